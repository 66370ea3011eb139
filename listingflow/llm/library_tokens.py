"""Ids of the tokenizers library, by part of a text: every distinct part is encoded once per worker and then looked up.

A text may be cut where the pre-tokenizer never lets a token reach across, so the ids of the parts, end to end, are the ids of
the text.  ``ByteLevelTokens`` and ``WordTokens`` cut for their kinds of tokenizer.  Parts are found, hashed and looked up as
numpy arrays over the bytes of many texts; only new parts become strings and go to the library.  Texts that hold what might be
a special string, or white space beyond ASCII, are given to the library whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .words import column_bytes, segment_hashes, words_of

# Ends of a part that are a pre-token of their own after a letter: what stands before them is encoded without them.
_ENDS = (".", ",")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
# UTF-8 of the white space beyond ASCII.
_WIDE_WHITE = frozenset(
    chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


class Lexicon:
    """Ids by 64-bit hash: a large sorted table and a small one of what came last, merged now and then.

    Holds at most ``limit`` parts and is emptied beyond, which changes speed only.
    """

    def __init__(self, limit: int = 2_000_000):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2  # (hashes, numbers of parts), old and recent
        self.flat, self.used = np.zeros(1024, np.uint32), 0
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the parts, -1 for those not held."""
        out = np.full(len(hashes), -1)
        for known, number in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                out = np.where(known[at] == hashes, number[at], out)
        return out

    def add(self, hashes: np.ndarray, ids: list[bytes]) -> None:
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        new, total = np.frombuffer(b"".join(ids), "<u4"), int(lengths.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(total, self.used), np.uint32)])
        self.flat[self.used : self.used + total] = new
        number = len(self.start) + np.arange(len(ids))
        self.start = np.concatenate([self.start, self.used + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.used += total
        old, recent = self.tables[0], self._merged(self.tables[1], (hashes, number))
        if 4 * len(recent[0]) > len(old[0]) + 100_000:
            old, recent = self._merged(old, recent), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.tables = [old, recent]

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
        hashes, number = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
        order = np.argsort(hashes, kind="stable")
        return hashes[order], number[order]

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the parts end to end, number of ids of each part)."""
        length = self.length[numbers]
        begin = np.cumsum(length) - length
        return self.flat[np.arange(int(length.sum())) + np.repeat(self.start[numbers] - begin, length)], length


class LibraryTokens:
    """Encodes many new parts with one call: between two of them stands a control character that is a pre-token of its own."""

    between = " \x01"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if not all(s.startswith("<|") for s in special):
            raise ValueError(f"{path}: special strings are expected to begin with <|")
        self.mark = self._ids(self.between)  # the ids between two parts; the last stands for the control character
        self.ends = {e: self._ids(e).tobytes() if e else b"" for e in ("", *_ENDS)}
        self.lexicon = Lexicon()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _together(self, parts: list[str], at_once: int = 64) -> list[bytes]:
        """The ids of each part; parts begin with white space, or drop it."""
        runs = [parts[i : i + at_once] for i in range(0, len(parts), at_once)]
        found = self.tokenizer.encode_batch_fast([self.between.join(r) for r in runs], add_special_tokens=False)
        out: list[bytes] = []
        for run, encoding in zip(runs, found, strict=True):
            ids = np.array(encoding.ids, "<u4")
            cuts = np.flatnonzero(ids == self.mark[-1])
            if len(cuts) == len(run) - 1:
                raw, width = ids.tobytes(), 4 * len(self.mark)
                ends = [*(4 * cuts + 4).tolist(), len(raw) + width]
                out += [raw[a : b - width] for a, b in zip([0, *ends], ends, strict=False)]
            else:  # a part holds the control character itself
                out += [self._ids(p).tobytes() for p in run]
        return out

    def _encode(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, encoded alone.  A full stop or comma after a letter is encoded apart, as the library does."""
        split = [(p[:-1], p[-1]) if p[-1:] in _ENDS and p[-2:-1] in _LETTERS else (p, "") for p in parts]
        stems = list({stem for stem, _ in split})
        known = dict(zip(stems, self._together(stems), strict=True))
        return [known[stem] + self.ends[end] for stem, end in split]

    def _looked_up(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts end to end, number of ids of each part)."""
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.lexicon.start) > self.lexicon.limit:
            self.lexicon.clear()
        numbers = self.lexicon.find(distinct)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            raw = data.tobytes()
            parts = [raw[a:b].decode() for a, b in zip(start[at[new]].tolist(), end[at[new]].tolist(), strict=True)]
            self.lexicon.add(distinct[new], self._encode(parts))
            numbers[new] = len(self.lexicon.start) - len(new) + np.arange(len(new))
        return self.lexicon.ids(numbers[inverse.reshape(-1)])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a column without nulls."""
        data, offsets = column_bytes(texts)
        raw = data.tobytes()
        odd = np.zeros(len(texts), bool)
        if b"<|" in raw:
            odd |= [b"<|" in raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        odd[self._unfit(data, offsets, raw)] = True
        whole = {i: self._ids(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()}
        rest = texts.filter(pa.array(~odd)) if whole else texts
        ids, ends = self._plain(rest)
        plain = iter(np.split(ids, ends[:-1]) if len(rest) else [])
        return [whole[i] if i in whole else next(plain) for i in range(len(texts))]

    def _unfit(self, data: np.ndarray, offsets: np.ndarray, raw: bytes) -> list[int]:
        return []

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, where each text's ids end)."""
        raise NotImplementedError


class ByteLevelTokens(LibraryTokens):
    """Byte-level BPE whose pattern gives a space to the token after it.

    The last white space before a visible character is its space or a token of its own, and white space before that is one token;
    so a text is cut before and after that white space.
    """

    def _unfit(self, data: np.ndarray, offsets: np.ndarray, raw: bytes) -> list[int]:
        """Texts with white space beyond ASCII."""
        lead = np.flatnonzero(_LEAD[data]).tolist()
        wide = [i for i in lead if raw[i : i + 2] in _WIDE_WHITE or raw[i : i + 3] in _WIDE_WHITE] if lead else []
        return np.unique(np.searchsorted(offsets, wide, "right") - 1).tolist() if wide else []

    def _encode(self, parts: list[str]) -> list[bytes]:
        spaced = [p for p in parts if p[0] in " \t\n\x0b\f\r"]
        known = dict(zip(spaced, super()._encode(spaced), strict=True))
        return [known[p] if p in known else self._ids(p).tobytes() for p in parts]

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = column_bytes(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        white = _WHITE[data]
        first = np.zeros(len(data), bool)
        first[offsets[:-1][offsets[:-1] < len(data)]] = True
        cut = first.copy()
        # a run of white space begins: cut, unless it is the one white space before a visible character, which is cut anyway
        cut[1:] |= white[1:] & ~white[:-1]
        # the last white space before a visible character of the same text
        cut[:-1] |= white[:-1] & ~white[1:] & ~first[1:]
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(data))
        ids, count = self._looked_up(segment_hashes(data, start, end - start), data, start, end)
        total = np.append(0, np.cumsum(count))
        return ids, total[np.searchsorted(start, offsets[1:])]


class WordTokens(LibraryTokens):
    """BPE with word ends that drops white space and case: a text is cut at all ASCII white space, capitals A to Z made small."""

    between = " \x01 "

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = words_of(texts, lower=True)
        ids, count = self._looked_up(words.hashes, words.data, words.start, words.end)
        return ids, np.append(0, np.cumsum(count))[words.first[1:]]


@lru_cache(maxsize=4)
def load(kind: type[LibraryTokens], path: str) -> LibraryTokens:
    return kind(path)
