"""A SentencePiece BPE model as numpy tables: symbols, merge ranks, byte fallback.

Only the fields of the public model format that BPE encoding needs are read.  Models with a normaliser table, user-defined or
unused pieces, or without byte fallback are refused, because their results would differ.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

SPACE = "▁"
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NO_RANK = np.int64(1) << 31


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of one message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            n, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + n], at + n
        yield key >> 3, value


class PieceModel:
    """Symbols are piece ids; characters that are no piece get symbols above them, per call of ``symbols``."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            message = list(_fields(f.read()))
        pieces = [dict(_fields(v)) for number, v in message if number == 1]
        self.texts = [p[1].decode() for p in pieces]
        self.kinds = np.array([p.get(3, NORMAL) for p in pieces])
        scores = np.array([struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces])
        trainer = dict(_fields(next((v for number, v in message if number == 2), b"")))
        normalizer = dict(_fields(next((v for number, v in message if number == 3), b"")))
        plain = not normalizer.get(2) and normalizer.get(4, 1) == 0 and normalizer.get(5, 1) == 1
        if trainer.get(3) != 2 or trainer.get(35, 0) != 1 or not plain or trainer.get(24, 0):
            raise ValueError(f"{path}: only BPE models with byte fallback and no normaliser are supported")
        if np.isin(self.kinds, (USER_DEFINED, UNUSED)).any():
            raise ValueError(f"{path}: user-defined and unused pieces are not supported")
        self.dummy_prefix = normalizer.get(3, 1) == 1
        self.size = len(pieces)
        normal = {t: i for i, t in enumerate(self.texts) if self.kinds[i] == NORMAL}
        self.of_char = {t: i for t, i in normal.items() if len(t) == 1}
        if any(SPACE in t.lstrip(SPACE) for t in normal):
            raise ValueError(f"{path}: a piece spans a word boundary")
        if not {c for t in normal for c in t} <= self.of_char.keys():
            raise ValueError(f"{path}: a character of a piece is no piece itself")
        self.byte_ids = np.zeros(256, np.int64)
        for i, t in enumerate(self.texts):
            if self.kinds[i] == BYTE:
                self.byte_ids[int(t[3:5], 16)] = i
        # ranks: equal scores have equal ranks, the best score rank 0
        _, inverse = np.unique(-scores, return_inverse=True)
        merges = []
        for text, i in normal.items():
            for cut in range(1, len(text)):
                left, right = normal.get(text[:cut]), normal.get(text[cut:])
                if left is not None and right is not None:
                    merges.append((left * self.size + right, i, inverse[i]))
        merges.sort()
        self.pairs, self.merged, self.ranks = (np.array(x, np.int64) for x in zip(*merges, strict=True))
        raw = [
            bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k in (CONTROL, UNKNOWN) else t.replace(SPACE, " ").encode()
            for t, k in zip(self.texts, self.kinds, strict=True)
        ]
        raw[int(np.flatnonzero(self.kinds == UNKNOWN)[0])] = trainer.get(44, " ⁇ ".encode())
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_length = np.array([len(x) for x in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each adjacent pair and the piece it makes; NO_RANK where the two don't merge."""
        known = (left < self.size) & (right < self.size)
        key = np.where(known, left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        found = self.pairs[at] == key
        return np.where(found, self.ranks[at], NO_RANK), self.merged[at]

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat symbols, length of each word): a character is its piece, or ``size`` plus its code point."""
        flat = "".join(words)
        codes = np.frombuffer(flat.encode("utf-32-le"), np.uint32).astype(np.int64)
        kinds, inverse = np.unique(codes, return_inverse=True)
        ids = np.array([self.of_char.get(chr(c), self.size + c) for c in kinds], np.int64)
        return ids[inverse.reshape(-1)] if len(codes) else codes, np.array([len(w) for w in words], np.int64)

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text, each without the one space mark it begins with.

        No piece has a space mark after another character, so nothing merges across these cuts.  Joining the pre-tokens with
        a space mark before each gives the text, with a leading mark, back.
        """
        if not text:
            return []
        if not self.dummy_prefix:
            raise ValueError("models without a leading space mark are not supported")
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            out, run = [], 0
            for part in text.replace(" ", SPACE).split(SPACE):
                if part:
                    out.append(SPACE * run + part)
                    run = 0
                else:
                    run += 1
            # a trailing run of marks: one of them begins the last pre-token
            return out + [SPACE * (run - 1)] if run else out
        return text.split(" ")


@lru_cache(maxsize=4)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def merge_by_queue(model: PieceModel, symbols: list[int]) -> list[int]:
    """Final symbols of one long word, best pair first, with a priority queue: n log n where rounds would take n squared."""
    import heapq

    n = len(symbols)
    following, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    queue: list[tuple[int, int, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b < n:
            rank, made = pair(symbols[a], symbols[b])
            if rank < NO_RANK:
                heapq.heappush(queue, (rank, a, symbols[a], symbols[b], made))

    known: dict[tuple[int, int], tuple[int, int]] = {}

    def pair(x: int, y: int) -> tuple[int, int]:
        if (x, y) not in known:
            r, m = model.pair_ranks(np.array([x]), np.array([y]))
            known[x, y] = int(r[0]), int(m[0])
        return known[x, y]

    for i in range(n - 1):
        offer(i, i + 1)
    while queue:
        _, a, x, y, made = heapq.heappop(queue)
        b = following[a] if alive[a] else n
        if b >= n or symbols[a] != x or symbols[b] != y:
            continue
        symbols[a], alive[b], following[a] = made, False, following[b]
        if following[b] < n:
            before[following[b]] = a
        offer(before[a], a)
        offer(a, following[a])
    return [s for s, live in zip(symbols, alive, strict=True) if live]


def merge_words(model: PieceModel, words: list[str], long: int = 256, at_once: int = 1 << 20):
    """(flat final symbols, symbols of each word) of pre-tokens, all of them merged together.

    Sequences lie end to end in one array.  A round finds each sequence's lowest pair rank by a segmented minimum, the leftmost
    of equals, merges there in all sequences at the same time and closes the gaps; a sequence without a pair leaves.  That
    is the order in which the library merges.  At most ``at_once`` symbols (or one word) are held in rounds; sequences of
    over ``long`` symbols go through the priority queue, as rounds would take time in the square of their length.
    """
    symbols, lengths = model.symbols([SPACE + w for w in words])
    starts = np.cumsum(lengths) - lengths
    rows, counts, parts = [], [], []

    def leave(word: np.ndarray, count: np.ndarray, flat: np.ndarray) -> None:
        rows.append(word), counts.append(count), parts.append(flat)

    for w in np.flatnonzero(lengths > long):
        final = merge_by_queue(model, symbols[starts[w] : starts[w] + lengths[w]].tolist())
        leave(np.array([w]), np.array([len(final)]), np.array(final, np.int64))
    short = np.flatnonzero(lengths <= long)
    total = np.cumsum(lengths[short])
    for some in np.split(short, np.searchsorted(total, np.arange(at_once, total[-1] if len(total) else 0, at_once))):
        if len(some):
            begin = np.cumsum(lengths[some]) - lengths[some]
            take = np.arange(lengths[some].sum()) + np.repeat(starts[some] - begin, lengths[some])
            _rounds(model, symbols[take], lengths[some], some, leave)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row, count, flat = np.concatenate(rows), np.concatenate(counts), np.concatenate(parts)
    sizes = np.empty(len(words), np.int64)
    sizes[row] = count
    return flat[np.argsort(np.repeat(row, count), kind="stable")], sizes


def _rounds(model: PieceModel, flat: np.ndarray, lengths: np.ndarray, word: np.ndarray, leave) -> None:
    owner = np.repeat(np.arange(len(lengths)), lengths)
    rank, made = np.full(len(flat), NO_RANK), np.zeros(len(flat), np.int64)
    pair = np.flatnonzero(owner[:-1] == owner[1:])
    rank[pair], made[pair] = model.pair_ranks(flat[pair], flat[pair + 1])
    while len(flat):
        best = np.minimum.reduceat(rank * len(flat) + np.arange(len(flat)), np.cumsum(lengths) - lengths)
        merging, at = best // len(flat) < NO_RANK, best % len(flat)
        if not merging.all():
            stay = np.repeat(merging, lengths)
            leave(word[~merging], lengths[~merging], flat[~stay])
            at = (np.cumsum(stay) - 1)[at[merging]]
            flat, rank, made, word, lengths = flat[stay], rank[stay], made[stay], word[merging], lengths[merging]
            if not len(flat):
                return
        flat[at] = made[at]
        keep = np.ones(len(flat), bool)
        keep[at + 1] = False
        at = (np.cumsum(keep) - 1)[at]
        flat, rank, made, lengths = flat[keep], rank[keep], made[keep], lengths - 1
        ends = np.cumsum(lengths)
        rank[at[at + 1 == ends]] = NO_RANK
        pair = np.concatenate([at[at + 1 < ends], at[at > ends - lengths] - 1])
        rank[pair], made[pair] = model.pair_ranks(flat[pair], flat[pair + 1])


def encode_words(model: PieceModel, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, ids of each word): characters that are no piece become the ids of their UTF-8 bytes."""
    flat, sizes = merge_words(model, words)
    code = flat - model.size
    width = np.where(code < 0, 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
    odd = np.flatnonzero(code >= 0)
    ids = np.repeat(flat, width)
    if len(odd):
        begin = np.cumsum(width) - width
        raw = np.frombuffer("".join(map(chr, code[odd])).encode(), np.uint8)
        own = np.cumsum(width[odd]) - width[odd]
        ids[np.arange(len(raw)) + np.repeat(begin[odd] - own, width[odd])] = model.byte_ids[raw]
    word = np.repeat(np.arange(len(sizes)), sizes)
    return ids, np.bincount(word, weights=width, minlength=len(sizes)).astype(np.int64)


def decode_ids(model: PieceModel, ids: np.ndarray) -> bytes:
    """UTF-8 bytes that the ids stand for, the leading space mark included."""
    length = model.raw_length[ids]
    begin = np.cumsum(length) - length
    return model.raw[np.arange(length.sum()) + np.repeat(model.raw_start[ids] - begin, length)].tobytes()
