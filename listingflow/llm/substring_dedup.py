"""Removing passages that occur more than once, by level-wise doubling of window lengths.

A window of ``width`` words whose sequence also starts anywhere else is removed.  Such windows are found from short to long:
lengths double from a quarter of the width up to the width, and only what is repeated at one length is extended to twice that
length, until the full width is reached or no candidate survives.

* A repeated window has only repeated shorter windows, so it is enough to look at one of them: at the one with the lowest hash,
  which is the same in every copy of the window.  On the first level that leaves one window in some fourteen to be shuffled.
* What survives is kept as regions, runs of word hashes; from the second level on neither texts nor discarded parts are read.
* On the last level all windows of the regions are compared.  A window that occurs once drops out; the words under the rest
  are removed.
* Equal texts are one text here.  If there are two or more, all their windows are repeated, and only other texts need to know.

Windows are compared by 64-bit hashes.  Counting combines before the shuffle, so a passage in very many documents is one
row per task; no group of equal windows is ever collected.

Defined results: a null, empty or wordless text has no words; a text of fewer words than the width loses none unless ``width``
is smaller; rows with a null id and repeated rows are documents like others (so repeated rows are copies of each other);
other columns are not read; an empty table gives an empty result.  Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, stored
from .words import Words, shingle_hashes, text_slices, words_of


def ladder(width: int) -> list[int]:
    """Lengths from a quarter of the width on, each at most twice the one before."""
    half = -(-width // 2)
    return sorted({max(1, -(-half // 2)), half, width})


def sliding(x: np.ndarray, k: int, best: np.ufunc) -> np.ndarray:
    """``best`` of every k consecutive values, by doubling spans."""
    span = 1
    while 2 * span <= k:
        x = best(x[:-span], x[span:])
        span *= 2
    return best(x[: len(x) - (k - span)], x[k - span :]) if span < k else x


class Level:
    """Windows of ``width`` words in runs of word hashes, each with the lowest hash of the ``length``-word windows in it."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray, length: int, width: int):
        k = width - length + 1
        self.grams = shingle_hashes(hashes, length)
        self.windows = max(0, len(hashes) - width + 1)
        self.lowest = sliding(self.grams, k, np.minimum)[: self.windows] if self.windows else np.zeros(0, np.uint64)
        self.owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        start = np.arange(self.windows)
        self.valid = self.owner[: self.windows] == self.owner[width - 1 :][: self.windows] if self.windows else start > 0
        # a short window is looked at if it is the lowest of some window
        shown = np.zeros(self.windows + 2 * (k - 1), np.uint64)
        shown[k - 1 : k - 1 + self.windows] = np.where(self.valid, self.lowest, np.uint64(0))
        high = sliding(shown, k, np.maximum) if self.windows else np.zeros(0, np.uint64)
        self.looked_at = np.flatnonzero((high > 0) & (high == self.grams[: len(high)]))


def _runs(flags: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last) of every run of flagged positions with the same owner."""
    at = np.flatnonzero(flags)
    if len(at):
        cut = np.flatnonzero((np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]]))
        yield from zip(at[np.r_[0, cut + 1]].tolist(), at[np.r_[cut, len(at) - 1]].tolist(), strict=True)


REGIONS = "key long, start long, hashes binary"


def _region_batch(keys: list[int], starts: list[int], hashes: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(hashes, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["key", "start", "hashes"])


def _first_level(docs: DataFrame, length: int, width: int) -> DataFrame:
    """``key, grams, places``: the short windows of each text that are looked at."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in text_slices(batch):
                words = words_of(texts)
                level = Level(words.hashes, words.first, length, width)
                cut = np.searchsorted(level.looked_at, words.first).astype(np.int32)
                place = level.looked_at - words.first[:-1][level.owner[level.looked_at]]
                grams = pa.ListArray.from_arrays(pa.array(cut), pa.array(level.grams[level.looked_at].view(np.int64)))
                places = pa.ListArray.from_arrays(pa.array(cut), pa.array(place.astype(np.int32)))
                columns = [batch.column("key").slice(row, len(texts)), grams, places]
                yield pa.RecordBatch.from_arrays(columns, ["key", "grams", "places"])

    return docs.select("key", "text").mapInArrow(run, "key long, grams array<long>, places array<int>")


def _first_regions(texts: DataFrame, length: int, width: int) -> DataFrame:
    """Regions of texts whose ``places`` are the short windows found repeated."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, some in text_slices(batch):
                words = words_of(some)
                level = Level(words.hashes, words.first, length, width)
                keys = batch.column("key").slice(row, len(some)).to_pylist()
                places = batch.column("places").slice(row, len(some))
                own = np.repeat(words.first[:-1], [len(p) for p in places])
                at = own + places.flatten().to_numpy()
                # a hash is enough: one repeated at some place is repeated at all
                candidate = level.valid & np.isin(level.lowest, level.grams[at])
                yield from _cut(level, candidate, words.hashes, keys, (-words.first[:-1]).tolist(), width)

    return texts.mapInArrow(run, REGIONS)


def _cut(level: Level, candidate: np.ndarray, hashes: np.ndarray, keys: list, shift: list[int], width: int) -> Iterator[pa.RecordBatch]:
    """The runs of candidate windows as regions; ``shift`` takes a position to its place in the text."""
    out: tuple[list, list, list] = ([], [], [])
    for begin, last in _runs(candidate, level.owner):
        owner = level.owner[begin]
        out[0].append(keys[owner]), out[1].append(begin + shift[owner])
        out[2].append(hashes[begin : last + width].tobytes())
    if out[0]:
        yield _region_batch(*out)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column("hashes")]
    return np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])


def _small(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for begin in range(0, len(batch), rows):
        yield batch.slice(begin, rows)


def _looked_at(regions: DataFrame, length: int, width: int) -> DataFrame:
    """``gram, key, place`` of the windows of ``length`` words that are looked at in regions."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _small(whole)):
            hashes, first = _flat(batch)
            level = Level(hashes, first, length, width)
            at, owner = level.looked_at, level.owner[level.looked_at]
            place = at - first[:-1][owner] + batch.column("start").to_numpy()[owner]
            keys = batch.column("key").to_numpy()[owner]
            yield pa.RecordBatch.from_arrays([pa.array(level.grams[at].view(np.int64)), pa.array(keys), pa.array(place)], ["gram", "key", "place"])

    return regions.mapInArrow(run, "gram long, key long, place long")


def _single(windows: DataFrame) -> DataFrame:
    """``key, gone``: the places of windows that occur once, as an array for each text that has any."""
    once = windows.groupBy("gram").agg(F.count("*").alias("n"), F.min("key").alias("key"), F.min("place").alias("place"))
    return once.where("n = 1").groupBy("key").agg(F.collect_list("place").alias("gone"))


def _with_gone(regions: DataFrame, length: int, width: int, finish: Callable, schema: str) -> DataFrame:
    """``finish(level, candidate windows, batch, hashes, first)`` of the regions without the windows that occur once."""
    gone = stored(_single(_looked_at(regions, length, width)), f"single-{length}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _small(whole)):
            hashes, first = _flat(batch)
            level = Level(hashes, first, length, width)
            start, keep = batch.column("start").to_numpy(), np.ones(len(level.grams) + 1, bool)
            for row, places in enumerate(batch.column("gone").to_pylist()):
                at = np.array(places or [], np.int64) - start[row] + first[row]
                keep[at[(at >= first[row]) & (at <= first[row + 1] - length)]] = False
            lost = level.grams[~keep[:-1]]
            yield from finish(level, level.valid & ~np.isin(level.lowest, lost), batch, hashes, first)

    return regions.join(gone, "key", "left").mapInArrow(run, schema)


def repeated_ranges(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, starts, ends, whole``: the ranges of words under repeated windows, for each text that has any.

    ``key`` is the text's xxhash64.  Texts that occur more than once have ``whole`` instead of ranges.
    """
    docs = id_and_text(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("key"))
    first, *later = ladder(width)
    seen = stored(_first_level(docs, first, width), "short-windows")
    windows = seen.select("key", F.explode(F.arrays_zip("grams", "places")).alias("w"))
    windows = windows.select("key", F.col("w.grams").alias("gram"), F.col("w.places").alias("place"))
    # stored, so that neither side of the join is partitioned by its aggregate and the places of a frequent window can be split
    repeated = stored(windows.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "repeated")
    places = windows.join(repeated, "gram").groupBy("key").agg(F.collect_set("place").alias("places"))
    texts = stored(docs.groupBy("key").agg(F.min("doc_id").alias("own_id"), F.count("*").alias("copies")), "texts")
    wanted = stored(texts.join(places, "key").select("key", "own_id", "places"), "wanted")
    size = wanted.agg(F.coalesce(F.sum(F.size("places") + 8), F.lit(0))).first()[0]
    wanted = F.broadcast(wanted) if size <= 8_000_000 else wanted  # 64 MB at most; beyond, texts are shuffled
    read = docs.join(wanted, (docs.key == wanted.key) & docs.doc_id.eqNullSafe(wanted.own_id))
    read = read.select(docs.key, "text", "places")
    regions = stored(_first_regions(read, first, width), f"regions-{first}")

    def cut(level: Level, candidate: np.ndarray, batch: pa.RecordBatch, hashes: np.ndarray, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
        shift = (batch.column("start").to_numpy() - begins[:-1]).tolist()
        yield from _cut(level, candidate, hashes, batch.column("key").to_pylist(), shift, width)

    def ranges(level: Level, candidate: np.ndarray, batch: pa.RecordBatch, hashes: np.ndarray, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, start, out = batch.column("key").to_pylist(), batch.column("start").to_numpy(), []
        for begin, last in _runs(candidate, level.owner):
            owner = level.owner[begin]
            at = int(start[owner] - begins[owner])
            out.append((keys[owner], begin + at, last + width + at))
        columns = zip(*out, strict=True) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "start", "end"])

    for length in later[:-1]:
        regions = stored(_with_gone(regions, length, width, cut, REGIONS), f"regions-{length}")
    found = _with_gone(regions, width, width, ranges, "key long, start long, end long")
    by_text = found.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("r"))
    by_text = by_text.select("key", F.col("r.start").alias("starts"), F.col("r.end").alias("ends"))
    both = texts.where("copies > 1").select("key", F.lit(True).alias("whole")).join(by_text, "key", "full")
    return stored(both.select("key", "starts", "ends", F.coalesce("whole", F.lit(False)).alias("whole")), "repeated-ranges")


def _kept(words: Words, remove: np.ndarray, first: int, end: int) -> bytes:
    """The words from ``first`` to ``end`` that stay, joined by one space."""
    stay = np.flatnonzero(~remove[first:end]) + first
    if not len(stay):
        return b""
    length = words.end[stay] - words.start[stay] + 1
    begin = np.cumsum(length) - length
    at = np.arange(length.sum()) - np.repeat(begin - words.start[stay], length)
    out = words.data[np.minimum(at, len(words.data) - 1)]
    out[begin[1:] - 1] = 32
    return out[:-1].tobytes()


def remove_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: every text without its repeated passages, words joined by one space."""
    ranges = repeated_ranges(docs, width, id_col, text_col)
    size = ranges.agg(F.coalesce(F.sum(F.coalesce(F.size("starts"), F.lit(0)) + 3), F.lit(0))).first()[0]
    ranges = F.broadcast(ranges) if size <= 4_000_000 else ranges  # 64 MB at most; beyond, texts are shuffled
    own = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in text_slices(batch):
                words = words_of(texts)
                whole, starts, ends = (batch.column(c).slice(row, len(texts)).to_pylist() for c in ("whole", "starts", "ends"))
                remove, counts, kept = np.zeros(len(words.start), bool), [], []
                for i, (first, end) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                    if whole[i]:
                        remove[first:end] = end - first >= width
                    for a, b in zip(starts[i] or [], ends[i] or [], strict=True):
                        remove[first + a : first + b] = True
                    counts.append(int(remove[first:end].sum()))
                    kept.append(_kept(words, remove, first, end).decode())
                ids = batch.column("doc_id").slice(row, len(texts))
                columns = [ids, pa.array(np.diff(words.first)), pa.array(counts, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    schema = "doc_id long, n_words long, n_removed long, kept string"
    return own.join(ranges, "key", "left").select("doc_id", "text", "whole", "starts", "ends").mapInArrow(run, schema)
