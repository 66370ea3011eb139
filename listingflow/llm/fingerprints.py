"""Document fingerprints: invertible sketches of paragraph digests, whose difference tells what changed.

A paragraph is the words of a line.  A line is cut further, so that an edit changes the paragraphs it touches and no others:
after words that their own hash chooses, one of ``cut`` on average, after 4 x ``cut`` words at the latest, and after each of a
text's first 2 x ``cut`` words, so that short texts have several too.  A paragraph's digest covers its words and their order, not the white space between them.  The second and further occurrences of a paragraph in a text count as paragraphs of their own.

A sketch has a fixed number of cells in three parts.  Every paragraph is added to one cell of each part: to its count, its sum
of digests and its sum of check numbers.  Subtracting two sketches leaves what only one text has; a cell that holds a single
paragraph gives its digest, which is taken out of its other cells, until all cells are empty.  Where that gets stuck the
difference is too large for the sketch, and both texts are sketched anew with twice the cells, until it succeeds.  All pairs
of a batch are subtracted and peeled together, as flat arrays.  The fingerprint of a text is its sketch at the smallest size.

Documents meet their successors by a range partitioning with bounds from a sample of the ids (``SAMPLE`` rows a range; they
set the ranges, not the result), in which the first document of each range also goes to the range before.  Texts are shuffled
once and stream through a task; what a task holds does not grow with its range.

Defined results: a null text is the empty text; a null id comes before all others; documents that agree in id are in the order of
a hash of their texts, then of the texts; a document alone in its table is its own successor; two texts without words are alike
(1.0), and one such text is unlike any other (0.0); an empty table gives no rows; columns that are not named are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text
from .words import _numbers, mixed, words_of

#: Cells of the smallest sketch: differences of some 15 paragraphs come out of it.
CELLS = 24
#: One word of so many ends a paragraph inside a line.
CUT = 4
#: Ranges for each shuffle partition, and rows of the sample for each range.
RANGES, SAMPLE = 8, 16
#: Bytes of text that are taken apart at once; a single longer text is taken whole.
SLICE = 1_000_000

_PARTS = 3
_CELL = np.dtype([("count", "<i4"), ("digests", "<u8"), ("checks", "<u8")])
_CHECK, _AGAIN = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9E3779B97F4A7C15)


class Paragraphs(NamedTuple):
    """Digests of the paragraphs of some texts: ``first[i]`` to ``first[i + 1]`` are those of text i, all different."""

    digest: np.ndarray
    first: np.ndarray

    def of(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``texts``, digest) of every paragraph of some of the texts."""
        length = (self.first[1:] - self.first[:-1])[texts]
        row = np.repeat(np.arange(len(texts)), length)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        return row, self.digest[np.repeat(self.first[:-1][texts], length) + inside]

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def paragraphs(texts: pa.Array, cut: int = CUT) -> Paragraphs:
    """The paragraphs of a string column without nulls; ``cut`` 0 leaves lines whole."""
    words = words_of(texts)
    n = len(words.start)
    if not n:
        return Paragraphs(np.zeros(0, np.uint64), words.first)
    line = np.cumsum((words.data >= 10) & (words.data <= 13))[words.start]
    begins = np.zeros(n, bool)
    begins[words.first[:-1][words.first[:-1] < n]] = True
    begins[1:] |= line[1:] != line[:-1]
    if cut:
        number = np.arange(n) - np.repeat(words.first[:-1], np.diff(words.first))
        begins[1:] |= (words.hashes[:-1] % np.uint64(cut) == 0) | (number[1:] <= 2 * cut)
        start, length = _lengths(begins)
        begins |= (np.arange(n) - np.repeat(start, length)) % (4 * cut) == 0
    start, length = _lengths(begins)
    place = np.arange(n) - np.repeat(start, length)
    digest = mixed(np.add.reduceat(words.hashes * _numbers(1 << 21, int(length.max()))[place], start) + length.astype(np.uint64))
    first = np.searchsorted(start, words.first)
    return Paragraphs(_numbered(digest, first), first)


def _lengths(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs, given where each begins."""
    start = np.flatnonzero(begins)
    return start, np.diff(np.append(start, len(begins)))


def _numbered(digest: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Digests with those of repeats within a text changed by how often the paragraph came before."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((digest, row))
    d, r = digest[order], row[order]
    new = np.append(True, (d[1:] != d[:-1]) | (r[1:] != r[:-1]))
    number = np.arange(len(d)) - np.repeat(*_lengths(new))
    out = digest.copy()
    later = number > 0
    out[order[later]] = mixed(d[later] + number[later].astype(np.uint64) * _AGAIN)
    return out


class Sketches:
    """The cells of ``n`` sketches of ``size`` cells each, end to end."""

    def __init__(self, n: int, size: int):
        self.n, self.size = n, size
        self.count = np.zeros(n * size, np.int32)
        self.digests, self.checks = np.zeros(n * size, np.uint64), np.zeros(n * size, np.uint64)

    def cells(self, row: np.ndarray, digest: np.ndarray, part: int) -> np.ndarray:
        third = self.size // _PARTS
        seed = np.array([self.size * _PARTS + part], np.uint64)
        return row * self.size + part * third + (mixed(digest ^ mixed(seed * _AGAIN)) % np.uint64(third)).astype(np.int64)

    def add(self, row: np.ndarray, digest: np.ndarray, sign: np.ndarray | int) -> np.ndarray:
        """Adds paragraphs, or takes them out where ``sign`` is -1; the cells that changed."""
        changed = []
        times = np.asarray(sign, np.int64).astype(np.uint64)  # -1 is the inverse of 1 modulo 2^64
        check = mixed(digest ^ _CHECK)
        for part in range(_PARTS):
            at = self.cells(row, digest, part)
            np.add.at(self.count, at, np.broadcast_to(np.asarray(sign, np.int32), at.shape))
            np.add.at(self.digests, at, digest * times)
            np.add.at(self.checks, at, check * times)
            changed.append(at)
        return np.concatenate(changed)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, digest, sign) of what can be recovered, taken out of the cells."""
        found = []
        at = np.flatnonzero(np.abs(self.count) == 1)
        for _ in range(4 * self.size):
            if not len(at):
                break
            sign = self.count[at]
            times = sign.astype(np.int64).astype(np.uint64)
            digest = self.digests[at] * times
            single = self.checks[at] * times == mixed(digest ^ _CHECK)
            row, digest, sign = at[single] // self.size, digest[single], sign[single]
            if not len(row):
                break
            order = np.lexsort((digest, row))  # one paragraph may stand alone in several of its cells
            row, digest, sign = row[order], digest[order], sign[order]
            one = np.append(True, (row[1:] != row[:-1]) | (digest[1:] != digest[:-1]))
            row, digest, sign = row[one], digest[one], sign[one]
            found.append((row, digest, sign))
            changed = np.unique(self.add(row, digest, -sign))
            at = changed[np.abs(self.count[changed]) == 1]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def empty(self) -> np.ndarray:
        """For each sketch whether nothing is left in it."""
        full = (self.count != 0) | (self.digests != 0) | (self.checks != 0)
        return ~full.reshape(self.n, self.size).any(axis=1)

    def texts(self) -> list[str]:
        out = np.empty(self.n * self.size, _CELL)
        out["count"], out["digests"], out["checks"] = self.count, self.digests, self.checks
        data, width = out.tobytes(), self.size * _CELL.itemsize
        return [base64.b64encode(data[i * width : (i + 1) * width]).decode() for i in range(self.n)]


def sketches(of: Paragraphs, size: int = CELLS) -> Sketches:
    n = len(of.first) - 1
    out = Sketches(n, size)
    out.add(*of.of(np.arange(n)), 1)
    return out


class Difference(NamedTuple):
    """What only the left and only the right text of each pair has: (pair, digest, sign) with sign 1 and -1."""

    pair: np.ndarray
    digest: np.ndarray
    sign: np.ndarray


def difference(left: Paragraphs, a: np.ndarray, right: Paragraphs, b: np.ndarray, size: int = CELLS) -> Difference:
    """Paragraphs in which text ``a[i]`` of the left and ``b[i]`` of the right differ, peeled out of subtracted sketches.

    Starts with ``size`` cells, with more where the numbers of paragraphs alone differ by as much, and doubles them for
    the pairs that are not empty at the end.
    """
    out, waiting = [], np.arange(len(a))
    gap = np.abs(left.sizes()[a] - right.sizes()[b])
    while len(waiting):
        ready = gap[waiting] < size
        now = waiting[ready]
        held = Sketches(len(now), size)
        held.add(*left.of(a[now]), 1)
        held.add(*right.of(b[now]), -1)
        row, digest, sign = held.peel()
        done = held.empty()
        # an element wrongly taken for one cancels out where the sketch ends up empty
        good = done[row]
        out.append((now[row[good]], digest[good], sign[good]))
        waiting = np.concatenate([waiting[~ready], now[~done]])
        size *= 2
    parts = zip(*out, strict=True) if out else [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32)]
    return Difference(*(np.concatenate(x) if out else x for x in parts))


def likeness(left: Paragraphs, a: np.ndarray, right: Paragraphs, b: np.ndarray, size: int = CELLS) -> np.ndarray:
    """Twice the paragraphs that both texts of a pair have, of the paragraphs of both; 1 where neither has any."""
    found = difference(left, a, right, b, size)
    both = left.sizes()[a] + right.sizes()[b]
    apart = np.bincount(found.pair, minlength=len(a))
    return np.where(both > 0, (both - apart) / np.maximum(both, 1), 1.0)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _compared(ids: list, texts: list[str], cells: int, cut: int) -> pa.RecordBatch:
    """The results of all texts but the last, each with the one after it as its successor."""
    n = len(ids) - 1
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    own, other = paragraphs(pa.array(texts, pa.large_string()), cut), paragraphs(pa.array(changed, pa.large_string()), cut)
    row = np.arange(n)
    arrays = [
        pa.array(ids[:-1], pa.int64()),
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
        pa.array(sketches(own, cells).texts()[:-1]),
        pa.array(sketches(other, cells).texts()),
        pa.array(likeness(own, row, other, row, cells)),
        pa.array(likeness(own, row, own, row + 1, cells)),
    ]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _SCHEMA.split(", ")])


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Successive documents of a range, some at a time; the last of a run comes again as the first of the next."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        columns = (batch.column(c) for c in ("doc_id", "text", "follows"))
        for doc_id, value, follows in zip(*columns, strict=True):
            text = value.as_py() or ""
            ids.append(doc_id.as_py())
            texts.append(text)
            size += len(text)
            if follows.as_py():  # the first document of the next range, which ends this one
                if len(ids) > 1:
                    yield ids, texts
                ids, texts, size = [], [], 0
            elif size > SLICE and len(ids) > 1:
                yield ids, texts
                ids, texts, size = ids[-1:], texts[-1:], len(text)


def with_successors(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """``doc_id, text, follows``, dealt and sorted so that each row's successor in the order of ids is the next row of its partition.

    A row with ``follows`` stands at the end of a range: the first row of the next range (after the last range, of the first).
    """
    spark = rows.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = partitions * RANGES
    key = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key")
    # texts as they count here: null as empty
    keyed = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key).withColumn("hash", F.xxhash64("text"))
    keys = keyed.select("key", "hash")
    sample = keys.sample(min(1.0, ranges * SAMPLE / max(1, rows.count())), seed=7).collect()
    ends = sorted((r.key, r.hash) for r in sample)[SAMPLE::SAMPLE]
    end_keys, end_hashes = np.array([k for k, _ in ends], np.int64), np.array([h for _, h in ends], np.int64)

    @F.pandas_udf("int")
    def range_of(key: pd.Series, hash: pd.Series) -> pd.Series:
        """How many ends are not above a row."""
        k, h = key.to_numpy(), hash.to_numpy()
        out, low = np.searchsorted(end_keys, k, "right"), np.searchsorted(end_keys, k, "left")
        for i in np.unique(low[low < out]):  # an id that is itself an end, perhaps of many ranges
            mine = (low == i) & (low < out)
            high = out[mine][0]
            out[mine] = i + np.searchsorted(end_hashes[i:high], h[mine], "right")
        return pd.Series(out)

    firsts = keys.withColumn("range", range_of("key", "hash")).groupBy("range").agg(F.min(F.struct("key", "hash")).alias("first")).collect()
    firsts.sort(key=lambda r: r.range)  # a row for each range
    before = [(r.first.key, r.first.hash, firsts[i - 1].range) for i, r in enumerate(firsts)]
    ahead = spark.createDataFrame(before, "key long, hash long, ahead int")
    own = F.struct(F.col("range"), F.lit(False).alias("follows"))
    also = F.when(F.col("ahead").isNotNull(), F.struct(F.col("ahead").alias("range"), F.lit(True).alias("follows")))
    placed = keyed.withColumn("range", range_of("key", "hash")).join(F.broadcast(ahead), ["key", "hash"], "left")
    placed = placed.withColumn("place", F.explode(F.array_compact(F.array(own, also))))
    dealt = placed.select("doc_id", "text", "key", "hash", "place.range", "place.follows").repartition(partitions, "range")
    return dealt.sortWithinPartitions("range", "follows", "key", "hash", "text").select("doc_id", "text", "follows")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS, cut: int = CUT) -> DataFrame:
    """Every document's fingerprint, that of its text with the last quarter replaced by its successor's beginning, and how alike
    the fingerprint is to that one and to the successor's.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    """

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _runs(batches):
            yield _compared(ids, texts, cells, cut)

    return with_successors(id_and_text(docs, id_col, text_col)).mapInArrow(compared, _SCHEMA)


def changes(old: DataFrame, new: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS, cut: int = CUT) -> DataFrame:
    """Between two versions of a table: ``doc_id, n_old, n_new, only_old, only_new``, the numbers of paragraphs of each document
    and the digests of those that only one version has.

    Documents that a version lacks have no paragraphs there; null ids are left out; an id that a version has repeatedly
    gives a row for each combination.
    """
    schema = "doc_id long, n_old long, n_new long, only_old array<long>, only_new array<long>"
    a, b = id_and_text(old, id_col, text_col), id_and_text(new, id_col, text_col).withColumnRenamed("text", "new_text")
    pairs = a.where("doc_id is not null").join(b.where("doc_id is not null"), "doc_id", "full")

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, int(len(batch) * SLICE / max(1, batch.nbytes)))
            for begin in range(0, len(batch), step):
                part = batch.slice(begin, step)
                left, right = (paragraphs(part.column(c).fill_null("").cast(pa.large_string()), cut) for c in ("text", "new_text"))
                row = np.arange(len(part))
                found = difference(left, row, right, row, cells)
                sides = [_lists(found, found.sign == s, len(part)) for s in (1, -1)]
                arrays = [part.column("doc_id"), pa.array(left.sizes(), pa.int64()), pa.array(right.sizes(), pa.int64()), *sides]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])

    return pairs.mapInArrow(compared, schema)


def _lists(found: Difference, chosen: np.ndarray, n: int) -> pa.ListArray:
    """The chosen digests of each pair, in ascending order."""
    pair, digest = found.pair[chosen], found.digest[chosen].view(np.int64)
    order = np.lexsort((digest, pair))
    offsets = np.append(0, np.cumsum(np.bincount(pair, minlength=n)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(digest[order]))


def paragraph_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: int = CUT) -> DataFrame:
    """``doc_id, digest`` of every paragraph, to look up what ``changes`` names."""

    def taken(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, int(len(batch) * SLICE / max(1, batch.nbytes)))
            for begin in range(0, len(batch), step):
                part = batch.slice(begin, step)
                own = paragraphs(part.column("text").fill_null("").cast(pa.large_string()), cut)
                row, digest = own.of(np.arange(len(part)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row)), pa.array(digest.view(np.int64))], ["doc_id", "digest"])

    return id_and_text(docs, id_col, text_col).mapInArrow(taken, "doc_id long, digest long")
