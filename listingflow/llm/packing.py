"""Packing documents into sequences of fixed length: shortest-pack-first over the histogram of lengths.

Documents become ids and are cut into pieces of at most the sequence length.  Only the histogram of piece lengths, one count
for each possible length, reaches the driver.  Lengths are placed longest first, each into the packs with the most room left; packs
with the same content are one pattern with a count, split when only some of them get a piece.  A placement says: of the
pieces of this length, those of ranks r to r + n go to sequences s to s + n at this offset.  Pieces learn their rank from
counts per writing task, without meeting in one task, and their place from the placements.

Where pieces run out before the rooms do, the sequences that hold least are dissolved: their content, end to end, is cut to
fill the rooms of the others (rooms under ``smallest_room`` stay), until less than one sequence's content would fit.

Defined results: a null or empty text has no ids but the end id; null ids and repeated rows are documents of their own; a
text of any length is cut into full pieces and a rest; other columns of the input are not read; an empty table gives no
pieces.  Sequence ids need not be consecutive.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_and_text, released, stored
from .library_tokens import WordTokens, load
from .words import text_slices

PIECES = "part int, piece long, doc_id long, start long, length long, doc_tokens long, rank_in_part long, ids binary"


class Placement(NamedTuple):
    """Pieces of ``length`` with ranks from ``rank`` on, ``count`` of them, go one each to the sequences from ``sequence`` on."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


class Pattern(NamedTuple):
    """``count`` sequences from ``first`` on that hold ``held`` tokens each."""

    held: int
    first: int
    count: int


def place(histogram: dict[int, int], capacity: int) -> tuple[list[Placement], list[Pattern]]:
    """Shortest-pack-first: longest lengths first, each into the packs that hold least.  Also the patterns left open.

    A length opens one pattern and splits one at most, so the work and the result are bounded by the capacity, not by the number
    of pieces.
    """
    placements, opened = [], 0
    patterns: list[Pattern] = []  # a heap, least content first
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if patterns and patterns[0].held + length <= capacity:
                held, first, count = heapq.heappop(patterns)
            else:
                held, first, count = 0, opened, left
                opened += left
            n = min(left, count)
            placements.append(Placement(length, rank, n, first, held))
            if n < count:
                heapq.heappush(patterns, Pattern(held, first + n, count - n))
            if held + length < capacity:
                heapq.heappush(patterns, Pattern(held + length, first, n))
            rank, left = rank + n, left - n
    return placements, sorted(patterns)


def dissolve(patterns: list[Pattern], capacity: int, smallest_room: int) -> tuple[list[Pattern], list[Pattern]]:
    """(patterns to dissolve, patterns whose rooms take their content): as many of the least filled sequences as will fit."""
    rooms = [p for p in patterns if capacity - p.held >= smallest_room]
    space = sum((capacity - p.held) * p.count for p in rooms)
    gone, content = [], 0
    for i, p in enumerate(rooms):
        n = min(p.count, (space - content) // capacity)  # each takes its own room away and needs its content's: one capacity
        gone += [p._replace(count=n)] if n else []
        content, space = content + n * p.held, space - n * (capacity - p.held)
        if n < p.count:
            return gone, [p._replace(first=p.first + n, count=p.count - n), *rooms[i + 1 :]]
    return gone, []


class Filling:
    """Where the content of dissolved sequences goes: both sides as one line of tokens, in the same order."""

    def __init__(self, gone: list[Pattern], rooms: list[Pattern], capacity: int):
        self.gone = sorted(gone, key=lambda p: p.first)
        self.first = np.array([p.first for p in self.gone], np.int64)
        self.base = np.cumsum([0] + [p.held * p.count for p in self.gone])
        self.rooms = rooms
        self.room = [capacity - p.held for p in rooms]
        self.room_base = np.cumsum([0] + [r * p.count for r, p in zip(self.room, rooms, strict=True)])

    def fragments(self, sequence: int, offset: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of each part of a piece; one part where nothing is dissolved."""
        i = int(np.searchsorted(self.first, sequence, "right")) - 1
        if i < 0 or sequence >= self.gone[i].first + self.gone[i].count:
            yield 0, length, sequence, offset
            return
        at, done = int(self.base[i]) + (sequence - self.gone[i].first) * self.gone[i].held + offset, 0
        while done < length:
            j = int(np.searchsorted(self.room_base, at, "right")) - 1
            number, inside = divmod(at - int(self.room_base[j]), self.room[j])
            n = min(length - done, self.room[j] - inside)
            yield done, n, self.rooms[j].first + number, self.rooms[j].held + inside
            done, at = done + n, at + n


def cut(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of every document, in the order of its ids, each with its ids and its rank among its task's pieces of that length."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = load(WordTokens, tokenizer), TaskContext.get().partitionId()
        end, seen, number = np.array([end_id], "<u4").tobytes(), np.zeros(capacity + 1, np.int64), 0
        for batch in released(batches):
            doc_ids = batch.column("doc_id").to_pylist()
            for row, texts in text_slices(batch):
                out = [[] for _ in range(8)]
                for doc_id, found in zip(doc_ids[row : row + len(texts)], tokens.encode(texts), strict=True):
                    ids = found.tobytes() + end
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        length = min(capacity, total - start)
                        piece = (part, number, doc_id, start, length, total, int(seen[length]), ids[4 * start : 4 * (start + length)])
                        for column, value in zip(out, piece, strict=True):
                            column.append(value)
                        seen[length] += 1
                        number += 1
                kinds = [pa.int32(), *[pa.int64()] * 6, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], _NAMES)

    return id_and_text(docs, id_col, text_col).mapInArrow(pieces, PIECES)


_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    smallest_room: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    ``ids`` holds unsigned 32-bit little-endian numbers; ``start`` counts the document's ids before the piece.
    """
    pieces = stored(cut(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    # at most one row for each length up to the capacity
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placements, patterns = place(histogram, capacity)
    placements.sort(key=lambda p: (p.length, p.rank))
    filling = Filling(*dissolve(patterns, capacity, smallest_room), capacity)
    span = np.int64(1) << 44  # more pieces of one length than any input has
    begins = np.array([p.length * span + p.rank for p in placements], np.int64)
    sequences = np.array([p.sequence for p in placements], np.int64)
    offsets = np.array([p.offset for p in placements], np.int64)

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            key = length * span + batch.column("rank").to_numpy()
            at = np.searchsorted(begins, key, "right") - 1
            rows = zip((sequences[at] + key - begins[at]).tolist(), offsets[at].tolist(), length.tolist(), strict=True)
            found = [list(filling.fragments(*row)) for row in rows]
            own = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            columns = [batch.column(c).take(own) for c in ("part", "piece")]
            columns += [pa.array(c, pa.int64()) for c in zip(*(x for part in found for x in part), strict=True)] or [own] * 4
            yield pa.RecordBatch.from_arrays(columns, ["part", "piece", "inside", "n", "sequence_id", "offset"])

    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    earlier = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    rank = (F.col("earlier") + F.col("rank_in_part")).alias("rank")
    ranked = pieces.join(earlier, ["part", "length"]).select("part", "piece", "length", rank)
    places = ranked.mapInArrow(placed, "part int, piece long, inside long, n long, sequence_id long, offset long")
    own_ids = F.expr("substring(ids, cast(4 * inside + 1 as int), cast(4 * n as int))")
    rows = pieces.select("part", "piece", "doc_id", "start", "doc_tokens", "ids").join(places, ["part", "piece"])
    start = (F.col("start") + F.col("inside")).alias("start")
    return rows.select("doc_id", start, F.col("n").alias("length"), "doc_tokens", "sequence_id", "offset", own_ids.alias("ids"))
