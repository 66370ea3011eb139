"""Work on groups of rows that a task sees one at a time, with large groups cut into blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Pairs = list[tuple[int, int]]


def runs(batches: Iterable[pa.RecordBatch], key: str = "block") -> Iterator[pa.Table]:
    """The rows of each value of a long column by which the batches are sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(batch)]
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        for begin, end in zip(cuts, cuts[1:], strict=False):
            held.append(batch.slice(begin, end - begin))
            if end < len(batch):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def block_pairs(members: DataFrame, group: str, member: str, most: int) -> DataFrame:
    """``members`` with a column ``block``, so that any two members of a group meet in some block of at most 2 x ``most`` rows.

    A group of more than ``most`` members is dealt into parts by hash, and every pair of parts is a block: the work of one group is
    spread over as many tasks.  A row goes to as many blocks as its group has parts.
    """
    sizes = members.groupBy(group).agg(F.count("*").alias("_size")).where("_size > 1")
    dealt = members.join(sizes, group).withColumn("_parts", F.ceil(F.col("_size") / most).cast("int"))
    return in_blocks(dealt, group, member, "_parts").drop("_size", "_parts")


def in_blocks(members: DataFrame, group: str, member: str, parts: str) -> DataFrame:
    """``members`` with a column ``block``, a row for each pair of its group's ``parts`` that has the member's own."""
    dealt = members.withColumn("_part", F.pmod(F.xxhash64(member), F.col(parts)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    pair = (F.least("_part", "_other"), F.greatest("_part", "_other"))
    return dealt.withColumn("_other", other).withColumn("block", F.xxhash64(group, *pair)).drop("_part", "_other")


def each_block(rows: DataFrame, run: Callable[[pa.Table], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """``run`` on the rows of every block; it returns the columns of its results.

    Blocks whose hashes agree are seen as one, so ``run`` must not take for granted that its rows belong together.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def all_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches):
            found = run(table)
            if len(found[names[0]]):
                yield pa.RecordBatch.from_arrays([pa.array(found[n]) for n in names], names)

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(all_runs, schema)


def binary_views(column: pa.ChunkedArray, dtype: str) -> list[np.ndarray]:
    """A binary column's values as numpy arrays."""
    return [np.frombuffer(x.as_py(), dtype) for x in column]


def forest(n: int, left: np.ndarray, right: np.ndarray) -> Pairs:
    """A few of the pairs that connect what all of them connect."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def overlaps(sets: list[np.ndarray], weights: list[np.ndarray] | None = None, columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections: the product of the incidence matrix with its transpose, by blocks of columns.

    With ``weights``, one for each element, entry (i, j) adds up set i's weights of what it shares with set j.  Only elements in
    two sets or more become columns; no block has sums too large for a float to count exactly.
    """
    m = len(sets)
    total = np.zeros((m, m), np.int32)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    flat = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    value = np.concatenate(weights).astype(np.float32) if weights else np.ones(len(flat), np.float32)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    code = code.reshape(-1)
    shared = count > 1
    n = int(shared.sum())
    number, use = np.cumsum(shared) - 1, shared[code]
    row, code, value = row[use], number[code[use]], value[use]
    order = np.argsort(code, kind="stable")
    row, code, value = row[order], code[order], value[order]
    for begin in range(0, n, columns):
        a, b = np.searchsorted(code, (begin, begin + columns))
        part = np.zeros((m, min(columns, n - begin)), np.float32)
        part[row[a:b], code[a:b] - begin] = value[a:b]
        total += (part @ ((part > 0).astype(np.float32) if weights else part).T).astype(np.int32)
    return total
