"""Near-duplicate vectors by cosine, found through an inverted multi-index.

Vectors with the same label and components are one vector with a weight.  Each of the others is normalised and cut into two
halves; each half has its own codebook, fitted on a bounded sample, and the pairs of codewords are the cells of a grid.  Every
vector is filed in the cell of its nearest codewords and looks for partners in the cells nearest to it, in the order of
the sum of both distances (multi-sequence traversal).  How many cells are visited is found by brute force: a bounded set of
query vectors, enlarged where few of them have partners, is compared with all vectors, and the traversal goes on until
``target_recall`` of the pairs found are reached from either side, on average over pairs, queries and groups of near copies.
What is found is verified in double precision.

Only vectors with the same label and length meet; each length has its own grid, and vectors of a length that at most
``block_rows`` have are all compared with each other.  A cell with many vectors is cut into parts, and so are those that visit it, so no task
sees more than a bounded part of a hot label, cell or source.

Defined results: a vector that is null, empty, zero or has null or non-finite components, or has a null label or id, links with
nothing; repeated rows are vectors of their own with cosine 1; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_pairs, each_block, runs
from .common import ship_code, stored
from .components import components

VECTORS = "rep long, label long, weight long, vector binary"


class Grid(NamedTuple):
    """A codebook for each half of a vector; ``visits`` cells are searched for each vector."""

    left: np.ndarray
    right: np.ndarray
    visits: int

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        parts = ((vectors[:, :half], self.left), (vectors[:, half:], self.right))
        left, right = ((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1) for x, book in parts)
        return left, right

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        left, right = self.distances(vectors)
        return left.argmin(1) * len(self.right) + right.argmin(1)

    def nearest(self, vectors: np.ndarray, visits: int) -> np.ndarray:
        """The first cells of the traversal, nearest first, one row for each vector.

        The cell of the i-th and j-th nearest codewords comes after (i + 1) x (j + 1) - 1 others at least, so only cells with that
        below ``visits`` are weighed.
        """
        columns = [min(len(self.right), max(visits, 1) // (k + 1)) for k in range(min(len(self.left), max(visits, 1)))]
        i, j = np.repeat(np.arange(len(columns)), columns), np.concatenate([np.arange(n) for n in columns])
        # a bounded number of sums at a time
        step, out = max(1, (1 << 21) // len(i)), []
        for begin in range(0, max(len(vectors), 1), step):
            left, right = self.distances(vectors[begin : begin + step])
            by_left, by_right = np.argsort(left, 1, kind="stable"), np.argsort(right, 1, kind="stable")
            total = np.take_along_axis(left, by_left[:, i], 1) + np.take_along_axis(right, by_right[:, j], 1)
            order = np.argsort(total, 1, kind="stable")[:, :visits]
            out.append(np.take_along_axis(by_left[:, i] * len(self.right) + by_right[:, j], order, 1))
        return np.concatenate(out)


def _codebook(points: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """Means of ``size`` clusters of points (Lloyd's iterations from evenly spread points)."""
    book = points[np.linspace(0, len(points) - 1, min(size, len(points))).astype(int)]
    for _ in range(rounds):
        near = ((book * book).sum(1) - 2 * points @ book.T).argmin(1)
        count = np.bincount(near, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, near, points)
        book = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], book)
    return book


def _unit(column: pa.Array | pa.ChunkedArray, dtype: str) -> np.ndarray:
    """Vectors of a binary column as unit vectors in double precision."""
    rows = np.frombuffer(b"".join(column.to_pylist()), dtype).astype(np.float64)
    rows = rows.reshape(len(column), -1) if len(column) else rows.reshape(0, 0)
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def _prepared(table: DataFrame, id_col: str, vector_col: str, label_col: str, dtype: str) -> DataFrame:
    """``vec_id, label, vector, key``; vector and key are null where a row can link with nothing."""
    ship_code(table.sparkSession)
    chosen = table.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<float>" if dtype == "<f4" else "array<double>").alias("vector"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in zip(batch.column("vec_id"), batch.column("label"), batch.column("vector"), strict=True):
                usable = all(x.is_valid for x in row) and len(row[2]) and not row[2].values.null_count
                x = row[2].values.to_numpy().astype(dtype) if usable else np.zeros(1)
                norm = np.sqrt((x.astype(np.float64) ** 2).sum())
                out.append(x.tobytes() if usable and np.isfinite(norm) and norm > 0 else None)
            keys = [
                None if x is None else hashlib.blake2b(x, digest_size=16, salt=n.to_bytes(8, "little", signed=True)).digest()
                for n, x in zip(batch.column("label").fill_null(0).to_pylist(), out, strict=True)
            ]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "key"])

    return chosen.mapInArrow(run, "vec_id long, label long, vector binary, key binary")


class Ranks(NamedTuple):
    """``n`` pairs of a query that are found from one of their two sides at the ``rank``-th cell visited, counted from 0."""

    query: np.ndarray
    rank: np.ndarray
    n: np.ndarray

    def of(self, chosen: np.ndarray) -> Ranks:
        return Ranks(*(x[chosen] for x in self))

    def needed(self, shares: np.ndarray, target: float) -> int:
        """Visits at which ``target`` is reached per pair, per query and per group.

        Pairs alone would let one large group of near copies speak for all rows, and queries alone one with many rows.
        """
        if not len(self.n):
            return 1
        recall = self.n / np.bincount(self.query, self.n)[self.query]
        reached = (np.cumsum(np.bincount(self.rank, w)) / w.sum() for w in (self.n, recall, recall * shares[self.query]))
        return max(int(np.searchsorted(m, target - 1e-12)) + 1 for m in reached)


def _found(vectors: DataFrame, queries: pa.Table, grid: Grid, dtype: str, cosine: float, most: int) -> Ranks:
    """How early the pairs of queries with any vector are found; the rank ``most`` stands for those that many visits don't find."""
    labels, reps = queries.column("label").to_numpy(), queries.column("rep").to_numpy()
    units = _unit(queries.column("vector"), dtype)
    orders, homes = grid.nearest(units, most).astype(np.int32), grid.cells(units)
    step, pairs = max(1, (1 << 21) // max(len(units), 1)), max(1, (1 << 22) // most)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(begin, step) for b in batches for begin in range(0, len(b), step)):
            x = _unit(part.column("vector"), dtype)
            close = (x @ units.T >= cosine) & (part.column("label").to_numpy()[:, None] == labels) & (part.column("rep").to_numpy()[:, None] != reps)
            own = np.flatnonzero(close.any(1))
            row, query = np.nonzero(close[own])
            cells, visited = grid.cells(x[own]), grid.nearest(x[own], most)
            ranks = [np.zeros(0, np.int64)]
            for begin in range(0, len(row), pairs):
                r, q = row[begin : begin + pairs], query[begin : begin + pairs]
                there, back = orders[q] == cells[r][:, None], visited[r] == homes[q][:, None]
                ranks.append(np.minimum(*(np.where(found.any(1), found.argmax(1), most) for found in (there, back))))
            values, counts = np.unique(query * (most + 1) + np.concatenate(ranks), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], ["rank", "n"])

    found = vectors.mapInArrow(run, "rank long, n long").groupBy("rank").agg(F.sum("n").alias("n")).toArrow()
    query, rank = np.divmod(found.column("rank").to_numpy(), most + 1)
    return Ranks(query, rank, found.column("n").to_numpy())


def _planted(units: np.ndarray, grid: Grid, cosine: float, target: float, most: int) -> int:
    """Visits, ``most`` or more, that find ``target`` of partners made up for unit vectors.

    Each is at ``cosine``, the farthest a partner can be, on the way to another of the vectors.
    """
    away = np.roll(units, 1, 0)
    away = away - (away * units).sum(1)[:, None] * units
    length = np.sqrt((away * away).sum(1))
    units, away = units[length > 1e-6], away[length > 1e-6] / length[length > 1e-6][:, None]
    near = cosine * units + max(0.0, 1 - cosine * cosine) ** 0.5 * away
    late, least, cells = np.arange(len(units)), most, len(grid.left) * len(grid.right)
    allowed = int((1 - target) * len(units))
    while len(late):
        sides = ((units[late], near[late]), (near[late], units[late]))
        found = [grid.nearest(x, most) == grid.cells(y)[:, None] for x, y in sides]
        rank = np.minimum(*(np.where(f.any(1), f.argmax(1), most) for f in found))
        if (rank == most).sum() <= allowed:
            return max(least, int(np.sort(rank)[len(rank) - 1 - allowed]) + 1)
        late, most = late[rank == most], min(4 * most, cells)
    return least


def _group_shares(queries: pa.Table, dtype: str, cosine: float) -> np.ndarray:
    """One over the number of queries that are near a query, itself included: queries of one tight group add up to one."""
    labels, units = queries.column("label").to_numpy(), _unit(queries.column("vector"), dtype)
    near = [
        ((units[i : i + 512] @ units.T >= cosine) & (labels[i : i + 512][:, None] == labels)).sum(1) for i in range(0, len(units), 512)
    ]
    return 1 / np.maximum(np.concatenate(near), 1)


def fit_grid(
    vectors: DataFrame,
    dtype: str,
    cosine: float,
    target_recall: float,
    sample_rows: int,
    query_rows: int,
    most_visits: int,
    least_groups: int = 256,
) -> Grid:
    """Codebooks from at most ``sample_rows`` vectors, visits from ``query_rows`` or more of them against all vectors.

    The number of codewords grows with the square root of the largest label's count, so that a cell's share of a label stays
    small, up to an eighth of the sample.  Queries are added, up to the whole sample, until they have partners in
    ``least_groups`` groups; where the sample is not the whole table and still has fewer, partners are made up for it and no
    less than ``most_visits`` cells are visited.  ``most_visits`` are tried at first, and more, up to the whole grid, until
    ``target_recall`` is reached.
    """
    largest = vectors.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    sample = vectors.orderBy(F.xxhash64("rep", F.lit(7)), "rep").limit(sample_rows).toArrow()
    units = _unit(sample.column("vector"), dtype)
    size = int(np.clip(round((largest / 24) ** 0.5), 4, max(4, sample_rows // 8)))
    half = units.shape[1] // 2
    grid = Grid(_codebook(units[:, :half], size), _codebook(units[:, half:], size), 0)
    cells = len(grid.left) * len(grid.right)
    most = min(most_visits, cells)
    rows = min(query_rows, len(sample))
    while True:
        queries = sample.slice(0, rows)
        found, shares = _found(vectors, queries, grid, dtype, cosine, most), _group_shares(queries, dtype, cosine)
        enough = shares[np.unique(found.query)].sum() >= least_groups
        if enough or rows == len(sample):
            break
        rows = min(4 * rows, len(sample))
    visits = 1 if enough or len(sample) < sample_rows else _planted(units[:512], grid, cosine, target_recall, most)
    while (needed := found.needed(shares, target_recall)) > most:
        # only queries with pairs that were not found are compared again
        late = np.unique(found.query[found.rank == most])
        most = min(4 * most, cells)
        again = _found(vectors, queries.take(late), grid, dtype, cosine, most)
        known = found.of(~np.isin(found.query, late))
        found = Ranks(*map(np.concatenate, zip(known, again._replace(query=late[again.query]), strict=True)))
    return grid._replace(visits=max(visits, needed))


def near_vectors(
    table: DataFrame,
    cosine: float = 0.93,
    target_recall: float = 0.999,
    sample_rows: int = 8192,
    query_rows: int = 512,
    most_visits: int = 64,
    block_rows: int = 2048,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row: links found, smallest id they reach, whether it is the row's own."""
    single = dict(table.dtypes)[vector_col] == "array<float>"
    dtype = "<f4" if single else "<f8"
    rows = stored(_prepared(table, id_col, vector_col, label_col, dtype), "vectors")
    groups = rows.where("key is not null").groupBy("key")
    first = [F.min("vec_id").alias("rep"), F.first("label").alias("label"), F.count("*").alias("weight"), F.first("vector").alias("vector")]
    keyed = stored(groups.agg(*first), "distinct-vectors")
    vectors, width = keyed.select("rep", "label", "weight", "vector"), F.length("vector")
    large = [r["n"] for r in keyed.groupBy(width.alias("n")).count().where(F.col("count") > block_rows).orderBy("n").collect()]
    links = _all_links(vectors.where(~width.isin(large)), dtype, cosine, block_rows)
    for n in large:
        own = vectors.where(width == n)
        grid = fit_grid(own, dtype, cosine, target_recall, sample_rows, query_rows, most_visits)
        links = links.union(_links(own, grid, dtype, cosine, block_rows))
    links = stored(links, "links")
    found = components(links)
    each = links.select(F.col("a").alias("rep"), F.col("weight_b").alias("n"))
    each = each.union(links.select(F.col("b").alias("rep"), F.col("weight_a").alias("n")))
    others = each.groupBy("rep").agg(F.sum("n").alias("n"))
    known = keyed.select("key", "rep", "weight").join(others, "rep", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    linked = (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("linked")
    known = stored(known.select("key", linked, F.coalesce("component", "rep").alias("component")), "vector-classes")
    # both sides are read from files, so the partition of a vector that very many rows have can be split
    out = rows.select("vec_id", "key").join(known, "key", "left")
    component = F.coalesce("component", "vec_id").alias("component_id")
    kept = F.col("vec_id").eqNullSafe(F.coalesce("component", "vec_id")).alias("kept")
    return out.select("vec_id", F.coalesce("linked", F.lit(0)).alias("n_links"), component, kept)


def _all_links(vectors: DataFrame, dtype: str, cosine: float, block_rows: int) -> DataFrame:
    """``a, b, weight_a, weight_b`` of all pairs, for vectors of lengths that few have: those of one length are a block."""

    def compare(table: pa.Table) -> dict[str, np.ndarray]:
        length, label = table.column("width").to_numpy(), table.column("label").to_numpy()
        found = [(np.zeros(0, np.int64),) * 2]
        for n in np.unique(length):
            own = np.flatnonzero(length == n)
            unit = _unit(table.column("vector").take(pa.array(own)), dtype)
            x, y = np.nonzero(np.triu((unit @ unit.T >= cosine) & (label[own][:, None] == label[own]), 1))
            found.append((own[x], own[y]))
        x, y = map(np.concatenate, zip(*found, strict=True))
        rep, weight = table.column("rep").to_numpy(), table.column("weight").to_numpy()
        x, y = np.where(rep[x] < rep[y], x, y), np.where(rep[x] < rep[y], y, x)
        return {"a": rep[x], "b": rep[y], "weight_a": weight[x], "weight_b": weight[y]}

    dealt = block_pairs(vectors.withColumn("width", F.length("vector")), "width", "rep", block_rows)
    return each_block(dealt, compare, "a long, b long, weight_a long, weight_b long")


def _links(vectors: DataFrame, grid: Grid, dtype: str, cosine: float, block_rows: int) -> DataFrame:
    """``a, b, weight_a, weight_b`` of the pairs that the search finds, each once."""
    sent = vectors.sparkSession.sparkContext.broadcast(grid)

    def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 512):
                part = batch.slice(begin, 512)
                order = sent.value.nearest(_unit(part.column("vector"), dtype), sent.value.visits)
                visits = pa.array(order.tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, visits], [*part.schema.names, "visits"])

    filed = stored(vectors.mapInArrow(file, f"{VECTORS}, visits array<long>"), "filed")
    # the cell a vector is filed in is the first that it visits
    at_home = filed.select("rep", "label", F.col("visits")[0].alias("cell"), F.lit(0).alias("visitor"))
    visiting = filed.select("rep", "label", F.explode("visits").alias("cell"), F.lit(1).alias("visitor"))
    meeting = at_home.union(visiting)
    parts = meeting.groupBy("label", "cell").agg(
        F.ceil(F.sum(1 - F.col("visitor")) / block_rows).cast("int").alias("n_home"),
        F.ceil(F.sum("visitor") / (8 * block_rows)).cast("int").alias("n_visit"),
    ).where("n_home > 0")
    own = F.col("visitor") == 0
    mine, others = F.when(own, F.col("n_home")).otherwise(F.col("n_visit")), F.when(own, F.col("n_visit")).otherwise(F.col("n_home"))
    dealt = meeting.join(parts, ["label", "cell"]).select(
        "rep", "label", "cell", "visitor", F.pmod(F.xxhash64("rep"), mine).alias("part"), F.explode(F.sequence(F.lit(0), others - 1)).alias("other")
    )
    home, visit = F.when(own, F.col("part")).otherwise(F.col("other")), F.when(own, F.col("other")).otherwise(F.col("part"))
    dealt = stored(dealt.select("rep", "visitor", F.xxhash64("label", "cell", home, visit).alias("block")), "visits")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches):
            visitor, unit = table.column("visitor").to_numpy(), _unit(table.column("vector"), dtype)
            rep, label, weight = (table.column(c).to_numpy() for c in ("rep", "label", "weight"))
            home, guests = np.flatnonzero(visitor == 0), np.flatnonzero(visitor == 1)
            for begin in range(0, len(guests), 1024):
                some = guests[begin : begin + 1024]
                near = (unit[some] @ unit[home].T >= cosine) & (label[some][:, None] == label[home]) & (rep[some][:, None] != rep[home])
                x, y = np.nonzero(near)
                x, y = some[x], home[y]
                x, y = np.where(rep[x] < rep[y], x, y), np.where(rep[x] < rep[y], y, x)
                columns = [rep[x], rep[y], weight[x], weight[y]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "weight_a", "weight_b"])

    rows = dealt.join(vectors, "rep").repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(compare, "a long, b long, weight_a long, weight_b long").distinct()
