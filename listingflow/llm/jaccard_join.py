"""Near duplicates by exact Jaccard similarity of word n-grams: a blocked sparse matrix product with size-derived bounds.

A document is the set of its distinct n-grams.  Two link when 100 x common >= percent x all.  The product of the document by
n-gram incidence matrix with its transpose would give all overlaps; it is taken in blocks that hold every pair that can link:

1. Documents with the same set are one row of the matrix.
2. All sets are put in one order, n-grams that a sample shows to be frequent last.  Two sets can link only if they share one of
   the first n - ceil(percent x n) + 1 of their n elements.  The rows that share such an element form a block with the one among
   them of the lowest hash, their centre; so any two rows that share an element meet in a block, and a row is sent
   to few blocks, because the elements of similar rows have the same centre.
3. A block counts the overlaps in the elements of its centre, adds what the two rows can share in other blocks at most, and
   discards pairs whose sizes allow no link at that sum.  What remains ties rows to families.
4. Only rows of families are read again; the product of their whole sets, block by block, gives exact overlaps and so the links.

A block hands on no more pairs than connect its rows, so the links within a group of thousands never leave it one by one.
Groups of more than ``block_rows`` rows are cut into parts of which every two meet.

Defined results: a null, empty or wordless text has an empty set and links with nothing; a text of fewer words than n has one
element, its whole sequence of words; rows with a null id link with nothing and have a null component; rows that share an id
are one document, whose texts are each a set; repeated rows give repeated results; other columns are not read; an empty
table gives an empty result.  Elements are 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import binary_views, block_pairs, each_block, forest, in_blocks, overlaps
from .common import id_and_text, released, sent_if_small, stored
from .components import components
from .words import shingle_hashes, text_slices, words_of


def element_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words = words_of(texts, lower=True)
    grams = {w: shingle_hashes(words.hashes, w) for w in range(1, n + 1)}
    for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        width = min(n, end - begin)
        yield np.unique(grams[width][begin : end - width + 1]) if width else np.zeros(0, np.uint64)


def prefix_length(sizes: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Elements of which two linked sets share one at least: no partner lacks more than size - ceil(percent x size / 100)."""
    return sizes - (-(-percent * sizes // 100)) + 1


def can_link(common: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets with these overlaps reach the threshold: (100 + percent) x common >= percent x both sizes."""
    return (100 + percent) * common.astype(np.int64) >= percent * (sizes[:, None] + sizes)


def frequent_elements(docs: DataFrame, n: int, share: int = 16, least: int = 6, most: int = 500_000) -> np.ndarray:
    """Elements found in ``least`` or more of one in ``share`` documents, ascending by count and then hash.

    They only set the order of elements, never what is compared.  ``most`` bounds what is sent to every task (8 bytes each).
    """
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).where("text is not null").dropDuplicates(["text"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_slices(batch):
                found = np.concatenate([*element_sets(texts, n), np.zeros(0, np.uint64)])
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["element"])

    counts = some.select("text").mapInArrow(run, "element long").groupBy("element").agg(F.count("*").alias("n"))
    top = counts.where(F.col("n") >= least).orderBy(F.col("n").desc(), "element").limit(most).toArrow()
    order = np.lexsort([top.column("element").to_numpy(), top.column("n").to_numpy()])
    return top.column("element").to_numpy().view(np.uint64)[order]


def _described(docs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """``doc_id, size, key, prefix``: set size, digest of the set, its first elements in the common order."""
    by_hash = np.argsort(frequent)
    sent = docs.sparkSession.sparkContext.broadcast((frequent[by_hash], by_hash))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = sent.value
        for batch in released(batches):
            for row, texts in text_slices(batch):
                size, key, prefix = [], [], []
                for found in element_sets(texts, n):
                    size.append(len(found))
                    key.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    take = prefix_length(len(found), percent) if len(found) else 0
                    if len(known) and take:
                        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                        late = known[at] == found
                        rare = found[~late][:take]
                        last = found[late][np.argsort(rank[at[late]])][: take - len(rare)]
                        prefix.append(np.concatenate([rare, last]).tobytes())
                    else:
                        prefix.append(found[:take].tobytes())
                ids = batch.column("doc_id").slice(row, len(texts))
                columns = [ids, pa.array(size, pa.int64()), pa.array(key, pa.binary()), pa.array(prefix, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "key", "prefix"])

    return docs.mapInArrow(run, "doc_id long, size long, key binary, prefix binary")


def _postings(rows: DataFrame) -> DataFrame:
    """``element, rep`` of every first element of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(p.as_py(), np.int64) for p in batch.column("prefix")]
            rep = np.repeat(batch.column("rep").to_numpy(), [len(p) for p in found])
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(rep)], ["element", "rep"])

    return rows.select("rep", "prefix").mapInArrow(run, "element long, rep long")


STARS = "centre long, rep long, size long, behind long, elements binary, centres binary, weights binary"


def _candidate_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """``STARS`` and ``block``: any two rows that share a first element are together in the block of that element's centre.

    A row comes with its elements of this centre and, for its other centres, the number of its elements that they have.
    """
    postings = _postings(rows)
    rank = F.xxhash64("rep")
    centres = postings.groupBy("element").agg(F.min(rank).alias("centre"), F.count("*").alias("n"))
    shared = postings.join(centres.where("n > 1").select("element", "centre"), "element")
    by_row = shared.groupBy("rep").agg(F.collect_list(F.struct("centre", "element")).alias("found"))
    # as many as the row has first elements, at most
    by_row = by_row.select("rep", F.col("found.centre").alias("centres"), F.col("found.element").alias("elements"))
    sizes = rows.select("rep", "size", (F.col("size") - F.length("prefix") / 8).cast("long").alias("behind"))

    def stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(7)]
            lists = (batch.column(c).to_pylist() for c in ("rep", "size", "behind", "centres", "elements"))
            for rep, size, behind, centres, elements in zip(*lists, strict=True):
                order = np.argsort(centres, kind="stable")
                names, first, count = np.unique(np.array(centres)[order], return_index=True, return_counts=True)
                elements = np.array(elements)[order]
                for i, (name, begin, n) in enumerate(zip(names.tolist(), first.tolist(), count.tolist(), strict=True)):
                    others = np.delete(names, i).tobytes(), np.delete(count, i).astype("<i4").tobytes()
                    for column, value in zip(out, (name, rep, size, behind, elements[begin : begin + n].tobytes(), *others), strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 4 + [pa.binary()] * 3
            names = [c.split()[0] for c in STARS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    found = stored(by_row.join(sizes, "rep").mapInArrow(stars, STARS), "stars")
    return block_pairs(found, "centre", "rep", block_rows)


def _edges(table: pa.Table, linked: np.ndarray) -> dict[str, np.ndarray]:
    """A few of the linked pairs that connect what all of them connect."""
    reps = table.column("rep").to_numpy()
    left, right = np.nonzero(np.triu(linked, 1))
    pairs = np.array(forest(len(reps), left, right), np.int64).reshape(-1, 2)
    return {"a": reps[pairs[:, 0]], "b": reps[pairs[:, 1]]}


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 80, block_rows: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: set size, and the smallest id that links reach."""
    docs = id_and_text(docs, id_col, text_col)
    seen = stored(_described(docs, n, percent, frequent_elements(docs, n)), "element-sets")
    named = seen.where("doc_id is not null and size > 0")
    rows = stored(named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("prefix").alias("prefix")), "rows")

    def survivors(table: pa.Table) -> dict[str, np.ndarray]:
        size, behind = table.column("size").to_numpy(), table.column("behind").to_numpy()
        common = overlaps(binary_views(table.column("elements"), np.int64))
        # in other blocks two rows can share no more than either has there of centres that both have
        weights = binary_views(table.column("weights"), "<i4")
        elsewhere = overlaps(binary_views(table.column("centres"), np.int64), weights) if any(map(len, weights)) else 0 * common
        first = common + np.minimum(elsewhere, elsewhere.T)
        # what stands behind both first parts can add no more than the longer rest, nor than the smaller set allows
        most = np.minimum(first + np.maximum(behind[:, None], behind), np.minimum(size[:, None], size))
        return _edges(table, (common > 0) & can_link(most, size, percent))

    ties = each_block(_candidate_blocks(rows, block_rows), survivors, "a long, b long")
    families = stored(components(ties), "families")
    # the same rows again, with whole sets
    wanted = rows.join(families.withColumnRenamed("node", "rep"), "rep").select("key", "rep", "component")
    sources = seen.join(wanted, "key").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("rep").alias("rep"), F.first("component").alias("family"))
    sources = stored(sources.select("doc_id", "key", "rep", "family"), "families-rows")
    # a row carries the number of parts of its family; which blocks that means is worked out where the sets are
    parts = sources.groupBy("family").agg(F.ceil(F.countDistinct("rep") / block_rows).cast("int").alias("parts"))
    sources = stored(sources.join(parts, "family").select("doc_id", "key", "rep", "family", "parts"), "wanted")
    few = sources.count() <= 1_000_000  # some 80 bytes a row: a table that may be sent to every task; beyond, texts are shuffled
    texts = docs.join(F.broadcast(sources) if few else sources, "doc_id").select("rep", "family", "parts", "key", "text")

    def whole_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for row, some in text_slices(batch):
                keys = batch.column("key").slice(row, len(some)).to_pylist()
                sets = [s.tobytes() for s in element_sets(some, n)]
                # an id may have several texts: only the one that was asked for
                own = [hashlib.blake2b(s, digest_size=16).digest() == k for s, k in zip(sets, keys, strict=True)]
                part = [batch.column(c).slice(row, len(some)).filter(pa.array(own)) for c in ("rep", "family", "parts")]
                kept = pa.array([s for s, ok in zip(sets, own, strict=True) if ok], pa.binary())
                yield pa.RecordBatch.from_arrays([*part, kept], ["rep", "family", "parts", "elements"])

    sets = texts.mapInArrow(whole_sets, "rep long, family long, parts int, elements binary")
    sets = in_blocks(sets, "family", "rep", "parts").select("rep", "block", "elements")

    def links(table: pa.Table) -> dict[str, np.ndarray]:
        sets = binary_views(table.column("elements"), np.uint64)
        size = np.array([len(s) for s in sets])
        return _edges(table, can_link(overlaps(sets), size, percent))

    found = stored(components(each_block(sets, links, "a long, b long")), "classes")
    classes = rows.select("key", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    classes = stored(classes.select("key", F.coalesce("component", "rep").alias("component")), "set-classes")
    # both sides are read from files, so a set that very many rows have can be split between tasks
    out = seen.select("doc_id", "size", "key").join(classes, "key", "left")
    own = F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return out.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))


def keep_one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id is the smallest of their group of near duplicates.

    Rows with a null id all stay; of rows that agree in id, those stay or go together.
    """
    found = near_duplicates(docs, n, percent, id_col=id_col, text_col=text_col)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone__")).distinct()
    gone = stored(gone, "near-duplicates")
    return docs.join(sent_if_small(gone, 2_000_000), F.col(f"`{id_col}`").cast("long") == F.col("__gone__"), "left_anti")
