"""Merkle tree over a dataset: a digest per row, a tree per source, a tree over the sources, and every row's proof.

Nodes are labelled with nested intervals.  All rows are ranked once, by source and id; a leaf covers its own rank, a node the
ranks of the leaves beneath it, a source's tree those of the source.  A node's bucket at a level is its place there divided
by the fan-out, so ``(tree, bucket)`` finds the few nodes among which its parent is, and the parent is the one whose interval
contains the node's.  What is left of the parent's interval before and after the node's own names its siblings.

Trees are built upwards one level at a time, all sources together, and the siblings' digests are handed down again in the
same way; a level has a sixteenth of the rows of the one below, and no key of any shuffle has more than ``fan_out`` rows,
however large a source is.  Only digests are shuffled, never texts.  The ranks come from a range partitioning: a row's place in
its partition plus the rows of the partitions before it, whose counts, one number for each partition, go through the
driver.

Defined results: a null in any column is ``-`` in its row's digest; rows of a null source form the first tree; rows of a
source whose ids are null come first in it; rows that agree in source and id are ordered by their digests, so equal rows are
interchangeable leaves; an empty table gives no rows and has no root; columns that are not named are not read.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sent_if_small, stored

FAN_OUT = 16
#: The columns that make up a leaf.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*values: Column) -> Column:
    """Hexadecimal sha256 of texts put end to end."""
    return F.sha2(F.concat(*values).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """A row's digest, with other values for some columns."""
    return digest_of(*(encoded(changed.get(c, F.col(f"`{c}`"))) for c in COLUMNS))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, source, leaf, claimed``: ``claimed`` is the digest of the row as ``tampered`` shows its text, null where the
    text is as it was (``tampered`` null)."""
    claimed = F.when(tampered.isNotNull(), leaf(text=tampered)) if tampered is not None else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf().alias("leaf"), claimed.alias("claimed"))


def placed(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``rows`` with their places ``rank``, from 0 on, in an order over all partitions."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # partition number and place in it, in one long
    held = stored(dealt.withColumn("_place", F.monotonically_increasing_id()), label)
    part = F.shiftright("_place", 33).alias("_part")
    total, before = 0, []
    for r in sorted(held.groupBy(part).agg(F.count("*")).collect()):  # one row for each partition
        before.append((r[0], total))
        total += r[1]
    offsets = F.broadcast(rows.sparkSession.createDataFrame(before, "_part long, _before long"))
    rank = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return held.withColumn("_part", part).join(offsets, "_part").withColumn("rank", rank).drop("_part", "_place", "_before")


def few(frame: DataFrame, rows: float, each: int = 5_000) -> DataFrame:
    """A frame of so many rows, to be worked out by a task for each ``each`` of them: levels shrink, their files shall not."""
    return frame.coalesce(max(1, -(-int(rows) // each)))


class Forest(NamedTuple):
    """The nodes above the leaves: ``families[k]`` has a row for every node of level k + 1, with its children.

    Columns: ``tree, tree_hi, lo, hi, digest, children``; a child is ``lo, hi, digest`` and, at the first level, what the leaves carry.
    ``sizes`` has the number of nodes of each level, or a little more.
    """

    families: list[DataFrame]
    roots: DataFrame
    sizes: list[int]


def levels_above(n: int, fan_out: int) -> int:
    """Levels above n leaves; a lone leaf is its own root and also the only child of a node that repeats it."""
    levels, width = 1, fan_out
    while width < n:
        levels, width = levels + 1, width * fan_out
    return levels


def bucket(level: int, fan_out: int) -> Column:
    """Place of a node, or of its ancestor, among the nodes of a level of its tree."""
    return F.expr(f"(rank - tree) div {fan_out**level}")


def grow(nodes: DataFrame, longest: int, leaf_count: int, trees: int, fan_out: int, label: str) -> Forest:
    """Trees over leaves ``tree, tree_hi, rank, lo, hi, digest`` (and more, kept in the first level's children).

    ``rank`` counts a tree's leaves from ``tree`` on, ``tree_hi`` is the rank after its last one; ``lo`` and ``hi`` are the interval that
    a leaf covers, which for a tree over trees is that of a whole tree.  ``longest`` is the most leaves that a tree has.
    """
    families, roots, sizes = [], [], []
    own = [c for c in nodes.columns if c not in ("tree", "tree_hi", "rank", "lo", "hi", "digest")]
    for level in range(1, levels_above(longest, fan_out) + 1):
        kin = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest", "rank", *own))).alias("children")
        joined = nodes.withColumn("bucket", bucket(level, fan_out)).groupBy("tree", "tree_hi", "bucket").agg(kin)
        digests = F.col("children.digest")
        lone = F.col("tree_hi") - F.col("tree") == 1
        made = joined.select(
            "tree", "tree_hi", F.col("children")[0]["rank"].alias("rank"), F.col("children")[0]["lo"].alias("lo"),
            F.element_at("children", -1)["hi"].alias("hi"), F.when(lone, digests[0]).otherwise(digest_of(F.array_join(digests, ""))).alias("digest"), "children",
        )
        # every tree has at most one node that is not full; a family is as large as all its children
        sizes.append(leaf_count // fan_out**level + trees)
        families.append(stored(few(made, sizes[-1]), f"{label}-{level}"))
        # trees that end at this level have one node, and the others go on
        size = F.col("tree_hi") - F.col("tree")
        tops = families[-1].drop("children")
        roots.append(tops.where(size <= fan_out**level))
        nodes, own = tops.where(size > fan_out**level), []
    return Forest(families, reduce(DataFrame.unionByName, roots), sizes)


def siblings(child: Column, parent_lo: Column, parent_hi: Column, kin: Column) -> Column:
    """Digests of the nodes in what is left of the parent's interval ahead of the child's own and behind it."""
    digests = lambda inside: F.array_join(F.transform(F.filter(kin, inside), lambda x: x["digest"]), "")
    return F.struct(
        digests(lambda x: (x["lo"] >= parent_lo) & (x["hi"] <= child["lo"])).alias("before"),
        digests(lambda x: (x["lo"] >= child["hi"]) & (x["hi"] <= parent_hi)).alias("after"),
    )


def hand_down(forest: Forest, above: DataFrame, fan_out: int) -> DataFrame:
    """The leaves of all trees with ``path``, the siblings at every level from the leaf's own up to the last root.

    ``above`` has the paths of the trees themselves (``tree, path`` and more columns, which the leaves get too).
    """
    more = [c for c in above.columns if c not in ("tree", "path")]
    size = F.col("tree_hi") - F.col("tree")
    known: DataFrame | None = None
    for level in range(len(forest.families), 0, -1):
        family = forest.families[level - 1]
        # a node at the top of its tree continues the tree's path; any other the path of the node that contains it
        tops = family.where(size <= fan_out**level).join(sent_if_small(above), "tree")
        if known is None:
            attached = tops
        else:
            inner = family.where(size > fan_out**level).withColumn("bucket", bucket(level + 1, fan_out))
            parent = known.withColumn("bucket", bucket(level + 1, fan_out)).select(
                F.col("tree").alias("p_tree"), F.col("bucket").alias("p_bucket"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"),
                F.col("children").alias("kin"), F.col("path").alias("p_path"), *more,
            )
            inside = (F.col("lo") >= F.col("p_lo")) & (F.col("hi") <= F.col("p_hi"))
            met = inner.join(parent, (F.col("tree") == F.col("p_tree")) & (F.col("bucket") == F.col("p_bucket")) & inside)
            step = siblings(F.struct("lo", "hi"), F.col("p_lo"), F.col("p_hi"), F.col("kin"))
            path = F.concat(F.array(step), F.col("p_path")).alias("path")
            attached = tops.unionByName(met.select(*family.columns, path, *more))
        known = stored(few(attached, forest.sizes[level - 1]), f"paths-{level}") if level > 1 else attached
    each = known.select("tree", "tree_hi", F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), "children", "path", *more, F.explode("children").alias("child"))
    own = F.array(siblings(F.col("child"), F.col("p_lo"), F.col("p_hi"), F.col("children")))
    # a lone leaf is its tree's root, so no step leads from it to the root
    path = F.when(size == 1, F.col("path")).otherwise(F.concat(own, "path")).alias("path")
    return each.select("tree", "child.*", path, *more)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest gives with the siblings of its path."""
    return F.aggregate(path, digest, lambda held, step: digest_of(step["before"], held, step["after"]))


def proof(path: Column) -> Column:
    """All siblings of a path, from left to right and from the leaf to the root."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def manifest(docs: DataFrame, tampered: Column | None = None, fan_out: int = FAN_OUT) -> DataFrame:
    """``doc_id, source, leaf, subroot, root, path, claimed``: every row's digest, those of its source and of the dataset, and its
    proof, a list of the siblings' digests ``before`` and ``after`` at every level."""
    spark = docs.sparkSession
    first = F.asc_nulls_first
    # stored, as the bounds of a range partitioning come from a look at its whole input
    rows = placed(stored(leaves(docs, tampered), "digests"), [first("source"), first("doc_id"), first("leaf"), first("claimed")], "leaves")
    per_source = rows.groupBy("source").agg(F.min("rank").alias("tree"), (F.max("rank") + 1).alias("tree_hi"))
    per_source = stored(per_source.withColumnRenamed("source", "_source"), "sources")
    longest, sources, total = per_source.agg(F.max(F.col("tree_hi") - F.col("tree")), F.count("*"), F.max("tree_hi")).first()
    if not sources:
        path = "array<struct<before: string, after: string>>"
        return spark.createDataFrame([], f"doc_id long, leaf string, subroot string, root string, path {path}, claimed string")
    held = rows.join(sent_if_small(per_source), F.col("source").eqNullSafe(F.col("_source")))
    interval = [F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi")]
    trees = grow(held.select("tree", "tree_hi", "rank", *interval, F.col("leaf").alias("digest"), "doc_id", "claimed"), longest, total, sources, fan_out, "nodes")
    # sources are ordered as their intervals are; each interval is a leaf of the tree over the sources
    tops = placed(few(trees.roots.select(F.col("tree").alias("lo"), F.col("tree_hi").alias("hi"), "digest"), sources), [F.asc("lo")], "roots")
    above = grow(tops.select(F.lit(0).cast("long").alias("tree"), F.lit(sources).cast("long").alias("tree_hi"), "rank", "lo", "hi", "digest"), sources, sources, 1, fan_out, "top")
    root = above.roots.first().digest
    begin = spark.createDataFrame([(0, [], root)], "tree long, path array<struct<before: string, after: string>>, root string")
    over = hand_down(above, begin, fan_out).select(F.col("lo").alias("tree"), F.col("digest").alias("subroot"), "path", "root")
    out = hand_down(trees, stored(few(over, sources), "over"), fan_out)
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", "claimed")


def lowered(text: Column) -> Column:
    """A to Z as a to z, and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def verification(rows: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` from a manifest: the root that each row's proof gives
    for the row as it is claimed to be."""
    folded = rows.withColumn("folded_root", fold(F.coalesce("claimed", "leaf"), F.col("path")))
    check = (F.col("folded_root") == F.col("root")).alias("verified")
    return folded.select("doc_id", "leaf", "subroot", "root", digest_of(proof(F.col("path"))).alias("proof_sha256"), "folded_root", check)
