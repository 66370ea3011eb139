"""Connected components of a graph given as edges, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node, component`` for every node with an edge: the smallest node it can reach.

    ``edges`` has columns ``a, b``.  Alternating star contraction: every node's larger neighbours are tied to the smallest node
    it sees, then its smaller ones, until all components are stars; the rounds grow with the logarithm of the longest path.
    Smallest neighbours come from aggregates that combine before the shuffle, and are written before edges are joined to
    them, so that a node with very many edges can be split between tasks.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    pairs = stored(pairs, "edges")
    for _ in range(most_rounds):
        if _stars(pairs):
            break
        both = pairs.union(pairs.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")), "low")
        large = both.join(least, "a").where("b > a").select(F.col("low").alias("a"), "b")
        large = stored(large.where("a < b").distinct(), "edges")
        least = stored(large.groupBy("b").agg(F.min("a").alias("low")), "low")
        tied = large.join(least, "b").select(F.explode(F.array("a", "b")).alias("b"), F.col("low").alias("a")).where("a < b")
        pairs = stored(tied.select("a", "b").distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)


def _stars(pairs: DataFrame) -> bool:
    """Whether every larger node is tied to one smaller node, and that to none."""
    total, larger = pairs.agg(F.count("*"), F.countDistinct("b")).first()
    return total == larger and pairs.join(pairs.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()
