"""What each of several filters removes in every order of applying them, and its fair share of all that is removed.

A document's failing filters are a set of bits.  Documents are counted by part and set, the only work that grows with the
table; all else is arithmetic on the lattice of filter sets.  A state of the lattice is the set of filters applied so far,
an edge applies one more.  Forward counts say how many orders reach a state, backward counts how many leave it for the end,
so an edge lies in forward x backward orders.  The documents an edge removes are those that fail its filter and none of its
state's; weighted by the orders through it and summed over the edges of a filter they are the filter's Shapley value (times
the number of orders), and the steps of one order are the edges on its path.

Defined results: a null text is the empty text; a null part is the empty string; a document without a label is neither good
nor toxic, and one with several labels is good or toxic if any label says so; a null id has no label, repeats nothing and is
repeated by nothing; rows that agree in id and text are documents each, and neither repeats the other; an empty table gives
no rows; columns that are not named are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sent_if_small, stored

#: k filters have 2^k states, k * 3^(k - 1) pairs of a set and an edge that removes it, and k! orders.
MOST_FILTERS = 8


class Lattice:
    """States, edges and orders of some filters; state and set are sums of 2^(place of the filter)."""

    def __init__(self, letters: str):
        if not 0 < len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
            raise ValueError(f"1 to {MOST_FILTERS} different letters")
        self.letters, self.size = letters, len(letters)
        self.states = range(1 << self.size)
        self.edges = [(s, f) for s in self.states for f in range(self.size) if not s >> f & 1]
        # numbers of orders: a state has a larger number than every state on its paths from the empty one
        self.forward, self.backward = [1] + [0] * (len(self.states) - 1), [0] * (len(self.states) - 1) + [1]
        for s, f in self.edges:
            self.forward[s | 1 << f] += self.forward[s]
        for s, f in reversed(self.edges):
            self.backward[s] += self.backward[s | 1 << f]

    def weight(self, state: int, f: int) -> int:
        """How many orders take an edge."""
        return self.forward[state] * self.backward[state | 1 << f]

    def removals(self, spark: SparkSession) -> DataFrame:
        """For every set of failing filters the edges that remove a document with it."""
        rows = [(m, s, f, self.weight(s, f)) for s, f in self.edges for m in self.states if m >> f & 1 and not m & s]
        return spark.createDataFrame(rows, "failing int, state int, filter int, orders long")

    def survivals(self, spark: SparkSession) -> DataFrame:
        """For every set of failing filters the states that a document with it reaches."""
        return spark.createDataFrame([(m, s) for m in self.states for s in self.states if not m & s], "failing int, state int")

    def steps(self, spark: SparkSession) -> DataFrame:
        """Every step of every order as an edge, with the state it leads to."""
        rows = []
        for order in permutations(range(self.size)):
            state, name = 0, "".join(self.letters[f] for f in order)
            for step, f in enumerate(order, 1):
                rows.append((name, step, state, f, state | 1 << f))
                state |= 1 << f
        return spark.createDataFrame(rows, "filter_order string, step int, state int, filter int, reached int")


def failing_sets(
    docs: DataFrame, conditions: dict[str, Column], repeats: str | None = None, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """``doc_id, part, failing`` for every row: the sum of 2^place over the filters it fails.

    ``conditions`` are failure conditions on a column ``text`` by their letter, in order; the filter ``repeats``, after
    them, fails rows whose text a row of a smaller id has.  Texts are read once; only their digests are shuffled.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), part, text)
    bits = [F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(conditions.values())]
    failing = sum(bits[1:], bits[0]) if bits else F.lit(0)
    if not repeats:
        return rows.select("doc_id", "part", failing.alias("failing"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    rows = stored(rows.select("doc_id", "part", failing.alias("failing"), digest), "failing")
    # stored, so that neither side of the join is partitioned by its aggregate and the rows of a frequent text can be split
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    groups = stored(groups.where("first_id < last_id").select("digest", "first_id"), "repeated")
    again = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)).cast("int") * (1 << len(conditions))
    met = rows.join(sent_if_small(groups), "digest", "left")
    return met.select("doc_id", "part", (F.col("failing") + again).alias("failing"))


def counts_by_set(failing: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, failing, n, good, toxic``: documents, and those that ``labels`` marks with quality 1 and with toxic 1."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.where("doc_id is not null and (good or toxic)").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    met = failing.join(sent_if_small(stored(marks, "marks")), "doc_id", "left")
    count = lambda c: F.count(F.when(F.col(c), 1)).alias(c)
    return met.groupBy("part", "failing").agg(F.count("*").alias("n"), count("good"), count("toxic"))


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """For every part, order and step: what the step keeps, removes and finds gone, and the share of its filter.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``; ``shapley`` is summed over
    all orders.  ``counts`` has ``part, failing, n, good, toxic``.
    """
    spark, lattice = counts.sparkSession, Lattice(letters)
    counts = stored(counts, "counts")
    # every set of every part, so that each state and each edge has a row
    every = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit(len(lattice.states) - 1))).alias("failing"))
    none = F.lit(0).cast("long")
    held = counts.unionByName(every.withColumns({"n": none, "good": none, "toxic": none}))
    alone = F.when(F.col("failing") == F.expr("shiftleft(1, `filter`)"), F.col("n")).otherwise(0)
    edges = (
        held.join(F.broadcast(lattice.removals(spark)), "failing")
        .groupBy("part", "state", "filter", "orders")
        .agg(F.sum("n").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"), F.sum(alone).alias("alone"))
    )
    edges = stored(edges, "edges")
    at_first = lambda c: F.max(F.when(F.col("state") == 0, F.col(c)))
    filters = edges.groupBy("part", "filter").agg(
        F.sum(F.col("orders") * F.col("removed")).alias("shapley"), at_first("removed").alias("fails"), at_first("alone").alias("unique_fails")
    )
    kept = held.join(F.broadcast(lattice.survivals(spark)), "failing").groupBy("part", F.col("state").alias("reached")).agg(F.sum("n").alias("kept"))
    steps = edges.join(F.broadcast(lattice.steps(spark)), ["state", "filter"]).join(filters, ["part", "filter"]).join(kept, ["part", "reached"])
    return steps.select(
        "part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


def text_conditions() -> dict[str, Column]:
    """Four failure conditions on a column ``text``: few words (A), few different words (B), many capitals (C), signs (D).

    A word is a run of characters other than the space and the control characters 9 to 13; case counts.
    """
    text = F.col("text")
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words).cast("long")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * n,
        "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }
