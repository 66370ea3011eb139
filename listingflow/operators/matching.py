"""Exact similarity join of company names against an entity universe.

similarity = 1 - edit distance / length of the longer name, on normalised names.
confidence = similarity less half of what the runner-up scores above the threshold (1 for an exact match), i.e. a match
with a close rival is trusted less.

No name pair is compared because it merely sits in the same block.  Copies are folded first, equal names are matched by
an equi-join, and the rest meet on keys that any pair within the threshold provably shares, so no candidate is lost and none
needs to be capped.

A pair may have k edits, which follow from the longer name's length.  The known name is cut into k + 1 even pieces.  k edits
leave at least one of them whole, so it occurs in the other name, and not far from its own place: edits that moved it count
towards those before it, the rest to those behind it, and each piece takes no more of them than would be left if the pieces
before it, or those behind it, had one each.  So a name meets the known ones of each length on its substrings in these
places.  A key has the known name's length, the edits, the number of the piece and the piece, some four or five letters at
the usual threshold of 0.8.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import col_of, normalise_company
from ..sources.writers import unstaged
from .joins import left

def _edits(length: Column, threshold: float) -> Column:
    """Edits that a pair may have whose longer name has this length."""
    return F.floor(length * F.lit(1 - threshold) + F.lit(1e-9)).cast("int")


def similarity(a: Column | str, b: Column | str) -> Column:
    left, right = col_of(a), col_of(b)
    longer = F.greatest(F.length(left), F.length(right))
    return F.lit(1.0) - F.levenshtein(left, right) / longer


def _piece(length: Column, edits: Column, number: Column) -> tuple[Column, Column]:
    """(place from 0, length) of a piece of a name of this length that is cut into ``edits`` + 1; the last ones are longer."""
    pieces = edits + 1
    short, rest = F.floor(length / pieces).cast("int"), length % pieces
    beyond = F.greatest(number - (pieces - rest), F.lit(0))
    return number * short + beyond, short + F.when(number >= pieces - rest, 1).otherwise(0)


def _pieces(known: DataFrame, threshold: float) -> DataFrame:
    """``candidate, length, edits, number, piece``: the pieces of each known name for all numbers of edits that a pair with it may have."""
    n = F.length("name")
    longest = F.floor(n / F.lit(threshold) + F.lit(1e-9)).cast("int")
    each = known.select("name", n.alias("length"), F.explode(F.sequence(_edits(n, threshold), _edits(longest, threshold))).alias("edits"))
    each = each.where("edits > 0").withColumn("number", F.explode(F.sequence(F.lit(0), F.col("edits"))))
    place, width = _piece(F.col("length"), F.col("edits"), F.col("number"))
    return each.select(F.col("name").alias("candidate"), "length", "edits", "number", F.substring("name", place + 1, width).alias("piece"))


def _places(names: DataFrame, threshold: float, lengths: DataFrame) -> DataFrame:
    """``name, length, edits, number, piece``: the substrings on which each name meets known names of each of the ``lengths``."""
    m = F.length("name")
    shortest, longest = F.ceil(m * F.lit(threshold) - F.lit(1e-9)).cast("int"), F.floor(m / F.lit(threshold) + F.lit(1e-9)).cast("int")
    each = names.withColumn("length", F.explode(F.sequence(F.greatest(shortest, F.lit(1)), longest)))
    each = each.join(lengths, "length")
    each = each.withColumn("edits", _edits(F.greatest(m, F.col("length")), threshold)).where("edits > 0")
    each = each.where(F.abs(m - F.col("length")) <= F.col("edits")).withColumn("number", F.explode(F.sequence(F.lit(0), F.col("edits"))))
    place, width = _piece(F.col("length"), F.col("edits"), F.col("number"))
    each = each.withColumns({"place": place, "width": width})
    ahead, behind, shift = F.col("number"), F.col("edits") - F.col("number"), m - F.col("length")
    first = F.greatest(F.lit(0), F.col("place") - ahead, F.col("place") + shift - behind)
    last = F.least(m - F.col("width"), F.col("place") + ahead, F.col("place") + shift + behind)
    each = each.withColumns({"first": first, "last": last}).where("first <= last").withColumn("at", F.explode(F.sequence("first", "last")))
    return each.select("name", "length", "edits", "number", F.substring("name", F.col("at") + 1, F.col("width")).alias("piece"))


def met_pairs(names: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """The (name, candidate) pairs of unequal names that meet on some key, once for each key; ``allowed`` edits of the pair."""
    lengths = known.select(F.length("name").alias("length")).distinct()
    met = _places(names, threshold, lengths).join(_pieces(known, threshold), ["length", "edits", "number", "piece"])
    return met.where("name <> candidate").select("name", "candidate", F.col("edits").alias("allowed"))


def candidate_pairs(names: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """Distinct (name, candidate) pairs of unequal names whose similarity reaches the threshold."""
    # the bounded distance gives up early (-1), so pairs are measured where they meet and only near ones are shuffled
    distance = F.call_function("levenshtein", F.col("name"), F.col("candidate"), F.col("allowed"))
    met = met_pairs(names, known, threshold)
    near = met.select("name", "candidate", distance.alias("distance")).where("distance >= 0").distinct()
    longer = F.greatest(F.length("name"), F.length("candidate"))
    return near.select("name", "candidate", (F.lit(1.0) - F.col("distance") / longer).alias("similarity"))


def match_names(
    listings: DataFrame,
    universe: DataFrame,
    threshold: float = 0.8,
    name: str = "company_name",
    entity_name: str = "entityname",
    entity_id: str = "entity_id",
    stage: Callable[[DataFrame, str], DataFrame] = unstaged,
) -> DataFrame:
    """Each listing row with the best entity for its name: entity name, id, similarity, confidence, MAPPED/UNMAPPED.

    Ties go to the smallest normalised name, then the smallest entity id.  ``threshold`` must be at least 0.7: below it
    short names can be similar without sharing two letters in a row.  ``stage`` may store the two lists of distinct names,
    which are read several times (see ``sources.writers.staged``).
    """
    if threshold < 0.7:
        raise ValueError("threshold must be at least 0.7")
    named = listings.withColumn("_name", normalise_company(name))
    wanted = named.select(F.col("_name").alias("name")).where("name <> ''").distinct()
    # entities sharing a normalised name are one candidate, represented by the smallest id
    entities = (
        universe.select(normalise_company(entity_name).alias("name"), F.struct(entity_id, entity_name).alias("entity"))
        .where("name <> ''")
        .groupBy("name")
        .agg(F.min("entity").alias("entity"))
    )
    entities = stage(entities, "entities")
    known = entities.select("name")
    equal = wanted.join(known, "name", "left_semi").select(
        "name", F.col("name").alias("candidate"), F.lit(1.0).alias("similarity"), F.lit(None).cast("double").alias("second")
    )
    unequal = stage(wanted.join(known, "name", "left_anti"), "names")
    pairs = candidate_pairs(unequal, known, threshold)
    # the two best per name; the filter on the rank is applied before the shuffle as well
    by_score = Window.partitionBy("name").orderBy(F.desc("similarity"), "candidate")
    top = pairs.withColumn("place", F.row_number().over(by_score)).where("place <= 2")
    best = top.groupBy("name").agg(
        F.max(F.when(F.col("place") == 1, F.col("candidate"))).alias("candidate"),
        F.max(F.when(F.col("place") == 1, F.col("similarity"))).alias("similarity"),
        F.max(F.when(F.col("place") == 2, F.col("similarity"))).alias("second"),
    )
    rival = F.coalesce(F.col("second") - F.lit(threshold), F.lit(0.0)) / 2
    confidence = F.when(F.col("similarity") == 1.0, 1.0).otherwise(F.col("similarity") - rival)
    decided = (
        equal.unionByName(best)
        .join(entities.withColumnRenamed("name", "candidate"), "candidate")
        .select(
            F.col("name").alias("_name"),
            F.col(f"entity.{entity_name}").alias("entityname"),
            F.col(f"entity.{entity_id}").alias("entity_id"),
            "similarity",
            confidence.alias("confidence"),
        )
    )
    status = F.when(F.col("entity_id").isNotNull(), "MAPPED").otherwise("UNMAPPED")
    return left(named, decided, "_name").drop("_name").withColumn("mapstatus", status)
