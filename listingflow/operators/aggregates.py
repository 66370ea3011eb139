"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import round_half_even


def distinct_text(value: Column | str, separator: str = ", ") -> Column:
    """Aggregate: the distinct non-null values of a group in one text, in value order (duplicates go map-side)."""
    c = F.col(value) if isinstance(value, str) else value
    joined = F.array_join(F.array_sort(F.collect_set(c.cast("string"))), separator)
    return F.nullif(joined, F.lit(""))


def concat_distinct(df: DataFrame, key: str, values: list[str], separator: str = ", ") -> DataFrame:
    """Per key, each column's distinct values as text; keys null in the frame are left out, as are all-null columns."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[distinct_text(v, separator).alias(v) for v in values])
    )


def concat_distinct_newest(df: DataFrame, key: str, value: str, stamp: str, separator: str = ", ") -> DataFrame:
    """As ``concat_distinct`` for one column, newest value first."""
    last_seen = (
        df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key, value)
        .agg(F.max(stamp).alias("_seen"))
    )
    ordered = F.array_sort(
        F.collect_list(F.struct(F.col("_seen"), F.col(value))),
        lambda a, b: F.when(a["_seen"] > b["_seen"], -1)
        .when(a["_seen"] < b["_seen"], 1)
        .when(a[value] < b[value], -1)
        .when(a[value] > b[value], 1)
        .otherwise(0),
    )
    return last_seen.groupBy(key).agg(F.array_join(F.transform(ordered, lambda s: s[value]), separator).alias(value))


def aligned(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Two per-key aggregates of different tables side by side."""
    from .joins import full_outer

    return full_outer(left, right, key, unique=True)


def distinct_counts_where(df: DataFrame, key: str, counts: dict[str, tuple[Column, str]]) -> DataFrame:
    """Several per-key counts of distinct values of one table, side by side, each over the rows that meet its condition.

    One pass over the table; a key is listed if any row of it meets a condition, and a count without such rows is null.
    """
    met = F.lit(False)
    for condition, _ in counts.values():
        met = met | F.coalesce(condition, F.lit(False))
    found = df.where(met & F.col(key).isNotNull()).groupBy(key).agg(
        *[F.countDistinct(F.when(condition, F.col(value))).alias(f"_{name}") for name, (condition, value) in counts.items()],
        *[F.max(F.when(condition, True)).alias(f"_{name}_met") for name, (condition, _) in counts.items()],
    )
    return found.select(key, *[F.when(F.col(f"_{name}_met"), F.col(f"_{name}")).alias(name) for name in counts])


def greatest(df: DataFrame, values: dict[str, str], count: str) -> DataFrame:
    """The greatest value of each column in the whole table, and the number of rows: one row."""
    return df.agg(*[F.max(c).alias(name) for name, c in values.items()], F.count(F.lit(1)).alias(count))


def success_rate(total: Column, polls: int) -> Column:
    """Successes as a percentage of the polls asked for, even when fewer exist."""
    return round_half_even(total / F.lit(polls) * F.lit(100), 2)


def last_when(condition: Column, stamp: str) -> Column:
    """Aggregate: the greatest stamp among the rows that meet the condition."""
    return F.max(F.when(condition, F.col(stamp)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def grand_total(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.sum(column).alias(column))


def running_last(
    df: DataFrame, partition: list[str], position: str, value: Column, name: str, block: int = 10_000, tasks: int | None = None
) -> DataFrame:
    """Greatest value so far, by position, without putting a whole partition into one task.

    Positions are cut into blocks.  Each block is summed up first, the block summaries (few rows) are run through a window,
    and the rows are then windowed inside their own block only, behind a row that brings what was before the block; so the rows
    are shuffled and sorted once and no join holds them.  ``tasks`` is into how many parts they are dealt, where the caller knows
    how many rows there are; else it is the session's number.
    """
    from pyspark.sql import Window

    tagged = df.withColumns({"_block": F.floor(F.col(position) / F.lit(block)), "_value": value, "_own": F.lit(1)})
    blocks = tagged.groupBy(*partition, "_block").agg(F.max("_value").alias("_block_max"))
    before = Window.partitionBy(*partition).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_value", F.max("_block_max").over(before)).drop("_block_max").withColumn("_own", F.lit(0))
    # a null page or place has no blocks that follow each other
    blocks = blocks.na.drop(subset=[*partition, "_block", "_value"])
    inside = Window.partitionBy(*partition, "_block").orderBy("_own", position).rowsBetween(Window.unboundedPreceding, 0)
    rows = tagged.unionByName(blocks, allowMissingColumns=True)
    rows = rows.repartition(tasks, *partition, "_block") if tasks else rows
    running = rows.withColumn(name, F.max("_value").over(inside))
    return running.where("_own = 1").drop("_block", "_value", "_own")
