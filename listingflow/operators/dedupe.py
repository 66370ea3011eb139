"""De-duplication.

"Keep the first of each key" is written as ``row_number() = 1``.  Spark turns that filter into a group limit that runs
before the shuffle, so a task sends at most one row per key and a key holding a third of all rows costs no more than
any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from .columns import stack
from .ordering import sort_columns


def exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def _orderable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def keep_first(df: DataFrame, keys: list[str], order: list[tuple[str, str]], ties: list[str] | None = None) -> DataFrame:
    """One row per key: the first in ``order`` (name, asc or desc; nulls last); null keys form a group.

    Rows equal in ``order`` are told apart by the remaining columns, so the result does not depend on partitioning.
    Pass ``ties`` to use a shorter total order.
    """
    used = {*keys, *[name for name, _ in order]}
    rest = ties if ties is not None else [c for c in _orderable(df) if c not in used]
    by = sort_columns(order + [(c, "asc") for c in rest])
    window = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest(df: DataFrame, keys: list[str], stamp: str, ties: list[str] | None = None) -> DataFrame:
    return keep_first(df, keys, [(stamp, "desc")], ties)


def earliest_ignoring(df: DataFrame, ignored: list[str], order: list[str]) -> DataFrame:
    """Earliest of the rows that agree on everything but the ignored columns."""
    return keep_first(df, [c for c in df.columns if c not in ignored], [(c, "asc") for c in order])


def best_score(df: DataFrame, key: str, scores: list[str]) -> DataFrame:
    return keep_first(df, [key], [(s, "desc") for s in scores])


def lowest_price(df: DataFrame, key: str = "ticker", price: str = "price", stamp: str = "time_added") -> DataFrame:
    """The lowest price per key, unpriced rows last."""
    return keep_first(df, [key], [(price, "asc"), (stamp, "asc")])


def keep_last(base: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: stack the updates after the base and keep the last row of each key."""
    tagged = stack([base.withColumn("_turn", F.lit(0)), updates.withColumn("_turn", F.lit(1))])
    return keep_first(tagged, keys, [("_turn", "desc")]).drop("_turn")


def refresh(existing: DataFrame, new: DataFrame, keys: list[str], stamp: str, trim: list[str] = ()) -> DataFrame:
    """Incremental refresh: existing rows and new ones, texts trimmed, the latest row per key."""
    from ..functions.text import strip

    merged = stack([existing, new])
    if trim:
        merged = merged.withColumns({c: strip(c) for c in trim})
    return latest(merged, keys, stamp)


def audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, distinct rows, duplicate rows."""
    reports = []
    for name, df in tables.items():
        groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
        reports.append(
            groups.agg(
                F.lit(name).alias("table_name"),
                F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
                F.count(F.lit(1)).alias("distinct_rows"),
            ).withColumn("duplicate_rows", F.col("row_count") - F.col("distinct_rows"))
        )
    return stack(reports)


def checksum(columns: list[str]) -> Column:
    """A number that any order of the same rows gives: the sum of their hashes."""
    return F.coalesce(F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def clean(tables: dict[str, DataFrame], root: str) -> DataFrame:
    """Each table without its duplicates saved as ``root``/name, and the report of ``audit`` with a checksum of what was saved.

    A table is read once: the counts are gathered by the pass that writes it.  A folder must not be one the table is read from.
    Run again it gives the same tables and report.  ``checksum`` over a saved table tells later whether it is still whole.
    """
    report = []
    for name, df in tables.items():
        groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
        seen = Observation(f"clean-{name}")
        counts = (F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct"), checksum(df.columns).alias("checksum"))
        groups.observe(seen, *counts).drop("_n").write.mode("overwrite").parquet(f"{root}/{name}")
        got = seen.get
        report.append((name, got["rows"], got["distinct"], got["rows"] - got["distinct"], got["checksum"]))
    schema = "table_name string, row_count long, distinct_rows long, duplicate_rows long, checksum decimal(38,0)"
    return next(iter(tables.values())).sparkSession.createDataFrame(report, schema)
