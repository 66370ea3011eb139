"""Projection and schema operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import schemas
from ..functions.text import blank_to_null, null_if_in

# Characters that may not appear in a table column name.
_NAME_NOISE = re.compile(r"[()?+]")


def database_name(name: str) -> str:
    return _NAME_NOISE.sub("", name).lower().replace(" ", "_")


def database_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[database_name(c) for c in df.columns])


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def first_column(df: DataFrame, name: str) -> DataFrame:
    return df.select(name, *[c for c in df.columns if c != name])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names the frame lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def keep_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _on_strings(df: DataFrame, change, columns: Iterable[str] | None = None) -> DataFrame:
    names = list(columns) if columns is not None else string_columns(df)
    return df.withColumns({c: change(F.col(f"`{c}`")) for c in names}) if names else df


def blanks_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return _on_strings(df, blank_to_null, columns)


def placeholders_to_null(df: DataFrame, placeholders: list[str], columns: Iterable[str] | None = None) -> DataFrame:
    return _on_strings(df, lambda c: null_if_in(c, placeholders), columns)


def nulls_to_blank(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Blanks for nulls in the named text columns, or in all of them."""
    return df.na.fill("", subset=string_columns(df) if names is None else names)


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows that meet the condition.

    All new values are computed from the row as it was, so values can be moved between columns; a condition that is null
    counts as not met.
    """
    hit = F.coalesce(condition, F.lit(False))
    new = {}
    for name, value in changes.items():
        old = F.col(f"`{name}`") if name in df.columns else F.lit(None)
        new[name] = F.when(hit, value).otherwise(old)
    return df.withColumns(new)


def null_where(df: DataFrame, condition: Column, columns: Iterable[str]) -> DataFrame:
    """Blank several columns by one condition."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in columns if c in types]
    return update_where(df, condition, {c: F.lit(None).cast(types[c]) for c in present})


def fill_from(df: DataFrame, fallbacks: Mapping[str, str]) -> DataFrame:
    """Fill nulls of each column from its fallback column."""
    return df.withColumns({a: F.coalesce(F.col(f"`{a}`"), F.col(f"`{b}`")) for a, b in fallbacks.items()})


def move_when_prefixed(df: DataFrame, source: str, target: str, prefix: str) -> DataFrame:
    """Repair rows whose ``target`` value slipped into ``source``, told by its prefix."""
    return update_where(
        df,
        F.col(source).startswith(prefix),
        {target: F.col(source), source: F.lit(None).cast("string")},
    )


def conform(df: DataFrame, schema: T.StructType = schemas.LISTING) -> DataFrame:
    """Project to a fixed schema: absent columns become nulls, other columns go, types are tolerant casts."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def stack(frames: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Union by name, missing columns null; with a schema every frame is conformed first."""
    if schema is not None:
        frames = [conform(f, schema) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def row_total(df: DataFrame, marker: str, total: str = "total_tasks") -> DataFrame:
    """Row-wise sum of the columns whose name contains the marker, nulls as zero."""
    parts = [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in df.columns if marker in c.lower()]
    return df.withColumn(total, reduce(lambda a, b: a + b, parts, F.lit(0)))
