"""Row filters that are more than one predicate (the predicates are in ``functions``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import contains


def drop_null_rows(df: DataFrame, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how=how, subset=subset)


def largest_prefix(df: DataFrame, label: str, length: int) -> Column:
    """The prefix of the greatest label as a scalar subquery."""
    return F.substring(df.agg(F.max(label)).scalar(), 1, length)


def latest_batch(df: DataFrame, label: str, length: int = 8) -> DataFrame:
    """The rows of the newest batch: those sharing the prefix of the greatest label."""
    return df.where(F.substring(F.col(label), 1, length) == largest_prefix(df, label, length))


def messages_with(df: DataFrame, message: str, phrase: str, key: str) -> DataFrame:
    """Ids of the rows whose message holds the phrase (their number is a plain count of the result)."""
    return df.where(contains(message, phrase)).select(key)


def where_all(df: DataFrame, conditions: list[Column | str]) -> DataFrame:
    """Conjunction of a list of conditions given as columns or SQL text."""
    for condition in conditions:
        df = df.where(condition)
    return df
