"""Steps all normalisers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ... import schemas
from ...functions.dates import parse_date_columns
from ...functions.text import col_of
from ...operators.columns import conform

_STAMPS = ["time_added", "time_removed", "time_checked"]


def prepare(raw: DataFrame, dates: list[str] | None = None, dayfirst: bool = False) -> DataFrame:
    """Parse the source's date columns (``ipo_date`` unless told otherwise) and the history stamps."""
    dated = parse_date_columns(raw, ["ipo_date"] if dates is None else dates, dayfirst)
    return parse_date_columns(dated, _STAMPS, stamp=True)


def labelled(label: str, value: Column | str, blank_when_null: bool = False) -> Column:
    """``label`` + value; a null value gives null, or just the label."""
    c = col_of(value)
    return F.concat(F.lit(label), F.coalesce(c, F.lit("")) if blank_when_null else c)


def listings(clean: DataFrame) -> DataFrame:
    return conform(clean, schemas.LISTING)
