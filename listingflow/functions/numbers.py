"""Number columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .text import col_of, contains


# Fixed value: what counts as a number.
_NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"


def tolerant_double(value: Column | str) -> Column:
    """Per-cell numeric parse: null for anything that is not a plain number (the cell is looked at once)."""
    return F.regexp_extract(col_of(value).cast("string"), _NUMBER, 1).try_cast("double")


def double_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns as doubles; text is parsed tolerantly, numbers are only cast."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns({c: tolerant_double(c) if c in text else F.col(c).cast("double") for c in columns})


def thousands(value: Column | str) -> Column:
    """A number with comma separators."""
    return tolerant_double(F.replace(col_of(value).cast("string"), F.lit(","), F.lit("")))


def scaled(value: Column | str, factor: float) -> Column:
    return tolerant_double(value) * F.lit(float(factor))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    return F.try_divide(col_of(numerator), col_of(denominator))


def nullable_int(value: Column | str) -> Column:
    """A whole number for systems that accept no missing value: 0 stands for null.

    Whole numbers and texts of whole numbers are taken as they are, so none is rounded on the way through a double.
    """
    text = col_of(value).cast("string")
    whole = F.regexp_extract(text, r"^\s*([+-]?\d+)\s*$", 1).try_cast("bigint")
    return F.coalesce(whole, tolerant_double(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def round_half_even(value: Column | str, places: int = 2) -> Column:
    return F.bround(col_of(value), places)


def number_text(value: Column | str) -> Column:
    """A double as plain digits with at least one decimal (``16.0``, ``12500000.0``)."""
    c = col_of(value)
    whole = F.concat(c.try_cast("bigint").cast("string"), F.lit(".0"))
    fraction = F.rtrim(c.try_cast("decimal(38,10)").cast("string"), F.lit("0"))
    return F.when(c == F.floor(c), whole).when(F.abs(c) < 1e7, c.cast("string")).otherwise(fraction)


def range_text(low: Column | str, high: Column | str) -> Column:
    """``low - high``; null when either end is missing."""
    return F.concat(col_of(low).cast("string"), F.lit(" - "), col_of(high).cast("string"))


def split_price(price: Column | str, price_range: Column | str | None = None) -> tuple[Column, Column]:
    """A price text is a single price or a range: return (price, price range).

    A text with a dash is the range and leaves the price empty; otherwise an existing range is kept.
    """
    text = col_of(price)
    is_range = contains(text, "-")
    kept = col_of(price_range) if price_range is not None else F.lit(None).cast("string")
    single = F.when(~is_range, tolerant_double(F.replace(text, F.lit(" "), F.lit(""))))
    return single, F.when(is_range, text).otherwise(kept)


def price_from_bounds(low: Column | str, high: Column | str, zero_is_unpriced: bool = False) -> tuple[Column, Column]:
    """Two bounds: equal ones are the price, different ones a range; zero may mean "not priced yet"."""
    lo, hi = col_of(low), col_of(high)
    priced = F.coalesce(lo != 0, F.lit(False)) if zero_is_unpriced else F.lit(True)
    price = F.when(priced & (lo == hi), hi.try_cast("double"))
    return price, F.when(priced & (lo != hi), range_text(lo, hi))
