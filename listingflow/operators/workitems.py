"""Work items for analysts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import as_of_date, as_of_stamp
from ..functions.numbers import nullable_int
from ..functions.text import differs_or_missing
from .columns import first_column, upper_names
from .filters import where_all
from .joins import left, left_on_either
from .ordering import page

# Priority codes of the upload layout, and its columns that must be whole and present.
PRIORITY = {"Critical": 31, "High": 30, "Medium": 20, "Low": 10, "None": 0}
_WHOLE_COLUMNS = ["iconum", "master_deal", "shares_offered"]
PRIORITY_COLUMN = "i_priority"
URGENT_DAYS = 3


def upcoming(listings: DataFrame, entity_map: DataFrame, deals: DataFrame, as_of) -> DataFrame:
    """Listings from ``as_of`` on whose date or price the internal deal lacks or contradicts.

    A deal belongs to a listing by company name or by entity id.
    """
    wanted = listings.where(F.col("ipo_date") >= as_of_date(as_of)).select(
        "company_name", "ticker", "exchange", "ipo_date", "price", "price_range", "shares_offered", "notes"
    )
    entities = entity_map.select("company_name", F.col("iconum").alias("_entity")).distinct()
    internal = deals.select(
        F.col("company_name").alias("_deal_name"),
        F.col("iconum").alias("_deal_iconum"),
        "master_deal",
        F.col("trading_date").alias("_deal_date"),
        F.col("price").alias("_deal_price"),
    ).distinct()
    joined = left_on_either(
        left(wanted, entities, "company_name"),
        internal,
        [("company_name", "_deal_name"), ("_entity", "_deal_iconum")],
    )
    open_points = differs_or_missing("_deal_date", F.col("ipo_date").cast("timestamp_ntz")) | differs_or_missing(
        "_deal_price", "price"
    )
    return (
        joined.where(open_points)
        .select(
            F.coalesce("_deal_iconum", "_entity").alias("iconum"),
            "company_name",
            "master_deal",
            "ticker",
            "exchange",
            "ipo_date",
            "price",
            "price_range",
            "shares_offered",
            "notes",
        )
        .distinct()
    )


def priority(listing_date: Column, as_of) -> Column:
    """High when the listing is at most three days (to the instant) after ``as_of``."""
    limit = as_of_stamp(as_of) + F.expr(f"INTERVAL {URGENT_DAYS} DAYS")
    return F.when(listing_date.cast("timestamp_ntz") <= limit, PRIORITY["High"]).otherwise(PRIORITY["Medium"])


def upload_layout(items: DataFrame, as_of) -> DataFrame:
    """Priority first, whole numbers without nulls, upper-case headers but for the priority."""
    whole = items.withColumns({c: nullable_int(c) for c in _WHOLE_COLUMNS})
    shown = upper_names(whole).withColumn(PRIORITY_COLUMN, priority(F.col("IPO_DATE"), as_of))
    return first_column(shown, PRIORITY_COLUMN)


def task_counts(tasks: DataFrame, status: str, task_priority: str) -> DataFrame:
    """Tasks by status and priority, with the row total."""
    names = {str(code): f"{label.lower()}_priority" for label, code in PRIORITY.items()}
    by_code = F.col(task_priority).cast("string")
    counts = tasks.groupBy(status).agg(
        *[F.count(F.when(by_code == code, 1)).alias(name) for code, name in names.items()]
    )
    return counts.withColumn("total_tasks", sum(F.col(n) for n in names.values()))


def task_page(
    tasks: DataFrame,
    keys: list[tuple[str, str]],
    number: int = 0,
    size: int = 100,
    filters: list[Column | str] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Filtered tasks, one page at a time; the page is cut before the columns are."""
    found = page(where_all(tasks, filters or []), keys, number, size)
    return found.select(*columns) if columns else found
