"""External listings against internal deals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.dates import any_on_or_after
from ..functions.text import normalise_company, null_if_in
from .aggregates import concat_distinct
from .columns import conform, fill_from, rename
from .dedupe import latest
from .joins import enrich_with_fallback, full_outer, left, left_folded

# Exchanges whose listings carry localised names, and texts that stand for a missing ticker.
LOCALISED_EXCHANGES = ["Shenzhen Stock Exchange", "Shanghai Stock Exchange", "Shanghai", "Shenzhen"]
_MISSING_TICKERS = ["nan", "None"]

# The columns a deal brings to a reconciliation, in their order.
_DEAL_COLUMNS = [
    "iconum",
    "cusip",
    "company_name",
    "client_deal_id",
    "ticker",
    "exchange",
    "price",
    "trading_date",
    "last_updated_date_utc",
]

# The match report's columns, in order.
MATCH_COLUMNS = [
    "ipo_dates_match",
    "ipo_prices_match",
    "iconum",
    "company_name_external",
    "exchange_external",
    "ipo_date",
    "price_external",
    "price_range",
    "status",
    "notes",
    "time_added",
    "company_name_internal",
    "master_deal",
    "client_deal_id",
    "cusip",
    "ticker",
    "exchange_internal",
    "price_internal",
    "min_offering_price",
    "max_offering_price",
    "announcement_date",
    "pricing_date",
    "trading_date",
    "closing_date",
    "deal_status",
    "last_updated_date_utc",
]


def deals_per_entity(deals: DataFrame) -> DataFrame:
    """Deals with their entity's tickers, exchanges and security ids each joined into one text; latest per (entity, deal).

    Copies of a deal need no clean-up of their own: neither the distinct texts nor the latest row is changed by them.
    """
    cleaned = deals.withColumns(
        {"ticker": null_if_in("ticker", _MISSING_TICKERS), "exchange": F.trim("exchange")}
    )
    texts = concat_distinct(cleaned, "iconum", ["ticker", "exchange", "cusip"])
    newest = latest(cleaned.drop("ticker", "exchange", "cusip"), ["iconum", "master_deal"], "last_updated_date_utc")
    return left(newest, texts, "iconum").select(*[f.name for f in schemas.DEALS.fields])


def with_entities(
    listings: DataFrame,
    entity_map: DataFrame,
    deals: DataFrame,
    restrict_exchanges: bool = False,
    each_exchange: bool = False,
) -> DataFrame:
    """Listings with their entity; companies on localised exchanges may also be found by ticker among the deals.

    By default the ticker fallback is applied to any listing whose ticker fits; ``restrict_exchanges`` limits it to
    listings on the localised exchanges.  ``each_exchange`` looks at every exchange of a deal's joined exchange text
    rather than the whole text.
    """
    mapped = entity_map.select("company_name", "entityname", "iconum")
    joined = left_folded(listings, mapped, "company_name")
    names = [F.lit(e) for e in LOCALISED_EXCHANGES]
    if each_exchange:
        local_deal = F.arrays_overlap(F.split("exchange", ", "), F.array(*names))
    else:
        local_deal = F.col("exchange").isin(LOCALISED_EXCHANGES)
    lookup = deals.where(local_deal & F.col("ticker").isNotNull()).select("iconum", "company_name", "ticker")
    local = F.coalesce(F.col("exchange").isin(LOCALISED_EXCHANGES), F.lit(False))
    enriched = enrich_with_fallback(
        joined, lookup, "ticker", {"iconum": "iconum", "entityname": "company_name"}, local if restrict_exchanges else None
    )
    shown = F.when(local & F.col("entityname").isNotNull(), F.col("entityname")).otherwise(F.col("company_name"))
    return enriched.withColumn("company_name", shown)


def reconcile(
    external: DataFrame, deals: DataFrame, prefer_external_ticker: bool = False
) -> DataFrame:
    """Full outer view of external listings (with entities) and internal deals by entity."""
    kept = external if prefer_external_ticker else external.drop("ticker")
    result = full_outer(kept, deals.select(*_DEAL_COLUMNS), "iconum", ("_external", "_internal"))
    if prefer_external_ticker:
        result = result.withColumn("ticker", F.coalesce("ticker_external", "ticker_internal")).drop(
            "ticker_external", "ticker_internal"
        )
    return result


def current_rows(reconciled: DataFrame, as_of) -> DataFrame:
    return reconciled.where(any_on_or_after(["ipo_date", "trading_date"], as_of))


def withdrawn_rows(reconciled: DataFrame) -> DataFrame:
    return reconciled.where(F.col("status") == "Withdrawn")


def matches(internal: Column, external: Column) -> Column:
    """Equal, or nothing known externally."""
    return F.coalesce(internal == external, F.lit(False)) | external.isNull()


def match_report(external: DataFrame, deals: DataFrame) -> DataFrame:
    """Which external dates and prices agree with the internal deal.

    Only what is shown is joined, dates as they are shown, and the copies left by that are dropped where the join put them: rows
    equal in all columns met under the same key and salt, so the report is not shuffled again.
    """
    shown = [
        ["company_name", "exchange", "ipo_date", "price", "price_range", "status", "notes", "time_added"],
        [f.name for f in schemas.DEALS.fields if f.name != "iconum"],
    ]
    sides = []
    for df, columns in zip((external, deals), shown, strict=True):
        cast = [F.col(c).cast("date").alias(c) if "date" in c.lower() else F.col(c) for c in columns]
        sides.append(df.select("iconum", *cast))
    joined = left(*sides, "iconum", ("_external", "_internal"), hot_right=True, distinct=True)
    flagged = joined.withColumns(
        {
            "ipo_dates_match": matches(F.col("trading_date"), F.col("ipo_date")),
            "ipo_prices_match": matches(F.col("price_internal"), F.col("price_external")),
        }
    )
    return flagged.select(*MATCH_COLUMNS)


def ticket_listings(reconciled: DataFrame) -> DataFrame:
    """One coalesced record per reconciled row: external values win, internal ones fill the gaps."""
    filled = fill_from(
        reconciled.withColumn("ipo_date", F.col("ipo_date").cast("date")).withColumn(
            "_trading_day", F.col("trading_date").cast("date")
        ),
        {
            "company_name_external": "company_name_internal",
            "ipo_date": "_trading_day",
            "price_external": "price_internal",
            "exchange_external": "exchange_internal",
            "time_added": "last_updated_date_utc",
        },
    )
    named = rename(
        filled,
        {
            "company_name_external": "company_name",
            "price_external": "price",
            "exchange_external": "exchange",
            "time_added": "last_checked",
            "client_deal_id": "ipo_deal_id",
        },
    )
    named = named.withColumn("formatted_company_name", normalise_company("company_name"))
    return conform(named, schemas.TICKET_LISTING)
