"""Europe."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ...functions.dates import null_unless_after, parse_date_columns, text_on_or_after
from ...functions.numbers import ratio, thousands, tolerant_double
from ...functions.text import contains, extract, is_not, replace_pattern, replace_text
from ...operators.columns import move_when_prefixed, rename, update_where
from ...operators.dedupe import exact
from .common import labelled, prepare

# Patterns, labels and names of these sources.
_BRACKETED_SUFFIX = r"\s\(.*\)"
_FRA_MISPLACED = "First Price"
_FRA_NAME = r"\)([a-zA-Z\s\d\-&\.,]*)Sector"
_FRA_OFFER = r"\(([a-zA-Z\s\/]*)\)"
_FRA_SEGMENT = r"^([a-zA-Z\s]*)\s\("
_FRA_FIRST_PRICE = r"Quotation: €\s(\d{1,3}\.\d{1,3})"
_FRA_AMOUNT = r"/\s€\s([\d,\.]*)"
_FRA_PRICE = r"Volume: €\s(\d{1,3}\.\d{1,3})"
# the odd range from A to | is meant: it takes in letters and the signs between them
_FRA_SECTOR = r"Sector:\n\t\t\t([a-zA-|&,\.\s]*)"
_SPOTLIGHT_SINCE = "2020-01-01"
_SPOTLIGHT_UNUSED = ["ExternalDocuments", "CompanyDocuments"]
_SPOTLIGHT_NAMES = {
    "Id": "num",
    "DateFrom": "subscription_date_start",
    "DateTo": "subscription_date_end",
    "ListingDate": "ipo_date",
    "CompanyName": "company_name",
    "EmissionDescriptionEnglish": "listing_type",
}
_HUB_OPTIONS = {
    "Subscr. period": "subscription_period",
    "Price per share": "price",
    "Pre-money valuation": "market_cap",
    "Target to raise": "deal_size",
    "Offer status": "status",
    "First trading date": "ipo_date",
}
_HUB_CURRENCY = r"\s(\w{3})"
_NORDIC_DAILY = ["last_price", "percent_change"]


def euronext(raw: DataFrame) -> DataFrame:
    return prepare(raw, dayfirst=True).withColumn("exchange", F.concat("exchange", F.lit(" "), "location"))


def lse(raw: DataFrame) -> DataFrame:
    return prepare(raw).withColumns(
        {
            "company_name": replace_pattern("company_name", _BRACKETED_SUFFIX),
            "exchange": labelled("London Stock Exchange ", "exchange", blank_when_null=True),
        }
    )


def frankfurt(raw: DataFrame, older: bool = False) -> DataFrame:
    """Two cells swap places when the offer has no volume; details are read out of running text.

    ``older`` tells the swap by the empty second cell, as the older files need.
    """
    first, second = "sub_price_and_deal_size", "first_price_and_market_cap"
    if older:
        slipped = F.col(second).isNull() & F.col(first).isNotNull()
        placed = update_where(raw, slipped, {second: F.col(first), first: F.lit(None).cast("string")})
    else:
        placed = move_when_prefixed(raw, first, second, _FRA_MISPLACED)
    offer = extract("market_segment", _FRA_OFFER)
    return (
        prepare(placed)
        .withColumns(
            {
                "company_name": extract("summary", _FRA_NAME),
                "offer_type": offer,
                "notes": labelled("Offer Type: ", offer, blank_when_null=True),
                "exchange": labelled("Frankfurt Stock Exchange - ", extract("market_segment", _FRA_SEGMENT)),
                "first_traded_price": extract(second, _FRA_FIRST_PRICE),
                "market_cap": extract(second, _FRA_AMOUNT),
                "price": tolerant_double(extract(first, _FRA_PRICE)),
                "deal_size": extract(first, _FRA_AMOUNT),
                "sector": extract("sector", _FRA_SECTOR),
            }
        )
        .where(is_not("offer_type", "Transfer"))
    )


def bme(raw: DataFrame) -> DataFrame:
    """The price is volume over shares; the security id serves as ticker; integrations are no listings."""
    whole = {c: thousands(c).try_cast("bigint") for c in ["shares_offered", "deal_size", "volume"]}
    priced = prepare(raw).withColumns(whole).withColumn("price", ratio("volume", "shares_offered"))
    listed = priced.where(is_not("listing_type", "Integration")).withColumn("exchange", F.lit("Bolsa de Madrid"))
    return rename(listed, {"isin": "ticker"})


def nasdaq_nordic(raw: DataFrame) -> DataFrame:
    """Without the columns that change daily many rows are the same."""
    return exact(prepare(raw.drop(*_NORDIC_DAILY)).withColumn("exchange", F.lit("Nasdaq Nordic")))


def spotlight_raw(records: DataFrame) -> DataFrame:
    """Since 2020 only; the document list becomes text so rows can be compared."""
    recent = records.where(text_on_or_after("ListingDate", _SPOTLIGHT_SINCE)).drop(*_SPOTLIGHT_UNUSED)
    return rename(recent.withColumn("Documents", F.to_json("Documents")), _SPOTLIGHT_NAMES)


def spotlight(raw: DataFrame) -> DataFrame:
    return prepare(raw).withColumn("exchange", F.lit("Spotlight"))


def borsa_italiana(raw: DataFrame) -> DataFrame:
    segment = replace_text("market_segment", "*", "Professional Segment")
    moved = contains("listing_type", "Transition from")
    return prepare(raw, dayfirst=True).where(~moved).withColumns(
        {"market_segment": segment, "exchange": labelled("Borsa Italiana - ", segment)}
    )


def ipohub_raw(cards: DataFrame, as_of) -> DataFrame:
    """Cards from ``sources.records.cards``; a bare year reads as 1 January and is no date once that has passed."""
    text = F.col("price")
    return parse_date_columns(cards, ["ipo_date"]).withColumns(
        {
            "ipo_date": null_unless_after("ipo_date", as_of),
            "price_range": F.when(contains(text, "-"), text),
            "currency": extract(text, _HUB_CURRENCY),
            "price": tolerant_double(replace_pattern(text, _HUB_CURRENCY)),
        }
    )


def hub_options() -> dict[str, str]:
    """Card label -> column, for ``sources.records.cards``."""
    return dict(_HUB_OPTIONS)


def ipohub(raw: DataFrame) -> DataFrame:
    return prepare(raw)
