"""Asia and the Pacific."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ...functions.dates import infer_year, parse_date_columns
from ...functions.numbers import scaled, split_price, thousands, tolerant_double
from ...functions.text import concat_blank, contains, extract, replace_pattern, replace_text, strip
from ...operators.columns import blanks_to_null, placeholders_to_null, stack
from ...operators.dedupe import earliest_ignoring, latest, lowest_price
from ...operators.joins import left
from .common import labelled, listings, prepare

# Patterns, labels and names of these sources.
_JPX_TECHNICAL = "**"
_TOKYO_NAMES = [
    "company_name",
    "ipo_date",
    "ticker",
    "shares_outstanding",
    "blank_0",
    "price_range",
    "price",
    "bookbuilding_period",
    "opening_price",
    "percent_change",
    "underwriters",
    "business_description",
    "blank_1",
]
_TOKYO_UNUSED = ["blank_0", "business_description", "blank_1"]
_TOKYO_MARKER = "\n\n▶\xa0Stock/Chart"
_MONTH_DAY = r"^(\d{0,2}\/\d{0,2})$"
_BRACKETED_WORD = r"\((\w*)\)"
_TRAILING_FIGURES = r"(\d*)$"
_HONG_KONG_TICKER = r"(\d*)\.HK"
_ASX_NAME = r"^([a-zA-Z0-9\s,\.&\(\)\-]*)\s\-"
_ASX_DATE = r"\s*-\s*(\d{1,2}\s\w*\s\d{2,4})"
_SGX_PRICE = r"\s([\d\.]*)$"
_SGX_DAILY = [
    "closing_price_first_day",
    "change_from_ipo_price",
    "closing_price_prev_day",
    "market_cap_prev_day_mm",
    "prem_disc_to_ipo_price",
]
_DECIMAL = r"(\d*\.\d*)"
_TWSE_DATES = [
    "announcement_date",
    "listing_review_date",
    "application_approval_date",
    "listing_agreement_submitted_to_fsc_date",
    "ipo_date",
]
_SHANGHAI_DATES = ["subscription_date", "announcement_of_winning_results", "ipo_date"]


def jpx(raw: DataFrame) -> DataFrame:
    """Two stars mark a technical listing."""
    name = replace_text(replace_text("company_name", ",", ", "), _JPX_TECHNICAL)
    return prepare(raw, ["ipo_date", "date_of_listing_approval"]).withColumns(
        {
            "exchange": labelled("Japan Stock Exchange - ", "market_segment"),
            "notes": F.when(contains("company_name", _JPX_TECHNICAL), "Technical Listing"),
            "company_name": strip(name),
        }
    )


def tokyo_ipo_raw(records: DataFrame, as_of) -> DataFrame:
    """Records from ``sources.records.marked_records``; a date in a price cell says when the price will be known."""
    named = blanks_to_null(records).na.drop(how="all", subset=[c for c in _TOKYO_NAMES if c in records.columns])
    return named.withColumns(
        {
            "company_name": strip("company_name"),
            "price_range_expected_date": extract("price_range", _MONTH_DAY),
            "price_expected_date": extract("price", _MONTH_DAY),
            "price": thousands("price"),
            "ipo_date": infer_year("ipo_date", as_of, "/", roll_back=False),
            "exchange": labelled("Japan Stock Exchange - ", extract("ticker", _BRACKETED_WORD)),
            "ticker": replace_pattern("ticker", _BRACKETED_WORD),
        }
    ).drop(*_TOKYO_UNUSED)


def tokyo_ipo(raw: DataFrame) -> DataFrame:
    """Notes say when price or range are expected; the lowest price per ticker is kept."""
    range_due = F.col("price_range_expected_date").isNotNull()
    price_due = F.col("price_expected_date").isNotNull()
    noted = prepare(raw).withColumns(
        {
            "notes": F.when(price_due, labelled("Price expected ", "price_expected_date")).when(
                range_due, labelled("Price Range expected ", "price_range_expected_date")
            ),
            "price_range": F.when(~range_due, F.col("price_range")),
            "price": tolerant_double("price"),
        }
    )
    return lowest_price(noted)


def japan(raw: dict[str, DataFrame], as_of=None) -> DataFrame:
    """The exchange's calendar, priced from the other one by ticker and date."""
    extra = tokyo_ipo(raw["TokyoIPO"]).select(
        "ticker", "ipo_date", "price", "price_range", F.col("notes").alias("notes_extra"), "time_added"
    )
    base = jpx(raw["JPX"]).drop("time_added", "price", "price_range")
    joined = left(base, extra, ["ticker", "ipo_date"])
    return listings(joined.withColumn("notes", concat_blank("notes_extra", "notes")))


def shanghai(raw: DataFrame) -> DataFrame:
    """Name and ticker come in one field, the ticker last."""
    return prepare(raw, _SHANGHAI_DATES).withColumns(
        {
            "company_name": replace_pattern("new_share_name", r"\d+"),
            "ticker": extract("new_share_name", _TRAILING_FIGURES),
            "exchange": F.lit("Shanghai Stock Exchange"),
        }
    )


def shanghai_older(raw: DataFrame) -> DataFrame:
    """The older layout: the first word holds name and ticker."""
    word = extract("new_share_name", r"^(\w*)\s")
    return prepare(raw, _SHANGHAI_DATES).withColumns(
        {
            "company_name": replace_pattern(word, r"\w(\d*)\b"),
            "ticker": extract(word, r"\w(\d*)\b"),
            "exchange": F.lit("Shanghai Stock Exchange"),
        }
    )


def cninfo(raw: DataFrame) -> DataFrame:
    """Shares are given in ten thousands."""
    return prepare(raw, ["ipo_date", "release_date"]).withColumns(
        {"exchange": F.lit("Shenzhen Stock Exchange"), "shares_offered": scaled("shares_offered", 10_000)}
    )


def east_money(raw: DataFrame, as_of) -> DataFrame:
    """Dates come without a year, and a dash stands for nothing."""
    bare = placeholders_to_null(raw, ["-"])
    return prepare(bare, []).withColumn("ipo_date", infer_year("ipo_date", as_of))


def china(raw: dict[str, DataFrame], as_of) -> DataFrame:
    """Both mainland exchanges; the newest aggregator row per ticker supplies missing dates."""
    exchanges = stack([listings(shanghai(raw["Shanghai"])), listings(cninfo(raw["CNInfo"]))])
    dates = latest(east_money(raw["East Money"], as_of), ["ticker"], "time_added")
    dates = dates.where(F.col("ipo_date").isNotNull()).select("ticker", F.col("ipo_date").alias("_date"))
    joined = left(exchanges, dates, "ticker")
    filled = joined.withColumn("ipo_date", F.coalesce("ipo_date", "_date"))
    return latest(listings(filled), ["company_name", "ticker"], "time_added")


def aastocks(raw: DataFrame) -> DataFrame:
    price, price_range = split_price("price")
    return prepare(raw).withColumns(
        {
            "exchange": F.lit("Hong Kong Stock Exchange"),
            "ticker": extract("ticker", _HONG_KONG_TICKER),
            "price": price,
            "price_range": price_range,
        }
    )


def krx(raw: DataFrame) -> DataFrame:
    figures = {c: thousands(c) for c in ["shares_outstanding", "par_value", "price"]}
    return prepare(raw).withColumns({"exchange": F.lit("Korea Exchange"), **figures})


def asx_raw(lines: DataFrame) -> DataFrame:
    """``name - date`` headings as records."""
    parts = lines.withColumns(
        {"company_name": extract("listing_info", _ASX_NAME), "ipo_date": extract("listing_info", _ASX_DATE)}
    )
    return parse_date_columns(parts, ["ipo_date"]).withColumn("exchange", F.lit("Australian Stock Exchange"))


def asx(raw: DataFrame) -> DataFrame:
    """The earliest of the rows that differ in time columns only."""
    return earliest_ignoring(prepare(raw), [c for c in raw.columns if "time" in c], ["time_added"])


def twse(raw: DataFrame) -> DataFrame:
    return prepare(raw, _TWSE_DATES).withColumns(
        {"ticker": F.col("ticker").cast("string"), "exchange": F.lit("Taiwan Stock Exchange")}
    )


def sgx(raw: DataFrame) -> DataFrame:
    """The price is the trailing number; funds and columns that change daily go."""
    return (
        prepare(raw.where(~contains("company_name", " ETF")).drop(*_SGX_DAILY))
        .withColumns(
            {
                "exchange": labelled("Singapore Exchange - ", "market_segment", blank_when_null=True),
                "price": tolerant_double(extract("price", _SGX_PRICE)),
            }
        )
    )


def idx(raw: DataFrame) -> DataFrame:
    return prepare(raw, ["ipo_date", "delisting_date"]).withColumn(
        "exchange", labelled("Indonesia Stock Exchange - ", "market_segment", blank_when_null=True)
    )


def bursa_malaysia(raw: DataFrame) -> DataFrame:
    return prepare(raw, ["subscription_date_start", "subscription_date_end", "ipo_date"]).withColumns(
        {
            "exchange": labelled("Bursa Malaysia - ", "market_segment", blank_when_null=True),
            "price": tolerant_double(extract("price", _DECIMAL)),
        }
    )


def nse(raw: DataFrame) -> DataFrame:
    return prepare(raw)


def tokyo_layout() -> tuple[list[str], str]:
    """Cell names and record marker of the Tokyo page, for ``marked_records``."""
    return list(_TOKYO_NAMES), _TOKYO_MARKER
