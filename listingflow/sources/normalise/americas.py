"""United States and Canada."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ...functions.dates import as_of_stamp, dated_note, shift_days
from ...functions.numbers import double_columns, number_text, price_from_bounds, range_text, scaled, split_price, thousands
from ...functions.text import contains, contains_any, extract, is_not, remove_phrases, replace_text, strip, truncate
from ...operators.columns import rename, stack
from ...operators.dedupe import earliest_ignoring, keep_first, latest
from ...operators.history import close_out
from ...operators.joins import first_known
from .common import listings, prepare

# Patterns, labels and names of these sources.
_SCOOP_STATUS = r"(Priced|Postponed)"
_SCOOP_DATE = r"(\d{1,2}/\d{1,2}/\d{4})"
_SCOOP_VAGUE = "Week of"
_MILLION = 1_000_000
_FEED_NAMES = {
    "symbol": "ticker",
    "name": "company_name",
    "ipoDate": "ipo_date",
    "priceRangeLow": "price_range_low",
    "priceRangeHigh": "price_range_high",
}
_FEED_ASSETS = [(" Unit", "Units"), (" Right", "Rights"), (" Warrant", "Warrants")]
_TMX_NAMES = {"list_symbol": "ticker", "effective_date": "ipo_date", "details": "notes"}
_TMX_NO_COMPANY = [" ETF", " Fund"]
_TMX_NO_SECURITY = ["Debentures", "Warrants", "Rights", "Common share purchase warrants"]
_TORONTO_TYPES = [(" ETF", "ETF"), (" Fixed Income", "Fixed Income"), (" Private Pool", "Private Pool")]
_TSX_TICKER = r"\(([a-zA-Z\.,\s]*)\)"
_TSX_NAME = r"^([a-zA-Z\.\s\d&,\-]*)[\xa0|\(\+]"


def nyse(raw: DataFrame) -> DataFrame:
    """The date given is that of pricing; listing is the day after."""
    return prepare(raw).withColumns(
        {
            "ipo_date": shift_days("ipo_date", 1),
            "shares_offered": thousands("shares_offered"),
            "deal_size": thousands("deal_size"),
        }
    )


def nyse_withdrawn(raw: DataFrame) -> DataFrame:
    return prepare(raw, ["postponement_date"]).withColumns(
        {
            "notes": dated_note("Withdrawn on ", "postponement_date"),
            "exchange": F.lit("NYSE"),
            "shares_offered": thousands("shares_offered"),
        }
    )


def nasdaq(raw: DataFrame) -> DataFrame:
    price, price_range = split_price("price", "price_range" if "price_range" in raw.columns else None)
    return prepare(raw).withColumns(
        {"price_range": price_range, "price": price, "shares_offered": thousands("shares_offered")}
    )


def nasdaq_priced(raw: DataFrame) -> DataFrame:
    return prepare(raw).withColumn("shares_offered", thousands("shares_offered"))


def nasdaq_withdrawn(raw: DataFrame) -> DataFrame:
    return prepare(raw, ["announcement_date", "cancellation_date"]).withColumns(
        {
            "notes": dated_note("Withdrawn on ", "cancellation_date"),
            "status": F.lit("Withdrawn"),
            "exchange": F.lit("Nasdaq"),
            "shares_offered": thousands("shares_offered"),
        }
    )


def iposcoop(raw: DataFrame) -> DataFrame:
    """Status and date share a cell; rows with only a week are too vague to keep."""
    price, price_range = price_from_bounds("price_range_low", "price_range_high")
    dated = raw.where(~contains("ipo_date", _SCOOP_VAGUE)).withColumns(
        {
            "status": extract("ipo_date", _SCOOP_STATUS),
            "ipo_date": extract("ipo_date", _SCOOP_DATE),
            "price": price,
            "price_range": price_range,
            "exchange": F.lit("IPOScoop"),
            "shares_offered": scaled("shares_offered_mm", _MILLION),
        }
    )
    return prepare(dated)


def feed_raw(lines: DataFrame) -> DataFrame:
    """The delimited calendar feed under this library's names, with the asset type read from the company name."""
    asset = None
    for text, kind in _FEED_ASSETS:
        hit = contains("name", text)
        asset = F.when(hit, kind) if asset is None else asset.when(hit, kind)
    typed = double_columns(lines, ["priceRangeLow", "priceRangeHigh"])
    return rename(typed.withColumn("assetType", asset.otherwise("Shares")), _FEED_NAMES)


def feed(raw: DataFrame) -> DataFrame:
    """Zero bounds mean "not priced yet"; asset words are taken out of company names."""
    bounded = double_columns(prepare(raw), ["price_range_low", "price_range_high"])
    low, high = F.col("price_range_low"), F.col("price_range_high")
    price, _ = price_from_bounds(low, high, zero_is_unpriced=True)
    is_range = (low != 0) & (low != high)
    return bounded.withColumns(
        {
            "price": price,
            "price_range": F.when(is_range, range_text(number_text(low), number_text(high))),
            "exchange": replace_text("exchange", '"'),
            "assetType": F.when(contains("company_name", " ETF"), "ETF").otherwise(F.col("assetType")),
            "company_name": remove_phrases("company_name"),
        }
    )


def united_states(raw: dict[str, DataFrame], as_of, stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """The exchanges first; each aggregator only adds symbols not known yet.  ``stage`` may store the cleaned sources."""
    exchanges = [
        nasdaq(raw["Nasdaq"]),
        nasdaq_priced(raw["Nasdaq Priced"]),
        nasdaq_withdrawn(raw["Nasdaq Withdrawn"]),
        nyse(raw["NYSE"]),
        nyse_withdrawn(raw["NYSE Withdrawn"]),
    ]
    known = first_known(
        [
            stack([listings(e) for e in exchanges]),
            listings(iposcoop(raw["IPOScoop"])),
            listings(feed(raw["AlphaVantage"])),
        ],
        stage=stage,
    )
    return price_expected(latest(known, ["company_name", "ticker"], "time_added"), as_of)


def price_expected(df: DataFrame, as_of) -> DataFrame:
    """A listing later than the instant ``as_of`` is expected to be priced the day before."""
    ahead = F.col("ipo_date").cast("timestamp_ntz") >= as_of_stamp(as_of)
    note = dated_note("Price expected ", shift_days("ipo_date", -1))
    return df.withColumn("notes", F.when(ahead, note).otherwise(F.col("notes")))


def tmx(raw: DataFrame, as_of, note_length: int | None = None) -> DataFrame:
    """Feed files pile up; what is not in the newest file is closed, then the earliest copy of each row is kept.

    Rows are compared and filtered by their whole notes; ``note_length`` shortens them in the result.
    """
    closed = close_out(prepare(rename(raw, _TMX_NAMES), ["ipo_date", "entry_date", "modification_date"]), "identification", "file", as_of)
    first = earliest_ignoring(closed, ["time_added", "file"], ["entry_date", "file", "time_added"])
    kept = first.where(
        (F.col("change_type") == "New Listing")
        & ~contains_any("notes", ["transfer"], ignore_case=True)
        & ~contains_any("company_name", _TMX_NO_COMPANY)
        & ~contains_any("security_description", _TMX_NO_SECURITY)
    )
    return kept.withColumn("notes", truncate("notes", note_length)) if note_length else kept


def toronto_older(raw: dict[str, DataFrame]) -> DataFrame:
    """The older file layout of the three Toronto calendars: funds out, first row per company."""
    boards = stack(
        [
            raw["BS-TSX"].withColumn("exchange", F.lit("TSX")),
            raw["BS-TSXV"].withColumn("exchange", F.lit("TSX Venture")),
        ]
    )
    bulletin = raw["TSX"].withColumns(
        {
            "ticker": extract("company_name", _TSX_TICKER),
            "company_name": strip(extract("company_name", _TSX_NAME)),
            "exchange": F.lit("TSX"),
        }
    )
    boards = boards.where(~contains_any("company_name", [text for text, _ in _TORONTO_TYPES]))
    bulletin = bulletin.where(~contains("company_name", _TORONTO_TYPES[0][0]))
    # the bulletin's date column was never taken over under its canonical name
    tagged = [
        prepare(boards).withColumn("_turn", F.when(is_not("exchange", "TSX"), 1).otherwise(0)),
        prepare(bulletin).drop("ipo_date").withColumn("_turn", F.lit(2)),
    ]
    return keep_first(stack(tagged), ["company_name"], [("_turn", "asc")]).drop("_turn")
