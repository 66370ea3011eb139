"""Fixed schemas.  Raw sources may have any columns; everything downstream is held to these."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_DATE, _TS = T.DateType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Column names and order are the exchange format between the jobs.
LISTING = _schema(
    ("company_name", _S),
    ("ticker", _S),
    ("exchange", _S),
    ("ipo_date", _DATE),
    ("price", _D),
    ("price_range", _S),
    ("shares_offered", _D),
    ("status", _S),
    ("notes", _S),
    ("time_added", _TS),
    ("time_removed", _TS),
)

# Layout of the older file-based job: one poll stamp in place of the two history stamps.
LISTING_SINGLE_STAMP = _schema(
    *[(f.name, f.dataType) for f in LISTING.fields if f.name not in ("time_added", "time_removed")],
    ("time_checked", _TS),
)

ENTITY_MAP = _schema(
    ("company_name", _S),
    ("ticker", _S),
    ("exchange", _S),
    ("entityname", _S),
    ("iconum", _L),
    ("entity_id", _S),
    ("mapstatus", _S),
    ("similarityscore", _D),
    ("confidencescore", _D),
    ("countryname", _S),
    ("entitytypedescription", _S),
)

DEALS = _schema(
    ("iconum", _L),
    ("company_name", _S),
    ("master_deal", _L),
    ("cusip", _S),
    ("client_deal_id", _S),
    ("ticker", _S),
    ("exchange", _S),
    ("price", _D),
    ("min_offering_price", _D),
    ("max_offering_price", _D),
    ("announcement_date", _TS),
    ("pricing_date", _TS),
    ("trading_date", _TS),
    ("closing_date", _TS),
    ("deal_status", _S),
    ("last_updated_date_utc", _TS),
)

# A listing as the ticket jobs see it, then the ticket columns.
TICKET_LISTING = _schema(
    ("iconum", _S),
    ("cusip", _S),
    ("company_name", _S),
    ("ticker", _S),
    ("exchange", _S),
    ("ipo_date", _DATE),
    ("price", _D),
    ("price_range", _S),
    ("status", _S),
    ("notes", _S),
    ("last_checked", _TS),
    ("ipo_deal_id", _S),
    ("formatted_company_name", _S),
)
TICKET_COLUMNS = _schema(
    ("ticket_number", _L),
    ("ticket_link", _S),
    ("ticket_created", _TS),
    ("ticket_status", _S),
)
TICKET_LEDGER = T.StructType(TICKET_LISTING.fields + TICKET_COLUMNS.fields)

TICKET_FEED = _schema(("ticket_number", _L), ("status", _S), ("duplicate_of", _L))

HEALTH = _schema(("source", _S), ("result", _I), ("time_checked", _S))

SOURCE_REGISTRY = T.StructType(
    [
        T.StructField("source_name", _S),
        T.StructField("source_type", _S),
        T.StructField("exchange", _S),
        T.StructField("rank", _I),
        T.StructField("location", _S),
        T.StructField("url", _S),
        T.StructField("endpoint", _S),
        T.StructField("table_num", _I),
        T.StructField("table_elem", _S),
        T.StructField("table_title", _S),
        T.StructField("table_attrs", T.MapType(_S, _S)),
        T.StructField("row_elem", _S),
        T.StructField("cell_elem", T.ArrayType(_S)),
        T.StructField("header_elem", _S),
        T.StructField("header_attrs", T.MapType(_S, _S)),
        T.StructField("link_elem", _S),
        T.StructField("link_key", _S),
        T.StructField("parameters", T.MapType(_S, _S)),
        T.StructField("rename_columns", T.MapType(_S, _S)),
        T.StructField("columns", T.ArrayType(_S)),
        T.StructField("column_names_as_row", T.BooleanType()),
        T.StructField("file", _S),
        T.StructField("db_table_raw", _S),
        T.StructField("db_table", _S),
    ]
)
