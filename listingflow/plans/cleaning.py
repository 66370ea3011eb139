"""Queries over the column functions: text, numbers, dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import dates, numbers, text
from ..operators import entities, workitems
from .catalog import AS_OF, Tables, query

_SPACE = r"[\s\x{a0}]"

# --- text --------------------------------------------------------------------------------------------------------

_NAMES = r"""SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN upper(p_name) || ', Inc.' WHEN 1 THEN p_name || ' (Holdings) Limited' WHEN 2 THEN p_name || ' Ltd Group'
             WHEN 3 THEN '  ' || p_name || ' S.A.' WHEN 4 THEN p_name || ' A/S' WHEN 5 THEN p_name || '\\' || p_brand WHEN 6 THEN NULL ELSE p_name || ' sa' END AS name FROM {part}"""
_NAMES_SQL = _NAMES.replace("\\\\", "\\")


@query(
    "name_normalise",
    rf"""SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(name), '[.,()\\/]', '', 'g'), '\slimited$|\sltd|\ssa$|\sa/s$|\sinc$', '', 'g'), '^\s+|\s+$', '', 'g') AS usual,
         regexp_replace(regexp_replace(regexp_replace(lower(name), '[.,()\\/]', '', 'g'), '\s(limited|ltd|sa|as|inc)$', ''), '^\s+|\s+$', '', 'g') AS strict
         FROM ({_NAMES_SQL})""",
)
def name_normalise(t: Tables) -> DataFrame:
    return t.sql(_NAMES).select("p_partkey", text.normalise_company("name").alias("usual"), text.normalise_company("name", strict=True).alias("strict"))


_ASSETS = """SELECT p_partkey, p_name || CASE p_partkey % 6 WHEN 0 THEN ' Units' WHEN 1 THEN ' WARRANTS' WHEN 2 THEN ' ETF Trust' WHEN 3 THEN ' Class A Common Stock Rights'
             WHEN 4 THEN ' Warrants to purchase Ordinary Shares' ELSE '' END AS name FROM {part}"""


def _removals(expression: str, phrases: list[str]) -> str:
    for phrase in phrases:
        expression = f"regexp_replace({expression}, '{phrase}', '', 'gi')"
    return expression


@query("strip_list", f"SELECT p_partkey, {_removals('name', text.ASSET_PHRASES)} AS name FROM ({_ASSETS})")
def strip_list(t: Tables) -> DataFrame:
    return t.sql(_ASSETS).withColumn("name", text.remove_phrases("name"))


@query(
    "literal_replace",
    """SELECT p_partkey, replace(p_brand, '#', ' no. ') AS brand, regexp_replace(p_name, 'RING', 'circle', 'gi') AS name, replace(p_name, 'RING', 'x') AS same FROM part""",
)
def literal_replace(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        text.replace_text("p_brand", "#", " no. ").alias("brand"),
        text.replace_text("p_name", "RING", "circle", ignore_case=True).alias("name"),
        text.replace_text("p_name", "RING", "x").alias("same"),
    )


@query(
    "regex_extract",
    r"""SELECT c_custkey, nullif(regexp_extract(c_name, '(\d+)$', 1), '') AS number, nullif(regexp_extract(c_mktsegment, '^([AB]\w*)', 1), '') AS segment,
        regexp_replace(c_name, '\d+', '', 'g') AS bare FROM customer""",
)
def regex_extract(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        text.extract("c_name", r"(\d+)$").alias("number"),
        text.extract("c_mktsegment", r"^([AB]\w*)").alias("segment"),
        text.replace_pattern("c_name", r"\d+").alias("bare"),
    )


@query(
    "document_words",
    r"""SELECT doc_id, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS stripped, left(lang || '-' || source, 5) AS short_label, nullif(regexp_extract(text, '(\d+)', 1), '') AS first_number,
        lower(lang) || '/' || upper(source) AS label FROM documents""",
)
def document_words(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        F.length(text.strip("text")).alias("stripped"),
        text.truncate(F.concat("lang", F.lit("-"), "source"), 5).alias("short_label"),
        text.extract("text", r"([0-9]+)").alias("first_number"),
        F.concat(F.lower("lang"), F.lit("/"), F.upper("source")).alias("label"),
    )


_CELLS = """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN chr(160) || o_orderpriority || ' ' WHEN 3 THEN '-' WHEN 4 THEN chr(9) || 'x y' || chr(10) ELSE NULL END AS cell FROM {orders}"""


@query(
    "blank_to_null",
    """SELECT o_orderkey, CASE WHEN trim(cell) = '' THEN NULL ELSE cell END AS not_blank, nullif(cell, '-') AS no_dash,
       trim(cell, ' ' || chr(160) || chr(9) || chr(10)) AS stripped, coalesce(cell, '') || '_' || coalesce(CAST(o_orderkey AS STRING), '') AS joined
       FROM (""" + _CELLS + ")",
)
def blank_to_null(t: Tables) -> DataFrame:
    return t.sql(_CELLS).select(
        "o_orderkey",
        text.blank_to_null("cell").alias("not_blank"),
        text.null_if_in("cell", ["-"]).alias("no_dash"),
        text.strip("cell").alias("stripped"),
        text.concat_blank("cell", F.lit("_"), F.col("o_orderkey").cast("string")).alias("joined"),
    )


@query(
    "client_key",
    """SELECT c_custkey, c_name || '_' || coalesce(nullif(CAST(c_nationkey AS STRING), '3'), '') || '_' || c_mktsegment || '_x' AS client_id,
       c_name AS company_name, nullif(CAST(c_nationkey AS STRING), '3') AS ticker, c_mktsegment || '_x' AS exchange FROM customer""",
)
def client_key(t: Tables) -> DataFrame:
    made = t.sql("SELECT c_custkey, c_name, nullif(CAST(c_nationkey AS STRING), '3') AS nation, c_mktsegment || '_x' AS segment FROM {customer}")
    keyed = made.select("c_custkey", entities.client_key("c_name", "nation", "segment").alias("client_id"))
    return entities.split_client_key(keyed, "client_id")


@query(
    "list_to_text",
    """SELECT page_id, array_to_string(string_split(url, '/'), ', ') AS steps FROM pages""",
)
def list_to_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.join_list(F.split("url", "/")).alias("steps"))


# --- numbers -----------------------------------------------------------------------------------------------------

_FIGURES = """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN CAST(o_totalprice AS STRING) WHEN 1 THEN '1,234,' || lpad(CAST(o_custkey % 1000 AS STRING), 3, '0')
              WHEN 2 THEN 'n/a' WHEN 3 THEN '900719925474' || lpad(CAST(o_custkey % 10000 AS STRING), 4, '0') WHEN 4 THEN ' ' || CAST(o_custkey AS STRING) || ' ' WHEN 5 THEN '12d' ELSE '-' END AS cell FROM {orders}"""


@query(
    "tolerant_numeric",
    f"""SELECT o_orderkey, TRY_CAST(trim(cell) AS DOUBLE) AS plain, TRY_CAST(trim(replace(cell, ',', '')) AS DOUBLE) AS separated,
        TRY_CAST(trim(cell) AS DOUBLE) * 1000000 AS millions, coalesce(TRY_CAST(CASE WHEN regexp_matches(trim(cell), '^[0-9]+$') THEN trim(cell) END AS BIGINT), CAST(trunc(TRY_CAST(trim(cell) AS DOUBLE)) AS BIGINT), 0) AS whole FROM ({_FIGURES})""",
)
def tolerant_numeric(t: Tables) -> DataFrame:
    return t.sql(_FIGURES).select(
        "o_orderkey",
        numbers.tolerant_double("cell").alias("plain"),
        numbers.thousands("cell").alias("separated"),
        numbers.scaled("cell", 1_000_000).alias("millions"),
        numbers.nullable_int("cell").alias("whole"),
    )


@query(
    "ratio_and_rounding",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_quantity - 7, 0) AS price, round_even(l_quantity / 8, 2) AS eighth FROM lineitem""",
)
def ratio_and_rounding(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numbers.ratio("l_extendedprice", F.col("l_quantity") - 7).alias("price"),
        numbers.round_half_even(F.col("l_quantity") / 8).alias("eighth"),
    )


_PRICES = """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '10 - 12' WHEN 1 THEN '1 5' WHEN 2 THEN CAST(o_custkey AS STRING) || '.5' WHEN 3 THEN 'tbd' END AS price,
             CASE WHEN o_orderkey % 3 = 0 THEN 'earlier' END AS price_range FROM {orders}"""


@query(
    "price_range_split",
    f"""SELECT o_orderkey, CASE WHEN price LIKE '%-%' THEN NULL ELSE TRY_CAST(replace(price, ' ', '') AS DOUBLE) END AS price,
        CASE WHEN price LIKE '%-%' THEN price ELSE price_range END AS price_range FROM ({_PRICES})""",
)
def price_range_split(t: Tables) -> DataFrame:
    made = t.sql(_PRICES)
    price, price_range = numbers.split_price("price", "price_range")
    return made.select("o_orderkey", price.alias("price"), price_range.alias("price_range"))


_BOUNDS = "SELECT o_orderkey, nullif(CAST(o_orderkey % 4 AS DOUBLE), 3) AS low, CAST(o_custkey % 3 AS DOUBLE) AS high FROM {orders}"


@query(
    "price_from_bounds",
    f"""SELECT o_orderkey, CASE WHEN low = high THEN high END AS price, CASE WHEN low <> high THEN CAST(low AS STRING) || ' - ' || CAST(high AS STRING) END AS price_range,
        CASE WHEN low = high AND low <> 0 THEN high END AS known_price, CASE WHEN low <> high AND low <> 0 THEN CAST(low AS STRING) || ' - ' || CAST(high AS STRING) END AS known_range FROM ({_BOUNDS})""",
)
def price_from_bounds(t: Tables) -> DataFrame:
    price, price_range = numbers.price_from_bounds("low", "high")
    known_price, known_range = numbers.price_from_bounds("low", "high", zero_is_unpriced=True)
    return t.sql(_BOUNDS).select(
        "o_orderkey", price.alias("price"), price_range.alias("price_range"), known_price.alias("known_price"), known_range.alias("known_range")
    )


# --- dates -------------------------------------------------------------------------------------------------------

_LOOSE_DATES = [
    ("03/05/2020 09:30", "2020-03-05", "2020-05-03"),
    ("Monday, March 2, 2020", "2020-03-02", "2020-03-02"),
    ("2020/3/5 10:00", "2020-03-05", "2020-03-05"),
    ("March 2020", "2020-03-01", "2020-03-01"),
    ("Mar 5 2020 4:00 PM", "2020-03-05", "2020-03-05"),
    ("5th March 2020", "2020-03-05", "2020-03-05"),
    ("Sept 5, 2020", "2020-09-05", "2020-09-05"),
    ("Mar. 5, 2020", "2020-03-05", "2020-03-05"),
    ("2020-03-05T10:00:00Z", "2020-03-05", "2020-03-05"),
    ("01/02/99", "1999-01-02", "1999-02-01"),
    ("01/02/68", "2068-01-02", "2068-02-01"),
]
_LOOSE_TEXT = " ".join(f"WHEN {i} THEN '{text}'" for i, (text, *_) in enumerate(_LOOSE_DATES))
_TEXT_DATES = f"""SELECT o_orderkey, CASE WHEN o_orderkey % 12 = 5 THEN CASE o_custkey % {len(_LOOSE_DATES)} {_LOOSE_TEXT} END ELSE CASE o_orderkey % 6
                 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
                 WHEN 1 THEN CAST(day(o_orderdate) AS STRING) || '/' || CAST(month(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING)
                 WHEN 2 THEN ' ' || CAST(month(o_orderdate) AS STRING) || '-' || CAST(day(o_orderdate) AS STRING) || '-' || CAST(year(o_orderdate) AS STRING)
                 WHEN 3 THEN 'Week of ' || CAST(CAST(o_orderdate AS DATE) AS STRING)
                 WHEN 4 THEN '2001-02-30' END END AS cell FROM {{orders}}"""


def _loose(place: int) -> str:
    """What the texts of another layout mean, month first (1) or day first (2)."""
    return " ".join(f"WHEN '{row[0]}' THEN TIMESTAMP '{row[place]}'" for row in _LOOSE_DATES)


def _read(first: str, second: str) -> str:
    """A two-number date read by one convention, then by the other."""
    return f"coalesce(try_strptime(trim(cell), '{first}'), try_strptime(trim(cell), '{second}'))"


@query(
    "date_parse",
    f"""SELECT o_orderkey, CAST(CASE cell {_loose(1)} ELSE CASE WHEN regexp_matches(trim(cell), '^[0-9][0-9][0-9][0-9]-') THEN try_strptime(cell, '%Y-%m-%d') WHEN cell LIKE '%/%' THEN {_read('%m/%d/%Y', '%d/%m/%Y')} ELSE {_read('%m-%d-%Y', '%d-%m-%Y')} END END AS DATE) AS month_first,
        CAST(CASE cell {_loose(2)} ELSE CASE WHEN regexp_matches(trim(cell), '^[0-9][0-9][0-9][0-9]-') THEN try_strptime(cell, '%Y-%m-%d') WHEN cell LIKE '%/%' THEN {_read('%d/%m/%Y', '%m/%d/%Y')} ELSE {_read('%d-%m-%Y', '%m-%d-%Y')} END END AS DATE) AS day_first FROM ({_TEXT_DATES})""",
)
def date_parse(t: Tables) -> DataFrame:
    return dates.parse_dates(t.sql(_TEXT_DATES), {"month_first": ("cell", False), "day_first": ("cell", True)}).drop("cell")


_MONTH_DAY = "SELECT o_orderkey, lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '-' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS cell FROM {orders}"


@query(
    "year_inference",
    f"""WITH a AS (SELECT o_orderkey, CAST(try_strptime(cell || '-2001', '%m-%d-%Y') AS DATE) AS d FROM ({_MONTH_DAY}))
        SELECT o_orderkey, d AS this_year, CASE WHEN d > TIMESTAMP '2001-03-10 08:00:00' + INTERVAL 6 MONTH THEN CAST(d - INTERVAL 1 YEAR AS DATE) ELSE d END AS nearest FROM a""",
)
def year_inference(t: Tables) -> DataFrame:
    now = "2001-03-10 08:00:00"
    return t.sql(_MONTH_DAY).select(
        "o_orderkey", dates.infer_year("cell", now, roll_back=False).alias("this_year"), dates.infer_year("cell", now).alias("nearest")
    )


@query(
    "date_shift_note",
    """WITH a AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS d FROM orders)
       SELECT o_orderkey, d + 1 AS next_day, CAST(d AS STRING) AS iso, 'Withdrawn on ' || CAST(d AS STRING) AS note, CASE WHEN d > TIMESTAMP '2000-06-15 12:00:00' THEN d END AS ahead FROM a""",
)
def date_shift_note(t: Tables) -> DataFrame:
    d = F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", d.alias("d")).select(
        "o_orderkey",
        dates.shift_days("d", 1).alias("next_day"),
        dates.iso_text("d").alias("iso"),
        dates.dated_note("Withdrawn on ", "d").alias("note"),
        dates.null_unless_after("d", AS_OF).alias("ahead"),
    )


@query(
    "drop_time_zone",
    """SELECT event_id, ts FROM events""",
)
def drop_time_zone(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.drop_zone(dates.as_instant("ts")).alias("ts"))


@query(
    "status_by_asof",
    """WITH a AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE o_orderstatus WHEN 'F' THEN 'Withdrawn' WHEN 'P' THEN ' Priced ' END AS s FROM orders)
       SELECT o_orderkey, trim(CASE WHEN d > DATE '2000-06-15' THEN 'Upcoming ' || coalesce(s, '') WHEN d = DATE '2000-06-15' THEN 'Listing Today' ELSE s END) AS status FROM a""",
)
def status_by_asof(t: Tables) -> DataFrame:
    from ..sources.normalise.final import listing_status

    made = t.sql("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ipo_date, CASE o_orderstatus WHEN 'F' THEN 'Withdrawn' WHEN 'P' THEN ' Priced ' END AS status FROM {orders}")
    return made.select("o_orderkey", listing_status(AS_OF).alias("status"))


@query(
    "priority_bucket",
    """SELECT o_orderkey, CASE WHEN o_orderdate <= TIMESTAMP '2000-06-18 12:00:00' THEN 30 ELSE 20 END AS i_priority FROM orders""",
)
def priority_bucket(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", workitems.priority(F.col("o_orderdate"), AS_OF).alias("i_priority"))
