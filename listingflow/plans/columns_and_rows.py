"""Queries over the general operators: projections, filters, joins, aggregates, de-duplication, sorting, history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import schemas
from ..functions import dates, ids, numbers, text
from ..operators import aggregates, columns, dedupe, filters, history, joins, ordering, registry
from ..session import run_folder
from .catalog import AS_OF, EVENTS_AS_OF, Tables, query
from .frames import LISTING

# --- projections -------------------------------------------------------------------------------------------------


@query(
    "conform_union",
    """
    SELECT c_name AS company_name, CAST(NULL AS STRING) AS ticker, c_mktsegment AS exchange, CAST(NULL AS DATE) AS ipo_date,
           c_acctbal AS price, CAST(NULL AS STRING) AS price_range, CAST(NULL AS DOUBLE) AS shares_offered,
           CAST(NULL AS STRING) AS status, CAST(NULL AS STRING) AS notes, CAST(NULL AS TIMESTAMP) AS time_added,
           CAST(NULL AS TIMESTAMP) AS time_removed FROM customer
    UNION ALL SELECT s_name, CAST(s_suppkey AS STRING), NULL, NULL, s_acctbal, NULL, NULL, NULL, NULL, NULL, NULL FROM supplier
    UNION ALL SELECT p_name, p_brand, p_type, NULL, NULL, CAST(p_retailprice AS STRING), p_size, NULL, NULL, NULL, NULL FROM part
    """,
)
def conform_union(t: Tables) -> DataFrame:
    return columns.stack(
        [
            t.customer.select(F.col("c_name").alias("company_name"), F.col("c_mktsegment").alias("exchange"), F.col("c_acctbal").alias("price"), "c_nationkey"),
            t.supplier.select(F.col("s_name").alias("company_name"), F.col("s_suppkey").alias("ticker"), F.col("s_acctbal").cast("string").alias("price")),
            t.part.select(
                F.col("p_name").alias("company_name"),
                F.col("p_brand").alias("ticker"),
                F.col("p_type").alias("exchange"),
                F.col("p_retailprice").cast("string").alias("price_range"),
                F.col("p_size").alias("shares_offered"),
            ),
        ],
        schemas.LISTING,
    )


@query(
    "union_missing_columns",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
)
def union_missing_columns(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return columns.stack([a, b])


@query(
    "column_names",
    """SELECT s_name AS company_name, s_suppkey AS ticker, s_acctbal AS change_percent, 'Supplier' AS kind FROM supplier""",
)
def column_names(t: Tables) -> DataFrame:
    shown = t.supplier.withColumnsRenamed({"s_suppkey": "Ticker", "s_name": "Company Name", "s_acctbal": "Change (percent)+?"})
    named = columns.database_names(columns.drop(shown, ["s_nationkey", "not there"]))
    named = named.withColumn("kind", F.lit("Supplier"))
    return columns.keep_existing(columns.first_column(named, "kind"), ["company_name", "isin", "ticker", "change_percent", "kind"])


@query(
    "upper_headers",
    """SELECT p_partkey AS "P_PARTKEY", p_size AS "I_PRIORITY", p_name AS "P_NAME" FROM part""",
)
def upper_headers(t: Tables) -> DataFrame:
    named = columns.rename(t.part.select("p_partkey", "p_name", "p_size"), {"p_size": "i_priority", "absent": "x"})
    return columns.first_column(columns.upper_names(named), "I_PRIORITY")


@query(
    "conditional_update",
    """SELECT o_orderkey,
              CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_orderstatus = 'F' THEN 'final' ELSE o_orderpriority END AS label,
              CASE WHEN o_totalprice > 300000 THEN NULL ELSE o_totalprice END AS price,
              CASE WHEN o_totalprice > 300000 THEN NULL ELSE o_orderstatus END AS status,
              CASE WHEN o_totalprice > 300000 THEN o_totalprice END AS big_price
       FROM orders""",
)
def conditional_update(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("label"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    large = F.col("price") > 300000
    df = columns.update_where(df, F.col("status") == "F", {"label": F.lit("final")})
    df = columns.update_where(df, large, {"label": F.lit("large"), "big_price": F.col("price")})
    return columns.null_where(df, large, ["price", "status"])


@query(
    "fill_and_blank",
    """WITH b AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus,
                  CASE WHEN o_orderkey % 4 = 0 THEN '-' WHEN o_orderkey % 4 = 1 THEN '  ' WHEN o_orderkey % 4 = 2 THEN 'nan' ELSE o_orderpriority END AS c
                  FROM orders)
       SELECT o_orderkey, coalesce(priority, o_orderstatus) AS filled, coalesce(priority, 'none') AS constant,
              CASE WHEN c IN ('-', '  ', 'nan') THEN '' ELSE c END AS cleaned, 'order ' || priority AS noted
       FROM b""",
)
def fill_and_blank(t: Tables) -> DataFrame:
    made = t.sql(
        """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS filled, nullif(o_orderpriority, '5-LOW') AS constant, o_orderstatus,
           'order ' || nullif(o_orderpriority, '5-LOW') AS noted,
           CASE WHEN o_orderkey % 4 = 0 THEN '-' WHEN o_orderkey % 4 = 1 THEN '  ' WHEN o_orderkey % 4 = 2 THEN 'nan' ELSE o_orderpriority END AS cleaned
           FROM {orders}"""
    )
    filled = columns.fill_from(made, {"filled": "o_orderstatus"}).na.fill({"constant": "none"})
    cleaned = columns.placeholders_to_null(columns.blanks_to_null(filled, ["cleaned"]), ["-", "nan"], ["cleaned"])
    return columns.nulls_to_blank(cleaned, ["filled", "constant", "cleaned"]).select("o_orderkey", "filled", "constant", "cleaned", "noted")


@query(
    "shift_repair",
    """WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity,
                  CASE WHEN l_returnflag = 'A' THEN 'First Price: ' || CAST(l_quantity AS STRING) ELSE 'Volume: ' || CAST(l_quantity AS STRING) END AS a,
                  CASE WHEN l_returnflag <> 'A' THEN 'First Price: 1' END AS b FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN a LIKE 'First Price%' THEN NULL ELSE a END AS a,
              CASE WHEN a LIKE 'First Price%' THEN a ELSE b END AS b FROM b""",
)
def shift_repair(t: Tables) -> DataFrame:
    made = t.sql(
        """SELECT l_orderkey, l_linenumber, l_quantity,
           CASE WHEN l_returnflag = 'A' THEN 'First Price: ' || CAST(l_quantity AS STRING) ELSE 'Volume: ' || CAST(l_quantity AS STRING) END AS a,
           CASE WHEN l_returnflag <> 'A' THEN 'First Price: 1' END AS b FROM {lineitem}"""
    )
    return columns.move_when_prefixed(made, "a", "b", "First Price")


@query(
    "rowwise_total",
    """SELECT o_orderkey, coalesce(nullif(o_orderkey % 3, 0), 0) + coalesce(nullif(o_orderkey % 5, 0), 0) AS total_tasks FROM orders""",
)
def rowwise_total(t: Tables) -> DataFrame:
    made = t.sql("SELECT o_orderkey, nullif(o_orderkey % 3, 0) AS high_priority, nullif(o_orderkey % 5, 0) AS `Low Priority` FROM {orders}")
    return columns.row_total(made, "priority").select("o_orderkey", "total_tasks")


@query(
    "grand_total",
    """SELECT sum(coalesce(nullif(o_orderkey % 3, 0), 0) + o_orderkey % 5) AS total_tasks FROM orders""",
)
def grand_total(t: Tables) -> DataFrame:
    made = t.sql("SELECT nullif(o_orderkey % 3, 0) AS high_priority, o_orderkey % 5 AS low_priority FROM {orders}")
    return aggregates.grand_total(columns.row_total(made, "priority"), "total_tasks")


# --- filters -----------------------------------------------------------------------------------------------------


@query(
    "text_filters",
    """SELECT p_partkey, p_name, p_brand FROM part
       WHERE (contains(p_name, 'ring') AND NOT starts_with(p_name, 'old')) OR regexp_matches(p_name, '(?i)GEAR|Bolt')""",
)
def text_filters(t: Tables) -> DataFrame:
    name = F.col("p_name")
    ring = text.contains(name, "ring") & ~text.starts_with(name, "old")
    return t.part.where(ring | text.contains_any(name, ["GEAR", "Bolt"], ignore_case=True)).select("p_partkey", "p_name", "p_brand")


@query(
    "null_keeping_filters",
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus FROM orders
       WHERE nullif(o_orderpriority, '5-LOW') IS DISTINCT FROM '1-URGENT' AND o_orderstatus IN ('O', 'P')""",
)
def null_keeping_filters(t: Tables) -> DataFrame:
    made = t.sql("SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus FROM {orders}")
    return filters.where_all(made, [text.is_not("priority", "1-URGENT"), F.col("o_orderstatus").isin("O", "P")])


@query(
    "date_filters",
    f"""WITH b AS (SELECT o_orderkey, o_orderdate, max(l_shipdate) AS shipped FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ordered, CAST(shipped AS DATE) AS shipped,
               o_orderdate > TIMESTAMP '2000-06-08' AS recent, CAST(CAST(o_orderdate AS DATE) AS STRING) >= '2000-01-01' AS since
        FROM b WHERE CAST(o_orderdate AS DATE) >= DATE '2000-06-15' OR CAST(shipped AS DATE) >= DATE '2000-06-15'""",
)
def date_filters(t: Tables) -> DataFrame:
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
    df = t.orders.select("o_orderkey", "o_orderdate").join(shipped, "o_orderkey", "left")
    return df.where(dates.any_on_or_after(["o_orderdate", "shipped"], AS_OF)).select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("ordered"),
        F.col("shipped").cast("date").alias("shipped"),
        dates.within_days("o_orderdate", AS_OF, 7).alias("recent"),
        dates.text_on_or_after(dates.iso_text("o_orderdate"), "2000-01-01").alias("since"),
    )


@query(
    "recent_deals",
    """SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_shipdate AS DATE) AS shipped FROM lineitem WHERE l_shipdate > TIMESTAMP '2000-06-08'""",
)
def recent_deals(t: Tables) -> DataFrame:
    return t.lineitem.where(dates.within_days("l_shipdate", AS_OF, 7)).select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").cast("date").alias("shipped")
    )


@query(
    "drop_null_rows",
    """WITH b AS (SELECT nullif(o_orderkey % 2, 0) AS a, nullif(o_orderkey % 3, 0) AS b, nullif(o_orderkey % 5, 0) AS c FROM orders)
       SELECT 'any' AS rule, a, b, c FROM b WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL
       UNION ALL SELECT 'all', a, b, c FROM b WHERE NOT (a IS NULL AND b IS NULL AND c IS NULL)
       UNION ALL SELECT 'subset', a, b, c FROM b WHERE b IS NOT NULL""",
)
def drop_null_rows(t: Tables) -> DataFrame:
    made = t.sql("SELECT nullif(o_orderkey % 2, 0) AS a, nullif(o_orderkey % 3, 0) AS b, nullif(o_orderkey % 5, 0) AS c FROM {orders}")
    rules = {"any": filters.drop_null_rows(made), "all": filters.drop_null_rows(made, "all"), "subset": filters.drop_null_rows(made, subset=["b"])}
    return columns.stack([df.select(F.lit(rule).alias("rule"), "*") for rule, df in rules.items()])


@query(
    "success_messages",
    """SELECT doc_id FROM documents WHERE contains(text, 'that')""",
)
def success_messages(t: Tables) -> DataFrame:
    return filters.messages_with(t.documents, "text", "that", "doc_id")


_BATCHES = """SELECT event_id, user_id, event_type, replace(CAST(CAST(ts AS DATE) AS STRING), '-', '') || ' ' || event_type AS file,
              CASE WHEN event_type = 'error' THEN ts END AS time_removed FROM {events}"""


@query(
    "latest_batch",
    f"""WITH b AS ({_BATCHES}) SELECT event_id, user_id, file FROM b WHERE left(file, 8) = left((SELECT max(file) FROM b), 8)""",
)
def latest_batch(t: Tables) -> DataFrame:
    return filters.latest_batch(t.sql(_BATCHES), "file").select("event_id", "user_id", "file")


@query(
    "latest_batch_closeout",
    f"""WITH b AS ({_BATCHES}), cur AS (SELECT DISTINCT user_id FROM b WHERE left(file, 8) = left((SELECT max(file) FROM b), 8))
        SELECT event_id, user_id, event_type, file,
               CASE WHEN user_id NOT IN (SELECT user_id FROM cur) AND time_removed IS NULL THEN TIMESTAMP '{EVENTS_AS_OF}' ELSE time_removed END AS time_removed
        FROM b""",
)
def latest_batch_closeout(t: Tables) -> DataFrame:
    return history.close_out(t.sql(_BATCHES), "user_id", "file", EVENTS_AS_OF)


# --- joins -------------------------------------------------------------------------------------------------------


@query(
    "multiway_lookup",
    """SELECT o_orderkey, c_name, n_name, r_name, p_name, s_name, l_quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 4 JOIN region ON n_regionkey = r_regionkey
       LEFT JOIN part ON l_partkey = p_partkey AND p_size > 25 LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def multiway_lookup(t: Tables) -> DataFrame:
    c = F.col
    return joins.lookup_chain(
        t.lineitem,
        [
            (t.orders, c("l_orderkey") == c("o_orderkey"), "inner"),
            (t.customer, c("o_custkey") == c("c_custkey"), "inner"),
            (t.nation, (c("c_nationkey") == c("n_nationkey")) & (c("n_regionkey") != 4), "inner"),
            (t.region, c("n_regionkey") == c("r_regionkey"), "inner"),
            (t.part, (c("l_partkey") == c("p_partkey")) & (c("p_size") > 25), "left"),
            (t.supplier, c("l_suppkey") == c("s_suppkey"), "left"),
        ],
    ).select("o_orderkey", "c_name", "n_name", "r_name", "p_name", "s_name", "l_quantity")


@query(
    "left_join_by_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_retailprice FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def left_join_by_key(t: Tables) -> DataFrame:
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
    return joins.left(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), parts, "l_partkey")


@query(
    "composite_left_join",
    """SELECT o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS d, o.o_totalprice AS price, x.price AS price_tk
       FROM orders o LEFT JOIN (SELECT l_orderkey, CAST(l_shipdate AS DATE) - 30 AS d, max(l_extendedprice) AS price FROM lineitem GROUP BY ALL) x
       ON o.o_orderkey = x.l_orderkey AND CAST(o.o_orderdate AS DATE) = x.d""",
)
def composite_left_join(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("date").alias("d"), F.col("o_totalprice").alias("price"))
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("k"), F.date_sub("l_shipdate", 30).alias("d")).agg(F.max("l_extendedprice").alias("price"))
    return joins.left(a, b, ["k", "d"], ("", "_tk"))


@query(
    "natural_join",
    """SELECT c_custkey, c_nationkey AS nationkey, c_mktsegment, s_suppkey FROM customer LEFT JOIN (SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey""",
)
def natural_join(t: Tables) -> DataFrame:
    a = t.customer.select("c_custkey", F.col("c_nationkey").alias("nationkey"), "c_mktsegment")
    b = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.min("s_suppkey").alias("s_suppkey"))
    return joins.natural_left(a, b)


_NEW_A = "SELECT CASE WHEN s_nationkey <> 3 THEN 'T*' || CAST(s_suppkey AS STRING) END AS ticker, s_name AS company_name FROM {supplier}"
_NEW_B = "SELECT CASE WHEN c_nationkey <> 5 THEN 'T.' || CAST(c_custkey AS STRING) END AS ticker, c_name AS company_name FROM {customer}"


@query(
    "add_only_new",
    f"""WITH a AS ({_NEW_A}), b AS ({_NEW_B})
        SELECT ticker, company_name FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE regexp_replace(a.ticker, '[.''*]', '', 'g') IS NOT DISTINCT FROM regexp_replace(b.ticker, '[.''*]', '', 'g'))""",
)
def add_only_new(t: Tables) -> DataFrame:
    return joins.add_only_new(t.sql(_NEW_A), t.sql(_NEW_B))


@query(
    "set_difference",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def set_difference(t: Tables) -> DataFrame:
    return joins.only_in_left(t.customer.select("c_custkey", "c_name"), t.orders.where("o_totalprice > 400000").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


_SIDE_A = "SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS k, c_name AS name FROM {customer}"
_SIDE_B = "SELECT CASE WHEN o_custkey % 4 <> 0 THEN o_custkey + 500 END AS k, o_orderstatus AS name, o_orderkey FROM {orders}"


@query(
    "full_outer_join",
    f"""SELECT coalesce(a.k, b.k) AS k, a.name AS name_left, b.name AS name_right, b.o_orderkey FROM ({_SIDE_A}) a FULL JOIN ({_SIDE_B}) b ON a.k = b.k""",
)
def full_outer_join(t: Tables) -> DataFrame:
    return joins.full_outer(t.sql(_SIDE_A), t.sql(_SIDE_B), "k")


_OR_L = "SELECT c_custkey AS k1, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey + 10 END AS k2, c_name FROM {customer}"
_OR_R = "SELECT l_orderkey AS r1, CASE WHEN l_linenumber <> 2 THEN l_orderkey + l_linenumber + 5 END AS r2, l_quantity FROM {lineitem}"


@query(
    "or_join",
    f"""SELECT k1, k2, c_name, r1, r2, l_quantity FROM ({_OR_L}) a LEFT JOIN ({_OR_R}) b ON a.k1 = b.r1 OR a.k2 = b.r2""",
)
def or_join(t: Tables) -> DataFrame:
    return joins.left_on_either(t.sql(_OR_L), t.sql(_OR_R), [("k1", "r1"), ("k2", "r2")])


@query(
    "alt_key_union",
    f"""SELECT o.*, c.c_mktsegment AS segment FROM (SELECT o_orderkey, o_custkey AS ticker, o_custkey * 2 AS cusip FROM orders) o
        JOIN customer c ON c.c_custkey = o.ticker
        UNION ALL SELECT o.*, c.c_mktsegment FROM (SELECT o_orderkey, o_custkey AS ticker, o_custkey * 2 AS cusip FROM orders) o
        JOIN customer c ON c.c_custkey = o.cusip""",
)
def alt_key_union(t: Tables) -> DataFrame:
    tickets = t.customer.select(F.col("c_custkey").alias("ticker"), F.col("c_custkey").alias("cusip"), F.col("c_mktsegment").alias("segment"))
    listings = t.orders.select("o_orderkey", F.col("o_custkey").alias("ticker"), (F.col("o_custkey") * 2).alias("cusip"))
    return joins.union_of_matches(tickets, listings, ["ticker", "cusip"], ["segment"])


@query(
    "fallback_fill",
    """SELECT o_orderkey, CAST(o_custkey AS STRING) AS who, coalesce(nullif(o_orderstatus, 'P'), s_name) AS a, nullif(o_orderpriority, '5-LOW') AS b
       FROM orders LEFT JOIN supplier ON o_custkey = s_suppkey""",
)
def fallback_fill(t: Tables) -> DataFrame:
    base = t.sql("SELECT o_orderkey, CAST(o_custkey AS STRING) AS who, nullif(o_orderstatus, 'P') AS a, nullif(o_orderpriority, '5-LOW') AS b FROM {orders}")
    lookup = t.supplier.select(F.col("s_suppkey").cast("string").alias("who"), "s_name")
    return joins.enrich_with_fallback(base, lookup, "who", {"a": "s_name"})


@query(
    "aligned_aggregates",
    """SELECT coalesce(a.k, b.k) AS k, a.tickers, b.exchanges FROM
       (SELECT l_orderkey AS k, count(DISTINCT l_partkey) AS tickers FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a FULL JOIN
       (SELECT l_orderkey AS k, count(DISTINCT l_suppkey) AS exchanges FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON a.k = b.k""",
)
def aligned_aggregates(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("k", F.col("l_orderkey"))
    flag = F.col("l_returnflag")
    return aggregates.distinct_counts_where(lines, "k", {"tickers": (flag == "A", "l_partkey"), "exchanges": (flag == "R", "l_suppkey")})


@query(
    "recent_semi_join",
    """SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS day FROM events WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 5)""",
)
def recent_semi_join(t: Tables) -> DataFrame:
    days = t.events.select("event_id", dates.iso_text("ts").alias("day"))
    return joins.semi(days, ordering.top_distinct(days, "day", 5), "day")


# --- aggregates --------------------------------------------------------------------------------------------------


@query(
    "concat_distinct",
    """SELECT l_orderkey, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS p_brand,
              string_agg(DISTINCT nullif(l_returnflag, 'N'), ', ' ORDER BY nullif(l_returnflag, 'N')) AS l_returnflag
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def concat_distinct(t: Tables) -> DataFrame:
    df = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("l_returnflag", text.null_if_in("l_returnflag", ["N"]))
    return aggregates.concat_distinct(df, "l_orderkey", ["p_brand", "l_returnflag"])


@query(
    "concat_newest_first",
    """SELECT user_id, string_agg(event_type, ', ' ORDER BY seen DESC, event_type) AS event_type
       FROM (SELECT user_id, event_type, max(ts) AS seen FROM events GROUP BY ALL) GROUP BY 1""",
)
def concat_newest_first(t: Tables) -> DataFrame:
    return aggregates.concat_distinct_newest(t.events, "user_id", "event_type", "ts")


@query(
    "sum_and_rate",
    """SELECT user_id, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS result,
              round_even(CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS DOUBLE) / 30 * 100, 2) AS rate,
              max(CASE WHEN event_type = 'error' THEN CAST(CAST(ts AS DATE) AS STRING) END) AS last_error
       FROM events GROUP BY 1""",
)
def sum_and_rate(t: Tables) -> DataFrame:
    made = t.events.withColumns({"ok": F.when(F.col("event_type") == "error", 0).otherwise(1), "day": dates.iso_text("ts")})
    return made.groupBy("user_id").agg(
        F.sum("ok").alias("result"),
        aggregates.success_rate(F.sum("ok"), 30).alias("rate"),
        aggregates.last_when(F.col("ok") == 0, "day").alias("last_error"),
    )


@query("global_max", "SELECT max(url) AS last_url, count(*) AS pages FROM pages")
def global_max(t: Tables) -> DataFrame:
    return aggregates.greatest(t.pages, {"last_url": "url"}, "pages")


@query("distinct_values", "SELECT DISTINCT l_shipdate FROM lineitem")
def distinct_values(t: Tables) -> DataFrame:
    return aggregates.distinct_values(t.lineitem, "l_shipdate")


@query(
    "running_marker",
    """SELECT user_id, event_id, max(CASE WHEN event_type = 'signup' THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id) AS last_signup FROM events""",
)
def running_marker(t: Tables) -> DataFrame:
    signup = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return aggregates.running_last(t.events.select("user_id", "event_id", "event_type"), ["user_id"], "event_id", signup, "last_signup", block=500).select("user_id", "event_id", "last_signup")


# --- de-duplication ----------------------------------------------------------------------------------------------

_LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(
    "dedupe_latest",
    f"""SELECT {_LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
        l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedupe_latest(t: Tables) -> DataFrame:
    return dedupe.latest(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "dedupe_earliest_ignoring",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def dedupe_earliest_ignoring(t: Tables) -> DataFrame:
    return dedupe.earliest_ignoring(t.events, ["event_id", "ts", "value", "props"], ["ts", "event_id"])


@query(
    "dedupe_best_score",
    """SELECT p_partkey, p_name, p_size, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_size DESC, p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn = 1""",
)
def dedupe_best_score(t: Tables) -> DataFrame:
    return dedupe.best_score(t.part.select("p_partkey", "p_name", "p_size", "p_retailprice"), "p_name", ["p_size", "p_retailprice"])


_PRICED = "SELECT 'T' || CAST(l_partkey AS STRING) AS ticker, CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice END AS price, l_shipdate AS time_added, l_orderkey FROM {lineitem}"


@query(
    "dedupe_lowest_price",
    f"""SELECT ticker, price, time_added, l_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY price NULLS LAST, time_added, l_orderkey) AS rn FROM ({_PRICED})) WHERE rn = 1""",
)
def dedupe_lowest_price(t: Tables) -> DataFrame:
    return dedupe.lowest_price(t.sql(_PRICED))


@query("dedupe_exact", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity, l_discount FROM lineitem")
def dedupe_exact(t: Tables) -> DataFrame:
    return dedupe.exact(t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_discount"))


@query(
    "duplicate_audit",
    """SELECT 'lines' AS table_name, count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_rows, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem
       UNION ALL SELECT 'orders', count(*), count(*), 0 FROM orders
       UNION ALL SELECT 'texts', count(*), count(DISTINCT text), count(*) - count(DISTINCT text) FROM documents""",
)
def duplicate_audit(t: Tables) -> DataFrame:
    return dedupe.audit({"lines": t.lineitem.select("l_orderkey", "l_linenumber"), "orders": t.orders, "texts": t.documents.select("text")})


@query(
    "dedupe_saved",
    """SELECT 'lines' AS table_name, count(*) AS row_count, count(DISTINCT (l_partkey, l_suppkey)) AS distinct_rows, count(*) - count(DISTINCT (l_partkey, l_suppkey)) AS duplicate_rows, count(DISTINCT (l_partkey, l_suppkey)) AS saved_rows, true AS whole FROM lineitem
       UNION ALL SELECT 'texts', count(*), count(DISTINCT text), count(*) - count(DISTINCT text), count(DISTINCT text), true FROM documents""",
)
def dedupe_saved(t: Tables) -> DataFrame:
    """Two tables saved without duplicates; the report says what was read, the saved tables that nothing is missing."""
    folder = run_folder(t.spark, "cleaned")
    tables = {"lines": t.lineitem.select("l_partkey", "l_suppkey"), "texts": t.documents.select("text")}
    report = dedupe.clean(tables, folder)
    saved = [t.spark.read.parquet(f"{folder}/{n}").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("saved_rows"), dedupe.checksum(df.columns).alias("now")) for n, df in tables.items()]
    both = report.join(columns.stack(saved), "table_name")
    return both.withColumn("whole", F.col("checksum") == F.col("now")).drop("checksum", "now")


@query("deep_page", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber LIMIT 50 OFFSET 5000")
def deep_page(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    pages = ordering.Pages(rows, [("l_extendedprice", "desc"), ("l_orderkey", "asc"), ("l_linenumber", "asc")], run_folder(t.spark, "pages"), ranges=16)
    return pages.page(100, 50)


_UPDATES = "SELECT l_orderkey AS o_orderkey, 'S' AS o_orderstatus, max(l_extendedprice) AS o_totalprice FROM {lineitem} GROUP BY l_orderkey"


@query(
    "upsert_keep_last",
    f"""WITH u AS ({_UPDATES}) SELECT * FROM u UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u)""",
)
def upsert_keep_last(t: Tables) -> DataFrame:
    return history.apply_updates(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), t.sql(_UPDATES), ["o_orderkey"])


_OLD = "SELECT o_orderkey AS iconum, o_custkey AS master_deal, ' ' || o_orderstatus || ' ' AS deal_status, o_orderdate AS updated FROM {orders}"
_NEWER = "SELECT l_orderkey AS iconum, o_custkey AS master_deal, l_linestatus || ' ' AS deal_status, max(l_shipdate) AS updated FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_custkey, l_linestatus"


@query(
    "incremental_refresh",
    f"""SELECT iconum, master_deal, deal_status, updated FROM (SELECT iconum, master_deal, trim(deal_status) AS deal_status, updated,
        row_number() OVER (PARTITION BY iconum, master_deal ORDER BY updated DESC, trim(deal_status)) AS rn FROM ({_OLD} UNION ALL {_NEWER})) WHERE rn = 1""",
)
def incremental_refresh(t: Tables) -> DataFrame:
    return dedupe.refresh(t.sql(_OLD), t.sql(_NEWER), ["iconum", "master_deal"], "updated", ["deal_status"])


# --- sorting and paging ------------------------------------------------------------------------------------------


@query(
    "nulls_first_sort_topn",
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, CAST(o_orderdate AS DATE) AS d FROM orders ORDER BY priority ASC NULLS FIRST, d ASC NULLS FIRST, o_orderkey LIMIT 500""",
)
def nulls_first_sort_topn(t: Tables) -> DataFrame:
    made = t.sql("SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, CAST(o_orderdate AS DATE) AS d FROM {orders}")
    return ordering.order(made, [("priority", "asc"), ("d", "asc"), ("o_orderkey", "asc")], nulls="first").limit(500)


@query(
    "sort_descending_rank",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY nullif(o_orderpriority, '5-LOW') DESC NULLS LAST, o_orderkey DESC) AS place FROM orders""",
)
def sort_descending_rank(t: Tables) -> DataFrame:
    made = t.sql("SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, nullif(o_orderpriority, '5-LOW') AS p FROM {orders}")
    by = Window.partitionBy("o_custkey").orderBy(*ordering.sort_columns([("p", "desc"), ("o_orderkey", "desc")]))
    return made.select("o_orderkey", "d", F.row_number().over(by).alias("place"))


@query(
    "page_window",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200""",
)
def page_window(t: Tables) -> DataFrame:
    return ordering.page(t.orders.select("o_orderkey", "o_totalprice"), [("o_totalprice", "desc"), ("o_orderkey", "asc")], 2, 100)


@query(
    "page_after_window",
    """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE (o_orderstatus, -o_totalprice, o_orderkey) > ('F', -100000.0, 0) ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey LIMIT 100""",
)
def page_after_window(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    keys = [("o_orderstatus", "asc"), ("o_totalprice", "desc"), ("o_orderkey", "asc")]
    return ordering.page_after(rows, keys, {"o_orderstatus": "F", "o_totalprice": 100000.0, "o_orderkey": 0}, 100)


@query("mixed_key_join", "SELECT l_orderkey, l_linenumber, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def mixed_key_join(t: Tables) -> DataFrame:
    """A long key against an int."""
    orders = t.orders.select(F.col("o_orderkey").cast("int").alias("l_orderkey"), "o_totalprice")
    return joins.inner(t.lineitem.select("l_orderkey", "l_linenumber"), orders, "l_orderkey")


@query("recent_batches", "SELECT DISTINCT CAST(CAST(ts AS DATE) AS STRING) AS day FROM events ORDER BY day DESC LIMIT 7")
def recent_batches(t: Tables) -> DataFrame:
    return ordering.top_distinct(t.events.select(dates.iso_text("ts").alias("day")), "day", 7)


# --- history -----------------------------------------------------------------------------------------------------

_HISTORY = """SELECT o_orderkey, o_custkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority, o_orderdate AS time_added,
              CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '3' DAY END AS time_removed FROM {orders}"""
_SNAPSHOT = """SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 250000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority FROM {orders}"""
_DIFF = f"""
WITH h AS ({_HISTORY}), s AS (SELECT DISTINCT * FROM ({_SNAPSHOT}))
SELECT h.o_orderkey, h.o_custkey, h.o_orderstatus, h.priority, h.time_added,
       CASE WHEN s.o_orderkey IS NULL AND h.time_removed IS NULL THEN TIMESTAMP '2002-01-01 06:00:00' ELSE %s END AS time_removed
FROM h LEFT JOIN s ON h.o_orderkey = s.o_orderkey AND h.o_custkey = s.o_custkey AND h.o_orderstatus = s.o_orderstatus AND h.priority IS NOT DISTINCT FROM s.priority
UNION ALL
SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.priority, TIMESTAMP '2002-01-01 06:00:00', NULL FROM s
WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.o_orderkey = s.o_orderkey AND h.o_custkey = s.o_custkey AND h.o_orderstatus = s.o_orderstatus AND h.priority IS NOT DISTINCT FROM s.priority)
"""


@query("snapshot_diff", _DIFF % "h.time_removed")
def snapshot_diff(t: Tables) -> DataFrame:
    return history.snapshot_diff(t.sql(_HISTORY), t.sql(_SNAPSHOT), "2002-01-01 06:00:00")


@query("snapshot_diff_reopen", _DIFF % "CASE WHEN s.o_orderkey IS NULL THEN h.time_removed END")
def snapshot_diff_reopen(t: Tables) -> DataFrame:
    return history.snapshot_diff(t.sql(_HISTORY), t.sql(_SNAPSHOT), "2002-01-01 06:00:00", reopen=True)


@query(
    "history_start",
    """SELECT DISTINCT l_orderkey, l_returnflag, TIMESTAMP '2002-01-01 06:00:00' AS time_added, CAST(NULL AS TIMESTAMP) AS time_removed FROM lineitem""",
)
def history_start(t: Tables) -> DataFrame:
    return history.start_history(t.lineitem.select("l_orderkey", "l_returnflag"), "2002-01-01 06:00:00")


_POLL_LOG = "SELECT event_type AS source, user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS time_checked FROM {events}"
POLL_HISTORY = f"""
WITH p AS (SELECT DISTINCT * FROM ({_POLL_LOG})), f AS (SELECT source, user_id, min(time_checked) AS time_added FROM p GROUP BY ALL),
     times AS (SELECT DISTINCT source, time_checked FROM p)
SELECT f.source, f.user_id, f.time_added,
       min(CASE WHEN times.time_checked > f.time_added AND NOT EXISTS (SELECT 1 FROM p WHERE p.source = f.source AND p.user_id = f.user_id AND p.time_checked = times.time_checked)
                THEN times.time_checked END) AS time_removed
FROM f JOIN times ON f.source = times.source GROUP BY f.source, f.user_id, f.time_added
"""


def poll_log(t: Tables) -> DataFrame:
    return t.events.select(F.col("event_type").alias("source"), "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("time_checked"))


@query("poll_log_history", POLL_HISTORY)
def poll_log_history(t: Tables) -> DataFrame:
    return history.fold_polls(poll_log(t))


_MEMBERS = "SELECT o_custkey AS c_custkey FROM {orders} WHERE o_totalprice > 450000"


@query(
    "mark_members",
    f"""SELECT c_custkey, CASE WHEN c_custkey IN ({_MEMBERS}) THEN 'Withdrawn' ELSE c_mktsegment END AS c_mktsegment,
        CASE WHEN c_custkey IN ({_MEMBERS}) THEN 'Resolved' END AS ticket_status FROM customer""",
)
def mark_members(t: Tables) -> DataFrame:
    return history.mark_members(
        t.customer.select("c_custkey", "c_mktsegment"), t.sql(_MEMBERS), "c_custkey", {"c_mktsegment": F.lit("Withdrawn"), "ticket_status": F.lit("Resolved")}
    )


# --- registry ----------------------------------------------------------------------------------------------------

_REGISTRY = """SELECT 'page ' || CAST(page_id AS STRING) AS source_name, CASE WHEN page_id % 2 = 0 THEN 'website' ELSE 'other' END AS source_type,
               url FROM {pages}"""


def _registry(t: Tables) -> DataFrame:
    """Pages as sources: path steps as columns, the query text as parameters."""
    return t.sql(_REGISTRY).select(
        "source_name",
        "source_type",
        "url",
        F.array(F.lit("th"), F.lit("td")).alias("cell_elem"),
        F.split("url", "/").alias("columns"),
        F.create_map(F.lit("site"), F.split_part("url", F.lit("/"), F.lit(3))).alias("parameters"),
    )


@query(
    "registry_columns",
    f"""SELECT source_name, unnest(string_split(url, '/')) AS col_name, unnest(range(1, len(string_split(url, '/')) + 1)) AS col_num FROM ({_REGISTRY})""",
)
def registry_columns(t: Tables) -> DataFrame:
    return registry.column_reference(_registry(t))


@query(
    "registry_table",
    f"""SELECT source_name, source_type, url, 'th, td' AS cell_elem, '{{"site":"' || split_part(url, '/', 3) || '"}}' AS parameters FROM ({_REGISTRY})""".replace("{{", "{").replace("}}", "}"),
)
def registry_table(t: Tables) -> DataFrame:
    return registry.source_table(_registry(t))


@query(
    "registry_saved",
    f"""SELECT 'ref_columns' AS target, source_name, unnest(string_split(url, '/')) AS value FROM ({_REGISTRY})
        UNION ALL SELECT 'ref_sources', source_name, url FROM ({_REGISTRY})""",
)
def registry_saved(t: Tables) -> DataFrame:
    """Both tables of the registry as they are read back from where they were saved."""
    from ..sources.writers import save_registry_tables

    paths = save_registry_tables(_registry(t), run_folder(t.spark, "registry"))
    columns, sources = (t.spark.read.parquet(paths[name]) for name in ("ref_columns", "ref_sources"))
    saved = [columns.select(F.lit("ref_columns").alias("target"), "source_name", F.col("col_name").alias("value"))]
    saved.append(sources.select(F.lit("ref_sources").alias("target"), "source_name", F.col("url").alias("value")))
    return saved[0].unionByName(saved[1])


@query(
    "registry_by_type",
    f"""SELECT source_name, source_type FROM ({_REGISTRY}) WHERE source_type = 'website'""",
)
def registry_by_type(t: Tables) -> DataFrame:
    return registry.sources_of_type(_registry(t), "website").select("source_name", "source_type")


@query(
    "registry_documents",
    f"""SELECT source_name, url AS doc_url, string_split(url, '/')[3] AS third FROM ({_REGISTRY})""",
)
def registry_documents(t: Tables) -> DataFrame:
    made = registry.registry_json(_registry(t))
    return made.select("source_name", F.get_json_object("document", "$.url").alias("doc_url"), F.get_json_object("document", "$.columns[2]").alias("third"))


# --- ids ---------------------------------------------------------------------------------------------------------

_ALPHABET = "0123456789BCDFGHJKLMNPQRSTVWXYZ"
_DIGIT = " || ".join(f"substr('{_ALPHABET}', CAST(n // {31**p} % 31 AS INTEGER) + 1, 1)" for p in range(5, -1, -1))
_BACK = " + ".join(f"(strpos('{_ALPHABET}', substr(e, {6 - p}, 1)) - 1) * {31**p}" for p in range(5, -1, -1))


@query(
    "entity_codec",
    f"""WITH a AS (SELECT o_orderkey, o_orderkey * 7919 + o_custkey AS n FROM orders), b AS (SELECT o_orderkey, n, CASE WHEN n < {31**6} THEN {_DIGIT} || '-E' END AS e FROM a)
        SELECT o_orderkey, n, e, {_BACK} AS back, CAST(NULL AS BIGINT) AS other FROM b""",
)
def entity_codec(t: Tables) -> DataFrame:
    numbered = t.orders.select("o_orderkey", (F.col("o_orderkey") * 7919 + F.col("o_custkey")).alias("n"))
    coded = numbered.withColumn("e", ids.number_to_entity_id("n"))
    other = ids.entity_id_to_number(F.replace("e", F.lit("-E"), F.lit("-A")))
    return coded.withColumns({"back": ids.entity_id_to_number("e"), "other": other})


@query(
    "listing_export",
    f"""SELECT company_name AS "Company Name", ticker AS "Symbol", exchange AS "Market", ipo_date AS "IPO Date", price AS "Price", price_range AS "Price Range",
        shares_offered, status AS "Status", notes AS "Notes", time_added AS time_checked FROM ({LISTING})""",
)
def listing_export(t: Tables) -> DataFrame:
    from ..sources.writers import display_listings

    return display_listings(t.sql(LISTING))
