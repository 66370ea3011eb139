"""Queries over extraction, readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..operators.columns import conform
from ..session import run_folder
from ..sources import html, readers, records, writers
from . import batch
from .catalog import AS_OF, Tables, query
from .frames import LISTING

# --- HTML --------------------------------------------------------------------------------------------------------

_NAV = {"table_elem": "nav", "row_elem": "ul", "cell_elem": ["li"], "link_elem": "a", "link_key": "href", "link_base": "https://site.example"}
_UNESCAPED = "replace(replace(replace(%s, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
_NAV_SQL = r"""
WITH n AS (SELECT page_id, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav FROM pages),
     c AS (SELECT page_id, list_transform(regexp_extract_all(nav, '(?s)<li><a href="[^"]*">(.*?)</a></li>', 1), lambda x: trim(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&amp;', '&'))) AS texts,
           list_transform(regexp_extract_all(nav, 'href="([^"]*)"', 1), lambda x: 'https://site.example' || replace(x, '&amp;', '&')) AS links FROM n)
"""


@query(
    "html_records",
    _NAV_SQL + "SELECT page_id, 0 AS row_no, len(texts) + len(links) AS n_cells, array_to_string(list_concat(texts, links), '|') AS cells FROM c WHERE len(texts) + len(links) > 1",
)
def html_records(t: Tables) -> DataFrame:
    rows = html.extract_rows(t.pages, _NAV)
    return rows.select("page_id", "row_no", F.size("cells").alias("n_cells"), F.array_join("cells", "|").alias("cells"))


@query(
    "html_regular_records",
    r"""WITH r AS (SELECT page_id, unnest(list_transform(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '(?s)<li>(.*?)</li>', 1), lambda x: regexp_extract_all(x, '"([^"]*)"|>([^<>]+)<', 0))) AS cells,
             unnest(range(len(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '(?s)<li>(.*?)</li>', 1)))) AS row_no FROM pages)
       SELECT page_id, row_no, cells[1] AS target, cells[2] AS label FROM r WHERE len(cells) > 1""",
)
def html_regular_records(t: Tables) -> DataFrame:
    rows = html.extract_regular(t.pages, "<nav>(.*?)</nav>", "<li>(.*?)</li>", "(\"[^\"]*\"|>[^<>]+<)")
    return rows.select("page_id", "row_no", F.get("cells", F.lit(0)).alias("target"), F.get("cells", F.lit(1)).alias("label"))


@query(
    "html_named_cells",
    _NAV_SQL
    + """SELECT page_id, nullif(texts[1], '') AS first, nullif(texts[2], '') AS second,
         array_to_string(list_transform(list_concat(texts, links)[3:], lambda x: coalesce(nullif(x, ''), '-')), '|') AS unnamed
         FROM c WHERE len(texts) + len(links) > 1""",
)
def html_named_cells(t: Tables) -> DataFrame:
    """The names cover two cells; the others are counted through to the widest row's last."""
    rows = html.extract_rows(t.pages, _NAV)
    width = html.table_width(rows)
    named = html.name_cells(rows, ["first", "second"], width, ["page_id", F.size("cells").alias("n")])
    unnamed = [F.when(F.col("n") > i + 2, F.coalesce(F.col(f"Unnamed_column_{i}"), F.lit("-"))) for i in range(width - 2)]
    return named.select("page_id", "first", "second", F.concat_ws("|", *unnamed).alias("unnamed"))


@query(
    "registry_history",
    _NAV_SQL.replace("'https://site.example' || ", "")
    + """, r AS (SELECT page_id, list_transform(list_concat(texts, links), lambda x: nullif(x, '')) AS cells FROM c WHERE len(texts) + len(links) > 1)
       SELECT array_to_string(list_transform(cells, lambda x: coalesce(x, '-')), '|') AS cells,
              CASE WHEN min(CASE WHEN page_id % 6 <> 3 THEN 0 ELSE 1 END) = 0 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS time_added,
              CASE WHEN max(CASE WHEN page_id % 3 > 0 OR page_id % 6 = 3 THEN 1 ELSE 0 END) = 0 THEN TIMESTAMP '2024-01-02' END AS time_removed
       FROM r GROUP BY cells""",
)
def registry_history(t: Tables) -> DataFrame:
    """Two polls of one source that the registry describes: the first sees all pages but a sixth, the second that sixth and those not divisible by three."""
    setting = {**{k: v for k, v in _NAV.items() if k != "link_base"}, "source_name": "nav", "columns": ["first", "no header"]}
    registry = t.spark.createDataFrame([{**setting, "table_elem": "nav"}], "source_name string, table_elem string, row_elem string, cell_elem array<string>, link_elem string, link_key string, columns array<string>")
    pages = t.pages.withColumn("source_name", F.lit("nav"))
    stage = writers.staged(run_folder(t.spark, "registry-history"))
    first = batch.collect_histories(registry, pages.where("page_id % 6 <> 3"), {}, "2024-01-01", stage=lambda df, n: stage(df, f"{n}-1"))
    both = batch.collect_histories(registry, pages.where("page_id % 3 > 0 OR page_id % 6 = 3"), first, "2024-01-02", stage=lambda df, n: stage(df, f"{n}-2"))["nav"]
    names = [c for c in both.columns if not c.startswith("time_")]
    last = F.greatest(*[F.when(F.col(f"`{c}`").isNotNull(), i + 1).otherwise(0) for i, c in enumerate(names)])
    shown = [F.when(last > i, F.coalesce(F.col(f"`{c}`"), F.lit("-"))) for i, c in enumerate(names)]
    return both.select(F.concat_ws("|", *shown).alias("cells"), "time_added", "time_removed")


@query(
    "html_paragraphs",
    r"""SELECT page_id, len(regexp_extract_all(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>')) AS paragraphs FROM pages WHERE len(regexp_extract_all(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>')) > 1""",
)
def html_paragraphs(t: Tables) -> DataFrame:
    rows = html.extract_rows(t.pages, {"table_elem": "body", "row_elem": "article", "cell_elem": "p"})
    return rows.select("page_id", F.size("cells").alias("paragraphs"))


# --- flat cell sequences and option lists ------------------------------------------------------------------------


@query(
    "card_pivot",
    """SELECT user_id, max_by(props, event_id) FILTER (event_type = 'view') AS viewed, max_by(props, event_id) FILTER (event_type = 'purchase') AS bought,
       max_by(props, event_id) FILTER (event_type = 'refund') AS refunded FROM events GROUP BY 1""",
)
def card_pivot(t: Tables) -> DataFrame:
    return records.cards(t.events, ["user_id"], "event_type", "props", "event_id", {"view": "viewed", "purchase": "bought", "refund": "refunded"})


_WORDS = """SELECT doc_id, unnest(string_split(text, ' ')) AS cell, unnest(range(len(string_split(text, ' ')))) AS pos FROM documents"""


@query(
    "marker_records",
    f"""WITH w AS ({_WORDS}), r AS (SELECT *, coalesce(max(CASE WHEN contains(cell, '.') THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos), 0) AS record_start FROM w)
        SELECT doc_id, record_start, max(CASE WHEN pos - record_start = 0 THEN replace(cell, '.', '') END) AS a, max(CASE WHEN pos - record_start = 1 THEN replace(cell, '.', '') END) AS b,
               max(CASE WHEN pos - record_start = 2 THEN replace(cell, '.', '') END) AS c,
               coalesce(string_agg(replace(cell, '.', ''), ' ' ORDER BY pos) FILTER (pos - record_start > 2), '') AS more_cells, count(*) AS cell_count FROM r GROUP BY 1, 2""",
)
def marker_records(t: Tables) -> DataFrame:
    cells = t.documents.select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "cell"))
    cells = cells.withColumn("pos", F.col("pos").cast("long"))
    found = records.marked_records(cells, ["doc_id"], "pos", "cell", ".", ["a", "b", "c"], block=1000)
    return found.withColumn("more_cells", F.array_join("more_cells", " "))


@query(
    "marker_further_cells",
    f"""WITH w AS ({_WORDS}), r AS (SELECT *, coalesce(max(CASE WHEN contains(cell, '.') THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos), 0) AS record_start FROM w)
        SELECT doc_id, record_start, pos - record_start AS place, replace(cell, '.', '') AS cell FROM r WHERE pos - record_start >= 3""",
)
def marker_further_cells(t: Tables) -> DataFrame:
    cells = t.documents.select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "cell"))
    return records.further_cells(cells.withColumn("pos", F.col("pos").cast("long")), ["doc_id"], "pos", "cell", ".", ["a", "b", "c"], block=1000)


# --- nested and delimited text -----------------------------------------------------------------------------------


@query("json_flatten", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_flatten(t: Tables) -> DataFrame:
    return readers.json_column(t.events, "props", "k long", ["event_id"])


@query(
    "json_nested_flatten",
    """SELECT o_orderkey, o_custkey AS "data.customer.id", o_orderstatus AS "data.customer.status", o_totalprice AS "data.price" FROM orders""",
)
def json_nested_flatten(t: Tables) -> DataFrame:
    nested = F.to_json(
        F.struct(F.struct(F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("customer"), F.col("o_totalprice").alias("price")).alias("data"))
    )
    made = t.orders.select("o_orderkey", nested.alias("j"))
    return readers.json_column(made, "j", "data struct<customer: struct<id: long, status: string>, price: double>", ["o_orderkey"])


@query(
    "json_unknown_flatten",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS "customer.id", CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS "price",
              CASE WHEN o_orderkey % 5 > 1 THEN o_orderstatus END AS "customer.more.status", CASE WHEN o_orderkey % 5 > 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS STRING) ELSE 'none' END END AS "mixed",
              CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END AS other_json FROM orders""",
)
def json_unknown_flatten(t: Tables) -> DataFrame:
    """Texts whose keys nobody has told of: some nested, some in few texts, one with numbers and words, and texts that are no JSON."""
    status = F.when(F.col("o_orderkey") % 5 > 1, F.struct(F.col("o_orderstatus").alias("status")))
    price = F.col("o_totalprice").cast("string")
    shape = F.struct(F.struct(F.col("o_custkey").alias("id"), status.alias("more")).alias("customer"))
    mixed = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(', "mixed": '), F.col("o_custkey").cast("string"))).otherwise(F.lit(', "mixed": "none"'))
    body = F.concat(F.to_json(shape).substr(F.lit(1), F.length(F.to_json(shape)) - 1), F.lit(', "price": '), price, F.when(F.col("o_orderkey") % 5 > 1, mixed).otherwise(F.lit("")), F.lit("}"))
    made = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderpriority")).otherwise(body).alias("j"))
    return readers.json_unknown(made, "j", ["o_orderkey"])


@query(
    "json_stacked_lists",
    """SELECT page_id, 'HARD' AS list_name, unnest(string_split(url, '/')) AS name, CAST(NULL AS INTEGER) AS width FROM pages
       UNION ALL SELECT page_id, 'SOFT', url, length(url) FROM pages""",
)
def json_stacked_lists(t: Tables) -> DataFrame:
    lists = t.pages.select(
        "page_id",
        F.transform(F.split("url", "/"), lambda s: F.struct(s.alias("name"))).alias("HARD"),
        F.array(F.struct(F.col("url").alias("name"), F.length("url").alias("width"))).alias("SOFT"),
    )
    return readers.stack_lists(lists, ["HARD", "SOFT"], ["page_id"])


_CALENDAR = """SELECT c_custkey, 'symbol|name|price' || chr(13) || chr(10) || 'T' || CAST(c_custkey AS STRING) || '|' || c_name || '|' || CAST(c_nationkey AS STRING) || chr(13) || chr(10)
               || 'U' || CAST(c_custkey AS STRING) || '|' || c_mktsegment || '|0|x' || chr(13) || chr(10) AS body FROM {customer}"""


@query(
    "delimited_text",
    """SELECT c_custkey, 1 AS line_no, 'T' || c_custkey AS symbol, c_name AS name, CAST(c_nationkey AS STRING) AS price, '' AS more FROM customer
       UNION ALL SELECT c_custkey, 2, 'U' || c_custkey, c_mktsegment, '0', 'x' FROM customer""",
)
def delimited_text(t: Tables) -> DataFrame:
    """The separator is a character that patterns give a meaning of its own."""
    lines = readers.delimited_text(t.sql(_CALENDAR), "body", ["symbol", "name", "price"], ["c_custkey"], "|")
    return lines.withColumn("more", F.array_join("more_cells", "|")).drop("more_cells")


@query(
    "sql_text_scan",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ordered, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'""",
)
def sql_text_scan(t: Tables) -> DataFrame:
    return readers.read_query(
        t.spark,
        "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS ordered, c_name FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderstatus = 'O'",
        {"orders": t.orders, "customer": t.customer},
        ["ordered"],
    )


@query("registry_load", "SELECT 'part' AS source, count(*) AS n FROM part UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier")
def registry_load(t: Tables) -> DataFrame:
    frames = readers.load_tables(t.spark, {n: t.path(n) for n in ("part", "customer", "supplier")})
    counts = [df.agg(F.lit(n).alias("source"), F.count(F.lit(1)).alias("n")) for n, df in frames.items()]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


# --- writers: what is read back must be what was there -----------------------------------------------------------


@query("csv_round_trip", "SELECT p_partkey, p_name, p_brand, p_retailprice, CASE WHEN p_size > 25 THEN 'NA' ELSE 'a \"quoted\", cell' END AS note FROM part")
def csv_round_trip(t: Tables) -> DataFrame:
    folder = run_folder(t.spark, "csv")
    noted = t.part.select("p_partkey", "p_name", "p_brand", "p_retailprice", F.when(F.col("p_size") > 25, "NA").otherwise('a "quoted", cell').alias("note"))
    writers.export_csv(noted, folder)
    return readers.read_csv(t.spark, folder, noted.schema)


@query(
    "csv_misfits",
    """SELECT p_partkey, CASE WHEN p_size % 10 <> 0 THEN p_size END AS p_size, CASE WHEN p_size % 10 IN (0, 1) THEN line END AS misfit
       FROM (SELECT *, p_partkey || ',' || CASE WHEN p_size % 10 = 0 THEN 'n/a' ELSE CAST(p_size AS STRING) END || ',' || p_brand || CASE WHEN p_size % 10 = 1 THEN ',surplus' ELSE '' END AS line FROM part)""",
)
def csv_misfits(t: Tables) -> DataFrame:
    """Lines of which some have a cell of another type and some a cell too many."""
    folder = run_folder(t.spark, "csv-misfits")
    size = F.when(F.col("p_size") % 10 == 0, "n/a").otherwise(F.col("p_size").cast("string"))
    surplus = F.when(F.col("p_size") % 10 == 1, ",surplus").otherwise("")
    lines = t.part.select(F.concat(F.col("p_partkey").cast("string"), F.lit(","), size, F.lit(","), F.col("p_brand"), surplus).alias("p_partkey,p_size,p_brand"))
    lines.write.option("header", True).option("sep", "\u0001").csv(folder)  # whole lines
    read = readers.read_csv(t.spark, folder, "p_partkey long, p_size long, p_brand string", rescue="misfit")
    return read.select("p_partkey", "p_size", "misfit")


@query("csv_folder", "SELECT p_partkey, p_name, 'parts' AS source_name FROM part UNION ALL SELECT s_suppkey, s_name, 'suppliers' FROM supplier")
def csv_folder(t: Tables) -> DataFrame:
    """Two sources, each in files named after it."""
    folder = run_folder(t.spark, "csvs")
    writers.export_named_csv(t.part.select("p_partkey", "p_name"), f"{folder}/all", "parts")
    writers.export_named_csv(t.supplier.select(F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("p_name")), f"{folder}/all", "suppliers")
    read = readers.read_csv_folder(t.spark, f"{folder}/all", "p_partkey long, p_name string")
    return read.withColumn("source_name", F.regexp_extract("source_name", "^([a-z]+)", 1))


@query("json_round_trip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def json_round_trip(t: Tables) -> DataFrame:
    folder = run_folder(t.spark, "json")
    writers.as_json_documents(t.documents, folder)
    return readers.read_files(t.spark, folder, t.documents.schema, "json")


_LATER = """SELECT o_orderkey, o_orderstatus, o_orderdate FROM {orders}"""


@query(
    "versioned_overwrite",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE o_orderstatus END AS o_orderstatus, o_orderdate FROM orders""",
)
def versioned_overwrite(t: Tables) -> DataFrame:
    table = writers.VersionedTable(t.spark, run_folder(t.spark, "versions"))
    table.write(t.sql(_LATER))
    table.write(table.read().withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "F", "closed").otherwise(F.col("o_orderstatus"))))
    return table.read()


@query("typed_overwrite_append", f"SELECT company_name, ticker, exchange, ipo_date, price, price_range, shares_offered, status, notes, time_added, time_removed FROM ({LISTING}) UNION ALL SELECT s_name, NULL, NULL, NULL, s_acctbal, NULL, NULL, NULL, NULL, NULL, NULL FROM supplier")
def typed_overwrite_append(t: Tables) -> DataFrame:
    folder = run_folder(t.spark, "typed")
    writers.overwrite(t.sql(LISTING), folder, schemas.LISTING)
    extra = t.supplier.select(F.col("s_name").alias("company_name"), F.col("s_acctbal").cast("string").alias("price"))
    writers.append(extra, folder, schemas.LISTING)
    return t.spark.read.parquet(folder)


@query(
    "split_output",
    """SELECT 'current' AS target, o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-15'
       UNION ALL SELECT 'withdrawn', o_orderkey, 'Withdrawn' FROM orders WHERE o_orderstatus = 'Withdrawn' OR o_orderstatus = 'F'""".replace(
        "o_orderstatus AS status FROM", "CASE WHEN o_orderstatus = 'F' THEN 'Withdrawn' ELSE o_orderstatus END AS status FROM"
    ),
)
def split_output(t: Tables) -> DataFrame:
    folder = run_folder(t.spark, "split")
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "Withdrawn").otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_orderdate").cast("date").alias("ipo_date"),
        F.lit(None).cast("timestamp_ntz").alias("trading_date"),
    )
    targets = {n: writers.VersionedTable(t.spark, f"{folder}/{n}") for n in ("current", "withdrawn")}
    writers.split_current_withdrawn(rows, AS_OF, targets["current"], targets["withdrawn"])
    parts = [table.read().select(F.lit(n).alias("target"), "o_orderkey", "status") for n, table in targets.items()]
    return parts[0].unionByName(parts[1])


@query(
    "history_from_file",
    """SELECT event_id, user_id, date_trunc('second', ts) AS time_added, CAST(NULL AS TIMESTAMP) AS time_removed FROM events""",
)
def history_from_file(t: Tables) -> DataFrame:
    flat = t.events.select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time_checked"))
    return writers.history_from_file(flat)


@query(
    "conform_single_stamp",
    f"""SELECT company_name, ticker, exchange, ipo_date, price, price_range, shares_offered, status, notes, time_added AS time_checked FROM ({LISTING})""",
)
def conform_single_stamp(t: Tables) -> DataFrame:
    return conform(t.sql(LISTING).withColumnRenamed("time_added", "time_checked"), schemas.LISTING_SINGLE_STAMP)


@query("catalog_tables", "SELECT 'listingflow_audit_orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'listingflow_audit_customer', count(*) FROM customer")
def catalog_tables(t: Tables) -> DataFrame:
    """Catalog tables found by listing them."""
    for name in ("orders", "customer"):
        folder = run_folder(t.spark, name)
        getattr(t, name).write.parquet(folder)
        t.spark.sql(f"DROP TABLE IF EXISTS listingflow_audit_{name}")
        t.spark.catalog.createTable(f"listingflow_audit_{name}", path=folder, source="parquet")
    found = [n for n in readers.list_tables(t.spark) if n in ("listingflow_audit_orders", "listingflow_audit_customer")]
    counts = [readers.read_table(t.spark, n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n in sorted(found)]
    return counts[0].unionAll(counts[1])
