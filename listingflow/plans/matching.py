"""Queries over entities, reconciliation, work items and source health."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions.text import normalise_company
from ..operators import entities, health, matching, reconcile, workitems
from ..operators.columns import conform
from ..session import run_folder
from ..sources.writers import staged
from .catalog import AS_OF, Tables, query
from .frames import DEAL, DEAL_PER_ENTITY, ENTITY, EXTERNAL, LISTING, POLLS

_UPCOMING = f"""
SELECT DISTINCT coalesce(p.iconum, e.iconum) AS iconum, l.company_name, p.master_deal, l.ticker, l.exchange, l.ipo_date, l.price, l.price_range, l.shares_offered, l.notes
FROM ({LISTING}) l LEFT JOIN ({ENTITY}) e ON l.company_name = e.company_name
LEFT JOIN ({DEAL}) p ON l.company_name = p.company_name OR e.iconum = p.iconum
WHERE l.ipo_date >= DATE '2000-06-15' AND ((p.trading_date <> l.ipo_date OR p.trading_date IS NULL) OR (p.price <> l.price OR p.price IS NULL))
"""


@query(
    "workitems_upcoming",
    f"""SELECT CASE WHEN ipo_date <= TIMESTAMP '2000-06-18 12:00:00' THEN 30 ELSE 20 END AS i_priority, coalesce(iconum, 0) AS "ICONUM", company_name AS "COMPANY_NAME",
        coalesce(master_deal, 0) AS "MASTER_DEAL", ticker AS "TICKER", exchange AS "EXCHANGE", ipo_date AS "IPO_DATE", price AS "PRICE", price_range AS "PRICE_RANGE",
        CAST(shares_offered AS BIGINT) AS "SHARES_OFFERED", notes AS "NOTES" FROM ({_UPCOMING})""",
)
def workitems_upcoming(t: Tables) -> DataFrame:
    return workitems.upload_layout(workitems.upcoming(t.sql(LISTING), t.sql(ENTITY), t.sql(DEAL), AS_OF), AS_OF)


@query("upcoming_differences", _UPCOMING)
def upcoming_differences(t: Tables) -> DataFrame:
    return workitems.upcoming(t.sql(LISTING), t.sql(ENTITY), t.sql(DEAL), AS_OF)


@query(
    "task_counts",
    """SELECT o_orderstatus, count(*) FILTER (o_orderkey % 4 = 3) AS critical_priority, count(*) FILTER (o_orderkey % 4 = 2) AS high_priority,
       count(*) FILTER (o_orderkey % 4 = 1) AS medium_priority, count(*) FILTER (o_orderkey % 4 = 0) AS low_priority, 0 AS none_priority, count(*) AS total_tasks
       FROM orders GROUP BY 1""",
)
def task_counts(t: Tables) -> DataFrame:
    tasks = t.sql("SELECT o_orderstatus, CASE o_orderkey % 4 WHEN 0 THEN 10 WHEN 1 THEN 20 WHEN 2 THEN 30 ELSE 31 END AS code FROM {orders}")
    return workitems.task_counts(tasks, "o_orderstatus", "code")


@query(
    "task_page",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 1000 ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 50""",
)
def task_page(t: Tables) -> DataFrame:
    keys = [("o_orderdate", "desc"), ("o_orderkey", "asc")]
    return workitems.task_page(t.orders, keys, 1, 50, ["o_orderstatus = 'O'", F.col("o_totalprice") > 1000], ["o_orderkey", "o_totalprice"])


# --- reconciliation ----------------------------------------------------------------------------------------------


@query("deals_per_entity", DEAL_PER_ENTITY)
def deals_per_entity(t: Tables) -> DataFrame:
    return reconcile.deals_per_entity(t.sql(DEAL))


@query("fallback_enrich", EXTERNAL)
def fallback_enrich(t: Tables) -> DataFrame:
    return _external(t).select("company_name", "ticker", "exchange", "ipo_date", "price", "price_range", "shares_offered", "status", "notes", "time_added", "time_removed", "entityname", "iconum")


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Listings with entities, and deals, both stored as the batch job does because several joins read them."""
    stage = staged(run_folder(t.spark, "reconcile"))
    deals = stage(reconcile.deals_per_entity(t.sql(DEAL)), "deals")
    return stage(reconcile.with_entities(t.sql(LISTING), t.sql(ENTITY), deals), "external"), deals


def _external(t: Tables) -> DataFrame:
    return reconcile.with_entities(t.sql(LISTING), t.sql(ENTITY), reconcile.deals_per_entity(t.sql(DEAL)))


_RECONCILED = f"""
SELECT coalesce(a.iconum, b.iconum) AS iconum, a.company_name AS company_name_external, b.company_name AS company_name_internal, a.exchange AS exchange_external,
       b.exchange AS exchange_internal, a.ipo_date, b.trading_date, a.price AS price_external, b.price AS price_internal, a.price_range, a.status, a.notes, b.ticker, b.cusip,
       b.client_deal_id, a.time_added, b.last_updated_date_utc
FROM ({EXTERNAL}) a FULL JOIN ({DEAL_PER_ENTITY}) b ON a.iconum = b.iconum
"""
_RECONCILED_COLUMNS = (
    "iconum company_name_external company_name_internal exchange_external exchange_internal ipo_date trading_date price_external price_internal "
    "price_range status notes ticker cusip client_deal_id time_added last_updated_date_utc"
).split()


def _reconciled(t: Tables) -> DataFrame:
    return reconcile.reconcile(*_sides(t))


@query("outer_reconcile", _RECONCILED)
def outer_reconcile(t: Tables) -> DataFrame:
    return _reconciled(t).select(*_RECONCILED_COLUMNS)


@query("reconcile_current", f"SELECT * FROM ({_RECONCILED}) WHERE ipo_date >= DATE '2000-06-15' OR CAST(trading_date AS DATE) >= DATE '2000-06-15'")
def reconcile_current(t: Tables) -> DataFrame:
    return reconcile.current_rows(_reconciled(t), AS_OF).select(*_RECONCILED_COLUMNS)


@query("reconcile_withdrawn", f"SELECT * FROM ({_RECONCILED}) WHERE status = 'Withdrawn'")
def reconcile_withdrawn(t: Tables) -> DataFrame:
    return reconcile.withdrawn_rows(_reconciled(t)).select(*_RECONCILED_COLUMNS)


@query(
    "match_report",
    f"""SELECT DISTINCT (coalesce(CAST(b.trading_date AS DATE) = a.ipo_date, false) OR a.ipo_date IS NULL) AS ipo_dates_match,
        (coalesce(b.price = a.price, false) OR a.price IS NULL) AS ipo_prices_match, a.iconum, a.company_name AS company_name_external, a.exchange AS exchange_external, a.ipo_date,
        a.price AS price_external, a.price_range, a.status, a.notes, a.time_added, b.company_name AS company_name_internal, b.master_deal, b.client_deal_id, b.cusip, b.ticker,
        b.exchange AS exchange_internal, b.price AS price_internal, b.min_offering_price, b.max_offering_price, CAST(b.announcement_date AS DATE) AS announcement_date,
        CAST(b.pricing_date AS DATE) AS pricing_date, CAST(b.trading_date AS DATE) AS trading_date, CAST(b.closing_date AS DATE) AS closing_date, b.deal_status,
        CAST(b.last_updated_date_utc AS DATE) AS last_updated_date_utc
        FROM ({EXTERNAL}) a LEFT JOIN ({DEAL_PER_ENTITY}) b ON a.iconum = b.iconum""",
)
def match_report(t: Tables) -> DataFrame:
    return reconcile.match_report(*_sides(t))


_NORMAL = r"regexp_replace(regexp_replace(regexp_replace(lower(%s), '[.,()\\/]', '', 'g'), '\slimited$|\sltd|\ssa$|\sa/s$|\sinc$', '', 'g'), '^\s+|\s+$', '', 'g')"


@query(
    "ticket_listings",
    f"""SELECT CAST(iconum AS STRING) AS iconum, cusip, coalesce(company_name_external, company_name_internal) AS company_name, ticker,
        coalesce(exchange_external, exchange_internal) AS exchange, coalesce(ipo_date, CAST(trading_date AS DATE)) AS ipo_date, coalesce(price_external, price_internal) AS price,
        price_range, status, notes, coalesce(time_added, last_updated_date_utc) AS last_checked, client_deal_id AS ipo_deal_id,
        {_NORMAL % 'coalesce(company_name_external, company_name_internal)'} AS formatted_company_name FROM ({_RECONCILED})""",
)
def ticket_listings(t: Tables) -> DataFrame:
    return reconcile.ticket_listings(_reconciled(t))


# --- entities ----------------------------------------------------------------------------------------------------


def _worklist(extra: str) -> str:
    return f"""SELECT l.company_name, l.ticker, l.exchange, e.iconum, e.entity_id, e.mapstatus, max(l.time_added) AS time_added,
               l.company_name || '_' || coalesce(l.ticker, '') || '_' || l.exchange AS client_id
               FROM ({LISTING}) l LEFT JOIN ({ENTITY}) e ON l.company_name = e.company_name WHERE e.iconum IS NULL {extra} GROUP BY ALL"""


@query("unmapped_worklist", _worklist("AND e.mapstatus IS NULL"))
def unmapped_worklist(t: Tables) -> DataFrame:
    return entities.unmapped(t.sql(LISTING), t.sql(ENTITY))


@query("unmapped_worklist_all", _worklist(""))
def unmapped_worklist_all(t: Tables) -> DataFrame:
    return entities.unmapped(t.sql(LISTING), t.sql(ENTITY), recheck_all=True)


_DECISIONS = """
SELECT c_name || '_T' || CAST(c_custkey AS STRING) || '_' || c_mktsegment AS clientId, c_name AS clientName, c_name || ' Corp' AS entityName,
       '000' || lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') || '-E' AS entityId, CASE WHEN s_suppkey % 5 = 0 THEN 'UNMAPPED' WHEN s_suppkey % 5 = 1 THEN 'mapped' ELSE 'MAPPED' END AS mapStatus,
       CAST(s_suppkey % 8 AS DOUBLE) / 8 AS similarityScore, CAST(s_suppkey % 4 + 1 AS DOUBLE) / 4 - CAST(c_custkey % 2 AS DOUBLE) / 4 AS confidenceScore,
       n_name AS countryName, 'PUB' AS entityTypeCode, c_mktsegment AS entityTypeDescription
FROM {customer} JOIN {supplier} ON c_nationkey = s_nationkey JOIN {nation} ON c_nationkey = n_nationkey
"""
_ID_NUMBER = " + ".join(f"(strpos('0123456789BCDFGHJKLMNPQRSTVWXYZ', substr(entityId, {i + 1}, 1)) - 1) * {31 ** (5 - i)}" for i in range(6))


_GATE = f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY clientName ORDER BY confidenceScore DESC, similarityScore DESC, clientId, entityName, entityId, mapStatus) AS rn
                   FROM ({_DECISIONS}) WHERE upper(mapStatus) = 'MAPPED')
        SELECT clientName AS company_name, split_part(clientId, '_', 2) AS ticker, split_part(clientId, '_', 3) AS exchange,
               CASE WHEN confidenceScore > 0.75 THEN entityName END AS entityname, CASE WHEN confidenceScore > 0.75 THEN {_ID_NUMBER} END AS iconum,
               CASE WHEN confidenceScore > 0.75 THEN entityId END AS entity_id, CASE WHEN confidenceScore > 0.75 THEN mapStatus ELSE 'UNMAPPED' END AS mapstatus,
               CASE WHEN confidenceScore > 0.75 THEN similarityScore END AS similarityscore, CASE WHEN confidenceScore > 0.75 THEN confidenceScore END AS confidencescore,
               CASE WHEN confidenceScore > 0.75 THEN countryName END AS countryname, CASE WHEN confidenceScore > 0.75 THEN entityTypeDescription END AS entitytypedescription
        FROM r WHERE rn = 1"""


# Decisions that a task makes out of its customers, about.
_TASK_DECISIONS = 1_000_000


def _decisions(t: Tables) -> DataFrame:
    """The decisions, made by as many tasks as they need: their number grows with customers times suppliers, while the customers
    are a small file that one task would read."""
    customers = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("c"))
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("s"))
    made = customers.join(suppliers, "nation").agg(F.sum(F.col("c") * F.col("s"))).first()[0] or 0
    tasks = made // _TASK_DECISIONS + 1
    # both are dealt out, as either may be the one that the join sends to all tasks
    return t.sql(_DECISIONS, customer=t.customer.repartition(tasks), supplier=t.supplier.repartition(tasks))


@query("confidence_gate", _GATE)
def confidence_gate(t: Tables) -> DataFrame:
    return entities.decisions_to_map(_decisions(t))


@query(
    "entity_map_append",
    f"""SELECT company_name, ticker, exchange, entityname, iconum, entity_id, mapstatus, similarityscore, confidencescore, countryname, entitytypedescription FROM ({_GATE})
        UNION ALL SELECT company_name, ticker, exchange, entityname, iconum, entity_id, mapstatus, NULL, NULL, NULL, NULL FROM ({ENTITY}) e""",
)
def entity_map_append(t: Tables) -> DataFrame:
    return entities.extend_map(conform(t.sql(ENTITY), schemas.ENTITY_MAP), _decisions(t))


@query("candidate_types", "SELECT s_suppkey, s_name FROM (SELECT *, CASE s_nationkey % 5 WHEN 0 THEN 'PUB' WHEN 1 THEN 'PVT' WHEN 2 THEN 'FND' WHEN 3 THEN 'HOL' END AS kind FROM supplier) WHERE kind IN ('PUB', 'PVT', 'HOL', 'SUB')")
def candidate_types(t: Tables) -> DataFrame:
    typed = t.sql("SELECT s_suppkey, s_name, CASE s_nationkey % 5 WHEN 0 THEN 'PUB' WHEN 1 THEN 'PVT' WHEN 2 THEN 'FND' WHEN 3 THEN 'HOL' END AS entity_type FROM {supplier}")
    return entities.of_types(typed).select("s_suppkey", "s_name")


# Part names with a letter dropped, swapped or added, against the clean part names with their brand's first id.
_MISSPELT = """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ' Inc.' WHEN 1 THEN substr(p_name, 1, 3) || substr(p_name, 5) || ' ' || lower(p_type)
               WHEN 2 THEN replace(p_name, 'g', 'k') || ', ' || lower(p_type) ELSE p_name || 's ' || lower(p_type) || CAST(p_partkey % 10 AS STRING) END AS company_name FROM {part}"""
_UNIVERSE = """SELECT DISTINCT p_name AS entityname, p_name AS entity_id FROM {part} UNION SELECT DISTINCT p_name || ' ' || lower(p_type) AS entityname, p_name || '/' || p_type AS entity_id FROM {part}"""


@query(
    "fuzzy_match",
    f"""WITH l AS (SELECT p_partkey, company_name, {_NORMAL % 'company_name'} AS name FROM ({_MISSPELT})),
        u AS (SELECT {_NORMAL % 'entityname'} AS name, min((entity_id, entityname)) AS e FROM ({_UNIVERSE}) GROUP BY 1),
        p AS (SELECT a.name, u.name AS candidate, u.e, 1 - CAST(levenshtein(a.name, u.name) AS DOUBLE) / greatest(length(a.name), length(u.name)) AS sim
              FROM (SELECT DISTINCT name FROM l) a, u),
        r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY sim DESC, candidate) AS rn FROM p WHERE sim >= 0.8 - 1e-9),
        b AS (SELECT x.name, x.e, x.sim, y.sim AS second FROM (SELECT * FROM r WHERE rn = 1) x LEFT JOIN (SELECT * FROM r WHERE rn = 2) y ON x.name = y.name)
        SELECT p_partkey, company_name, b.e[2] AS entityname, b.e[1] AS entity_id, round(sim, 9) AS similarity,
               round(CASE WHEN sim = 1 THEN 1 ELSE sim - coalesce(second - 0.8, 0) / 2 END, 9) AS confidence, CASE WHEN sim IS NULL THEN 'UNMAPPED' ELSE 'MAPPED' END AS mapstatus
        FROM l LEFT JOIN b ON l.name = b.name""",
)
def fuzzy_match(t: Tables) -> DataFrame:
    matched = matching.match_names(t.sql(_MISSPELT), t.sql(_UNIVERSE), 0.8, stage=staged(run_folder(t.spark, "names")))
    return matched.withColumns({"similarity": F.round("similarity", 9), "confidence": F.round("confidence", 9)})


_PAIR_L = "SELECT DISTINCT lower(c_name) AS name FROM {customer}"
_PAIR_R = "SELECT DISTINCT replace(lower(s_name), 'supplier', 'customers') AS name FROM {supplier}"


@query(
    "similar_name_pairs",
    f"""SELECT a.name, b.name AS candidate, round(1 - CAST(levenshtein(a.name, b.name) AS DOUBLE) / greatest(length(a.name), length(b.name)), 9) AS similarity
        FROM ({_PAIR_L}) a, ({_PAIR_R}) b WHERE a.name <> b.name AND 1 - CAST(levenshtein(a.name, b.name) AS DOUBLE) / greatest(length(a.name), length(b.name)) >= 0.9 - 1e-9""",
)
def similar_name_pairs(t: Tables) -> DataFrame:
    pairs = matching.candidate_pairs(t.sql(_PAIR_L), t.sql(_PAIR_R), 0.9)
    return pairs.withColumn("similarity", F.round("similarity", 9))


@query(
    "match_normalised_names",
    f"""SELECT s_suppkey, p_partkey FROM (SELECT s_suppkey, {_NORMAL % "'small ring, ' || s_name || ' Ltd'"} AS n FROM supplier) a JOIN
        (SELECT p_partkey, {_NORMAL % "p_name || ' Supplier#' || lpad(CAST(p_size AS STRING), 9, '0') || ' Inc.'"} AS n FROM part) b ON a.n = b.n""",
)
def match_normalised_names(t: Tables) -> DataFrame:
    a = t.supplier.select("s_suppkey", normalise_company(F.concat(F.lit("small ring, "), "s_name", F.lit(" Ltd"))).alias("n"))
    b = t.part.select("p_partkey", normalise_company(F.concat("p_name", F.lit(" Supplier#"), F.lpad(F.col("p_size").cast("string"), 9, "0"), F.lit(" Inc."))).alias("n"))
    return a.join(b, "n", "inner").select("s_suppkey", "p_partkey")


# --- source health -----------------------------------------------------------------------------------------------

_RECENT = f"SELECT DISTINCT time_checked FROM ({POLLS}) ORDER BY 1 DESC LIMIT %d"


def health_sql(n: int) -> str:
    return f"""WITH p AS ({POLLS}), r AS ({_RECENT % n})
    SELECT source, sum(result) FILTER (time_checked IN (FROM r)) AS result,
           round_even(CAST(sum(result) FILTER (time_checked IN (FROM r)) AS DOUBLE) / {n} * 100, 2) AS recent_success_rate,
           max(time_checked) FILTER (result = 0) AS most_recent_failure, max(time_checked) FILTER (result = 1) AS most_recent_success
    FROM p GROUP BY source HAVING count(*) FILTER (time_checked IN (FROM r)) > 0"""


@query("source_health", health_sql(10))
def source_health(t: Tables) -> DataFrame:
    return health.worst_first(health.health_report(t.sql(POLLS), 10))


@query("recent_polls", f"WITH p AS ({POLLS}), r AS ({_RECENT % 5}) SELECT * FROM p WHERE time_checked IN (FROM r)")
def recent_polls(t: Tables) -> DataFrame:
    return health.recent_polls(t.sql(POLLS), 5).select("source", "result", "time_checked")
