"""Queries over ticket decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..operators import history, tickets
from ..operators.columns import conform
from . import batch
from .catalog import Tables, query
from .frames import LEDGER, TICKET_LISTING

_LINK = "https://tickets.example/"
_LISTING_COLUMNS = ", ".join(f.name for f in schemas.TICKET_LISTING.fields)
_LEDGER_COLUMNS = ", ".join(f.name for f in schemas.TICKET_LEDGER.fields)
# A ticket system of these queries' own.
SYSTEM = tickets.TicketSystem(
    questions={"cusip": 1, "ipo_date": 2, "exchange": 3, "ticker": 4},
    product="listings",
    request={"Type": "Request", "Priority": "Medium"},
    close_comment="Closed.",
    close_code=10,
    close_text="Answered",
)


def _listings(t: Tables) -> DataFrame:
    return conform(t.sql(TICKET_LISTING), schemas.TICKET_LISTING)


def _ledger(t: Tables) -> DataFrame:
    return conform(t.sql(LEDGER), schemas.TICKET_LEDGER)


# Tickets opened by hand; the ticker cell carries tabs and remarks.
_MANUAL = """SELECT 'T' || CAST(s_suppkey AS STRING) || chr(9) || 'typed' AS ticker, CASE WHEN s_suppkey % 2 = 0 THEN 'C' || CAST(s_suppkey AS STRING) END AS cusip,
             s_suppkey + 900000 AS ticket_number, 'https://tickets.example/' || CAST(s_suppkey + 900000 AS STRING) AS ticket_link,
             TIMESTAMP_NTZ '1999-01-01 00:00:00' AS ticket_created, 'Open' AS ticket_status FROM {supplier}"""
_PREFIXED = ", ".join(f"l.{f.name}" for f in schemas.TICKET_LISTING.fields)


@query(
    "ticket_match_manual",
    rf"""WITH m AS (SELECT regexp_extract(ticker, '^([\w\d\.]*)', 1) AS ticker, cusip, ticket_number, ticket_link, ticket_created, ticket_status FROM ({_MANUAL})), l AS ({TICKET_LISTING})
        SELECT {_PREFIXED}, m.ticket_number, m.ticket_link, m.ticket_created, m.ticket_status FROM m JOIN l ON m.ticker = l.ticker
        UNION ALL SELECT {_PREFIXED}, m.ticket_number, m.ticket_link, m.ticket_created, m.ticket_status FROM m JOIN l ON m.cusip = l.cusip""",
)
def ticket_match_manual(t: Tables) -> DataFrame:
    return tickets.match_manual_tickets(t.sql(_MANUAL), _listings(t))


_MAIN = f"""
SELECT {_LEDGER_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY formatted_company_name ORDER BY ticket_created NULLS LAST, iconum NULLS LAST, cusip NULLS LAST, company_name, ticker NULLS LAST, exchange,
         ipo_date NULLS LAST, price, price_range, status NULLS LAST, notes NULLS LAST, last_checked, ipo_deal_id, ticket_number NULLS LAST) AS rn
  FROM (SELECT {_LISTING_COLUMNS}, NULL AS ticket_number, NULL AS ticket_link, NULL AS ticket_created, NULL AS ticket_status FROM ({TICKET_LISTING})
        UNION ALL SELECT {_LEDGER_COLUMNS} FROM ({LEDGER}) WHERE ticket_status IS NOT NULL)
) WHERE rn = 1
"""


def _main(t: Tables) -> DataFrame:
    return tickets.ledger(_listings(t), _ledger(t).where("ticket_status IS NOT NULL"))


@query("ticket_ledger", _MAIN)
def ticket_ledger(t: Tables) -> DataFrame:
    return _main(t)


_WITHDRAWN = f"""SELECT {_PREFIXED}, k.ticket_number, k.ticket_link, k.ticket_created, k.ticket_status FROM (SELECT * FROM ({TICKET_LISTING}) WHERE status = 'Withdrawn') l
                 JOIN ({LEDGER}) k ON l.formatted_company_name = k.formatted_company_name WHERE k.ticket_status IS DISTINCT FROM 'Resolved'"""


def _withdrawn(t: Tables) -> DataFrame:
    return tickets.withdrawn_tickets(_listings(t).where("status = 'Withdrawn'"), _ledger(t))


@query("ticket_withdrawn", _WITHDRAWN)
def ticket_withdrawn(t: Tables) -> DataFrame:
    return _withdrawn(t)


@query(
    "ticket_mark_withdrawn",
    f"""WITH w AS ({_WITHDRAWN}) SELECT * REPLACE (CASE WHEN ticket_number IN (SELECT ticket_number FROM w) THEN 'Withdrawn' ELSE status END AS status,
        CASE WHEN ticket_number IN (SELECT ticket_number FROM w) THEN 'Resolved' ELSE ticket_status END AS ticket_status) FROM ({LEDGER})""",
)
def ticket_mark_withdrawn(t: Tables) -> DataFrame:
    return tickets.mark_withdrawn(_ledger(t), _withdrawn(t))


_UPDATES = f"""
WITH j AS (SELECT l.*, k.ticket_number, k.ticket_link, k.ticket_created, k.ticket_status, k.ipo_date AS old_date, k.cusip AS old_cusip, k.ticker AS old_ticker
           FROM ({TICKET_LISTING}) l JOIN ({LEDGER}) k ON l.formatted_company_name = k.formatted_company_name WHERE k.ticket_status IS DISTINCT FROM 'Resolved'),
     n AS (SELECT *, row_number() OVER (PARTITION BY ticket_number ORDER BY last_checked DESC, formatted_company_name, iconum NULLS LAST, cusip NULLS LAST, company_name, ticker NULLS LAST,
           exchange, ipo_date NULLS LAST, price, price_range, status NULLS LAST, notes NULLS LAST, ipo_deal_id) AS rn FROM j)
SELECT {_LEDGER_COLUMNS} FROM n WHERE rn = 1 AND NOT (coalesce(ipo_date = old_date, false) AND (coalesce(cusip = old_cusip, false) OR cusip IS NULL) AND (coalesce(ticker = old_ticker, false) OR ticker IS NULL))
"""


def _updates(t: Tables) -> DataFrame:
    return tickets.ticket_updates(_listings(t), _ledger(t))


@query("change_detection", _UPDATES)
def change_detection(t: Tables) -> DataFrame:
    return _updates(t)


@query(
    "ticket_apply_updates",
    f"""WITH u AS ({_UPDATES}) SELECT * FROM u UNION ALL SELECT {_LEDGER_COLUMNS} FROM ({LEDGER}) k
        WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.ticket_number = k.ticket_number AND u.formatted_company_name = k.formatted_company_name)""",
)
def ticket_apply_updates(t: Tables) -> DataFrame:
    return history.apply_updates(_ledger(t), _updates(t), ["ticket_number", "formatted_company_name"])


_ANSWERS = {1: "coalesce(cusip, '')", 2: "coalesce(CAST(ipo_date AS STRING), '')", 3: "coalesce(exchange, '')", 4: "coalesce(ticker, '')"}


def _read_answers(payload: str, path: str) -> list:
    parts = []
    for i in range(4):
        parts.append(F.get_json_object(payload, f"{path}[{i}].Id").cast("int").alias(f"id_{i}"))
        parts.append(F.get_json_object(payload, f"{path}[{i}].Answers[0].AnswerValue").alias(f"answer_{i}"))
    return parts


_ANSWER_SQL = ", ".join(f"{q} AS id_{i}, {expr} AS answer_{i}" for i, (q, expr) in enumerate(_ANSWERS.items()))


@query("ticket_update_payload", f"SELECT ticket_number, {_ANSWER_SQL} FROM ({_UPDATES})")
def ticket_update_payload(t: Tables) -> DataFrame:
    return tickets.update_payload(_updates(t), SYSTEM).select("ticket_number", *_read_answers("payload", "$"))


@query(
    "ticket_new_payload",
    f"""SELECT company_name, company_name || ' - ' || exchange AS title, 'listings' AS product, 'Medium' AS priority, ipo_deal_id AS deal_id, {_ANSWER_SQL} FROM ({_MAIN}) WHERE ticket_number IS NULL AND company_name <> ''""",
)
def ticket_new_payload(t: Tables) -> DataFrame:
    made = tickets.create_payload(tickets.new_tickets(_main(t)), SYSTEM)
    return made.select(
        "company_name",
        F.get_json_object("payload", "$.Title").alias("title"),
        F.get_json_object("payload", "$.Products[0].Id").alias("product"),
        F.get_json_object("payload", "$.Priority").alias("priority"),
        F.get_json_object(F.get_json_object("payload", "$.Content"), "$.ipo_deal_id").alias("deal_id"),
        *_read_answers("payload", "$.Questions"),
    )


@query(
    "ticket_withdrawn_payload",
    f"""SELECT ticket_number, company_name, status, coalesce(CAST(ipo_date AS STRING), '') AS ipo_date FROM ({_WITHDRAWN})""",
)
def ticket_withdrawn_payload(t: Tables) -> DataFrame:
    made = tickets.withdrawn_payload(_withdrawn(t)).withColumn("content", F.get_json_object("payload", "$.Content"))
    return made.select("ticket_number", *[F.get_json_object("content", f"$.{c}").alias(c) for c in ("company_name", "status", "ipo_date")])


@query("ticket_close_payload", f"SELECT ticket_number, 'Resolved' AS status, 10 AS code, 0 AS send FROM ({LEDGER})")
def ticket_close_payload(t: Tables) -> DataFrame:
    made = tickets.close_payload(_ledger(t), SYSTEM)
    return made.select(
        "ticket_number",
        F.get_json_object("payload", "$.Status").alias("status"),
        F.get_json_object("payload", "$.Resolution.Code").cast("int").alias("code"),
        F.get_json_object("payload", "$.SendOption").cast("int").alias("send"),
    )


_CREATED = """SELECT c_name AS company_name, c_custkey + 700000 AS ticket_number, 'https://tickets.example/' || CAST(c_custkey + 700000 AS STRING) AS ticket_link,
              TIMESTAMP_NTZ '2000-06-15 00:00:00' AS ticket_created, 'Pending' AS ticket_status FROM {customer} WHERE c_acctbal > 0"""


@query(
    "ticket_merge_back",
    f"""SELECT m.* REPLACE (coalesce(m.ticket_number, c.ticket_number) AS ticket_number, coalesce(m.ticket_link, c.ticket_link) AS ticket_link,
        coalesce(m.ticket_created, c.ticket_created) AS ticket_created, coalesce(m.ticket_status, c.ticket_status) AS ticket_status)
        FROM ({_MAIN}) m LEFT JOIN ({_CREATED}) c ON m.company_name = c.company_name""",
)
def ticket_merge_back(t: Tables) -> DataFrame:
    return tickets.merge_created(_main(t), t.sql(_CREATED))


_FEED = """SELECT c_custkey + 500000 AS ticket_number, CASE WHEN c_acctbal > 2000 THEN 'Resolved' WHEN c_acctbal > 0 THEN 'Completed' END AS status,
           CASE WHEN c_nationkey % 2 = 0 THEN c_custkey + 600000 END AS duplicate_of FROM {customer}"""


@query(
    "ticket_redirect",
    f"""SELECT k.* REPLACE (
          CASE WHEN f.status = 'Resolved' AND f.duplicate_of IS NOT NULL THEN f.duplicate_of ELSE k.ticket_number END AS ticket_number,
          CASE WHEN f.status = 'Resolved' AND f.duplicate_of IS NOT NULL THEN '{_LINK}' || f.duplicate_of ELSE k.ticket_link END AS ticket_link,
          CASE WHEN f.status = 'Resolved' AND f.duplicate_of IS NOT NULL THEN '' ELSE coalesce(f.status, k.ticket_status) END AS ticket_status)
        FROM ({LEDGER}) k LEFT JOIN ({_FEED}) f ON k.ticket_number = f.ticket_number""",
)
def ticket_redirect(t: Tables) -> DataFrame:
    return history.redirect_superseded(_ledger(t), t.sql(_FEED), _LINK)


@query(
    "ticket_comment_payload",
    f"""SELECT ticket_number, company_name, coalesce(cusip, '') AS cusip, coalesce(CAST(ipo_date AS STRING), '') AS ipo_date FROM ({_UPDATES}) u
        WHERE ticket_number NOT IN (SELECT ticket_number FROM ({_FEED}) f WHERE status = 'Resolved')""",
)
def ticket_comment_payload(t: Tables) -> DataFrame:
    """Comments on changed tickets that the feed does not call resolved."""
    made = tickets.comment_payload(tickets.still_open(_updates(t), t.sql(_FEED)))
    made = made.withColumn("content", F.get_json_object("payload", "$.Content"))
    return made.select("ticket_number", *[F.get_json_object("content", f"$.{c}").alias(c) for c in ("company_name", "cusip", "ipo_date")])


_KNOWN = f"(SELECT * FROM ({LEDGER}) WHERE ticket_status IS NOT NULL)"
_RUN_LEDGER = f"""
WITH w AS ({_WITHDRAWN.replace(f"({LEDGER})", _KNOWN)}), u AS ({_UPDATES.replace(f"({LEDGER})", _KNOWN)}), f AS ({_FEED}),
     m AS (SELECT * REPLACE (CASE WHEN ticket_number IN (SELECT ticket_number FROM w) THEN 'Withdrawn' ELSE status END AS status,
                             CASE WHEN ticket_number IN (SELECT ticket_number FROM w) THEN 'Resolved' ELSE ticket_status END AS ticket_status) FROM ({_MAIN}) m0),
     a AS (SELECT * FROM u UNION ALL SELECT m.* FROM m WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.ticket_number = m.ticket_number AND u.formatted_company_name = m.formatted_company_name))
SELECT a.* REPLACE (
  CASE WHEN f.status = 'Resolved' AND f.duplicate_of IS NOT NULL THEN f.duplicate_of ELSE a.ticket_number END AS ticket_number,
  CASE WHEN f.status = 'Resolved' AND f.duplicate_of IS NOT NULL THEN '{_LINK}' || f.duplicate_of ELSE a.ticket_link END AS ticket_link,
  CASE WHEN f.status = 'Resolved' AND f.duplicate_of IS NOT NULL THEN '' ELSE coalesce(f.status, a.ticket_status) END AS ticket_status)
FROM a LEFT JOIN f ON a.ticket_number = f.ticket_number
"""


def _chain(t: Tables) -> batch.TicketOutcome:
    listed, known = _listings(t), _ledger(t).where("ticket_status IS NOT NULL")
    return batch.ticket_chain(listed, listed.where("status = 'Withdrawn'"), known, t.sql(_FEED), _LINK)


@query("ticket_run_ledger", _RUN_LEDGER)
def ticket_run_ledger(t: Tables) -> DataFrame:
    """The ledger a run stores."""
    return _chain(t).ledger


@query(
    "ticket_run_outbox",
    f"""WITH l AS ({_RUN_LEDGER}), u AS ({_UPDATES.replace(f"({LEDGER})", _KNOWN)})
        SELECT 'withdraw' AS kind, ticket_number, NULL AS company_name FROM ({_WITHDRAWN.replace(f"({LEDGER})", _KNOWN)}) w
        UNION ALL SELECT kind, ticket_number, NULL FROM u, (VALUES ('comment'), ('answers')) k(kind) WHERE ticket_number NOT IN (SELECT ticket_number FROM ({_FEED}) f WHERE status = 'Resolved')
        UNION ALL SELECT 'open', NULL, company_name FROM l WHERE ticket_number IS NULL AND company_name <> ''""",
)
def ticket_run_outbox(t: Tables) -> DataFrame:
    """The calls a run stores, without their payloads."""
    return batch.outbox(_chain(t), SYSTEM).drop("payload")
