"""Ticket decisions: which tickets to open, update, mark withdrawn or close, as datasets for an outbox."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.dates import iso_text
from ..functions.text import extract, is_not
from .columns import conform, fill_from, stack
from .dedupe import keep_first, latest
from .history import changed_rows, mark_members
from .joins import inner, left, only_in_left, union_of_matches

RESOLVED = "Resolved"
_TICKET = [f.name for f in schemas.TICKET_COLUMNS.fields]
_NAME = "formatted_company_name"



@dataclass(frozen=True)
class TicketSystem:
    """What the caller's ticket system calls things: ids of its questions by listing column, product, request and close code."""

    questions: Mapping[str, int]
    product: str
    request: Mapping[str, str]
    close_comment: str
    close_code: int
    close_text: str


def match_manual_tickets(tickets: DataFrame, listings: DataFrame) -> DataFrame:
    """Tickets opened by hand, tied to a listing by ticker or by security id.

    A ticket that fits by both gives two rows; the ledger keeps one per name.
    """
    cleaned = tickets.withColumn("ticker", extract("ticker", r"^([\w\d\.]*)"))
    return union_of_matches(cleaned, listings, ["ticker", "cusip"], _TICKET)


def ledger(listings: DataFrame, *ticket_rows: DataFrame) -> DataFrame:
    """Listings and ticket rows in one list, one row per normalised name; the oldest ticket wins, listings come last."""
    rows = stack([listings, *ticket_rows], schemas.TICKET_LEDGER)
    return keep_first(rows, [_NAME], [("ticket_created", "asc")])


def withdrawn_tickets(withdrawn: DataFrame, tickets: DataFrame) -> DataFrame:
    """Withdrawn listings that still have an open ticket.  A name of which nothing is left after normalising ties nothing."""
    open_tickets = tickets.where(is_not("ticket_status", RESOLVED) & (F.col(_NAME) != "")).select(_NAME, *_TICKET)
    return inner(withdrawn.where(F.col(_NAME) != ""), open_tickets, _NAME)


def mark_withdrawn(ledger_rows: DataFrame, withdrawn: DataFrame) -> DataFrame:
    return mark_members(
        ledger_rows,
        withdrawn,
        "ticket_number",
        {"status": F.lit("Withdrawn"), "ticket_status": F.lit(RESOLVED)},
    )


def ticket_updates(listings: DataFrame, tickets: DataFrame) -> DataFrame:
    """The newest listing of every open ticket whose date, security id or ticker changed.

    A listing without a security id or ticker does not count as changed in it; a missing date does.  Only the newest listing of
    a name meets its tickets.
    """
    is_open = F.col("ticket_number").isNotNull() & is_not("ticket_status", RESOLVED)
    newest_listings = latest(listings.where(F.col(_NAME) != ""), [_NAME], "last_checked")
    joined = inner(newest_listings, tickets.where(is_open), _NAME, ("", "_old"))
    newest = latest(joined, ["ticket_number"], "last_checked")
    changed = changed_rows(newest, ["ipo_date"], ["cusip", "ticker"])
    return conform(changed, schemas.TICKET_LEDGER)


def new_tickets(ledger_rows: DataFrame) -> DataFrame:
    """Ledger rows to open a ticket for."""
    named = F.coalesce(F.col("company_name") != "", F.lit(False))
    return ledger_rows.where(F.col("ticket_number").isNull() & named)


def merge_created(ledger_rows: DataFrame, created: DataFrame) -> DataFrame:
    """Take over the numbers, links, dates and status of tickets just opened, by company name."""
    joined = left(ledger_rows, created.select("company_name", *_TICKET), "company_name", ("", "_new"))
    return fill_from(joined, {c: f"{c}_new" for c in _TICKET}).select(*ledger_rows.columns)


# --- request payloads --------------------------------------------------------------------------------------------


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _answer(question: int, value: Column) -> Column:
    return F.struct(
        F.lit(question).alias("Id"), F.array(F.struct(value.alias("AnswerValue"))).alias("Answers")
    )


def question_answers(system: TicketSystem) -> Column:
    values = {"ipo_date": F.coalesce(iso_text("ipo_date"), F.lit(""))}
    return F.array(*[_answer(q, values.get(name, _blank(name))) for name, q in system.questions.items()])


def still_open(rows: DataFrame, feed: DataFrame) -> DataFrame:
    """The rows whose ticket the status feed does not call resolved: nothing is sent to a resolved ticket."""
    return only_in_left(rows, feed.where(F.col("status") == RESOLVED).select("ticket_number"), ["ticket_number"])


def update_payload(rows: DataFrame, system: TicketSystem) -> DataFrame:
    """One outbox row per ticket to update: its number and the answers as JSON."""
    return rows.select("ticket_number", F.to_json(question_answers(system)).alias("payload"))


def comment_payload(rows: DataFrame) -> DataFrame:
    """One outbox row per ticket to update: its number and a comment that holds the listing."""
    return rows.select("ticket_number", F.to_json(F.struct(listing_content().alias("Content"))).alias("payload"))


def listing_content() -> Column:
    """The listing as JSON, blanks for missing values (the ticket text)."""
    names = [f.name for f in schemas.TICKET_LISTING.fields if f.name != _NAME]
    return F.to_json(F.struct(*[_blank(n).alias(n) for n in names]))


def create_payload(rows: DataFrame, system: TicketSystem) -> DataFrame:
    """One outbox row per ticket to open: the company and the request as JSON."""
    request = F.struct(
        F.concat(_blank("company_name"), F.lit(" - "), _blank("exchange")).alias("Title"),
        F.array(F.struct(F.lit(system.product).alias("Id"))).alias("Products"),
        listing_content().alias("Content"),
        *[F.lit(v).alias(k) for k, v in system.request.items()],
        question_answers(system).alias("Questions"),
    )
    return rows.select("company_name", F.to_json(request).alias("payload"))


def withdrawn_payload(rows: DataFrame) -> DataFrame:
    return rows.select("ticket_number", F.to_json(F.struct(listing_content().alias("Content"))).alias("payload"))


def close_payload(ledger_rows: DataFrame, system: TicketSystem) -> DataFrame:
    """A close request for every ticket of the ledger."""
    request = F.struct(
        F.lit(system.close_comment).alias("Content"),
        F.lit(RESOLVED).alias("Status"),
        F.struct(F.lit(system.close_code).alias("Code"), F.lit(system.close_text).alias("Description")).alias("Resolution"),
        F.lit(0).alias("SendOption"),
    )
    return ledger_rows.where(F.col("ticket_number").isNotNull()).select("ticket_number", F.to_json(request).alias("payload"))
