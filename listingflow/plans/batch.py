"""The standing batch job: histories -> listings -> entities -> reconciliation -> work items and tickets.

Every step is a lazy frame; the only writes are those of ``run``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators import dedupe, reconcile, tickets, workitems
from ..operators.columns import conform, database_names, stack
from ..operators.entities import extend_map, match_decisions, unmapped
from ..operators.health import health_report
from ..operators.history import STAMPS, apply_updates, redirect_superseded, snapshot_diff, start_history
from ..operators.registry import registry_configs
from ..session import run_folder
from ..sources import html
from ..sources.normalise import COMBINED, SINGLE, combine_all
from ..sources.writers import VersionedTable, staged, unstaged


def collect_histories(
    registry: DataFrame,
    pages: DataFrame,
    stored: dict[str, DataFrame],
    checked_at,
    source: str = "source_name",
    stage: Callable[[DataFrame, str], DataFrame] = unstaged,
) -> dict[str, DataFrame]:
    """The history of every source of the registry after one poll of its pages.

    The registry says how a page of a source is read and what its cells are called; ``pages`` has a page's source in the column
    ``source``, ``stored`` the histories so far.  A source of which no record was read is left as it was: a page that has
    changed its layout must not close everything.  Columns that one side lacks are nulls.
    """
    found = {}
    for name, setting in registry_configs(registry).items():
        rows = stage(html.extract_rows(pages.where(F.col(source) == name), setting), "cells-" + name.replace(" ", "-"))
        width, known = html.table_width(rows), stored.get(name)
        if not width:
            found |= {name: known} if known is not None else {}
            continue
        snapshot = html.name_cells(rows, setting.get("columns") or [], width, [])
        if known is None:
            found[name] = start_history(snapshot, checked_at)
            continue
        kinds = {f.name: f.dataType for df in (known, snapshot) for f in df.schema.fields}
        wide = [df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in kinds.items() if c not in df.columns and c not in STAMPS]) for df in (known, snapshot)]
        found[name] = snapshot_diff(*wide, checked_at)
    return found


@dataclass
class Listings:
    frame: DataFrame
    failed: dict[str, str]


def normalise_all(raw: dict[str, DataFrame], as_of, stage: Callable[[DataFrame, str], DataFrame] = unstaged) -> Listings:
    """Clean and combine every source there is.

    A source that is absent or lacks a column is reported and left out; the others are not affected.  With a ``stage`` that
    stores them, the clean sources become tables of their own, and so does a source that fails only while it is read.
    """
    done, failed = [], {}
    jobs = {**{n: (lambda f=f: f(raw, as_of)) for n, f in COMBINED.items()}}
    for name, function in SINGLE.items():
        jobs[name] = lambda f=function, n=name: f(raw[n], as_of) if n == "TMX" else f(raw[n])
    for name, job in jobs.items():
        try:
            done.append(stage(job(), "clean-" + name.lower().replace(" ", "-")))
        except (KeyError, PySparkException) as problem:
            failed[name] = str(problem).splitlines()[0]
    if not done:
        raise ValueError(f"no source could be read: {failed}")
    return Listings(combine_all(done, as_of), failed)


@dataclass
class Outcome:
    """Everything a run decides; nothing has been computed yet."""

    reconciled: DataFrame
    current: DataFrame
    withdrawn: DataFrame
    work_items: DataFrame
    entity_worklist: DataFrame


def decide(
    listings: DataFrame,
    entity_map: DataFrame,
    deals: DataFrame,
    as_of,
    recheck_all: bool = True,
    stage: Callable[[DataFrame, str], DataFrame] = unstaged,
) -> Outcome:
    """``stage`` stores an intermediate frame that several results read and gives it back (see ``staged``)."""
    per_entity = stage(reconcile.deals_per_entity(deals), "deals")
    external = stage(reconcile.with_entities(listings, entity_map, per_entity), "external")
    both = stage(reconcile.reconcile(external, per_entity), "reconciled")
    return Outcome(
        reconciled=both,
        current=reconcile.current_rows(both, as_of),
        withdrawn=reconcile.withdrawn_rows(both),
        work_items=workitems.upload_layout(workitems.upcoming(listings, entity_map, deals, as_of), as_of),
        entity_worklist=unmapped(listings, entity_map, recheck_all),
    )


@dataclass
class TicketInputs:
    """What the ticket stage needs besides the reconciliation."""

    ledger: DataFrame
    manual: DataFrame
    feed: DataFrame
    link_base: str
    system: tickets.TicketSystem


def run(
    raw: dict[str, DataFrame],
    entity_map: DataFrame,
    deals: DataFrame,
    as_of,
    root: str,
    new_deals: DataFrame | None = None,
    universe: DataFrame | None = None,
    polls: DataFrame | None = None,
    ticketing: TicketInputs | None = None,
) -> dict[str, str]:
    """One scheduled run: clean, combine, map, reconcile, decide tickets and save.  Returns the sources that failed.

    ``new_deals`` refresh the stored ones; names without an entity are matched against ``universe`` and what is found is added
    to the entity map; ``polls`` give the health report; ``ticketing`` the ledger and the outbox.
    """
    spark = deals.sparkSession
    store = staged(run_folder(spark, "run"))
    saved = lambda df, name: _saved(spark, df, f"{root}/{name}")
    combined = normalise_all(raw, as_of, saved)
    listings = saved(combined.frame, "all_listings")
    if new_deals is not None:
        deals = saved(dedupe.refresh(deals, new_deals, ["master_deal"], "last_updated_date_utc"), "deals")
    if universe is not None:
        worklist = store(unmapped(listings, entity_map, True), "worklist")
        entity_map = saved(extend_map(entity_map, match_decisions(worklist, universe, stage=store)), "entity_map")
    outcome = decide(listings, entity_map, deals, as_of, stage=store)
    current, withdrawn = saved(outcome.current, "current"), saved(outcome.withdrawn, "withdrawn")
    saved(outcome.work_items, "work_items")
    saved(outcome.entity_worklist, "entity_worklist")
    if polls is not None:
        saved(polls, "polls")
        saved(database_names(health_report(polls)), "health")
    if ticketing is not None:
        done = decide_tickets(current, withdrawn, ticketing.ledger, ticketing.manual, ticketing.feed, ticketing.link_base)
        saved(done.ledger, "ticket_ledger")
        saved(outbox(done, ticketing.system), "ticket_outbox")
    return combined.failed


def _saved(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """A new version of a table, read back."""
    table = VersionedTable(spark, path)
    return spark.read.schema(df.schema).parquet(table.path(table.write(df)))


@dataclass
class TicketOutcome:
    ledger: DataFrame
    to_withdraw: DataFrame
    to_update: DataFrame
    to_open: DataFrame


def decide_tickets(
    current: DataFrame, withdrawn: DataFrame, stored_ledger: DataFrame, manual: DataFrame, feed: DataFrame, link_base: str
) -> TicketOutcome:
    """The ledger after one run, and the outbox rows that go with it."""
    listed = reconcile.ticket_listings(current)
    by_hand = conform(tickets.match_manual_tickets(manual, listed), schemas.TICKET_LEDGER)
    known = stack([stored_ledger, by_hand], schemas.TICKET_LEDGER)
    return ticket_chain(listed, reconcile.ticket_listings(withdrawn), known, feed, link_base)


def ticket_chain(listed: DataFrame, gone: DataFrame, known: DataFrame, feed: DataFrame, link_base: str) -> TicketOutcome:
    """Withdrawals, changes, the status feed and new tickets, in this order, over listings and the tickets known so far."""
    closing = tickets.withdrawn_tickets(gone, known)
    changed = tickets.ticket_updates(listed, known)
    main = tickets.mark_withdrawn(tickets.ledger(listed, known), closing)
    main = apply_updates(main, changed, ["ticket_number", "formatted_company_name"])
    main = redirect_superseded(main, feed, link_base)
    return TicketOutcome(main, closing, tickets.still_open(changed, feed), tickets.new_tickets(main))


def outbox(out: TicketOutcome, system: tickets.TicketSystem) -> DataFrame:
    """The calls to make: kind, ticket or company, and the request as JSON."""
    calls = {
        "withdraw": tickets.withdrawn_payload(out.to_withdraw),
        "comment": tickets.comment_payload(out.to_update),
        "answers": tickets.update_payload(out.to_update, system),
        "open": tickets.create_payload(out.to_open, system),
    }
    parts = [rows.withColumn("kind", F.lit(kind)) for kind, rows in calls.items()]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.select("kind", "ticket_number", "company_name", "payload")
