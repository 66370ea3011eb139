import datetime as dt

import pytest
from pyspark.sql import functions as F

from listingflow import schemas
from listingflow.operators import health, reconcile, registry, tickets, workitems
from listingflow.operators.columns import conform
from listingflow.plans import batch
from listingflow.session import run_folder
from listingflow.sources.writers import VersionedTable

from conftest import rows

NOW = "2024-06-15 12:00:00"
D = dt.date(2024, 6, 20)
T = dt.datetime(2024, 6, 1)


SYSTEM = tickets.TicketSystem({"cusip": 1, "ipo_date": 2, "exchange": 3, "ticker": 4}, "p", {"Type": "Request"}, "Closed.", 1, "Done")


def frame(spark, schema, *data):
    """Rows given by name, all other columns null."""
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema.fields) for d in data], schema)


def test_upcoming_null_rules(spark):
    listings = frame(
        spark,
        schemas.LISTING,
        dict(company_name="same", ipo_date=D, price=1.0),
        dict(company_name="unpriced", ipo_date=D),
        dict(company_name="missing", ipo_date=D, price=1.0, shares_offered=5.0),
        dict(company_name="by id", ipo_date=D, price=2.0),
        dict(company_name="past", ipo_date=dt.date(2024, 6, 14)),
        dict(company_name="today", ipo_date=dt.date(2024, 6, 15)),
    )
    known = frame(spark, schemas.ENTITY_MAP, dict(company_name="by id", iconum=7))
    day = dt.datetime(2024, 6, 20)
    deals = frame(
        spark,
        schemas.DEALS,
        dict(company_name="same", trading_date=day, price=1.0, master_deal=1),
        dict(company_name="unpriced", trading_date=day, price=3.0, master_deal=2),
        dict(company_name="other", iconum=7, trading_date=day, price=3.0, master_deal=3),
        dict(company_name="other", iconum=7, trading_date=day, price=3.0, master_deal=3),
    )
    got = workitems.upcoming(listings, known, deals, NOW)
    assert rows(got, "company_name", "iconum", "master_deal") == [("by id", 7, 3), ("missing", None, None), ("today", None, None)]
    upload = workitems.upload_layout(got, NOW)
    assert upload.columns[:3] == ["i_priority", "ICONUM", "COMPANY_NAME"]
    assert rows(upload, "COMPANY_NAME", "i_priority", "ICONUM", "MASTER_DEAL", "SHARES_OFFERED") == [("by id", 20, 7, 3, 0), ("missing", 20, 0, 0, 5), ("today", 30, 0, 0, 0)]


def test_entity_fallback_options(spark):
    listings = frame(spark, schemas.LISTING, dict(company_name="深", ticker="1", exchange="Shenzhen"), dict(company_name="US", ticker="1", exchange="NYSE"))
    known = frame(spark, schemas.ENTITY_MAP)
    deals = frame(spark, schemas.DEALS, dict(iconum=5, company_name="Deep", ticker="1", exchange="Nasdaq, Shenzhen"))
    assert rows(reconcile.with_entities(listings, known, deals), "company_name", "iconum") == [("US", None), ("深", None)]
    each = reconcile.with_entities(listings, known, deals, each_exchange=True)
    assert rows(each, "company_name", "iconum") == [("Deep", 5), ("US", 5)]
    limited = reconcile.with_entities(listings, known, deals, restrict_exchanges=True, each_exchange=True)
    assert rows(limited, "company_name", "iconum") == [("Deep", 5), ("US", None)]


def test_reconcile_does_not_match_null_ids(spark):
    external = frame(spark, schemas.LISTING, dict(company_name="a", ticker="x"), dict(company_name="b", status="Withdrawn")).withColumns({"iconum": F.lit(None).cast("long"), "entityname": F.lit("e")})
    deals = frame(spark, schemas.DEALS, dict(company_name="d", ticker="y"), dict(iconum=3, company_name="f", trading_date=dt.datetime(2024, 6, 15)))
    got = reconcile.reconcile(external, deals)
    assert got.count() == 4
    assert rows(reconcile.current_rows(got, NOW), "company_name_internal") == [("f",)]
    assert rows(reconcile.withdrawn_rows(got), "company_name_external") == [("b",)]
    assert rows(got, "ticker") == [("y",), (None,), (None,), (None,)]
    assert ("x",) in rows(reconcile.reconcile(external, deals, prefer_external_ticker=True), "ticker")
    assert rows(reconcile.ticket_listings(got), "company_name") == [("a",), ("b",), ("d",), ("f",)]


def ticket(**given):
    return dict(formatted_company_name=given["company_name"].lower(), **given)


def test_ticket_decisions(spark):
    old = frame(
        spark,
        schemas.TICKET_LEDGER,
        ticket(company_name="Same", ipo_date=D, cusip="c", ticker="t", ticket_number=1, ticket_status="Open", ticket_created=T),
        ticket(company_name="Moved", ipo_date=D, ticket_number=2, ticket_status=None, ticket_created=T),
        ticket(company_name="Done", ipo_date=D, ticket_number=3, ticket_status="Resolved", ticket_created=T),
        ticket(company_name="NoDate", ticket_number=4, ticket_status="Open", ticket_created=T),
    )
    new = frame(
        spark,
        schemas.TICKET_LISTING,
        ticket(company_name="Same", ipo_date=D, last_checked=T),
        ticket(company_name="Moved", ipo_date=dt.date(2024, 7, 1), last_checked=T),
        ticket(company_name="Moved", ipo_date=D, last_checked=dt.datetime(2024, 5, 1)),
        ticket(company_name="Done", ipo_date=dt.date(2024, 7, 1), last_checked=T),
        ticket(company_name="NoDate", last_checked=T),
        ticket(company_name="Fresh", ipo_date=D, last_checked=T),
    )
    # a date missing on both sides counts as changed
    assert rows(tickets.ticket_updates(new, old), "ticket_number") == [(2,), (4,)]
    main = tickets.ledger(new, old)
    assert rows(main, "company_name", "ticket_number") == [("Done", 3), ("Fresh", None), ("Moved", 2), ("NoDate", 4), ("Same", 1)]
    assert rows(tickets.new_tickets(main), "company_name") == [("Fresh",)]
    gone = tickets.withdrawn_tickets(new.where("company_name IN ('Moved', 'Done')"), old)
    assert rows(tickets.mark_withdrawn(old, gone), "ticket_number", "status", "ticket_status") == [(1, None, "Open"), (2, "Withdrawn", "Resolved"), (3, None, "Resolved"), (4, None, "Open")]
    made = spark.createDataFrame([("Fresh", 9, "l", T, "Pending")], "company_name string, ticket_number long, ticket_link string, ticket_created timestamp_ntz, ticket_status string")
    merged = tickets.merge_created(main, made)
    assert ("Fresh", 9, "Pending") in rows(merged, "company_name", "ticket_number", "ticket_status")
    payload = tickets.create_payload(tickets.new_tickets(main), SYSTEM).first().payload
    assert '"Title":"Fresh - "' in payload and '"AnswerValue":"2024-06-20"' in payload
    assert tickets.close_payload(main, SYSTEM).count() == 4


def test_health(spark):
    polls = spark.createDataFrame([("a", 1, "3"), ("a", 0, "2"), ("b", 0, "2"), ("b", 1, "1"), ("c", 1, "1")], "source string, result int, time_checked string")
    assert rows(health.health_report(polls, 2)) == [("a", 1, 50.0, "2", "3"), ("b", 0, 0.0, "2", "1")]
    assert [r.source for r in health.worst_first(health.health_report(polls, 2)).collect()] == ["b", "a"]


def test_registry(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"source_name": "A", "source_type": "website", "cell_elem": ["th", "td"], "columns": ["x", "y"], "table_attrs": {"class": "c"}}, {"source_name": "B", "source_type": "other", "cell_elem": "td", "columns": ["z"]}]')
    made = registry.read_registry(spark, str(tmp_path / "r.json"))
    assert rows(registry.column_reference(made)) == [("A", "x", 1), ("A", "y", 2), ("B", "z", 1)]
    assert rows(registry.source_table(made), "source_name", "cell_elem", "table_attrs") == [("A", "th, td", '{"class":"c"}'), ("B", "td", None)]
    assert registry.sources_of_type(made, "other").count() == 1
    assert registry.registry_configs(made)["A"]["cell_elem"] == ["th", "td"]
    with pytest.raises(ValueError):
        registry.sources_of_type(made, "mail")


def test_a_failing_source_is_left_out(spark):
    names = "company_name string, ticker string, ipo_date string, exchange string, location string, time_added string, time_removed string"
    good = spark.createDataFrame([("A", "t", "02/03/2024", "Euronext", "Paris", "2024-01-01", None)], names)
    made = batch.normalise_all({"Euronext": good, "KRX": good.drop("ticker", "company_name")}, NOW)
    assert rows(made.frame, "company_name", "exchange") == [("A", "Euronext Paris")]
    assert "KRX" in made.failed and "Japan" in made.failed and "Euronext" not in made.failed


def test_whole_run(spark):
    listings = frame(
        spark,
        schemas.LISTING,
        dict(company_name="Acme Ltd", ticker="A", exchange="NYSE", ipo_date=D, price=1.0, time_added=T),
        dict(company_name="Beta", ticker="B", exchange="NYSE", status="Withdrawn", time_added=T),
        dict(company_name="Unknown", ticker="U", exchange="NYSE", ipo_date=D, time_added=T),
    )
    known = frame(spark, schemas.ENTITY_MAP, dict(company_name="Acme Ltd", iconum=1, entityname="Acme"), dict(company_name="Beta", iconum=2, entityname="Beta"))
    deals = frame(
        spark,
        schemas.DEALS,
        dict(iconum=1, company_name="Acme", master_deal=10, ticker="A", cusip="C1", trading_date=dt.datetime(2024, 6, 21), price=1.0, last_updated_date_utc=T),
        dict(iconum=2, company_name="Beta", master_deal=20, ticker="B", last_updated_date_utc=T),
    )
    done = batch.decide(listings, known, deals, NOW)
    assert rows(done.work_items, "COMPANY_NAME") == [("Acme Ltd",), ("Unknown",)]
    assert rows(done.entity_worklist, "company_name") == [("Unknown",)]
    assert rows(done.current, "company_name_external") == [("Acme Ltd",), ("Unknown",)]
    assert rows(done.withdrawn, "company_name_external") == [("Beta",)]
    stored = frame(
        spark,
        schemas.TICKET_LEDGER,
        ticket(company_name="Beta", ticket_number=5, ticket_status="Open", ticket_created=T),
        dict(company_name="Acme Ltd", formatted_company_name="acme", ipo_date=D, cusip="C0", ticket_number=6, ticket_status="Open", ticket_created=T),
    )
    manual = spark.createDataFrame([("U\tx", None, 7, "l", T, "Open")], "ticker string, cusip string, ticket_number long, ticket_link string, ticket_created timestamp_ntz, ticket_status string")
    feed = spark.createDataFrame([(6, "Open", None)], schemas.TICKET_FEED)
    out = batch.decide_tickets(done.current, done.withdrawn, stored, manual, feed, "https://t.example/")
    assert rows(out.to_withdraw, "ticket_number") == [(5,)]
    assert rows(out.to_update, "ticket_number", "cusip") == [(6, "C1")]
    assert rows(out.to_open, "company_name") == [("Unknown",)]
    assert ("Beta", 5, "Withdrawn", "Resolved") in rows(out.ledger, "company_name", "ticket_number", "status", "ticket_status")
    assert conform(out.ledger, schemas.TICKET_LEDGER).columns == out.ledger.columns


def test_a_run_saves_its_results(spark, tmp_path):
    names = "company_name string, ticker string, ipo_date string, exchange string, location string, time_added string, time_removed string"
    source = spark.createDataFrame([("A", "t", "20/06/2024", "Euronext", "Paris", "2024-01-01", None)], names)
    deals = frame(spark, schemas.DEALS, dict(iconum=1, company_name="A", master_deal=10, last_updated_date_utc=T))
    for _ in range(2):  # a later run replaces what the first one saved
        failed = batch.run({"Euronext": source}, frame(spark, schemas.ENTITY_MAP), deals, NOW, str(tmp_path))
    assert "KRX" in failed
    saved = {n: VersionedTable(spark, f"{tmp_path}/{n}") for n in ("all_listings", "work_items", "current", "withdrawn")}
    assert saved["all_listings"].current() == 2
    assert rows(saved["all_listings"].read(), "company_name", "status") == [("A", "Upcoming")]
    assert rows(saved["work_items"].read(), "COMPANY_NAME", "MASTER_DEAL") == [("A", 10)]
    assert saved["current"].read().count() == 1 and saved["withdrawn"].read().count() == 0


def test_a_whole_run_twice(spark, tmp_path):
    """Deals refreshed, names mapped, health and tickets saved; the second run starts from what the first one saved."""
    names = "company_name string, ticker string, ipo_date string, exchange string, location string, time_added string, time_removed string"
    listed = [("Acme Bakery", "A", "20/06/2024"), ("Bravo Mining Group", "B", "21/06/2024")]
    source = spark.createDataFrame([(n, t, d, "Euronext", "Paris", "2024-01-01", None) for n, t, d in listed], names)
    universe = spark.createDataFrame([("Acme Bakery", "000001-E"), ("Bravo Mining Groop", "000002-E")], "entityname string, entity_id string")
    old = frame(spark, schemas.DEALS, dict(iconum=1, company_name="Acme Bakery", master_deal=10, cusip="C1", ticker="A", last_updated_date_utc=T))
    new = frame(spark, schemas.DEALS, dict(iconum=1, company_name="Acme Bakery", master_deal=10, cusip="C2", ticker="A", last_updated_date_utc=T + dt.timedelta(days=1)))
    polls = spark.createDataFrame([("Euronext", 1, "2024-06-18"), ("Euronext", 0, "2024-06-17")], "source string, result int, time_checked string")
    manual = spark.createDataFrame([], "ticker string, cusip string, ticket_number long, ticket_link string, ticket_created timestamp_ntz, ticket_status string")
    feed = spark.createDataFrame([(7, "Resolved", None)], schemas.TICKET_FEED)
    ledger = frame(
        spark,
        schemas.TICKET_LEDGER,
        ticket(company_name="Acme Bakery", ticket_number=6, ticket_status="Open", ticket_created=T),
        dict(company_name="Bravo Mining Group", formatted_company_name="bravo mining group", cusip="C0", ticket_number=7, ticket_status="Open", ticket_created=T),
    )
    known, deals = frame(spark, schemas.ENTITY_MAP), old
    saved = {n: VersionedTable(spark, f"{tmp_path}/{n}") for n in "deals entity_map ticket_ledger ticket_outbox health clean-euronext".split()}
    for version in (1, 2):
        inputs = batch.TicketInputs(ledger, manual, feed, "https://t.example/", SYSTEM)
        batch.run({"Euronext": source}, known, deals, NOW, str(tmp_path), new, universe, polls, inputs)
        assert {t.current() for t in saved.values()} == {version}
        known, deals, ledger = (saved[n].read() for n in ("entity_map", "deals", "ticket_ledger"))
        assert rows(deals, "cusip") == [("C2",)]
        assert rows(known.where("mapstatus = 'MAPPED'"), "company_name", "iconum") == [("Acme Bakery", 1), ("Bravo Mining Group", 2)]
        assert rows(saved["health"].read(), "source", "result") == [("Euronext", 1)]
        sent = saved["ticket_outbox"].read()
        assert rows(sent.where("ticket_number = 7")) == []  # the feed calls it resolved
        wanted = [("answers", 6), ("comment", 6)] if version == 1 else []
        assert rows(sent.where("ticket_number = 6"), "kind", "ticket_number") == wanted
        assert rows(ledger.where("ticket_number = 7"), "ticket_status") == [("Resolved",)]


def test_nothing_is_sent_to_a_resolved_ticket(spark):
    changed = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "ticket_number long, company_name string")
    feed = spark.createDataFrame([(1, "Resolved", None), (2, "Completed", None)], schemas.TICKET_FEED)
    assert rows(tickets.still_open(changed, feed), "ticket_number") == [(2,), (3,)]


def test_folders_are_new_each_time(spark):
    assert run_folder(spark, "x") != run_folder(spark, "x")
