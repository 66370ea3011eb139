"""Work that is dealt over enough tasks, or done with less, whatever the size; each on rows of its own."""

from __future__ import annotations

from datetime import date, datetime

import pyarrow as pa
from pyspark.sql import functions as F

from listingflow.llm import common, words
from listingflow.operators import aggregates, entities, reconcile
from listingflow.plans import catalog, matching
from listingflow.sources import records


def _tables(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return catalog.Tables(spark, str(folder))


def test_decisions_are_made_by_as_many_tasks_as_they_need(spark, tmp_path, monkeypatch):
    t = _tables(
        spark,
        tmp_path,
        customer=([(i, f"C{i}", i % 2 or None, 0.0, "X") for i in range(40)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        supplier=([(i, f"S{i}", 1, 0.0) for i in range(30)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        nation=([(1, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
    )
    monkeypatch.setattr(matching, "_TASK_DECISIONS", 100)
    made = matching._decisions(t)
    per_task = [r["n"] for r in made.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(per_task) == 20 * 30 and len(per_task) >= 5
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, t.sql(matching._DECISIONS).collect()))


def test_best_decision_of_a_name_that_several_clients_share(spark):
    rows = [
        ("Acme_T1_NYSE", "MAPPED", "000001-E", "A", 0.9, 0.8),
        ("Acme_T1_NYSE", "mapped", "000002-E", "B", 0.9, 0.9),
        ("Acme_T2_NYSE", "MAPPED", "000003-E", "C", 0.9, 0.9),
        ("Acme_T2_NYSE", "UNMAPPED", "000004-E", "D", 1.0, 1.0),
        ("Bolt_T3_X", "MAPPED", "000005-E", "E", None, 0.9),
        ("Bolt_T3_X", "MAPPED", "000006-E", "F", 0.1, None),
        (None, "MAPPED", "000007-E", "G", 0.8, 0.1),
    ]
    df = spark.createDataFrame(rows, "clientId string, mapStatus string, entityId string, entityName string, confidenceScore double, similarityScore double")
    got = {(r.company_name, r.ticker, r.entity_id, r.mapstatus) for r in entities.decisions_to_map(df).collect()}
    assert got == {("Acme", "T1", "000002-E", "mapped"), ("Bolt", "T3", None, "UNMAPPED"), (None, None, "000007-E", "MAPPED")}


def _spied(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_value_needs_no_join_and_one_shuffle_of_the_rows(spark):
    rows = [(p, i, i if i % 7 == 3 else None, "x" * (i % 3)) for p in ("a", "b") for i in range(40)] + [(None, 1, 5, "n"), (None, 25, None, "m"), ("c", None, 9, "z")]
    df = spark.createDataFrame(rows, "page string, pos long, v long, cell string")
    ran = aggregates.running_last(df, ["page"], "pos", F.col("v"), "last", 10)
    assert "Join" not in _spied(ran)
    got = {(r.page, r.pos): r["last"] for r in ran.collect()}
    assert ran.columns == ["page", "pos", "v", "cell", "last"] and len(got) == len(rows)
    for p in ("a", "b"):
        for i in range(40):
            assert got[p, i] == max([j for j in range(i + 1) if j % 7 == 3], default=None)
    assert got[None, 1] == 5 and got[None, 25] is None and got["c", None] == 9


def _match_sides(spark, hot):
    listing = "company_name string, ticker string, exchange string, ipo_date date, price double, price_range string, shares_offered double, status string, notes string, time_added timestamp_ntz, time_removed timestamp_ntz, entityname string, iconum long"
    external = [(f"L{k}", "T", "X", date(2000, 1, 1 + k % 3), 1.0 * (k % 2), None, float(k), None, None, None, None, None, k % 5 if k % 7 else None) for k in range(20)]
    external += [(None, "T", "X", date(2000, 1, 1), 1.0, None, float(i), None, None, datetime(2000, 1, 1, i % 2), None, None, 1) for i in range(hot)]
    deal = "iconum long, company_name string, master_deal long, cusip string, client_deal_id string, ticker string, exchange string, price double, min_offering_price double, max_offering_price double, announcement_date timestamp_ntz, pricing_date timestamp_ntz, trading_date timestamp_ntz, closing_date timestamp_ntz, deal_status string, last_updated_date_utc timestamp_ntz"
    deals = [(k, "D", 10 * (k or 5), None, "c", "t", "X", 1.0, None, None, None, None, datetime(2000, 1, 1, h), None, "Open", datetime(2000, 1, 2, h)) for k in (0, 1, 2, None) for h in (1, 2)]
    deals += [(2, "D", i % 9, None, "c", "t", "X", 0.0, None, None, None, None, None, None, "Open", datetime(2000, 1, 2, i % 24)) for i in range(hot)]
    return spark.createDataFrame(external, listing), spark.createDataFrame(deals, deal)


def test_match_report_is_not_shuffled_after_the_join(spark):
    external, deals = _match_sides(spark, 300)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        report = reconcile.match_report(external, deals)
        plan = _spied(report)
        got = sorted(map(str, map(tuple, report.collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan[: plan.index("SortMergeJoin")]
    a, b = external.select("*").alias("a"), deals.alias("b")
    day = lambda c: F.col(c).cast("date")
    joined = a.join(b, F.expr("a.iconum = b.iconum"), "left").select(
        (F.coalesce(day("b.trading_date") == day("a.ipo_date"), F.lit(False)) | F.col("a.ipo_date").isNull()).alias("d"),
        (F.coalesce(F.col("b.price") == F.col("a.price"), F.lit(False)) | F.col("a.price").isNull()).alias("p"),
        "a.iconum", "a.company_name", "a.exchange", day("a.ipo_date").alias("i"), "a.price", "a.price_range", "a.status", "a.notes", "a.time_added",
        F.col("b.company_name").alias("n"), "b.master_deal", "b.client_deal_id", "b.cusip", "b.ticker", F.col("b.exchange").alias("e"), F.col("b.price").alias("q"),
        "b.min_offering_price", "b.max_offering_price", *[day(f"b.{c}").alias(c) for c in ("announcement_date", "pricing_date", "trading_date", "closing_date")],
        "b.deal_status", day("b.last_updated_date_utc").alias("u"),
    )
    assert got == sorted(map(str, map(tuple, joined.distinct().collect())))


def test_cells_are_dealt_over_as_many_tasks_as_asked_for(spark):
    cells = spark.createDataFrame([("a", i, f"c{i}" + ("#" if i % 5 == 0 else "")) for i in range(100)], "page string, pos long, cell string")
    made = records.marked_records(cells, ["page"], "pos", "cell", "#", ["x", "y"], block=10, tasks=7)
    assert "REPARTITION_BY_NUM" in _spied(made)
    plain = records.marked_records(cells, ["page"], "pos", "cell", "#", ["x", "y"], block=10)
    assert sorted(map(str, made.collect())) == sorted(map(str, plain.collect())) and made.count() == 20


def test_slices_of_a_batch_are_small_and_batches_are_released():
    batch = pa.RecordBatch.from_pydict({"text": ["word " * 20_000] * 10 + [None, "x" * 900_000]})
    slices = [texts for _, texts in words.text_slices(batch)]
    assert sum(map(len, slices)) == 12
    assert all(len(texts) == 1 or sum(len(t.as_py()) for t in texts) <= 400_000 for texts in slices)
    assert list(common.released(iter([batch, batch]))) == [batch, batch] and list(common.released(iter([]))) == []
