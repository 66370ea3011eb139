import random

import pytest
from pyspark.sql import functions as F

from listingflow.operators import aggregates, columns, dedupe, filters, joins, ordering

from conftest import rows


def random_frame(spark, seed, names, n=60, top=8):
    pick = random.Random(seed)
    data = [tuple(pick.choice([None, *range(top)]) for _ in names) for _ in range(n)]
    return spark.createDataFrame(data, ", ".join(f"{c} int" for c in names))


def test_or_join_equals_the_literal_one(spark):
    for seed in range(3):
        a, b = random_frame(spark, seed, ["a1", "a2", "a3"], 20), random_frame(spark, seed + 9, ["b1", "b2"], 20)
        literal = a.join(b, (F.col("a1") == F.col("b1")) | (F.col("a2") == F.col("b2")), "left")
        assert rows(joins.left_on_either(a, b, [("a1", "b1"), ("a2", "b2")])) == rows(literal)


@pytest.mark.parametrize("hot", ["left", "right", "both", "none"])
def test_hot_keys_are_dealt_over_salts(spark, hot):
    def side(name, many):
        data = [(7, f"{name}{i}") for i in range(400 if many else 1)] + [(i, f"{name}{i}") for i in range(8, 300, 2 if name == "l" else 3)]
        data += [(None, f"{name}{i}") for i in range(5)] + [(1001 if name == "l" else 1000, f"{name}!{i}") for i in range(200 if many else 1)]
        return spark.createDataFrame(data, f"k long, {name} string")

    a, b = side("l", hot in ("left", "both")), side("r", hot in ("right", "both"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for kind, got in (("full_outer", joins.full_outer(a, b, "k")), ("left", joins.left(a, b, "k", hot_right=True))):
            assert rows(got, "k", "l", "r") == rows(a.join(b, "k", kind), "k", "l", "r")
        keys = [joins.keyed(joins._present(x, ["k"]), ["k"]).select("_hash") for x in (a, b)]
        found = joins.hot_keys(*keys)
        assert found.count() == {"left": 2, "right": 2, "both": 3, "none": 0}[hot]
        dealt = joins.salted(joins.keyed(a, ["k"], True), found, 0)
        if hot == "left":
            assert dealt.count() == a.count() and dealt.where("k = 7").groupBy("_salt").count().agg({"count": "max"}).first()[0] < 60
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_full_outer_reads_each_side_once(spark, tmp_path):
    for name in "ab":
        spark.createDataFrame([(1, "x")], f"k long, {name} string").write.parquet(str(tmp_path / name))
    plan = joins.full_outer(*[spark.read.parquet(str(tmp_path / n)) for n in "ab"], "k")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert len([s for s in scans if "a:string" in s]) == len([s for s in scans if "b:string" in s]) == 1
    # the sketch reads the keys alone
    assert all("ReadSchema: struct<k:bigint>" in s for s in scans if "a:string" not in s and "b:string" not in s)


def test_full_outer_equals_sparks(spark):
    a, b = random_frame(spark, 4, ["k", "x"]), random_frame(spark, 5, ["k", "x"])
    want = a.withColumnRenamed("x", "x_left").join(b.withColumnRenamed("x", "x_right"), "k", "full_outer")
    got = joins.full_outer(a, b, "k")
    assert rows(got, "k", "x_left", "x_right") == rows(want, "k", "x_left", "x_right")


def test_first_known_equals_repeated_anti_joins(spark):
    make = lambda seed: random_frame(spark, seed, ["t", "x"], 15, 12).select(F.concat(F.lit("A."), F.col("t").cast("string")).alias("ticker"), "x")
    frames = [make(s) for s in (1, 2, 3)]
    known = frames[0]
    for extra in frames[1:]:
        known = known.unionByName(joins.add_only_new(known, extra))
    assert rows(joins.first_known(frames)) == rows(known)


def test_null_keys_of_set_difference(spark):
    a = spark.createDataFrame([(1,), (None,)], "k int")
    b = spark.createDataFrame([(None,)], "k int")
    assert rows(joins.only_in_left(a, b, ["k"])) == [(1,), (None,)]
    assert rows(joins.only_in_left(a, b, ["k"], null_safe=True)) == [(1,)]


def test_fallback_only_where_allowed(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (1, 5, "x")], "k int, v int, place string")
    lookup = spark.createDataFrame([(1, 7), (2, 8)], "k int, w int")
    assert rows(joins.enrich_with_fallback(df, lookup, "k", {"v": "w"})) == [(1, 5, "x"), (1, 7, "x"), (2, 8, "y")]
    limited = joins.enrich_with_fallback(df, lookup, "k", {"v": "w"}, F.col("place") == "x")
    assert rows(limited) == [(1, 5, "x"), (1, 7, "x"), (2, None, "y")]


def test_keep_first_is_independent_of_partitioning(spark):
    df = random_frame(spark, 8, ["k", "t", "a", "b"], 300, 4)
    want = rows(dedupe.latest(df.coalesce(1), ["k"], "t"))
    assert rows(dedupe.latest(df.repartition(7), ["k"], "t")) == want
    assert len(want) == df.select("k").distinct().count()


def test_keep_first_drops_before_the_shuffle(spark):
    plan = dedupe.latest(random_frame(spark, 8, ["k", "t"]), ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in before and "Partial" in after


def test_upsert_prefers_updates(spark):
    base = spark.createDataFrame([(1, "a", "old"), (2, "b", "old"), (None, "c", "old")], "n int, f string, v string")
    new = spark.createDataFrame([(1, "a", "new"), (None, "c", "new")], "n int, f string, v string")
    assert rows(dedupe.keep_last(base, new, ["n", "f"])) == [(1, "a", "new"), (2, "b", "old"), (None, "c", "new")]


def test_audit(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    got = rows(dedupe.audit({"t": df, "empty": df.where("false")}))
    assert got == [("empty", 0, 0, 0), ("t", 3, 2, 1)]


def test_concat_orders(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "b", 3), (1, None, 9), (2, None, 1), (None, "z", 1)], "k int, v string, t int")
    assert rows(aggregates.concat_distinct(df, "k", ["v"])) == [(1, "a, b"), (2, None)]
    assert rows(aggregates.concat_distinct_newest(df, "k", "v", "t")) == [(1, "b, a")]


def test_running_last_for_any_block_size(spark):
    pick = random.Random(3)
    data = [(p, i, pick.random() < 0.2) for p in "xy" for i in range(100)]
    df = spark.createDataFrame(data, "p string, i long, m boolean")
    want, last = {}, {}
    for p, i, m in data:
        last[p] = i if m else last.get(p)
        want[p, i] = last[p]
    for block in (1, 7, 1000):
        got = aggregates.running_last(df, ["p"], "i", F.when(F.col("m"), F.col("i")), "r", block)
        assert {(r.p, r.i): r.r for r in got.collect()} == want


def test_update_reads_old_values(spark):
    df = spark.createDataFrame([("First Price 1", None), ("x", "y"), (None, "z")], "a string, b string")
    assert rows(columns.move_when_prefixed(df, "a", "b", "First")) == [("x", "y"), (None, "First Price 1"), (None, "z")]


def test_conform_is_tolerant(spark):
    df = spark.createDataFrame([("Acme", "12.5", "bad"), ("B", "n/a", "7")], "company_name string, price string, shares_offered string")
    got = columns.conform(df)
    assert len(got.columns) == 11
    assert rows(got, "company_name", "price", "shares_offered", "ipo_date") == [("Acme", 12.5, None, None), ("B", None, 7.0, None)]


def test_column_names():
    assert columns.database_name("Change (percent)+?") == "change_percent"


def test_paging_and_batches(spark):
    df = spark.createDataFrame([(i, f"2024010{i % 3}") for i in range(9)], "i int, f string")
    assert [r[0] for r in ordering.page(df, [("i", "desc")], 1, 4).collect()] == [4, 3, 2, 1]
    assert rows(filters.latest_batch(df, "f"), "i") == [(2,), (5,), (8,)]
    assert rows(ordering.top_distinct(df, "f", 2)) == [("20240101",), ("20240102",)]
