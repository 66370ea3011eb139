"""Joins on keys of different types against Spark's own join."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from listingflow.operators import history, joins

PAIRS = {
    "int/long": ("int", "long", ["1", "2", "2", None, "7"], ["2", "1", None, "9"]),
    "long/decimal": ("long", "decimal(12,2)", ["1", "2", "2", None, "7"], ["2", "1", None, "9.5"]),
    "date/timestamp": ("date", "timestamp_ntz", ["2020-01-01", "2020-01-02", None], ["2020-01-02 00:00:00", "2020-01-01 10:00:00", None]),
    "string/long": ("string", "long", ["1", "2", "02", None, "7"], ["2", "1", None, "9"]),
    "long/string": ("long", "string", ["1", "2", "2", None, "7"], ["2", " 1", None, "9"]),
}


def _sides(spark, name):
    a, b, x, y = PAIRS[name]
    made = []
    for kind, values, label in ((a, x, "l"), (b, y, "r")):
        df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k string, {label} int")
        made.append(df.withColumn("k", F.col("k").cast(kind)))
    return made


def _plain(spark, left, right, how):
    joined = left.alias("a").join(right.alias("b"), F.col("a.k") == F.col("b.k"), how)
    return joined.select("l") if how in ("left_semi", "left_anti") else joined.select("l", "r")


@pytest.mark.parametrize("name", PAIRS)
def test_same_matches_as_sparks_own_join(spark, name):
    a, b = _sides(spark, name)
    assert rows(joins.inner(a, b, "k"), "l", "r") == rows(_plain(spark, a, b, "inner"))
    assert rows(joins.left(a, b, "k"), "l", "r") == rows(_plain(spark, a, b, "left"))
    assert rows(joins.left(a, b, "k", hot_right=True), "l", "r") == rows(_plain(spark, a, b, "left"))
    assert rows(joins.full_outer(a, b, "k"), "l", "r") == rows(_plain(spark, a, b, "full"))
    assert rows(joins.semi(a, b, "k"), "l") == rows(_plain(spark, a, b, "left_semi"))
    assert rows(joins.only_in_left(a, b, ["k"]), "l") == rows(_plain(spark, a, b, "left_anti"))
    assert joins.inner(a, b, "k").schema["k"].dataType == a.schema["k"].dataType


@pytest.mark.parametrize("name", PAIRS)
def test_or_join_and_marks(spark, name):
    a, b = _sides(spark, name)
    right = b.withColumnRenamed("k", "m")
    expected = a.join(right, (F.col("k") == F.col("m")) | (F.col("l") == F.col("r")), "left").select("l", "r")
    assert rows(joins.left_on_either(a, right, [("k", "m"), ("l", "r")]), "l", "r") == rows(expected)
    marked = history.mark_members(a, b, "k", {"mark": F.lit("x")}).where("mark = 'x'")
    assert rows(marked, "l") == rows(_plain(spark, a, b.where("k is not null"), "left_semi"))


@pytest.mark.parametrize("name", ["int/long", "date/timestamp"])
def test_snapshot_of_another_type_closes_nothing_it_has(spark, name):
    a, b = _sides(spark, name)
    start = history.start_history(a.select("k"), "2020-01-01")
    got = history.snapshot_diff(start, b.select("k"), "2020-02-01")
    shared = _plain(spark, a, b, "left_semi").join(a, "l").select("k").distinct().count()
    assert got.where("time_removed is null and time_added = '2020-01-01'").count() == shared + 1  # and the null key
    assert got.count() == a.select("k").distinct().count() + b.select("k").distinct().count() - shared - 1


def test_texts_that_are_no_numbers_match_nothing(spark):
    a = spark.createDataFrame([("x", 1), (None, 2), ("3", 3)], "k string, l int")
    b = spark.createDataFrame([(None, 1), (3, 2)], "k long, r int")
    assert rows(joins.inner(a, b, "k"), "l") == [(3,)]
    assert rows(joins.only_in_left(a, b, ["k"], null_safe=True), "l") == [(1,)]
    assert rows(joins.full_outer(a, b, "k"), "k", "l", "r") == [("3", 3, 2), ("x", 1, None), (None, 2, None), (None, None, 1)]


def test_keys_without_a_common_type_are_refused(spark):
    a = spark.createDataFrame([(1, 1)], "k int, l int")
    b = spark.createDataFrame([([1], 1)], "k array<int>, r int")
    with pytest.raises(TypeError):
        joins.inner(a, b, "k")


def test_a_hot_key_is_split_without_broadcast(spark):
    """One key with a third of the rows: results stay whole and the plan's joins are fed by shuffles that can be split."""
    n = 3000
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("k"), F.col("id").alias("l"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("r"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.full_outer(left, right, "k")
        assert rows(got.groupBy("k").count()) == rows(_plain_full(left, right))
        plan = joins.inner(left, right, "k")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(_hash") == 2 and "Broadcast" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plain_full(left, right):
    joined = left.alias("a").join(right.alias("b"), F.col("a.k") == F.col("b.k"), "full")
    return joined.groupBy(F.coalesce("a.k", "b.k").alias("k")).count()
