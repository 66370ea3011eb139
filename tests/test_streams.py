"""Streams with keyed state."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from listingflow.operators import health
from listingflow.streaming import jobs, keyed


def day(n, hour=0):
    return dt.datetime(2024, 1, n, hour)


def arrive(spark, folder, schema, *batches):
    """A stream of one batch for each list of rows; folders are listed in their order."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


SEEN = "name string, nr long, ts timestamp_ntz"


def test_first_sightings_are_kept_for_good(spark, tmp_path):
    big = 2**60 + 1
    batches = [
        [("a", 1, day(5)), ("a", 1, day(3)), ("b", None, day(4)), (None, None, day(6)), ("k", 7, day(9))],
        [("a", 1, day(1)), ("b", None, day(1)), ("c", big, None), ("c", big, day(8)), (None, 2, None)],
    ]
    known = spark.createDataFrame([("k", 7), ("k", 7), ("old", None)], "name string, nr long")
    place = (f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    stream = arrive(spark, tmp_path, SEEN, *batches)
    jobs.first_seen(stream, ["name", "nr"], "ts", *place, known=known).awaitTermination()
    first = [("a", 1, day(3)), ("b", None, day(4)), (None, None, day(6)), ("c", big, day(8)), (None, 2, None)]
    assert rows(spark.read.parquet(place[0])) == rows(spark.createDataFrame(first, SEEN))
    # started again, with the same known keys and new files
    stream = arrive(spark, tmp_path, SEEN, [("a", 1, day(2)), ("old", None, day(2)), ("new", 3, day(7)), (None, None, day(1))])
    jobs.first_seen(stream, ["name", "nr"], "ts", *place, known=known).awaitTermination()
    assert rows(spark.read.parquet(place[0])) == rows(spark.createDataFrame([*first, ("new", 3, day(7))], SEEN))


def test_first_sightings_need_no_python_state(spark, tmp_path):
    place = (f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    data = [(f"k{i % 300}", i % 2, None if i % 5 == 0 else day(1 + i % 28)) for i in range(3000)]
    known = spark.createDataFrame([("k1", 1), ("k3", 1), ("gone", None)], "name string, nr long")
    jobs.first_seen(arrive(spark, tmp_path, SEEN, data), ["name", "nr"], "ts", *place, known=known).awaitTermination()
    least = spark.createDataFrame(data, SEEN).groupBy("name", "nr").agg(F.min("ts").alias("ts"))
    assert rows(spark.read.parquet(place[0])) == rows(least.join(known, ["name", "nr"], "left_anti"))
    # the whole state is a row per key, held by Spark itself
    state = spark.read.format("statestore").load(place[1])
    assert rows(state.select("key.name", "key.nr")) == rows(least.select("name", "nr").union(known).distinct())
    # known keys are those of the first start, whatever is given later
    more = [("k1", 1, day(1)), ("late", 1, day(2)), ("gone", None, day(2))]
    for i, given in enumerate([None, spark.createDataFrame([("again 1", 1)], "name string, nr long")]):
        stream = arrive(spark, tmp_path, SEEN, [*more, (f"again {i}", 1, day(3))])
        jobs.first_seen(stream, ["name", "nr"], "ts", *place, known=given).awaitTermination()
    seen = spark.read.parquet(place[0]).where("name = 'late' OR name LIKE 'again%' OR name = 'gone'")
    assert rows(seen) == [("again 0", 1, day(3)), ("again 1", 1, day(3)), ("late", 1, day(2))]


def test_whole_pieces_have_one_row_per_key_of_a_partition(spark):
    data = [(f"k{i % 7}", i % 2, None if i % 11 == 0 else day(1 + i % 28)) for i in range(30_000)]
    frame = spark.createDataFrame(data, SEEN).repartition(3, "name", "nr")
    thin = keyed.combined(frame, ["name", "nr"], [("ts", "min", "ts")], whole=True)
    assert rows(thin) == rows(frame.groupBy("name", "nr").agg(F.min("ts").alias("ts")))


def test_pieces_keep_the_earliest_of_each_key(spark):
    data = [(None if i % 5 == 0 else f"k{i % 7}", None if i % 3 == 0 else i % 2, None if i % 11 == 0 else day(1 + i % 28)) for i in range(2000)]
    frame = spark.createDataFrame(data, SEEN).repartition(3)
    thin = keyed.combined(frame, ["name", "nr"], [("ts", "min", "ts")])
    assert thin.count() < 200
    least = lambda df: df.groupBy("name", "nr").agg(F.min("ts"))
    assert rows(least(thin)) == rows(least(frame))


@pytest.mark.parametrize(("kind", "stamp"), [("string", lambda d, h: f"2024-01-{d:02} {h:02}"), ("timestamp", day), ("timestamp_ntz", day), ("date", lambda d, h: dt.date(2024, 1, d))])
def test_health_of_late_polls_equals_the_batch_report(spark, tmp_path, kind, stamp):
    rnd = random.Random(4)
    schema = f"source string, result int, time_checked {kind}"
    polls = [(rnd.choice(["a", "a", "a", "b", "c"]), rnd.choice([0, 1, 1, None]), stamp(rnd.randrange(5, 29), rnd.randrange(3))) for _ in range(300)]
    polls += [("silent", 1, stamp(1, 0)), ("a", 1, None), (None, 1, stamp(28, 2)), ("only failures", 0, stamp(28, 1))]
    rnd.shuffle(polls)
    stream = arrive(spark, tmp_path, schema, polls[:100], polls[100:101], polls[101:])
    place = f"{tmp_path}/checkpoint"
    jobs.source_health(stream, place, 6).awaitTermination()
    frame = spark.createDataFrame(polls, schema)
    got = keyed.health_so_far(spark, place, 6)
    assert rows(got) == rows(health.health_report(frame, 6))
    recent = spark.read.format("statestore").option("stateVarName", "recent").load(place)
    assert recent.groupBy("key.source").count().agg(F.max("count")).first()[0] <= 6


def test_a_source_without_polls_is_forgotten(spark, tmp_path):
    schema = "source string, result int, time_checked string"
    place = f"{tmp_path}/checkpoint"
    stream = arrive(spark, tmp_path, schema, [("a", 1, "1"), ("b", 1, "1")])
    with pytest.raises(ValueError):
        jobs.source_health(stream, place, 3, forget_after=1)
    running = jobs.source_health(stream, place, 3, every="1 second", forget_after=2000)
    try:
        end = time.time() + 60
        while time.time() < end:
            time.sleep(2)
            held = spark.read.format("statestore").option("stateVarName", "recent").load(place) if running.lastProgress else None
            if running.lastProgress and running.lastProgress["batchId"] > 1 and held.isEmpty():
                break
        else:
            raise AssertionError("the sources are still known")
    finally:
        running.stop()
