import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import types as T

from listingflow.operators import history
from listingflow.operators.history import HistoryStore
from listingflow.streaming import jobs

from conftest import rows

T0 = dt.datetime(2024, 1, 1)


def snap(spark, values):
    return spark.createDataFrame(values, "name string, price string")


def test_diff_rules(spark):
    old = spark.createDataFrame(
        [("a", None, T0, None), ("a", None, T0, None), ("b", "1", T0, None), ("c", "1", T0, T0), (None, None, T0, None), ("d", "1", T0, T0)],
        "name string, price string, time_added timestamp_ntz, time_removed timestamp_ntz",
    )
    new = snap(spark, [("a", None), ("a", None), ("c", "1"), (None, None), ("e", "2"), ("e", "2")])
    now = dt.datetime(2024, 1, 2)
    got = rows(history.snapshot_diff(old, new, now))
    assert got == sorted(
        [("a", None, T0, None), ("b", "1", T0, now), ("c", "1", T0, T0), ("d", "1", T0, T0), ("e", "2", now, None), (None, None, T0, None)],
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )
    assert ("c", "1", T0, None) in rows(history.snapshot_diff(old, new, now, reopen=True))
    # the same snapshot again changes nothing
    once = history.snapshot_diff(old, new, now)
    assert rows(history.snapshot_diff(once, new, dt.datetime(2024, 1, 3))) == got


def _random_polls(seed, sources=3, polls=6, names=8):
    pick = random.Random(seed)
    return [
        (f"s{s}", pick.choice([f"n{n}", None]) if n == 0 else f"n{n}", T0 + dt.timedelta(hours=p))
        for s in range(sources)
        for p in range(polls)
        for n in range(names)
        if pick.random() < 0.6
    ]


SCHEMA = "source string, name string, time_checked timestamp_ntz"


def _sequential(spark, log):
    """Poll by poll, source by source, with snapshot_diff."""
    done = None
    for source in sorted({r[0] for r in log}):
        state = None
        for when in sorted({r[2] for r in log if r[0] == source}):
            new = spark.createDataFrame([(r[0], r[1]) for r in log if r[0] == source and r[2] == when], "source string, name string")
            state = history.start_history(new, when) if state is None else history.snapshot_diff(state, new, when)
            state = spark.createDataFrame(state.collect(), state.schema)
        done = state if done is None else done.unionByName(state)
    return done


def test_folding_a_log_equals_poll_by_poll(spark):
    log = _random_polls(1)
    folded = history.fold_polls(spark.createDataFrame(log, SCHEMA))
    assert rows(folded, "source", "name", "time_added", "time_removed") == rows(_sequential(spark, log), "source", "name", "time_added", "time_removed")


def test_store_in_batches_equals_one_fold_and_survives_replay(spark, tmp_path):
    log = _random_polls(2, polls=9)
    store = HistoryStore(spark, str(tmp_path / "history"))
    for version, hours in enumerate([range(0, 3), range(3, 4), range(4, 9)]):
        part = [r for r in log if (r[2] - T0).seconds // 3600 in hours]
        for _ in range(2):  # the second time is a replay
            store.fold(spark.createDataFrame(part, SCHEMA), version)
    want = history.fold_polls(spark.createDataFrame(log, SCHEMA))
    columns = ["source", "name", "time_added", "time_removed"]
    assert rows(store.history(), *columns) == rows(want, *columns)


def test_a_fold_reads_as_much_however_many_rows_are_closed(spark, tmp_path):
    store, read = HistoryStore(spark, str(tmp_path / "history"), slots=16), []
    own = store._read

    def recorded(kind, paths):
        read.append((kind, sum(f.stat().st_size for p in paths for f in pathlib.Path(p).rglob("*.parquet"))))
        return own(kind, paths)

    store._read = recorded
    rnd, bytes_read, closed = random.Random(3), [], []
    kept = [("steady", f"k{i}") for i in range(50)]
    for version in range(8):
        at = T0 + dt.timedelta(hours=version)
        passing = [("busy", f"v{version}-{i}-{rnd.random()}") for i in range(20 * 2**version)]
        polled = [(s, n, at) for s, n in (kept if version % 2 else [*kept, *passing])]
        empty = spark.createDataFrame([("busy", at)], "source string, time_checked timestamp_ntz")
        read.clear()
        store.fold(spark.createDataFrame(polled, SCHEMA), version, empty)
        if version % 2:  # a poll that brings nothing new
            bytes_read.append(sum(size for kind, size in read if kind == "closed"))
        closed.append(store.closed_rows().count() if version else 0)
    assert closed[-1] > 10 * closed[1] > 0 and bytes_read == [0] * 4
    with pytest.raises(ValueError):
        HistoryStore(spark, str(tmp_path / "history"), slots=8).history()


def test_a_fold_leaves_other_sources_alone_and_keeps_closed_rows_closed(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "history"), slots=1000)
    at = [T0 + dt.timedelta(hours=h) for h in range(4)]
    store.fold(spark.createDataFrame([("a", "x", at[0]), ("a", "y", at[0]), ("b", "z", at[0]), ("b", None, at[0])], SCHEMA), 0)
    store.fold(spark.createDataFrame([("a", "x", at[1])], SCHEMA), 1)
    store.fold(spark.createDataFrame([("a", "x", at[2]), ("a", "y", at[2])], SCHEMA), 2)  # y was closed
    versions = {p.name: sorted(q.name for q in p.iterdir() if q.is_dir()) for p in (tmp_path / "history/open").iterdir() if p.is_dir()}
    assert [len(versions[f"version={v}"]) for v in range(3)] == [2, 1, 1]
    columns = ["source", "name", "time_added", "time_removed"]
    assert rows(store.history(), *columns) == sorted([("a", "x", at[0], None), ("a", "y", at[0], at[1]), ("b", "z", at[0], None), ("b", None, at[0], None)], key=lambda r: tuple((x is None, str(x)) for x in r))


def test_an_empty_poll_closes_rows(spark):
    seen = spark.createDataFrame([("s", "a", T0)], SCHEMA)
    later = T0 + dt.timedelta(hours=1)
    polls = spark.createDataFrame([("s", T0), ("s", later), ("other", later)], "source string, time_checked timestamp_ntz")
    assert rows(history.fold_polls(seen, polls=polls), "time_removed") == [(later,)]


def test_stream_of_files_equals_batch(spark, tmp_path):
    log = _random_polls(3)
    folder = str(tmp_path / "in")
    for hour in range(6):
        part = [r for r in log if r[2] == T0 + dt.timedelta(hours=hour)]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    schema = T.StructType.fromDDL(SCHEMA)
    store = HistoryStore(spark, str(tmp_path / "history"))
    for _ in range(2):  # a restart finds nothing new
        stream = jobs.read_folder_stream(spark, folder, schema, files_per_batch=1)
        jobs.snapshots_to_history(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    columns = ["source", "name", "time_added", "time_removed"]
    assert store.log.current() == 5
    assert rows(store.history(), *columns) == rows(_sequential(spark, log), *columns)


def test_close_out_keeps_null_ids_apart(spark):
    df = spark.createDataFrame(
        [(1, "20240102a", None), (2, "20240101a", None), (2, "20240101b", T0), (None, "20240101a", None)],
        "id int, file string, time_removed timestamp_ntz",
    )
    now = dt.datetime(2024, 2, 1)
    got = rows(history.close_out(df, "id", "file", now))
    assert got == [(1, "20240102a", None), (2, "20240101a", now), (2, "20240101b", T0), (None, "20240101a", now)]


def test_changed_rows(spark):
    df = spark.createDataFrame(
        [(1, "d", "d", "c", "c"), (2, None, None, "c", "c"), (3, "d", "d", None, "c"), (4, "d", "d", "x", "c"), (5, "d", "d", "c", None)],
        "i int, day string, day_old string, cusip string, cusip_old string",
    )
    assert rows(history.changed_rows(df, ["day"], ["cusip"]), "i") == [(2,), (4,), (5,)]


def test_redirect(spark):
    ledger = spark.createDataFrame([(1, "x/1", "Open"), (2, "x/2", "Open"), (3, "x/3", "Open")], "ticket_number long, ticket_link string, ticket_status string")
    feed = spark.createDataFrame([(1, "Resolved", 9), (2, "Resolved", None)], "ticket_number long, status string, duplicate_of long")
    got = rows(history.redirect_superseded(ledger, feed, "x/"))
    assert got == [(2, "x/2", "Resolved"), (3, "x/3", "Open"), (9, "x/9", "")]
