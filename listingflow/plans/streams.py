"""The streaming jobs run to the end of the test tables; the result is checked against plain SQL over the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import dates
from ..operators.history import HistoryStore
from ..session import run_folder
from ..streaming import jobs, keyed
from .catalog import Tables, query
from .columns_and_rows import POLL_HISTORY
from .matching import health_sql


def _events(t: Tables) -> DataFrame:
    return jobs.read_folder_stream(t.spark, t.folder, t.events.schema, glob="events.parquet")


def _replayed(rows: DataFrame, dealt_by, folder: str, batches: int = 3) -> DataFrame:
    """The rows written to as many folders as the stream that reads them is to have batches."""
    rows.withColumn("batch", F.pmod(F.hash(dealt_by), F.lit(batches))).repartition("batch").write.partitionBy("batch").parquet(folder)
    stream = rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("basePath", folder)
    return stream.parquet(f"{folder}/batch=*")


# A source of its own is polled on two days: users on the first, nobody on the second.
_EMPTIED = "UNION ALL SELECT 'emptied', user_id, TIMESTAMP '2023-01-01 00:00:00' AS time_added, TIMESTAMP '2023-01-02 00:00:00' AS time_removed FROM events GROUP BY user_id"


@query("stream_snapshot", f"SELECT * FROM ({POLL_HISTORY}) h {_EMPTIED}")
def stream_snapshot(t: Tables) -> DataFrame:
    folder = run_folder(t.spark, "stream-snapshot")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    polled = [
        (F.col("event_type"), F.col("user_id"), day, False),
        (F.lit("emptied"), F.col("user_id"), dates.as_of_stamp("2023-01-01"), False),
        (F.lit("emptied"), F.lit(None).cast("long"), dates.as_of_stamp("2023-01-02"), True),
    ]
    names = ("source", "user_id", "time_checked", "nothing")
    rows = F.array(*[F.struct(*[(F.lit(v) if isinstance(v, bool) else v).alias(n) for v, n in zip(p, names, strict=True)]) for p in polled])
    store = HistoryStore(t.spark, f"{folder}/history")
    jobs.snapshots_to_history(_events(t).select(F.inline(rows)), store, f"{folder}/checkpoint", empty="nothing").awaitTermination()
    return store.history()


@query("stream_first_seen", "SELECT user_id, event_type, min(ts) AS ts FROM events GROUP BY ALL")
def stream_first_seen(t: Tables) -> DataFrame:
    folder = run_folder(t.spark, "stream-first")
    listings = t.events.select("user_id", "event_type", "ts")
    # the earlier half of the days was seen before the stream began; the stream brings all of them, a key's in one batch
    before = listings.where("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'").groupBy("user_id", "event_type").agg(F.min("ts").alias("ts"))
    before.write.parquet(f"{folder}/before")
    known = t.spark.read.parquet(f"{folder}/before")
    replayed = _replayed(listings, F.hash("user_id", "event_type"), f"{folder}/arriving")
    jobs.first_seen(replayed, ["user_id", "event_type"], "ts", f"{folder}/seen", f"{folder}/checkpoint", known=known).awaitTermination()
    return known.unionByName(t.spark.read.schema(listings.schema).parquet(f"{folder}/seen"))


@query("stream_first_arrival", "SELECT DISTINCT user_id, event_type FROM events")
def stream_first_arrival(t: Tables) -> DataFrame:
    folder = run_folder(t.spark, "stream-arrival")
    listings = _events(t).select("user_id", "event_type", dates.as_instant("ts").alias("ts"))
    first = jobs.first_arrival(listings, ["user_id", "event_type"], "ts", "40 days")
    jobs.to_files(first, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{folder}/out").select("user_id", "event_type")


@query(
    "stream_health_windows",
    """SELECT 'user' || user_id AS source, CAST(CAST(ts AS DATE) AS STRING) AS window_day, count(*) AS polls, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS successes FROM events
       GROUP BY ALL HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""".replace(
        "GROUP BY ALL HAVING CAST(ts AS DATE)", "GROUP BY user_id, CAST(ts AS DATE) HAVING CAST(ts AS DATE)"
    ),
)
def stream_health_windows(t: Tables) -> DataFrame:
    folder = run_folder(t.spark, "stream-windows")
    polls = _events(t).select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("source"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("result"),
        dates.as_instant("ts").alias("ts"),
    )
    windows = jobs.health_windows(polls, "ts", "1 day", "1 day")
    jobs.to_files(windows, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{folder}/out").select("source", dates.iso_text(dates.drop_zone("window_start")).alias("window_day"), "polls", "successes")


@query("stream_health", health_sql(10))
def stream_health(t: Tables) -> DataFrame:
    folder = run_folder(t.spark, "stream-health")
    polls = t.events.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("source"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("result"),
        F.date_format("ts", "yyyy-MM-dd").alias("time_checked"),
        "ts",
    )
    # dealt by row, so every batch brings polls from all over the month, and most come late
    replayed = _replayed(polls, F.xxhash64("ts", "source"), f"{folder}/arriving")
    jobs.source_health(replayed.drop("ts"), f"{folder}/checkpoint", 10).awaitTermination()
    return keyed.health_so_far(t.spark, f"{folder}/checkpoint", 10)
