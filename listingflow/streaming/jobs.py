"""Snapshot history, first-seen listings and source health as streams."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.health import RECENT_POLLS
from ..operators.history import HistoryStore
from . import keyed


def read_folder_stream(
    spark, folder: str, schema: T.StructType, fmt: str = "parquet", glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Files arriving in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def _start(writer, checkpoint: str, continuous: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def snapshots_to_history(
    snapshots: DataFrame, store: HistoryStore, checkpoint: str, every: str | None = None, empty: str | None = None
) -> StreamingQuery:
    """Fold each micro-batch of snapshots into the store.

    The batch id is the version, and a fold starts from the version before, so a replayed batch changes nothing.  Polls of
    one source must arrive in time order; a batch may hold many of them.  ``empty`` names a boolean column that marks the
    polls that returned nothing: such a row gives a source and a time only, and closes what the source had.
    """

    def fold(batch: DataFrame, number: int) -> None:
        if empty is None:
            store.fold(batch, number)
        else:
            marked = F.coalesce(F.col(empty), F.lit(False))
            store.fold(batch.where(~marked).drop(empty), number, batch.where(marked))

    return _start(snapshots.writeStream.foreachBatch(fold), checkpoint, every)


def first_arrival(listings: DataFrame, keys: list[str], stamp: str, delay: str) -> DataFrame:
    """One row of each key, the first to arrive, not the earliest by its stamp.

    Copies are dropped for as long as ``delay`` and the state then freed, so a key that stays away longer comes out again; where
    that matters use ``first_seen``.
    """
    return listings.withWatermark(stamp, delay).dropDuplicatesWithinWatermark(keys)


def first_seen(
    listings: DataFrame, keys: list[str], stamp: str, path: str, checkpoint: str, every: str | None = None, known: DataFrame | None = None
) -> StreamingQuery:
    """Append the first sighting of each key to ``path``, for good (see ``keyed.first_seen``).

    ``known`` are keys seen before; they are read when the query first starts and never again.  They are stored beside its state,
    where the first batch reads them, also when it has to be done again.
    """
    spark, place = listings.sparkSession, f"{checkpoint}/known"
    layout = T.StructType([listings.schema[k] for k in keys])
    if _exists(spark, f"{checkpoint}/offsets"):
        stored = _exists(spark, place)
    else:
        stored = known is not None
        if stored:
            known.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in layout]).distinct().write.mode("overwrite").parquet(place)
    earlier = spark.readStream.schema(layout).parquet(place) if stored else None
    with keyed.rocksdb_state(spark):
        return to_files(keyed.first_seen(listings, keys, stamp, earlier), path, checkpoint, every)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def health_windows(polls: DataFrame, stamp: str, width: str, delay: str, source: str = "source") -> DataFrame:
    """Polls and successes per source and tumbling window, emitted when the window can no longer change."""
    windows = polls.withWatermark(stamp, delay).groupBy(F.window(stamp, width), source)
    return windows.agg(F.count(F.lit(1)).alias("polls"), F.sum("result").alias("successes")).select(
        source, F.col("window.start").alias("window_start"), "polls", "successes"
    )


def to_files(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to parquet, exactly once."""
    return _start(stream.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint, every)


def source_health(
    polls: DataFrame, checkpoint: str, n: int = RECENT_POLLS, every: str | None = None, forget_after: int | None = None, sink: str | None = None
) -> StreamingQuery:
    """Keep the last ``n`` polls of every source as state; ``keyed.health_so_far`` reports from the checkpoint.

    ``sink`` names a format that takes the changed sources of each batch; without it they are only kept as state.  Timers need
    a query that goes on, so ``forget_after`` needs ``every``.
    """
    if forget_after is not None and every is None:
        raise ValueError("forget_after needs every")
    with keyed.rocksdb_state(polls.sparkSession):
        changed = keyed.poll_health(polls, n, forget_after).writeStream.format(sink or "noop").outputMode("update")
        return _start(changed, checkpoint, every)
