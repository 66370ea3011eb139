"""Streams with keyed state, held in Spark's RocksDB state store.

The state of a key is looked up when the key arrives, so a batch costs what it brings, however many keys were seen before.  It
is committed with the batch: a restarted query goes on from the last batch and gives the same rows.  Processors are made inside
functions, so that their code travels with the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.aggregates import success_rate
from ..operators.health import RECENT_POLLS
from ..operators.ordering import top_distinct

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; a query keeps the setting it was started with."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def combined(rows: DataFrame, by: list[str], values: list[tuple[str, str, str]], whole: bool = False) -> DataFrame:
    """Rows combined before a shuffle: of each key of an Arrow batch one row, with ``values`` given as (column, aggregate, name).

    What a built-in aggregate does before its shuffle, for streams, in which one may not stand before keyed state.  A key that
    holds most of a micro-batch then sends one row for each Arrow batch.  With ``whole`` of each key of a partition one row,
    as after a shuffle; a task then holds the keys of its partition.
    """
    wide = rows.select(*[f"`{c}`" for c in by], *[F.col(f"`{c}`").alias(name) for c, _, name in values])

    def combine(batches):
        import pyarrow as pa

        def least(tables):
            found = pa.concat_tables(tables).group_by(by).aggregate([(name, kind) for _, kind, name in values])
            found = found.select([*by, *[f"{name}_{kind}" for _, kind, name in values]]).rename_columns(tables[0].schema.names)
            return found.cast(tables[0].schema)

        held, limit = [], 0
        for batch in batches:
            held.append(least([pa.Table.from_batches([batch])]))
            if not whole:
                yield from held.pop().to_batches()
            elif sum(t.num_rows for t in held) > limit:
                held = [least(held)]
                limit = 2 * held[0].num_rows + _WAITING
        if held:
            yield from least(held).to_batches(max_chunksize=_BATCH)

    return wide.mapInArrow(combine, wide.schema)


# Rows that wait to be combined, at least, and rows of an Arrow batch given back.
_WAITING, _BATCH = 100_000, 10_000


def first_seen(listings: DataFrame, keys: list[str], stamp: str, known: DataFrame | None = None) -> DataFrame:
    """A stream of every key's first sighting: its earliest stamp in the batch that brought it first, once and for good.

    The sightings of a micro-batch are brought to one row per key, and ``dropDuplicates`` keeps the keys as its state, so no key
    costs a call of Python.  ``known`` is a stream of keys (columns ``keys``) seen before; it must bring all of them in the first
    batch.  Null keys are keys; a sighting without a stamp counts, with a null stamp.
    """
    rows = listings.select(*[f"`{c}`" for c in [*keys, stamp]], F.lit(0).alias("_known"))
    if known is not None:
        no_stamp = F.lit(None).cast(listings.schema[stamp].dataType).alias(stamp)
        rows = rows.unionByName(known.select(*[f"`{c}`" for c in keys], no_stamp, F.lit(1).alias("_known")))
    values = [(stamp, "min", stamp), ("_known", "max", "_known")]
    thin = combined(rows, keys, values).repartition(*[f"`{c}`" for c in keys])
    return combined(thin, keys, values, whole=True).dropDuplicates(keys).where("_known = 0").drop("_known")


def poll_health(polls: DataFrame, n: int = RECENT_POLLS, forget_after: int | None = None, source: str = "source", stamp: str = "time_checked") -> DataFrame:
    """A stream of each polled source's own last ``n`` polls: ``source, polls, result, most_recent_failure, most_recent_success``.

    The state of a source is a list of its ``n`` newest poll times with their successes, and its last failure and success;
    nothing else of the polls is kept.  A late poll takes its place in the list, or none if ``n`` newer ones are known.  With
    ``forget_after`` a timer clears a source that has not been polled for so many milliseconds, and a row without polls says
    so.  ``health_so_far`` makes the report over all sources from the state.
    """
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    kind = polls.schema[stamp].dataType
    name, result = polls.schema[source].dataType.simpleString(), F.col("result").cast("long")
    # an instant is kept as a number, as it would come back from the state without its zone
    instant = isinstance(kind, T.TimestampType)
    at, unit = ("bigint", "micros") if instant else (kind.simpleString(), "at")
    time = F.unix_micros(stamp) if instant else F.col(stamp)
    flags = {"failed": (result == 0).cast("int"), "succeeded": (result == 1).cast("int")}
    rows = polls.where(F.col(stamp).isNotNull()).select(F.col(source).alias("source"), time.alias("at"), result.alias("successes"), *[c.alias(k) for k, c in flags.items()])
    thin = combined(rows, ["source", "at"], [("successes", "sum", "successes"), ("failed", "max", "failed"), ("succeeded", "max", "succeeded")])

    report = Row(source, "polls", "result", "most_recent_failure", "most_recent_success")

    class LastPolls(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.recent = handle.getListState("recent", f"{unit} {at}, successes long")
            self.ends = handle.getValueState("ends", f"failure {at}, success {at}")

        def handleInputRows(self, key, rows, timers):
            held = dict(tuple(r) for r in self.recent.get())
            ends = list(self.ends.get()) if self.ends.exists() else [None, None]
            for _, time, successes, *met in rows:
                for place, hit in enumerate(met):
                    if hit and (ends[place] is None or time > ends[place]):
                        ends[place] = time
                if time in held:
                    held[time] = _added(held[time], successes)
                elif len(held) < n or time > min(held):
                    held[time] = successes
                    if len(held) > n:
                        del held[min(held)]
            self.recent.put(list(held.items()))
            self.ends.update(tuple(ends))
            if forget_after is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + forget_after)
            total = None
            for successes in held.values():
                total = _added(total, successes)
            yield report(key[0], len(held), total, *ends)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.recent.clear()
            self.ends.clear()
            yield report(key[0], 0, None, None, None)

        def close(self) -> None:
            pass

    def _added(a, b):
        return b if a is None else a if b is None else a + b

    mode = "none" if forget_after is None else "ProcessingTime"
    schema = f"`{source}` {name}, polls int, result long, most_recent_failure {at}, most_recent_success {at}"
    changed = thin.groupBy("source").transformWithState(LastPolls(), schema, "update", mode)
    return changed.withColumns({c: F.timestamp_micros(c) for c in changed.columns[3:]}) if instant else changed


def health_so_far(spark: SparkSession, checkpoint: str, n: int = RECENT_POLLS) -> DataFrame:
    """The health report over the last ``n`` polls of all sources, from the state that ``poll_health`` has committed.

    The newest ``n`` poll times of all are among the newest ``n`` of each source that has them, so the state is all it takes.
    """
    state = lambda name: spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    source = F.col("key.source").alias("source")
    held = state("recent").select(source, "list_element.*")
    instant = "micros" in held.columns
    recent = held.withColumnRenamed("micros", "at")
    shown = lambda c, name: (F.timestamp_micros(c) if instant else F.col(c)).alias(name)
    ends = state("ends").select(F.col("key.source").alias("_source"), shown("value.failure", "most_recent_failure"), shown("value.success", "most_recent_success"))
    polled = recent.join(top_distinct(recent, "at", n), "at", "left_semi")
    per_source = polled.groupBy("source").agg(F.sum("successes").alias("result"))
    return per_source.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "result", success_rate(F.col("result"), n).alias("recent_success_rate"), "most_recent_failure", "most_recent_success"
    )
