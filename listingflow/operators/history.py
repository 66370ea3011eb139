"""First-seen / last-seen histories and the change sets derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import as_of_stamp
from .columns import stack
from .dedupe import keep_last
from .filters import latest_batch
from .joins import ROW_KEY, common_types, keyed, keys_of, left

ADDED, REMOVED, CHECKED = "time_added", "time_removed", "time_checked"
STAMPS = (CHECKED, ADDED, REMOVED)


def start_history(snapshot: DataFrame, checked_at) -> DataFrame:
    """The first poll of a source: every distinct row is added."""
    keys = [c for c in snapshot.columns if c not in STAMPS]
    return snapshot.select(*keys).distinct().select(
        "*", as_of_stamp(checked_at).alias(ADDED), F.lit(None).cast("timestamp_ntz").alias(REMOVED)
    )


def snapshot_diff(history: DataFrame, snapshot: DataFrame, checked_at, reopen: bool = False) -> DataFrame:
    """Fold a new snapshot into a history.

    Rows are identified by all columns but the stamps, nulls equal.  Rows new in the snapshot are added at ``checked_at``;
    open rows it lacks are closed; all others stay as they are, and a row that was closed stays closed when it reappears
    unless ``reopen``.  Duplicates of either side are dropped before the comparison.

    The two sides are read once each and meet in one aggregate; a row collects no more than its own periods in the history.
    """
    keys = [c for c in snapshot.columns if c not in STAMPS]
    now = as_of_stamp(checked_at)
    types = common_types(history, snapshot, keys, keys)
    if any(types):
        same = {c: F.col(f"`{c}`").cast(t) for c, t in zip(keys, types, strict=True) if t}
        history, snapshot = history.withColumns(same), snapshot.withColumns(same)
    open_stamp = F.lit(None).cast("timestamp_ntz")
    # one aggregate over both sides, combined before the shuffle: a row's periods, and whether the snapshot has it
    period = F.struct(F.col(ADDED).cast("timestamp_ntz").alias(ADDED), F.col(REMOVED).cast("timestamp_ntz").alias(REMOVED))
    known = history.select(*keys, period.alias("_period"), F.lit(False).alias("_now"))
    polled = snapshot.select(*keys, F.lit(None).cast(known.schema["_period"].dataType).alias("_period"), F.lit(True).alias("_now"))
    rows = known.unionByName(polled).groupBy(*keys).agg(F.collect_set("_period").alias("_periods"), F.max("_now").alias("_now"))
    first = F.array(F.struct(now.alias(ADDED), open_stamp.alias(REMOVED)))
    each = rows.select(*keys, "_now", F.inline(F.when(F.size("_periods") == 0, first).otherwise(F.col("_periods"))))
    closed = F.when(~F.col("_now") & F.col(REMOVED).isNull(), now).otherwise(F.col(REMOVED))
    if reopen:
        closed = F.when(~F.col("_now"), closed)
    return each.select(*keys, ADDED, closed.alias(REMOVED))


def close_out(df: DataFrame, key: str, label: str, checked_at, length: int = 8) -> DataFrame:
    """Close the open rows whose id is not in the newest batch."""
    current = keys_of(latest_batch(df, label, length), [key]).withColumn("_now", F.lit(True))
    flagged = keyed(df, [key]).join(current, ROW_KEY, "left")
    closing = F.col("_now").isNull() & F.col(REMOVED).isNull()
    return flagged.withColumn(REMOVED, F.when(closing, as_of_stamp(checked_at)).otherwise(F.col(REMOVED))).select(
        *df.columns
    )


def unchanged(new: Column, old: Column, null_new_is_unchanged: bool = False) -> Column:
    """Equality in which a missing side counts as a change, unless the new value is null and that is to be ignored."""
    same = F.coalesce(new == old, F.lit(False))
    return same | new.isNull() if null_new_is_unchanged else same


def changed_rows(joined: DataFrame, strict: list[str], lenient: list[str], old_suffix: str = "_old") -> DataFrame:
    """Rows with at least one changed field, with a ``<field>_unchanged`` flag for each.

    ``strict`` fields count a null on either side as a change; ``lenient`` fields ignore a null new value.
    """
    flags = {
        f"{c}_unchanged": unchanged(F.col(c), F.col(c + old_suffix), c in lenient) for c in [*strict, *lenient]
    }
    flagged = joined.withColumns(flags)
    any_changed = F.lit(False)
    for name in flags:
        any_changed = any_changed | ~F.col(name)
    return flagged.where(any_changed)


def apply_updates(base: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    return keep_last(base, updates, keys)


def mark_members(df: DataFrame, keys: DataFrame, on: str, changes: dict[str, Column]) -> DataFrame:
    """Set columns on the rows whose key is in ``keys``."""
    members = keys.select(on).distinct().withColumn("_member", F.lit(True))
    joined = left(df, members, on)
    new = {
        c: F.when(F.col("_member"), v).otherwise(F.col(c) if c in df.columns else F.lit(None))
        for c, v in changes.items()
    }
    extra = [c for c in changes if c not in df.columns]
    return joined.withColumns(new).select(*df.columns, *extra)


def redirect_superseded(
    ledger: DataFrame,
    feed: DataFrame,
    link_base: str,
    number: str = "ticket_number",
    link: str = "ticket_link",
    status: str = "ticket_status",
) -> DataFrame:
    """Follow the status feed: take over each ticket's status, and where a ticket was resolved as a duplicate point the row
    to the ticket that replaced it and blank its status."""
    news = feed.select(
        F.col("ticket_number").alias(number), F.col("status").alias("_status"), F.col("duplicate_of").alias("_other")
    )
    joined = left(ledger, news, number)
    moved = F.coalesce((F.col("_status") == "Resolved") & F.col("_other").isNotNull(), F.lit(False))
    return joined.withColumns(
        {
            status: F.when(moved, "").when(F.col("_status").isNotNull(), F.col("_status")).otherwise(F.col(status)),
            link: F.when(moved, F.concat(F.lit(link_base), F.col("_other").cast("string"))).otherwise(F.col(link)),
            number: F.when(moved, F.col("_other")).otherwise(F.col(number)),
        }
    ).select(*ledger.columns)


def poll_times(snapshots: DataFrame, source: str = "source") -> DataFrame:
    """The polls a log of snapshots shows: one row per source and time."""
    return snapshots.select(source, CHECKED).distinct()


def fold_polls(
    snapshots: DataFrame,
    source: str = "source",
    open_rows: DataFrame | None = None,
    closed_rows: DataFrame | None = None,
    polls: DataFrame | None = None,
) -> DataFrame:
    """Any number of polls of any number of sources folded into a history at once.

    Gives what ``snapshot_diff`` would after being run poll by poll: a row is added at the first poll that has it and
    closed at the first later poll of its source that lacks it, for good.  ``snapshots`` carries ``source`` and
    ``time_checked``.  ``open_rows`` and ``closed_rows`` are the history so far; the result holds the rows open before or
    seen now, closed ones with their stamp.  ``polls`` (source, time_checked) lists all polls, those that returned nothing
    included; without it the list is taken from the snapshots.

    Every sighting is told which poll of its source came next; a row is gone at the first such poll that did not see it: the
    next polls without a sighting come from one anti join, and two aggregates of single values, combined map-side, do the rest.
    """
    keys = [c for c in snapshots.columns if c not in STAMPS]
    polls = poll_times(snapshots, source) if polls is None else polls.select(source, CHECKED).distinct()
    following = F.lead(CHECKED).over(Window.partitionBy(source).orderBy(CHECKED))
    steps = polls.select(source, CHECKED, following.alias("_next"))
    sightings = snapshots.select(*keys, CHECKED).join(steps, [source, CHECKED], "left")
    sightings = sightings.select(*keys, CHECKED, "_next", F.lit(None).cast("timestamp_ntz").alias("_was"))
    if open_rows is not None:
        starts = polls.groupBy(source).agg(F.min(CHECKED).alias("_next"))
        before = left(open_rows.select(*keys, F.col(ADDED).alias("_was")), starts, source)
        sightings = sightings.unionByName(before, allowMissingColumns=True)
    if closed_rows is not None:
        sightings = keyed(sightings, keys).join(keys_of(closed_rows, keys), ROW_KEY, "left_anti").drop(*ROW_KEY)
    # a poll that was due and did not see the row: its sighting says so with a stamp, any other with none
    due = sightings.where(F.col("_next").isNotNull()).select(*keys, F.col("_next").alias("_at"), F.lit(0).alias("_hit"))
    seen = sightings.where(F.col(CHECKED).isNotNull()).select(*keys, F.col(CHECKED).alias("_at"), F.lit(1).alias("_hit"))
    was = sightings.groupBy(*keys).agg(F.min("_was").alias("_was")).select(*keys, F.col("_was").alias("_at"), F.lit(2).alias("_hit"))
    polled = due.unionByName(seen).groupBy(*keys, "_at").agg(F.max("_hit").alias("_hit"))
    events = polled.unionByName(was)
    at = F.col("_at")
    first = events.groupBy(*keys).agg(
        F.min(F.when(F.col("_hit") == 2, at)).alias("_was"),
        F.min(F.when(F.col("_hit") == 1, at)).alias("_seen"),
        F.min(F.when(F.col("_hit") == 0, at)).alias(REMOVED),
    )
    return first.select(*keys, F.coalesce("_was", "_seen").alias(ADDED), REMOVED)


#: Parts into which a store's rows are dealt.
SLOTS = 64


class HistoryStore:
    """A history on shared storage in which a fold reads and writes only what its polls touch.

    Rows are dealt into ``slots`` folders: open rows by their source, closed rows by a hash of all their columns.  A fold reads
    the open rows of the slots of its sources and writes these anew under its version; of the closed rows, which never
    change, it reads the slots of rows that were sighted but are not open, so none where a poll brings nothing new, however
    many rows were closed before, and adds the ones it closes.  A small table beside each version tells which version has the
    open rows of each slot and which slots have closed rows; it also holds the number of slots, and another number is refused.

    Folding the same version again reads what the version before left and writes the same folders.  Snapshots must keep
    the types of their columns.
    """

    def __init__(self, spark, root: str, source: str = "source", slots: int = SLOTS):
        from ..sources.writers import VersionedTable

        self.spark, self.source, self.slots = spark, source, slots
        self.root = root.rstrip("/")
        self.log = VersionedTable(spark, self.root)

    def _places(self, before: int | None = None) -> tuple[dict[int, int], set[int]] | None:
        """(version of each slot's open rows, slots with closed rows) as of the newest version; None where there is none."""
        current = self.log.current(before)
        if current is None:
            return None
        rows = self.spark.read.parquet(f"{self.root}/slots/version={current}").collect()  # two rows a slot at most, and one
        made_with = next(r.version for r in rows if r.kind == "slots")
        if made_with != self.slots:
            raise ValueError(f"the store has {made_with} slots, not {self.slots}")
        return {r.slot: r.version for r in rows if r.kind == "open"}, {r.slot for r in rows if r.kind == "closed"}

    def _read(self, kind: str, paths: list[str]) -> DataFrame | None:
        if not paths:
            return None
        return self.spark.read.option("basePath", f"{self.root}/{kind}").parquet(*sorted(paths))

    def open_rows(self, before: int | None = None, slots: set[int] | None = None) -> DataFrame | None:
        """The open rows (of some slots); None where there are none."""
        places = self._places(before)
        wanted = {} if places is None else {k: v for k, v in places[0].items() if slots is None or k in slots}
        rows = self._read("open", [f"{self.root}/open/version={v}/slot={k}" for k, v in wanted.items()])
        return None if rows is None else rows.drop("version", "slot")

    def closed_rows(self, before: int | None = None, slots: set[int] | None = None) -> DataFrame | None:
        """The closed rows (of some slots); None where there are none."""
        places = self._places(before)
        wanted = set() if places is None else {k for k in places[1] if slots is None or k in slots}
        rows = self._read("closed", [f"{self.root}/closed/slot={k}" for k in wanted])
        return None if rows is None else rows.where(F.col("version") <= self.log.current(before)).drop("version", "slot")

    def history(self) -> DataFrame:
        opened, closed = self.open_rows(), self.closed_rows()
        if opened is None or closed is None:
            return opened if closed is None else closed
        return opened.unionByName(closed)

    def _slot_of(self, columns: list[str]) -> Column:
        parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in columns]
        return F.pmod(F.xxhash64(*parts), F.lit(self.slots)).cast("int")

    def fold(self, snapshots: DataFrame, version: int, empty_polls: DataFrame | None = None) -> None:
        # the list of polls is stored first: read back, its size is known and Spark can tell whether to broadcast it
        times = poll_times(snapshots, self.source)
        if empty_polls is not None:
            times = times.unionByName(empty_polls.select(self.source, CHECKED))
        folder = f"{self.root}/polls/version={version}"
        times.write.mode("overwrite").parquet(folder)
        polls = self.spark.read.schema(times.schema).parquet(folder)
        keys = [c for c in snapshots.columns if c not in STAMPS]
        slot = lambda rows, by: {r[0] for r in rows.select(self._slot_of(by)).distinct().collect()}  # noqa: E731  at most ``slots``
        touched = slot(polls, [self.source])
        before = self.open_rows(version, touched)
        missed = snapshots.select(*keys)
        if before is not None:
            missed = keyed(missed, keys).join(keys_of(before, keys), ROW_KEY, "left_anti").drop(*ROW_KEY)
        closed = self.closed_rows(version, slot(missed, keys))
        folded = fold_polls(snapshots, self.source, before, closed, polls)
        is_open = F.col(REMOVED).isNull()
        place = F.when(is_open, self._slot_of([self.source])).otherwise(self._slot_of(keys)).alias("slot")
        whole = f"{self.root}/folded/version={version}"
        folded.select("*", is_open.alias("_open"), place).write.mode("overwrite").parquet(whole)
        rows = self.spark.read.schema(folded.select("*", is_open.alias("_open"), place).schema).parquet(whole)
        rows.where("_open").drop("_open").write.mode("overwrite").partitionBy("slot").parquet(f"{self.root}/open/version={version}")
        gone = rows.where("not _open").drop("_open").withColumn("version", F.lit(version))
        gone.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot", "version").parquet(f"{self.root}/closed")
        self._record(version, touched, {(r.slot, r._open) for r in rows.select("slot", "_open").distinct().collect()})

    def _record(self, version: int, touched: set[int], written: set[tuple[int, bool]]) -> None:
        opened, closed = self._places(version) or ({}, set())
        now = {k: v for k, v in opened.items() if k not in touched} | {k: version for k, is_open in written if is_open}
        closed = closed | {k for k, is_open in written if not is_open}
        rows = [("slots", None, self.slots), *(("open", k, v) for k, v in now.items()), *(("closed", k, None) for k in closed)]
        table = self.spark.createDataFrame(rows, "kind string, slot int, version long").coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.root}/slots/version={version}")
        self.log.record(version)
