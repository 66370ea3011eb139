"""Exact de-duplication against a persistent digest index.

The index is a table of digests, bucketed and sorted by digest.  A batch is reduced to one row per digest before it meets the
index, so the sort-merge join has unique keys on both sides and reads the index without shuffling it.  Rows then learn what
became of their digest in a second join, whose inputs are both shuffled plainly, so that the executor may split the
partition of a text that a third of all rows share.

Defined results: a null text counts as the empty text; a null id is an ordinary id smaller than all others; rows that agree
in id and text are copies of which one stays; an empty batch changes nothing; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, new_folder, sent_if_small, stored

#: Buckets of an index that is made without saying how many.
BUCKETS = 64


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return id_and_text(docs, id_col, text_col).select("doc_id", text_digest(F.col("text")).alias("digest"))


class DigestIndex:
    """The digests of all texts accepted so far, with the row that stays for each.

    ``location`` names the index's folder; an index that exists there is opened again, so it outlives the session and the
    catalog.  A small table in it holds the number of buckets, without which its files cannot be read whole: opened without
    ``buckets`` it has the number it was made with, and another number is refused.
    """

    def __init__(self, spark: SparkSession, location: str, buckets: int | None = None):
        self.spark, self.location = spark, location.rstrip("/")
        self.buckets = self._settled(buckets)
        # the whole location, so that no two share a table of the catalog
        self.name = "digest_index_" + hashlib.sha256(self.location.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{self.name}` (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.location}/digests'"
        )
        spark.catalog.refreshTable(self.name)

    def _settled(self, buckets: int | None) -> int:
        """The number of buckets the index was made with, written down for a new one."""
        folder = f"{self.location}/buckets"
        try:
            made_with = self.spark.read.schema("buckets int").parquet(folder).agg(F.min("buckets")).first()[0]
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            made_with = None
        if made_with is None:
            made_with = int(buckets or BUCKETS)
            self.spark.createDataFrame([(made_with,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(folder)
        if buckets is not None and buckets != made_with:
            raise ValueError(f"the index at {self.location} has {made_with} buckets, not {buckets}")
        return made_with

    def rows(self) -> DataFrame:
        """``digest, keep_id, batch``.  A batch that was lost after part of it was appended, and absorbed again, may stand twice."""
        return self.spark.table(self.name)

    def append(self, fresh: DataFrame, batch: str) -> None:
        """Adds digests that no other batch has; one file per bucket and batch."""
        rows = fresh.select("digest", "keep_id", F.lit(batch).alias("batch"))
        rows.repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def absorb(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """De-duplicates one batch and appends what is new.

        One row per row of ``docs``: ``doc_id, digest, keep_id, group_size, kept``.  Of equal texts within the batch the row
        with the largest id stays, unless the index holds the text already: then ``keep_id`` is the indexed row's and no
        row of the batch stays.  ``group_size`` counts rows of this batch.

        ``batch`` names the batch.  One whose result was lost may be absorbed again under its name, with the same rows: what it
        appended itself counts as unknown and is not appended again, so it gets the same result.  Without a name a batch is new.
        """
        return self.absorb_digests(digests(docs, id_col, text_col), batch)

    def absorb_digests(self, texts: DataFrame, batch: str | None = None) -> DataFrame:
        """``absorb`` for rows ``doc_id, digest``."""
        rows = stored(folded(texts), "digests")
        return _fates(rows, self.meet(rows, batch or uuid.uuid4().hex))

    def meet(self, rows: DataFrame, batch: str) -> DataFrame:
        """``digest, last_id, group_size, known_id, known`` of every digest of a batch, having appended what is new.

        ``rows`` are ``digest, doc_id, copies``, stored.
        """
        # stored, so that this side has no partitioning of its own and the bucketed index need not be shuffled to match it
        groups = stored(
            rows.groupBy("digest").agg(F.max("doc_id").alias("last_id"), F.sum("copies").alias("group_size")), "groups"
        )
        held = self.rows()
        # a batch's own rows have been appended by an attempt that was lost
        mine = F.col("batch") == batch
        known = held.where(~mine).select("digest", F.col("keep_id").alias("known_id"), F.lit(True).alias("known"))
        met = stored(groups.hint("merge").join(known.hint("merge"), "digest", "left"), "groups-met")
        # the anti-join of the batch with the index: the left join's unmatched rows
        fresh = met.where(F.col("known").isNull()).select("digest", F.col("last_id").alias("keep_id"))
        again = held.where(mine).select("digest")
        if not again.isEmpty():
            fresh = stored(fresh.join(again.distinct(), "digest", "left_anti"), "fresh")
        self.append(fresh, batch)
        return met


def folded(texts: DataFrame) -> DataFrame:
    return texts.groupBy("digest", "doc_id").agg(F.count("*").alias("copies"))


def _fates(rows: DataFrame, met: DataFrame) -> DataFrame:
    """What became of every row, given what its digest met: ``doc_id, digest, keep_id, group_size, kept``."""
    fate = met.select(
        "digest",
        F.when(F.col("known"), F.col("known_id")).otherwise(F.col("last_id")).alias("keep_id"),
        F.col("known").isNull().alias("new"),
        "group_size",
    )
    wide = rows.hint("merge").join(fate.hint("merge"), "digest")
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    kept = F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return wide.withColumn("copy", each).select("doc_id", "digest", "keep_id", "group_size", kept.alias("kept"))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None):
    """``index.absorb`` with a new, empty index in the shared folder unless one is given."""
    spark = docs.sparkSession
    # an index for one batch has few, larger files; one that is to grow should get buckets for what it will hold
    return (index or DigestIndex(spark, new_folder(spark, "digest-index"), 16)).absorb(docs, id_col, text_col, batch)


def in_batches(docs: DataFrame, index: DigestIndex, batches: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All of ``docs`` absorbed by one index in several batches, those of larger ids first: a row each, as ``absorb`` gives them
    for the whole, ``group_size`` over all batches.

    The ids are cut at quantiles, so batches have about as many rows each; every batch but the first meets what the ones before
    it left in the index.  As larger ids come first, the row that stays is the one with the largest id of all.  The index
    must be empty, or hold no text of ``docs``: otherwise a group's size counts rows of ``docs`` alone.
    """
    rows = stored(folded(digests(docs, id_col, text_col)), "digests")  # texts are read once, not for every batch
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] or []), reverse=True) if shares else []
    met = []
    for number in range(len(cuts) + 1):
        above, below = (cuts[number] if number < len(cuts) else None), (cuts[number - 1] if number else None)
        part = F.lit(True) if above is None else F.col("doc_id") > above
        if below is not None:
            part = part & (F.col("doc_id") <= below)
        chosen = F.coalesce(part, F.lit(above is None))  # null ids come last
        met.append(index.meet(rows.where(chosen), f"part-{number}"))
    # a digest that is new to its first batch is known to the later ones, with the row that stays
    fresh = F.col("known").isNull()
    whole = reduce(DataFrame.unionByName, met).groupBy("digest").agg(
        F.max("known_id").alias("known_id"),
        F.max(F.when(fresh, F.col("last_id"))).alias("last_id"),
        F.sum("group_size").alias("group_size"),
        F.when(~F.bool_or(fresh), True).alias("known"),
    )
    return _fates(rows, stored(whole, "groups-met"))


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that exact de-duplication keeps: the largest id of each text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("__key__")
    fate = deduplicate(docs, None, id_col, text_col).select(key, F.col("digest").alias("__digest__"), "kept")
    # rows to drop, and rows that occur repeatedly of which one stays: usually a small part of all rows
    marked = fate.groupBy("__key__", "__digest__").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    marked = stored(marked.where("not kept or n > 1").select("__key__", "__digest__", "kept"), "marked")
    own = F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit("null"))
    held = docs.withColumns({"__key__": own, "__digest__": text_digest(F.col(f"`{text_col}`").cast("string"))})
    # some 60 bytes a row, so 30 MB at most are sent to a task
    out = held.join(sent_if_small(marked.select("__key__", "__digest__")), ["__key__", "__digest__"], "left_anti")
    again = marked.where("kept").select("__key__", "__digest__")
    if not again.isEmpty():
        out = out.unionByName(held.join(sent_if_small(again), ["__key__", "__digest__"], "left_semi").dropDuplicates(["__key__", "__digest__"]))
    return out.drop("__key__", "__digest__")
