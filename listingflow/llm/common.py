"""Shared by the operators: reading tables, written intermediate results, caches inside tasks."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


_shipped: set[str] = set()


def sent_if_small(frame: DataFrame, most_rows: int = 500_000) -> DataFrame:
    """A stored frame of short rows, marked to be sent to every task if it has at most ``most_rows``; else it is shuffled."""
    return F.broadcast(frame) if frame.count() <= most_rows else frame


#: Bytes of a batch between the JVM and Python.  Documents differ in size by orders of magnitude, and a batch is held several
#: times over on its way, so Spark's own bound of 64 MB is too much for small executors.
BATCH_BYTES = 4 << 20


def ship_code(spark: SparkSession) -> None:
    """Prepares a session: bounds its Arrow batches by ``BATCH_BYTES``, unless it asks for less, and gives the executors
    this package, once per application, through Spark's own file distribution."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    bound = spark.conf.get(key).lower().rstrip("b")
    if not bound.isdigit() or int(bound) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    package, application = Path(__file__).resolve().parents[1], spark.sparkContext.applicationId
    if application in _shipped or not package.is_dir():
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="listingflow-code-"), "listingflow_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def released(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; when they are used up, memory that the worker's allocators hold free is given back to the system.

    Workers live on from task to task and stage to stage, and would keep what the largest of them took.
    """
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so other columns can't clash with its own."""
    ship_code(docs.sparkSession)
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors and the driver share: ``spark.checkpoint.dir``, or the context's where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written once to the shared folder and read back: its lineage is cut, and lost executors lose nothing."""
    folder = new_folder(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def text_groups(batch: pa.RecordBatch, column: str = "text", size: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows with at most ``size`` characters or one row; null texts are empty."""
    group: list[str] = []
    chars = first = 0
    for row, value in enumerate(batch.column(column)):
        text = value.as_py() or ""
        if group and chars + len(text) > size:
            yield first, group
            group, chars, first = [], 0, row
        group.append(text)
        chars += len(text)
    if group:
        yield first, group


class WordCache:
    """Results per word (``known``), kept between the batches and tasks of one Python worker.

    ``fill`` computes the results of a list of new words at once.  The cache is emptied when it holds ``limit`` words, and
    words over ``longest`` characters stay only until the next call, so its memory is bounded whatever the vocabulary; this
    changes speed only.
    """

    def __init__(self, fill: Callable[[list[str]], list], limit: int = 800_000, longest: int = 60):
        self.fill, self.limit, self.longest = fill, limit, longest
        self.known: dict = {}
        self.passing: list[str] = []

    def ready(self, texts: Iterable[list[str]]) -> dict:
        """``known`` with the words of some texts, which stay until the next call at least."""
        for w in self.passing:
            self.known.pop(w, None)
        if len(self.known) > self.limit:
            self.known.clear()
        new = list(set(chain.from_iterable(texts)).difference(self.known))
        if new:
            self.known.update(zip(new, self.fill(new), strict=True))
        self.passing = [w for w in new if len(w) > self.longest]
        return self.known
