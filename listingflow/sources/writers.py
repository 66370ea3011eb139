"""Writers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import parse_date_columns
from ..operators.columns import conform

# Column names of the listing export.
LISTING_DISPLAY = {
    "company_name": "Company Name",
    "ticker": "Symbol",
    "exchange": "Market",
    "ipo_date": "IPO Date",
    "price": "Price",
    "price_range": "Price Range",
    "shares_offered": "shares_offered",
    "status": "Status",
    "notes": "Notes",
    "time_added": "time_checked",
}


def overwrite(df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: list[str] = ()) -> None:
    """Typed full overwrite.  The target must not be among the frame's own inputs; use ``VersionedTable`` for that."""
    writer = (conform(df, schema) if schema is not None else df).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    (conform(df, schema) if schema is not None else df).write.mode("append").parquet(path)


def history_from_file(df: DataFrame) -> DataFrame:
    """A flat poll file as the start of a history: its stamp becomes ``time_added``, nothing is removed yet."""
    renamed = df.withColumnRenamed("time_checked", "time_added")
    stamped = parse_date_columns(renamed, ["time_added", "time_removed"], stamp=True)
    return stamped.withColumn("time_removed", F.lit(None).cast("timestamp_ntz"))


def export_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV with a header.  ``bom`` puts the UTF-8 mark before the first header cell, for spreadsheets."""
    if bom:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_named_csv(df: DataFrame, folder: str, stem: str, bom: bool = False) -> None:
    """CSV files in ``folder`` that are named after their source: ``stem-0.csv`` and so on.

    They are written aside and moved when all are there, through the file system that Spark itself uses.
    """
    aside = f"{folder.rstrip('/')}/_{stem}"
    export_csv(df, aside, bom)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(aside)
    files = source.getFileSystem(conf)
    parts = sorted(s.getPath().getName() for s in files.listStatus(source) if s.getPath().getName().startswith("part-"))
    for number, part in enumerate(parts):
        target = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{stem}-{number}.csv")
        files.delete(target, False)
        files.rename(jvm.org.apache.hadoop.fs.Path(f"{aside}/{part}"), target)
    files.delete(source, True)


def display_listings(df: DataFrame) -> DataFrame:
    """Listings under their display names, internal columns left out."""
    return df.select(*[F.col(c).alias(shown) for c, shown in LISTING_DISPLAY.items()])


def staged(folder: str) -> Callable[[DataFrame, str], DataFrame]:
    """Store frames under a folder all executors share: computed once, with known size, and safe when an executor goes."""

    def stage(df: DataFrame, label: str) -> DataFrame:
        path = f"{folder}/{label}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return stage


def unstaged(df: DataFrame, label: str) -> DataFrame:
    """Leave the frame lazy."""
    return df


class VersionedTable:
    """A table that jobs read and then replace.

    Each write goes to a folder of its own and is made current by a row in a small log, so a frame built from one version
    can be saved as the next, and a write repeated after a lost job ends the same way.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> str:
        return f"{self.root}/_versions"

    def current(self, before: int | None = None) -> int | None:
        """The newest version (older than ``before``)."""
        try:
            log = self.spark.read.schema("version long").parquet(self._log())
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise  # a log that can't be read is not an empty one
            return None
        if before is not None:
            log = log.where(F.col("version") < before)
        return log.agg(F.max("version")).first()[0]

    def path(self, version: int) -> str:
        return f"{self.root}/version-{version:012d}"

    def read(self, before: int | None = None) -> DataFrame | None:
        version = self.current(before)
        return None if version is None else self.spark.read.parquet(self.path(version))

    def write(self, df: DataFrame, version: int | None = None) -> int:
        if version is None:
            version = (self.current() or 0) + 1
        df.write.mode("overwrite").parquet(self.path(version))
        self.record(version)
        return version

    def record(self, version: int) -> None:
        row = self.spark.range(version, version + 1, 1, 1).select(F.col("id").alias("version"))
        row.write.mode("append").parquet(self._log())


def split_current_withdrawn(reconciled: DataFrame, as_of, current: VersionedTable, withdrawn: VersionedTable) -> None:
    """Save the two selections of one reconciliation; it is stored once and both are filtered from the stored rows."""
    from ..operators.reconcile import current_rows, withdrawn_rows

    whole = VersionedTable(reconciled.sparkSession, f"{current.root}/_reconciled")
    whole.write(reconciled)
    stored = whole.read()
    current.write(current_rows(stored, as_of))
    withdrawn.write(withdrawn_rows(stored))


def as_json_documents(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_registry_tables(registry: DataFrame, root: str) -> Mapping[str, str]:
    """The registry's column list and source table."""
    from ..operators.registry import column_reference, source_table

    targets = {"ref_columns": f"{root}/ref_columns", "ref_sources": f"{root}/ref_sources"}
    overwrite(column_reference(registry), targets["ref_columns"])
    overwrite(source_table(registry), targets["ref_sources"])
    return targets
