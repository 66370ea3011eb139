"""Session set-up and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Bytes of code above which a JVM leaves a method interpreted.  Tolerant date parsing makes larger ones of a whole stage; Spark
# then runs the operators one by one, each with generated code that it splits into small methods.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Settings the operators count on.  AQE splits skewed join partitions and sizes the shuffles at run time, so no fixed
# partition number is baked into any operator.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # pages differ in size by orders of magnitude, so Arrow batches are bounded by bytes as well as by rows
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.ui.enabled": "false",
    **COMPILED,
}


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", checkpoint_dir: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark; on a cluster use the session you are given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("listingflow")
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", memory)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the one the context was told."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named.rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    """A new sub-folder name under the shared folder; nothing is reused between runs."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
