"""Registration of queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The "now" of all queries over orders and over events.
AS_OF = "2000-06-15 12:00:00"
EVENTS_AS_OF = "2024-01-20 12:00:00"


class Tables:
    """The test tables of one folder, read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def sql(self, text: str, **dealt: DataFrame) -> DataFrame:
        """A SQL text in which ``{orders}`` stands for the table; inputs are shaped with the part of SQL both engines share.

        ``dealt`` are tables to be read in place of their file, with the same rows.
        """
        used = set(re.findall(r"\{(\w+)\}", text)) - set(dealt)
        return self.spark.sql(text, **{name: getattr(self, name) for name in used}, **dealt)


def plain(text: str) -> str:
    """The same SQL for an engine that knows the tables by name."""
    return re.sub(r"\{(\w+)\}", r"\1", text).replace("TIMESTAMP_NTZ", "TIMESTAMP")


def query(name: str, oracle: str | None = None):
    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = plain(oracle)
        return function

    return register
