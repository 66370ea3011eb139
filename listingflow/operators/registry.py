"""The source registry: one row per source, read from a JSON document the user keeps (``schemas.SOURCE_REGISTRY``)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions.text import join_list

SOURCE_TYPES = ("all", "website", "other")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines or arrays of source objects; a cell element may be one name or a list of names."""
    fields = [
        T.StructField(f.name, T.StringType()) if f.name == "cell_elem" else f for f in schemas.SOURCE_REGISTRY.fields
    ]
    raw = spark.read.schema(T.StructType(fields)).option("multiLine", True).json(path)
    listed = F.when(F.col("cell_elem").startswith("["), F.from_json("cell_elem", "array<string>"))
    single = F.when(F.col("cell_elem").isNotNull(), F.array("cell_elem"))
    return raw.withColumn("cell_elem", F.coalesce(listed, single))


def sources_of_type(registry: DataFrame, source_type: str = "all") -> DataFrame:
    if source_type not in SOURCE_TYPES:
        raise ValueError(f"{source_type} is not one of {', '.join(SOURCE_TYPES)}")
    return registry if source_type == "all" else registry.where(F.col("source_type") == source_type)


def column_reference(registry: DataFrame) -> DataFrame:
    """(source, column, 1-based number)."""
    return registry.select("source_name", F.posexplode("columns").alias("_pos", "col_name")).select(
        "source_name", "col_name", (F.col("_pos") + 1).alias("col_num")
    )


def source_table(registry: DataFrame) -> DataFrame:
    """The registry without its columns: lists as text, maps as JSON."""
    maps = [f.name for f in registry.schema.fields if isinstance(f.dataType, T.MapType)]
    shown = registry.drop("columns").withColumns({m: F.to_json(m) for m in maps})
    return shown.withColumn("cell_elem", join_list("cell_elem"))


def registry_json(registry: DataFrame) -> DataFrame:
    """One JSON document per source."""
    return registry.select("source_name", F.to_json(F.struct(*registry.columns)).alias("document"))


def registry_configs(registry: DataFrame) -> dict[str, dict]:
    """Extraction settings by source; the registry has one row per calendar and is kept by hand."""
    return {row.source_name: json.loads(row.document) for row in registry_json(registry).toLocalIterator()}
