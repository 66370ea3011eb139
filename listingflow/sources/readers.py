"""Readers.  Every reader takes a schema or reads plain text columns; none samples the data to guess types."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import parse_date_columns
from ..operators.columns import stack


def load_tables(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Name -> frame for a registry of paths; nothing is read until used."""
    return {name: spark.read.format(fmt).load(path) for name, path in paths.items()}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    columns: list[str] | None = None,
    na_values: list[str] | None = None,
    multi_line: bool = False,
    rescue: str | None = None,
) -> DataFrame:
    """CSV with a header row.  Literals such as ``NA`` stay text unless listed in ``na_values``.

    Say ``multi_line`` when cells hold line breaks: such a file can't be split between tasks.  ``rescue`` names a column for the
    whole text of records that do not fit the schema: a cell of another type, which is null in its column, too many cells or
    too few.  It needs a schema; see ``misfits`` for a report.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if rescue is not None:
        # every cell is looked at, those of columns that are not asked for too
        reader, schema = reader.option("columnPruning", False), _with_rescue(reader, schema, rescue)
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    if rescue is not None:
        df = _all_looked_at(df, rescue)
    if na_values:
        df = df.replace(na_values, None)
    return df.select(*columns, *([rescue] if rescue else [])) if columns else df


def _with_rescue(reader, schema: T.StructType | str | None, rescue: str) -> T.StructType:
    """The schema with the column for misfits, which the reader is told of."""
    if schema is None:
        raise ValueError("rescue needs a schema")
    reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rescue)
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    # a file may lack any cell, so no column can be promised to be filled
    return T.StructType([*(T.StructField(f.name, f.dataType, True, f.metadata) for f in fields), T.StructField(rescue, T.StringType())])


def _all_looked_at(df: DataFrame, rescue: str) -> DataFrame:
    """``df`` with a rescue column that depends on every cell: a scan finds no fault in cells that it is not asked for.

    The condition holds for every number; Spark's optimiser does not see through it.
    """
    seen = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    return df.withColumn(rescue, F.when(seen.bitwiseOR(F.lit(1).cast("long")) != 0, F.col(rescue)))


def misfits(df: DataFrame, rescue: str) -> DataFrame:
    """``file, record`` of every record that did not fit, from a frame that a reader with ``rescue`` gave."""
    return df.where(F.col(rescue).isNotNull()).select(F.url_decode("_metadata.file_path").alias("file"), F.col(rescue).alias("record"))


def read_csv_folder(spark: SparkSession, folder: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All CSV files of a folder of like files, with the file stem as ``source_name``."""
    df = read_csv(spark, f"{folder}/*.csv", schema)
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.csv$", 1)
    return df.withColumn("source_name", F.url_decode(stem))


def read_table(spark: SparkSession, table: str, date_columns: list[str] = ()) -> DataFrame:
    """A catalog table with the listed text columns read as stamps."""
    return parse_date_columns(spark.table(table), list(date_columns), stamp=True)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    date_columns: list[str] = (),
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table; give a numeric partition column and its bounds for a parallel read."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **dict(properties or {}))
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return parse_date_columns(reader.load(), list(date_columns), stamp=True)


def read_query(spark: SparkSession, sql: str, views: Mapping[str, DataFrame], date_columns: list[str] = ()) -> DataFrame:
    """A SQL text over named frames (``{name}`` in the text stands for a frame)."""
    return parse_date_columns(spark.sql(sql, **dict(views)), list(date_columns), stamp=True)


def read_files(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", date_columns: list[str] = (), rescue: str | None = None
) -> DataFrame:
    """Files with an explicit schema, listed text columns read as stamps.

    ``rescue`` names a column for the text of records that do not fit (text formats only, see ``read_csv``).
    """
    reader = spark.read.format(fmt)
    if rescue is not None:
        schema = _with_rescue(reader, schema, rescue)
    df = reader.schema(schema).load(path)
    return parse_date_columns(df if rescue is None else _all_looked_at(df, rescue), list(date_columns), stamp=True)


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as columns named ``outer.inner``; arrays stay as they are."""
    while any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        columns = []
        for f in df.schema.fields:
            if isinstance(f.dataType, T.StructType):
                columns += [
                    F.col(f"`{f.name}`").getField(inner).alias(f"{f.name}{separator}{inner}") for inner in f.dataType.names
                ]
            else:
                columns.append(F.col(f"`{f.name}`"))
        df = df.select(*columns)
    return df


def json_column(df: DataFrame, column: str, schema: T.StructType | str, keep: list[str] = ()) -> DataFrame:
    """A JSON text column flattened next to the kept columns."""
    parsed = df.select(*keep, F.from_json(column, schema).alias("_json"))
    fields = parsed.schema["_json"].dataType.names
    return flatten(parsed.select(*keep, *[F.col("_json").getField(f).alias(f) for f in fields]))


#: Most columns that ``json_unknown`` makes; texts with ever new keys are data, not columns.
MOST_COLUMNS = 5_000


def json_unknown(df: DataFrame, column: str, keep: list[str] = (), separator: str = ".", other: str = "other_json") -> DataFrame:
    """A JSON text column of unknown shape flattened next to the kept columns: a column for every path that occurs.

    One pass finds the paths and their types, another reads them.  Numbers with fractions are doubles; a path that holds values of
    different kinds is text, with lists and objects as JSON; lists stay lists.  Texts that are no JSON objects are kept whole
    in ``other``.  Keys are told apart by case, as in the text.  More paths than ``MOST_COLUMNS`` are an error.
    """
    parsed = df.select(*keep, F.col(column).alias("_text"), F.try_parse_json(column).alias("_json"))
    is_object = F.startswith(F.schema_of_variant("_json"), F.lit("OBJECT"))
    found = parsed.where(is_object).agg(F.schema_of_variant_agg("_json")).first()[0]
    leaves = _leaves(_sql_type(found or "VOID"), ())
    if len(leaves) > MOST_COLUMNS:
        raise ValueError(f"{len(leaves)} different paths")
    columns = [_at_path(path, kind).alias(separator.join(path)) for path, kind in leaves]
    rest = F.when(F.coalesce(is_object, F.lit(False)), None).otherwise(F.col("_text")).alias(other)
    return parsed.select(*keep, *columns, rest)


def _sql_type(schema: str) -> T.DataType:
    """A variant's schema as a type; a path that is always null is text."""
    outside = schema.split("`")  # names in back quotes are the odd pieces
    for i in range(0, len(outside), 2):
        outside[i] = re.sub(r"(^|: |ARRAY<)OBJECT<", r"\1STRUCT<", outside[i])
        outside[i] = re.sub(r"(^|: |ARRAY<)VOID\b", r"\1STRING", outside[i])
        outside[i] = re.sub(r"(^|: |ARRAY<)DECIMAL\([0-9,]+\)", r"\1DOUBLE", outside[i])
    return T.DataType.fromDDL("`".join(outside))


def _leaves(kind: T.DataType, path: tuple[str, ...]) -> list[tuple[tuple[str, ...], T.DataType]]:
    if isinstance(kind, T.StructType):
        return [leaf for f in kind.fields for leaf in _leaves(f.dataType, (*path, f.name))]
    return [(path, kind)] if path else []


def _at_path(path: tuple[str, ...], kind: T.DataType) -> Column:
    steps = "$" + "".join(f"['{name}']" if "'" not in name else f'["{name}"]' for name in path)
    if isinstance(kind, T.VariantType):
        return F.coalesce(F.try_variant_get("_json", steps, "string"), F.to_json(F.try_variant_get("_json", steps, "variant")))
    return F.try_variant_get("_json", steps, kind.simpleString())


def stack_lists(df: DataFrame, lists: list[str], keep: list[str] = ()) -> DataFrame:
    """Several array-of-struct columns as one frame, with the list name as ``list_name``."""
    return stack([df.select(*keep, F.lit(name).alias("list_name"), F.inline(name)) for name in lists])


def delimited_text(df: DataFrame, text: Column | str, names: list[str], keep: list[str] = (), separator: str = ",") -> DataFrame:
    """Lines of a delimited text whose first line is the header; lines with a missing cell (a trailing one) are dropped.

    ``names`` are the header's names as they are wanted in the frame; cells past them are kept in the array ``more_cells``.
    The separator is a plain text.  Quoted separators are cut as well; where cells may hold them, use ``from_csv``.
    """
    body = F.regexp_replace(F.col(text) if isinstance(text, str) else text, "\r", "")
    lines = df.select(*keep, F.posexplode(F.split(body, "\n")).alias("line_no", "_line")).where("line_no > 0")
    cells = F.split("_line", "\\Q" + separator + "\\E")
    filled = lines.where(F.size(cells) >= len(names))
    more = F.slice(cells, len(names) + 1, F.greatest(F.size(cells) - len(names), F.lit(0))).alias("more_cells")
    return filled.select(*keep, "line_no", *[cells.getItem(i).alias(n) for i, n in enumerate(names)], more)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
