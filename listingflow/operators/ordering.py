"""Sorting, paging and top-N.  Nulls come last in either direction unless asked otherwise."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T


def order(df: DataFrame, keys: list[tuple[str, str]], nulls: str = "last") -> DataFrame:
    return df.orderBy(*sort_columns(keys, nulls))


def sort_columns(keys: list[tuple[str, str]], nulls: str = "last") -> list[Column]:
    made = []
    for name, direction in keys:
        c = F.col(name)
        if direction == "desc":
            made.append(c.desc_nulls_last() if nulls == "last" else c.desc_nulls_first())
        else:
            made.append(c.asc_nulls_last() if nulls == "last" else c.asc_nulls_first())
    return made


def top_distinct(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n greatest distinct values (a top-n plan: every task keeps n)."""
    return df.select(column).distinct().orderBy(F.col(column).desc_nulls_last()).limit(n)


def page(df: DataFrame, keys: list[tuple[str, str]], number: int = 0, size: int = 100) -> DataFrame:
    """One page of an ordered result; ``keys`` must order the rows totally for pages to be stable.

    All pages before it go through one task as well; to walk through many pages use ``page_after``, to jump to any ``Pages``.
    """
    return order(df, keys).offset(number * size).limit(size)


def page_after(df: DataFrame, keys: list[tuple[str, str]], last: Mapping[str, object] | None = None, size: int = 100) -> DataFrame:
    """The page that follows the row with the key values ``last`` (the first page without).

    A filter and a top-n, however deep the page: every task keeps ``size`` rows.  Nulls come last, as in ``order``.
    """
    if last is not None:
        behind, equal = F.lit(False), F.lit(True)
        for name, direction in keys:
            column, value = F.col(name), last[name]
            if value is None:
                past, same = F.lit(False), column.isNull()
            else:
                past = (column < F.lit(value) if direction == "desc" else column > F.lit(value)) | column.isNull()
                same = column.eqNullSafe(F.lit(value))
            behind, equal = behind | (equal & past), equal & same
        df = df.where(F.coalesce(behind, F.lit(False)))
    return order(df, keys).limit(size)


class Pages:
    """An ordered result whose pages, however deep, are read without those before them.

    The rows are dealt once into ranges of the keys and stored range by range; the number of rows in each, one number a range, tells
    where a page begins.  A page sorts only the ranges it overlaps, one or two as a rule.  ``keys`` must order the rows
    totally for pages to be stable.  Rows that agree in all keys share a range.
    """

    def __init__(self, df: DataFrame, keys: list[tuple[str, str]], folder: str, ranges: int | None = None):
        self.keys, self.columns, by = keys, df.columns, sort_columns(keys)
        dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
        dealt.withColumn("_range", F.spark_partition_id()).write.partitionBy("_range").parquet(folder)
        schema = T.StructType([*df.schema.fields, T.StructField("_range", T.IntegerType())])
        self.rows = df.sparkSession.read.schema(schema).parquet(folder)
        counted = self.rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()
        self.counts = sorted((r["_range"], r.n) for r in counted)

    def __len__(self) -> int:
        return sum(n for _, n in self.counts)

    def page(self, number: int, size: int = 100) -> DataFrame:
        """The rows of one page in order; none past the last."""
        begin, before, skipped, wanted = number * size, 0, 0, []
        for part, n in self.counts:
            if before + n > begin and before < begin + size:
                wanted.append(part)
            elif before + n <= begin:
                skipped = before + n
            before += n
        found = self.rows.where(F.col("_range").isin(wanted)) if wanted else self.rows.limit(0)
        return order(found, self.keys).offset(begin - skipped if wanted else 0).limit(size).select(*[f"`{c}`" for c in self.columns])
