"""Records out of flat cell sequences and option lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.aggregates import running_last


def cards(options: DataFrame, card: list[str], label: str, value: str, position: str, names: dict[str, str]) -> DataFrame:
    """One row per card, with the value of each wanted label as a column; a repeated label keeps its last value.

    ``options`` has one row per (card, label); ``names`` maps labels to columns.
    """
    return options.groupBy(*card).agg(
        *[
            F.max_by(F.when(F.col(label) == shown, F.col(value)), F.when(F.col(label) == shown, F.col(position))).alias(c)
            for shown, c in names.items()
        ]
    )


def placed_cells(cells: DataFrame, page: list[str], position: str, cell: str, marker: str, block: int = 10_000, tasks: int | None = None) -> DataFrame:
    """``page, record_start, place, cell``: every cell with the record it belongs to and its place there, the marker cut away.

    A cell holding the marker starts a record; cells before the first one form a record of their own.  The start of a record
    is a running maximum taken block by block, so a long page need not fit into a task (``tasks``: see ``running_last``).
    """
    starts = F.when(F.col(cell).contains(marker), F.col(position))
    placed = running_last(cells, page, position, starts, "record_start", block, tasks)
    placed = placed.withColumn("record_start", F.coalesce("record_start", F.lit(0).cast("long")))
    text = F.replace(F.col(cell), F.lit(marker), F.lit(""))
    return placed.select(*page, "record_start", (F.col(position) - F.col("record_start")).alias("place"), text.alias("cell"))


def marked_records(
    cells: DataFrame, page: list[str], position: str, cell: str, marker: str, names: list[str], block: int = 10_000, more: bool = True, tasks: int | None = None
) -> DataFrame:
    """Records of a flat cell sequence in which a cell holding the marker starts a record.

    Cells are named by their place in the record; ``cell_count`` tells how many a record had.  Cells past the names follow in the
    array ``more_cells``, so a record, as a row, has to fit into a task; say ``more=False`` where records may be of any
    length, and take them as rows from ``further_cells``.
    """
    placed = placed_cells(cells, page, position, cell, marker, block, tasks)
    place = F.col("place")
    past = F.collect_list(F.when(place >= len(names), F.struct(place, F.col("cell"))))
    return placed.groupBy(*page, "record_start").agg(
        *[F.max(F.when(place == i, F.col("cell"))).alias(name) for i, name in enumerate(names)],
        *([F.transform(F.array_sort(past), _cell).alias("more_cells")] if more else []),
        F.count(F.lit(1)).alias("cell_count"),
    )


def further_cells(cells: DataFrame, page: list[str], position: str, cell: str, marker: str, names: list[str], block: int = 10_000) -> DataFrame:
    """``page, record_start, place, cell`` of the cells past the names of ``marked_records``, a row each."""
    return placed_cells(cells, page, position, cell, marker, block).where(F.col("place") >= len(names))


def _cell(numbered: Column) -> Column:
    return numbered["cell"]
