"""Records out of HTML pages held in a ``pages`` frame.

``extract_rows`` follows an extraction setting (container, row and cell elements, link targets) and runs a small tag
reader per page inside ``mapInArrow``; pages are independent, so there is no shuffle.  ``extract_regular`` does the same
for regular markup with two regular expressions, entirely in the JVM.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip
from ..operators.columns import blanks_to_null

# The tag reader travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: elements that have no content.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


@dataclass
class _Element:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    parent: "_Element | None" = None
    parts: list = field(default_factory=list)

    def walk(self) -> Iterator["_Element"]:
        """All elements below this one, in document order."""
        todo = [p for p in reversed(self.parts) if isinstance(p, _Element)]
        while todo:
            element = todo.pop()
            yield element
            todo.extend(p for p in reversed(element.parts) if isinstance(p, _Element))

    def find_all(self, tags: Iterable[str]) -> list["_Element"]:
        wanted = set(tags)
        return [e for e in self.walk() if e.tag in wanted]

    def text(self) -> str:
        out, todo = [], list(reversed(self.parts))
        while todo:
            part = todo.pop()
            if isinstance(part, str):
                out.append(part)
            elif part.tag not in ("script", "style"):
                todo.extend(reversed(part.parts))
        return "".join(out)


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = _Element("")

    def handle_starttag(self, tag, attrs):
        element = _Element(tag, {k: v or "" for k, v in attrs}, self.here)
        self.here.parts.append(element)
        if tag not in _VOID:
            self.here = element

    def handle_startendtag(self, tag, attrs):
        self.here.parts.append(_Element(tag, {k: v or "" for k, v in attrs}, self.here))

    def handle_endtag(self, tag):
        element = self.here
        while element is not self.root and element.tag != tag:
            element = element.parent
        if element is not self.root:  # an end tag that was never opened is ignored
            self.here = element.parent

    def handle_data(self, data):
        self.here.parts.append(data)


def _has_attrs(element: _Element, attrs: dict) -> bool:
    for name, wanted in attrs.items():
        value = element.attrs.get(name)
        if value is None:
            return False
        choices = set(wanted) if isinstance(wanted, (list, tuple)) else {wanted}
        have = {value, *value.split()} if name == "class" else {value}
        if not choices & have:
            return False
    return True


def _container(root: _Element, setting: dict) -> _Element | None:
    tag = setting["table_elem"]
    if setting.get("table_title") is not None:
        for element in root.walk():
            if setting["table_title"] in [p for p in element.parts if isinstance(p, str)]:
                scope = element.parent
                return next(iter(scope.find_all([tag])), None) if scope else None
        return None
    found = root.find_all([tag])
    if setting.get("table_attrs"):
        return next((e for e in found if _has_attrs(e, setting["table_attrs"])), None)
    number = setting.get("table_num") or 0
    return found[number] if number < len(found) else None


def page_rows(html: str, setting: dict) -> list[list[str]]:
    """Cell texts (then link targets) of each row with more than one cell, but for repeated header rows."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    container = _container(reader.root, setting)
    if container is None:
        return []
    cell_tags = setting["cell_elem"]
    cell_tags = [cell_tags] if isinstance(cell_tags, str) else cell_tags
    header = (setting.get("columns") or [None, None])[1:2]
    rows = []
    for row in container.find_all([setting["row_elem"]]):
        cells = [c.text().strip() for c in row.find_all(cell_tags)]
        if setting.get("link_elem") and setting.get("link_key"):
            base = setting.get("link_base") or ""
            links = row.find_all([setting["link_elem"]])
            cells += [base + a.attrs[setting["link_key"]] for a in links if setting["link_key"] in a.attrs]
        if len(cells) > 1 and cells[1:2] != header:
            rows.append(cells)
    return rows


def extract_rows(pages: DataFrame, setting: dict, key: str = "page_id", html: str = "html") -> DataFrame:
    """(page, row number, cells) for every record of every page; result pages of one listing are just more pages."""
    key_type = pages.schema[key].dataType.simpleString()
    skip = 1 if setting.get("column_names_as_row") else 0

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keys, numbers, cells = [], [], []
            for page, source in zip(batch.column(0).to_pylist(), batch.column(1)):
                for number, row in enumerate(page_rows(source.as_py() or "", setting)[skip:]):
                    keys.append(page)
                    numbers.append(number)
                    cells.append(row)
            columns = [
                pa.array(keys, batch.schema.field(0).type),
                pa.array(numbers, pa.int32()),
                pa.array(cells, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "row_no", "cells"])

    return pages.select(key, html).mapInArrow(run, f"{key} {key_type}, row_no int, cells array<string>")


def extract_regular(
    pages: DataFrame, container: str, row: str, cell: str, key: str = "page_id", html: str = "html"
) -> DataFrame:
    """The same shape from three patterns, each with one group, for markup without nesting."""
    inside = F.regexp_extract(html, "(?s)" + container, 1)
    rows = F.regexp_extract_all(inside, F.lit("(?s)" + row), F.lit(1))
    cells = F.transform(F.regexp_extract_all("row_html", F.lit("(?s)" + cell), F.lit(1)), strip)
    return (
        pages.select(key, F.posexplode(rows).alias("row_no", "row_html"))
        .select(key, "row_no", cells.alias("cells"))
        .where(F.size("cells") > 1)
    )


def table_width(rows: DataFrame) -> int:
    """The widest row: one number, needed to name the columns."""
    return rows.agg(F.max(F.size("cells"))).first()[0] or 0


def fitted_names(names: list[str], width: int) -> list[str]:
    """The name list cut or padded to the table's width."""
    return (names + [f"Unnamed_column_{i}" for i in range(width - len(names))])[:width]


def name_cells(rows: DataFrame, names: list[str], width: int, keep: list[str] = ("page_id", "row_no")) -> DataFrame:
    """Cells as named columns; blank cells become null and wholly blank records go."""
    fitted = fitted_names(names, width)
    named = rows.select(*keep, *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(fitted)])
    return blanks_to_null(named, fitted).na.drop(how="all", subset=fitted) if fitted else named

