"""HTML table tokenizer run inside executors (``mapInArrow``).

Self-contained on purpose: it imports only the standard library and pyarrow,
and is shipped to the Python workers by value (cloudpickle), so executors do
not need this package installed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle

SECTIONS = ("thead", "tbody", "tfoot")
ROW_FIELDS = [("section", "string"), ("section_idx", "int"), ("cells", "array<string>"), ("cells_spaced", "array<string>")]
_ROW = "struct<" + ",".join(f"{n}:{t}" for n, t in ROW_FIELDS) + ">"
#: One page: its tables in document order, each with its text, first caption, heads of its first thead and rows.
TABLES = f"array<struct<text:string,caption:string,heads:array<string>,rows:array<{_ROW}>>>"
_ARROW_ROW = pa.struct([("section", pa.string()), ("section_idx", pa.int32()), ("cells", pa.list_(pa.string())), ("cells_spaced", pa.list_(pa.string()))])
_ARROW_TABLES = pa.list_(pa.struct([("text", pa.string()), ("caption", pa.string()), ("heads", pa.list_(pa.string())), ("rows", pa.list_(_ARROW_ROW))]))
#: Characters of pages parsed before a batch of results leaves.
FLUSH_AT = 4 << 20


def _joined(fragments: list[str], sep: str) -> str:
    parts = (f.strip() for f in fragments)
    return sep.join(p for p in parts if p).replace("\xa0", " ")


class _Table:
    """A table being read. ``heads`` stays None without a thead, ``caption`` without a caption."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.caption = self.heads = self.row = self.cell = None
        self.rows: list[dict] = []
        self.section, self.section_idx = "", -1
        self.counts = dict.fromkeys(SECTIONS, 0)

    def close_cell(self) -> None:
        if self.cell is None:
            return
        (kind, fragments), self.cell = self.cell, None
        if kind == "caption" and self.caption is None:
            self.caption = "".join(fragments)
        elif kind == "th" and self.section == "thead" and self.section_idx == 0:
            self.heads.append(_joined(fragments, ""))
        elif kind == "td" and self.row is not None:
            self.row["cells"].append(_joined(fragments, ""))
            self.row["cells_spaced"].append(_joined(fragments, " "))

    def close_row(self) -> None:
        self.close_cell()
        self.row = None

    def open(self, tag: str) -> None:
        if tag in SECTIONS:
            self.close_row()
            self.section, self.section_idx = tag, self.counts[tag]
            self.counts[tag] += 1
            if tag == "thead" and self.heads is None:
                self.heads = []
        elif tag == "tr":
            self.close_row()
            self.row = {"section": self.section, "section_idx": self.section_idx, "cells": [], "cells_spaced": []}
            self.rows.append(self.row)
        elif tag in ("td", "th", "caption"):
            self.close_cell()
            self.cell = (tag, [])

    def shut(self, tag: str) -> None:
        if tag in ("td", "th", "caption"):
            self.close_cell()
        elif tag == "tr" or tag in SECTIONS:
            self.close_row()
            if tag in SECTIONS:
                self.section, self.section_idx = "", -1

    def record(self) -> dict:
        self.close_row()
        return {"text": "".join(self.text), "caption": self.caption, "heads": self.heads, "rows": self.rows}


class _TableParser(HTMLParser):
    """Collects the tables of a page; one inside another is a table of its own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[_Table] = []
        self.open_tables: list[_Table] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            if self.open_tables:
                self.open_tables[-1].close_cell()
            self.open_tables.append(_Table())
            self.tables.append(self.open_tables[-1])
        elif self.open_tables:
            self.open_tables[-1].open(tag)

    def handle_endtag(self, tag):
        if not self.open_tables:
            return
        if tag == "table":
            self.open_tables.pop().close_row()
        else:
            self.open_tables[-1].shut(tag)

    def handle_data(self, data):
        if self.cdata_elem is None and self.open_tables:  # no script or style text
            self.open_tables[-1].text.append(data)
            if self.open_tables[-1].cell is not None:
                self.open_tables[-1].cell[1].append(data)


def parse_tables(html: str | None) -> list[dict]:
    """The tables of one page (see ``TABLES``)."""
    if not html:
        return []
    parser = _TableParser()
    parser.feed(html)
    parser.close()
    return [t.record() for t in parser.tables]


def pages_fn(n_carry: int):
    """(carried columns, html) -> (carried columns, tables), a row a page, in batches of bounded size."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, size, tables = 0, 0, []
            for html in batch.column(n_carry):
                text = html.as_py()
                tables.append(parse_tables(text))
                size += len(text or "")
                if size >= FLUSH_AT:
                    yield _tables_batch(batch.slice(start, len(tables)), n_carry, tables)
                    start, size, tables = start + len(tables), 0, []
            if tables:
                yield _tables_batch(batch.slice(start, len(tables)), n_carry, tables)

    return fn


def _tables_batch(pages: pa.RecordBatch, n_carry: int, tables: list) -> pa.RecordBatch:
    names = [*pages.schema.names[:n_carry], "tables"]
    return pa.RecordBatch.from_arrays([*pages.columns[:n_carry], pa.array(tables, _ARROW_TABLES)], names=names)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
