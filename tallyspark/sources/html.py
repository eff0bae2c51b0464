"""HTML account-page tables -> GRID rows (A10 / R2), as a Spark job over a
pages table ``(page_id, url, html)``.

Per page: the first visible table among the known ids, in priority order.
A table is hidden by an inline ``display: none`` of its own or of any element
around it (static HTML has no computed style).  Its own rows (``thead``, then
bodies, then ``tfoot``; rows of nested tables are text of their cell) and
their cells become text: tags removed, all character references decoded,
leading and trailing newlines and tabs trimmed.  The account name is the
source text inside the first ``<span>`` of ``#debitAccountNameDiv``, or, on a
page without that element, of the first ``h2.bel-typography.bel-typography-h2``;
``Account Name`` is prepended as first column (header row) / the account name
(data rows).  Pages that give no rows come back with the reason.
"""

from __future__ import annotations

from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.markup import END, RAW, TEXT, attributes, tokens

# Table ids in priority order and the account-name locations.
TABLE_IDS = ("creditCardRecentMovementsTable", "creditCardStateTRX", "transactionTable", "transactionTable1")
ACCOUNT_DIV_ID = "debitAccountNameDiv"
ACCOUNT_H2_CLASSES = "bel-typography bel-typography-h2"

NO_TABLE = "no visible account table"
NO_ACCOUNT = "no account name"

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# a start tag ends these open elements, up to its table
_ENDS = {"tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_SECTIONS = {"thead": 0, "tbody": 1, "tfoot": 2}
# open elements, as in browsers: a deeper one takes the place of the last
_MAX_DEPTH = 512


class _Open:
    __slots__ = ("tag", "hidden", "table", "section", "capture", "inner", "cell")

    def __init__(self, tag, hidden):
        self.tag, self.hidden = tag, hidden
        self.table = None  # the rows of a known table: (section, cells)
        self.section = 1  # of a table: the section that rows go to
        self.capture = self.inner = None  # what its inner source is, and where that begins
        self.cell = None  # the texts of a known table's cell


class _Reader:
    """Elements open at the moment, and what was found of interest."""

    def __init__(self, html: str):
        self.html = html
        self.open: list[_Open] = []
        self.around: list[_Open] = []  # the open tables
        self.cells: list[list[str]] = []  # open cells of known tables
        self.tables: dict[str, tuple[bool, list]] = {}
        self.divs = 0  # open elements inside the account element, itself included
        self.has_div = False
        self.span = self.heading = None
        for kind, tag, text, start, stop in tokens(html):
            if kind == TEXT:
                if self.cells:
                    text = text if tag in RAW and tag not in ("title", "textarea") else unescape(text)
                    for cell in self.cells:
                        cell.append(text)
            elif kind == END:
                self.end(tag, start)
            else:
                self.start(tag, text, start, stop)
        while self.open:
            self.pop(len(html))

    def start(self, tag: str, source: str, start: int, stop: int) -> None:
        ends = _ENDS.get(tag) or (("tr", "td", "th", *_SECTIONS) if tag in _SECTIONS else ())
        for k in range(len(self.open) - 1, -1, -1) if ends and self.around else ():
            if self.open[k].tag == "table":
                break
            if self.open[k].tag in ends:
                while len(self.open) > k:
                    self.pop(start)
        if tag in _VOID:
            return
        if len(self.open) >= _MAX_DEPTH:
            self.pop(start)
        names = attributes(source)
        style = "".join(unescape(names.get("style", "")).lower().split())
        own = _Open(tag, "display:none" in style or bool(self.open and self.open[-1].hidden))
        name = unescape(names.get("id", ""))
        home = self.around[-1] if self.around else None
        if tag == "table":
            self.around.append(own)
            if name in TABLE_IDS and name not in self.tables:
                own.table = []
                self.tables[name] = (not own.hidden, own.table)
        elif home is not None:
            if tag in _SECTIONS:
                home.section = _SECTIONS[tag]
            elif tag == "tr" and home.table is not None:
                home.table.append((home.section, []))
            elif tag in ("td", "th") and home.table:
                own.cell = []
                home.table[-1][1].append(own.cell)
                self.cells.append(own.cell)
        if name == ACCOUNT_DIV_ID and not self.has_div:
            self.has_div, self.divs = True, 1
        elif self.divs:
            self.divs += 1
            if tag == "span" and self.span is None:
                own.capture, own.inner, self.span = "span", stop, ""
        if tag == "h2" and self.heading is None and set(ACCOUNT_H2_CLASSES.split()) <= set(unescape(names.get("class", "")).split()):
            own.capture, own.inner, self.heading = "heading", stop, ""
        self.open.append(own)

    def pop(self, at: int) -> None:
        own = self.open.pop()
        if own.tag == "table":
            self.around.pop()
        elif own.tag in _SECTIONS and self.around:
            self.around[-1].section = 1
        if own.cell is not None:
            self.cells.pop()
        if own.capture:
            setattr(self, own.capture, self.html[own.inner : at])
        if self.divs:
            self.divs -= 1

    def end(self, tag: str, at: int) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag == tag:
                while len(self.open) > k:
                    self.pop(at)
                return
            if self.open[k].tag == "table" and tag in ("td", "th", "tr", *_SECTIONS):
                return


def _trimmed(text: str) -> str:
    return text.strip("\n\t")


def page_rows(html: str | None) -> tuple[list[list[str]], str | None, str | None]:
    """Rows (with the account column), account name, and the reason if there
    are none."""
    found = _Reader(html or "")
    rows = next((t for i in TABLE_IDS if i in found.tables and found.tables[i][0] for t in [found.tables[i][1]]), None)
    if rows is None:
        return [], None, NO_TABLE
    name = found.span if found.has_div else found.heading
    name = _trimmed(name) if name else None
    if not name:
        return [], None, NO_ACCOUNT
    texts = [[_trimmed("".join(c)) for c in cells] for _, cells in sorted(rows, key=lambda r: r[0])]
    return [["Account Name" if k == 0 else name, *cells] for k, cells in enumerate(texts)], name, None


def read_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, row_no, cells, account, reason): the rows of every page's
    table, and one row with a reason for each page without."""
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))
    kind = slim.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for page, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows, account, reason = page_rows(html)
                out += [(page, k, cells, account, None) for k, cells in enumerate(rows)]
                if reason:
                    out.append((page, None, None, None, reason))
            kinds = [b.schema.field(0).type, pa.int64(), pa.list_(pa.string()), pa.string(), pa.string()]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["page_id", "row_no", "cells", "account", "reason"])

    return slim.mapInArrow(run, f"page_id {kind}, row_no long, cells array<string>, account string, reason string")


def extract_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, row_no, cells, account) for every row of the visible table
    of every page that has one and an account name."""
    return read_tables(pages, id_col, html_col).where("reason IS NULL").drop("reason")


def table_rejects(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, reason) of the pages that give no rows."""
    return read_tables(pages, id_col, html_col).where("reason IS NOT NULL").select("page_id", "reason")
