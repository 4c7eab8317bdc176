"""Markup to blocks, grids and inline marks.

Order and nesting of mixed content have no relational form, so these run as table functions and
Arrow UDFs over one document at a time, on the standard library's tolerant parser.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser
from xml.sax.saxutils import quoteattr

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import udtf

# Fixed values of HTML.
BLOCKS = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "td", "th", "title"}
SILENT = {"script", "style", "template"}
VOID = {"br", "img", "hr", "input", "meta", "link"}
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}
#: The most rows that a cell of HTML spans.
WIDEST = 65_534


class _Reader(HTMLParser):
    """Blocks in reading order as (kind, depth, text), inline tags turned into marks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.text: list[str] = []
        self.kind, self.link = "body", ""
        self.out: list[tuple[str, int, str]] = []

    def flush(self) -> None:
        text = " ".join("".join(self.text).split(" ")).strip(" \n\t\r")
        text = "\n".join(" ".join(x.split()) for x in text.split("\n") if x.strip())
        if text:
            self.out.append((self.kind, len(self.stack), text))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            self.kind = tag
        if tag in MARKS:
            self.text.append(MARKS[tag])
        elif tag == "br":
            self.text.append("\n")
        elif tag == "img":
            self.text.append(f"![{dict(attrs).get('alt') or ''}]")
        elif tag == "a":
            self.link = dict(attrs).get("href") or ""
            self.text.append("[" if self.link else "")
        if tag not in VOID:
            self.stack.append(tag)

    def handle_endtag(self, tag):
        if tag in MARKS:
            self.text.append(MARKS[tag])
        elif tag == "a" and self.link:
            self.text.append(f"]({self.link})")
            self.link = ""
        if tag in BLOCKS:
            self.flush()
            self.kind = "body"
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass

    def handle_data(self, data):
        if not SILENT & set(self.stack):
            self.text.append(data)


def blocks_of(html: str) -> list[tuple[str, int, str]]:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.flush()
    return reader.out


@udtf(returnType="pos int, kind string, depth int, text string")
class PageBlocks:
    """A row for each block of a page."""

    def eval(self, html: str) -> Iterator[tuple[int, str, int, str]]:
        for pos, (kind, depth, text) in enumerate(blocks_of(html)):
            yield pos, kind, depth, text


def _span(value: str | None) -> int:
    return min(int(value), WIDEST) if value and value.isdigit() and int(value) > 0 else 1


class _Tables(HTMLParser):
    """The cells of each outermost table: rows of (text, columns, rows, in head).

    HTML says spans as colspan and rowspan; the exchange model of CALS names first and last columns
    and counts further rows.
    """

    def __init__(self, row: str = "tr", cells: tuple[str, ...] = ("td", "th")):
        super().__init__(convert_charrefs=True)
        self.row, self.cells = row, cells
        self.tables, self.depth, self.head, self.cell, self.names = [], 0, False, None, {}

    def _spans(self, values: dict) -> tuple[int, int]:
        if "namest" in values and "nameend" in values:
            first, last = self.names.get(values["namest"]), self.names.get(values["nameend"])
            return (last - first + 1 if first is not None and last is not None and last >= first else 1), _span(str(int(values["morerows"]) + 1) if (values.get("morerows") or "").isdigit() else None)
        if (values.get("morerows") or "").isdigit():
            return 1, _span(str(int(values["morerows"]) + 1))
        return _span(values.get("colspan")), _span(values.get("rowspan"))

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.tables.append([])
                self.names = {}
        if self.depth != 1:
            return
        if tag == "colspec":
            self.names[dict(attrs).get("colname")] = len(self.names)
        elif tag == "thead":
            self.head = True
        elif tag == self.row:
            self.tables[-1].append([])
        elif tag in self.cells and self.tables[-1]:
            self.cell = ["", *self._spans(dict(attrs)), self.head]
            self.tables[-1][-1].append(self.cell)

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif tag == "thead":
            self.head = False
        elif tag in self.cells and self.depth == 1:
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell[0] += data


def grid_of(rows: list[list]) -> str:
    """A pipe table: spans repeat their cell, short rows are filled, a missing head is blank."""
    grid, carried, heads = [], {}, []
    for cells in rows:
        line, left, at = [], list(cells), 0
        while left or at in carried:
            if at in carried:
                text, more = carried.pop(at)
                if more > 1:
                    carried[at] = (text, more - 1)
                line.append(text)
                at += 1
                continue
            text, columns, down, _ = left.pop(0)
            text = " ".join(text.split()).replace("|", "\\|")
            for _ in range(columns):
                if down > 1:
                    carried[at] = (text, down - 1)
                line.append(text)
                at += 1
        if line:
            heads.append(bool(cells) and cells[0][3])
            grid.append(line)
    if not grid:
        return ""
    width = max(map(len, grid))
    grid = [x + [""] * (width - len(x)) for x in grid]
    top = max((i for i, head in enumerate(heads) if head), default=None)
    head = grid.pop(top) if top is not None else [""] * width
    shown = lambda x: "| " + " | ".join(x) + " |"
    return "\n".join([shown(head), shown(["---"] * width), *map(shown, grid)])


#: What stays of a table inside a table, which a pipe table has no form for.
KEPT_TAGS = frozenset("table colgroup col thead tbody tfoot tr th td caption p span b strong i em sup sub br a img".split())
KEPT_ATTRIBUTES = ("rowspan", "colspan", "href", "src", "alt")


def kept_markup(node) -> str:
    """A tree as HTML with the kept elements and attributes alone; of others their text stays, of odd links nothing."""
    out = []
    for item in node.items:
        if isinstance(item, str):
            out.append(escape(item, quote=False) if item.strip() else "")
        elif item.tag not in KEPT_TAGS:
            out.append("" if item.tag in SILENT else kept_markup(item))
        else:
            named = [(k, item.attrs[k]) for k in KEPT_ATTRIBUTES if item.attrs.get(k) and (k not in ("href", "src") or re.match(r"(?:https?:/|[/#])", item.attrs[k]))]
            out.append(f"<{item.tag}{''.join(f' {k}={quoteattr(v)}' for k, v in named)}>" + ("" if item.tag in VOID else f"{kept_markup(item)}</{item.tag}>"))
    return "".join(out)


def _outer_tables(node) -> Iterator:
    for item in node.items:
        if not isinstance(item, str):
            if item.tag == "table":
                yield item
            else:
                yield from _outer_tables(item)


def grids_of(html: str | None, row: str = "tr", cells: tuple[str, ...] = ("td", "th"), cell: Callable[[str], str] | None = None) -> list[str]:
    """The outermost tables: pipe tables below their captions, or markup where a table holds another one.

    ``cell`` is called with the text of each cell and gives what is shown.
    """
    from lexloom.sources import layouts

    reader = _Tables(row, cells)
    reader.feed(html or "")
    out = []
    root, _ = layouts.tree(html or "", "html")
    for rows, node in zip(reader.tables, _outer_tables(root)):
        if layouts.find(node, "table"):
            whole = layouts.Node("")
            whole.items.append(node)
            out.append(kept_markup(whole))
            continue
        for line in rows if cell else ():
            for x in line:
                x[0] = cell(x[0])
        caption, grid = layouts.first(node, "caption"), grid_of(rows)
        if grid:
            out.append(f"{caption}\n\n{grid}" if caption else grid)
    return out


def table_grids(html: Column, row: str = "tr", cells: tuple[str, ...] = ("td", "th"), cell: Callable[[str], str] | None = None) -> Column:
    """The tables of each page; ``row`` and ``cells`` name the tags of the dialect, ``cell`` changes a cell's text."""
    def grids(html: pd.Series) -> pd.Series:
        return html.map(lambda text: grids_of(text, row, cells, cell))

    return F.pandas_udf(grids, "array<string>")(html)


@udtf(returnType="block string, version int, src string, pub string, eff string, text string, expiry string, error string")
class VersionedBlocks:
    """Blocks with dated versions of an XML document, a row each version.

    The layout is ``block(id, expiry) > version(src, pub, eff) > p``; dates stay text.  Of a broken
    document come the blocks that can be read, each with what is wrong under ``error``; where there are
    none, or the document is empty, one row says so.
    """

    def eval(self, xml: str) -> Iterator[tuple]:
        from lexloom.sources import layouts

        root, error = layouts.tree(xml or "", "xml")
        found = 0
        for block in layouts.find(root, "block"):
            for number, version in enumerate(layouts.find(block, "version")):
                text = "\n\n".join("".join(p.pieces()).strip() for p in layouts.find(version, "p"))
                found += 1
                yield block.attrs.get("id"), number, version.attrs.get("src"), version.attrs.get("pub"), version.attrs.get("eff"), text, block.attrs.get("expiry"), error
        if not found:
            yield None, None, None, None, None, None, None, error or "no blocks"
