"""HTML documents as rows: a small element tree over the standard parser, tables as Markdown, text and table blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset({"script", "style"})
SPACE = re.compile(r"\s+")
#: The HTML standard clamps the colspan attribute to so many columns.
MOST_COLUMNS = 1000


class Element:
    def __init__(self, tag: str, attrs: dict[str, str | None] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []

    def walk(self) -> Iterator[Element]:
        """This element and all inside, in order."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Element)]

    def first(self, tag: str) -> Element | None:
        return next((x for x in self.walk() if x.tag == tag and x is not self), None)

    def text(self, mark: str = "") -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag not in SKIPPED:
                stack += reversed(node.children)
        return mark.join(out)

    def html(self) -> str:
        """The element and what is inside as markup."""
        out: list[str] = []
        stack: list[Element | str] = [self]
        ends: list[str] = []  # None in the stack closes the last of these
        while stack:
            node = stack.pop()
            if node is None:
                out.append(ends.pop())
            elif isinstance(node, str):
                out.append(node)
            else:
                attrs = "".join(f' {k}="{v or ""}"' for k, v in node.attrs.items())
                out.append(f"<{node.tag}{attrs}>")
                if node.tag not in VOID:
                    ends.append(f"</{node.tag}>")
                    stack += [None, *reversed(node.children)]
        return "".join(out)


class Tree(HTMLParser):
    """A forgiving tree: end tags without an open element are ignored, and open ones end with their parent."""

    CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("[document]")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        closes = self.CLOSES.get(tag, ())
        while len(self.open) > 1 and self.open[-1].tag in closes:
            self.open.pop()
        node = Element(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Element(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def soup(html: str | None) -> Element:
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def cell_text(node: Element) -> str:
    return SPACE.sub(" ", node.text(" ").replace("|", "/")).strip()


def grid(table: Element) -> list[list[str]]:
    """Rows of cells with spans expanded, padded to one width. Rows of inner tables are theirs."""
    own_rows: list[Element] = []
    stack = list(reversed(table.children))
    while stack:
        node = stack.pop()
        if isinstance(node, Element) and node.tag == "tr":
            own_rows.append(node)
        elif isinstance(node, Element) and node.tag != "table":
            stack += reversed(node.children)
    rows: list[dict[int, str]] = []
    held: dict[tuple[int, int], str] = {}
    number = lambda v: int(v) if v and v.isdigit() and int(v) > 0 else 1
    for r, tr in enumerate(own_rows):
        row: dict[int, str] = {}
        at = 0
        for cell in (c for c in tr.children if isinstance(c, Element) and c.tag in ("td", "th")):
            while (r, at) in held:
                row[at] = held[r, at]
                at += 1
            text = cell_text(cell)
            # no cell reaches below the last row; spans widen a table to MOST_COLUMNS, and cells behind those take one place each
            wide, high = min(number(cell.attrs.get("colspan")), max(1, MOST_COLUMNS - at)), min(number(cell.attrs.get("rowspan")), len(own_rows) - r) if at < MOST_COLUMNS else 1
            for k in range(wide):
                row[at] = text
                for below in range(1, high):
                    held[r + below, at] = text
                at += 1
        while (r, at) in held:
            row[at] = held[r, at]
            at += 1
        if row:
            rows.append(row)
    width = max((max(row) + 1 for row in rows), default=0)
    return [[row.get(i, "") for i in range(width)] for row in rows]


def markdown(rows: list[list[str]]) -> str:
    """The first row as header. Cell texts stay as they are."""
    if not rows:
        return ""
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return "\n".join([line(rows[0]), line(["---"] * len(rows[0])), *map(line, rows[1:])])


def largest_table(html: str | None) -> str:
    """The table of most cells as Markdown, of equals the first."""
    grids = [grid(t) for t in soup(html).walk() if t.tag == "table"]
    return markdown(max(grids, key=lambda g: sum(map(len, g)), default=[]))


def blocks(html: str | None) -> list[tuple[str, str]]:
    """(kind, payload) in order: tables as Markdown, and all text between two tables as one block on one line."""
    out: list[tuple[str, str]] = []
    buffer: list[str] = []

    def flush() -> None:
        text = SPACE.sub(" ", " ".join(buffer)).strip()
        buffer.clear()
        if text:
            out.append(("text", text))

    stack: list = [soup(html)]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            buffer.append(node)
        elif node.tag == "table":
            text = markdown(grid(node))
            if text:
                flush()
                out.append(("table", text))
        elif node.tag not in SKIPPED:
            stack += reversed(node.children)
    flush()
    return out


def plain(html: str | None) -> str:
    """All text of a document, stripped pieces on lines of their own."""
    out: list[str] = []
    stack: list = [soup(html)]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out += [node.strip()] if node.strip() else []
        elif node.tag not in SKIPPED:
            stack += reversed(node.children)
    return "\n".join(out)


def split(docs: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, kind, payload) of each document's blocks."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(k, i, kind, payload) for k, h in zip(frame[key], frame[html], strict=True) for i, (kind, payload) in enumerate(blocks(h))]
            yield pd.DataFrame(rows, columns=[key, "pos", "kind", "payload"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, html).mapInPandas(each, f"{key} {kind}, pos int, kind string, payload string")
