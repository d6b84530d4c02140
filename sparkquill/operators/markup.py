"""HTML as rows of events, and what is built of them by Spark: blocks of text, rows and cells of tables, Markdown, sections.

Python does one thing: what the standard parser sees becomes rows in order, with end tags supplied where a forgiving reader sees
them: tags and texts (``Events``), or the cells and texts of them (``Pieces``), where no tags are asked for. Depths are running
sums of events, blocks are islands between them, tables are grouped from cells to rows to grids, and sections are chosen by
running maxima of headings, all in windows and groups of one document, which need one shuffle. A document's rows are sorted on disk where they are many.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sparkquill.functions import scalars as S
from sparkquill.shared import stored

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is none.
SKIPPED = ("script", "style")
#: What an opening tag ends, if it is the innermost open element.
CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: The HTML standard clamps the colspan attribute to so many columns; spans widen a table to so many.
MOST_COLUMNS = 1000
OPEN, CLOSE, TEXT = "open", "close", "text"
NUMBERS = ("pos", "element", "within", "colspan", "rowspan")
EVENT = [StructField(c, IntegerType() if c in NUMBERS else StringType()) for c in ("pos", "event", "tag", "element", "parent", "within", "value", "markup", "colspan", "rowspan")]
CELL = ("text", "wide", "high")
PIECE = [StructField(c, StringType() if c == "text" else IntegerType()) for c in ("table_no", "row_no", "cell", *CELL)]


def spans_of(attrs: dict) -> tuple[int, int]:
    """colspan and rowspan, 1 where there is none that counts."""
    wide, high = (int(v) if (v := attrs.get(c)) and v.isascii() and v.isdigit() and len(v) < 9 and int(v) > 0 else 1 for c in ("colspan", "rowspan"))
    return wide, high


class Events(HTMLParser):
    """Rows in order (event, tag, number of the element, tag and number of its parent, text, markup, colspan, rowspan). Every
    opened element is closed, at the end of its parent at last."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.open = [("[document]", 0)]
        self.depths: dict[str, list[int]] = {}
        self.count = 0

    def _start(self, tag: str, attrs: list) -> None:
        self.count += 1
        held = dict(attrs)
        written = "".join(f' {k}="{v or ""}"' for k, v in held.items())
        self.rows.append((OPEN, tag, self.count, *self.open[-1], None, f"<{tag}{written}>", *spans_of(held)))
        self.depths.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, self.count))

    def _end(self, depth: int) -> None:
        while len(self.open) > depth:
            tag, number = self.open.pop()
            self.depths[tag].pop()
            self.rows.append((CLOSE, tag, number, *self.open[-1], None, "" if tag in VOID else f"</{tag}>", 1, 1))

    def handle_starttag(self, tag, attrs):
        closes = CLOSES.get(tag, ())
        while self.open[-1][0] in closes:
            self._end(len(self.open) - 1)
        self._start(tag, attrs)
        if tag in VOID:
            self._end(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs)
        self._end(len(self.open) - 1)

    def handle_endtag(self, tag):
        if self.depths.get(tag):
            self._end(self.depths[tag][-1])

    def updatepos(self, i, j):
        """Lines are not counted."""
        return j

    def handle_data(self, data):
        self.rows.append((TEXT, None, None, *self.open[-1], data, data, 1, 1))


def events_of(html: str | None) -> list[tuple]:
    parser = Events()
    parser.feed(html or "")
    parser.close()
    parser._end(1)  # noqa: SLF001
    return parser.rows


def _emitted(docs: DataFrame, key: str, html: str, fields: list[StructField], rows_of: Callable[[str | None], list[tuple]], at_once: int) -> DataFrame:
    """(key, fields ...): the rows that each document gives, in its order, some ``at_once`` at a time."""
    schema = StructType([docs.schema[key], *fields])
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            at: list[int] = []

            def done(batch=batch) -> pa.RecordBatch:
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *columns], names=schema.names)

            for i, text in enumerate(batch.column(1)):
                found = rows_of(text.as_py())
                rows += found
                at += [i] * len(found)
                if len(rows) >= at_once:
                    yield done()
                    rows, at = [], []
            if rows:
                yield done()

    return docs.select(key, html).mapInArrow(each, schema)


def events(docs: DataFrame, key: str, html: str = "html", at_once: int = 20_000) -> DataFrame:
    """(key, EVENT ...) of documents; ``key`` is unique."""
    return _emitted(docs, key, html, EVENT, lambda text: [(i, *row) for i, row in enumerate(events_of(text))], at_once)


def clean_cell(texts: list[str]) -> str:
    return " ".join(" ".join(texts).replace("|", "/").split())


class Pieces(Events):
    """Rows in order (number of the last outermost table, of its row, of the cell, text, colspan, rowspan): each cell of a table with all
    its text, a row that has none without a cell, and all text between two tables without a row. What is inside an inner table is
    text of the cell around it."""

    def __init__(self):
        super().__init__()
        self.outside: list[str] = []
        self.cell: list[str] | None = None
        self.empty = True
        self.spans = (1, 1)
        self.tables = self.table_rows = self.skipped = 0
        self.numbers = {"table": 0, "tr": 0, "cell": 0}

    def _start(self, tag: str, attrs: list) -> None:
        parent = self.open[-1][0]
        self.depths.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, 0))
        if tag == "table":
            self.tables += 1
            if self.tables == 1:
                self._text()
                self.numbers["table"] += 1
        elif tag in SKIPPED:
            self.skipped += 1
        elif self.tables != 1:
            pass
        elif tag == "tr":
            self.table_rows += 1
            if self.table_rows == 1:
                self.numbers["tr"] += 1
                self.empty = True
        elif tag in ("td", "th") and parent == "tr" and self.table_rows == 1:
            self.numbers["cell"] += 1
            self.cell, self.spans = [], spans_of(dict(attrs)) if attrs else (1, 1)

    def _end(self, depth: int) -> None:
        while len(self.open) > depth:
            tag, _ = self.open.pop()
            self.depths[tag].pop()
            if tag == "table":
                self.tables -= 1
            elif tag in SKIPPED:
                self.skipped -= 1
            elif self.tables != 1:
                pass
            elif tag == "tr":
                self.table_rows -= 1
                if self.table_rows == 0 and self.empty:
                    self.rows.append((self.numbers["table"], self.numbers["tr"], None, None, None, None))
            elif tag in ("td", "th") and self.open[-1][0] == "tr" and self.table_rows == 1:
                self.rows.append((self.numbers["table"], self.numbers["tr"], self.numbers["cell"], clean_cell(self.cell), *self.spans))
                self.cell, self.empty = None, False

    def handle_data(self, data):
        if not self.skipped:
            if not self.tables:
                self.outside.append(data)
            elif self.cell is not None:
                self.cell.append(data)

    def _text(self) -> None:
        if self.outside:
            self.rows.append((self.numbers["table"], None, None, " ".join(self.outside), None, None))
            self.outside = []


def pieces_of(html: str | None) -> list[tuple]:
    parser = Pieces()
    parser.feed(html or "")
    parser.close()
    parser._end(1)  # noqa: SLF001
    parser._text()  # noqa: SLF001
    return parser.rows


def pieces(docs: DataFrame, key: str, html: str = "html", at_once: int = 20_000) -> DataFrame:
    """(key, PIECE ...) of documents; ``key`` is unique."""
    return _emitted(docs, key, html, PIECE, pieces_of, at_once)


def _depth(upto, *tags: str, where: Column | None = None) -> Column:
    """How many elements of these tags are open behind an event."""
    mine = F.col("tag").isin(*tags) if where is None else F.col("tag").isin(*tags) & where
    return F.coalesce(F.sum(F.when(mine & (F.col("event") == OPEN), 1).when(mine & (F.col("event") == CLOSE), -1)).over(upto), F.lit(0))


def _joined(value: Column, place: Column, when: Column, mark: str) -> Column:
    """The values of a group in the order of their places."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(when, F.struct(place.alias("p"), value.alias("v"))))), lambda x: x["v"]), mark)


def tables(found: DataFrame, key: str) -> DataFrame:
    """(key, table_no, markdown, behind): each outermost table of documents, numbered from 1, as Markdown, empty where it has no cells;
    and the text between it and the next one. Number 0 has the text before all tables.

    found: pieces. The first row is the header."""
    # all that follows groups rows of one document, and so needs this one shuffle
    found = found.repartition(key)
    cell = F.when(F.col("cell").isNotNull(), F.struct("cell", "text", "wide", "high"))
    rows = found.groupBy(key, "table_no", "row_no").agg(F.array_sort(F.collect_list(cell)).alias("cells"), F.max(F.when(F.col("row_no").isNull(), F.col("text"))).alias("text"))
    row = F.when(F.col("row_no").isNotNull(), F.struct("row_no", "cells"))
    grids = rows.groupBy(key, "table_no").agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["cells"]).alias("rows"), F.max("text").alias("behind"))
    spans = F.exists("rows", lambda r: F.exists(r, lambda c: (c["wide"] > 1) | (c["high"] > 1)))
    plain = F.filter(F.transform("rows", lambda r: F.transform(r, lambda c: c["text"])), lambda r: F.size(r) > 0)
    grids = grids.withColumn("spanned", F.when(spans, F.col("rows"))).withColumn("placed", F.arrow_udf(_placed, "array<array<string>>")("spanned"))
    return grids.withColumn("grid", F.coalesce("placed", plain)).select(key, "table_no", markdown(F.col("grid")).alias("markdown"), "behind")


def _placed(tables: pa.Array) -> pa.Array:
    """Columns are read whole, as a dictionary for each cell costs more than its place."""
    own, rows = pc.list_value_length(tables).to_pylist(), tables.flatten()
    sizes, cells = iter(pc.list_value_length(rows).to_pylist()), rows.flatten()
    held = zip(*[cells.field(c).to_pylist() for c in CELL], strict=True)
    return pa.array([None if n is None else placed([[dict(zip(CELL, x, strict=True)) for x in islice(held, next(sizes))] for _ in range(n)]) for n in own], pa.list_(pa.list_(pa.string())))


def placed(rows: list) -> list[list[str]]:
    """Texts in the places that spans leave them: a cell stands in every place that it spans, none below the last row. Spans
    widen a table to MOST_COLUMNS; cells behind those take one place each."""
    out: list[dict[int, str]] = []
    held: dict[int, tuple[str, int]] = {}  # by column: a text from above, and for how many rows yet
    for r, cells in enumerate(rows):
        row: dict[int, str] = {}
        below = {k: (text, n - 1) for k, (text, n) in held.items() if n > 1}
        at = 0
        for cell in [*cells, None]:
            while at in held:
                row[at] = held[at][0]
                at += 1
            if cell is None:
                break
            wide, high = (min(cell["wide"], MOST_COLUMNS - at), min(cell["high"], len(rows) - r)) if at < MOST_COLUMNS else (1, 1)
            for k in range(at, at + wide):
                row[k] = cell["text"]
                if high > 1:
                    below[k] = (cell["text"], high - 1)
            at += wide
        if row:
            out.append(row)
        held = below
    width = max((max(row) + 1 for row in out), default=0)
    return [[row.get(i, "") for i in range(width)] for row in out]


def markdown(rows: Column) -> Column:
    """Rows of cells as a Markdown table of one width, the first row as header; no rows are an empty text."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    def lines(held: Column) -> Column:
        full = F.transform(held["rows"], lambda r: line(F.concat(r, F.array_repeat(F.lit(""), held["width"] - F.size(r)))))
        rule = F.array(line(F.array_repeat(F.lit("---"), held["width"])))
        return F.transform(F.array(full), lambda x: F.array_join(F.concat(F.slice(x, 1, 1), rule, F.slice(x, F.lit(2), F.size(x))), "\n"))[0]

    whole = F.transform(F.array(F.struct(rows.alias("rows"), width.alias("width"))), lines)[0]
    return F.when(F.size(rows) > 0, whole).otherwise("")


def blocks(docs: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, kind, payload) of each document in order: outermost tables as Markdown, and all text between two tables as
    one block on one line. A table without cells parts nothing. A document without text or cells has no rows."""
    kinds = F.array(*[F.struct(F.lit(i).alias("behind"), F.col(c).alias("payload")) for i, c in enumerate(("markdown", "behind"))])
    both = tables(pieces(docs, key, html), key).select(key, "table_no", F.explode(kinds).alias("b")).select(key, "table_no", "b.*").filter("payload is not null and (behind = 1 or payload != '')")
    in_order = Window.partitionBy(key).orderBy("table_no", "behind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("part", F.sum(1 - F.col("behind")).over(in_order))
    merged = both.groupBy(key, "part", "behind").agg(_joined(F.col("payload"), F.col("table_no"), F.lit(True), " ").alias("payload"))
    payload = F.when(F.col("behind") == 1, S.collapse(F.col("payload"))).otherwise(F.col("payload"))
    merged = merged.withColumn("payload", payload).filter("payload != ''")
    pos = F.row_number().over(Window.partitionBy(key).orderBy("part", "behind")) - 1
    return merged.select(key, pos.alias("pos"), F.when(F.col("behind") == 1, "text").otherwise("table").alias("kind"), "payload")


# sections

HEADINGS = ("title", "h1", "h2", "h3", "h4")
FIGURES = ("table", "image", "img")


def flat_blocks(found: DataFrame, key: str) -> DataFrame:
    """(key, place, kind, text, markup) of headings (top, sub), paragraphs, tables and images in order of their place.

    found: events. A table is one block, whatever it holds; a table or image that is a child of a paragraph is one again.
    A heading without text is none."""
    upto = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = found.withColumns({"skipped": _depth(upto, *SKIPPED), "blocks": _depth(upto, "p", *HEADINGS, *FIGURES)})
    opened = F.col("event") == OPEN
    outer = opened & F.col("tag").isin("p", *HEADINGS, *FIGURES) & (F.col("blocks") == 1)
    inner = opened & F.col("tag").isin(*FIGURES) & (F.col("parent") == "p") & (F.col("blocks") == 2)
    held = held.withColumns({"outer": F.last(F.when(outer, F.col("pos")), True).over(upto), "outer_tag": F.last(F.when(outer, F.col("tag")), True).over(upto), "inner": F.last(F.when(inner, F.col("pos")), True).over(upto), "inner_element": F.last(F.when(inner, F.col("element")), True).over(upto)})
    inside = (F.col("blocks") > 0) | ((F.col("event") == CLOSE) & F.col("tag").isin("p", *HEADINGS, *FIGURES))
    # a figure within a paragraph lasts to its own closing event
    closes = F.first(F.when((F.col("event") == CLOSE) & (F.col("element") == F.col("inner_element")), F.col("pos")), True).over(Window.partitionBy(key, "inner").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    held = held.filter(inside & F.col("outer").isNotNull()).withColumn("until", F.when(F.col("inner") > F.col("outer"), closes))
    both = F.array(
        F.struct(F.col("outer").alias("place"), F.col("outer_tag").alias("of")),
        F.when((F.col("outer_tag") == "p") & (F.col("inner") > F.col("outer")) & (F.col("pos") <= F.col("until")), F.struct(F.col("inner").alias("place"), F.lit("inner").alias("of"))),
    )
    parts = held.select(key, "pos", "event", "tag", "value", "markup", "skipped", F.explode(F.array_compact(both)).alias("b")).select("*", "b.place", "b.of")
    text = (F.col("event") == TEXT) & (F.col("skipped") == 0)
    whole = parts.groupBy(key, "place").agg(
        F.min_by("tag", "pos").alias("tag"), F.min_by("of", "pos").alias("of"), S.normalize_heading(_joined(F.col("value"), F.col("pos"), text, " ")).alias("text"), _joined(F.col("markup"), F.col("pos"), F.lit(True), "").alias("markup")
    )
    kind = F.when(F.col("tag") == "table", "table").when(F.col("tag").isin(*FIGURES), "image").otherwise(F.coalesce(S.heading_kind(F.col("text")), F.lit("para")))
    figure = F.col("tag").isin(*FIGURES)
    return whole.filter(figure | (F.col("text") != "")).select(key, "place", kind.alias("kind"), F.when(figure, "").otherwise(F.col("text")).alias("text"), "markup")


def textual(found: DataFrame, key: str, specs: DataFrame) -> DataFrame:
    """(key, spec_id, html): what stands under the wanted sub-headings of the wanted top headings, of documents that have any.

    specs: (id, parents, titles). After a heading text is captured if it is a wanted sub-heading and the last top heading is
    wanted, too. The first heading that is met while capturing and is not wanted ends the section."""
    rows = flat_blocks(found, key).crossJoin(F.broadcast(specs.select(F.col("id").alias("spec_id"), "parents", "titles")))
    order = Window.partitionBy(key, "spec_id").orderBy("place")
    upto, before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(Window.unboundedPreceding, -1)
    heading = F.col("kind").isin("top", "sub")
    wanted = F.when(F.col("kind") == "top", S.heading_matches(F.col("text"), F.col("parents"))).when(F.col("kind") == "sub", S.heading_matches(F.col("text"), F.col("titles")))
    rows = rows.withColumn("wanted", wanted).withColumn("inside", F.coalesce(F.last(F.when(F.col("kind") == "top", F.col("wanted")), True).over(upto), F.lit(False)))
    rows = rows.withColumn("captures", F.when(heading, (F.col("kind") == "sub") & F.col("inside") & F.col("wanted")))
    rows = rows.withColumns({"capturing": F.coalesce(F.last("captures", True).over(before), F.lit(False))})
    ends = F.min(F.when(heading & F.col("capturing") & ~F.col("wanted"), F.col("place"))).over(Window.partitionBy(key, "spec_id"))
    kept = rows.withColumn("ends", ends).filter(~heading & F.col("capturing") & (F.col("ends").isNull() | (F.col("place") < F.col("ends"))))
    return kept.groupBy(key, "spec_id").agg(_joined(F.col("markup"), F.col("place"), F.lit(True), "\n").alias("html"))


def structured(found: DataFrame, key: str, specs: DataFrame) -> DataFrame:
    """(key, spec_id, html): what the first wanted SECTION-2 in a wanted SECTION-1 holds besides its own titles, perhaps nothing.

    A section's title is the first within it, at whatever depth."""
    upto = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    opened = F.col("event") == OPEN
    held = found.withColumns({"skipped": _depth(upto, *SKIPPED)})
    # the text of each title, at its opening event
    titles = held.withColumns({"title": F.last(F.when(opened & (F.col("tag") == "title"), F.col("pos")), True).over(upto), "titles": _depth(upto, "title")})
    named = titles.filter("titles > 0 and event = 'text' and skipped = 0").groupBy(key, "title").agg(_joined(F.col("value"), F.col("pos"), F.lit(True), "").alias("text"))
    marks = held.filter(F.col("tag").isin("section-1", "section-2", "title")).select(key, "pos", "event", "tag", "element")
    marks = marks.join(named.select(key, F.col("title").alias("pos"), "text"), [key, "pos"], "left")
    first = F.first(F.when(opened & (F.col("tag") == "title"), F.struct("pos", F.coalesce("text", F.lit("")).alias("text"))), True).over(later)
    sections = marks.withColumn("first", first).filter(F.col("tag") != "title")
    ends = sections.filter(F.col("event") == CLOSE).select(key, "element", F.col("pos").alias("until"))
    sections = sections.filter(opened).join(ends, [key, "element"]).filter("first.pos < until").select(key, "tag", "pos", "until", "element", F.col("first.text").alias("title"))
    one, two = (sections.filter(F.col("tag") == f"section-{n}").select(key, *[F.col(c).alias(f"{c}_{n}") for c in ("pos", "until", "element", "title")]) for n in (1, 2))
    pairs = one.join(two, key).filter("pos_2 > pos_1 and until_2 < until_1")  # the sections of one document, some dozens
    chosen = pairs.crossJoin(F.broadcast(specs.select(F.col("id").alias("spec_id"), "parents", "titles"))).filter(S.heading_matches(F.col("title_1"), F.col("parents")) & S.heading_matches(F.col("title_2"), F.col("titles")))
    chosen = chosen.groupBy(key, "spec_id").agg(F.min(F.struct("pos_1", "pos_2", "until_2", "element_2")).alias("s")).select(key, "spec_id", "s.*")
    inside = found.join(chosen, key).filter("pos > pos_2 and pos < until_2")
    within = Window.partitionBy(key, "spec_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    child = (F.col("within") == F.col("element_2")) & (F.col("event") != CLOSE)
    inside = inside.withColumn("part", F.last(F.when(child, F.col("pos")), True).over(within))
    parts = inside.groupBy(key, "spec_id", "part").agg(F.min_by("tag", "pos").alias("tag"), _joined(F.col("markup"), F.col("pos"), F.lit(True), "").alias("markup"))
    text = F.when(F.col("tag").isNull(), S.stripped(F.col("markup"))).otherwise(F.col("markup"))
    kept = parts.withColumn("text", text).filter("text != '' and (tag is null or tag != 'title')").groupBy(key, "spec_id").agg(_joined(F.col("text"), F.col("part"), F.lit(True), "\n").alias("html"))
    return chosen.select(key, "spec_id").join(kept, [key, "spec_id"], "left").withColumn("html", F.coalesce("html", F.lit("")))


def sections(docs: DataFrame, key: str, specs: DataFrame, html: str = "html") -> DataFrame:
    """(key, spec_id, strategy, html) of the wanted sections that documents have. A structured one, though it be empty, goes before
    a textual one."""
    # only documents with a section can have a structured one; where those are all that is wanted, no textual one is looked for
    nested = F.coalesce(F.col(html).rlike("(?i)<section-2"), F.lit(False))
    # dealt anew, as a small file may hold many documents, which one task would parse
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.sparkSession.sparkContext.defaultParallelism)
    dealt = lambda some: some.select(key, html).repartition(parts, key)
    inside, others = stored(events(dealt(docs.filter(nested)), key, html), "nested"), stored(events(dealt(docs.filter(~nested)), key, html), "events")
    built = stored(structured(inside, key, specs), "structured").withColumn("strategy", F.lit("structured"))
    whole = built.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") == specs.select("id").distinct().count()).select(key)
    flat = textual(others.unionByName(inside.join(whole, key, "left_anti")), key, specs)
    flat = flat.join(built.select(key, "spec_id"), [key, "spec_id"], "left_anti").withColumn("strategy", F.lit("textual"))
    return built.unionByName(flat).select(key, "spec_id", "strategy", "html")
