"""Finding sections of structured and of flat documents.

A structured document nests SECTION-1 and SECTION-2 elements with titles; a flat one has headings among its paragraphs.
For each wanted section the first member file and strategy that has it wins.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkquill.functions.scalars import ROMAN, SUB_HEADING, TOP_HEADING
from sparkquill.operators import markup
from sparkquill.operators.html_blocks import Element
from sparkquill.operators.relational import first_by

HEADINGS = frozenset({"title", "h1", "h2", "h3", "h4"})


@dataclass(frozen=True)
class Spec:
    id: str
    parents: tuple[str, ...]
    titles: tuple[str, ...]


def normalized(text: str | None) -> str:
    out = text or ""
    for sign, letters in ROMAN.items():
        out = out.replace(sign, letters)
    return re.sub(r"\s+", " ", out.replace("．", ".")).strip()


def matches(text: str | None, patterns: tuple[str, ...]) -> bool:
    bare = normalized(text).replace(" ", "")
    return any(p.replace(" ", "") in bare for p in patterns)


def structured(root: Element, spec: Spec) -> str | None:
    """What the section holds besides its own titles; None if there is no such section."""
    for outer in (x for x in root.walk() if x.tag == "section-1"):
        title = outer.first("title")
        if title is None or not matches(title.text(), spec.parents):
            continue
        for inner in (x for x in outer.walk() if x.tag == "section-2"):
            own = inner.first("title")
            if own is not None and matches(own.text(), spec.titles):
                parts = (c.strip() if isinstance(c, str) else c.html() for c in inner.children if isinstance(c, str) or c.tag != "title")
                return "\n".join(p for p in parts if p)
    return None


def flat_blocks(root: Element) -> Iterator[tuple[str, str, str]]:
    """(kind, text, markup) of headings, paragraphs, tables and images in order; a table is one block."""
    stack: list = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            continue
        if node.tag in ("table", "image", "img"):
            yield ("table" if node.tag == "table" else "image"), "", node.html()
            continue
        if node.tag == "p" or node.tag in HEADINGS:
            text = normalized(node.text(" "))
            top, sub = re.match(TOP_HEADING, text), re.match(SUB_HEADING, text)
            if text:
                yield ("top" if top else "sub" if sub else "para"), text, node.html()
            if node.tag != "p":
                continue
            stack += [c for c in reversed(node.children) if isinstance(c, Element) and c.tag in ("table", "image", "img")]
            continue
        stack += reversed(node.children)


def textual(root: Element, spec: Spec) -> str | None:
    """What stands under the wanted sub-headings of the wanted top headings, headings left out; None if that is nothing.

    Either heading may be repeated, as on the pages that follow: the capture goes on under the same sub-heading, and begins
    again under it after the top heading. It ends with another heading."""
    inside = capturing = False
    found: list[str] = []
    for kind, text, markup in flat_blocks(root):
        if kind not in ("top", "sub"):
            found += [markup] if capturing else []
            continue
        wanted = matches(text, spec.parents if kind == "top" else spec.titles)
        if capturing and not wanted:
            break
        if kind == "top":
            inside, capturing = wanted, False
        elif inside:
            capturing = wanted
    return "\n".join(found) or None


def members(content: bytes | None) -> Iterator[tuple[str, str]]:
    """(name, text) of the XML files of a ZIP archive."""
    with zipfile.ZipFile(io.BytesIO(content or b"")) as archive:
        for name in archive.namelist():
            if name.lower().endswith(".xml"):
                yield name, archive.read(name).decode("utf-8", "replace")


def candidates(reports: DataFrame, specs: list[Spec]) -> DataFrame:
    """(report, spec_id, member, member_ord, strategy, html) of every hit; reports: (report, member, member_ord, markup).

    An empty structured hit still counts, so the textual strategy is not tried on that member. Markup becomes rows of events,
    and sections are found by windows over them (``markup``)."""
    spark = reports.sparkSession
    wanted = spark.createDataFrame([(s.id, list(s.parents), list(s.titles)) for s in specs], "id string, parents array<string>, titles array<string>")
    members = reports.select("report", "member", "member_ord", "markup", F.sha2(F.to_json(F.struct("report", "member", "member_ord")), 256).alias("_document"))
    found = markup.sections(members, "_document", wanted, "markup")
    return members.drop("markup").join(found, "_document").select("report", "spec_id", "member", "member_ord", "strategy", "html")


def extracted(reports: DataFrame, specs: list[Spec]) -> DataFrame:
    """(report, spec_id, found, strategy, member, html): one row for each report and wanted section."""
    hits = first_by(candidates(reports, specs).filter("html != ''"), ["report", "spec_id"], F.col("member_ord"))
    wanted = reports.select("report").distinct().withColumn("spec_id", F.explode(F.array(*[F.lit(s.id) for s in specs])))
    return wanted.join(hits, ["report", "spec_id"], "left").withColumn("found", F.col("html").isNotNull())


def success(results: DataFrame) -> DataFrame:
    """Sections found per strategy, with the share of all wanted ones."""
    total = results.agg(F.greatest(F.count("*"), F.lit(1)).alias("total"))
    return results.filter("found").groupBy("strategy").agg(F.count("*").alias("n")).crossJoin(total).withColumn("share", F.round(F.col("n") / F.col("total"), 6))
