"""Blocks, tables and sections built by Spark from events, against the element tree."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparkquill.operators import html_blocks, markup, sections

TAGS = ("p", "div", "span", "table", "tr", "td", "th", "b", "ul", "li", "script", "style", "h1", "h2", "br", "img", "tbody")
TEXTS = ("one", "two | three", " four\n five ", "1. item", "II. top", "&amp; six", "<!-- c -->", "　", "")


def soup(seed: int) -> str:
    """Random markup with unclosed and stray tags."""
    rng = random.Random(seed)
    out = []
    for _ in range(rng.choice((3, 12, 60, 150))):
        tag = rng.choice(TAGS)
        kind = rng.random()
        if kind < 0.45:
            spans = "".join(f' {c}="{rng.choice((2, 3, 0, "x", 40))}"' for c in ("colspan", "rowspan") if rng.random() < 0.12)
            out.append(f"<{tag}{spans}>")
        elif kind < 0.75:
            out.append(f"</{tag}>")
        else:
            out.append(rng.choice(TEXTS))
    return "".join(out)


def table(seed: int) -> str:
    rng = random.Random(seed)
    span = lambda: f" colspan={rng.choice((1, 1, 1, 2, 3))} rowspan={rng.choice((1, 1, 1, 2, 5))}"
    rows = "".join("<tr>" + "".join(f"<td{span()}>c{r}-{c}" for c in range(rng.randint(0, 4))) for r in range(rng.randint(0, 6)))
    return f"before<table>{rows}</table>between<table><tr><th>h<td><table><tr><td>in</table></table><table></table>after"


@pytest.fixture(scope="module")
def documents():
    held = [soup(i) for i in range(250)] + [table(i) for i in range(60)]
    held += [None, "", "plain", "<table><tr><td>a</td></tr></table>", "<p>x<table><tr></tr></table>y", "<table>" + "<tr><td>cell" * 300 + "</table>", "<tr><td>loose</td></tr>", "<div>" * 500 + "deep"]
    return list(enumerate(held))


def test_blocks(spark, documents):
    docs = spark.createDataFrame(documents, "id long, html string").repartition(4)
    got: dict[int, list] = {i: [] for i, _ in documents}
    for r in markup.blocks(docs, "id").orderBy("id", "pos").collect():
        assert r.pos == len(got[r.id])
        got[r.id].append((r.kind, r.payload))
    for i, html in documents:
        assert got[i] == html_blocks.blocks(html), (i, html)


def test_wide_and_deep_tables_stay_small():
    rows = [[{"text": "x", "wide": 1000, "high": 9999}, {"text": "tail", "wide": 1, "high": 1}]] * 200
    found = markup.placed(rows)
    assert sum(map(len, found)) < 500_000 and sum(r.count("tail") for r in found) == 200


def test_unclosed_elements_are_not_walked_for_each_tag():
    import time

    began = time.perf_counter()
    rows = markup.events_of("<i>" * 30_000 + "</b>" * 30_000 + "<p>" * 30_000)
    assert time.perf_counter() - began < 5
    assert sum(r[0] == "open" for r in rows) == sum(r[0] == "close" for r in rows) == 60_000


SPECS = [sections.Spec("one", ("사업의 내용", "II."), ("개요", "item")), sections.Spec("two", ("재무",), ("요약",))]
HEADS = ("II. 사업의 내용", "III. 재무에 관한 사항", "Ⅱ．사업의  내용", "1. 사업의 개요", "2. 요약", "3. other", "no heading", "1. item", "")


def flat(seed: int) -> str:
    rng = random.Random(seed)
    part = lambda: rng.choice(
        (f"<p>{rng.choice(HEADS)}</p>", f"<h2>{rng.choice(HEADS)}<b>x</b></h2>", f"<p>text {rng.randrange(9)}", "<table><tr><td><p>1. item</p></td></tr></table>", "<p>in<table><tr><td>t</td></tr></table><img src=a>", "<div><p>deep</p>loose</div>", "<image>", "<h1></h1>")
    )
    return "<body>" + "".join(part() for _ in range(rng.choice((4, 15, 40)))) + "</body>"


def nested(seed: int) -> str:
    rng = random.Random(seed)
    title = lambda: f"<title>{rng.choice(HEADS)}</title>" if rng.random() < 0.8 else ""
    inner = lambda: f"<section-2>{title()} a <p class=x>{rng.choice(HEADS)}</p><title>again</title><div>d<title>deep</title></div>{rng.choice(('', 'tail', ' '))}</section-2>"
    return "<doc>" + "".join(f"<section-1>{title()}{''.join(inner() for _ in range(rng.randint(0, 3)))}</section-1>" for _ in range(rng.randint(0, 3))) + "</doc>"


def sections_brute(html):
    root, out = html_blocks.soup(html), {}
    for spec in SPECS:
        for strategy, find in (("structured", sections.structured), ("textual", sections.textual)):
            if (text := find(root, spec)) is not None:
                out[spec.id] = (strategy, text)
                break
    return out


def test_sections(spark):
    held = [flat(i) for i in range(120)] + [nested(i) for i in range(80)] + [nested(i) + flat(i) for i in range(40)] + [None, "", "<section-1><title>II. x</title><section-2><title>1. item</title></section-2></section-1><p>II. x</p><p>1. item</p><p>t</p>"]
    docs = spark.createDataFrame(list(enumerate(held)), "id long, html string").repartition(4)
    specs = spark.createDataFrame([(s.id, list(s.parents), list(s.titles)) for s in SPECS], "id string, parents array<string>, titles array<string>")
    got: dict[int, dict] = {i: {} for i in range(len(held))}
    for r in markup.sections(docs, "id", specs).collect():
        assert r.spec_id not in got[r.id]
        got[r.id][r.spec_id] = (r.strategy, r.html)
    for i, html in enumerate(held):
        assert got[i] == sections_brute(html), (i, html)
    assert sum(bool(v) for v in got.values()) > 40
    assert {s for v in got.values() for s, _ in v.values()} == {"structured", "textual"}


def test_documents_that_lack_keys_are_kept_apart(spark):
    docs = spark.createDataFrame([("a", "<p>x"), ("b", "<p>y")], "id string, html string").withColumn("pos", F.lit(1))
    assert {(r.id, r.payload) for r in markup.blocks(docs, "id").collect()} == {("a", "x"), ("b", "y")}


def test_a_document_is_parsed_once_and_shuffled_as_cells(spark):
    docs = spark.createDataFrame([(1, "a<table><tr><td>x<td> y |<tr></table>b")], "id long, html string")
    plan = markup.blocks(docs, "id")._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert plan.count("MapInArrow") + plan.count("MapInPandas") == 1
    assert markup.pieces_of("a<table><tr><td>x<td> y |<tr></table>b") == [(0, None, None, "a", None, None), (1, 1, 1, "x", 1, 1), (1, 1, 2, "y /", 1, 1), (1, 2, None, None, None, None), (1, None, None, "b", None, None)]


def test_structured_sections_are_looked_for_where_sections_are(spark, monkeypatch):
    seen = []
    whole = markup.structured
    monkeypatch.setattr(markup, "structured", lambda found, *a: seen.append({r.id for r in found.select("id").distinct().collect()}) or whole(found, *a))
    docs = spark.createDataFrame([(1, "<p>II. x<p>1. item<p>t"), (2, "<SECTION-1><title>II. x</title><SECTION-2><title>1. item</title>s</section-2></section-1>"), (3, None)], "id long, html string")
    specs = spark.createDataFrame([("one", ["x"], ["item"])], "id string, parents array<string>, titles array<string>")
    found = {r.id: (r.strategy, r.html) for r in markup.sections(docs, "id", specs).collect()}
    assert found == {1: ("textual", "<p>t</p>"), 2: ("structured", "s")}
    assert seen == [{2}]
