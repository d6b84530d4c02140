"""The HTML tokenizer on broken markup, and main texts against an extractor that shares no code with the operator."""

from __future__ import annotations

import re
import time
from html.parser import HTMLParser
from pathlib import Path

import pytest

from sparkquill.llm import html_text

DATA = Path("/root/testdata")


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p data-x=it's>Hello world ...</p><p>It's a second paragraph > with more text.</p>", "Hello world ...\nIt's a second paragraph > with more text."),
        ('<p title="abc>Hello world', "Hello world"),
        ("<p>a<!-- c --!>b</p>", "ab"),
        ("<p>a<!-->b</p><p>c<!--->d</p><!-- open", "ab\ncd"),
        ("<p title = 'a>b' class=x>y</p>", "y"),
        ("<p title='it\"s' alt=\"it's\">y</p>", "y"),
        ("a </> b </ x> c", "a b c"),
        ("<i alt=\">q\">z</i> 1 < 2 > 0", "z 1 < 2 > 0"),
        ("<p data-id=nav data-class='ad'>kept</p><p id=nav>menu</p>", "kept"),
        ("<p title='class=ad'>kept</p>", "kept"),
        ("<p>whole</p><a href='http://cut.off/in/the", "whole"),
    ],
)
def test_broken_markup(html, text):
    assert html_text.extract(html)[0] == text


@pytest.mark.parametrize("piece", ["<a ", '<a b="', "<a b='>", "<!-- ", "< ", "<", "</", "&", "<script>", "<p><b>", "<![CDATA[", "<a b=c", "x=\"'"])
def test_a_megabyte_of_broken_markup_is_read_once(piece):
    began = time.perf_counter()
    html_text.extract(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - began < 4


@pytest.mark.parametrize("html", ["<li><ul>" + "<div>" * 15_000 + "<li></li>" * 15_000, "<p>" + "<span>" * 20_000 + "x</i>" * 20_000, "<table><td>" + "<div>" * 15_000 + "<table><tr></table>" * 15_000])
def test_deep_markup_is_not_walked_for_each_tag(html):
    began = time.perf_counter()
    html_text.extract(html)
    assert time.perf_counter() - began < 4


@pytest.mark.parametrize("words", ["Short.", "a sentence that is long enough " * 20])
@pytest.mark.parametrize(("box", "kept"), [("<section class=social><p>%s</p></section>", True), ("<div class=form><p>%s</p><input></div>", False), ("<div class=share>%s</div>", False), ("<div class=related><p><a href=x>%s</a></p></div>", False)])
def test_doubtful_names_go_by_what_they_hold_and_not_by_length(words, box, kept):
    body = "The body of the article goes on and on. " * 9
    got = html_text.extract(f"<body><article><p>{body}</p>{box % words}</article></body>")[0]
    assert got == "\n".join([body.strip(), words.strip()] if kept else [body.strip()])


class Article(HTMLParser):
    """The text within <article>, a block for each heading, paragraph or item, as the generated pages are made."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.skipped, self.blocks, self.open = 0, 0, [], []

    def flush(self):
        text = re.sub(r"\s+", " ", "".join(self.open)).strip()
        self.open = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag in ("nav", "footer", "aside", "form", "script", "style") or dict(attrs).get("class") == "ad":
            self.skipped += 1
        elif tag == "article":
            self.inside += 1
        if tag in ("p", "h1", "h2", "h3", "ul", "li", "article", "div"):
            self.flush()
        if tag == "br":
            self.open.append(" ")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "h3", "ul", "li", "article", "div"):
            self.flush()
        if tag in ("nav", "footer", "aside", "form", "script", "style") or (tag == "div" and self.skipped):
            self.skipped -= 1
        elif tag == "article":
            self.inside -= 1

    def handle_data(self, data):
        if self.inside and not self.skipped:
            self.open.append(data)


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_every_page_of_the_tables(spark, table):
    pages = spark.read.parquet(f"{DATA}/{table}/pages.parquet")
    html = {r.page_id: r.html for r in pages.select("page_id", "html").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.query(spark, f"{DATA}/{table}").collect()}
    assert got.keys() == html.keys()
    for page, source in html.items():
        parser = Article()
        parser.feed(source or "")
        parser.close()
        parser.flush()
        want = "\n".join(parser.blocks)
        assert got[page] == (want, len(want)), page
