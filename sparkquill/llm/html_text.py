"""Main text of web pages by consensus host paths.

Each page is parsed into containers, and each container is scored by the text that it holds outside menus, adverts, links
and the like, less for text in inner containers, and by its tag and class. A page votes for the generalised path (tags and classes from the root,
digits and positions left out) of its best container; votes are summed per host in Spark, and every page of the host is
extracted again from all containers at the winning path, in page order. A page without that path uses the path of its
own best container. So does, besides the winning one, a page of another template: one whose own containers hold
``CLEAR_CHARS`` characters more or over, of which those at the winning path are less than ``CLEAR_SHARE``.

Some names tell what an element is (a menu, a reader comment). Others may as well be what an article is about: a section
named social, a div named form. Such an element goes only if it has controls, many links or no paragraph. In a header
within an article the headings are the article's own.

Votes pre-aggregate before the shuffle, so a host with a third of all pages costs no more than others. The table of
winners has a row per host: it is broadcast up to ``BROADCAST_HOSTS`` rows and joined by shuffle beyond. A path is kept as
its last step and its parent, so that deep markup costs what it holds.

Defined results: null and empty html have an empty text; very long pages are parsed whole, in a batch of their own; a null
url has an empty host, whose pages vote together; of paths with equal votes the first in order wins; what is dropped is
listed in ``DROP_TAGS``, ``DROP_NAMES``, ``COMMENT_NAMES`` and ``DOUBTFUL_NAMES`` and nothing else is; unclosed tags end where
their parent does; repeated pages get equal texts; an empty table gives an empty result; extra columns are kept, whatever
their names, but columns named as the outputs (``into``, and ``path``) are replaced by them.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkquill.llm import words
from sparkquill.llm.columns import fresh, own
from sparkquill.llm.urls import host_of
from sparkquill.shared import stored

BROADCAST_HOSTS = 200_000
#: A page's own containers are added to those that its host voted for if these hold less than this share of the text, ...
CLEAR_SHARE = 0.5
#: ... and so many characters less. Smaller differences are what the vote is for.
CLEAR_CHARS = 250

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: What is no text of an article, with all inside.
DROP_TAGS = frozenset(
    "head script style template noscript title iframe object svg canvas nav header footer aside form button select textarea input fieldset dialog menu noembed noframes".split()
)
#: The same for class, id and role, by their parts: class="side-bar ad" has the parts side, bar, sidebar and ad.
DROP_NAMES = frozenset(
    "nav navigation navbar menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside complementary contentinfo banner ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion notice notices cookie cookies consent gdpr alert popup modal dialog overlay newsletter subscribe subscription signup "
    "searchform toolbar pagination pager".split()
)
#: These drop an article element as well, as reader comments are often marked up so.
COMMENT_NAMES = frozenset("comment comments disqus respond replies reply".split())
#: Names that go by what the element holds.
DOUBTFUL_NAMES = frozenset("share sharing social related recommended form search widget".split())
#: A doubtful element is text if it holds a paragraph of its own, no controls, and a share of links of so much at most.
DOUBT_LINKS = 0.3
PARAGRAPHS = frozenset("p blockquote pre".split())
#: What text counts for the container around its own, so that the one next to most of the text scores best.
DECAY = 0.7
CONTROLS = frozenset("form input select textarea button".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: A class such as has-sidebar says something of the page, not of the element.
ABOUT = frozenset("has with no without layout enabled".split())
GOOD_NAMES = frozenset("article content post entry story main body text maincontent articlebody postcontent entrycontent articlecontent storybody".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend "
    "li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
CONTAINERS = frozenset("article main section div body td blockquote details figure".split())
#: An opening tag closes an open element of these kinds, up to the nearest of the bounding ones.
CLOSED_BY = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "body", "html", "legend"}
FORMATTING = frozenset("a b big code em font i small span strong tt u s strike sub sup cite q abbr mark time kbd samp var del ins bdi bdo label".split())

#: A comment, declaration or tag. A quote counts only behind an equals sign and where it is closed; what is open at the end of
#: the page ends there. So every alternative consumes what it has looked at, and a page is read once.
TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*+(?:>|\Z)|/(?=[^A-Za-z])[^>]*+(?:>|\Z)"
    r"|(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
NAMING = frozenset("class id role itemprop".split())
NAME_PART = re.compile(r"[A-Za-z]+")
SPACE = re.compile(r"\s+")


class Node:
    """A container: ``path`` is a number of ``Page.paths``."""

    __slots__ = ("path", "parent", "order", "text", "links", "bonus")

    def __init__(self, path: int, parent: Node | None, order: int, bonus: float):
        self.path, self.parent, self.order, self.bonus = path, parent, order, bonus
        self.text = self.links = 0


class Region:
    """A doubtful element, with what it holds."""

    __slots__ = ("parent", "text", "links", "controls", "prose", "gone")

    def __init__(self, parent: Region | None):
        self.parent, self.text, self.links, self.controls, self.prose, self.gone = parent, 0, 0, False, False, False


class Page:
    """Containers in order, blocks of text outside what is dropped with their innermost containers, and paths by number."""

    def __init__(self):
        self.containers: list[Node] = []
        self.blocks: list[tuple[Node, str]] = []
        self.paths: list[tuple[int, str]] = [(-1, "")]
        self.numbers: dict[tuple[int, str], int] = {}

    def number(self, parent: int, step: str) -> int:
        found = self.numbers.setdefault((parent, step), len(self.paths))
        if found == len(self.paths):
            self.paths.append((parent, step))
        return found

    def name(self, path: int) -> str:
        steps = []
        while path > 0:
            path, step = self.paths[path]
            steps.append(step)
        return "".join(f"/{x}" for x in reversed(steps))

    def find(self, name: str) -> int | None:
        """The number of a path by name, None if the page has no such path."""
        at: int | None = 0
        for step in name.split("/")[1:]:
            at = self.numbers.get((at, step))
            if at is None:
                return None
        return at


def names_of(value: str) -> tuple[set[str], list[str], set[str]]:
    """The parts of a class, id or role in lower case, joined neighbours included; its words without digits; the parts that
    say what the element is."""
    parts: set[str] = set()
    whole: list[str] = []
    tell: set[str] = set()
    for word in value.lower().split():
        own_parts = NAME_PART.findall(word)
        mine = {*own_parts, *(a + b for a, b in zip(own_parts, own_parts[1:], strict=False))}
        parts |= mine
        if mine.isdisjoint(ABOUT):
            tell |= mine
        if own_parts:
            whole.append("-".join(own_parts))
    return parts, whole, tell


KEPT, DROPPED, IN_HEADER = 0, 1, 2


def parse(html: str) -> Page:
    page = Page()
    root = Node(0, None, 0, 0.0)
    page.containers.append(root)
    found: list[tuple[Node, str, int, Region | None, bool]] = []
    # tag, innermost container, whether dropped, whether in a link, whether in an article, innermost doubtful element
    stack: list[tuple[str, Node, int, bool, bool, Region | None]] = []
    depths: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements of a tag
    block_depths: list[int] = []  # of the open block elements
    regions: list[Region] = []
    outside = (root, KEPT, False, False, None)
    node, dropped, linked, article, region = outside
    buffer: list[str] = []
    link_chars = 0
    at, n = 0, len(html)

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = SPACE.sub(" ", unescape("".join(buffer))).strip()
            buffer.clear()
            if text:
                found.append((node, text, min(link_chars, len(text)), region, any(depths[x] for x in PARAGRAPHS)))
        link_chars = 0

    def nearest(tags) -> int:
        """The depth of the innermost open element of some tags, -1 without one."""
        return max((depths[x][-1] for x in tags if depths[x]), default=-1)

    def close(depth: int) -> None:
        """Leave the elements of the stack from this depth on."""
        nonlocal node, dropped, linked, article, region
        if any(x[0] in BLOCKS or x[2] for x in stack[depth:]):
            flush()
        for x in reversed(stack[depth:]):
            depths[x[0]].pop()
            if x[0] in BLOCKS:
                block_depths.pop()
        del stack[depth:]
        node, dropped, linked, article, region = stack[-1][1:] if stack else outside

    while at < n:
        m = TAG.search(html, at)
        if not dropped:
            piece = html[at : m.start() if m else n]
            if piece:
                buffer.append(piece)
                if linked:
                    link_chars += len(piece)
        if not m:
            break
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            depth = nearest((tag,))
            if depth >= 0 and not (tag in FORMATTING and block_depths and block_depths[-1] > depth):
                close(depth)
            elif tag in BLOCKS and not dropped:
                flush()
            continue
        if tag in CONTROLS and region:
            region.controls = True
        if tag == "br" or tag in VOID:
            if not dropped:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    buffer.append(" ")
            continue
        if tag in CLOSES_P and depths["p"] and block_depths[-1] == depths["p"][-1]:
            close(depths["p"][-1])
        if tag in CLOSED_BY:
            ends, bounds = CLOSED_BY[tag]
            first = nearest(ends)
            if first > nearest(bounds):
                while first and stack[first - 1][0] in ends:
                    first -= 1
                close(first)
        if tag in ("html", "body") and depths[tag]:
            continue
        attributes = m[3]
        parts: set[str] = set()
        tell: set[str] = set()
        words_of: list[str] = []
        if attributes and ("=" in attributes):
            for a in ATTRIBUTE.finditer(attributes):
                if a[1].lower() not in NAMING:
                    continue
                own_parts, whole, mine = names_of(a[2] or a[3] or a[4] or "")
                parts |= own_parts
                tell |= mine
                if a[1].lower() == "class":
                    words_of = whole
        if not dropped and tag in BLOCKS:
            flush()
        drop = dropped
        if tag in HEADINGS and drop == IN_HEADER:
            drop = KEPT
        elif drop != DROPPED and tag not in ("html", "body"):
            named = tag not in ("article", "main") and not tell.isdisjoint(DROP_NAMES)
            if tag in DROP_TAGS or named or (tag != "main" and not tell.isdisjoint(COMMENT_NAMES)):
                headed = tag == "header" or (named and tell & DROP_NAMES == {"header"})
                drop = IN_HEADER if headed and article else DROPPED
        if drop and not dropped:
            flush()
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if not drop and tag not in ("html", "body", "article", "main") and not tell.isdisjoint(DOUBTFUL_NAMES):
            flush()
            region = Region(region)
            regions.append(region)
        own_node = node
        if tag in CONTAINERS and not drop:
            bonus = {"article": 0.5, "main": 0.4, "section": 0.05, "div": 0.02, "body": 0.0}.get(tag, 0.0)
            if "main" in parts or "articlebody" in parts:
                bonus = max(bonus, 0.4)
            elif not parts.isdisjoint(GOOD_NAMES):
                bonus = max(bonus, 0.3)
            own_node = Node(page.number(node.path, f"{tag}{''.join('.' + w for w in sorted(set(words_of)))}"), node, len(page.containers), bonus)
            page.containers.append(own_node)
        node, dropped, linked, article = own_node, drop, linked or tag == "a", article or tag in ("article", "main")
        depths[tag].append(len(stack))
        if tag in BLOCKS:
            block_depths.append(len(stack))
        stack.append((tag, node, dropped, linked, article, region))
    flush()
    for _, text, links, inner, prose in found:
        if inner:
            inner.text += len(text)
            inner.links += links
            inner.prose |= prose
    for r in reversed(regions):
        if r.parent:
            r.parent.text += r.text
            r.parent.links += r.links
            r.parent.prose |= r.prose
    for r in regions:
        r.gone = bool(r.parent and r.parent.gone) or r.controls or not r.prose or r.links > DOUBT_LINKS * r.text
    for block_node, text, links, inner, _ in found:
        if not (inner and inner.gone):
            page.blocks.append((block_node, text))
            block_node.text += len(text)
            block_node.links += links
    return page


def scores(containers: list[Node]) -> list[float]:
    """Text inside without links, that of inner containers at ``DECAY`` a level, times 1 and a bonus for what a tag or class says."""
    inside = [float(c.text - c.links) for c in containers]
    for c in reversed(containers[1:]):
        inside[c.parent.order] += DECAY * inside[c.order]
    return [t * (1 + c.bonus) for c, t in zip(containers, inside, strict=True)]


def best(containers: list[Node], found: list[float] | None = None) -> tuple[Node, float]:
    """The container of the highest score, of equals the outermost."""
    found = scores(containers) if found is None else found
    k = max(range(len(found)), key=lambda i: (found[i], -i))
    return containers[k], found[k]


def within(containers: list[Node], path: int) -> list[bool]:
    """For each container, whether it is at ``path`` or inside of one that is."""
    inside: list[bool] = []
    for c in containers:
        inside.append(c.path == path or (c.parent is not None and inside[c.parent.order]))
    return inside


def extract(html: str | None, path: str | None = None) -> tuple[str, str]:
    """The text and the path that it is from: all containers at ``path``, or else at the path of the page's best one.

    Where the page's own hold clearly more than those at ``path``, the text is of both, and the path is the page's own."""
    if not html:
        return "", ""
    page = parse(html)
    containers, blocks = page.containers, page.blocks
    scored = scores(containers)
    chosen = best(containers, scored)[0].path
    inside = within(containers, chosen)
    voted = None if path is None else page.find(path)
    if voted is not None and voted != chosen and any(scored[c.order] > 0 for c in containers if c.path == voted):
        there = within(containers, voted)
        more = sum(len(t) for c, t in blocks if inside[c.order])
        less = sum(len(t) for c, t in blocks if there[c.order])
        if less < more * CLEAR_SHARE and more - less >= CLEAR_CHARS:
            inside = [a or b for a, b in zip(inside, there, strict=True)]
        else:
            chosen, inside = voted, there
    return "\n".join(t for c, t in blocks if inside[c.order]), page.name(chosen)


def vote(html: str | None) -> tuple[str | None, int]:
    """The path of a page's best container, with its score, of which 1000 count at most, so that long pages don't outvote the rest."""
    if not html:
        return None, 0
    page = parse(html)
    node, score = best(page.containers)
    return page.name(node.path), min(1000, int(score))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes): the sum of what the pages of a host give a path."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "html"):
            found = [vote(html) for html in block.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("host"), pa.array([p for p, _ in found], pa.string()), pa.array([v for _, v in found], pa.int64())], names=["host", "path", "vote"])

    cast = pages.select("host", "html").mapInArrow(each, "host string, path string, vote long")
    return cast.filter("vote > 0").groupBy("host", "path").agg(F.sum("vote").alias("votes"))


def winners(pages: DataFrame) -> DataFrame:
    """(host, path) by the most votes, of equals the path first in order."""
    return votes(pages).groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), F.col("path"))).alias("path"))


def texts(pages: DataFrame, into: str = "text") -> DataFrame:
    """``pages`` (url, html, ...) with the main text, and the ``path`` that it was taken from."""
    pages = pages.drop(into, "path")
    host, voted = fresh(pages, "host", "voted")
    named = pages.withColumn(host, host_of(F.col("url")))
    chosen = stored(winners(named.select(F.col(host).alias("host"), "html")), "hosts").withColumnsRenamed({"host": host, "path": voted})
    few = chosen.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    ready = named.join(F.broadcast(chosen) if few else chosen, host, "left").select(*own(pages), voted)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "html"):
            found = [extract(h, p) for h, p in zip(block.column("html").to_pylist(), block.column(voted).to_pylist(), strict=True)]
            names = [c for c in block.schema.names if c != voted]
            yield pa.RecordBatch.from_arrays([*map(block.column, names), pa.array([t for t, _ in found], pa.string()), pa.array([p for _, p in found], pa.string())], names=[*names, into, "path"])

    return ready.mapInArrow(each, T.StructType([*pages.schema.fields, T.StructField(into, T.StringType()), T.StructField("path", T.StringType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = texts(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
