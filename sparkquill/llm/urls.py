"""URL filters with redirect equivalence.

Rules decide the urls they fit. For the others, redirect and canonical links make urls equivalent: components of the
link graph are computed in Spark, and a block of one url is passed on to all its aliases. An explicit allow takes
precedence: a url with a rule of its own keeps that verdict, and a component that holds an allowed url blocks none of
its aliases.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed; null html
has no links; repeated pages and urls get the same verdict; an empty table gives an empty result; extra columns do not
matter, since only the named ones are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkquill.llm.components import components
from sparkquill.shared import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many rules are one expression; longer tables are joined on the host's suffixes.
INLINE_RULES = 256


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    rule: str  # host, then path from its first slash

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return self.rule[len(self.host) :]


RULES = (
    Rule("block", "com/en/"),
    Rule("allow", "example.com/en/7"),
    Rule("allow", "net/de/"),
    Rule("block", "example.net/de/8"),
    Rule("block", "org/es/"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """The url as a node of the link graph: scheme and host in lower case, no fragment, "/" for an empty path; null without ``://``."""
    scheme = F.translate(F.regexp_extract(url, r"(?s)^\s*(.*?)://", 1), UPPER, LOWER)
    path = path_of(url)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(scheme, F.lit("://"), host_of(url), F.when(path == "", F.lit("/")).otherwise(path), query))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def _order(rule: Rule) -> tuple:
    return (-len(rule.rule), -len(rule.host), rule.verdict != "allow", rule.rule)


def with_rule(pages: DataFrame, rules: tuple[Rule, ...] = RULES, inline: int = INLINE_RULES) -> DataFrame:
    """``pages`` (host, path) with ``rule`` and ``rule_verdict`` of the longest fitting rule, or nulls. Of rules of one
    length the one with the longer host wins, then allow."""
    best = sorted({r.rule: r for r in sorted(rules, key=_order, reverse=True)}.values(), key=_order)
    if len(best) <= inline:
        host, path = F.col("host"), F.col("path")
        found = F.coalesce(*[F.when(_fits(r, host, path), F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in best], F.lit(None))
        return pages.withColumn("_r", found).withColumns({"rule": F.col("_r.rule"), "rule_verdict": F.col("_r.verdict")}).drop("_r")
    spark = pages.sparkSession
    table = spark.createDataFrame([(r.host, r.path, r.rule, r.verdict, i) for i, r in enumerate(best)], "s string, p string, rule string, rule_verdict string, i int")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    urls = pages.select("host", "path").distinct()
    hits = urls.select("host", "path", F.explode(suffixes).alias("s")).join(table, "s").filter(F.col("path").startswith(F.col("p")))
    top = hits.groupBy("host", "path").agg(F.min_by(F.struct("rule", "rule_verdict"), "i").alias("_r"))
    return pages.join(top, ["host", "path"], "left").withColumns({"rule": F.col("_r.rule"), "rule_verdict": F.col("_r.rule_verdict")}).drop("_r")


def links(pages: DataFrame) -> DataFrame:
    """(a, b): the url of a page and what its canonical link or its refresh redirect points to, both as nodes."""
    # what is not closed goes to the end of the page, so a page is read once
    html = F.regexp_replace("html", r"(?s)<!--.*?(?:--!?>|\z)|(?i)<script\b.*?(?:</script\s*>|\z)", " ")
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    likely = pages.filter("url is not null and html is not null").filter(F.col("html").rlike(r"(?i)canonical|http-equiv"))
    value = lambda name: rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    bare = lambda tag, name: F.trim(F.regexp_replace(F.regexp_extract(tag, value(name), 1), r"""^["']|["']$""", ""))

    def target(tag: Column) -> Column:
        canonical = tag.rlike("(?i)^<link") & F.lower(bare(tag, "rel")).rlike(r"(^|\s)canonical($|\s)")
        refresh = tag.rlike("(?i)^<meta") & (F.lower(bare(tag, "http-equiv")) == "refresh")
        to = F.regexp_extract(bare(tag, "content"), r"""(?is)^\s*[\d.]*\s*[;,]\s*url\s*=\s*["']?([^"']*)""", 1)
        return F.replace(F.when(canonical, bare(tag, "href")).when(refresh, F.trim(to)).otherwise(""), F.lit("&amp;"), F.lit("&"))

    # each explode also ends an expression, which keeps the generated code small
    found = likely.select("url", F.explode(F.filter(F.transform(tags, target), lambda x: x != "")).alias("to"))
    path = path_of(F.col("url"))
    parts = F.struct(
        F.regexp_extract("url", r"(?s)^(.*?)://", 1).alias("scheme"),
        F.regexp_extract("url", r"(?s)^.*?://[^/?#]*", 0).alias("site"),
        F.when(path == "", F.lit("/")).otherwise(path).alias("path"),
    )
    found = found.select("url", "to", F.explode(F.array(parts)).alias("p"))
    full = (
        F.when(F.col("to").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat("p.scheme", F.lit(":"), "to"))
        .when(F.col("to").startswith("/"), F.concat("p.site", "to"))
        .when(F.col("to").rlike(r"^[?#]"), F.concat("p.site", "p.path", "to"))
        .otherwise(F.concat("p.site", F.regexp_extract("p.path", r"(?s)^.*/", 0), "to"))
    )
    found = found.select("url", F.explode(F.array(full)).alias("full"))
    return found.select(node_of(F.col("url")).alias("a"), node_of(F.col("full")).alias("b")).filter("a is not null and b is not null and a != b")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of each row of ``pages`` (page_id, url, html). ``redirects``: further (a, b)
    pairs of urls, such as the 3xx answers of a crawl."""
    edges = links(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")))
    edges = stored(edges.distinct(), "links")
    base = with_rule(pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}), rules)
    if edges.isEmpty():
        blocked = F.lit(False)
    else:
        members = stored(components(edges.select("a", "b"), "aliases"), "members")
        nodes = members.select("node", "component").unionByName(members.select(F.col("component").alias("node"), "component")).distinct()
        own = with_rule(nodes.withColumns({"host": host_of(F.col("node")), "path": path_of(F.col("node"))}), rules)
        votes = own.groupBy("component").agg(F.bool_or(F.col("rule_verdict") == "block").alias("block"), F.bool_or(F.col("rule_verdict") == "allow").alias("allow"))
        guilty = nodes.join(votes.filter("block and not coalesce(allow, false)").select("component"), "component").select(F.col("node").alias("_node"), F.lit(True).alias("_blocked"))
        base = base.withColumn("_node", node_of(F.col("url"))).join(guilty, "_node", "left")
        blocked = F.coalesce("_blocked", F.lit(False))
    verdict = F.coalesce("rule_verdict", F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    return base.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
