"""Personal data by patterns, and by contexts that are bootstrapped from what the patterns find.

Seeds are the spans of four fixed patterns. Every identifier-like token (letters, digits and joining marks with at least
one digit, ``LEAST`` characters or more) is a candidate. Each mention has a lexical pattern of its own context, the two
words before it, and general ones: the word before, the word after, both, and the word before with the mention's shape.
Mentions give a bipartite graph of patterns and instances (identifiers), aggregated in Spark and judged in rounds: a
pattern is as good as the share of its distinct instances that are good, seeds and the instances of trusted patterns. A
pattern is trusted with a share of ``TRUST`` and ``SUPPORT`` good instances. A general one needs more: the lower bound of
its share (at ``Z`` standard errors) must reach ``TRUST`` and the share of seeds among all instances, so that frequent
words that stand before anything are not trusted. What one round discovers supports further patterns in the next, until
no pattern is added. (Scores that are means of scores only rise, and end at these same shares: where they stand still,
the instances of trusted patterns have the score of the seeds.) Candidates of patterns that are trusted at last become
spans of kind ``context``.

Texts are matched in one scan, which shuffles only contexts and spans, keyed by document and a hash of its text; a context
that a third of all texts share is counted by partial aggregation and joined under skew handling. The spans are joined to
the documents at the end, with the columns that the caller goes on to use.

Defined results: a null text counts as empty; very long texts are matched whole, in a batch of their own; rows that repeat
a doc_id and its text get equal spans; spans count code points, end exclusive; an added span never overlaps one of a fixed
pattern; an empty table gives an empty result; extra columns are kept, whatever their names, but a column named as the
output (``into``) is replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkquill.llm import words
from sparkquill.llm.columns import fresh, own
from sparkquill.shared import stored

KINDS = ("email", "ip", "card", "phone")
LEAST = 5
SUPPORT, TRUST, Z, ROUNDS = 3, 0.6, 2.6, 100

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match may as well begin at the start of a run of digits, as any later start in it succeeds only if that one does.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
CANDIDATE = re.compile(r"[^\W_](?:[\w.:/@-]*[^\W_])?")
WORD = re.compile(r"\w+")
SHAPES = re.compile(r"[0-9]+|[A-Z]+|[^\W\d_A-Z]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each "@" so that long words cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """By kind as listed, then start."""
    found = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        if "." in text:
            found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def context(text: str, start: int) -> str | None:
    """The two words before a position, in lower case; None at the start of a text."""
    size = 80
    # the first word of a piece may be cut, the two last of three are whole
    while len(before := WORD.findall(text[max(0, start - size) : start])) < 3 and size < start:
        size *= 2
    return " ".join(before[-2:]).lower() or None


def shape(token: str) -> str:
    """Runs of capitals, small letters and digits as A, a and 9 with their length; marks as they are."""
    return SHAPES.sub(lambda m: f"{'9' if m[0][0].isdigit() else 'A' if m[0][0].isupper() else 'a'}{len(m[0])}", token)


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a mention. General ones hold <>, which no word does, and come after its own."""
    before = context(text, start)
    size = 40
    # the first word of a piece is whole if the piece goes on behind it
    while not ((m := WORD.search(text, end, end + size)) and m.end() < end + size) and end + size < len(text):
        size *= 2
    after = m[0].lower() if m else None
    own = [before] if before else []
    if before:
        last = before.rpartition(" ")[2]
        own += [f"{last} <>", f"{last} <{shape(text[start:end])}>"]
        own += [f"{last} <> {after}"] if after else []
    return own + ([f"<> {after}"] if after else [])


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like tokens that no base span overlaps."""
    taken = sorted((a, b) for _, a, b in base)
    out, k = [], 0
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if b - a < LEAST or not DIGIT.search(text, a, b):
            continue
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k == len(taken) or taken[k][0] >= b:
            out.append((a, b))
    return out


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
SEEN = T.StructType([*SPAN.fields, T.StructField("patterns", T.ArrayType(T.StringType())), T.StructField("instance", T.StringType())])
ARROW_SEEN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("patterns", pa.list_(pa.string())), ("instance", pa.string())]))


def mentions(rows: DataFrame) -> DataFrame:
    """(key, t, seen) of rows (key, text, t): base spans, and candidates with kind null, each with its patterns and its own text in lower case."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text"):
            out = []
            for x in block.column("text").to_pylist():
                x = x or ""
                base = base_spans(x) if "@" in x or DIGIT.search(x) else []
                spans = base + ([(None, a, b) for a, b in candidates(x, base)] if DIGIT.search(x) else [])
                out.append([{"kind": k, "start": a, "end": b, "patterns": patterns(x, a, b), "instance": x[a:b].lower()} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays([block.column("key"), block.column("t"), pa.array(out, ARROW_SEEN)], names=["key", "t", "seen"])

    return rows.mapInArrow(each, T.StructType([rows.schema["key"], T.StructField("t", T.LongType()), T.StructField("seen", T.ArrayType(SEEN))]))


def trusted(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The patterns of a graph (pattern, instance, seed) that are trusted when a round adds none."""
    base = graph.groupBy("instance").agg(F.bool_or("seed").cast("int").alias("seed")).agg(F.avg("seed")).first()[0] or 0.0
    n = F.col("n")

    def enough(support: Column) -> Column:
        share = support / n
        lower = (share + Z * Z / (2 * n) - Z * F.sqrt(share * (1 - share) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)
        return F.when(F.col("pattern").contains("<"), lower >= max(TRUST, base)).otherwise((support >= SUPPORT) & (share >= TRUST))

    # most patterns have too few instances for trust, even if all were good, and take no part in the rounds
    able = graph.groupBy("pattern").agg(F.count("*").alias("n")).filter(enough(n))
    graph = stored(graph.join(able, "pattern"), "able")
    patterns, known = None, 0
    for _ in range(rounds):
        good = graph.withColumn("good", F.col("seed"))
        if patterns is not None:
            held = graph.join(patterns, "pattern", "left_semi").select("instance").distinct().withColumn("held", F.lit(True))
            good = graph.join(held, "instance", "left").withColumn("good", F.col("seed") | F.coalesce("held", F.lit(False)))
        patterns = stored(good.groupBy("pattern", "n").agg(F.count_if("good").alias("support")).filter(enough(F.col("support"))).select("pattern"), "patterns")
        if (found := patterns.count()) == known:  # patterns stay trusted, so as many are the same ones
            return patterns
        known = found
    raise RuntimeError(f"no fixed point after {rounds} rounds")


def find(docs: DataFrame, text: str = "text", key: str = "doc_id", into: str = "pii") -> DataFrame:
    """``docs`` with the array ``into`` of (kind, start, end), by kind as listed, context last, then start."""
    docs = docs.drop(into)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("t"))
    seen = stored(mentions(rows).filter(F.size("seen") > 0), "mentions")
    each = seen.select("key", "t", F.explode("seen").alias("s")).select("key", "t", "s.*")
    own_patterns = each.select(F.explode("patterns").alias("pattern"), "instance", "kind")
    graph = own_patterns.groupBy("pattern", "instance").agg(F.bool_or(F.col("kind").isNotNull()).alias("seed"))
    good = trusted(graph)
    hits = each.filter("kind is null").select("key", "t", "start", "end", F.explode("patterns").alias("pattern")).join(good, "pattern", "left_semi")
    added = hits.select("key", "t", F.struct(F.lit("context").alias("kind"), "start", "end").alias("s"))
    base = each.filter("kind is not null").select("key", "t", F.struct("kind", "start", "end").alias("s"))
    order = F.create_map(*[F.lit(x) for i, k in enumerate((*KINDS, "context")) for x in (k, i)])
    spans = base.unionByName(added).withColumn("s", F.struct(order[F.col("s.kind")].alias("o"), F.col("s.start").alias("start"), F.col("s.kind").alias("kind"), F.col("s.end").alias("end")))
    spans = spans.groupBy("key", "t").agg(F.array_sort(F.collect_set("s")).alias("s"))
    spans = spans.select("key", "t", F.transform("s", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("s"))
    k, t, s, hashed = fresh(docs, "k", "t", "s", "hashed")
    spans = stored(spans.toDF(k, t, s), "spans")
    # the hash is a column of its own, so that a text which the caller does not use is not shuffled for it
    joined = docs.withColumn(hashed, F.xxhash64(F.coalesce(text, F.lit("")))).join(spans, F.col(key).eqNullSafe(F.col(k)) & (F.col(hashed) == F.col(t)), "left")
    return joined.select(*own(docs), F.coalesce(s, F.array().cast(T.ArrayType(SPAN))).alias(into))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    spans = F.col("pii")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in KINDS], F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(*KINDS))), 256).alias("base_sha256"), joined(spans).alias("spans")
    )
