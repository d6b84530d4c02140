"""Choosing evidence for a question, looking evidence up, and verifying drafted questions against it."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from sparkquill.functions import scalars as S

REQUIRED = ("question", "gold_answer", "gold_answer_unit", "evidence_chunks", "evidence_quotes", "reasoning_steps", "reasoning_hops")
PAYLOAD = (
    "question string, gold_answer string, gold_answer_unit string, evidence_chunks array<string>, evidence_quotes array<string>, "
    "reasoning_steps array<string>, reasoning_hops string, generation_notes string"
)
#: Characters of quotes that one pass looks for, at most.
MOST_QUOTE_CHARS = 2_000_000


def first_seen(hits: DataFrame, group: str) -> DataFrame:
    """Of the hits of several seeds (group, seed, rank, chunk_id, ...) the first of each chunk, by seed and then rank."""
    rank = F.row_number().over(Window.partitionBy(group, "chunk_id").orderBy("seed", "rank"))
    return hits.withColumn("_r", rank).filter("_r = 1").drop("_r")


def ranked(hits: DataFrame, group: str, least: int, most: int) -> DataFrame:
    """The best ``most`` chunks of a group, those with tables first, then by distance and order; groups of under ``least`` go."""
    order = Window.partitionBy(group).orderBy(F.col("has_table").desc(), F.coalesce("distance", F.lit(0.0)), "ord")
    found = hits.withColumns({"rank": F.row_number().over(order), "_n": F.count("*").over(Window.partitionBy(group))})
    return found.filter((F.col("_n") >= least) & (F.col("rank") <= most)).drop("_n")


def looked_up(items: DataFrame, chunks: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """(id, texts) in the order of evidence_chunks; chunks that are found nowhere are left out, items never are.

    chunks and fallback: (chunk_id, text), one row for each id."""
    parts = items.select("id", F.posexplode_outer("evidence_chunks").alias("pos", "chunk_id"))
    found = parts.join(chunks.select("chunk_id", F.col("text").alias("_a")), "chunk_id", "left")
    text = F.col("_a")
    if fallback is not None:
        found = found.join(fallback.select("chunk_id", F.nullif("text", F.lit("")).alias("_b")), "chunk_id", "left")
        text = F.coalesce("_a", "_b")
    pairs = F.collect_list(F.when(text.isNotNull(), F.struct("pos", text.alias("text"))))
    return found.groupBy("id").agg(F.transform(F.array_sort(pairs), lambda x: x["text"]).alias("texts"))


def joined(df: DataFrame, keys: list[str], order: str, text: str, mark: str = "\n\n", into: str = "evidence") -> DataFrame:
    """One text of a group's rows in order."""
    return df.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), mark).alias(into))


def block(chunks: Column) -> Column:
    """The evidence part of a prompt, of an array of (chunk_id, text, section, has_table): each text under a line that names it."""
    yes = lambda c: F.when(c["has_table"].isNull(), "None").when(c["has_table"], "True").otherwise("False")
    head = lambda c: F.concat(F.lit("--- chunk_id="), c["chunk_id"], F.lit(" | section="), F.coalesce(c["section"], F.lit("None")), F.lit(" | has_table="), yes(c), F.lit(" ---"))
    return F.array_join(F.transform(chunks, lambda c: F.concat(head(c), F.lit("\n"), c["text"], F.lit("\n"))), "\n")


def prompt(template: str, **fields: Column) -> Column:
    """A template with each {name} replaced; texts that are put in are not searched for names again."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.lit(p) if i % 2 == 0 else F.coalesce(fields[p].cast("string"), F.lit("")) for i, p in enumerate(parts)])


def outermost_json(text: str | None) -> str | None:
    """The first balanced object of a reply, code fences aside; null if it is no JSON."""
    if not text:
        return None
    start, depth = -1, 0
    for m in re.finditer(r"[{}]", text):
        if m[0] == "{":
            start, depth = (m.start() if not depth else start), depth + 1
        elif depth:
            depth -= 1
            if not depth:
                part = text[start : m.end()]
                try:
                    json.loads(part)
                except ValueError:
                    return None
                return part
    return None


def extract_json(text: Column) -> Column:
    def each(texts: pd.Series) -> pd.Series:
        return texts.map(outermost_json)

    return F.pandas_udf(each, "string")(text)


def payload(text: Column) -> Column:
    """The fields of a drafted question, of the JSON text of one object; null if it is none."""
    return F.from_json(text, PAYLOAD)


def verified(text: Column, evidence: Column) -> Column:
    """The first rule that a drafted question breaks, or ok.

    text: JSON of one object as ``extract_json`` gives it; evidence: map of the chunk texts that were shown, by id."""
    fields, variant = payload(text), F.try_parse_json(text)
    kind = lambda name: F.coalesce(F.schema_of_variant(F.try_variant_get(variant, f"$.{name}", "variant")), F.lit("VOID"))
    known = F.transform(fields["evidence_chunks"], lambda i: F.try_element_at(evidence, i))
    shown = S.collapse(F.array_join(known, " \n"))
    quotes = F.try_variant_get(variant, "$.evidence_quotes", "array<variant>")
    hops = F.floor(F.abs(fields["reasoning_hops"].try_cast("double"))) * F.signum(fields["reasoning_hops"].try_cast("double"))
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    return (
        F.when(F.coalesce(F.size(F.array_except(F.array(*map(F.lit, REQUIRED)), F.json_object_keys(text))), F.lit(1)) > 0, "missing_fields")
        .when(none(fields["reasoning_steps"]), "no_steps")
        .when(hops.isNull(), "hops_not_a_number")
        .when(hops != F.size(fields["reasoning_steps"]), "hops_differ_from_steps")
        .when(none(fields["evidence_quotes"]), "no_quotes")
        .when(F.exists(known, lambda t: t.isNull()), "unknown_evidence")
        .when(F.exists(quotes, lambda q: F.schema_of_variant(q) != "STRING") | F.exists(fields["evidence_quotes"], lambda q: S.collapse(q) == ""), "blank_quote")
        .when(F.exists(fields["evidence_quotes"], lambda q: ~F.contains(shown, S.collapse(q))), "quote_not_in_evidence")
        .when(kind("gold_answer").rlike("^(VOID|ARRAY|OBJECT)"), "gold_not_a_single_value")
        .otherwise("ok")
    )


def quotes_found(quotes: DataFrame, docs: DataFrame, most: int = MOST_QUOTE_CHARS) -> DataFrame:
    """(item_id, doc_id) where the normalised quote is part of the normalised text; blank quotes are part of none.

    The quotes are a stated set, which each task holds as one automaton: a text is read once, whatever the number of
    quotes, and nothing but the pairs found leaves the scan. Quotes of more than ``most`` characters go in passes of so many."""
    asked = quotes.select("item_id", S.collapse(F.lower("text")).alias("quote")).filter("quote != ''")
    bodies = docs.select("doc_id", S.collapse(F.lower("text")).alias("body")).filter("body is not null")
    spark, key, doc = docs.sparkSession, quotes.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    schema = StructType([StructField("item_id", key), StructField("doc_id", doc)])

    def scan(held: list[tuple]) -> DataFrame:
        shared = spark.sparkContext.broadcast(held)

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            find = ahocorasick.Automaton()
            of: dict[str, list[int]] = {}
            for i, (_, quote) in enumerate(own):
                of.setdefault(quote, []).append(i)
            for quote, items in of.items():
                find.add_word(quote, items)
            find.make_automaton()
            ids = pa.array([i for i, _ in own], to_arrow_type(key))
            for batch in batches:
                rows, items = [], []
                for row, body in enumerate(batch.column("body").to_pylist()):
                    found = {i for _, mine in find.iter(body) for i in mine}
                    rows += [row] * len(found)
                    items += sorted(found)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(items, pa.int64())), batch.column("doc_id").take(pa.array(rows, pa.int64()))], names=["item_id", "doc_id"])

        return bodies.mapInArrow(each, schema)

    out = spark.createDataFrame([], schema)
    held: list[tuple] = []
    chars = 0
    for row in asked.toLocalIterator():
        if held and chars + len(row.quote) > most:
            out, held, chars = out.unionByName(scan(held)), [], 0
        held.append((row.item_id, row.quote))
        chars += len(row.quote)
    return out.unionByName(scan(held)) if held else out
