"""Curated datasets: accepted items, matched subsets, conversion to one table and its prose, validation, statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkquill.functions import scalars as S
from sparkquill.functions import tables
from sparkquill.operators.evidence import looked_up


def accepted(items: DataFrame, calibration: DataFrame) -> DataFrame:
    """Items whose class is accepted, with what the calibration says; calibration: (item_id, classification, attempts, retrieved_chunk_ids)."""
    info = F.struct(
        "classification",
        F.size(F.filter("attempts", lambda a: a["correct"])).alias("n_correct"),
        F.size("attempts").alias("n_attempts"),
        "retrieved_chunk_ids",
    )
    good = calibration.filter(F.col("classification") == "accepted").select(F.col("item_id").alias("id"), info.alias("calibration"))
    return items.join(good, "id")


def matched(items: DataFrame, most_hops: int = 2, hops: str = "reasoning_hops") -> DataFrame:
    """Items of a known number of steps up to a bound, with their difficulty group."""
    kept = items.filter(F.col(hops).isNotNull() & (F.col(hops) <= most_hops))
    return kept.withColumns({"difficulty_group": S.difficulty_group(F.col(hops)), "finqa_matched": F.lit(True)})


def converted(items: DataFrame, chunks: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Items as (id, pre_text, post_text, table, filename, qa, meta). The executable answer is a number or else a text."""
    texts = looked_up(items, chunks, fallback)
    parts = tables.assemble(F.flatten(F.transform("texts", tables.blocks)))
    found = items.join(texts, "id").withColumn("_p", parts)
    answer = F.coalesce(F.col("gold_answer").cast("string"), F.lit(""))
    number = S.parse_number(F.col("gold_answer").cast("string"))
    meta = [c for c in ("task_type", "reasoning_hops", "source_company", "source_report", "source_section", "gold_answer_unit", "evidence_chunks", "difficulty_group", "finqa_matched") if c in items.columns]
    qa = F.struct(
        "question",
        answer.alias("answer"),
        number.alias("exe_ans_num"),
        F.when(number.isNull(), F.col("gold_answer").cast("string")).alias("exe_ans_text"),
        F.lit("").alias("program"),
        F.array_join("reasoning_steps", "\n").alias("explanation"),
        tables.gold_inds(F.col("evidence_quotes"), F.col("_p.table"), F.col("_p.pre_text"), F.col("_p.post_text")).alias("gold_inds"),
    )
    name = F.coalesce(F.nullif("source_report", F.lit("")), F.nullif("source_company", F.lit("")), "id")
    return found.select("id", "_p.pre_text", "_p.post_text", "_p.table", name.alias("filename"), qa.alias("qa"), F.struct(*meta).alias("meta"))


def validated(converted: DataFrame) -> DataFrame:
    """One row: items, those with a table, tables of uneven rows, missing answers."""
    uneven = F.size(F.array_distinct(F.transform("table", lambda r: F.size(r)))) > 1
    missing = F.col("qa.exe_ans_num").isNull() & F.coalesce(F.col("qa.exe_ans_text") == "", F.lit(True))
    return converted.agg(
        F.count("*").alias("n"), F.count_if(F.size("table") > 0).alias("with_table"), F.count_if(uneven).alias("non_rectangular_tables"), F.count_if(missing).alias("missing_exe_ans")
    )


def issues(converted: DataFrame) -> DataFrame:
    """(id, issue) of items that lack something a reader needs."""
    checks = {"no question": F.coalesce(F.trim("qa.question"), F.lit("")) == "", "no answer": F.col("qa.answer") == "", "no context": (F.size("pre_text") + F.size("post_text") + F.size("table")) == 0}
    return converted.select("id", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()]))).alias("issue"))


def sampled(found: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in an order, for a report."""
    return found.orderBy(*order).limit(n)


def output_name(path: str, tag: str = "finqa", only: str = "") -> str:
    """The name of a derived file beside its input: tag, and what the rows were narrowed to, before the ending."""
    stem, dot, ending = path.rpartition(".")
    base = stem if dot and "/" not in ending else path
    return f"{base}_{tag}{f'_{only}' if only else ''}{f'.{ending}' if base == stem and dot else ''}"


def statistics(items: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Counts by each of several sets of keys in one job, as (grouping, key..., n), in order."""
    keys = list(dict.fromkeys(k for s in sets for k in s))
    grouped = items.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(F.grouping_id().alias("_g"), F.count("*").alias("n"))
    bits = {sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s): "+".join(s) or "all" for s in sets}
    label = reduce(lambda a, kv: a.when(F.col("_g") == kv[0], F.lit(kv[1])), bits.items(), F.when(F.lit(False), F.lit("")))
    return grouped.select(label.alias("grouping"), *keys, "n").orderBy("grouping", *keys)


def report(items: DataFrame, calibration: DataFrame, rates: DataFrame | None = None) -> str:
    """A statistics page in Markdown; what reaches the driver is one row for each group."""
    lines = ["# Dataset statistics", ""]
    mean = items.agg(F.count("*").alias("n"), F.avg(F.size("evidence_chunks")).alias("mean")).first()
    lines += [f"- items: {mean['n']}", f"- mean evidence chunks: {(mean['mean'] or 0):.2f}", ""]
    classes = calibration.groupBy("classification").agg(F.count("*").alias("n")).orderBy("classification").collect()
    total = max(1, sum(r["n"] for r in classes))
    lines += ["## Difficulty", "", *[f"- {r['classification']}: {r['n']} ({r['n'] / total:.1%})" for r in classes], ""]
    for row in statistics(items, [["task_type"], ["reasoning_hops"], ["source_company", "source_report"]]).toLocalIterator():
        name = " / ".join(str(row[k]) for k in row["grouping"].split("+"))
        if f"## {row['grouping']}" not in lines:
            lines += [f"## {row['grouping']}", ""]
        lines.append(f"- {name}: {row['n']}")
    if rates is not None:
        r = rates.first()
        lines += ["", "## Review", "", *[f"- {k}: {r[k]}" for k in ("accept", "edit", "regenerate", "discard")], f"- edit rate: {r['edit_rate']:.1%}"]
    return "\n".join(lines) + "\n"
