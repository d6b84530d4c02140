"""Filling quotas of questions by type: the exact round-robin, and forms in windows for large pools."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkquill.functions import scalars as S
from sparkquill.operators import evidence
from sparkquill.operators.relational import first_by
from sparkquill.shared import stored


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """A fixed order by a hash of a key and a seed, as the column ``ord_key``."""
    return df.withColumn("ord_key", F.md5(F.concat_ws("#", F.lit(str(seed)), F.col(key).cast("string"))))


def filled(pool: Iterable[tuple], quotas: dict[str, int], draw: Callable, cap: int = 5, extra: int = 5) -> list:
    """For each type go round a pool of (company, year) until its quota is filled or quota * extra tries are used up.

    ``draw(type, slot, source)`` gives an item or None; a source gives at most ``cap`` items over all types. Caps couple
    the types, so this is a sequence by nature; the pool is a list of reports, and each try is a call of a model."""
    pool, used, out = list(pool), Counter(), []
    for kind, quota in quotas.items():
        done = tries = at = 0
        while pool and done < quota and tries < quota * extra:
            source = pool[at % len(pool)]
            at += 1
            if used[source] >= cap:
                if all(used[s] >= cap for s in pool):
                    break
                continue
            tries += 1
            item = draw(kind, done + 1, source)
            if item is not None:
                out.append(item)
                used[source] += 1
                done += 1
    return out


def filled_by_windows(candidates: DataFrame, kind: str, source: str, order: str, quotas: DataFrame, cap: int = 5) -> DataFrame:
    """An approximation of ``filled`` for many candidates: first the cap within a source, then the quota within a type.

    Candidates beyond the cap are lost even where quotas stay open; ``filled_by_rounds`` goes on with them."""
    within = F.row_number().over(Window.partitionBy(source).orderBy(order))
    capped = candidates.withColumn("_c", within).filter(F.col("_c") <= cap)
    slot = F.row_number().over(Window.partitionBy(kind).orderBy(order))
    return capped.withColumn("slot", slot).join(F.broadcast(quotas), kind).filter(F.col("slot") <= F.col("quota")).drop("_c", "quota")


def filled_by_rounds(candidates: DataFrame, kind: str, source: str, order: str, quotas: DataFrame, cap: int = 5) -> DataFrame:
    """As ``filled_by_windows``, repeated with the candidates left over until none fits: in the end each of them has a full
    type or a full source. Which types a source's places go to is not optimised. quotas: (kind, quota), a row a kind.

    Either all that the caps allow is taken, which ends it, or a type is full: so there is a round more than types at most.
    A source gives ``cap`` rows of a type at most, its first ones, so the rounds work on these only."""
    first = F.row_number().over(Window.partitionBy(source, kind).orderBy(order))
    rows = candidates.withColumn("_f", first).filter(F.col("_f") <= cap).drop("_f").join(F.broadcast(quotas.withColumnRenamed("quota", "_need")), kind)
    rows = stored(rows.withColumns({"_left": F.lit(cap).cast("long"), "_need": F.col("_need").cast("long"), "_row": F.monotonically_increasing_id()}), "candidates")
    picks = rows.limit(0)
    while True:
        within = F.row_number().over(Window.partitionBy(source).orderBy(order, "_row"))
        capped = rows.withColumn("_c", within).filter((F.col("_c") <= F.col("_left")) & (F.col("_c") <= cap))
        place = F.row_number().over(Window.partitionBy(kind).orderBy(order, "_row"))
        taken = stored(capped.withColumn("_p", place).filter(F.col("_p") <= F.col("_need")).drop("_c", "_p"), "picks")
        if taken.isEmpty():
            break
        picks = picks.unionByName(taken)
        of_source = taken.groupBy(F.col(source).alias("_source")).agg(F.count("*").alias("_gave"))
        of_kind = taken.groupBy(F.col(kind).alias("_kind")).agg(F.count("*").alias("_got"))
        rest = rows.join(taken.select("_row"), "_row", "left_anti").join(of_source, F.col(source).eqNullSafe(F.col("_source")), "left").join(of_kind, F.col(kind) == F.col("_kind"), "left")
        rest = rest.withColumns({"_left": F.col("_left") - F.coalesce("_gave", F.lit(0)), "_need": F.col("_need") - F.coalesce("_got", F.lit(0))})
        rows = stored(rest.filter("_left > 0 and _need > 0").select(*rows.columns), "candidates")
    slot = F.row_number().over(Window.partitionBy(kind).orderBy(order, "_row"))
    return picks.withColumn("slot", slot).select(*candidates.columns, "slot")


def first_ok(attempts: DataFrame) -> DataFrame:
    """attempts (id, attempt, verdict, ...) -> the first that passed for each id; discards are counted by ``attempt_stats``."""
    rank = F.row_number().over(Window.partitionBy("id").orderBy("attempt"))
    return attempts.filter(F.col("verdict") == "ok").withColumn("_r", rank).filter("_r = 1").drop("_r")


def drafted(replies: DataFrame) -> DataFrame:
    """Items of the first reply of each slot that passes all rules, and of the others why their last reply does not.

    replies: (task_type, slot, attempt, reply, error, company, report, section, shown), where ``shown`` maps the ids of the
    evidence to its texts; an ``error`` is a call that gave no reply. Returns (task_type, slot, verdict, item)."""
    shown = F.coalesce("shown", F.create_map().cast("map<string,string>"))
    judged = replies.withColumn("_json", evidence.extract_json(F.col("reply")))
    verdict = F.when(F.size(shown) == 0, "no_evidence").when(F.col("error").isNotNull(), "api_error").when(F.col("_json").isNull(), "json_parse_failed")
    judged = judged.withColumn("verdict", verdict.otherwise(evidence.verified(F.col("_json"), shown))).withColumn("_p", evidence.payload(F.col("_json")))
    text = lambda name: F.col(f"_p.{name}").alias(name)
    item = F.struct(
        S.item_id(F.col("task_type"), F.col("slot")).alias("id"), text("question"), text("gold_answer"), text("gold_answer_unit"), text("evidence_chunks"), text("evidence_quotes"), text("reasoning_steps"),
        F.size("_p.reasoning_steps").alias("reasoning_hops"), F.col("task_type"), F.col("company").alias("source_company"), F.col("report").alias("source_report"),
        F.col("section").alias("source_section"), F.lit(None).cast("string").alias("source_pages"), F.coalesce("_p.generation_notes", F.lit("")).alias("generation_notes"),
    )
    ok = F.col("verdict") == "ok"
    one = judged.withColumn("item", F.when(ok, item))
    # a passing reply comes first, the earliest of them; of slots without one the last reply says why
    return first_by(one, ["task_type", "slot"], F.when(ok, F.col("attempt")).asc_nulls_last(), F.col("attempt").desc()).select("task_type", "slot", "verdict", "item")


def discard_reasons(drafts: DataFrame) -> DataFrame:
    """How often each rule was the reason of a discard, by type."""
    return drafts.filter("verdict != 'ok'").groupBy("task_type", F.col("verdict").alias("reason")).agg(F.count("*").alias("n"))


def draft_stats(items: DataFrame) -> DataFrame:
    """Drafts by type, by company and report, and all: (level, task_type, source_company, source_report, n_items, mean_hops, n_chunks).

    items: (task_type, source_company, source_report, reasoning_hops, evidence_chunks). ``n_chunks`` counts distinct pieces
    of evidence; ``mean_hops`` is 0 where no item has a number. No items give no rows. Level is "type", "report" or "all", and the columns that it does not
    group by are null."""
    sets = [["task_type"], ["source_company", "source_report"], []]
    columns = [c for s in sets for c in s]
    level = F.when(F.grouping("task_type") == 0, "type").when(F.grouping("source_company") == 0, "report").otherwise("all").alias("level")
    counts = items.groupingSets(sets, *columns).agg(level, F.count("*").alias("n_items"), F.round(F.coalesce(F.avg("reasoning_hops"), F.lit(0.0)), 6).alias("mean_hops"))
    chunks = items.select(*columns, F.explode("evidence_chunks").alias("_chunk")).groupingSets(sets, *columns).agg(level, F.count_distinct("_chunk").alias("n_chunks"))
    same = F.col("a.level") == F.col("b.level")
    for c in columns:
        same &= F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    both = counts.alias("a").join(chunks.alias("b"), same, "left")
    return both.select("a.level", *[f"a.{c}" for c in columns], "n_items", "mean_hops", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"))


def attempt_stats(attempts: DataFrame) -> DataFrame:
    """Per type: tries, passes and discards."""
    ok = F.col("verdict") == "ok"
    return attempts.groupBy("task_type").agg(F.count("*").alias("attempts"), F.count_if(ok).alias("successes"), F.count_if(~ok).alias("discards"))
