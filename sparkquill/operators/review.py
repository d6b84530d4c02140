"""Human review as an event log: each action is a row, and the state of an item is its latest action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkquill.functions import scalars as S
from sparkquill.operators import evidence
from sparkquill.operators.relational import first_by

ACTIONS = ("accept", "edit", "regenerate", "discard")
#: What a new draft of an item may replace, besides the number of its steps.
REWRITTEN = ("question", "gold_answer", "gold_answer_unit", "evidence_chunks", "evidence_quotes", "reasoning_steps", "generation_notes")
#: The status after an action.
STATUS = {"accept": "accepted", "discard": "discarded", "edit": "edited", "regenerate": "pending"}
#: Fixed value: a date and a time, the item, the action and a note.
LOG_LINE = r"^\s*(\S+ \S+)\s+\|\s+(\S+)\s+\|\s+(\S+)\s+\|\s*(.*?)\s*$"


def states(items: DataFrame, actions: DataFrame) -> DataFrame:
    """items (ord, id, ...) with status, reasons and the time last touched; actions (ord, ts, id, action, note).

    All items keep their state, also those that a session's filter does not show."""
    last = first_by(actions, ["id"], F.col("ord").desc()).select("id", "ts", F.lower("action").alias("action"), "note")
    status = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    found = items.join(last, "id", "left")
    return found.select(
        *items.columns,
        F.coalesce(F.try_element_at(status, F.col("action")), F.lit("pending")).alias("status"),
        F.when(F.col("action") == "discard", F.col("note")).alias("discard_reason"),
        F.when(F.col("action") == "regenerate", F.col("note")).alias("regenerate_reason"),
        F.col("ts").alias("last_touched"),
    )


def resumed(drafts: DataFrame, prior: DataFrame) -> DataFrame:
    """Drafts (id, ...) with the status of a prior session; new ones are pending."""
    return drafts.join(prior.select("id", "status"), "id", "left").withColumn("status", F.coalesce("status", F.lit("pending")))


def parsed_log(lines: DataFrame) -> DataFrame:
    """(ts, id, action, note) of the lines (value) that have the four parts; others are left out."""
    part = lambda i: F.regexp_extract("value", LOG_LINE, i)
    return lines.filter(F.col("value").rlike(LOG_LINE)).select(part(1).alias("ts"), part(2).alias("id"), part(3).alias("action"), part(4).alias("note"))


def edit_rate(log: DataFrame, total: DataFrame) -> DataFrame:
    """Lines by action and the edits of all items (a one-row ``n_total``); every line counts. Without items all are 0."""
    n = lambda a: F.count_if(F.lower("action") == a)
    counts = log.agg(*[n(a).alias(a) for a in ACTIONS])
    rate = F.round(F.col("edit") / F.col("n_total"), 6)
    some = F.col("n_total") > 0
    both = counts.crossJoin(total).withColumn("edit_rate", F.when(some, rate).otherwise(F.lit(0.0)))
    return both.withColumns({a: F.when(some, F.col(a)).otherwise(F.lit(0).cast("long")) for a in ACTIONS})


def archive_first_pass(spark: SparkSession, reviewed: str, archive: str) -> bool:
    """Before a second pass, put the file (or table) of the first one aside, unless an archive is there already; whether it was moved."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    here, there = jvm.org.apache.hadoop.fs.Path(reviewed), jvm.org.apache.hadoop.fs.Path(archive)
    store = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return store.exists(here) and not store.exists(there) and store.rename(here, there)


def second_pass_counts(diff: DataFrame) -> DataFrame:
    """One row: items of one pass only, items whose status differs, items with changed fields, and all of these differences.

    diff: as ``second_pass`` returns it. An item of one pass only counts once, whatever else it lacks."""
    alone = ~(F.col("in_first") & F.col("in_second"))
    counts = diff.agg(
        F.count_if(alone).alias("only_in_one"), F.count_if(~alone & F.col("status_changed")).alias("status_changed"), F.count_if(~alone & (F.size("changed") > 0)).alias("fields_changed")
    )
    return counts.withColumn("n_diff", F.col("only_in_one") + F.col("status_changed") + F.col("fields_changed"))


def progress(states: DataFrame) -> DataFrame:
    """Per type: items, and those that are no longer pending."""
    return states.groupBy("task_type").agg(F.count_if(F.col("status") != "pending").alias("done"), F.count("*").alias("total"))


def second_pass(first: DataFrame, second: DataFrame, fields: list[str]) -> DataFrame:
    """(id, status_changed, changed, in_first, in_second) of all ids of two passes; a row or field that is missing is null."""
    a, b = (d.select("id", F.lit(True).alias(f"in_{n}"), F.col("status").alias(f"status_{n}"), *[F.col(c).alias(f"{c}_{n}") for c in fields]) for d, n in ((first, "a"), (second, "b")))
    both = a.join(b, "id", "full_outer")
    changed = S.changed_fields({c: F.col(f"{c}_a") for c in fields}, {c: F.col(f"{c}_b") for c in fields})
    held = [F.coalesce(f"in_{n}", F.lit(False)).alias(name) for n, name in (("a", "in_first"), ("b", "in_second"))]
    return both.select("id", (~F.col("status_a").eqNullSafe(F.col("status_b"))).alias("status_changed"), changed.alias("changed"), *held)


def next_pending(states: DataFrame, after: int) -> DataFrame:
    """The first pending item after a position, from the start again if there is none; the first item if none is pending."""
    pending = F.col("status") == "pending"
    return states.agg(F.coalesce(F.min(F.when(pending & (F.col("ord") > after), F.col("ord"))), F.min(F.when(pending, F.col("ord"))), F.min("ord")).alias("ord"))


def moved(position: Column, step: Column, n: Column) -> Column:
    """A cursor after a step, kept within the n items; 0 without any."""
    return F.greatest(F.lit(0), F.least(position + step, n - 1))


def jumped(states: DataFrame, target: str, position: int) -> DataFrame:
    """Where a jump leads: to the item with the id ``target``, else to the item of that number from 1 on, else nowhere.

    states (ord, id, ...), where ord counts from 0."""
    number = int(target) - 1 if target.strip().isdigit() else -1
    by_id, by_number = F.min(F.when(F.col("id") == target, F.col("ord"))), F.min(F.when(F.col("ord") == number, F.col("ord")))
    return states.agg(F.coalesce(by_id, by_number, F.lit(position).cast("long")).alias("ord"))


def rewritten(items: DataFrame, replies: DataFrame, chunks: DataFrame) -> DataFrame:
    """Items after a new draft was asked for: one that passes all rules replaces what the item says and keeps its id and
    source; of any other the item stays as it is. ``verdict`` says which rule a draft breaks, and is null without a draft.

    replies: (id, reply), a row for each id, chunks: (chunk_id, text)."""
    shown = items.select("id", F.explode("evidence_chunks").alias("chunk_id")).join(chunks, "chunk_id")
    shown = shown.groupBy("id").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("chunk_id", "text")))).alias("_shown"))
    asked = items.join(replies.select("id", "reply"), "id", "left").join(shown, "id", "left").withColumn("_json", evidence.extract_json(F.col("reply")))
    none = F.create_map().cast("map<string,string>")
    verdict = F.when(F.col("reply").isNull(), None).when(F.col("_shown").isNull(), "no_evidence").when(F.col("_json").isNull(), "no_json")
    asked = asked.withColumn("verdict", verdict.otherwise(evidence.verified(F.col("_json"), F.coalesce("_shown", none)))).withColumn("_new", evidence.payload(F.col("_json")))
    ok = F.coalesce(F.col("verdict") == "ok", F.lit(False))
    keys = F.json_object_keys("_json")
    fields = {f: F.when(ok & F.array_contains(keys, f), F.col(f"_new.{f}")).otherwise(F.col(f)) for f in REWRITTEN if f in items.columns}
    fields["reasoning_hops"] = F.when(ok, F.size("_new.reasoning_steps")).otherwise(F.col("reasoning_hops"))
    return asked.withColumns(fields).select(*items.columns, "verdict")


def log_line(ts: Column, item: Column, action: Column, note: Column) -> Column:
    return F.concat_ws(" | ", ts, item, action, F.coalesce(note, F.lit("")))
