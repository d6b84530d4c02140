"""Interaction audit of filters by inclusion and exclusion, without running any order of them.

For each part the joint failures of all subsets of the filters are summed, each as the product of its filters' flags. All
else follows from these sums: Moebius inversion gives what survives a set of filters, differences of survivors give what a
filter removes behind others, and joint failures are, up to sign, the Harsanyi dividends of the game "documents removed by
a set of filters", which give each filter's Shapley value.

Flags of a text alone are equal for equal texts. So documents are grouped by a digest of the text before anything is
judged across the table: a hot text becomes a row for each task and part before the shuffle, and no text is shuffled.

Defined results: a null text counts as empty; a null part counts as the empty one; a row with a null id is never called a
repeat and makes none; rows of one id and text are all first or all repeats; a document of several labels is good, or
toxic, if one of them says so; very long texts are measured whole; extra columns of any name are not read; an empty table
gives no part and so no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#$%&*|"
#: The filters of the query; the last one looks across the table.
LETTERS = "ABCDE"
TOTALS = ("n", "good", "toxic")


def text_flags(text: Column) -> Column:
    """A struct of the filters A to D of one text, and its digest."""
    text = F.coalesce(text, F.lit(""))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    symbol = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in SYMBOLS])
    rest = F.struct((100 * capitals > 2 * F.char_length(text)).alias("C"), symbol.alias("D"), F.unhex(F.sha2(text, 256)).alias("digest"))
    # runs of spaces split, so only the first and the last part may be empty
    parts = F.transform(F.array(F.split(text, SPACE)), lambda p: F.struct(F.size(p).alias("n"), F.size(F.array_distinct(p)).alias("kinds"), (F.get(p, F.lit(0)) == "").alias("first"), (F.get(p, F.size(p) - 1) == "").alias("last")))
    number = lambda c: c.cast("int")
    n = lambda p: F.when(p["n"] == 1, 1 - number(p["first"])).otherwise(p["n"] - number(p["first"]) - number(p["last"]))
    counts = F.transform(parts, lambda p: F.struct(n(p).alias("n"), (p["kinds"] - number(p["first"] | p["last"])).alias("kinds")))
    return F.transform(counts, lambda c: F.struct((c["n"] < 200).alias("A"), (100 * c["kinds"] < 50 * c["n"]).alias("B"), rest.alias("rest")))[0]


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, A to E, n, good, toxic): how many documents of a part fail which filters, a row for each text, part and E.

    docs: (doc_id, text, source), labels: (doc_id, quality, toxic)."""
    # explode of one element ends the expression: the flags are not worked out again where they are used
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce("source", F.lit("")).alias("part"), F.explode(F.array(text_flags(F.col("text")))).alias("judged"))
    rows = rows.select("id", "part", "judged.A", "judged.B", "judged.rest.C", "judged.rest.D", "judged.rest.digest")
    marks = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").alias("id"))
    said = marks.agg(F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("toxic"))
    known = rows.join(said, "id", "left")
    of_id = known.groupBy("id", "digest", "part", *"ABCD").agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS[1:]])
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", *TOTALS)))
    nameless = F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0))
    of_text = of_id.groupBy("digest", "part", *"ABCD").agg(least.alias("least"), nameless.alias("nameless"), *[F.sum(c).alias(c) for c in TOTALS])
    first = F.min("least.id").over(Window.partitionBy("digest"))  # a row for each part that has the text
    is_first = F.coalesce(F.col("least.id") == first, F.lit(False))
    held = of_text.withColumn("firsts", F.struct(*[(F.when(is_first, F.col(f"least.{c}")).otherwise(0) + (F.col("nameless") if c == "n" else 0)).alias(c) for c in TOTALS]))
    both = F.array(
        F.struct(F.lit(False).alias("E"), *[F.col(f"firsts.{c}").alias(c) for c in TOTALS]),
        F.struct(F.lit(True).alias("E"), *[(F.col(c) - F.col(f"firsts.{c}")).alias(c) for c in TOTALS]),
    )
    return held.select("part", *"ABCD", F.explode(both).alias("half")).select("part", *"ABCD", "half.*").filter("n > 0")


def joint_failures(rows: DataFrame, part: str, filters: Sequence[str], totals: Sequence[str] = TOTALS) -> DataFrame:
    """For each part and total an array over all subsets of the filters, as bits: how much fails every filter of the subset.

    rows: boolean columns ``filters`` and how many documents each row stands for. A subset's sum is that of the product of
    its flags, so partial sums combine before the shuffle, and a part is one row whatever its size."""
    flags = [F.col(f).cast("long") for f in filters]
    sums = []
    for mask in range(1 << len(filters)):
        for total in totals:
            product = F.col(total)
            for bit, flag in enumerate(flags):
                if mask >> bit & 1:
                    product = product * flag
            sums.append(F.sum(product).alias(f"{total}_{mask}"))
    held = rows.groupBy(part).agg(*sums)
    return held.select(part, *[F.array(*[f"{t}_{mask}" for mask in range(1 << len(filters))]).alias(t) for t in totals])


def survivors(joint: Column, k: int) -> Column:
    """Moebius inversion: for each set of filters, what fails none of them."""
    masks = F.sequence(F.lit(0), F.lit((1 << k) - 1))
    sign = lambda s: 1 - 2 * (F.bit_count(s) % 2)
    term = lambda f, s: F.when(s.bitwiseAND(f) == s, F.get(joint, s) * sign(s)).otherwise(0)
    return F.transform(masks, lambda f: F.aggregate(masks, F.lit(0).cast("long"), lambda total, s: total + term(f, s)))


def interactions(joint: DataFrame, part: str, filters: str, totals: Sequence[str] = TOTALS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, <total>_lost ..., shapley) for all orders of the filters.

    joint: as ``joint_failures`` gives it. ``filters`` are one letter each; the first of ``totals`` counts documents. The
    Shapley value is a sum over all orders, not a mean, so it is whole."""
    k, n = len(filters), totals[0]
    every = (1 << k) - 1
    held = joint.withColumns({f"alive_{t}": survivors(F.col(t), k) for t in totals})
    orders = F.explode(F.array(*[F.lit("".join(p)) for p in permutations(filters)])).alias("filter_order")
    steps = held.select("*", orders).select("*", F.posexplode(F.split("filter_order", "")).alias("at", "filter"))
    bit = lambda letter: F.get(F.array(*[F.lit(1 << i) for i in range(k)]), F.array_position(F.array(*map(F.lit, filters)), letter) - 1)
    earlier = F.aggregate(F.slice(F.split("filter_order", ""), F.lit(1), F.col("at")), F.lit(0), lambda held, x: held.bitwiseOR(bit(x)))
    steps = steps.withColumns({"own": bit(F.col("filter")), "before": earlier})
    after = F.col("before").bitwiseOR(F.col("own"))
    lost = lambda t: F.get(f"alive_{t}", F.col("before")) - F.get(f"alive_{t}", after)
    # a dividend is shared equally by the filters of its set: whole in a sum over all k! orders
    dividend = lambda s: F.get(n, s) * (2 * (F.bit_count(s) % 2) - 1)
    share = lambda s: F.when(s.bitwiseAND(F.col("own")) != 0, dividend(s) * F.floor(F.lit(factorial(k)) / F.bit_count(s))).otherwise(0)
    shapley = F.aggregate(F.sequence(F.lit(1), F.lit(every)), F.lit(0).cast("long"), lambda total, s: total + share(s))
    return steps.select(
        part,
        "filter_order",
        (F.col("at") + 1).cast("int").alias("step"),
        F.get(f"alive_{n}", after).alias("kept"),
        lost(n).alias("removed"),
        (F.get(n, F.col("own")) - lost(n)).alias("redundant"),
        (F.get(f"alive_{n}", F.lit(every) - F.col("own")) - F.get(f"alive_{n}", F.lit(every))).alias("unique_fails"),
        *[lost(t).alias(f"{t}_lost") for t in totals[1:]],
        shapley.alias("shapley"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return interactions(joint_failures(flagged(docs, labels), "part", LETTERS), "part", LETTERS)
