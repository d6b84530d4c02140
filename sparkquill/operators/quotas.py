"""Quotas of questions by type, filled going round a pool of sources: the exact sequence, worked out by Spark.

The sequence: for each type in turn, visit v goes to source v mod P. A source that has given ``cap`` items, of whatever types,
is passed over; else its next candidate of the type is drawn, and is taken if it is good. A type ends when its quota is full or
after quota * extra visits; visits that pass a source over count.

Within a type sources do not touch each other but by the quota: until a source is full, its r-th visit draws its r-th
candidate. So visit numbers are known without running the sequence, a source's end is a running count of its own good
draws, and the quota cuts a prefix of all visits, found by a running count over them. Only types wait for each other, as
they share the caps: a round each, whose picks are a written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkquill.operators.ordered import running
from sparkquill.shared import stored


def filled(candidates: DataFrame, pool: DataFrame, quotas: list[tuple[str, int]], good: Column, kind: str = "kind", source: str = "source", order: str = "ord", cap: int = 5, extra: int = 5, parts: int | None = None) -> DataFrame:
    """The candidates taken, with ``slot`` (from 1 in a type) and ``visit`` (from 0 in a type).

    candidates: (kind, source, order, ...), ``order`` without ties in a kind and source; pool: (source, position), positions
    0 .. P - 1; quotas: types in their order. ``good`` says whether a draw succeeds; null counts as no. Candidates of sources
    outside the pool, or of types without a quota, are not drawn. A row of ``quotas`` that comes again fills its type again,
    from the candidates' start, as the sequence would."""
    columns = candidates.columns
    size = pool.count()
    taken = None
    places = pool.select(F.col(source).alias("_source"), F.col("position").cast("long").alias("_place"))
    used = places.select("_source", F.lit(0).cast("long").alias("_used"))
    for turn, (code, quota) in enumerate(quotas):
        visits = quota * extra
        if not size or visits <= 0:
            continue
        rounds = -(-visits // size)  # no source is visited more often
        nth = F.row_number().over(Window.partitionBy(source).orderBy(order))
        drawn = candidates.filter(F.col(kind) == code).withColumn("_nth", nth).filter(F.col("_nth") <= rounds)
        drawn = drawn.join(places, F.col(source) == F.col("_source")).drop("_source")
        drawn = drawn.withColumns({"_visit": (F.col("_nth") - 1) * size + F.col("_place"), "_good": F.coalesce(good, F.lit(False)).cast("long")}).filter(F.col("_visit") < visits)
        earlier = Window.partitionBy(source).orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
        drawn = drawn.join(used, F.col(source) == F.col("_source")).drop("_source")
        open_draws = drawn.filter(F.col("_used") < cap).withColumn("_own", F.coalesce(F.sum("_good").over(earlier), F.lit(0)) + F.col("_used")).filter((F.col("_own") < cap) & (F.col("_good") == 1))
        picks = running(open_draws.select(*columns, "_visit"), [], ["_visit"], {"slot": ("count", F.lit(1))}, parts).filter(F.col("slot") <= quota)
        picks = stored(picks.withColumn("_turn", F.lit(turn)), "picks")
        taken = picks if taken is None else taken.unionByName(picks)
        gave = picks.groupBy(F.col(source).alias("_source")).agg(F.count("*").alias("_gave"))
        used = stored(used.join(gave, "_source", "left").select("_source", (F.col("_used") + F.coalesce("_gave", F.lit(0))).alias("_used")), "used")
    if taken is None:
        return candidates.limit(0).withColumns({"slot": F.lit(0).cast("long"), "visit": F.lit(0).cast("long")})
    return taken.select(*columns, "slot", F.col("_visit").alias("visit"))
