"""Connected components over an edge table, by rounds of Spark joins.

Each round alternates the two star operations: large-star links every larger neighbour of a node to the smallest node
of its neighbourhood, small-star does the same for the smaller ones. Both keep components as they are and need a number
of rounds that grows with the logarithm of the longest path; a hub with many links converges in two. Grouping is a
``min`` that Spark pre-aggregates before the shuffle, and the joins back on the node may be split by skew handling.
Edges of each round go to the shared folder, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkquill.shared import dropped, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: distinct (a, b) with a > b. Returns the same kind of edges."""
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """edges: pairs (a, b) in any order, repeats, loops and nulls allowed. Returns (node, component): one row for each
    node that has an edge to another node, ``component`` the smallest node that it reaches. No edges give no rows."""
    clean = edges.filter("a is not null and b is not null and a != b")
    now = stored(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    for _ in range(rounds):
        before, now = now, stored(_star(_star(now, large=True), large=False), name)
        dropped(before)
        # the stars are final when each node hangs on one other node at most, and on none that hangs on another
        ends = now.select(F.col("a").alias("n"), F.lit(1).alias("child")).unionByName(now.select(F.col("b").alias("n"), F.lit(0).alias("child")))
        loose = ends.groupBy("n").agg(F.sum("child").alias("up"), F.min("child").alias("parent")).filter("up > 1 or (up = 1 and parent = 0)")
        if loose.isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError(f"no fixed point after {rounds} rounds")
