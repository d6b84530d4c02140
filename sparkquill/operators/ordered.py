"""Running totals in an order, for keys of any size.

A window puts all rows of a key into one task. Here rows are dealt by ranges of keys and order, so a key that holds a large
part of the table is cut into many ranges: each is summed on its own, and the totals of the ranges before it are added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkquill.shared import stored

#: How a running value is made of the values of two neighbouring ranges.
MERGED = {"count": lambda a, b: a + b, "sum": lambda a, b: a + b, "max": F.greatest}


def running(df: DataFrame, keys: list[str], order: list[str], values: dict[str, tuple[str, Column]], parts: int | None = None) -> DataFrame:
    """``df`` with, for each name of ``values``, the "count" of non-null values, "sum" or "max" of its column over the rows of
    the key up to and with this one. Nulls are a key like others and come first in the order; ``order`` should leave no ties.

    Ranges are cut by sampling and kept by a written table, so that a task that runs again finds the same ones. Besides the
    rows, what is shuffled are totals: one for each key and range."""
    spark = df.sparkSession
    kind = {"count": F.count, "sum": F.sum, "max": F.max}
    of_totals = kind | {"count": F.sum}
    own = df.withColumns({f"_{name}": value for name, (_, value) in values.items()})
    ranged = own.repartitionByRange(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, *order)
    ranged = stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")

    within = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranged.withColumns({name: kind[how](f"_{name}").over(within) for name, (how, _) in values.items()})
    totals = ranged.groupBy(*keys, "_range").agg(*[kind[how](f"_{name}").alias(f"_{name}") for name, (how, _) in values.items()])
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_range").alias("_at"), *[of_totals[how](f"_{name}").over(before).alias(f"_before_{name}") for name, (how, _) in values.items()])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)], F.col("_range") == F.col("_at"))
    joined = inside.join(offsets, same)
    whole = {name: F.when(F.col(f"_before_{name}").isNull(), F.col(name)).when(F.col(name).isNull(), F.col(f"_before_{name}")).otherwise(MERGED[how](F.col(f"_before_{name}"), F.col(name))) for name, (how, _) in values.items()}
    return joined.withColumns(whole).select(*df.columns, *values)
