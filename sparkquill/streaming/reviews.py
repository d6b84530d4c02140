"""Review actions as a stream: the state of an item is its latest action, kept in a state store.

Actions may come late, more than once, and cut into batches in any way: the one of the greatest ``ord`` counts. Each batch
gives the state of the items that it has actions of; ``latest`` makes the table of all from what the batches gave.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkquill.operators.relational import first_by
from sparkquill.operators.review import STATUS

CHANGE = "id string, ord long, ts string, action string, note string"


#: What keeps the state of ``transformWithState``.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start within keep their state in RocksDB, as these operators need."""
    before = spark.conf.get(*PROVIDER[:1], None)
    spark.conf.set(*PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER[0])
        else:
            spark.conf.set(PROVIDER[0], before)


def changes(actions: DataFrame) -> DataFrame:
    """A stream of actions (ord, ts, id, action, note) -> a stream of the states of the items that a batch has actions of. Of actions
    with one ``ord`` the greatest counts. A task keeps one state for each item of its batch before the shuffle."""
    known = actions.filter("id is not null and ord is not null").select("id", F.col("ord").cast("long").alias("ord"), "ts", F.lower("action").alias("action"), "note")
    return known.groupBy("id").agg(F.max(F.struct("ord", "ts", "action", "note")).alias("s")).select("id", "s.*")


def kept(actions: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Follow a stream of actions: what changes in a batch is a folder of Parquet, overwritten if the batch runs again."""

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return changes(actions).writeStream.outputMode("update").foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(items: DataFrame, changed: DataFrame) -> DataFrame:
    """items (ord, id, ...) with status, reasons and the time last touched, as ``review.states`` gives them from all actions."""
    last = first_by(changed.select("id", F.col("ord").alias("_ord"), "ts", "action", "note"), ["id"], F.col("_ord").desc()).drop("_ord")
    status = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    return items.join(last, "id", "left").select(
        *items.columns,
        F.coalesce(F.try_element_at(status, F.col("action")), F.lit("pending")).alias("status"),
        F.when(F.col("action") == "discard", F.col("note")).alias("discard_reason"),
        F.when(F.col("action") == "regenerate", F.col("note")).alias("regenerate_reason"),
        F.col("ts").alias("last_touched"),
    )
