"""Results kept as they come: each micro-batch adds the items that are not stored yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: The store is parted by a hash of the key, so that a batch reads only the parts that its keys may be in.
PARTS = 256


def part_of(key: str, parts: int = PARTS):
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def store_new(results: DataFrame, path: str, checkpoint: str, key: str = "item_id", parts: int = PARTS) -> StreamingQuery:
    """Append a stream of results to Parquet, one row for each key; a batch that runs again after a failure adds nothing twice.

    The store has a folder for each part of the keys. Of the parts that a batch touches, only the keys are read."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates([key]).withColumn("part", part_of(key, parts))
        jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
        store = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
        if store.exists(jvm_path):
            touched = [r[0] for r in new.select("part").distinct().collect()]  # PARTS numbers at most
            held = spark.read.schema(new.schema).parquet(path).filter(F.col("part").isin(touched)).select(key, "part")
            new = new.join(held, [key, "part"], "left_anti").select(*batch.columns, "part")
        new.write.mode("append").partitionBy("part").parquet(path)

    return results.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
