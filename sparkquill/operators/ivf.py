"""A vector collection with inverted lists: centroids by rounds of k-means, chunks filed under the nearest, questions that
probe the lists nearest to them.

The collection is a Parquet table partitioned by list, so a probe reads its lists' files only. A list that holds much of the
table is as many files as its size asks for. What the driver holds are the centroids: ``n_lists`` vectors.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sparkquill.operators import nearest
from sparkquill.shared import stored

#: Vectors that centroids are fitted on, about, chosen by a hash of their ids.
SAMPLE = 65_536
#: Rows of a list that go to one file, about.
ROWS_PER_FILE = 250_000


def closest(vectors: np.ndarray, centroids: np.ndarray, n: int = 1) -> np.ndarray:
    """The n nearest centroids of each vector, nearest first, ties by number."""
    rough = (centroids**2).sum(axis=1) - 2 * vectors @ centroids.T
    return np.argsort(rough, axis=1, kind="stable")[:, :n]


def sampled(chunks: DataFrame, size: int) -> DataFrame:
    """About ``size`` of the chunks (chunk_id, v) with vectors, by a hash of their ids; all where there are no more."""
    known = chunks.filter("v is not null").select("chunk_id", "v")
    share = min(1.0, size / max(1, known.count()))
    return known.filter(F.pmod(F.xxhash64("chunk_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))


def fit(chunks: DataFrame, n_lists: int, rounds: int = 10, sample: int = SAMPLE, parts: int = 8) -> np.ndarray:
    """Centroids of the sample: the vectors of least hash first, then ``rounds`` times the mean of what is nearest to each.

    Vectors of another length than most have are left out. A centroid that nothing is nearest to stays where it is. Sums are made within parts cut by hash and added in the order
    of the parts, so that they do not depend on which task runs what."""
    rows = sampled(chunks, sample).select("v", F.xxhash64("chunk_id").alias("h"))
    spark = chunks.sparkSession
    rows = stored(rows.withColumn("part", F.pmod("h", F.lit(parts)).cast("int")), "sample")
    usual = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "size").first()
    if usual is None:
        raise ValueError("no vectors to fit centroids on")
    rows = rows.filter(F.size("v") == usual["size"])
    first = rows.orderBy("h").limit(4 * n_lists).collect()
    centroids = np.unique(np.array([r.v for r in first], np.float64), axis=0)
    centroids = centroids[np.linspace(0, len(centroids) - 1, min(n_lists, len(centroids))).astype(int)]

    def sums(key, table):
        held = shared.value
        table = table.sort_by("h")
        total, count = np.zeros_like(held), np.zeros(len(held), np.int64)
        v = nearest.matrix(table.column("v"))
        at = closest(v, held)[:, 0]
        np.add.at(total, at, v)
        count += np.bincount(at, minlength=len(held))
        return pa.table({"part": pa.array([key[0].as_py()] * len(held), pa.int32()), "list": pa.array(np.arange(len(held), dtype=np.int32)), "n": count, "total": list(total)})

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centroids)
        # n_lists rows for each of a fixed number of parts
        found = rows.groupBy("part").applyInArrow(sums, "part int, list int, n long, total array<double>").filter("n > 0").collect()
        total, count = np.zeros_like(centroids), np.zeros(len(centroids))
        for r in sorted(found, key=lambda r: (r.part, r.list)):
            total[r.list] += r.total
            count[r.list] += r.n
        moved = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids)
        shared.destroy()
        if np.array_equal(moved, centroids):
            break
        centroids = moved
    return centroids


def filed(chunks: DataFrame, centroids: np.ndarray, into: str = "list") -> DataFrame:
    """``chunks`` (chunk_id, v, ...) with the number of the nearest centroid; null where there is no vector of that length."""
    shared = chunks.sparkSession.sparkContext.broadcast(centroids)
    schema = StructType([*chunks.schema.fields, StructField(into, IntegerType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            v = batch.column(batch.schema.get_field_index("v"))
            fits = (pa.compute.fill_null(pa.compute.list_value_length(v), -1)).to_numpy(zero_copy_only=False) == held.shape[1]
            lists = np.zeros(len(batch), np.int32)
            if fits.any():
                lists[fits] = closest(nearest.matrix(v.filter(pa.array(fits))), held)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, mask=~fits)], names=schema.names)

    return chunks.mapInArrow(each, schema)


@dataclass
class Collection:
    """Chunks on disk by list, and the centroids of the lists."""

    spark: SparkSession
    path: str
    centroids: np.ndarray

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/lists")

    def query(self, questions: DataFrame, k: int, n_probe: int, on: Sequence[str] = (), most_questions: int = nearest.MOST_QUESTIONS) -> DataFrame:
        """The k nearest chunks of each question (question_id, chunk_id, distance, rank) in the ``n_probe`` lists nearest to it,
        of those that have its keys ``on``. With all lists probed the result is exact."""
        probing = probes(questions, self.centroids, n_probe)
        wanted = [r[0] for r in probing.select("list").distinct().collect()]  # n_lists numbers at most
        return nearest.top_k(probing, self.rows().filter(F.col("list").isin(wanted)), k, ["list", *on], most_questions)


def probes(questions: DataFrame, centroids: np.ndarray, n_probe: int) -> DataFrame:
    """questions (question_id, q, ...), a row for each of the lists nearest to them."""
    shared = questions.sparkSession.sparkContext.broadcast(centroids)
    known = questions.filter(F.col("q").isNotNull() & (F.size("q") == centroids.shape[1]))
    schema = StructType([*known.schema.fields, StructField("list", IntegerType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = closest(nearest.matrix(batch.column(batch.schema.get_field_index("q"))), shared.value, n_probe) if len(batch) else np.zeros((0, n_probe), int)
            rows = batch.take(pa.array(np.repeat(np.arange(len(batch)), near.shape[1])))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(near.ravel().astype(np.int32))], names=schema.names)

    return known.mapInArrow(each, schema)


def build(chunks: DataFrame, path: str, n_lists: int, rounds: int = 10, sample: int = SAMPLE, rows_per_file: int = ROWS_PER_FILE) -> Collection:
    """Write the collection of ``chunks`` (chunk_id, v, ...) to a new folder. Every chunk with a vector of the centroids' length is filed."""
    spark = chunks.sparkSession
    centroids = fit(chunks, n_lists, rounds, sample)
    rows = stored(filed(chunks, centroids).filter("list is not null"), "filed")
    sizes = rows.groupBy("list").agg(F.count("*").alias("_n"))
    pieces = F.ceil(F.col("_n") / rows_per_file)
    dealt = rows.join(F.broadcast(sizes), "list").withColumn("_piece", F.pmod(F.xxhash64("chunk_id"), pieces))  # n_lists rows at most
    dealt.repartition("list", "_piece").drop("_n", "_piece").write.partitionBy("list").parquet(f"{path}/lists")
    spark.createDataFrame([(json.dumps(centroids.tolist()),)], "value string").coalesce(1).write.text(f"{path}/centroids")
    return Collection(spark, path, centroids)


def opened(spark: SparkSession, path: str) -> Collection:
    return Collection(spark, path, np.array(json.loads(spark.read.text(f"{path}/centroids").first()[0])))
