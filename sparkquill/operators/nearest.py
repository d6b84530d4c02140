"""Top-k by vector distance in two phases: each task keeps the k nearest of the chunks it reads, and only their ids and
distances are shuffled and ranked.

A question searches one or more groups of chunks: all of them, those that pass its filter (equal keys), or the inverted lists
that it probes. Chunks are never shuffled, so a group that holds most of the table is read by as many tasks as any other
part of it. Questions are a stated set, broadcast in blocks with a pass over the chunks for each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType

#: Questions that one pass over the chunks scores, at most; their vectors are broadcast.
MOST_QUESTIONS = 10_000
#: Distances are found by a product of matrices first; so much they may differ from exact ones, relative to 1 and themselves.
MARGIN = 1e-6
#: Distances are compared after rounding to so many places, ties by id.
PLACES = 9
#: Chunks and questions that are scored at a time: what a task holds of distances is their product, however many questions there are.
STEP, ASKED = 2048, 512


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long lists of numbers as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def exact(vectors: np.ndarray, question: np.ndarray) -> np.ndarray:
    """Squared distances, summed from the first coordinate to the last as Spark sums them."""
    return np.cumsum((vectors - question) ** 2, axis=1)[:, -1] if vectors.size else np.zeros(len(vectors))


class Best:
    """For each question of a block the nearest chunks so far, with all that rounding may make equal to the k-th."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.distances = [np.zeros(0)] * n
        self.names = [np.zeros(0, object)] * n
        self.limit = np.full(n, np.inf)

    def offer(self, asked: np.ndarray, wanted: np.ndarray, names: np.ndarray, vectors: np.ndarray) -> None:
        """asked: numbers of questions; wanted: their vectors."""
        sizes = (vectors**2).sum(axis=1)
        for at in range(0, len(asked), ASKED):
            self._offer(asked[at : at + ASKED], wanted[at : at + ASKED], names, vectors, sizes)

    def _offer(self, asked: np.ndarray, wanted: np.ndarray, names: np.ndarray, vectors: np.ndarray, sizes: np.ndarray) -> None:
        rough = (wanted**2).sum(axis=1)[:, None] - 2 * wanted @ vectors.T + sizes
        slack = MARGIN * (1 + np.abs(rough))
        closer = rough - slack <= self.limit[asked][:, None]
        for i in np.flatnonzero(closer.any(axis=1)).tolist():
            q, own = asked[i], np.flatnonzero(closer[i])
            if len(own) > self.k:  # those of this step that may be among its own k nearest
                upper = np.partition(rough[i, own] + slack[i, own], self.k - 1)[self.k - 1]
                own = own[rough[i, own] - slack[i, own] <= upper]
            self.distances[q] = np.concatenate([self.distances[q], exact(vectors[own], wanted[i])])
            self.names[q] = np.concatenate([self.names[q], names[own]])
            if len(self.names[q]) > self.k:
                self._prune(q)

    def _prune(self, q: int) -> None:
        """Of each distance the k least ids, and none that is farther than the k-th by more than rounding."""
        order = np.lexsort((self.names[q], self.distances[q]))
        d = self.distances[q][order]
        self.limit[q] = d[self.k - 1] + 2 * 10.0**-PLACES
        place = np.arange(len(d)) - np.searchsorted(d, d)  # among equal ones
        keep = order[(place < self.k) & (d <= self.limit[q])]
        self.distances[q], self.names[q] = self.distances[q][keep], self.names[q][keep]


def candidates(questions: DataFrame, chunks: DataFrame, k: int, on: list[str], most_questions: int = MOST_QUESTIONS) -> DataFrame:
    """(question_id, chunk_id, distance): from each task the k nearest of its chunks for each question, those of one group only.

    questions: (question_id, q, on ...), a row for each group that a question searches; chunks: (chunk_id, v, on ...). Rows
    without a vector, or with one of another length, are near to nothing; a null key equals none."""
    spark = questions.sparkSession
    chunks = chunks.select("chunk_id", "v", *on)
    schema = StructType([questions.schema["question_id"], chunks.schema["chunk_id"], StructField("distance", DoubleType())])
    id_type, chunk_type = to_arrow_type(schema[0].dataType), to_arrow_type(schema[1].dataType)

    def scan(block: dict) -> DataFrame:
        ids = list(block)
        groups: dict[tuple, list[int]] = {}
        for i, (_, keys) in enumerate(block.values()):
            for key in keys:
                groups.setdefault(key, []).append(i)
        by_size: dict[int, list[int]] = {}
        for i, (vector, _) in enumerate(block.values()):
            by_size.setdefault(len(vector), []).append(i)
        vectors = {size: np.array([block[ids[i]][0] for i in own], np.float64) for size, own in by_size.items()}
        shared = spark.sparkContext.broadcast((ids, groups, by_size, vectors))

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, groups, by_size, vectors = shared.value
            best = Best(len(ids), k)
            held = {key: {size: np.intersect1d(own, by_size[size]) for size in by_size} for key, own in groups.items()}
            row_of = {size: {q: i for i, q in enumerate(own)} for size, own in by_size.items()}
            for batch in batches:
                batch = batch.filter(pc.is_valid(batch.column("v")))
                for size in by_size:
                    part = batch.filter(pc.equal(pc.list_value_length(batch.column("v")), size))
                    for at in range(0, len(part), STEP):
                        step = part.slice(at, STEP)
                        v, names = matrix(step.column("v")), np.array(step.column("chunk_id").to_pylist(), object)
                        for key, rows in grouped(step, on).items():
                            asked = held.get(key, {}).get(size)
                            if asked is not None and len(asked):
                                best.offer(asked, vectors[size][[row_of[size][q] for q in asked.tolist()]], names[rows], v[rows])
            for i, (d, names) in enumerate(zip(best.distances, best.names, strict=True)):
                if len(d):
                    yield pa.RecordBatch.from_arrays([pa.array([ids[i]] * len(d), id_type), pa.array(names.tolist(), chunk_type), pa.array(d)], names=schema.names)

        return chunks.mapInArrow(each, schema)

    out = spark.createDataFrame([], schema)
    for block in blocks(questions.filter("q is not null").select("question_id", "q", *on), on, most_questions):
        out = out.unionByName(scan(block))
    return out


def grouped(batch: pa.RecordBatch, on: list[str]) -> dict[tuple, np.ndarray]:
    """The rows of each key, without those that hold a null."""
    if not on:
        return {(): np.arange(len(batch))}
    codes, values = np.zeros(len(batch), np.int64), []
    for c in on:
        coded = batch.column(batch.schema.get_field_index(c)).dictionary_encode()
        values.append([*coded.dictionary.to_pylist(), None])
        codes = codes * len(values[-1]) + pc.fill_null(coded.indices, len(values[-1]) - 1).to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    found = {}
    kinds, starts = np.unique(codes[order], return_index=True)
    for code, rows in zip(kinds.tolist(), np.split(order, starts[1:]), strict=True):
        key = []
        for own in reversed(values):
            code, i = divmod(code, len(own))
            key.append(own[i])
        if None not in key:
            found[tuple(reversed(key))] = rows
    return found


def blocks(questions: DataFrame, on: list[str], most: int) -> Iterator[dict]:
    """Questions as {id: (vector, groups)}, so many at a time; rows of one question follow each other."""
    block: dict = {}
    for row in questions.orderBy("question_id").toLocalIterator():
        if row.question_id not in block and len(block) == most:
            yield block
            block = {}
        key = tuple(row[c] for c in on)
        held = block.setdefault(row.question_id, (list(row.q), []))
        if None not in key and key not in held[1]:
            held[1].append(key)
    if block:
        yield block


def ranked(found: DataFrame, k: int) -> DataFrame:
    """(question_id, chunk_id, distance, rank): the k nearest of each question; Spark limits each task's rows before the shuffle."""
    rounded = found.withColumn("distance", F.round("distance", PLACES))
    rank = F.row_number().over(Window.partitionBy("question_id").orderBy("distance", "chunk_id"))
    return rounded.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_k(questions: DataFrame, chunks: DataFrame, k: int, on: Sequence[str] = (), most_questions: int = MOST_QUESTIONS) -> DataFrame:
    """The k nearest chunks of each question (question_id, chunk_id, distance, rank): of all, or of those with its keys."""
    return ranked(candidates(questions, chunks, k, list(on), most_questions), k)
