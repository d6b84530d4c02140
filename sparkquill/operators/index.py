"""Exact vector search over a table of embeddings, and the index table's upkeep.

Distances are squared Euclidean in double precision; equal ones are ordered by id, so results do not depend on the plan.
"""

from __future__ import annotations

import hashlib
import math
import time
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkquill.operators import nearest
from sparkquill.operators.attempts import EMBEDDINGS, Exhausted, Policy

#: Words whose places a task keeps, at most.
MOST_PLACES = 1 << 18
#: Texts are dealt by the first bits of their length, so many; a part holds about so many tokens.
BITS, PART_TOKENS = 6, 2_000_000
#: Rows that a task gives at a time.
GIVEN = 1024

def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)


def top_k(questions: DataFrame, chunks: DataFrame, k: int, on: list[str], most_questions: int = nearest.MOST_QUESTIONS) -> DataFrame:
    """questions (question_id, q, keys...), chunks (chunk_id, v, keys...) -> (question_id, chunk_id, distance, rank).

    Exact, in two phases (``nearest``): each task keeps the k nearest of its chunks for each question, of those with its keys if
    there are any, and only ids and distances are shuffled and ranked. Questions are a stated set, broadcast in blocks of
    ``most_questions``, with a pass over the chunks for each."""
    return nearest.top_k(questions, chunks, k, on, most_questions)


def top_k_or_any(questions: DataFrame, chunks: DataFrame, k: int, on: list[str]) -> DataFrame:
    """As top_k with a filter; questions whose filter leaves no chunk are searched without."""
    found = top_k(questions, chunks, k, on)
    lost = questions.join(chunks.select(*on).distinct(), on, "left_anti")
    return found.unionByName(top_k(lost.drop(*on), chunks.drop(*on), k, []))


def recall(gold: DataFrame, hits: DataFrame, group: str | None = None) -> DataFrame:
    """Share of questions all of whose gold ids are hits; a question without gold is a miss. gold: (question_id, gold[, group])."""
    found = hits.groupBy("question_id").agg(F.collect_set("chunk_id").alias("found"))
    all_in = (F.size("gold") > 0) & (F.size(F.array_except("gold", F.coalesce("found", F.array().cast("array<bigint>")))) == 0)
    judged = gold.join(found, "question_id", "left").withColumn("hit", F.coalesce(all_in, F.lit(False)))
    share = [F.count("*").alias("n"), F.count_if("hit").alias("n_hit"), F.round(F.avg(F.col("hit").cast("double")), 6).alias("recall")]
    return judged.groupBy(*([group] if group else [])).agg(*share)


def missed(gold: DataFrame, hits: DataFrame) -> DataFrame:
    """(question_id, missed): the gold ids that are no hits, of the questions that have any."""
    found = hits.groupBy("question_id").agg(F.collect_set("chunk_id").alias("found"))
    left = F.when(F.col("found").isNull(), F.array_distinct("gold")).otherwise(F.array_except("gold", "found"))
    return gold.join(found, "question_id", "left").select("question_id", F.array_sort(left).alias("missed")).filter(F.size("missed") > 0)


def by_ids(index: DataFrame, ids: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The rows of an index with the ids of a table, in no order; ids that it lacks give none."""
    return index.join(ids.select(key).distinct(), key, "left_semi")


def reset(index: DataFrame) -> DataFrame:
    """The index as it is before anything is added."""
    return index.limit(0)


def upsert(index: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The index with rows replaced or added by key."""
    return index.join(new.select(key), key, "left_anti").unionByName(new)


def replaced(index: DataFrame, new: DataFrame, parts: tuple[str, ...] = ("company", "year", "section")) -> DataFrame:
    """The index with all rows of the re-indexed parts replaced, so that no rows of a longer former version stay."""
    return index.join(new.select(*parts).distinct(), list(parts), "left_anti").unionByName(new)


def index_rows(chunks: DataFrame, embedding: str = "embedding") -> DataFrame:
    """Chunks as the index holds them: a missing report code is an empty text."""
    meta = F.struct("company", "year", "section", F.coalesce("report_code", F.lit("")).alias("report_code"), "has_table", "token_count")
    return chunks.select(F.col("chunk_id").alias("id"), F.col("text").alias("document"), F.col(embedding).alias("embedding"), meta.alias("metadata"))


def word_place(word: str, size: int) -> tuple[int, float]:
    """Where a word counts in a vector, and with which sign."""
    h = int.from_bytes(hashlib.blake2b(word.lower().encode(), digest_size=8).digest(), "big")
    return h % size, 1.0 if h >> 63 else -1.0


class Places(dict):
    """Of each word its place in a vector, and behind those of all positive words the place of a negative one."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_PLACES:
            self.clear()
        at, sign = word_place(word, self.size)
        self[word] = at = at if sign > 0 else at + self.size
        return at


places = lru_cache(maxsize=8)(Places)


def hash_vector(text: str, size: int) -> list[float]:
    """A unit vector of signed word counts in hashed places."""
    counts = np.bincount(np.fromiter(map(places(size).__getitem__, text.split()), np.int64), minlength=2 * size)
    out = (counts[:size] - counts[size:]).astype(float)
    norm = math.sqrt(out @ out)
    return (out / norm if norm else out).tolist()


Provider = Callable[[list[str]], list[list[float]]]
PROVIDERS: dict[str, Callable[..., Provider]] = {"hash": lambda size=64: lambda texts: [hash_vector(t, size) for t in texts]}


def build_provider(name: str, **options) -> Provider:
    if name not in PROVIDERS:
        raise ValueError(f"unknown embedding provider: {name}")
    return PROVIDERS[name](**options)


def patient(encode: Provider, policy: Policy = EMBEDDINGS, wait: Callable[[float], None] = time.sleep) -> Provider:
    """A provider that is asked again for a batch that fails, after the delays of a policy; to the end it is an error."""

    def ask(texts: list[str]) -> list[list[float]]:
        for failures in range(1, policy.tries + 1):
            try:
                return encode(texts)
            except Exception as e:  # noqa: BLE001  whatever a service does
                if failures == policy.tries:
                    raise Exhausted(f"a batch of {len(texts)} texts failed {failures} times: {type(e).__name__}: {e}") from e
                wait(policy.delay(failures))
        raise ValueError("a policy tries once at least")

    return ask


def embedded(df: DataFrame, text: str, provider: str = "hash", prefix: str = "", max_tokens: int = 0, into: str = "embedding", **options) -> DataFrame:
    """``df`` with vectors of prefix + text. The provider is built once a task. Texts are whole, unless ``max_tokens`` cuts
    them to so many words first, for a provider whose input is limited."""
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = patient(build_provider(provider, **options))
        for texts in batches:
            cut = [" ".join(t.split()[:max_tokens]) if max_tokens else t for t in texts.fillna("")]
            yield pd.Series(encode([prefix + t for t in cut]))

    return df.withColumn(into, F.pandas_udf(each, "array<float>")(F.col(text)))


def length_batches(df: DataFrame, text: str, key: str, batch_size: int = 32, max_tokens: int = 6144) -> DataFrame:
    """(key, n_tokens, batch): texts in ascending length, a batch closed before it has too many texts or padded tokens.

    Batches are made within partitions, by the tasks that encode them; ``batch`` is unique with the partition's id."""

    def each(frames):
        batch, count = 0, 0
        for frame in frames:
            numbers = []
            for n in frame["n_tokens"]:
                if count and (count + 1 > batch_size or (count + 1) * n > max_tokens):
                    batch, count = batch + 1, 0
                count += 1
                numbers.append(batch)
            yield frame.assign(batch=numbers)

    sized = df.select(key, F.greatest(F.lit(1), F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda x: x != ""))).alias("n_tokens"), F.spark_partition_id().alias("part"))
    kind = df.schema[key].dataType.simpleString()
    return sized.sortWithinPartitions("n_tokens", key).mapInPandas(each, f"{key} {kind}, n_tokens int, part int, batch int")


def embedded_by_length(df: DataFrame, key: str, text: str, provider: str = "hash", prefix: str = "", batch_size: int = 32, max_tokens: int = 6144, parts: int | None = None, **options) -> DataFrame:
    """(key, embedding, n_tokens, batch, n_texts, padded): vectors as ``embedded`` gives them, of texts that are encoded beside texts of their length.

    Texts are dealt by steps of length to parts that hold equally many tokens, so that long texts fill more parts than short
    ones; a step that fills several is cut apart by a hash of the key. They are sorted within, and go to the provider in
    batches that are closed before they hold more than ``batch_size`` texts or ``max_tokens`` padded tokens; a longer text is a
    batch of its own. ``batch`` names a batch with its part, ``n_texts`` is how many texts it has, ``padded`` the length that
    they are padded to. Without ``parts`` there are as many as Spark shuffles to, or more where those would hold over
    ``PART_TOKENS``. Join the vectors to their rows by ``key``."""
    spark = df.sparkSession
    n_tokens = F.size(F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r")), r"\s+"))  # an empty text has one
    bits = F.length(F.bin("n_tokens"))
    step = bits * 2**BITS + F.call_function("shiftright", F.col("n_tokens"), F.greatest(bits - BITS, F.lit(0)))
    sized = df.select(key, F.coalesce(text, F.lit("")).alias("_text"), n_tokens.alias("n_tokens"))
    # 32 rows for each doubling of length at most
    sizes = sized.groupBy(step.alias("_step")).agg(F.sum(F.col("n_tokens") + F.lit(1).cast("long")).alias("n")).orderBy("_step").collect()
    total = sum(r.n for r in sizes)
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_TOKENS))
    ends = [0, *accumulate(r.n for r in sizes)]
    spread = spark.createDataFrame([(r[0], at * parts / total, r.n * parts / total) for r, at in zip(sizes, ends)], "_step int, _first double, _width double")
    at = F.col("_first") + F.col("_width") * F.pmod(F.xxhash64(key), F.lit(1 << 20)) / (1 << 20)
    dealt = sized.withColumn("_step", step).join(F.broadcast(spread), "_step", "left").withColumn("_part", F.least(F.floor(at), F.lit(parts - 1)).cast("int"))
    dealt = dealt.select(key, "_text", "n_tokens", "_part").repartitionById(parts, "_part").drop("_part").sortWithinPartitions("n_tokens", key)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = patient(build_provider(provider, **options))
        number, held = 0, []

        given: list[tuple] = []

        def done() -> None:
            vectors = encode([prefix + t for _, t, _ in held])
            padded = max(n for *_, n in held)
            given.extend((k, v, n, number, len(held), padded) for (k, _, n), v in zip(held, vectors, strict=True))

        def frame_of(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=[key, "embedding", "n_tokens", "_number", "n_texts", "padded"])

        for frame in frames:
            for row in zip(frame[key].tolist(), frame["_text"], frame["n_tokens"].tolist(), strict=True):
                if held and (len(held) == batch_size or (len(held) + 1) * row[2] > max_tokens):
                    done()
                    number, held = number + 1, []
                    if len(given) >= GIVEN:
                        yield frame_of(given)
                        given.clear()
                held.append(row)
        if held:
            done()
            yield frame_of(given)

    kind = df.schema[key].dataType.simpleString()
    found = dealt.mapInPandas(each, f"`{key}` {kind}, embedding array<float>, n_tokens int, _number int, n_texts int, padded int")
    return found.select(key, "embedding", "n_tokens", F.concat_ws("-", F.spark_partition_id(), "_number").alias("batch"), "n_texts", "padded")
