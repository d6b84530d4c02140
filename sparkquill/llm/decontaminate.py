"""Benchmark decontamination: windows of normalised benchmark words in a broadcast hash set, against which the word
windows of every text are scanned; hits are verified on the words themselves, and spans or documents are removed.

The benchmark's size is checked before it is broadcast. A benchmark beyond ``MOST_WORDS`` words is dealt into blocks of
items below that bound; each block is scanned in a pass of its own and the hits of a document are put together by key.

Defined results: a null or empty text has no words and no hits; very long texts are scanned whole, in a batch of their
own; a benchmark item without words has no window; one of fewer words than a window is one window of its own length;
repeated documents are judged alike; repeated items count once by item_id; a null item_id is a hit but no id; an empty
benchmark hits nothing and an empty table gives an empty result; extra columns are kept, whatever their names, but a
column named as the output (``into``) is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkquill.llm import words
from sparkquill.llm.columns import fresh, own
from sparkquill.shared import stored

WINDOW = 10
#: Words of a benchmark block that is broadcast, at most: some 40 bytes each in the index.
MOST_WORDS = 2_000_000
BITS = 22

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.LongType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


def same_words(x: words.Words, at: np.ndarray, y: words.Words, to: np.ndarray, length: int) -> np.ndarray:
    """For each pair of word positions in x and y whether ``length`` words from there on are the same bytes."""
    good = np.ones(len(at), bool)
    for j in range(length):
        left = np.flatnonzero(good)
        i, k = at[left] + j, to[left] + j
        size = x.ends[i] - x.starts[i]
        equal = size == y.ends[k] - y.starts[k]
        i, k, size = x.starts[i[equal]], y.starts[k[equal]], size[equal]
        good[left[~equal]] = False
        if len(size):
            first = np.cumsum(size) - size
            inner = np.arange(int(size.sum())) - np.repeat(first, size)
            alike = x.data[np.repeat(i, size) + inner] == y.data[np.repeat(k, size) + inner]
            good[left[equal]] = np.logical_and.reduceat(alike, first)
    return good


class Index:
    """Windows of a block of benchmark items in flat arrays of some 40 bytes a word: the block's words, and by window length
    the sorted hashes of the distinct windows, where each stands in the block, and the items that hold it."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int):
        split = words.split(pa.array([t for _, t in items], pa.large_string()), words.ALNUM, lower=True)
        self.ids = np.array([i or 0 for i, _ in items], np.int64)
        self.named = np.array([i is not None for i, _ in items], bool)
        n = np.diff(split.first)
        item_of = np.repeat(np.arange(len(items), dtype=np.int32), n)
        self.by_length = {}
        for length in np.unique(np.minimum(n, size)).tolist():
            if not length:
                continue
            keys = words.windows(split.hashes, length)
            inside = np.arange(len(split.starts)) <= (split.first[1:] - length)[item_of]
            at = np.flatnonzero(inside & (np.minimum(n, size) == length)[item_of])
            order = np.lexsort((item_of[at], keys[at]))
            at, keys, item = at[order], keys[at][order], item_of[at][order]
            again = np.zeros(len(at), bool)
            again[1:] = keys[1:] == keys[:-1]
            again[again] = same_words(split, at[again], split, at[np.flatnonzero(again) - 1], length)
            window = np.cumsum(~again) - 1
            fresh_item = ~again
            fresh_item[1:] |= item[1:] != item[:-1]
            first = np.flatnonzero(~again)
            bounds = np.searchsorted(window[fresh_item], np.arange(len(first) + 1))
            maybe = np.zeros(1 << BITS, bool)
            maybe[(keys >> np.uint64(64 - BITS)).astype(np.int64)] = True
            self.by_length[length] = (keys[first], at[first].astype(np.int32), bounds, item[fresh_item], np.packbits(maybe))
        self.words = words.Words(split.data, split.offsets, split.starts.astype(np.int32), split.ends.astype(np.int32), split.first, np.zeros(0, np.uint64))
        self.maybe: dict[int, np.ndarray] = {}

    def scan(self, split: words.Words) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(first words, words of a window, windows) of the occurrences in a block of texts, each as verified on the words."""
        text_of = None
        for length, (keys, place, _, _, packed) in self.by_length.items():
            got = words.windows(split.hashes, length)
            if not len(got):
                continue
            if length not in self.maybe:
                self.maybe[length] = np.unpackbits(packed).astype(bool)
            at = np.flatnonzero(self.maybe[length][(got >> np.uint64(64 - BITS)).astype(np.int64)])
            if text_of is None:
                text_of = np.repeat(np.arange(len(split.first) - 1), np.diff(split.first))
            at = at[text_of[at] == text_of[at + length - 1]]  # a window stays within one text
            left = np.searchsorted(keys, got[at], "left")
            while len(at):  # once, and again where hashes of different windows collide
                hit = keys[np.minimum(left, len(keys) - 1)] == got[at]
                hit &= left < len(keys)
                at, left = at[hit], left[hit]
                good = same_words(split, at, self.words, place[left], length)
                if good.any():
                    yield at[good], length, left[good]
                left = left + 1

    def items(self, length: int, windows: np.ndarray) -> np.ndarray:
        """Numbers of the items that hold any of these windows."""
        _, _, bounds, item, _ = self.by_length[length]
        return np.unique(np.concatenate([item[bounds[w] : bounds[w + 1]] for w in windows.tolist()]))


def _scan(docs: DataFrame, index, text: str, into: str) -> DataFrame:
    """``docs`` with the struct ``into``: words, hit words, items and hit spans of words [first, end)."""
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())), ("spans", pa.list_(pa.list_(pa.int32())))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for block in words.blocks(batches, text):
            split = words.split(block.column(text), words.ALNUM, lower=True)
            covered = np.zeros(len(split.starts) + 1, np.int32)
            held: dict[int, list[np.ndarray]] = {}
            for at, length, windows in known.scan(split):
                np.add.at(covered, at, 1)
                np.add.at(covered, at + length, -1)
                pairs = np.unique(np.stack([np.searchsorted(split.first, at, "right") - 1, windows]), axis=1)
                for k in np.unique(pairs[0]).tolist():
                    held.setdefault(k, []).append(known.items(length, pairs[1][pairs[0] == k]))
            hit = np.cumsum(covered)[:-1] > 0
            upto = np.concatenate([[0], np.cumsum(hit)])
            out = []
            for k in range(len(block)):
                a, b = int(split.first[k]), int(split.first[k + 1])
                spans, items = [], []
                if k in held:
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]])))
                    spans = edges.reshape(-1, 2).tolist()
                    own_items = np.unique(np.concatenate(held[k]))
                    items = np.unique(known.ids[own_items[known.named[own_items]]]).tolist()
                out.append({"n_words": b - a, "n_hit": int(upto[b] - upto[a]), "items": items, "spans": spans})
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(out, kind)], names=[*block.schema.names, into])

    return docs.mapInArrow(each, T.StructType([*docs.schema.fields, T.StructField(into, HITS)]))


def _blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``most`` words, read one after the other; a block fits the driver and a broadcast."""
    block, total = [], 0
    for row in benchmark.toLocalIterator(prefetchPartitions=False):
        n = len(row[1] or "") // 2 + 1
        if block and total + n > most:
            yield block
            block, total = [], 0
        block.append((row[0], row[1]))
        total += n
    if block:
        yield block


def find(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text: str = "text", into: str = "hits", most: int = MOST_WORDS, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``docs`` with the struct ``into`` of the benchmark (item_id, text) windows that a text holds.

    A benchmark of one block is scanned in one pass without a shuffle. Of a larger one each block has a pass of its own,
    which writes the hits of the documents that it hits, and no texts; they are put together by ``key`` and a digest of the text."""
    spark = docs.sparkSession
    docs = docs.drop(into)
    parts = _blocks(benchmark.select("item_id", "text"), most)
    first, second = next(parts, []), next(parts, None)
    send = lambda block: spark.sparkContext.broadcast(Index(block, size))
    if second is None:
        return _scan(docs, send(first), text, into)
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    base = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], F.col(text).alias("text"), digest.alias("t"))
    keys = [f"k{i}" for i in range(len(key))]

    def hits(block: list[tuple]) -> DataFrame:
        found = _scan(base, send(block), "text", "hits").filter("hits.n_hit > 0").select(*keys, "t", "hits.spans", "hits.items")
        return stored(found.dropDuplicates([*keys, "t"]), "hits")

    every = hits(first)
    while second is not None:
        every = every.unionByName(hits(second))
        second = next(parts, None)
    words_hit = F.array_sort(F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_list("spans")), lambda s: F.sequence(s[0], s[1] - 1)))))
    together = every.groupBy(*keys, "t").agg(words_hit.alias("w"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    here, there, n = fresh(docs, "t", "found", "n")
    together = together.select(F.struct(*keys, "t").alias(here), F.struct("w", "items").alias(there))
    counted = _scan(docs, send([]), text, n)
    on = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], digest.alias("t"))
    joined = counted.join(together, on.eqNullSafe(F.col(here)), "left")
    w = F.col(f"{there}.w")
    firsts = F.filter(w, lambda x, i: (i == 0) | (x - F.get(w, i - 1) > 1))
    lasts = F.filter(w, lambda x, i: F.coalesce(F.get(w, i + 1) - x > 1, F.lit(True)))
    whole = F.struct(
        F.col(f"{n}.n_words").alias("n_words"),
        F.coalesce(F.size(w), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.col(f"{there}.items"), F.array().cast("array<bigint>")).alias("items"),
        F.coalesce(F.zip_with(firsts, lasts, lambda a, b: F.array(a, b + 1)), F.array().cast("array<array<int>>")).alias("spans"),
    )
    return joined.select(*own(docs), whole.alias(into))


def removed(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    (hits,) = fresh(docs, "hits")
    return find(docs, benchmark, into=hits, **options).filter(F.col(hits)["n_hit"] == 0).drop(hits)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_join(F.array_sort(F.col("hits.items").cast("array<string>")), ",")
    return found.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )
