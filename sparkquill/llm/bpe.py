"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary (hash and displace): it resolves the pre-tokens that are already
in the vocabulary, with vectorised probes of the distinct pre-tokens of a block. Tier two merges the bytes of the
misses, kept as a linked list, in the order of a heap of ranked pairs.

The vocabulary is a fixed file of some 50,000 entries; its size bounds what is broadcast. Rows are independent: there is
no shuffle, and a lost executor costs its tasks only.

Defined results: a null text counts as empty and has no ids; null ids decode to no bytes; very long texts are encoded
whole, in a batch of their own; repeated rows are encoded alike; extra columns are kept, whatever their names, but a
column named as the output (``into``) is replaced by it; an empty table gives an empty result; special tokens are
ordinary text.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkquill.llm import words

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Misses whose ids a task remembers between blocks, at most.
MEMO = 400_000


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    found = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [found[i] for i in range(len(found))]


def hash_two(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each string or binary value."""
    data, offsets = words.text_bytes(column) if not pa.types.is_large_binary(column.type) else _binary(column)
    starts, ends = offsets[:-1], offsets[1:]
    full = ends > starts
    one = np.zeros(len(starts), np.uint64)
    one[full] = words.hash_runs(data, starts[full], ends[full])
    return one, words.mix(one ^ np.uint64(0xD6E8FEB86659FD93))


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class PerfectHash:
    """Maps each of n distinct keys to its own slot of n: buckets by the first hash, a displacement per bucket that
    sends its keys to free slots, the buckets of one key straight to a free slot (a negative displacement)."""

    def __init__(self, keys: list[bytes]):
        self.size = n = len(keys)
        one, two = hash_two(pa.array(keys, pa.large_binary()))
        self.buckets = max(1, n // 3)
        bucket = (one % np.uint64(self.buckets)).astype(np.int64)
        self.shift = np.zeros(self.buckets, np.int64)
        taken = np.zeros(n, bool)
        self.key_at = np.full(n, -1, np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for b in np.argsort(bounds[:-1] - bounds[1:], kind="stable"):
            mine = order[bounds[b] : bounds[b + 1]]
            if len(mine) < 2:
                break
            d, slots = self._free_displacement(two[mine], taken)
            self.shift[b] = d
            taken[slots] = True
            self.key_at[slots] = mine
        free = iter(np.flatnonzero(~taken).tolist())
        for b in np.flatnonzero(np.diff(bounds) == 1):
            slot = next(free)
            self.shift[b] = -slot - 1
            self.key_at[slot] = order[bounds[b]]

    def _free_displacement(self, two: np.ndarray, taken: np.ndarray, step: int = 256) -> tuple[int, np.ndarray]:
        """The least displacement that sends the keys of a bucket to free slots, each to its own."""
        for first in range(1, 1 << 24, step):
            slots = np.sort(self._slots(two, np.arange(first, first + step)[:, None]), axis=1)
            good = ~taken[slots].any(axis=1) & (np.diff(slots, axis=1) > 0).all(axis=1)
            if good.any():
                d = first + int(good.argmax())
                return d, self._slots(two, d)
        raise ValueError("keys are not distinct")

    def _slots(self, two: np.ndarray, d) -> np.ndarray:
        return (words.mix(two + np.asarray(d, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.size)).astype(np.int64)

    def probe(self, column: pa.Array) -> np.ndarray:
        """For each value the only key that it can be."""
        one, two = hash_two(column)
        d = self.shift[(one % np.uint64(self.buckets)).astype(np.int64)]
        slots = np.where(d < 0, -d - 1, self._slots(two, np.maximum(d, 0)))
        return self.key_at[slots]


class Encoder:
    def __init__(self, tokens: list[bytes], pattern: str = public_tokenizers.PATTERN):
        self.tokens, self.pattern = tokens, pattern
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.hash = PerfectHash(tokens)
        self.pairs = [-1] * 65536
        for token, i in self.ranks.items():
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = i
        self.memo: dict[str, array] = {}
        self.find = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"find": None, "memo": {}}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece that is no token: merge the adjacent pair of least rank, the leftmost of equals, until none is left."""
        ranks, pairs = self.ranks, self.pairs
        n = len(piece)
        end = list(range(1, n + 1))  # of the part that starts here; 0 once it is merged away
        left = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i, (a, b) in enumerate(zip(piece, piece[1:])) if (r := pairs[a << 8 | b]) >= 0]  # noqa: B905
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            middle = end[i]
            if not middle or middle >= n or not end[middle] or end[middle] != stop:
                continue  # one of the two parts has changed since
            end[i], end[middle] = stop, 0
            if stop < n:
                left[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heappush(heap, (r, i, end[stop]))
            if (j := left[i]) >= 0 and (r := ranks.get(piece[j:stop])) is not None:
                heappush(heap, (r, j, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def distinct(self, pieces: pa.Array) -> list[array | list[int]]:
        """Ids of each of the distinct pre-tokens."""
        found, memo, tokens = [], self.memo, self.tokens
        for text, key in zip(pieces.to_pylist(), self.hash.probe(pieces).tolist(), strict=True):
            piece = text.encode()
            if piece == tokens[key]:
                found.append([key])
                continue
            ids = memo.get(text)
            if ids is None:
                ids = array("i", self.merge(piece))
                if len(memo) >= MEMO:
                    memo.clear()
                if len(text) <= 64:
                    memo[text] = ids
            found.append(ids)
        return found

    def encode(self, texts: list[str | None]) -> pa.Array:
        self.find = self.find or regex.compile(self.pattern).findall
        pieces: list[str] = []
        ends = [0]
        for text in texts:
            pieces += self.find(text or "")
            ends.append(len(pieces))
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        del pieces
        ids = self.distinct(coded.dictionary)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum()))
        first = np.cumsum(sizes) - sizes
        each = sizes[at]
        upto = np.concatenate([[0], np.cumsum(each)])
        out = flat[np.repeat(first[at] - upto[:-1], each) + np.arange(upto[-1])]
        return pa.ListArray.from_arrays(pa.array(upto[ends], pa.int32()), pa.array(out))


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def encode(docs: DataFrame, text: str = "text", into: str = "ids", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with the token ids of ``text`` as an array column."""
    docs = docs.drop(into)
    shared = docs.sparkSession.sparkContext.broadcast(Encoder(read_ranks(path or public_tokenizers.path(VOCABULARY)), pattern))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for block in words.blocks(batches, text, 2 << 20):
            yield _with(block, into, encoder.encode(block.column(text).to_pylist()))

    return docs.mapInArrow(each, T.StructType([*docs.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, ids: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """``docs`` with the bytes that the token ids stand for."""
    docs = docs.drop(into)
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path or public_tokenizers.path(VOCABULARY)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = np.array(shared.value, object)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                column = part.column(ids)
                bounds = column.offsets.to_numpy()
                flat = column.values.to_numpy(zero_copy_only=False)
                found = [b"".join(tokens[flat[a:b]].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield _with(part, into, pa.array(found, pa.binary()))

    return docs.mapInArrow(each, T.StructType([*docs.schema.fields, T.StructField(into, T.BinaryType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = encode(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text")
    return decode(docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
