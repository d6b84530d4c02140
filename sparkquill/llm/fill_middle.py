"""Fill-in-middle transformation of whole texts, cut at code points by succinct rank and select.

The bytes of a block of texts become one packed bit vector, a set bit where a code point begins, with a directory that
holds the popcount before each 512 bits. The popcount of a text's bits is its length n; select on two ranks gives the
bytes at which it is cut. No text is turned into a sequence of characters.

Cuts and forms come from a hash of the key, so they do not depend on partitions or on which task runs them. Rows are
independent: there is no shuffle, and a lost executor costs its tasks only.

Defined results: a null text counts as empty and stays plain, as does any text that holds a mark; a null key is hashed as
an empty one; very long texts are cut whole, in a block of their own; rows of equal key and text give equal results; extra
columns are kept, whatever their names, but a column named as the output (``into``) is replaced by it; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkquill.llm import words
from sparkquill.llm.columns import fresh

#: What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OUTPUT = T.StructType([T.StructField(c, T.StringType() if c in ("form", "output") else T.LongType()) for c in ("n", "form", "prefix_chars", "middle_chars", "output")])


class Boundaries:
    """Where code points begin in UTF-8 bytes, as bits with a directory of popcounts."""

    WORDS = 8  # of 64 bits each, in a block of the directory

    def __init__(self, data: np.ndarray):
        bits = np.packbits((data & 0xC0) != 0x80, bitorder="little")
        n_words = -(-len(bits) // (8 * self.WORDS)) * self.WORDS + self.WORDS  # a block of zeros at the end, so that every position has one
        self.bits = np.zeros(n_words, np.uint64)
        self.bits.view(np.uint8)[: len(bits)] = bits
        in_blocks = np.bitwise_count(self.bits).reshape(-1, self.WORDS).sum(axis=1, dtype=np.int64)
        self.directory = np.concatenate([[0], np.cumsum(in_blocks)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many code points begin before each byte."""
        block, inside = np.divmod(at, 64 * self.WORDS)
        left = np.clip(inside[:, None] - 64 * np.arange(self.WORDS), 0, 64).astype(np.uint64)  # bits of each word that count
        mask = np.where(left == 64, ~np.uint64(0), (np.uint64(1) << (left % np.uint64(64))) - np.uint64(1))
        return self.directory[block] + np.bitwise_count(self._words(block) & mask).sum(axis=1, dtype=np.int64)

    def select(self, rank: np.ndarray) -> np.ndarray:
        """The byte at which the code point of each rank begins; ranks count from 0 and must exist."""
        block = np.searchsorted(self.directory, rank, side="right") - 1
        rest = rank - self.directory[block]
        held = self._words(block)
        upto = np.cumsum(np.bitwise_count(held), axis=1, dtype=np.int64)
        word = (upto <= rest[:, None]).sum(axis=1)
        row = np.arange(len(rank))
        rest = rest - np.where(word > 0, upto[row, word - 1], 0)
        each = (held[row, word][:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        bit = (np.cumsum(each, axis=1) <= rest[:, None]).sum(axis=1)
        return block * 64 * self.WORDS + word * 64 + bit

    def _words(self, block: np.ndarray) -> np.ndarray:
        return self.bits.reshape(-1, self.WORDS)[block]


def cut(texts: pa.Array, hashes: np.ndarray, plain_from: int, spm_below: int) -> pa.StructArray:
    """OUTPUT for each text; ``hashes`` has its four numbers as a row."""
    data, offsets = words.text_bytes(texts)
    starts, ends = offsets[:-1], offsets[1:]
    marks = Boundaries(data)
    first = marks.rank(offsets)
    n = np.diff(first)
    ranks = np.sort(hashes[:, :2] % (n + 1)[:, None], axis=1)
    places = []
    for side in range(2):
        inner = np.flatnonzero(ranks[:, side] < n)
        place = ends.copy()
        place[inner] = marks.select(first[inner] + ranks[inner, side])
        places.append(place)
    plain = (n == 0) | (hashes[:, 2] % 100 >= plain_from)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain |= pc.fill_null(pc.match_substring(texts, mark), False).to_numpy(zero_copy_only=False)
    spm = ~plain & (hashes[:, 3] % 100 < spm_below)

    view = memoryview(data)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    out = []
    for a, b, x, y, whole, suffix_first in zip(starts.tolist(), ends.tolist(), *[q.tolist() for q in places], plain.tolist(), spm.tolist(), strict=True):
        if whole:
            out.append(view[a:b].tobytes())
        elif suffix_first:
            out.append(b"".join((s, view[y:b], p, view[a:x], m, view[x:y])))
        else:
            out.append(b"".join((p, view[a:x], s, view[y:b], m, view[x:y])))
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    columns = [
        pa.array(n),
        pa.array(form.tolist(), pa.string()),
        pa.array(ranks[:, 0], pa.int64(), mask=plain),
        pa.array(ranks[:, 1] - ranks[:, 0], pa.int64(), mask=plain),
        pa.array(out, pa.binary()).cast(pa.string()),
    ]
    return pa.StructArray.from_arrays(columns, names=OUTPUT.names)


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", into: str = "fim", seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """``docs`` with the struct ``into``: code points, form (plain, psm or spm), those of prefix and middle, and the text put out.

    Of 100 texts that may be cut, those from ``plain_from`` on stay plain; of the others ``spm_below`` have the suffix first."""
    docs = docs.drop(into)
    (four,) = fresh(docs, "four")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    numbers = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.conv(F.substr(digest, 8 * k + 1, F.lit(8)), 16, 10).cast("long"))
    schema = T.StructType([*docs.schema.fields, T.StructField(into, OUTPUT)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, text):
            at = block.schema.get_field_index(four)
            hashes = np.array(block.column(at).flatten()).reshape(-1, 4)
            found = cut(block.column(text), hashes, plain_from, spm_below)
            own = [i for i in range(block.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[block.column(i) for i in own], found], names=schema.names)

    return docs.withColumn(four, numbers).mapInArrow(each, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that was cut. A cut text holds no mark, and no mark begins as another ends, so the marks split it into its parts."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)
    prefix, suffix = (F.when(form == "psm", F.get(parts, F.lit(i))).otherwise(F.get(parts, F.lit(3 - i))) for i in (1, 2))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = transform(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return docs.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )
