"""Removal of repeated long spans by a compacted De Bruijn graph of words.

An edge is a k-mer of ``size + 1`` words; it leads from the node of its first ``size`` words (a window) to that of its
last ``size``. A node's in- and out-degree count the different words before and after its occurrences. Where a node has
one way out, and the node that follows has one way in, every walk through one goes through both.

1. Texts that are copies as a whole go first: of a class of equal texts (128 bits of hashes) the least doc_id stays in
   the graph, so neither repeated rows nor thousands of copies are looked at again.
2. Candidates: the least of the k-mers of ``K`` words in a window names it, and equal windows have equal names. Only
   windows whose name stands at two or more coordinates go on (counts pre-aggregate before the shuffle).
3. Nodes: candidate windows are grouped by hash, with the first coordinate and the words before and after. Those that
   occur once are dropped.
4. Compaction: a node is joined with the one that stands before it at its first coordinate. Without a branch between
   them both lie on one path, whose first coordinates are consecutive. So a path is a run in its source text, and every
   occurrence of its first node is one of the whole path.
5. Verification: the words of each occurrence are read again at its coordinate and at the source's, and compared by
   SHA-256. Where they differ (hashes collided), the windows of both are grouped once more by their words themselves.
6. What is removed is cut out of the source text by coordinate.

A k-mer, node or path that a third of all texts share is counted by partial aggregation and joined under skew handling;
coordinates are never collected but by text.

Defined results: null and empty texts have no words; texts shorter than a window lose nothing; very long texts are read
whole, in a batch of their own; rows that repeat a doc_id and its text are one document and get the same answer; texts
that share a doc_id only are ordered by a hash of the text; rows without a doc_id come first in that order (a null counts
as the least number); an empty table gives an empty result; extra columns are kept, whatever their names, but a column
named as an output (``spans``, ``cut``) is replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkquill.llm import words
from sparkquill.llm.columns import fresh, own
from sparkquill.shared import stored

WINDOW = 20
K = 8
#: Rows of ids or hashes that are broadcast at most, so that only what they pick is shuffled; beyond, all is.
BROADCAST_IDS = 1_000_000
NO_ID = -(1 << 63)
SPAN = "array<struct<start:int,end:int>>"


def names(kmers: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` k-mers the position of its least one, the leftmost of equals."""
    n = len(kmers) - span + 1
    best, at = kmers[:n].copy(), np.arange(n)
    for j in range(1, span):
        less = kmers[j : j + n] < best
        best[less] = kmers[j : j + n][less]
        at[less] = np.flatnonzero(less) + j
    return at


def runs(kmers: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k-mer position, first window, windows) of the runs of a text: windows in sequence that one k-mer names."""
    at = names(kmers, span)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.diff(np.concatenate([first, [len(at)]]))


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(NO_ID))


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def few(rows: DataFrame) -> bool:
    return rows.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS


def picked(df: DataFrame, rows: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """``df`` joined with stored ``rows``, which are broadcast if they are few."""
    return df.join(F.broadcast(rows) if few(rows) else rows, on, how)


def copies(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(i, t) of texts that equal the text of a smaller id, and whether rows repeat; docs: (i, t, text)."""
    seen = stored(docs.select("i", "t", F.xxhash64(F.lit(1), "text").alias("g")), "seen")
    classes = stored(seen.groupBy("t", "g").agg(F.min("i").alias("least"), F.count("*").alias("c")).filter("c > 1"), "classes")
    again = not seen.groupBy("i", "t").count().filter("count > 1").isEmpty()
    return stored(picked(seen, classes, ["t", "g"]).filter("i > least").select("i", "t").distinct(), "copies"), again


def _runs_of(docs: DataFrame, size: int, k: int) -> DataFrame:
    """(i, t, kmer, start, n) of all runs: n windows from word start on."""
    schema = "i long, t long, kmer long, start int, n int"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text"):
            split = words.split(block.column("text"), words.NOT_SPACE)
            kmers = words.windows(split.hashes, k)
            rows, parts = [], []
            for i in range(len(block)):
                mine = split.of(i)
                if mine.stop - mine.start >= size:
                    at, first, n = runs(kmers[mine.start : mine.stop - k + 1], size - k + 1)
                    parts.append((kmers[mine.start + at], first, n))
                    rows.append(np.full(len(at), i))
            if rows:
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("i").take(take),
                        block.column("t").take(take),
                        pa.array(np.concatenate([p[0] for p in parts]).view(np.int64)),
                        pa.array(np.concatenate([p[1] for p in parts]).astype(np.int32)),
                        pa.array(np.concatenate([p[2] for p in parts]).astype(np.int32)),
                    ],
                    names=["i", "t", "kmer", "start", "n"],
                )

    return docs.mapInArrow(each, schema)


def candidates(docs: DataFrame, size: int, k: int) -> tuple[DataFrame, int]:
    """(d, i, t, text, runs) of the texts that hold runs named by repeated k-mers, and the bits of a position; docs: (i, t, text)
    without repeated rows. ``d`` numbers the texts in the order of i and t, so that ``d << bits | position`` orders all words."""
    every = _runs_of(docs, size, k)  # read twice: cheaper than a stored copy of every run
    # aggregates are stored before they are joined: then both sides of the join come from a shuffle of their own, and a hot k-mer may be split
    many = stored(every.groupBy("kmer").agg(F.count("*").alias("c")).filter("c > 1").select("kmer"), "many")
    held = every.join(many, "kmer").groupBy("i", "t").agg(F.collect_list(F.struct("start", "n")).alias("runs"), F.max(F.col("start") + F.col("n")).alias("last"))
    held = stored(held, "runs")
    # rows of a range-partitioned sort are numbered by partition and row; both are packed as close as their greatest values allow
    numbers = stored(held.select("i", "t", "last").orderBy("i", "t").select("i", "t", "last", F.monotonically_increasing_id().alias("m")), "numbers")
    part, row = F.shiftrightunsigned("m", 33), F.col("m").bitwiseAND((1 << 33) - 1)
    top = numbers.agg(F.max(part).alias("part"), F.max(row).alias("row"), F.max("last").alias("last")).first()
    rows, bits = (top.row or 0) + 1, (top.last or 0).bit_length()
    if ((top.part or 0) + 1) * rows << bits >= 1 << 63:
        raise OverflowError("too many texts for their longest one")
    held = held.join(numbers.select("i", "t", (part * rows + row).alias("d")), ["i", "t"]).select("i", "t", "d", "runs")
    held = stored(held, "held")
    ids = held.select("i", "t")
    if few(ids):
        docs = docs.join(F.broadcast(ids), ["i", "t"], "left_semi")
    return stored(docs.join(held, ["i", "t"]).select("d", "i", "t", "text", "runs"), "candidates"), bits


def nodes(texts: DataFrame, size: int, bits: int, letters: bool, hashed: int = 64) -> DataFrame:
    """(at, node) of each candidate window, with ``hashed`` bits of a hash, and with ``letters`` the words ``before`` and
    ``after`` it: 31 bits of their hashes, -1 where the text begins or ends. texts: (d, text, runs)."""
    schema = "at long, node long" + (", before int, after int" if letters else "")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text"):
            split = words.split(block.column("text"), words.NOT_SPACE)
            hashes = words.windows(split.hashes, size) >> np.uint64(64 - hashed)
            held = block.column("runs")
            text = pc.list_parent_indices(held).to_numpy()
            values = held.flatten()
            start, n = values.field("start").to_numpy(), values.field("n").to_numpy()
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            text, start = np.repeat(text, n), np.repeat(start, n) + inner
            word = split.first[text] + start
            number = block.column("d").to_numpy()[text]
            out = [pa.array((number << bits) | start), pa.array(hashes[word].view(np.int64))]
            if letters:
                short = (split.hashes >> np.uint64(33)).astype(np.int32)
                before = np.where(start > 0, short[np.maximum(word - 1, 0)], -1)
                after = np.where(word + size < split.first[text + 1], short[np.minimum(word + size, len(short) - 1)], -1)
                out += [pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32))]
            whole = pa.RecordBatch.from_arrays(out, names=["at", "node", "before", "after"][: len(out)])
            for i in range(0, len(whole), 100_000):
                yield whole.slice(i, 100_000)

    return texts.select("d", "text", "runs").mapInArrow(each, schema)


def paths(texts: DataFrame, size: int, bits: int, hashed: int = 64) -> DataFrame:
    """(node, at, n) of the compacted paths: their first node, its first coordinate, and the nodes on them."""
    graph = nodes(texts, size, bits, True, hashed).groupBy("node").agg(
        F.count("*").alias("c"), F.min("at").alias("at"), *[f(x).alias(f"{x}_{f.__name__}") for x in ("before", "after") for f in (F.min, F.max)]
    )
    one = lambda x: (F.col(f"{x}_min") == F.col(f"{x}_max")) & (F.col(f"{x}_min") >= 0)
    graph = stored(graph.filter("c > 1").select("node", "at", one("before").alias("one_in"), one("after").alias("one_out")), "nodes")
    ahead = graph.filter("one_out").select((F.col("at") + 1).alias("at"), F.lit(True).alias("linked"))
    graph = graph.join(ahead, "at", "left").select("node", "at", (F.col("one_in") & F.coalesce("linked", F.lit(False))).alias("inner"))
    # the nodes of a path stand in sequence in their source text, which bounds the groups
    by_text = Window.partitionBy(F.shiftright("at", bits)).orderBy("at")
    head = F.max(F.when(~F.col("inner"), F.col("at"))).over(by_text.rowsBetween(Window.unboundedPreceding, 0))
    return stored(graph.withColumn("head", head).groupBy("head").agg(F.count("*").cast("int").alias("n"), F.min_by("node", "at").alias("node")).select("node", F.col("head").alias("at"), "n"), "paths")


def _by_text(texts: DataFrame, spans: DataFrame, bits: int) -> DataFrame:
    """(d, text, spans) of the texts that hold spans (at, n), which come as arrays of (at, n)."""
    grouped = stored(spans.groupBy(F.shiftright("at", bits).alias("d")).agg(F.collect_set(F.struct("at", "n")).alias("spans")), "spans")
    ids = grouped.select("d")
    texts = texts.select("d", "text")
    if few(ids):
        texts = texts.join(F.broadcast(ids), "d", "left_semi")
    return texts.join(grouped, "d")


def _read(texts: DataFrame, size: int, bits: int, single: bool) -> DataFrame:
    """(at, n, words) of spans of n windows, where words are the SHA-256 of the words; with ``single`` of each window, and the
    words themselves. texts: as ``_by_text`` returns them."""
    schema = f"at long, n int, words {'string' if single else 'binary'}"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text"):
            data, offsets = words.text_bytes(block.column("text"))
            starts, ends = words.runs(data, offsets, words.NOT_SPACE)
            first = np.searchsorted(starts, offsets)
            held = block.column("spans")
            text = pc.list_parent_indices(held).to_numpy()
            at, n = held.flatten().field("at").to_numpy(), held.flatten().field("n").to_numpy()
            rows: list[tuple[int, int, bytes]] = []
            for k, place, count in zip(text.tolist(), at.tolist(), n.tolist(), strict=True):
                word, stop = int(first[k]) + (place & ((1 << bits) - 1)), int(first[k + 1])
                to = min(word + count + size - 1, stop)
                own_words = [data[a:b].tobytes() for a, b in zip(starts[word:to].tolist(), ends[word:to].tolist(), strict=True)]
                if single:
                    rows += [(place + j, 1, b" ".join(own_words[j : j + size])) for j in range(len(own_words) - size + 1)]
                else:
                    rows.append((place, count, hashlib.sha256(b" ".join(own_words)).digest()))
                if len(rows) >= 20_000:
                    yield batch(rows)
                    rows = []
            yield batch(rows)

    def batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        found = pa.array([r[2] for r in rows], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), found.cast(pa.string()) if single else found], names=["at", "n", "words"])

    return texts.mapInArrow(each, schema)


def repeats(texts: DataFrame, size: int, bits: int, hashed: int = 64) -> DataFrame:
    """(at, n): n windows from coordinate ``at`` on that stand at an earlier one too; texts: as ``candidates`` returns them."""
    known = paths(texts, size, bits, hashed).withColumnRenamed("at", "source")
    found = stored(picked(nodes(texts, size, bits, False, hashed), known, "node").filter("at != source").select("at", "source", "n"), "occurrences")
    spans = found.select("at", "n").unionByName(found.select(F.col("source").alias("at"), "n").distinct())
    read = stored(_read(_by_text(texts, spans, bits), size, bits, single=False), "read")
    left, right = read.select("at", F.col("words").alias("x")), read.select(F.col("at").alias("source"), F.col("words").alias("y"))
    judged = stored(found.join(left, "at").join(right, "source").select("at", "source", "n", (F.col("x") == F.col("y")).alias("same")), "judged")
    good, bad = judged.filter("same").select("at", "n"), judged.filter("not same")
    if bad.isEmpty():
        return good
    again = bad.select("at", "n").unionByName(bad.select(F.col("source").alias("at"), "n")).distinct()
    single = stored(_read(_by_text(texts, again, bits), size, bits, single=True), "windows")
    first = stored(single.groupBy("words").agg(F.min("at").alias("first"), F.count("*").alias("c")).filter("c > 1").select("words", "first"), "first")
    later = single.join(first, "words").filter("at != first").select("at", "n")
    return good.unionByName(later)


def removed(docs: DataFrame, size: int = WINDOW, k: int = K, hashed: int = 64) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``spans``: what a repeat takes out of the text, as word positions [start, end).

    ``hashed``: bits of a window's hash. The result is the same with few, as words are compared; only the work grows."""
    docs = docs.drop("spans")
    keyed = docs.select(_id().alias("i"), _text().alias("text")).withColumn("t", F.xxhash64("text"))
    gone, again = copies(keyed)
    unique = picked(keyed, gone, ["i", "t"], "left_anti")
    if again:
        unique = unique.groupBy("i", "t").agg(F.first("text").alias("text"))
    texts, bits = candidates(unique, size, k)
    at = F.col("at").bitwiseAND((1 << bits) - 1).cast("int")
    found = repeats(texts, size, bits, hashed).select(F.shiftright("at", bits).alias("d"), at.alias("start"), (at + F.col("n") + size - 1).alias("end"))
    found = found.groupBy("d").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")).join(texts.select("d", "i", "t"), "d").select("i", "t", "spans")
    found = stored(found.unionByName(gone.select("i", "t", F.lit(None).cast(SPAN).alias("spans"))), "removed")
    # names that no column of the input has
    i, t, s = fresh(docs, "i", "t", "s")
    found = found.select(F.col("i").alias(i), F.col("t").alias(t), F.col("spans").alias(s), F.lit(True).alias(fresh(docs, "found")[0]))
    some = F.col(fresh(docs, "found")[0])
    n_words = F.regexp_count(_text(), F.lit(r"[^\x20\x09-\x0D]+"))
    whole = F.when(n_words >= size, F.array(F.struct(F.lit(0).alias("start"), n_words.alias("end"))))
    spans = F.coalesce(F.when(some, F.coalesce(F.col(s), whole)), F.array().cast(SPAN)).cast(SPAN)

    def joined(part: DataFrame) -> DataFrame:
        return part.withColumns({i: _id(), t: F.xxhash64(_text())}).join(found, [i, t], "left").select(*own(docs), spans.alias("spans"))

    ids = found.select(i)
    if not few(ids):
        return joined(docs)
    # texts that lose nothing stay where they are
    ids = F.broadcast(ids.distinct())
    keyed = docs.withColumn(i, _id())
    kept = keyed.join(ids, i, "left_anti").select(*own(docs), F.array().cast(SPAN).alias("spans"))
    return joined(keyed.join(ids, i, "left_semi").select(*own(docs))).unionByName(kept)


RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])


def cut(docs: DataFrame, into: str = "cut", text: str = "text") -> DataFrame:
    """``docs`` (text, spans, ...) with the struct ``into``: words, removed words, and the kept words joined by one space."""
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    docs = docs.drop(into)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, text):
            data, offsets = words.text_bytes(block.column(text))
            starts, ends = words.runs(data, offsets, words.NOT_SPACE)
            first = np.searchsorted(starts, offsets)
            spans = block.column("spans")
            base, values = first[pc.list_parent_indices(spans).to_numpy()], spans.flatten()
            edge = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edge, base + values.field("start").to_numpy(), 1)
            np.add.at(edge, base + values.field("end").to_numpy(), -1)
            stays = np.cumsum(edge[:-1]) == 0
            upto = np.concatenate([[0], np.cumsum(stays)])[first]  # kept words before each text
            a, b = starts[stays], ends[stays]
            last = np.zeros(len(a), bool)
            last[upto[1:][np.diff(upto) > 0] - 1] = True
            # a kept word takes the byte of white space that follows it along, unless it ends the text
            stop = b + ~last
            mark = np.zeros(len(data) + 1, np.int8)
            mark[a] += 1
            mark[stop] -= 1
            spaced = data.copy()
            spaced[b[~last]] = 0x20
            size = np.concatenate([[0], np.cumsum(stop - a)])[upto].astype(np.int32)
            kept = pa.Array.from_buffers(pa.string(), len(block), [None, pa.py_buffer(size), pa.py_buffer(spaced[np.cumsum(mark[:-1], dtype=np.int8) > 0])])
            n = np.diff(first)
            out = pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(n - np.diff(upto), pa.int64()), kept], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*block.columns, out], names=[*block.schema.names, into])

    return docs.mapInArrow(each, T.StructType([*docs.schema.fields, T.StructField(into, RESULT)]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return cut(removed(docs)).select("doc_id", "cut.n_words", "cut.n_removed", F.sha2("cut.kept", 256).alias("kept_sha256"))
