"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds what the patterns miss.

The field tags each token of a text as begin (B), inside (I) or outside (O) of a secret. Its features are the token's
shape, the words and marks next to it, and features of the file (the whole text). It is fitted on the driver by gradient
ascent on the exact log-likelihood, over pieces of at most ``TRAIN_ROWS`` texts, of ``TRAIN_PIECE`` characters each (at a
place that the text's hash draws, so that texts of any length are in the sample) and ``TRAIN_CHARS`` together: their
tokens are labelled by the patterns, and secrets of known formats, drawn from a fixed seed, are set into copies of their
lines. The sample is of distinct texts, chosen by hash in Spark, so that the driver gets some ``TRAIN_ROWS`` pieces
however large the table is. Tagging covers every token of every text. Decoding is Viterbi; tokens that must be outside whatever their neighbours are
(their margin beats any change of transitions) cut the chain first, which leaves the best path as it is.

Rows are independent, so the scan has no shuffle. Defined results: a null or empty text has no secrets; equal texts get
equal spans within a run; very long texts are tagged whole, in a batch of their own; spans count code points, end
exclusive; an added span never overlaps one of a pattern; an empty table is tagged with a field fitted on the drawn
secrets alone; extra columns are kept, whatever their names, but a column named as the output (``into``) is replaced.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkquill.llm import words

TRAIN_ROWS, TRAIN_PIECE, TRAIN_CHARS = 200, 1300, 1 << 18
#: Bytes of text that are tagged at a time, about; features and scores of its tokens take some 40 times as much.
BLOCK_BYTES = 1 << 20
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a longest run, as [0-9a-f]+ of 24 or more is

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

KEYWORDS = "password passwd pwd pass secret token key apikey api_key api-key bearer authorization auth access_key secret_key private credential credentials".split()
TOKEN = words.byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)) | np.isin(np.arange(256), list(b"+/_.-"))
DIGIT, UPPER, LOWER = words.byte_table((0x30, 0x39)), words.byte_table((0x41, 0x5A)), words.byte_table((0x61, 0x7A))
MARK, HIGH = np.isin(np.arange(256), list(b"+/_-")), words.byte_table((0x80, 0xFF))
CLASS = (DIGIT * 1 + UPPER * 2 + LOWER * 3 + MARK * 4 + HIGH * 5).astype(np.uint8)
LENGTHS = np.array([4, 8, 12, 16, 20, 24, 32, 40, 64])
N_FEATURES = 64
B, I, O = 0, 1, 2  # noqa: E741


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """What the fixed patterns find, by start and then kind as listed."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


class Tokens:
    """The tokens of a block of texts with their features: column indices of active features, -1 for none."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = words.text_bytes(column)
        self.starts, self.ends = words.runs(self.data, self.offsets, TOKEN)
        self.first = np.searchsorted(self.starts, self.offsets)
        n = len(self.starts)
        self.active = np.full((n, 14), -1, np.int8)
        if not n:
            return
        data, starts, ends = self.data, self.starts, self.ends
        cut = np.stack([starts, ends], 1).ravel()
        padded = np.concatenate([CLASS[data], [0]])

        def count(of: np.ndarray) -> np.ndarray:
            return np.add.reduceat(of, cut, dtype=np.int32)[::2]

        length = ends - starts
        n_digit, n_upper, n_lower, n_mark, n_high = (count(padded == k) for k in range(1, 6))
        change = np.zeros(len(padded), bool)
        change[1:] = padded[1:] != padded[:-1]
        n_change = count(change) - change[starts]
        text_of = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))
        before = np.where(starts > self.offsets[text_of], data[np.maximum(starts - 1, 0)], 10)
        lowered = words.LOWER[data]
        short = np.flatnonzero(length <= 16)
        known = np.zeros(n, bool)
        keys = words.hash_runs(*_joined(KEYWORDS))
        known[short] = np.isin(words.hash_runs(lowered, starts[short], ends[short]), keys)
        near = lambda k: np.concatenate([np.zeros(k, bool), known[:-k]])[:n] & (np.arange(n) - self.first[text_of] >= k)
        a = self.active
        a[:, 0] = 0  # bias
        a[:, 1] = 1 + np.searchsorted(LENGTHS, length, "right")  # 1..10
        share = n_digit / length
        a[:, 2] = 11 + np.where(n_digit == 0, 0, np.where(share < 0.15, 1, np.where(share < 0.5, 2, np.where(share < 1, 3, 4))))  # 11..15
        letters = (n_upper > 0) * 2 + (n_lower > 0)
        a[:, 3] = 16 + letters  # 16..19
        a[:, 4] = 20 + np.minimum(3, n_mark)  # 20..23
        a[:, 5] = 24 + (n_high > 0)  # 24..25
        rate = n_change / length
        a[:, 6] = 26 + np.where(length < 12, 0, np.where(rate < 0.12, 1, np.where(rate < 0.3, 2, np.where(rate < 0.5, 3, 4))))  # 26..30
        a[:, 7] = 31 + np.select([before == 61, before == 58, (before == 34) | (before == 39), before == 32, before == 10], [0, 1, 2, 3, 4], 5)  # 31..36
        a[:, 8] = np.where(near(1), 37, np.where(near(2), 38, 39))
        a[:, 9] = np.where(known, 40, 41)
        mixed = (n_digit > 0) & (letters > 0) & (length >= 16)
        a[:, 10] = np.where(mixed & (n_high == 0), 42 + np.minimum(3, n_digit // 4), 46)  # 42..46
        marks = np.add.reduceat(np.concatenate([np.isin(data, list(b"=:;{}")), [False]]), np.minimum(self.offsets[:-1], len(data)), dtype=np.int64)
        size = np.maximum(1, np.diff(self.offsets))
        a[:, 11] = (47 + np.where(marks * 200 > size, 2, np.where(marks * 2000 > size, 1, 0)))[text_of]  # 47..49
        dots = count(np.concatenate([data == 46, [False]]))
        a[:, 12] = 50 + np.minimum(3, dots)  # 50..53
        follows = np.concatenate([[False], (starts[1:] - ends[:-1] == 1) & (text_of[1:] == text_of[:-1]) & (data[np.minimum(ends[:-1], len(data) - 1)] == 10)])
        whole_line = follows & (length >= 40)
        a[:, 13] = np.where(whole_line, 54, 55)


def _joined(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    return np.frombuffer("".join(parts).encode(), np.uint8), ends - sizes, ends


class Field:
    """Weights of emissions (feature, tag), transitions (tag, tag), and of the first tag."""

    def __init__(self):
        self.emit = np.zeros((N_FEATURES, 3))
        self.move = np.zeros((3, 3))
        self.open = np.zeros(3)

    def scores(self, active: np.ndarray) -> np.ndarray:
        return sum((self.emit[active[:, k]] for k in range(active.shape[1])), np.zeros((len(active), 3)))

    def fit(self, active: np.ndarray, tags: np.ndarray, first: np.ndarray, rounds: int = 80, length: int = 32) -> Field:
        """Adam on the log-likelihood of pieces of ``length`` tokens. Transitions get the stronger penalty."""
        pieces = [(i, min(i + length, b)) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True) for i in range(a, b, length)]
        if not pieces:
            return self
        index = np.full((len(pieces), length), -1)
        for r, (a, b) in enumerate(pieces):
            index[r, : b - a] = np.arange(a, b)
        real = index >= 0
        design = np.zeros((len(active), N_FEATURES), np.float32)
        for k in range(active.shape[1]):
            design[np.arange(len(active)), active[:, k]] = 1
        gold = np.eye(3)[tags]
        y = np.where(real, tags[index], O)
        gold_move = np.zeros((3, 3))
        np.add.at(gold_move, (y[:, :-1][real[:, 1:]], y[:, 1:][real[:, 1:]]), 1)
        gold_open = np.bincount(y[:, 0], minlength=3)
        params = [self.emit, self.move, self.open]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, rounds + 1):
            e = (design @ self.emit.astype(np.float32)).astype(np.float64)
            e = np.where(real[:, :, None], e[index], 0.0)
            seen = np.exp(e - e.max(axis=2, keepdims=True))
            move = np.exp(self.move)
            alpha, scale = np.zeros_like(e), np.ones((length, len(pieces), 1))
            for t in range(length):
                new = (alpha[:, t - 1] @ move if t else np.exp(self.open)) * seen[:, t]
                scale[t] = np.where(real[:, t, None], new.sum(axis=1, keepdims=True), 1)
                alpha[:, t] = np.where(real[:, t, None], new / scale[t], alpha[:, t - 1])
            beta = np.ones_like(e)
            moves = np.zeros((3, 3))
            for t in range(length - 2, -1, -1):
                ahead = np.where(real[:, t + 1, None], seen[:, t + 1] * beta[:, t + 1] / scale[t + 1], 0)
                beta[:, t] = np.where(real[:, t + 1, None], ahead @ move.T, 1)
                moves += move * (alpha[:, t].T @ ahead)
            belief = alpha * beta
            flat = np.zeros((len(active), 3))
            flat[index[real]] = belief[real]
            grads = [design.T @ (gold - flat) - 0.02 * self.emit, gold_move - moves - 4.0 * self.move, gold_open - belief[:, 0].sum(axis=0) - 4.0 * self.open]
            for p, g, a, b in zip(params, grads, m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p += 0.15 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best tags of each text's tokens."""
        tags = np.full(len(scores), O, np.int8)
        if not len(scores):
            return tags
        move = self.move
        begins = np.concatenate([move, self.open[None]])  # the tag before, or none
        ends = np.concatenate([move, np.zeros((3, 1))], axis=1)  # the tag after, or none
        gain = [max(begins[a, y] - begins[a, O] for a in range(4)) + max(ends[y, b] - ends[O, b] for b in range(4)) for y in (B, I)]
        unsure = np.flatnonzero((scores[:, O] - scores[:, B] <= gain[0]) | (scores[:, O] - scores[:, I] <= gain[1]))
        if not len(unsure):
            return tags
        text_of = np.searchsorted(first, unsure, "right")
        breaks = np.flatnonzero((np.diff(unsure) > 1) | (np.diff(text_of) > 0)) + 1
        starts_text, ends_text = set(first.tolist()), set((first - 1).tolist())
        for run in np.split(unsure, breaks):
            a, b = int(run[0]), int(run[-1]) + 1
            best = (self.open if a in starts_text else move[O]) + scores[a]
            back = []
            for t in range(a + 1, b):
                options = best[:, None] + move
                back.append(options.argmax(axis=0))
                best = options.max(axis=0) + scores[t]
            tag = int((best + (0 if b - 1 in ends_text else move[:, O])).argmax())
            for t in range(b - 1, a, -1):
                tags[t] = tag
                tag = int(back[t - a - 1][tag])
            tags[a] = tag
        return tags


def _drawn(rng: random.Random) -> tuple[str, str]:
    """A secret of a known format and the words that lead to it."""
    def of(chars: str, n: int) -> str:
        return "".join(rng.choice(chars) for _ in range(n))

    mixed, deep = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    kind = rng.randrange(9)
    secret = (
        lambda: "ghp_" + of(mixed, 36),
        lambda: "sk_live_" + of(mixed, rng.randint(24, 40)),
        lambda: "xoxb-" + of(string.digits, 12) + "-" + of(mixed, 24),
        lambda: "eyJ" + of(mixed, 30) + "." + of(mixed + "-_", 60) + "." + of(mixed + "-_", 43),
        lambda: of(deep, 40),
        lambda: of(mixed, rng.randint(20, 44)),
        lambda: "AIza" + of(mixed + "-_", 35),
        lambda: of("0123456789abcdef", rng.choice((32, 40, 64))),
        lambda: "\n".join(of(deep, 64) for _ in range(rng.randint(2, 5))),
    )[kind]()
    lead = rng.choice(("Bearer ", "Authorization: Bearer ", "key ", "secret is ", "key: ", 'pwd="', "auth=", "credentials: ", "", "", "-> "))
    return secret, "private key\n" if kind == 8 else lead


def training_set(texts: list[str], seed: int = 11) -> tuple[list[str], list[list[tuple[int, int]]]]:
    """Texts with the code point spans of their secrets: as the patterns label them, and lines with a drawn secret set in."""
    rng = random.Random(seed)
    texts = texts or ["a line of plain words, with a number 12 and a date 2020-01-02\nand one more line without anything"]
    out, spans = list(texts), [[(s, e) for _, s, e in _values(t)] for t in texts]
    for k in range(max(400, len(texts))):
        lines = [x for x in texts[k % len(texts)].split("\n") if x.strip() and not base_spans(x)] or ["plain words"]
        parts = rng.choice(lines).split(" ")
        at = rng.randint(0, len(parts))
        secret, lead = _drawn(rng)
        head = " ".join(parts[:at]) + (" " if at else "") + lead
        out.append(head + secret + rng.choice(("", " ", '"', ".", "\n", ", ")) + " ".join(parts[at:]))
        spans.append([(len(head), len(head) + len(secret))])
    return out, spans


def _values(text: str) -> list[tuple[str, int, int]]:
    """Pattern spans without the words that lead to the value."""
    found = [("assign", m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    return found + [x for x in base_spans(text) if x[0] != "assign"]


def fit(texts: list[str]) -> Field:
    texts, spans = training_set(texts)
    tokens = Tokens(pa.array(texts, pa.large_string()))
    tags = np.full(len(tokens.starts), O, np.int8)
    for k, (text, own) in enumerate(zip(texts, spans, strict=True)):
        base = int(tokens.offsets[k])
        for start, end in own:
            a, b = base + len(text[:start].encode()), base + len(text[:end].encode())
            inside = np.arange(np.searchsorted(tokens.starts, a), np.searchsorted(tokens.starts, b))
            tags[inside] = I
            tags[inside[:1]] = B
    return Field().fit(tokens.active, tags, tokens.first)


def scan(field: Field, column: pa.Array) -> list[list[tuple[str, int, int]]]:
    """Spans of each text by start, those of the field with kind ``crf``."""
    tokens = Tokens(column)
    tags = field.decode(field.scores(tokens.active), tokens.first)
    found = [base_spans(text or "") for text in column.to_pylist()]
    hits = np.flatnonzero(tags != O)
    text_of = np.searchsorted(tokens.first, hits, "right") - 1
    added: list[tuple[int, int, int]] = []
    for t, k in zip(hits.tolist(), text_of.tolist(), strict=True):
        if added and tags[t] == I and added[-1][0] == k and t == last + 1:  # noqa: F821
            added[-1] = (k, added[-1][1], int(tokens.ends[t]))
        else:
            added.append((k, int(tokens.starts[t]), int(tokens.ends[t])))
        last = t  # noqa: F841
    points = np.zeros(len(tokens.data) + 1, np.int32)  # code points before each byte
    if added:
        np.cumsum((tokens.data & 0xC0) != 0x80, out=points[1:])
    at, starts, reach, last_end = -1, [], [], 0
    for k, a, b in added:
        while b < tokens.offsets[k + 1] and tokens.data[b] == 61:
            b += 1
        if k != at:  # pattern spans by start, and how far those up to each reach
            by_start = sorted((s, e) for _, s, e in found[k])
            at, starts, reach, last_end = k, [s for s, _ in by_start], list(accumulate((e for _, e in by_start), max)), 0
        start, end = int(points[a] - points[tokens.offsets[k]]), int(points[b] - points[tokens.offsets[k]])
        before = bisect_left(starts, end)
        if last_end <= start and not (before and reach[before - 1] > start):
            found[k].append(("crf", start, end))
            last_end = end
    order = {kind: i for i, kind in enumerate((*KINDS, "crf"))}
    return [sorted(x, key=lambda s: (s[1], order[s[0]])) for x in found]


def sample(docs: DataFrame, text: str = "text", rows: int = TRAIN_ROWS, piece: int = TRAIN_PIECE, chars: int = TRAIN_CHARS) -> list[str]:
    """Pieces of at most ``rows`` distinct texts of any length, the same for the same table, of ``chars`` characters together
    at most. Texts are chosen by the least hashes; a bound on the hash, from about how many distinct texts there are, keeps
    the others in Spark. Copies of a text change nothing."""
    h = F.xxhash64(text)
    kinds = docs.filter(F.length(text) > 0).select(F.approx_count_distinct(h)).first()[0]
    share = min(1.0, 4 * rows / max(1, kinds))
    place = F.pmod(h, F.greatest(F.lit(1), F.char_length(text) - piece + 1)).cast("int")
    few = docs.filter((F.length(text) > 0) & (F.pmod(h, F.lit(1 << 31)) < int(share * (1 << 31)))).select(h.alias("h"), F.substring(F.col(text), place + 1, F.lit(piece)).alias("piece"))
    picked = few.groupBy("h").agg(F.min("piece").alias("piece")).orderBy("h").limit(rows).collect()
    out, total = [], 0
    for row in picked:
        total += len(row.piece)
        if total > chars:
            break
        out.append(row.piece)
    return out


def find(docs: DataFrame, text: str = "text", into: str = "secrets", field: Field | None = None) -> DataFrame:
    """``docs`` with the array ``into`` of (kind, start, end)."""
    spark, docs = docs.sparkSession, docs.drop(into)
    shared = spark.sparkContext.broadcast(field or fit(sample(docs, text)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, text, BLOCK_BYTES):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in scan(shared.value, block.column(text))]
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(spans, ARROW_SPANS)], names=[*block.schema.names, into])

    return docs.mapInArrow(each, T.StructType([*docs.schema.fields, T.StructField(into, SPANS)]))


def masked(text: str | None, spans: list[tuple[str, int, int]], mark: str) -> str | None:
    """``text`` with a mark for each span; overlapping spans, by start, are one."""
    if not spans:
        return text
    out, done = [], 0
    for _, start, end in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", field: Field | None = None) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``; overlapping spans are one."""
    shared = docs.sparkSession.sparkContext.broadcast(field or fit(sample(docs, text)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, text, BLOCK_BYTES):
            column = block.column(text)
            clean = [masked(t, spans, mark) for t, spans in zip(column.to_pylist(), scan(shared.value, column), strict=True)]
            at = block.schema.get_field_index(text)
            yield block.set_column(at, block.schema.field(at), pa.array(clean, block.schema.field(at).type))

    return docs.mapInArrow(each, docs.schema)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    spans = F.col("secrets")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(*KINDS))), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )
