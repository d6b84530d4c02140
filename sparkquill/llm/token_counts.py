"""Token counts of whole texts by a BPE vocabulary with word ends: whole words are looked up, only the rest is merged.

Offline, on the driver, each vocabulary string that ends a word is encoded by its own merges; those that come out as one
token again are proven whole. In tasks a pre-token that is a proven string counts one without a merge; each other distinct
pre-token of a block is merged once, by a heap of ranked pairs over a linked list.

Texts are put into Unicode's composed form and lower case and split by the vocabulary's own pattern. Characters that
versions of Unicode class differently (DOUBTFUL) are left to the vocabulary's own normaliser and splitter.

The vocabulary is a fixed file; its size bounds what is broadcast. Rows are independent: there is no shuffle, and a lost
executor costs its tasks only.

Defined results: a null text counts as empty and has no bytes and no tokens; strings of special tokens within a text count
one token each, in their exact case; very long texts are counted whole, in a block of their own and in parts cut at spaces; repeated rows count alike;
extra columns are kept, whatever their names, but a column named as the output (``into``) is replaced by it; an empty table
gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from sparkquill.llm import words

VOCABULARY = "word_bpe_49k.json"
#: Merged pre-tokens that a task remembers between blocks, at most.
MEMO = 400_000
#: Characters of a text that are split at a time.
PART_CHARS = 1 << 20
SPACE = re.compile("[\x20\x09-\x0D]")
#: Code points whose class or lower case changed between versions of Unicode, with margins: a test compares all others.
DOUBTFUL = (
    r"[\u0558\u058B\u058C\u088F\u0C5C\u0CDC\u1C89\u208F\u209D-\u209F\uA7CB-\uA7F1\uAB6C\uAB6D"
    r"\U00010000-\U0001EFFF\U00020000-\U0010FFFF]"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """The merges of a vocabulary whose tokens at the end of a word carry ``end``."""

    def __init__(self, model: dict):
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.letter = {b: c for c, b in byte_letters().items()}
        self.inner = [ids[self.letter[b]] for b in range(256)]
        self.last = [ids[self.letter[b] + end] for b in range(256)]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs.setdefault((ids[a], ids[b]), (rank, ids[a + b]))

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token: merge the adjacent pair of least rank, the leftmost of equals, until none is left."""
        pairs, n = self.pairs, len(piece)
        ids = [self.inner[b] for b in piece[:-1]] + [self.last[piece[-1]]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*found, i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := pairs.get((ids[i], ids[i + 1])))]
        heapify(heap)
        while heap:
            _, new, i, a, b = heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has changed since
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := pairs.get((new, ids[k])):
                    heappush(heap, (*found, i, new, ids[k]))
            if (h := before[i]) >= 0 and (found := pairs.get((ids[h], new))):
                heappush(heap, (*found, h, ids[h], new))
        return [i for i in ids if i >= 0]


def proven_whole(model: dict, merges: Merges) -> frozenset[str]:
    """The words that the vocabulary holds as one token and that its merges do encode as that token alone."""
    byte_of, end = byte_letters(), model["end_of_word_suffix"]
    found = []
    for token, own in model["vocab"].items():
        if not token.endswith(end) or token == end:
            continue
        piece = bytes(byte_of[c] for c in token.removesuffix(end))
        if merges.merge(piece) != [own]:
            continue
        try:
            found.append(piece.decode())
        except UnicodeDecodeError:
            continue  # part of a character: never a pre-token
    return frozenset(found)


class Counter:
    """Counts tokens as the vocabulary file says; see the module."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        normalizers, (split, byte_level) = held["normalizer"]["normalizers"], held["pre_tokenizer"]["pretokenizers"]
        known = [x["type"] for x in normalizers] == ["NFC", "Replace", "Lowercase"] and split["behavior"] == "Removed" and split["invert"] and not byte_level["use_regex"]
        model = held["model"]
        if not (known and model["type"] == "BPE" and model["end_of_word_suffix"] and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))):
            raise ValueError(f"not a vocabulary of lower-case words with word ends: {path}")
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in held["added_tokens"]):
            raise ValueError("special tokens that are normalised or stripped are not known")
        self.pattern = split["pattern"]["Regex"]
        self.special = "|".join(regex.escape(t["content"]) for t in sorted(held["added_tokens"], key=lambda t: -len(t["content"])))
        self.merges = Merges(model)
        self.whole = proven_whole(model, self.merges)
        # the vocabulary's own normaliser and splitter, as text, since tasks rebuild them
        self.own = json.dumps(held | {"model": model | {"vocab": {}, "merges": [], "end_of_word_suffix": None}, "added_tokens": []})
        self._ready = False

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("pattern", "special", "merges", "whole", "own")} | {"_ready": False}

    def _prepare(self) -> None:
        if not self._ready:
            self._find = regex.compile(self.pattern).findall
            self._cut = regex.compile(self.special).split if self.special else None
            self._doubtful = regex.compile(DOUBTFUL).search
            self._library = None
            self._memo: dict[str, int] = {}
            self._ready = True

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens."""
        if text.isascii():
            return self._find(text.lower())
        if self._doubtful(text):
            self._library = self._library or Tokenizer.from_str(self.own)
            text = self._library.normalizer.normalize_str(text)
            return [text[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(text)]
        # the vocabulary knows no final sigma
        return self._find(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _tokens(self, piece: str) -> int:
        if piece in self.whole:
            return 1
        found = self._memo.get(piece)
        if found is None:
            found = len(self.merges.merge(piece.encode()))
            if len(self._memo) >= MEMO:
                self._memo.clear()
            if len(piece) <= 64:
                self._memo[piece] = found
        return found

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text. Long texts are cut at spaces, which no pre-token holds, so that memory does not grow with them."""
        self._prepare()
        found: list[str] = []
        ends, others = np.zeros(len(texts) + 1, np.int64), np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            text = text or ""
            if len(text) <= PART_CHARS:
                others[i] = self._add(text, found)
            else:
                for part in parts(text, PART_CHARS):
                    own: list[str] = []
                    others[i] += self._add(part, own)
                    others[i] += int(self._each(own).sum())
            ends[i + 1] = len(found)
        upto = np.concatenate([[0], np.cumsum(self._each(found))])
        return upto[ends[1:]] - upto[ends[:-1]] + others

    def _add(self, text: str, found: list[str]) -> int:
        """Add the pre-tokens of a text; returns its special tokens."""
        own = self._cut(text) if self._cut and "<" in text else [text]
        for part in own:
            found += self.pieces(part)
        return len(own) - 1

    def _each(self, found: list[str]) -> np.ndarray:
        """Tokens of each pre-token; distinct ones are counted once."""
        coded = pa.array(found, pa.large_string()).dictionary_encode()
        each = np.fromiter(map(self._tokens, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        return each[coded.indices.to_numpy(zero_copy_only=False)]


def parts(text: str, size: int) -> Iterator[str]:
    """A text cut at spaces into parts of about ``size`` characters; where there are none, longer ones."""
    at = 0
    while at < len(text):
        m = SPACE.search(text, at + size)
        end = m.start() if m else len(text)
        yield text[at:end]
        at = end


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def counted(docs: DataFrame, text: str = "text", into: str = "n_tokens", path: str | None = None) -> DataFrame:
    """``docs`` with the number of tokens of ``text``."""
    docs = docs.drop(into)
    shared = docs.sparkSession.sparkContext.broadcast(counter(path or public_tokenizers.path(VOCABULARY)))
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.LongType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, text, 2 << 20):
            found = pa.array(shared.value.count(block.column(text).to_pylist()))
            yield pa.RecordBatch.from_arrays([*block.columns, found], names=schema.names)

    return docs.mapInArrow(each, schema)


def query(spark: SparkSession, sf_dir: str, limit: int = 2048) -> DataFrame:
    docs = counted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
