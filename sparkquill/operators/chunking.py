"""Packing text and table blocks into chunks of a token budget.

Packing is a running fold over the blocks of one section; sections are many and each is bounded by its document. A section
that is a row (its HTML, or an array of its blocks) is packed where it is; blocks that are rows are grouped first.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkquill.functions import scalars as S
from sparkquill.operators import html_blocks

#: After the last of these a text may be cut. the last of these a text may be cut.
TERMINATORS = ".!?。…\n"
SCHEMA = "chunk_id string, text string, company string, year int, section string, report_code string, has_table boolean, token_count int, block_kinds array<string>"


TOKEN = re.compile(r"\s*\S+|\s+")


def word_spans(text: str) -> list[tuple[int, int]]:
    """The default tokenizer: each token is a word with the white space before it, so that tokens join to the text."""
    return [m.span() for m in TOKEN.finditer(text)]


TOKENIZERS: dict[str, Callable[[str], list[tuple[int, int]]]] = {"words": word_spans}


class Packer:
    """A text is split into tokens once. A token that a cut goes through counts in both parts."""

    def __init__(self, size: int = 512, overlap: int = 50, tokenizer: str = "words", compat: bool = False):
        self.size, self.overlap, self.spans, self.compat = size, overlap, TOKENIZERS[tokenizer], compat

    def count(self, text: str) -> int:
        return len(self.spans(text))

    def tail(self, text: str) -> str:
        """The last tokens of a text, to begin the next chunk with."""
        if self.overlap <= 0:
            return ""
        spans = self.spans(text)
        return text if len(spans) <= self.overlap else text[spans[-self.overlap][0] :].lstrip()

    def pack(self, blocks: Iterable[tuple[str, str]]) -> Iterator[tuple[str, list[str]]]:
        """(text, kinds) of each chunk; tables stay whole, and one that fits nowhere is a chunk of its own."""
        parts: list[tuple[str, str]] = []
        used = 0

        def flushed(seed: bool = True) -> Iterator[tuple[str, list[str]]]:
            nonlocal parts, used
            only_overlap = all(k == "overlap" for k, _ in parts)
            if not parts or (only_overlap and not self.compat):
                return
            text = "\n\n".join(t for _, t in parts)
            yield text, [k for k, _ in parts]
            rest = self.tail(text) if seed else ""
            parts, used = ([("overlap", rest)], self.count(rest)) if rest.strip() else ([], 0)

        for kind, payload in blocks:
            if not payload or not payload.strip():
                continue
            spans = self.spans(payload)
            n = len(spans)
            if kind == "table":
                if used + n > self.size and parts:
                    yield from flushed()
                if n + used > self.size:
                    if not self.compat:
                        parts, used = [], 0
                    parts.append((kind, payload))
                    used = n
                    yield from flushed()
                else:
                    parts.append((kind, payload))
                    used += n
                continue
            at = token = 0  # where the rest of the text begins, and its first token
            while at < len(payload):
                if self.size <= used:
                    yield from flushed()
                room = max(self.size - used, 1)
                if n - token <= room:
                    end = len(payload)
                else:
                    end = spans[token + room - 1][1]
                    # the longest start within the budget, cut after its last terminator if it has one
                    cut = max(payload.rfind(c, at, end) for c in TERMINATORS)
                    end = cut + 1 if cut > at else end
                parts.append((kind, payload[at:end]))
                first = token
                while token < n and spans[token][1] <= end:
                    token += 1
                used += token - first + (token < n and spans[token][0] < end)
                at = end
                while at < len(payload) and payload[at].isspace():
                    at += 1
                while token < n and spans[token][1] <= at:
                    token += 1
                if at < len(payload):
                    yield from flushed()
        yield from flushed(seed=False)


def _records(packer: Packer, company, year, section, report_code, blocks) -> Iterator[tuple]:
    for i, (text, kinds) in enumerate(packer.pack(blocks)):
        yield f"{company}_{year}_{section}_{i:03d}", text, company, year, section, report_code, "table" in kinds, packer.count(text), kinds


COLUMNS = ["chunk_id", "text", "company", "year", "section", "report_code", "has_table", "token_count", "block_kinds"]


def chunks(blocks: DataFrame, size: int = 512, overlap: int = 50, tokenizer: str = "words", compat: bool = False) -> DataFrame:
    """blocks (company, year, section, report_code, pos, kind, payload) -> chunks, numbered within company, year and section."""

    def each(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos", kind="stable")
        one = frame.iloc[0]
        held = zip(frame["kind"], frame["payload"], strict=True)
        return pd.DataFrame(_records(Packer(size, overlap, tokenizer, compat), one.company, one.year, one.section, one.report_code, held), columns=COLUMNS)

    return blocks.groupBy("company", "year", "section").applyInPandas(each, SCHEMA)


def section_chunks(sections: DataFrame, content: str, size: int = 512, overlap: int = 50, tokenizer: str = "words", compat: bool = False) -> DataFrame:
    """sections (company, year, section, report_code, ...) -> chunks, a section a row, so that nothing is shuffled.

    ``content`` names a column of HTML, or one of blocks, array<struct<kind, text>>."""
    html = sections.schema[content].dataType.typeName() == "string"

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = Packer(size, overlap, tokenizer, compat)
        for frame in frames:
            rows: list[tuple] = []
            for r in frame.itertuples(index=False):
                found = html_blocks.blocks(r.content) if html else [(b["kind"], b["text"]) for b in (r.content if r.content is not None else ())]
                rows += _records(packer, r.company, r.year, r.section, r.report_code, found)
            yield pd.DataFrame(rows, columns=COLUMNS)

    return sections.select("company", "year", "section", "report_code", F.col(content).alias("content")).mapInPandas(each, SCHEMA)


def windows(df: DataFrame, key: str, text: str, stride: int = 400, size: int = 450) -> DataFrame:
    """(key, pos, n_tokens, window): fixed windows of words with an overlap of size - stride, without Python."""
    words = S.tokens(F.col(text))
    count = F.greatest(F.ceil((F.size("_w") - (size - stride)) / F.lit(stride)).cast("int"), F.lit(1))
    cut = lambda i: F.slice("_w", i * stride + 1, F.lit(size))
    parts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(i.alias("pos"), F.size(cut(i)).alias("n_tokens"), F.array_join(cut(i), " ").alias("window")))
    return df.select(key, words.alias("_w")).filter(F.size("_w") > 0).select(key, F.explode(parts).alias("p")).select(key, "p.*")


def overlap_tail(text: Column, n: int) -> Column:
    words = S.tokens(text)
    return F.array_join(F.slice(words, F.greatest(F.size(words) - n + 1, F.lit(1)), n), " ") if n > 0 else F.lit("")


def truncated(text: Column, n: int) -> Column:
    """The first n words."""
    return F.array_join(F.slice(S.tokens(text), 1, n), " ")
