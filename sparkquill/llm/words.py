"""Splitting whole texts into words, vectorised over the UTF-8 bytes of an Arrow column.

No Python object is made for each word: a block of texts becomes arrays of word starts, word ends and 64-bit word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: Everything but ASCII white space.
NOT_SPACE = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: ASCII letters, digits and everything beyond ASCII.
ALNUM = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Maps A-Z to a-z and leaves other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_M = np.uint64(0x9E3779B97F4A7C15)
_A = np.uint64(0xBF58476D1CE4E5B9)
_B = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        base = np.full(max(n, 1024), 0x5851F42D4C957F2D, np.uint64)
        base[0] = 1
        _POWERS = np.multiply.accumulate(base)
    return _POWERS[:n]


@dataclass
class Words:
    data: np.ndarray  #: bytes of all texts of the block, lower-cased if asked for
    offsets: np.ndarray  #: where each text starts in data, and the end
    starts: np.ndarray  #: of words, in data
    ends: np.ndarray
    first: np.ndarray  #: of each text, its first word; and the number of words
    hashes: np.ndarray

    def of(self, text: int) -> slice:
        return slice(int(self.first[text]), int(self.first[text + 1]))

    def bytes(self, word: int) -> bytes:
        return self.data[self.starts[word] : self.ends[word]].tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def runs(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of bytes in ``table`` that stay within one text."""
    inside = table[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    return np.flatnonzero(inside & ~before[:-1]), np.flatnonzero(inside & ~after[1:]) + 1


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    inner = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = (data[np.repeat(starts, lengths) + inner].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[inner]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * _M)


def split(column: pa.Array, table: np.ndarray, lower: bool = False) -> Words:
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    starts, ends = runs(data, offsets, table)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), hash_runs(data, starts, ends))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive words; window i starts at word i."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * _A + hashes[k : k + n]
        out ^= out >> np.uint64(29)
    return mix(out)


def sequence_hash(hashes: np.ndarray) -> int:
    """The hash that ``windows`` gives the whole sequence."""
    return int(windows(hashes, len(hashes))[0])


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a longer text stays whole in a batch of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < len(sizes):
            base = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
