"""ZIP archives of any size, read member by member: no task holds an archive.

The listing gives paths and lengths without contents. One task an archive reads its central directory, by ranges at its end;
the members are then dealt to all tasks, which read and inflate each from its offset.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: signatures and the fields behind them.
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_FIELDS, END64_FIELDS, LOCATOR_FIELDS, ENTRY_FIELDS = "<4s4H2LH", "<4sQ2H2L4Q", "<4sLQL", "<4s6H3L5H2L"
LOCAL_SIZE, STORED, DEFLATED = 30, 0, 8
FULL = 0xFFFFFFFF

DIRECTORY = "path string, member string, member_ord int, method int, encrypted boolean, start long, packed long, size long, crc long"
STEP = 1 << 20

Read = Callable[[int, int], bytes]


class BadArchive(ValueError):
    """A file that is no archive, or one that this reader does not know."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    encrypted: bool
    start: int  # of the local header
    packed: int
    size: int
    crc: int


def directory(read: Read, length: int) -> list[Member]:
    """The members of an archive in the order of its central directory; ``read(at, n)`` gives up to n bytes of the file."""
    size = struct.calcsize(END_FIELDS)
    tail_at = max(0, length - size - 0xFFFF)
    tail = read(tail_at, length - tail_at)
    at = _end(tail)
    if at < 0:
        raise BadArchive("no end of a central directory")
    *_, count, n_bytes, start, _ = struct.unpack(END_FIELDS, tail[at : at + size])
    end_at = tail_at + at
    if FULL in (n_bytes, start) or count == 0xFFFF:
        locator = read(max(0, end_at - struct.calcsize(LOCATOR_FIELDS)), struct.calcsize(LOCATOR_FIELDS))
        if locator[:4] == LOCATOR:
            place = struct.unpack(LOCATOR_FIELDS, locator)[2]
            head = read(place, struct.calcsize(END64_FIELDS))
            if head[:4] != END64:
                raise BadArchive("no end of a large central directory")
            *_, count, n_bytes, start = struct.unpack(END64_FIELDS, head)
            end_at = place
    shift = end_at - n_bytes - start  # bytes before the archive's own
    held, found, at = read(start + shift, n_bytes), [], 0
    for _ in range(count):
        if held[at : at + 4] != ENTRY:
            raise BadArchive("a central directory that ends early")
        fields = struct.unpack(ENTRY_FIELDS, held[at : at + 46])
        flags, method, crc, packed, size, n_name, n_extra, n_comment, begins = fields[3], fields[4], fields[7], fields[8], fields[9], fields[10], fields[11], fields[12], fields[16]
        name = held[at + 46 : at + 46 + n_name]
        extra = held[at + 46 + n_name : at + 46 + n_name + n_extra]
        size, packed, begins = _large(extra, [size, packed, begins])
        found.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, bool(flags & 1), begins + shift, packed, size, crc))
        at += 46 + n_name + n_extra + n_comment
    return found


def _end(tail: bytes) -> int:
    """Where the end record begins: the last signature whose comment ends the file, else the last one with a comment that fits."""
    size, at, fits = struct.calcsize(END_FIELDS), tail.rfind(END), -1
    while at >= 0:
        if len(tail) - at >= size:
            rest = len(tail) - at - size - struct.unpack(END_FIELDS, tail[at : at + size])[-1]
            if rest == 0:
                return at
            if rest > 0 and fits < 0:
                fits = at
        at = tail.rfind(END, 0, at)
    return fits


def _large(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and offset with those that do not fit replaced from the extra field for large files."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack("<2H", extra[at : at + 4])
        if kind == 1:
            rest = list(struct.unpack(f"<{n // 8}Q", extra[at + 4 : at + 4 + n // 8 * 8]))
            return [rest.pop(0) if v == FULL and rest else v for v in values]
        at += 4 + n
    return values


def content(read: Read, member: Member) -> bytes:
    """What a member holds, checked against its checksum."""
    if member.encrypted or member.method not in (STORED, DEFLATED):
        raise BadArchive(f"{member.name}: encrypted, or packed by an unknown method ({member.method})")
    head = read(member.start, LOCAL_SIZE)
    if head[:4] != LOCAL:
        raise BadArchive(f"{member.name}: no member at its offset")
    n_name, n_extra = struct.unpack("<2H", head[26:30])
    at, end = member.start + LOCAL_SIZE + n_name + n_extra, member.start + LOCAL_SIZE + n_name + n_extra + member.packed
    inflate, parts = zlib.decompressobj(-15), []
    while at < end:
        part = read(at, min(STEP, end - at))
        if not part:
            raise BadArchive(f"{member.name}: cut off")
        parts.append(part if member.method == STORED else inflate.decompress(part))
        at += len(part)
    whole = b"".join([*parts, inflate.flush()] if member.method == DEFLATED else parts)
    if zlib.crc32(whole) != member.crc:
        raise BadArchive(f"{member.name}: checksum")
    return whole


def _opened(path: str) -> pa.NativeFile:
    store, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(name)


def _reader(file: pa.NativeFile) -> Read:
    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    return read


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files under a path; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def members(archives: DataFrame, suffix: str = "") -> DataFrame:
    """(DIRECTORY) of the members of archives (path, length), folders left out; only names that end in ``suffix``, in any case.

    ``member_ord`` counts the members that are kept, from 0 in each archive."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("member_ord", pa.int32()), ("method", pa.int32()), ("encrypted", pa.bool_()), *[(c, pa.int64()) for c in ("start", "packed", "size", "crc")]])
        for batch in batches:
            for one in batch.to_pylist():
                with _opened(one["path"]) as file:
                    held = [m for m in directory(_reader(file), one["length"]) if not m.name.endswith("/") and m.name.lower().endswith(suffix.lower())]
                rows = [{"path": one["path"], "member": m.name, "member_ord": i, "method": m.method, "encrypted": m.encrypted, "start": m.start, "packed": m.packed, "size": m.size, "crc": m.crc} for i, m in enumerate(held)]
                yield pa.RecordBatch.from_pylist(rows, schema)

    spread = archives.repartition(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInArrow(each, DIRECTORY)


def contents(found: DataFrame) -> DataFrame:
    """(path, member, member_ord, content) of members as ``members`` gives them. Members are dealt to tasks whatever their archive."""
    schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("member_ord", pa.int32()), ("content", pa.binary())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, file = None, None
            try:
                for one in sorted(batch.to_pylist(), key=lambda r: (r["path"], r["start"])):
                    if one["path"] != path:
                        if file:
                            file.close()
                        path, file = one["path"], _opened(one["path"])
                    member = Member(one["member"], one["method"], one["encrypted"], one["start"], one["packed"], one["size"], one["crc"])
                    row = {"path": path, "member": one["member"], "member_ord": one["member_ord"], "content": content(_reader(file), member)}
                    yield pa.RecordBatch.from_pylist([row], schema)
            finally:
                if file:
                    file.close()

    spark = found.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return found.repartition(tasks, "path", "member_ord").mapInArrow(each, "path string, member string, member_ord int, content binary")
