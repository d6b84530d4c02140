"""WARC archives: a writer with revisit records, and a splittable reader.

The writer makes one gzip member of each record and one archive of each partition, under a name that depends on the
partition only: an archive is written aside and moved into place, so repeated tasks leave one file. Of records with
equal payloads the one with the smallest page_id is a response and the others revisit it.

The reader deals archives out in byte ranges. A task scans its range for gzip magic, takes a position for a member only
if the bytes there decode to a WARC header, reads on from the first one member by member, and owns the records that
start inside its range; of the last one it reads past the end of the range.

Defined results: null html is an empty payload; payloads under ``SMALL`` bytes are all responses; so are rows without a
page_id, and rows that share the smallest page_id of a payload; an empty table gives no archives and no records; a null
url is written as an empty one; columns other than page_id, url and html are not archived.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkquill.shared import new_path, stored

SMALL = 100
#: Payloads that occur more than once are broadcast up to so many, 50 bytes each; beyond that they are joined by shuffle.
BROADCAST_ROWS = 200_000
SPLIT_BYTES = 16 << 20
MAGIC = b"\x1f\x8b\x08"
DATE = "2020-01-01T00:00:00Z"
#: A WARC header is looked for in so many decoded bytes of a candidate member.
HEAD = 64 << 10


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


def _record(page_id, url: str | None, payload: bytes, n_bytes: int, digest: bytes, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha256:{digest.hex()}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, path: str, level: int = 6) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) under ``path``. Returns (path, length) of the archives."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.octet_length(payload).cast("long").alias("n"), F.unhex(F.sha2(payload, 256)).alias("digest"))
    least = rows.filter((F.col("n") >= SMALL) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    least = stored(least.filter("copies > 1").drop("copies"), "copies")
    few = least.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(least) if few else least, "digest", "left")
    refers = F.when((F.col("n") >= SMALL) & (F.col("page_id") > F.col("first")), F.col("first"))
    rows = rows.select("page_id", "url", "html", "n", "digest", refers.alias("refers_to"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, base = _place(path)
        name = f"{base}/part-{context.partitionId():06d}.warc.gz"
        aside = f"{base}/.{context.taskAttemptId()}.tmp"
        length, out = 0, None
        for batch in batches:
            for at in range(0, len(batch), 64):
                for row in batch.slice(at, 64).to_pylist():
                    if out is None:
                        store.create_dir(base, recursive=True)
                        out = store.open_output_stream(aside)
                    member = gzip.compress(_record(row["page_id"], row["url"], row["html"].encode(), row["n"], row["digest"], row["refers_to"]), level, mtime=0)
                    out.write(member)
                    length += len(member)
        if out is not None:
            out.close()
            store.move(aside, name)
            yield pa.RecordBatch.from_pydict({"path": [f"{path}/part-{context.partitionId():06d}.warc.gz"], "length": pa.array([length], pa.int64())})

    return stored(rows.mapInArrow(each, "path string, length long"), "archives")


RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
    ]
)
ARROW_RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("path", pa.string()), ("offset", pa.int64())]
)


class Members:
    """The WARC records of the gzip members that start in [start, end) of a file."""

    def __init__(self, file, start: int, end: int, step: int = 1 << 20):
        self.file, self.start, self.end, self.step = file, start, end, step
        self.size = file.size()

    def _bytes(self, at: int, n: int) -> bytes:
        return self.file.read_at(min(n, self.size - at), at) if at < self.size else b""

    def _is_member(self, at: int) -> bool:
        try:
            return zlib.decompressobj(31).decompress(self._bytes(at, HEAD), HEAD).startswith(b"WARC/")
        except zlib.error:
            return False

    def _next(self, at: int) -> int | None:
        """The first member at or after ``at`` that starts before the end of the range."""
        while at < self.end:
            window = self._bytes(at, self.step + len(MAGIC) - 1)
            k = window.find(MAGIC)
            while k >= 0 and at + k < self.end:
                if self._is_member(at + k):
                    return at + k
                k = window.find(MAGIC, k + 1)
            at += self.step
        return None

    def _member(self, at: int) -> tuple[bytes, int] | None:
        """What the member at ``at`` holds, and where it ends; None if it is cut or broken."""
        inflate, out, place = zlib.decompressobj(31), [], at
        try:
            while not inflate.eof:
                part = self._bytes(place, 256 << 10)
                if not part:
                    return None
                out.append(inflate.decompress(part))
                place += len(part)
        except zlib.error:
            return None
        return b"".join(out), place - len(inflate.unused_data)

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        at = self._next(self.start)
        while at is not None and at < self.end:
            found = self._member(at)
            if found is None or not found[0].startswith(b"WARC/"):
                at = self._next(at + 1)
                continue
            yield at, found[0]
            # the next member follows at once, unless something else lies between
            at = found[1] if self._bytes(found[1], len(MAGIC)) == MAGIC and self._is_member(found[1]) else self._next(found[1])


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """The named fields of a record, in lower case, and its block."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, rest[: int(fields.get("content-length") or 0)]


def _row(record: bytes, path: str, offset: int) -> dict | None:
    fields, block = parse(record)
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda x: int(x[10:-1]) if x and x.startswith("<urn:page:") and x[10:-1] else None
    if kind == "revisit":
        sizes = [h.split(b":", 1)[1] for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:")]
        n, digest, payload = int(sizes[0]) if sizes else None, fields.get("warc-payload-digest", "").removeprefix("sha256:") or None, None
    else:
        n, digest = len(payload), hashlib.sha256(payload).hexdigest()
    return {
        "page_id": page(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": page(fields.get("warc-refers-to")),
        "payload_bytes": n,
        "payload_digest": digest,
        "payload": payload,
        "path": path,
        "offset": offset,
    }


def splits(archives: DataFrame, size: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, end) byte ranges of archives (path, length), each in a task of its own as far as Spark deals them evenly."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0).cast("long")), F.lit(size).cast("long"))
    return archives.filter("length > 0").select("path", F.explode(starts).alias("start"), "length").select("path", "start", F.least(F.col("start") + size, "length").alias("end"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files under a path, without reading them."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(path).select("path", "length")


def read(archives: DataFrame, payload: bool = True, size: int = SPLIT_BYTES) -> DataFrame:
    """The response and revisit records of archives (path, length). The payload of a revisit is null; its length and digest
    are those of the record that it refers to. ``payload=False`` leaves the payloads out of the result."""
    spark = archives.sparkSession
    ranges = splits(archives, size)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                store, name = _place(part["path"])
                with store.open_input_file(name) as file:
                    rows, held = [], 0
                    for offset, record in Members(file, part["start"], part["end"]):
                        row = _row(record, part["path"], offset)
                        if row is None:
                            continue
                        if not payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 300
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, ARROW_RECORD)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, ARROW_RECORD)

    return ranges.repartition(tasks, "path", "start").mapInArrow(each, RECORD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    archives = write(pages, new_path(spark, "warc"))
    return read(archives, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
