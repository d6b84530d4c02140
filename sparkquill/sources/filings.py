"""Data sources for a filing service: lists that come in pages, and documents.

    spark.dataSource.register(FilingList)
    spark.read.format("filing_list").option("requests", ...).option("path", recorded).load()

A request (a company and a range of dates, or a document) is read by one task: it asks for page after page until the last,
tries again where the service or the network fails, and tells the service's own answers apart: data, none, error. With the
option ``errors`` = "rows" a request that fails is a row with its error, as a caller needs that goes on with the next choice.

``transport`` names how a request is answered: "recorded" reads answers that ``record`` has written to the folder ``path``;
"module:function" calls ``function(endpoint, params)``, which returns an ``Answer`` or raises OSError.
"""

from __future__ import annotations

import base64
import importlib
import json
import pickle
import re
import tempfile
import time
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values of the service's answers: data, and no data for the question.
OK, NONE = "000", "013"
LIST, DOCUMENT = "list.json", "document.xml"
RECORDED_BUCKETS = 64
#: Bytes that are read of a recorded file at a time, and how its lines begin.
READ, HEAD = 1 << 20, re.compile(rb'\{"name":("(?:[^"\\]|\\.)*"),"page_no":([0-9]+),')
#: Bytes of a request's rows in memory; more are on disk until the last is there.
HELD = 8 << 20


class SourceError(RuntimeError):
    """The service answered with an error."""


@dataclass(frozen=True)
class Answer:
    status_code: int
    content_type: str
    body: bytes


Transport = Callable[[str, dict], Answer]


class Recorded:
    """Answers from a folder. Of one request at a time it is known where its answers stand; one answer is held."""

    def __init__(self, path: str):
        self.store, self.folder = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        self.name, self.places = None, {}
        self.path, self.file = None, None

    def __call__(self, endpoint: str, params: dict) -> Answer:
        name = request_name(endpoint, params)
        if name != self.name:
            self.name, self.places = name, dict(self._places(name))
        place = self.places.get(int(params.get("page_no", 1)))
        if place is None:
            return Answer(404, "text/plain", b"not recorded")
        path, at, size = place
        if path != self.path:
            self.close()
            self.path, self.file = path, self.store.open_input_file(path)
        self.file.seek(at)
        one = json.loads(self.file.read(size))
        return Answer(one["status_code"], one["content_type"], base64.b64decode(one["body"]))

    def _places(self, name: str) -> Iterator[tuple[int, tuple[str, int, int]]]:
        """(page, (file, offset, bytes)) of a request's answers, whose bucket is read piece by piece."""
        folder = f"{self.folder}/bucket={zlib.crc32(name.encode()) % RECORDED_BUCKETS}"
        for file in self.store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if not file.base_name.endswith(".json"):
                continue
            with self.store.open_input_stream(file.path) as stream:
                at, rest = 0, b""
                while part := stream.read(READ):
                    *lines, rest = (rest + part).split(b"\n")
                    for line in lines:
                        if line and (own := named(line))[0] == name:
                            yield own[1], (file.path, at, len(line))
                        at += len(line) + 1
                if rest and (own := named(rest))[0] == name:
                    yield own[1], (file.path, at, len(rest))

    def close(self) -> None:
        if self.file:
            self.file.close()


def named(line: bytes) -> tuple[str, int]:
    """Name and page of a recorded answer; its body is not read where these stand before it."""
    head = HEAD.match(line)
    one = {"name": json.loads(head[1]), "page_no": int(head[2])} if head else json.loads(line)
    return one["name"], one["page_no"]


def request_name(endpoint: str, params: dict) -> str:
    """What a request is recorded under, without its page."""
    return "|".join([endpoint, *(str(params.get(k, "")) for k in ("corp_code", "bgn_de", "end_de", "pblntf_detail_ty", "rcept_no"))])


def record(answers: DataFrame, path: str) -> None:
    """Write answers (endpoint, corp_code, bgn_de, end_de, pblntf_detail_ty, rcept_no, page_no, status_code, content_type, body binary)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("corp_code", "bgn_de", "end_de", "pblntf_detail_ty", "rcept_no")]
    named = answers.withColumn("name", F.concat_ws("|", "endpoint", *parts))
    named = named.select("name", F.coalesce("page_no", F.lit(1)).alias("page_no"), "status_code", "content_type", F.base64("body").alias("body"), F.pmod(F.crc32("name"), F.lit(RECORDED_BUCKETS)).alias("bucket"))
    named.repartition("bucket").write.partitionBy("bucket").json(path)


def retried(call: Callable[[], Answer], tries: int = 5, first: float = 1.0, most: float = 20.0, wait: Callable[[float], None] = time.sleep) -> Answer:
    """The answer of a call that is made again after network errors and answers from 500 on, with a delay that doubles."""
    for failures in range(1, tries + 1):
        try:
            answer = call()
            if answer.status_code < 500:
                break
            problem: Exception = SourceError(f"HTTP {answer.status_code}")
        except OSError as e:
            problem = e
        if failures == tries:
            raise problem
        wait(min(most, first * 2 ** (failures - 1)))
    if answer.status_code >= 400:
        raise SourceError(f"HTTP {answer.status_code}: {answer.body[:200].decode(errors='replace')}")
    return answer


def pages(get: Callable[[str, dict], Answer], request: dict, page_count: int) -> Iterator[tuple[int, dict]]:
    """(page, row) of all rows of a list, page after page to the last that the service names."""
    number = 1
    while True:
        body = json.loads(get(LIST, {**request, "page_no": number, "page_count": page_count}).body)
        status = body.get("status")
        if status == NONE:
            return
        if status != OK:
            raise SourceError(f"{LIST} error {status}: {body.get('message')}")
        for row in body.get("list") or []:
            yield number, row
        if number >= int(body.get("total_page") or 1):
            return
        number += 1


def document(get: Callable[[str, dict], Answer], rcept_no: str) -> bytes:
    """The archive of a document; any other answer is an error, told by its envelope if it has one."""
    answer = get(DOCUMENT, {"rcept_no": rcept_no})
    if "application/zip" in answer.content_type or answer.body[:2] == b"PK":
        return answer.body
    shown = answer.body[:200].decode(errors="replace")
    try:
        root = ElementTree.fromstring(answer.body)
    except ElementTree.ParseError:
        raise SourceError(f"no archive: {shown}") from None
    raise SourceError(f"{DOCUMENT} error {root.findtext('status') or '?'}: {root.findtext('message') or shown}")


@dataclass
class Requests(InputPartition):
    held: list[dict]


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.requests = json.loads(self.options["requests"])
        if self.options.get("errors", "raise") not in ("raise", "rows"):
            raise ValueError("errors: raise or rows")

    def partitions(self) -> list[InputPartition]:
        """One for each request, or ``partitions`` of them, dealt in turn."""
        n = min(int(self.options.get("partitions", len(self.requests))), len(self.requests))
        return [Requests(self.requests[i::n]) for i in range(n)] if n else [Requests([])]

    def transport(self) -> Transport:
        name = self.options.get("transport", "recorded")
        if name == "recorded":
            found: Transport = Recorded(self.options["path"])
        else:
            module, _, function = name.partition(":")
            found = getattr(importlib.import_module(module), function)
        tries, first = int(self.options.get("tries", 5)), float(self.options.get("first_delay", 1))
        return lambda endpoint, params: retried(lambda: found(endpoint, params), tries, first)

    def read(self, partition: Requests) -> Iterator[tuple]:
        get = self.transport()
        for request in partition.held:
            if self.options.get("errors", "raise") == "raise":
                yield from self.rows(get, request)  # what fails ends the query, whatever came before
                continue
            with tempfile.SpooledTemporaryFile(HELD) as held:
                try:
                    for row in self.rows(get, request):
                        pickle.dump(row, held)
                except (SourceError, OSError) as e:
                    yield self.failed(request, str(e))
                    continue
                end = held.tell()
                held.seek(0)
                while held.tell() < end:
                    yield pickle.load(held)  # noqa: S301  written above

    def rows(self, get: Transport, request: dict) -> Iterator[tuple]:
        raise NotImplementedError

    def failed(self, request: dict, error: str) -> tuple:
        raise NotImplementedError


class _ListReader(_Reader):
    def rows(self, get: Transport, request: dict) -> Iterator[tuple]:
        of = {k: request.get(k) for k in ("corp_code", "bgn_de", "end_de", "pblntf_detail_ty")}
        asked = {k: v for k, v in of.items() if v is not None}
        for i, (page, row) in enumerate(pages(get, asked, int(self.options.get("page_count", 100)))):
            yield *of.values(), page, i, row["rcept_no"], row["corp_code"], row["corp_name"], row["report_nm"], row.get("rcept_dt", ""), None

    def failed(self, request: dict, error: str) -> tuple:
        return (*(request.get(k) for k in ("corp_code", "bgn_de", "end_de", "pblntf_detail_ty")), *[None] * 7, error)


class _DocumentReader(_Reader):
    def rows(self, get: Transport, request: dict) -> Iterator[tuple]:
        yield request["rcept_no"], document(get, request["rcept_no"]), None

    def failed(self, request: dict, error: str) -> tuple:
        return request["rcept_no"], None, error


class FilingList(DataSource):
    """Rows of lists by company and dates; ``ord`` counts a request's rows from 0. A request without data gives none."""

    @classmethod
    def name(cls) -> str:
        return "filing_list"

    def schema(self) -> str:
        asked = "asked_corp string, bgn_de string, end_de string, pblntf_detail_ty string"
        return f"{asked}, page_no int, ord int, rcept_no string, corp_code string, corp_name string, report_nm string, rcept_dt string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _ListReader(self.options)


class FilingDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "filing_documents"

    def schema(self) -> str:
        return "rcept_no string, content binary, error string"

    def reader(self, schema) -> DataSourceReader:
        return _DocumentReader(self.options)
