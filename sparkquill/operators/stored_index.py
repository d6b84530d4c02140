"""A keyed table on disk that is changed by copying: buckets of keys, versions, and one commit file that makes a version.

    path/data/<change>/bucket=<n>/part-*.parquet    written once, never changed
    path/commits/<version>.json                     which change holds each bucket in that version

A change reads and writes only the buckets that its keys fall into, in a new folder, and counts when its commit file is renamed
into place. So a reader sees the version that it opened until it opens another, a write that stops half-way leaves nothing but
a folder that no version names, and of two writers of one version the second fails. All goes through Spark and Hadoop's file
systems, so the path may be any that Spark writes to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64


class Conflict(RuntimeError):
    """Another writer has made the version first."""


class _Files:
    """The few calls of Hadoop's file systems that commits need."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm  # noqa: SLF001
        self.store = self.jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        place = self.path(folder)
        return sorted(f.getPath().getName() for f in self.store.listStatus(place)) if self.store.exists(place) else []

    def read(self, file: str) -> str:
        stream = self.store.open(self.path(file))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, file: str, text: str) -> None:
        """Write beside and rename, so that the file is whole as soon as it is there."""
        beside = self.path(f"{file}.{uuid.uuid4().hex}.tmp")
        stream = self.store.create(beside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.store.exists(self.path(file)) or not self.store.rename(beside, self.path(file)):
            self.store.delete(beside, False)
            raise Conflict(f"already there: {file}")

    def remove(self, folder: str) -> None:
        self.store.delete(self.path(folder), True)


class Index:
    """A table with a key of one or more columns; see the module. Keys are unique after ``upsert``, as its last row of a key wins."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), _Files(spark, path)

    @staticmethod
    def create(spark: SparkSession, path: str, schema: StructType, key: list[str], buckets: int = BUCKETS) -> Index:
        """An empty table, version 0."""
        index = Index(spark, path)
        if missing := set(key) - set(schema.names):
            raise ValueError(f"the schema has no {sorted(missing)}")
        index._commit(0, {"schema": schema.jsonValue(), "key": key, "buckets": buckets, "data": {}})  # noqa: SLF001
        return index

    # versions

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names(f"{self.path}/commits") if n.endswith(".json"))

    def commit(self, version: int | None = None) -> dict:
        held = self.versions()
        if not held:
            raise FileNotFoundError(self.path)
        version = held[-1] if version is None else version
        return json.loads(self.files.read(f"{self.path}/commits/{version:012d}.json")) | {"version": version}

    def _commit(self, version: int, content: dict) -> None:
        self.files.publish(f"{self.path}/commits/{version:012d}.json", json.dumps({k: v for k, v in content.items() if k != "version"}))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest one by default; they stay readable while other versions are made."""
        return self._rows(self.commit(version))

    def _rows(self, commit: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(commit["schema"])
        wanted = commit["data"] if buckets is None else {str(b): commit["data"][str(b)] for b in buckets if str(b) in commit["data"]}
        folders = [f"{self.path}/data/{change}/bucket={b}" for b, change in sorted(wanted.items())]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the keys of a table; only their buckets are read."""
        commit = self.commit()
        wanted = keys.select(*commit["key"]).distinct()
        touched = self._touched(commit, wanted)
        return self._rows(commit, touched).join(wanted, commit["key"], "left_semi")

    # changes

    def upsert(self, rows: DataFrame, order: str | None = None) -> int:
        """Add rows, or replace those of equal key. Of several rows of one key the last by ``order`` is kept, or any without it."""
        commit = self.commit()
        key, schema = commit["key"], StructType.fromJson(commit["schema"])
        last = _last(rows, key, order).select(*[F.col(f.name).cast(f.dataType) for f in schema])
        touched = self._touched(commit, last)
        kept = self._rows(commit, touched).join(last.select(*key), key, "left_anti")
        return self._change(commit, touched, kept.select(*schema.names).unionByName(last))

    def delete(self, keys: DataFrame) -> int:
        """Remove the rows of the keys of a table."""
        commit = self.commit()
        gone = keys.select(*commit["key"]).distinct()
        touched = self._touched(commit, gone)
        return self._change(commit, touched, self._rows(commit, touched).join(gone, commit["key"], "left_anti"))

    def replace(self, rows: DataFrame, parts: list[str], order: str | None = None) -> int:
        """Replace all rows of the parts (values of some columns) that ``rows`` hold, so that none of a longer former state stays.

        Buckets are told by keys, so those that hold rows of the parts are looked for first."""
        commit = self.commit()
        key, schema = commit["key"], StructType.fromJson(commit["schema"])
        last = _last(rows, key, order).select(*[F.col(f.name).cast(f.dataType) for f in schema])
        gone = last.select(*parts).distinct()
        held = self._rows(commit)
        touched = sorted({*self._touched(commit, last), *self._touched(commit, held.join(gone, parts, "left_semi"))})
        kept = self._rows(commit, touched).join(gone, parts, "left_anti").join(last.select(*key), key, "left_anti")
        return self._change(commit, touched, kept.select(*schema.names).unionByName(last))

    def reset(self) -> int:
        """A version without rows."""
        commit = self.commit()
        self._commit(commit["version"] + 1, commit | {"data": {}})
        return commit["version"] + 1

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove the versions before the last ``keep``, and folders that no version left names; their readers must be done."""
        held = self.versions()
        for version in held[:-keep]:
            self.files.remove(f"{self.path}/commits/{version:012d}.json")
        used = {change for v in held[-keep:] for change in self.commit(v)["data"].values()}
        gone = [n for n in self.files.names(f"{self.path}/data") if n not in used]
        for name in gone:
            self.files.remove(f"{self.path}/data/{name}")
        return gone

    def _bucket(self, commit: dict):
        return F.pmod(F.xxhash64(*commit["key"]), F.lit(commit["buckets"])).cast("int")

    def _touched(self, commit: dict, rows: DataFrame) -> list[int]:
        """Numbers of buckets: no more than the table has."""
        schema = StructType.fromJson(commit["schema"])
        typed = rows.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in commit["key"]])
        return sorted(r[0] for r in typed.select(self._bucket(commit)).distinct().collect())

    def _change(self, commit: dict, touched: list[int], rows: DataFrame) -> int:
        change = uuid.uuid4().hex
        folder = f"{self.path}/data/{change}"
        bucketed = rows.withColumn("bucket", self._bucket(commit))
        bucketed.repartition(max(1, len(touched)), "bucket").write.partitionBy("bucket").parquet(folder)
        filled = {int(n.removeprefix("bucket=")) for n in self.files.names(folder) if n.startswith("bucket=")}
        data = {b: c for b, c in commit["data"].items() if int(b) not in touched} | {str(b): change for b in filled}
        self._commit(commit["version"] + 1, commit | {"data": data})
        return commit["version"] + 1


def _last(rows: DataFrame, key: list[str], order: str | None) -> DataFrame:
    if order is None:
        return rows.dropDuplicates(key)
    fields = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(*[F.col(k).alias(f"_{k}_") for k in key]).agg(F.max_by(fields, order).alias("_row")).select("_row.*")
