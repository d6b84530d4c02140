"""Places that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local temporary one is used only where that is unset (local mode)."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = f"file://{tempfile.mkdtemp(prefix='sparkquill-')}"
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: The tables of the scopes that are open in this thread, innermost last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, so that later reads survive lost executors.

    The table stays until its ``scratch`` scope ends; outside of one, until the session's driver ends."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if scopes := _scopes.get():
        scopes[-1].append(path)
    df.write.parquet(path)
    _at(spark, path).deleteOnExit(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))  # noqa: SLF001
    found = spark.read.schema(df.schema).parquet(path)
    found._stored_at = path  # noqa: SLF001
    return found


def _at(spark: SparkSession, path: str):
    """The file system of a path."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001


def removed(spark: SparkSession, path: str) -> None:
    _at(spark, path).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)  # noqa: SLF001


def dropped(table: DataFrame) -> None:
    """Remove a table that ``stored`` wrote and that no plan still to be run reads."""
    removed(table.sparkSession, table._stored_at)  # noqa: SLF001


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that ``stored`` writes within, at the end: by then, results must be written, as they read these tables."""
    held: list[str] = []
    token = _scopes.set((*_scopes.get(), held))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in held:
            removed(spark, path)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers that see this folder import the package, wherever the session was started from. Where they don't, ship it with --py-files."""
    root = str(Path(__file__).resolve().parent.parent)
    held = spark.sparkContext.environment
    if root not in held.get("PYTHONPATH", "").split(os.pathsep):
        held["PYTHONPATH"] = os.pathsep.join(filter(None, [root, held.get("PYTHONPATH", "")]))
    return spark
