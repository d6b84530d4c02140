"""Calls of a service that may fail: a ledger of attempts, tried again with a growing delay, resumed where it was left.

The ledger is a folder of journals, one for each round and bucket of calls. A task writes each outcome to its journal as soon as
it has it, so a task that is lost and runs again repeats no call whose outcome is there, and a run that was stopped goes on
where it ended. The ledger is read when a run begins; then each round gives its outcomes as a table, of which the next one takes
what failed. Calls that failed are due again after a delay that doubles up to a bound; a round calls what is due by then.
Nothing sleeps inside tasks.

The folder must be one to which pyarrow's file systems append and which all executors share (a mounted one, or HDFS). Two copies
of a task at a time would both call, so speculative execution must be off.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import count

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from sparkquill.shared import stored

#: What a journal holds of a try: its number, when it ended (seconds), the answer with its tokens, or the error.
OUTCOME = "try int, at double, raw string, input_tokens long, output_tokens long, error string"
BUCKETS = 64
RESULT = [StructField("tries", IntegerType()), StructField("raw", StringType()), StructField("input_tokens", LongType()), StructField("output_tokens", LongType()), StructField("error", StringType())]


class Exhausted(RuntimeError):
    """Calls failed as often as they may."""


@dataclass(frozen=True)
class Policy:
    """How often a call is tried and how long it waits after each failure. ``raises``: a call that fails to the end ends the run."""

    tries: int = 4
    first: float = 1.0
    most: float = 8.0
    raises: bool = False

    def delay(self, failures: int) -> float:
        """Seconds after so many failures."""
        return min(self.most, self.first * 2 ** (failures - 1)) if failures else 0.0


#: Answers of a model: four tries, then an empty answer. Embeddings: five, without a bound on the delay, then an error.
ANSWERS, EMBEDDINGS = Policy(), Policy(tries=5, most=float("inf"), raises=True)

#: Gets a call's columns, as Arrow gives them to Python, and the number of the try, from 1; gives the answer and its tokens in and out.
Provider = Callable[[dict, int], tuple[str, int, int]]


def _uri(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class Journal:
    """The outcomes of one bucket, as lines that are only ever added to; ``part`` names a round."""

    def __init__(self, path: str, bucket: int, part: str = ""):
        self.store, folder = _uri(path)
        self.store.create_dir(f"{folder}/calls", recursive=True)
        self.file = f"{folder}/calls/{bucket:05d}{part}.json"
        self.held: dict[tuple, dict] = {}
        torn = False
        if self.store.get_file_info(self.file).type == fs.FileType.File:
            with self.store.open_input_stream(self.file) as stream:
                data = stream.read()
            torn = bool(data) and not data.endswith(b"\n")
            for line in data.split(b"\n"):
                try:
                    one = json.loads(line)
                except ValueError:
                    continue  # cut off as its task was lost
                self.held[*one["key"], one["try"]] = one
        self.out = self.store.open_append_stream(self.file)
        if torn:
            self.out.write(b"\n")

    def add(self, key: list, outcome: dict) -> None:
        self.out.write(json.dumps({"key": key, **outcome}, ensure_ascii=False).encode() + b"\n")
        self.out.flush()

    def close(self) -> None:
        self.out.close()


def outcomes(spark: SparkSession, path: str, keys: list[StructField]) -> DataFrame:
    """All that the ledger holds: the key columns and OUTCOME, a row for each try."""
    store, folder = _uri(path)
    if store.get_file_info(f"{folder}/calls").type != fs.FileType.Directory:
        return spark.createDataFrame([], StructType([*keys, *StructType.fromDDL(OUTCOME).fields]))
    lines = spark.read.schema(f"key array<string>, {OUTCOME}").json(f"{path}/calls").filter("key is not null and try is not null")
    named = lines.select(*[F.col("key")[i].cast(k.dataType).alias(k.name) for i, k in enumerate(keys)], *[f"`{c}`" for c in StructType.fromDDL(OUTCOME).names])
    return named.dropDuplicates([*[k.name for k in keys], "try"])


def _latest(tried: DataFrame, keys: list[str]) -> DataFrame:
    """Per call: how often it was tried, when last, and the outcome that counts: the answer, else the last error."""
    rank = F.struct(F.col("error").isNull().alias("ok"), "try", "at", "raw", "input_tokens", "output_tokens", "error")
    return tried.groupBy(*keys).agg(F.max(rank).alias("_best"), F.max("try").alias("_tries"), F.max("at").alias("_at"))


def called(
    calls: DataFrame,
    keys: list[str],
    provider: Provider,
    path: str,
    policy: Policy = ANSWERS,
    workers: int | None = None,
    buckets: int = BUCKETS,
    wait: Callable[[float], None] = time.sleep,
    clock: Callable[[], float] = time.time,
) -> DataFrame:
    """``calls`` with tries, raw, input_tokens, output_tokens, error: the answer of ``provider``.

    ``keys`` name a call within the ledger at ``path`` (unique, not null, told apart as text). A call that fails to the end has
    an empty answer and its last error, or ends the run (``policy.raises``). Outcomes that the ledger holds are used, not called
    again. ``workers`` bounds the tasks, and so the calls at a time."""
    spark = calls.sparkSession
    fields = [calls.schema[k] for k in keys]
    columns = calls.columns
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}_") for k in keys])

    bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")
    delay = F.least(F.lit(float(policy.most)), F.lit(float(policy.first)) * F.pow(F.lit(2.0), F.col("tries") - 1))
    is_open = F.col("error").isNotNull() & (F.col("tries") < policy.tries) | (F.col("tries") == 0)
    run, rounds = uuid.uuid4().hex[:12], count(1)
    schema = StructType([*calls.schema.fields, *RESULT, StructField("_at", DoubleType())])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields[len(columns) :]]

    def known() -> DataFrame:
        """The calls as the ledger has them."""
        found = _latest(outcomes(spark, path, fields), keys).withColumnsRenamed({k: f"_{k}_" for k in keys})
        best = {"tries": F.coalesce("_tries", F.lit(0)).cast("int"), **{f.name: F.col(f"_best.{f.name}") for f in RESULT[1:]}}
        return calls.join(found, same, "left").withColumns(best).select(*columns, *best, "_at")

    def asked(ready: DataFrame, part: str) -> DataFrame:
        """The same rows with the outcomes of one more try."""

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            journal, at = None, None
            try:
                for batch in batches:
                    found = []
                    for row in batch.to_pylist():
                        if row["_bucket"] != at:
                            if journal:
                                journal.close()
                            at = row["_bucket"]
                            journal = Journal(path, at, part)
                        key, number = [str(row[k]) for k in keys], row["_failures"] + 1
                        outcome = journal.held.get((*key, number))  # of this task, before it was lost
                        if outcome is None:
                            outcome = {"try": number, "raw": "", "input_tokens": 0, "output_tokens": 0, "error": None}
                            try:
                                outcome["raw"], outcome["input_tokens"], outcome["output_tokens"] = provider({c: row[c] for c in columns}, number)
                            except Exception as e:  # noqa: BLE001  whatever a service does, the others go on
                                outcome["error"] = f"{type(e).__name__}: {e}"
                            outcome["at"] = clock()
                            journal.add(key, outcome)
                        found.append(tuple(outcome[c] for c in ("try", "raw", "input_tokens", "output_tokens", "error", "at")))
                    if found:
                        values = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=True)]
                        yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *values], names=schema.names)
            finally:
                if journal:
                    journal.close()

        dealt = ready.select(*columns, bucket.alias("_bucket"), F.col("tries").alias("_failures"))
        dealt = dealt.repartition(min(workers or int(spark.conf.get("spark.sql.shuffle.partitions")), buckets), "_bucket").sortWithinPartitions("_bucket")
        return dealt.mapInArrow(ask, schema)

    def due(table: DataFrame, after: float) -> DataFrame:
        """The calls of a table that are to be made later than ``after``."""
        at = F.when(F.col("tries") > 0, F.col("_at") + delay).otherwise(F.lit(0.0))
        return table.filter(is_open).withColumn("_due", at).filter(F.col("_due") > after)

    tables = [stored(known(), "calls")]
    waiting = [(tables[0], -math.inf)]  # with the time up to which its calls are made
    while True:
        least = [due(t, after).agg(F.min("_due").alias("least")).withColumn("i", F.lit(i)) for i, (t, after) in enumerate(waiting)]
        first = {r.i: r.least for r in reduce(DataFrame.unionByName, least).collect() if r.least is not None} if least else {}
        if not first:
            break
        now = clock()
        if min(first.values()) > now:
            wait(min(first.values()) - now)
            now = max(min(first.values()), clock())
        ready = reduce(DataFrame.unionByName, [due(*waiting[i]).filter(F.col("_due") <= now) for i in first])
        tables.append(stored(asked(ready, f"-{run}-{next(rounds):05d}"), "tried"))
        waiting = [*[(waiting[i][0], max(waiting[i][1], now)) for i in first], (tables[-1], -math.inf)]
    found = reduce(DataFrame.unionByName, [t.filter(~is_open) for t in tables])
    if policy.raises and (bad := found.filter("error is not null").select(*keys, "error").first()):
        raise Exhausted(f"a call failed {policy.tries} times: {bad.asDict()}")
    failed = F.col("error").isNotNull()
    taken = {"raw": F.when(failed, "").otherwise(F.col("raw"))} | {c: F.when(failed, 0).otherwise(F.col(c)).cast("long") for c in ("input_tokens", "output_tokens")}
    return found.withColumns(taken).select(*columns, *[f.name for f in RESULT])
