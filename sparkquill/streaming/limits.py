"""The limit of ``operators.limiter`` on a stream: the state of a key is the starts of its last calls."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import ArrayType, LongType, StructField, StructType, TimestampType

STARTS = StructType([StructField("starts", ArrayType(LongType()))])


class Limit(StatefulProcessor):
    """Gives each call of a key its start. The state holds ``most`` numbers, however many calls there were."""

    def __init__(self, key: str, arrival: str, order: str, most: int, seconds: int):
        self.key, self.arrival, self.order, self.most, self.window = key, arrival, order, most, seconds * 1_000_000

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", STARTS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        starts = list(self.last.get()[0]) if self.last.exists() else []
        calls = pd.concat(list(rows)).sort_values([self.arrival, self.order])
        found = []
        for at in (calls[self.arrival].astype("datetime64[us]").astype("int64")).tolist():
            # a call that arrives late starts behind those that were admitted before it
            at = max([at, *starts[-1:]])
            if len(starts) == self.most:
                at = max(at, starts.pop(0) + self.window)
            starts.append(at)
            found.append(at)
        self.last.update((starts,))
        yield calls.assign(start=pd.to_datetime(found, unit="us"))

    def close(self) -> None:
        pass


def limited(calls: DataFrame, key: str, arrival: str, order: str, most: int, seconds: int) -> DataFrame:
    """A stream of ``calls`` with ``start``. Where no call comes after a later one of its key, starts are those of
    ``limiter.admitted``, whatever the batches. Needs the RocksDB state store."""
    known = calls.filter(f"`{arrival}` is not null")
    schema = StructType([*known.schema.fields, StructField("start", TimestampType())])
    return known.groupBy(key).transformWithStateInPandas(Limit(key, arrival, order, most, seconds), schema, outputMode="append", timeMode="none")
