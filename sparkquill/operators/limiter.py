"""A sliding-window limit on calls: of each key at most ``most`` begin within any ``seconds``, in the order of arrival.

The i-th call of a key starts when it arrives, or ``seconds`` after the start of the call ``most`` places before it, whichever
is later. Along i, i - most, i - 2 most ... this unrolls to a running maximum: with turn t(i) = i div most,

    start(i) = seconds * t(i) + max over j = i, i - most, ... of (arrival(j) - seconds * t(j)).

So no call waits for another to be worked out, and a key of any size is spread over tasks (``ordered.running``).
``streaming.limits`` gives the same starts to calls that come as a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkquill.operators.ordered import running


def admitted(calls: DataFrame, key: str, arrival: str, order: str, most: int, seconds: int, parts: int | None = None) -> DataFrame:
    """``calls`` with ``start`` (timestamp) and ``waited`` (seconds). Calls of one time go by ``order``, which is unique in a key.

    Calls without a key share one limit; calls without an arrival are never admitted: their start and wait are null, and
    they take no place."""
    if most < 1 or seconds < 0:
        raise ValueError("a limit admits at least one call, and its window is not negative")
    window = seconds * 1_000_000
    known = calls.filter(F.col(arrival).isNotNull()).withColumn("_us", F.unix_micros(F.col(arrival).cast("timestamp")))
    numbered = running(known, [key], [arrival, order], {"_i": ("count", F.lit(1))}, parts)
    numbered = numbered.withColumns({"_lane": (F.col("_i") - 1) % most, "_turn": F.floor((F.col("_i") - 1) / most)})
    led = running(numbered, [key, "_lane"], ["_i"], {"_lead": ("max", F.col("_us") - window * F.col("_turn"))}, parts)
    start = F.col("_lead") + window * F.col("_turn")
    found = led.withColumns({"start": F.timestamp_micros(start), "waited": (start - F.col("_us")) / F.lit(1e6)}).select(*calls.columns, "start", "waited")
    never = calls.filter(F.col(arrival).isNull()).withColumns({"start": F.lit(None).cast("timestamp"), "waited": F.lit(None).cast("double")})
    return found.unionByName(never)
