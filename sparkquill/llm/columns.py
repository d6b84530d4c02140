"""Names for columns, when a table may hold columns of any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """For each wanted name one that no column of ``df`` has: itself, or with underscores behind."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def own(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]
