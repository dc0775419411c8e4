"""Joins of a smaller side to rows whose keys may be very uneven."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, side: DataFrame, on: list[str], how: str = "inner", missing: bool = False) -> DataFrame:
    """Join `side`, one row per key, to `df`; with `missing`, missing keys meet each other.

    A plain join: adaptive execution measures the side's bytes and broadcasts it where they are few,
    and splits the partitions of a key that holds a large share of the rows where they are not.
    """
    if not missing:
        return df.join(side, list(on), how)
    renamed = side.withColumnsRenamed({k: f"_on_{k}" for k in on})
    same = reduce(lambda x, y: x & y, [df[k].eqNullSafe(F.col(f"_on_{k}")) for k in on])
    return df.join(renamed, same, how).drop(*[f"_on_{k}" for k in on])
