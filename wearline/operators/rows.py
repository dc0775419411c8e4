"""Row selection: membership, positions and whole-row operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.operators.ordering import number_rows

HEAD_ROWS = 100_000


def keep_selected(df: DataFrame, column: str, chosen: list, empty_means_all: bool) -> DataFrame:
    """Rows whose value was chosen; an empty choice shows everything or nothing, as asked."""
    if not chosen:
        return df if empty_means_all else df.where(F.lit(False))
    return df.where(F.col(column).isin(chosen))


def head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The last n rows, found from the end instead of by counting from the start."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def rows_between(df: DataFrame, order: list[str], first: int, stop: int) -> DataFrame:
    """Rows at 0-based positions first..stop-1 of the whole table in `order`.

    A slice near the start needs the first `stop` rows only.
    """
    if stop <= HEAD_ROWS:
        df = head(df, order, stop)
    numbered = number_rows(df, [], order, "_pos")
    return numbered.where(F.col("_pos").between(first + 1, stop)).drop("_pos")


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name; a column a frame lacks is missing there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
