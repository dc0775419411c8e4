"""Positions, running totals and blocks: ordered work on series of any length.

A plain `Window.partitionBy(engine)` puts a whole engine in one task. Here a series is
numbered first and then cut into blocks of `BLOCK_ROWS` consecutive positions. Each block
also receives the last few rows of the block before it, so a frame that looks back n rows
finds them, and one very long engine is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wearline.operators.joins import attach
from wearline.session import stage, stage_counted

# Groups up to this many rows are ordered by one window task; longer ones by a range sort.
BOUNDED_ROWS = 1_000_000
BLOCK_ROWS = 16_384
# Keys of large groups that may be broadcast.
LARGE_GROUPS = 500_000


def _largest(df: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """Rows per key, and the largest number; one pass that reads the keys only and sends partial counts."""
    if not keys:
        return df, df.count()
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes, sizes.agg(F.max("_n")).first()[0] or 0


def groups_fit(df: DataFrame, keys: list[str], limit: int) -> bool:
    """Whether no key group has more than `limit` rows."""
    return _largest(df, keys)[1] <= limit


def split_by_size(df: DataFrame, keys: list[str], limit: float) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of groups up to `limit`, and rows of larger groups; None where there are none.

    At most one group per `limit` rows can be large, which bounds the list of their keys. Missing keys
    are a group like any other. An infinite limit says that the caller has checked the size.
    """
    if math.isinf(limit):
        return df, None
    sizes, most = _largest(df, keys)
    if most <= limit:
        return df, None
    if not keys:
        return None, df
    named = {k: f"_large_{i}" for i, k in enumerate(keys)}
    large, found = stage_counted(sizes.where(F.col("_n") > limit).select(*[F.col(k).alias(n) for k, n in named.items()]), "large")
    side = F.broadcast(large) if found <= LARGE_GROUPS else large
    same = reduce(lambda x, y: x & y, [df[k].eqNullSafe(F.col(n)) for k, n in named.items()])
    return df.join(side, same, "left_anti"), df.join(side, same, "left_semi")


def _placed(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows in global (keys, order) ranges, written with their range and place in it."""
    columns = [F.col(c) for c in [*keys, *order]]
    ranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return stage(
        ranged.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()),
        "placed",
    )


def _before_part(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Amount of earlier ranges and of all ranges, per key; a key has at most one row per range."""
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("_before", F.coalesce(F.sum("_amount").over(earlier), F.lit(0))).withColumn(
        "_total", F.sum("_amount").over(Window.partitionBy(*keys))
    )


def number_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    total: str | None = None,
    bounded_rows: float | None = None,
) -> DataFrame:
    """Dense positions 1..n per key in `order` (unique within a key), and n itself as `total`."""
    added = [name, *([total] if total else [])]
    usual, large = split_by_size(df, keys, BOUNDED_ROWS if bounded_rows is None else bounded_rows)
    numbered = []
    if usual is not None:
        by_key = Window.partitionBy(*keys)
        position = F.row_number().over(by_key.orderBy(*order)).cast("long")
        numbered.append(usual.select("*", position.alias(name), *_total_of(F.count(F.lit(1)).over(by_key), total)))
    if large is not None:
        placed = _placed(large, keys, order)
        parts = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_amount"), F.min("_row").alias("_first"))
        known = attach(placed, _before_part(parts, keys).drop("_amount"), [*keys, "_part"], missing=True)
        position = F.col("_row") - F.col("_first") + 1 + F.col("_before")
        numbered.append(known.select("*", position.alias(name), *_total_of(F.col("_total"), total)))
    return reduce(DataFrame.union, [part.select(*df.columns, *added) for part in numbered])


def _total_of(amount: Column, name: str | None) -> list[Column]:
    return [amount.alias(name)] if name else []


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    amount: str,
    name: str,
    total: str | None = None,
    bounded_rows: float | None = None,
) -> DataFrame:
    """Inclusive running sum of `amount` per key in `order` (unique within a key)."""
    added = [name, *([total] if total else [])]
    usual, large = split_by_size(df, keys, BOUNDED_ROWS if bounded_rows is None else bounded_rows)
    summed = []
    if usual is not None:
        by_key = Window.partitionBy(*keys)
        upto = by_key.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = F.sum(amount).over(upto)
        summed.append(usual.select("*", running.alias(name), *_total_of(F.sum(amount).over(by_key), total)))
    if large is not None:
        placed = _placed(large, keys, order)
        parts = placed.groupBy(*keys, "_part").agg(F.sum(amount).alias("_amount"))
        known = attach(placed, _before_part(parts, keys).drop("_amount"), [*keys, "_part"], missing=True)
        by_part = Window.partitionBy(*keys, "_part").orderBy(*order)
        running = F.col("_before") + F.sum(amount).over(by_part.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        summed.append(known.select("*", running.alias(name), *_total_of(F.col("_total"), total)))
    return reduce(DataFrame.union, [part.select(*df.columns, *added) for part in summed])


def block_of(position: str, block_rows: int | None = None) -> Column:
    rows = BLOCK_ROWS if block_rows is None else block_rows
    return F.expr(f"(`{position}` - 1) div {rows}")


def lay_blocks(df: DataFrame, position: str, before: int, block_rows: int | None = None) -> DataFrame:
    """Add `_block` and `_own`; the last `before` rows of a block also go to the next block.

    `position` must be dense per series. Copies carry `_own` = false and are dropped after
    the window expressions are computed.
    """
    # A frame may look back further than the usual block; blocks are then that long.
    rows = max(BLOCK_ROWS if block_rows is None else block_rows, before)
    home = block_of(position, rows)
    if before == 0:
        return df.withColumn("_block", home).withColumn("_own", F.lit(True))
    spills = (F.col(position) - 1) % rows >= rows - before
    targets = F.when(spills, F.array(home, home + 1)).otherwise(F.array(home))
    return df.withColumn("_block", F.explode(targets)).withColumn("_own", F.col("_block") == home)


def series_window(keys: list[str], position: str) -> WindowSpec:
    return Window.partitionBy(*keys, "_block").orderBy(position)


def over_series(
    df: DataFrame,
    features: Mapping[str, Callable[[WindowSpec], Column]],
    before: int,
    keys: list[str],
    position: str,
    block_rows: int | None = None,
    dense: bool = False,
) -> DataFrame:
    """Add window features to each row: one shuffle and one sort for all of them.

    `dense` says that `position` counts an engine's rows from 1. Otherwise the rows are numbered in
    its order first, so that gaps, late starts and any first value are fine.
    """
    if not dense:
        numbered = number_rows(df, list(keys), [position], "_place")
        return over_series(numbered, features, before, keys, "_place", block_rows, True).drop("_place")
    w = series_window(keys, position)
    laid = lay_blocks(df, position, before, block_rows)
    added = laid.select(*df.columns, "_own", *[make(w).alias(name) for name, make in features.items()])
    return added.where("_own").drop("_own")
