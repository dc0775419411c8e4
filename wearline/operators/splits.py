"""Sampling, train/test splits and class balancing with reproducible draws."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.functions.scalar import modular_hash
from wearline.operators.joins import attach
from wearline.operators.ordering import number_rows
from wearline.schema import CYCLE, ENTITY

DRAW_BLOCK = 65_536
# Hashes are below 2 ** 31, so there are at most 32,768 ranges.
HASH_RANGE = 65_536
DRAWS_PER_COPY = 1_000


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows drawn by hashed key; n is the sample size the caller asks for."""
    return df.orderBy(modular_hash(key, seed), key).limit(n)


def split_random(df: DataFrame, key: str, test_share: float, seed: int = 42) -> DataFrame:
    """Mark exactly ceil(share x n) rows as test, drawn by hashed unique key.

    Hashes are counted in ranges; only the range that holds the last test row is ordered. The rows
    themselves are split by comparing with that row and do not move.
    """
    drawn = df.select(modular_hash(key, seed).alias("_hash"), F.col(key).alias("_key"))
    drawn = drawn.withColumn("_range", F.expr(f"_hash div {HASH_RANGE}"))
    counts = sorted((r["_range"], r["count"]) for r in drawn.groupBy("_range").count().collect())
    size = math.ceil(test_share * sum(n for _, n in counts))
    if size == 0:
        return df.withColumn("is_test", F.lit(False))
    rank = size
    for place, n in counts:
        if rank <= n:
            break
        rank -= n
    last = drawn.where(F.col("_range") == place).orderBy("_hash", "_key").offset(rank - 1).first()
    mark = F.struct(modular_hash(key, seed).alias("h"), F.col(key).alias("k"))
    edge = F.struct(F.lit(last["_hash"]).alias("h"), F.lit(last["_key"]).alias("k"))
    return df.withColumn("is_test", mark <= edge)


def split_by_engine(df: DataFrame, test_share: float, seed: int = 42, keys=ENTITY) -> DataFrame:
    """Send whole engines to train or test, so that no window of one engine is in both."""
    engines = df.select(*keys).distinct()
    numbered = number_rows(engines, [], list(keys), "_no")
    marked = split_random(numbered, "_no", test_share, seed).drop("_no")
    return attach(df, marked, list(keys))


def split_chronological(df: DataFrame, train_share: float = 0.8, keys=ENTITY, position=CYCLE, dense: bool = False) -> DataFrame:
    """Mark the first share of each engine's rows as train.

    `dense` says that `position` counts the rows from 1; otherwise they are numbered here.
    """
    if dense:
        lengths = df.groupBy(*keys).agg(F.max(position).alias("_length"))
        placed, place = attach(df, lengths, list(keys)), position
    else:
        placed, place = number_rows(df, list(keys), [position], "_place", total="_length"), "_place"
    limit = F.floor(F.col("_length") * F.lit(train_share))
    return placed.withColumn("is_train", F.col(place) <= limit).select(*df.columns, "is_train")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def oversample_minority(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Every smaller class drawn with replacement up to the size of the largest.

    Rows of the largest class (of all classes of that size) and rows without a label stay as they
    are, with `draw` 0. Draw i of a class of m rows takes its row numbered hash(i) mod m. Draws are
    made in blocks; a row that expects many draws is copied, so that no task gets all of them.
    """
    present = df.where(F.col(label).isNotNull())
    sizes = class_balance(present, label)
    largest = sizes.agg(F.max("n")).first()[0] or 0
    numbered = number_rows(present, [label], [key], "_no", total="_size")
    parts = F.ceil(F.lit(largest) / (F.col("_size") * DRAWS_PER_COPY))
    copies = numbered.where(F.col("_size") < largest).withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    blocks = sizes.where(F.col("n") < largest).select(
        label, F.col("n").alias("_size"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit((largest - 1) // DRAW_BLOCK))).alias("_block")
    )
    first = F.col("_block") * DRAW_BLOCK + 1
    draws = blocks.select(label, "_size", F.explode(F.sequence(first, F.least(first + (DRAW_BLOCK - 1), F.lit(largest)))).alias("draw")).select(
        label, (modular_hash("draw", seed) % F.col("_size") + 1).alias("_no"), (F.col("draw") % parts).alias("_copy"), "draw"
    )
    drawn = copies.join(draws, [label, "_no", "_copy"]).select(*df.columns, "draw")
    largest_classes = sizes.where(F.col("n") == largest).select(label)
    kept = df.where(F.col(label).isNull()).unionByName(df.join(largest_classes, label, "left_semi"))
    return kept.withColumn("draw", F.lit(0).cast("long")).unionByName(drawn)
