"""Remaining useful life: targets and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.functions.scalar import clip
from wearline.operators.aggregates import max_cycle
from wearline.operators.joins import attach
from wearline.schema import CYCLE, ENTITY, RUL

# Fixed value: the optional cap of the target.
RUL_CAP = 130


def train_rul(df: DataFrame, keys=ENTITY, position=CYCLE) -> DataFrame:
    """Cycles left until the engine's last one."""
    joined = attach(df, max_cycle(df, keys, position), list(keys))
    return joined.withColumn(RUL, F.col("max_cycle") - F.col(position)).drop("max_cycle")


def test_rul(df: DataFrame, truth: DataFrame | None = None, keys=ENTITY, position=CYCLE) -> DataFrame:
    """True life at the last cycle plus the cycles until then; engines without truth are dropped.

    Without any truth the target is 0.
    """
    if truth is None:
        return df.withColumn(RUL, F.lit(0).cast("long"))
    last = max_cycle(df, keys, position).join(truth, list(keys))
    joined = attach(df, last, list(keys))
    return joined.withColumn(RUL, F.col("rul_true") + F.col("max_cycle") - F.col(position)).drop("max_cycle", "rul_true")


def capped_rul(df: DataFrame, cap: int = RUL_CAP) -> DataFrame:
    return df.withColumn(RUL, clip(RUL, upper=cap))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MSE, RMSE, MAE and R2 in one aggregation, over rows that have both values.

    A constant target has no R2.
    """
    y = F.when(F.col(predicted).isNotNull(), F.col(actual).cast("double"))
    error = F.col(predicted).cast("double") - y
    return df.agg(
        F.count(error).alias("n"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
    )


def actual_and_predicted(truth: DataFrame, predictions: DataFrame, keys: list[str], first: int, last: int) -> DataFrame:
    """Rows first..last (from 0) of actual against predicted values in key order; the slice is the report."""
    joined = truth.join(predictions, keys)
    return joined.orderBy(*keys).offset(first).limit(last - first)
