"""Regressors on window features: training and batch scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.operators.sequences import of_shape
from wearline.schema import CYCLE, ENTITY, RUL


def window_features(seqs: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Mean, last value and change over the window for each feature, as columns."""
    size = F.size("seq")
    out = []
    for i, f in enumerate(features):
        series = series_of(i)
        total = F.aggregate(series, F.lit(0.0), lambda a, x: a + x)
        last, first = F.element_at(series, -1), F.element_at(series, 1)
        out += [(total / size).alias(f"{f}_wmean"), last.alias(f"{f}_last"), (last - first).alias(f"{f}_change")]
    return seqs.select(*keep, *out)


def series_of(feature: int) -> Column:
    """One feature of a window over its time steps."""
    return F.transform("seq", lambda step: step[feature])


def feature_names(features: list[str]) -> list[str]:
    return [f"{f}_{part}" for f in features for part in ("wmean", "last", "change")]


def train_regressor(df: DataFrame, inputs: list[str], label: str = RUL, regressor=None) -> PipelineModel:
    regressor = regressor or LinearRegression(regParam=0.0, solver="normal")
    regressor = regressor.setFeaturesCol("features").setLabelCol(label)
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    return Pipeline(stages=[assembler, regressor]).fit(df)


def coefficients(df: DataFrame, model: PipelineModel, inputs: list[str]) -> DataFrame:
    linear = model.stages[-1]
    rows = [*zip(inputs, map(float, linear.coefficients)), ("intercept", float(linear.intercept))]
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("value", T.DoubleType())])
    return df.sparkSession.createDataFrame(rows, schema)


def score_windows(seqs: DataFrame, model: PipelineModel, features: list[str], size: int) -> DataFrame:
    """Predictions for windows of the expected shape, by key."""
    checked = of_shape(seqs, size, len(features))
    return score_features(window_features(checked, features, [*ENTITY, CYCLE]), model)


def score_features(table: DataFrame, model: PipelineModel, keep: list[str] | None = None) -> DataFrame:
    """Predictions for a table of window features, by key."""
    return model.transform(table).select(*ENTITY, CYCLE, *(keep or []), "prediction")


def prediction_summary(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count("prediction").alias("n"),
        F.min("prediction").alias("min"),
        F.max("prediction").alias("max"),
        F.avg("prediction").alias("mean"),
    )
