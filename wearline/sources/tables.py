"""Tables, sequences, manifests and fitted parameters on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.operators.transforms import MANIFEST_SCHEMA, SCALER_SCHEMA
from wearline.schema import DATASET_ID


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; types are inferred only when no schema is given."""
    if schema is not None:
        return spark.read.schema(schema).csv(path, header=True)
    return spark.read.csv(path, header=True, inferSchema=True)


def write_sequences(seqs: DataFrame, path: str) -> None:
    """Windows with their keys in the same row, one folder per data set."""
    seqs.write.mode("overwrite").partitionBy(DATASET_ID).parquet(path)


def read_sequences(spark: SparkSession, path: str, datasets: list[str] | None = None) -> DataFrame:
    seqs = spark.read.parquet(path)
    return seqs.where(F.col(DATASET_ID).isin(datasets)) if datasets else seqs


def save_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").parquet(path)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def save_scaler(params: DataFrame, path: str) -> None:
    params.write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    """Fitted parameters; an absent folder is an error, so nothing is refitted silently."""
    return spark.read.schema(SCALER_SCHEMA).parquet(path)
