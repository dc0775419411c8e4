"""Readers for whitespace-separated sensor logs and truth files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.operators.ordering import number_rows
from wearline.schema import DATASET_ID, LOG_SCHEMA
from wearline.session import path_exists

DATASET_PATTERN = "FD[0-9]+"


def dataset_of(path: Column) -> Column:
    """The last data set tag in a path, so that a folder's tag does not hide the file's; none is an error."""
    tag = F.regexp_extract(path, f".*({DATASET_PATTERN})", 1)
    return F.when(tag != "", tag).otherwise(F.raise_error(F.concat(F.lit("no data set tag in "), path)))


def _parsed(lines: DataFrame, schema: T.StructType, extra: list) -> DataFrame:
    """Split each line at runs of blanks; a field that does not parse, or is NaN, becomes missing."""
    clean = F.regexp_replace("value", r"^\s+|\s+$", "")
    fields = lines.where(clean != "").select(F.split(clean, r"\s+").alias("_f"), *extra)
    names = [e for e in fields.columns if e != "_f"]
    return fields.select(
        *names, *[_field(i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )


def _field(place: int) -> Column:
    text = F.get("_f", F.lit(place))
    return F.when(F.lower(text) != "nan", text)


def read_engine_log(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    """Headerless log with the fixed field names; leading, trailing and repeated blanks are fine."""
    return _parsed(spark.read.text(path), schema, [])


def existing_paths(spark: SparkSession, folder: str, numbers: list[int], pattern: str) -> list[str]:
    paths = [f"{folder}/{pattern.format(n)}" for n in numbers]
    found = [p for p in paths if path_exists(spark, p)]
    if not found:
        raise FileNotFoundError(f"none of {paths} exists")
    return found


def read_engine_logs(
    spark: SparkSession,
    folder: str,
    numbers: list[int],
    pattern: str = "train_FD00{}.txt",
    schema: T.StructType = LOG_SCHEMA,
) -> DataFrame:
    """Several subsets in one scan, each row tagged with its data set; missing files are skipped."""
    lines = spark.read.text(existing_paths(spark, folder, numbers, pattern))
    tag = dataset_of(F.col("_metadata.file_path")).alias(DATASET_ID)
    return _parsed(lines, schema, [tag])


def read_positional_truth(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Remaining life by line: line n of a data set belongs to engine n.

    Lines are ordered by file, by the offset of the split they were read from, and by their
    place in it, so the files may be of any size. Blank lines do not count; a line that does not
    parse keeps its engine, with a missing value.
    """
    lines = spark.read.text(paths).select(
        dataset_of(F.col("_metadata.file_path")).alias(DATASET_ID),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_offset"),
        F.monotonically_increasing_id().alias("_line"),
        F.regexp_replace("value", r"^\s+|\s+$", "").alias("_text"),
    )
    lines = lines.where("_text <> ''").withColumn("rul_true", F.col("_text").try_cast("long")).drop("_text")
    numbered = number_rows(lines, [DATASET_ID], ["_file", "_offset", "_line"], "engine_id")
    return numbered.select(DATASET_ID, "engine_id", "rul_true")
