"""Sensor panel over the `events` table: users stand for engines, events for cycles.

`user_id % 4` names the data set, so the same engine id occurs in up to four of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.operators.ordering import number_rows
from wearline.schema import ENTITY

PANEL_SENSORS = [f"sensor_{i}" for i in range(1, 6)]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def engine_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as one cycle of its engine, with the engine's life and the test cut-off."""
    events = table(spark, folder, "events")
    keyed = events.select(
        F.concat(F.lit("FD00"), (F.col("user_id") % 4 + 1).cast("string")).alias("dataset_id"),
        F.expr("user_id div 4").alias("engine_id"),
        "ts",
        "event_id",
        F.hour("ts").cast("double").alias("op_setting_1"),
        ((F.col("event_id") % 7).cast("double") / 10).alias("op_setting_2"),
        F.lit(100.0).alias("op_setting_3"),
        F.col("value").alias("sensor_1"),
        F.regexp_extract("props", "[0-9]+", 0).cast("double").alias("sensor_2"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("sensor_3"),
        F.lit(518.67).alias("sensor_4"),
        F.length("event_type").cast("double").alias("sensor_5"),
    )
    numbered = number_rows(keyed, ENTITY, ["ts", "event_id"], "cycle", total="life")
    cutoff = F.expr("(life * (50 + 5 * (engine_id % 10))) div 100")
    return numbered.select(
        *ENTITY,
        "cycle",
        "event_id",
        "op_setting_1",
        "op_setting_2",
        "op_setting_3",
        *PANEL_SENSORS,
        "life",
        cutoff.alias("cutoff"),
    )


def test_panel(spark: SparkSession, folder: str) -> DataFrame:
    """The truncated series an unfinished engine would show."""
    return engine_panel(spark, folder).where("cycle <= cutoff")


def truth(panel: DataFrame) -> DataFrame:
    """Remaining life at the cut-off, one row per engine."""
    return panel.groupBy(*ENTITY).agg((F.max("life") - F.max("cutoff")).alias("rul_true"))
