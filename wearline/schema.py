"""Names and types of the sensor log, shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw log has these 26 fields in this order.
ENGINE_ID = "engine_id"
CYCLE = "cycle"
OP_SETTINGS = [f"op_setting_{i}" for i in range(1, 4)]
SENSORS = [f"sensor_{i}" for i in range(1, 22)]
LOG_COLUMNS = [ENGINE_ID, CYCLE, *OP_SETTINGS, *SENSORS]

DATASET_ID = "dataset_id"
RUL = "RUL"

# An engine id repeats across data sets, so one series is named by both columns.
ENTITY = [DATASET_ID, ENGINE_ID]

WINDOW_SIZE = 30
MODEL_FEATURES = 66

LOG_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c in (ENGINE_ID, CYCLE) else T.DoubleType()) for c in LOG_COLUMNS]
)


def columns_with_prefix(columns: list[str], prefix: str) -> list[str]:
    return [c for c in columns if c.startswith(prefix)]


def numeric_columns(schema: T.StructType, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def require_numeric(schema: T.StructType, columns: list[str]) -> None:
    """Fail before any job runs when a feature column is not numeric."""
    wrong = [c for c in columns if not isinstance(schema[c].dataType, T.NumericType)]
    if wrong:
        raise TypeError(f"feature columns are not numeric: {wrong}")
