"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Round doubles, so that the last bits of sums do not matter."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


PANEL_SQL = """
WITH keyed AS (
  SELECT concat('FD00', cast(user_id % 4 + 1 AS varchar)) AS dataset_id,
         cast(floor(user_id / 4) AS bigint) AS engine_id,
         event_id, ts, event_type, value,
         cast(regexp_extract(props, '[0-9]+', 0) AS double) AS k
  FROM events),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY dataset_id, engine_id ORDER BY ts, event_id) AS cycle FROM keyed),
bounded AS (
  SELECT *, max(cycle) OVER (PARTITION BY dataset_id, engine_id) AS life FROM ordered),
panel AS (
  SELECT dataset_id, engine_id, cast(cycle AS bigint) AS cycle, event_id,
         cast(hour(ts) AS double) AS op_setting_1,
         cast(event_id % 7 AS double) / 10 AS op_setting_2,
         cast(100 AS double) AS op_setting_3,
         value AS sensor_1, k AS sensor_2,
         CASE WHEN event_type <> 'error' THEN value END AS sensor_3,
         cast(518.67 AS double) AS sensor_4,
         cast(length(event_type) AS double) AS sensor_5,
         cast(life AS bigint) AS life,
         cast(floor(life * (50 + 5 * (engine_id % 10)) / 100) AS bigint) AS cutoff
  FROM bounded),
test AS (SELECT * FROM panel WHERE cycle <= cutoff)
"""

ENGINE = "PARTITION BY dataset_id, engine_id"
SERIES = f"{ENGINE} ORDER BY cycle"


def frame(n: int) -> str:
    return f"({SERIES} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
