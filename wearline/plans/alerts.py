"""Risk levels, alert zones and maintenance boards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.functions.scalar import cut
from wearline.operators.aggregates import counts_for_labels
from wearline.operators.windows import first_engines, latest_rows
from wearline.schema import CYCLE, ENTITY, RUL

# Thresholds and labels of the two presets.
WARNING_RUL = 50
CRITICAL_RUL = 20
ZONE_EDGES = [-1, 10, 30, float("inf")]
ZONE_LABELS = ["Critical", "Warning", "Safe"]
ZONE_MESSAGES = {
    "Critical": f"URGENT: %d engine(s) CRITICAL (RUL <= {ZONE_EDGES[1]})",
    "Warning": f"HIGH PRIORITY: %d engine(s) WARNING ({ZONE_EDGES[1]}-{ZONE_EDGES[2]})",
    "Safe": "%d engine(s) SAFE",
}
TREND_ENGINES = 5


def risk_level(column: str = RUL, warning: float = WARNING_RUL, critical: float = CRITICAL_RUL) -> Column:
    """Critical up to one threshold, Warning up to the other, else Normal, also when missing."""
    value = F.col(column)
    return F.when(value <= critical, "Critical").when(value <= warning, "Warning").otherwise("Normal")


def alert_zone(column: str = RUL, edges: list[float] | None = None, labels: list[str] | None = None) -> Column:
    return cut(column, edges or ZONE_EDGES, labels or ZONE_LABELS)


def latest_zones(df: DataFrame, keys=ENTITY, position=CYCLE, edges: list[float] | None = None, labels: list[str] | None = None) -> DataFrame:
    """The last row of each engine with its alert zone."""
    return latest_rows(df.select(*keys, position, RUL), keys, position).withColumn("Alert", alert_zone(RUL, edges, labels))


def zone_counts(zones: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Engines per label, in the labels' order, zero where there are none."""
    return counts_for_labels(zones, "Alert", labels or ZONE_LABELS)


def zone_metrics(zones: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """One row: engines per zone and engines without one."""
    return zones.agg(
        *[F.count_if(F.col("Alert") == z).alias(z.lower()) for z in labels or ZONE_LABELS],
        F.count_if(F.col("Alert").isNull()).alias("null_zone"),
    )


def zone_messages(counts: DataFrame, messages: dict[str, str] | None = None) -> DataFrame:
    """Messages in order of severity, for zones that hold engines; `messages` has a text with one %d for a label.

    A label without a text of its own is named with its number of engines.
    """
    text = F.format_string("%d engine(s) %s", F.col("n"), F.upper("Alert"))
    for zone, message in (messages or ZONE_MESSAGES).items():
        text = F.when(F.col("Alert") == zone, F.format_string(message, F.col("n"))).otherwise(text)
    return counts.where("n > 0").select("pos", F.col("Alert").alias("level"), text.alias("message")).orderBy("pos")


def alert_board(zones: DataFrame, keys=ENTITY, position=CYCLE) -> DataFrame:
    return zones.select(*keys, position, F.bround(F.col(RUL).cast("double"), 1).alias(RUL), "Alert").orderBy(*keys)


def rul_trend(df: DataFrame, engines: DataFrame | None = None, keys=ENTITY, position=CYCLE) -> DataFrame:
    """Series of the chosen engines, by default the first five; an empty choice shows all."""
    chosen = first_engines(df, TREND_ENGINES, keys) if engines is None else engines.select(*keys).distinct()
    rows = df.select(*keys, position, RUL)
    if engines is None or not chosen.isEmpty():
        rows = rows.join(chosen, list(keys), "left_semi")
    return rows.orderBy(*keys, position)
