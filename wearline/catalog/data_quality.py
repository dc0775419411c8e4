"""Profiles, imputation, constants, outliers, collinearity and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.catalog.aggregation import NUMBERS, _each
from wearline.catalog.registry import PANEL_SQL, query, rounded
from wearline.operators import aggregates, quality, rows
from wearline.operators.transforms import apply_imputer, fit_imputer
from wearline.panel import PANEL_SENSORS, engine_panel, table
from wearline.schema import ENTITY

PROFILED = [*ENTITY, "cycle", "event_id", "op_setting_1", "op_setting_2", "op_setting_3", *PANEL_SENSORS, "life", "cutoff"]
MISSING_SQL = " + ".join(f"count(*) - count({c})" for c in PROFILED)


def _metric(name: str, expression: str, source: str = "p") -> str:
    return f"SELECT '{name}' AS metric, round(cast({expression} AS double), 6) AS value FROM {source}"


PROFILE_SQL = " UNION ALL ".join(
    [
        _metric("rows", "count(*)"),
        _metric("columns", "max(14)"),
        _metric("type_bigint", "max(5)"),
        _metric("type_double", "max(8)"),
        _metric("type_string", "max(1)"),
        _metric("missing", MISSING_SQL),
        _metric("duplicates", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p))"),
        *[_metric(f"{c}_{n}", f"{f}({c})") for c in PANEL_SENSORS
          for n, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))],
        *[_metric(f"rows_FD00{i}", f"count(*) FILTER (dataset_id = 'FD00{i}')") for i in range(1, 5)],
    ]
)


@query("profile_table", PANEL_SQL + f", p AS (SELECT {', '.join(PROFILED)} FROM panel) {PROFILE_SQL}")
def profile_table(spark, sf):
    return rounded(quality.profile(engine_panel(spark, sf).select(*PROFILED)), ["value"])


@query("quality_report", PANEL_SQL + f", p AS (SELECT {', '.join(PROFILED)} FROM panel) " + " UNION ALL ".join([
    _metric("total_rows", "count(*)"), _metric("total_columns", "max(14)"),
    _metric("missing_values", MISSING_SQL),
    _metric("duplicate_rows", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p))"),
    _metric("numeric_columns", "max(13)"), _metric("inf_values", "count(*) FILTER (sensor_1 = 0)")]))
def quality_report(spark, sf):
    panel = engine_panel(spark, sf).select(*PROFILED)
    marked = panel.withColumn("sensor_1", F.when(F.col("sensor_1") == 0, F.lit(float("inf"))).otherwise(F.col("sensor_1")))
    return quality.quality_report(marked)


def _filled_sensor(spark, sf, strategy, constant=None):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle", "sensor_3")
    return rounded(apply_imputer(panel, fit_imputer(panel, ["sensor_3"], strategy, constant)), ["sensor_3"])


def _fill_sql(value: str) -> str:
    return PANEL_SQL + f"""
SELECT dataset_id, engine_id, cycle, round(coalesce(sensor_3, {value}), 6) AS sensor_3 FROM panel"""


@query("impute_constant", _fill_sql("0"))
def impute_constant(spark, sf):
    return _filled_sensor(spark, sf, "constant", 0.0)


@query("impute_mean", _fill_sql("(SELECT avg(sensor_3) FROM panel)"))
def impute_mean(spark, sf):
    return _filled_sensor(spark, sf, "mean")


@query("impute_median", _fill_sql("(SELECT quantile_cont(sensor_3, 0.5) FROM panel)"))
def impute_median(spark, sf):
    return _filled_sensor(spark, sf, "median")


@query("impute_mode", """
WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority FROM orders),
m AS (SELECT o_orderpriority AS v FROM o WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, coalesce(o_orderpriority, (SELECT v FROM m)) AS o_orderpriority FROM o""")
def impute_mode(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderpriority, '3-MEDIUM')").alias("o_orderpriority"))
    return apply_imputer(orders, fit_imputer(orders, ["o_orderpriority"], "most_frequent"))


CHECKED = ["op_setting_1", "op_setting_3", "sensor_1", "sensor_3", "sensor_4"]


@query("constant_columns", PANEL_SQL + _each("""
SELECT '{c}' AS "column", round(stddev_samp({c}), 6) AS std, min({c}) = max({c}) AS is_constant,
       count(DISTINCT {c}) AS n_distinct FROM panel""", CHECKED))
def constant_columns(spark, sf):
    return rounded(quality.constant_report(engine_panel(spark, sf), CHECKED), ["std"])


SKEWED = ["sensor_1", "sensor_2", "sensor_3", "sensor_5", "life"]


def _iqr_sql(columns: list[str]) -> str:
    return _each("""
SELECT '{c}' AS "column", count(*) FILTER ({c} < b.lo OR {c} > b.hi) AS n_outliers,
       round(100.0 * count(*) FILTER ({c} < b.lo OR {c} > b.hi) / count(*), 4) AS pct
FROM panel, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM panel)) b""", columns)


@query("outliers_iqr_count", PANEL_SQL + _iqr_sql(SKEWED))
def outliers_iqr_count(spark, sf):
    return rounded(quality.iqr_outliers(engine_panel(spark, sf), SKEWED), ["pct"], 4)


@query("outliers_zscore_count", _each("""
SELECT '{c}' AS "column", count(*) FILTER (abs(({c} - m) / s) > 1.5) AS n_outliers,
       round(100.0 * count(*) FILTER (abs(({c} - m) / s) > 1.5) / count(*), 4) AS pct
FROM lineitem, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM lineitem)""", NUMBERS))
def outliers_zscore_count(spark, sf):
    return rounded(quality.zscore_outliers(table(spark, sf, "lineitem"), NUMBERS), ["pct"], 4)


@query("topk_outlier_columns", PANEL_SQL + f"""
, o AS ({_iqr_sql(SKEWED)}) SELECT * FROM o WHERE n_outliers > 0 ORDER BY n_outliers DESC, "column" LIMIT 10""")
def topk_outlier_columns(spark, sf):
    outliers = quality.iqr_outliers(engine_panel(spark, sf), SKEWED)
    return rounded(quality.top_outlier_columns(outliers), ["pct"], 4)


EVENT_BOUNDS = """
WITH b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))
"""


@query("outliers_iqr_filter", EVENT_BOUNDS + "SELECT event_id, value FROM events, b WHERE value BETWEEN lo AND hi")
def outliers_iqr_filter(spark, sf):
    return quality.drop_outlier_rows(table(spark, sf, "events").select("event_id", "value"), ["value"])


@query("outliers_iqr_cap", EVENT_BOUNDS + """
SELECT event_id, round(CASE WHEN value > hi THEN hi WHEN value < lo THEN lo ELSE value END, 6) AS value FROM events, b""")
def outliers_iqr_cap(spark, sf):
    return rounded(quality.cap_outliers(table(spark, sf, "events").select("event_id", "value"), ["value"]), ["value"])


@query("vif_gram", """
WITH x AS (SELECT l_quantity AS x1, l_extendedprice AS x2,
                  coalesce(CASE WHEN l_linenumber <> 7 THEN l_discount END,
                           (SELECT avg(l_discount) FROM lineitem WHERE l_linenumber <> 7)) AS x3 FROM lineitem),
g AS (SELECT sum(x1 * x1) AS a, sum(x1 * x2) AS b, sum(x1 * x3) AS c, sum(x2 * x2) AS d, sum(x2 * x3) AS e,
             sum(x3 * x3) AS f FROM x),
h AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM g)
SELECT 'l_quantity' AS "column", round(a * (d * f - e * e) / det, 4) AS vif FROM h
UNION ALL SELECT 'l_extendedprice', round(d * (a * f - c * c) / det, 4) FROM h
UNION ALL SELECT 'l_discount', round(f * (a * d - b * b) / det, 4) FROM h""")
def vif_gram(spark, sf):
    line = table(spark, sf, "lineitem")
    marked = F.when(F.col("l_linenumber") == 7, F.lit(float("inf"))).otherwise(F.col("l_discount"))
    found = quality.variance_inflation(line.withColumn("l_discount", marked), ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(found, ["vif"], 4)


@query("histogram_equal_width", """
WITH r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM events),
c AS (SELECT cast(least(floor((value - lo) / w), 29) AS bigint) AS bin, count(*) AS n FROM events, r GROUP BY 1)
SELECT g AS bin, round(lo + g * w, 6) AS left_edge, round(lo + (g + 1) * w, 6) AS right_edge, coalesce(n, 0) AS n
FROM (SELECT unnest(generate_series(0, 29)) AS g), r LEFT JOIN c ON c.bin = g""")
def histogram_equal_width(spark, sf):
    return rounded(quality.histogram(table(spark, sf, "events"), "value", 30), ["left_edge", "right_edge"])


@query("kde_grid", """
WITH s AS (SELECT count(value) AS n, stddev_samp(value) * pow(count(value), -0.2) AS h, min(value) AS lo,
                  (max(value) - min(value)) / 49 AS step FROM events),
v AS (SELECT value AS x, count(*) AS c FROM events GROUP BY 1)
SELECT g AS point, round(lo + g * step, 6) AS x,
       round(sum(c * exp(-0.5 * pow((lo + g * step - v.x) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 8) AS density
FROM (SELECT unnest(generate_series(0, 49)) AS g), s, v GROUP BY g, lo, step""")
def kde_grid(spark, sf):
    grid = quality.density_grid(table(spark, sf, "events"), "value", 50)
    return rounded(rounded(grid, ["x"]), ["density"], 8)


BOX_SQL = """
SELECT {label} AS event_type, count(value) AS n, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
       min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
       max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
       count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM events JOIN (SELECT {key} AS k, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                         quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1) ON k = {key} GROUP BY {key}"""


@query("boxplot_stats", BOX_SQL.format(label="event_type", key="event_type") + " UNION ALL " + BOX_SQL.format(label="'all'", key="'all'"))
def boxplot_stats(spark, sf):
    events = table(spark, sf, "events").select("event_type", "value")
    whole = quality.box_stats(events, "value").withColumn("event_type", F.lit("all"))
    return rounded(rows.union_all(quality.box_stats(events, "value", ["event_type"]), whole), ["q1", "median", "q3"])


@query("group_spread", """
SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, round(stddev_samp(l_extendedprice), 4) AS std,
       round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS q3,
       round(quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25), 4) AS iqr
FROM lineitem GROUP BY 1, 2""")
def group_spread(spark, sf):
    spread = aggregates.group_spread(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return rounded(spread, ["std", "q1", "median", "q3", "iqr"], 4)
