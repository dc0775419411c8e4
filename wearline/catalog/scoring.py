"""Regressors on window features and their scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.catalog.registry import PANEL_SQL, SERIES, frame, query, rounded
from wearline.operators.sequences import of_shape, rolling_sequences
from wearline.panel import engine_panel
from wearline.plans import learning, serving
from wearline.plans.rul import actual_and_predicted, regression_metrics
from wearline.schema import ENTITY, RUL, WINDOW_SIZE
from wearline.session import stage

CYCLES = [*ENTITY, "cycle"]
FEATURES = ["sensor_1", "sensor_2"]


def _predicted(spark, sf):
    """The panel's target beside a deterministic prediction."""
    rul = F.col("life") - F.col("cycle")
    return engine_panel(spark, sf).select(*CYCLES, rul.alias(RUL), (rul + F.col("event_id") % 11 - 5).cast("double").alias("prediction"))


@query("metrics_regression", PANEL_SQL + """
, e AS (SELECT cast(life - cycle AS double) AS y, cast(event_id % 11 - 5 AS double) AS d FROM panel)
SELECT count(*) AS n, round(avg(d * d), 6) AS mse, round(sqrt(avg(d * d)), 6) AS rmse, round(avg(abs(d)), 6) AS mae,
       round(1 - sum(d * d) / (var_pop(y) * count(*)), 6) AS r2 FROM e""")
def metrics_regression(spark, sf):
    return rounded(regression_metrics(_predicted(spark, sf), RUL, "prediction"), ["mse", "rmse", "mae", "r2"])


@query("pred_vs_actual", PANEL_SQL + """
SELECT dataset_id, engine_id, cycle, life - cycle AS "RUL", cast(life - cycle + event_id % 11 - 5 AS double) AS prediction
FROM panel ORDER BY 1, 2, 3 LIMIT 200""")
def pred_vs_actual(spark, sf):
    both = _predicted(spark, sf)
    return actual_and_predicted(both.select(*CYCLES, RUL), both.select(*CYCLES, "prediction"), CYCLES, 0, 200)


def _windows(spark, sf):
    """Written features of all windows of the right shape; windows are built once."""
    panel = engine_panel(spark, sf).withColumn(RUL, (F.col("life") - F.col("cycle")).cast("double"))
    seqs = of_shape(rolling_sequences(panel, FEATURES, carry=[RUL], dense=True), WINDOW_SIZE, len(FEATURES))
    return stage(learning.window_features(seqs, FEATURES, [*CYCLES, RUL]), "features")


INPUTS = learning.feature_names(FEATURES)
WINDOW_SQL = PANEL_SQL + f"""
, w AS (SELECT dataset_id, engine_id, cycle, cast(life - cycle AS double) AS y, {', '.join(
    f"avg({c}) OVER {frame(30)} AS {c}_wmean, {c} AS {c}_last, {c} - lag({c}, 29) OVER ({SERIES}) AS {c}_change" for c in FEATURES)}
  FROM panel QUALIFY cycle >= 30)
"""


def least_squares_sql(source: str, train: str) -> str:
    """Linear regression of y on INPUTS over the rows `train` of `source`, as CTEs up to `fitted`.

    Inputs are made orthogonal one after the other: each loses its regression on those before it, so
    every slope is a ratio of two sums. `slopes{j}` has the slopes of input j on the earlier ones,
    `gains` those of y.
    """
    sql = f"""
, m AS (SELECT avg(y) AS y, {', '.join(f'avg({x}) AS {x}' for x in INPUTS)} FROM {source} WHERE {train}),
t0 AS (SELECT s.*, s.y - m.y AS yc, {', '.join(f's.{x} - m.{x} AS x{j}' for j, x in enumerate(INPUTS))} FROM {source} s, m),
r0 AS (SELECT *, x0 AS r_0 FROM t0)"""
    for j in range(1, len(INPUTS)):
        slopes = ", ".join(f"sum(x{j} * r_{k}) / sum(r_{k} * r_{k}) AS b{k}" for k in range(j))
        sql += f""",
slopes{j} AS (SELECT {slopes} FROM r{j - 1} WHERE {train}),
r{j} AS (SELECT r.*, x{j} - ({' + '.join(f'b{k} * r_{k}' for k in range(j))}) AS r_{j} FROM r{j - 1} r, slopes{j})"""
    last = len(INPUTS) - 1
    return sql + f""",
gains AS (SELECT {', '.join(f'sum(yc * r_{k}) / sum(r_{k} * r_{k}) AS g{k}' for k in range(last + 1))} FROM r{last} WHERE {train}),
fitted AS (SELECT r.*, m.y + {' + '.join(f'g{k} * r_{k}' for k in range(last + 1))} AS prediction FROM r{last} r, gains, m)
"""


def coefficients_sql() -> str:
    """Terms of the fitted line from the slopes, last input first."""
    last = len(INPUTS) - 1
    beta = {}
    for j in range(last, -1, -1):
        later = "".join(f" - ({beta[k]}) * slopes{k}.b{j}" for k in range(j + 1, last + 1))
        beta[j] = f"g{j}{later}"
    tables = ", ".join(["gains", "m", *(f"slopes{j}" for j in range(1, last + 1))])
    terms = [f"SELECT '{x}' AS term, round({beta[j]}, 4) AS value FROM {tables}" for j, x in enumerate(INPUTS)]
    constant = " - ".join(["m.y", *(f"({beta[j]}) * m.{x}" for j, x in enumerate(INPUTS))])
    return " UNION ALL ".join([*terms, f"SELECT 'intercept', round({constant}, 4) FROM {tables}"])


FITTED_SQL = WINDOW_SQL + least_squares_sql("w", "TRUE")


@query("train_regressor", FITTED_SQL + coefficients_sql())
def train_regressor(spark, sf):
    features = _windows(spark, sf)
    model = learning.train_regressor(features, INPUTS)
    return rounded(learning.coefficients(features, model, INPUTS), ["value"], 4)


@query("score_batch", FITTED_SQL + """
SELECT count(*) AS n, round(min(prediction), 4) AS min, round(max(prediction), 4) AS max, round(avg(prediction), 4) AS mean FROM fitted""")
def score_batch(spark, sf):
    features = _windows(spark, sf)
    scored = learning.score_features(features, learning.train_regressor(features, INPUTS))
    return rounded(learning.prediction_summary(scored), ["min", "max", "mean"], 4)


SERVED_SQL = WINDOW_SQL + """
, e AS (SELECT dataset_id, engine_id, row_number() OVER (ORDER BY dataset_id, engine_id) AS no
        FROM (SELECT DISTINCT dataset_id, engine_id FROM w)),
d AS (SELECT *, row_number() OVER (ORDER BY (no * 48271 + 42) % 2147483647, no) <= ceil(0.2 * (SELECT count(*) FROM e)) AS is_test FROM e),
v AS (SELECT w.*, is_test FROM w JOIN d USING (dataset_id, engine_id))
""" + least_squares_sql("v", "NOT is_test")


@query("serve_validation_metrics", SERVED_SQL + """
SELECT count(*) AS n, round(avg((prediction - y) ** 2), 4) AS mse, round(sqrt(avg((prediction - y) ** 2)), 4) AS rmse,
       round(avg(abs(prediction - y)), 4) AS mae, round(1 - sum((prediction - y) ** 2) / (var_pop(y) * count(*)), 4) AS r2
FROM fitted WHERE is_test""")
def serve_validation_metrics(spark, sf):
    """Split by engine, scaler and model from the train engines, metrics on the others."""
    metrics = serving.train_and_validate(_windows(spark, sf), INPUTS)["metrics"]
    return rounded(metrics, ["mse", "rmse", "mae", "r2"], 4)


@query("serve_zone_counts", SERVED_SQL + """
, latest AS (SELECT prediction AS rul FROM fitted QUALIFY row_number() OVER (PARTITION BY dataset_id, engine_id ORDER BY cycle DESC) = 1),
zones AS (SELECT CASE WHEN rul > -1 AND rul <= 10 THEN 'Critical' WHEN rul > 10 AND rul <= 30 THEN 'Warning' WHEN rul > 30 THEN 'Safe' END AS alert FROM latest),
labels3 AS (SELECT 1 AS pos, 'Critical' AS label UNION ALL SELECT 2, 'Warning' UNION ALL SELECT 3, 'Safe')
SELECT cast(pos AS bigint) AS pos, label AS "Alert", count(alert) AS n FROM labels3 LEFT JOIN zones ON alert = label GROUP BY 1, 2""")
def serve_zone_counts(spark, sf):
    """Engines per alert zone by their latest predicted life."""
    served = serving.train_and_validate(_windows(spark, sf), INPUTS)
    return serving.maintenance(served["predictions"])["counts"]
