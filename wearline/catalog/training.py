"""Linear models on whole windows: fit, scores, grid search and training by steps.

The SQL builds every window and solves by coordinate descent or by steps in recursive queries.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.catalog.registry import PANEL_SQL, SERIES, query, rounded
from wearline.functions.scalar import modular_hash
from wearline.operators.joins import attach
from wearline.operators.ordering import number_rows
from wearline.operators.splits import split_by_engine
from wearline.panel import engine_panel
from wearline.plans import window_models as models
from wearline.plans.window_moments import window_moments
from wearline.schema import ENTITY, RUL
from wearline.session import fresh_path

FEATURES = ["sensor_1", "sensor_2", "sensor_5", "op_setting_1", "op_setting_2"]
STEPS = 5
INPUTS = [(t, f) for t in range(STEPS) for f in FEATURES]
K = len(INPUTS)
FOLDS = 3


def _panel(spark, sf):
    return engine_panel(spark, sf).select(*ENTITY, "cycle", "life", *FEATURES, (F.col("life") - F.col("cycle")).cast("double").alias(RUL))


ENGINES_SQL = """
, e AS (SELECT dataset_id, engine_id, row_number() OVER (ORDER BY dataset_id, engine_id) AS no
        FROM (SELECT DISTINCT dataset_id, engine_id FROM panel)),
d AS (SELECT *, (no * 48271 + 42) % 2147483647 % 3 AS fold,
             row_number() OVER (ORDER BY (no * 48271 + 42) % 2147483647, no) <= ceil(0.2 * (SELECT count(*) FROM e)) AS is_test FROM e)"""
WINDOWS_SQL = PANEL_SQL.replace("WITH", "WITH RECURSIVE", 1) + ENGINES_SQL + f""",
w AS MATERIALIZED (SELECT * FROM (
  SELECT dataset_id, engine_id, cycle, cast(life - cycle AS double) AS y,
         [{', '.join(f if t == STEPS - 1 else f"lag({f}, {STEPS - 1 - t}) OVER ({SERIES})" for t, f in INPUTS)}] AS x
  FROM panel QUALIFY cycle >= {STEPS}) JOIN d USING (dataset_id, engine_id))"""


def products_sql(source: str) -> str:
    """CTEs with the scaled mean products of each `part` of `source` (part, centred, x, y): `solved_by`.

    Inputs are scaled by their standard deviation, and taken about their means, as the target is, where `centred`.
    """
    return f""",
stat AS (SELECT part, list(m ORDER BY j) AS m, list(s ORDER BY j) AS s, any_value(my) AS my FROM (
  SELECT part, j, CASE WHEN any_value(centred) THEN avg(x[j]) ELSE 0 END AS m, stddev_pop(x[j]) AS s, CASE WHEN any_value(centred) THEN avg(y) ELSE 0 END AS my
  FROM {source}, (SELECT unnest(range(1, {K + 1})) AS j) GROUP BY part, j) GROUP BY part),
z AS MATERIALIZED (SELECT part, list_transform(range(1, {K + 1}), lambda j: (x[j] - m[j]) / s[j]) AS z, y - my AS r FROM {source} JOIN stat USING (part)),
solved_by AS MATERIALIZED (SELECT part, a, c FROM
  (SELECT part, list(g ORDER BY i) AS a FROM (SELECT part, i, list(g ORDER BY j) AS g FROM (
     SELECT part, i, j, avg(z[i] * z[j]) AS g FROM z, (SELECT unnest(range(1, {K + 1})) AS i), (SELECT unnest(range(1, {K + 1})) AS j) GROUP BY ALL) GROUP BY ALL) GROUP BY part)
  JOIN (SELECT part, list(g ORDER BY i) AS c FROM (SELECT part, i, avg(z[i] * r) AS g FROM z, (SELECT unnest(range(1, {K + 1})) AS i) GROUP BY ALL) GROUP BY part) USING (part))"""


def descent_sql(combinations: str, sweeps: int = 40) -> str:
    """CTE `settled`: weights of each row of `combinations` (part, reg, mix) after all sweeps of coordinate descent."""
    return f""",
descent AS (
  SELECT part, reg, mix, 0 AS step, list_transform(range({K}), lambda i: 0.0::DOUBLE) AS w FROM ({combinations})
  UNION ALL
  SELECT part, reg, mix, step + 1, list_transform(range(1, {K + 1}), lambda i: CASE WHEN i = step % {K} + 1 THEN new ELSE w[i] END)
  FROM (SELECT *, sign(pull) * greatest(abs(pull) - reg * mix, 0) / (own + reg * (1 - mix)) AS new
        FROM (SELECT descent.*, a[step % {K} + 1][step % {K} + 1] AS own,
                     c[step % {K} + 1] - list_dot_product(a[step % {K} + 1], w) + a[step % {K} + 1][step % {K} + 1] * w[step % {K} + 1] AS pull
              FROM descent JOIN solved_by USING (part) WHERE step < {K * sweeps}))),
settled AS MATERIALIZED (SELECT part, reg, mix, list_transform(range(1, {K + 1}), lambda j: w[j] / s[j]) AS w, my, m FROM descent JOIN stat USING (part) WHERE step = {K * sweeps})"""


FITTED_SQL = WINDOWS_SQL + ", one AS (SELECT 1 AS part, TRUE AS centred, x, y FROM w)" + products_sql("one") + descent_sql("SELECT 1 AS part, 0.0 AS reg, 0.0 AS mix")


@query("train_on_windows", FITTED_SQL + f"""
SELECT cast((j - 1) // {len(FEATURES)} AS integer) AS t, ['{"', '".join(FEATURES)}'][(j - 1) % {len(FEATURES)} + 1] AS feature, round(w[j], 4) AS value
FROM settled, (SELECT unnest(range(1, {K + 1})) AS j)
UNION ALL SELECT NULL, 'intercept', round(my - list_dot_product(w, m), 4) FROM settled""")
def train_on_windows(spark, sf):
    """Regression on every time step and feature of the windows, from lagged products of the rows."""
    moments = window_moments(_panel(spark, sf), FEATURES, size=STEPS, dense=True, length="life")[None]
    path = fresh_path(spark, "window-model")
    models.save_model(models.fit_window_model(moments), spark, path)
    return rounded(models.load_model(spark, path).table(spark), ["value"], 4)


@query("score_on_windows", FITTED_SQL + """
SELECT dataset_id, engine_id, cycle, round(my + list_dot_product(settled.w, x) - list_dot_product(settled.w, m), 4) AS prediction FROM w, settled""")
def score_on_windows(spark, sf):
    """Predictions of the fitted model as sums of earlier rows' weighted values."""
    panel = _panel(spark, sf)
    model = models.fit_window_model(window_moments(panel, FEATURES, size=STEPS, dense=True, length="life")[None])
    return rounded(models.score_rows(panel, model, dense=True), ["prediction"], 4)


GRID_SQL = WINDOWS_SQL + f"""
, sides AS (SELECT f * 2 + cast(centred AS integer) AS part, centred, x, y FROM w, (SELECT unnest(range({FOLDS})) AS f), (SELECT unnest([TRUE, FALSE]) AS centred) WHERE fold <> f)
""" + products_sql("sides") + descent_sql(
    "SELECT part, reg, mix FROM stat, (SELECT unnest([0.0, 0.1]::DOUBLE[]) AS reg), (SELECT unnest([0.0, 0.5]::DOUBLE[]) AS mix)",
    sweeps=1000,  # inputs that are not centred settle slowly
) + f"""
, errors AS (SELECT part, reg, mix, sqrt(avg((y - my - list_dot_product(settled.w, x) + list_dot_product(settled.w, m)) ** 2)) AS rmse
             FROM w JOIN settled ON w.fold = settled.part // 2 GROUP BY ALL),
scored AS (SELECT reg AS reg_param, mix AS elastic_net, part % 2 = 1 AS fit_intercept, avg(rmse) AS rmse FROM errors GROUP BY ALL)
SELECT reg_param, elastic_net, fit_intercept, round(rmse, 5) AS rmse,
       row_number() OVER (ORDER BY round(rmse, 6), reg_param, elastic_net, fit_intercept DESC) = 1 AS is_best FROM scored"""


@query("grid_search_cv", GRID_SQL)
def grid_search_cv(spark, sf):
    """2 x 2 x 2 combinations over three folds of whole engines, from the folds' moments."""
    panel = _panel(spark, sf)
    engines = number_rows(panel.select(*ENTITY).distinct(), [], ENTITY, "_no")
    folded = attach(panel, engines.select(*ENTITY, (modular_hash("_no", 42) % FOLDS).cast("int").alias("fold")), ENTITY)
    rows, _ = models.grid_search(window_moments(folded, FEATURES, size=STEPS, by="fold", dense=True, length="life"))
    return rounded(models.grid_table(spark, rows), ["rmse"], 5)


EPOCHS = 30
HISTORY_SQL = WINDOWS_SQL + """
, one AS (SELECT 1 AS part, TRUE AS centred, x, y FROM w WHERE NOT is_test)""" + products_sql("one") + f""",
checked AS MATERIALIZED (SELECT list_transform(range(1, {K + 1}), lambda j: (x[j] - m[j]) / s[j]) AS z, y - my AS r FROM w, stat WHERE is_test),
fixed AS MATERIALIZED (SELECT (SELECT a FROM solved_by) AS a, (SELECT c FROM solved_by) AS c, (SELECT avg(r * r) FROM z) AS yy),
steps AS (
  SELECT 0 AS epoch, list_transform(range({K}), lambda i: 0.0::DOUBLE) AS w, 0.1::DOUBLE AS rate, 0.1::DOUBLE AS used, 0.0::DOUBLE AS loss, 0.0::DOUBLE AS val_loss,
         'infinity'::DOUBLE AS best, 0 AS idle, 'infinity'::DOUBLE AS level, 0 AS flat
  UNION ALL
  SELECT epoch + 1, w, CASE WHEN val_loss < level - 1e-4 OR flat < 2 THEN rate ELSE greatest(rate * 0.5, 1e-5) END, rate, loss, val_loss,
         least(best, val_loss), CASE WHEN val_loss < best THEN 0 ELSE idle + 1 END,
         CASE WHEN val_loss < level - 1e-4 THEN val_loss ELSE level END, CASE WHEN val_loss < level - 1e-4 OR flat >= 2 THEN 0 ELSE flat + 1 END
  FROM (SELECT epoch, w, rate, best, idle, level, flat,
               yy - 2 * list_dot_product(w, c) + list_sum(list_transform(range(1, {K + 1}), lambda j: w[j] * list_dot_product(a[j], w))) AS loss,
               (SELECT avg((r - list_dot_product(z, w)) ** 2) FROM checked) AS val_loss
        FROM (SELECT epoch, list_transform(range(1, {K + 1}), lambda j: w[j] - rate * (list_dot_product(a[j], w) - c[j])) AS w, rate, best, idle, level, flat, a, c, yy
              FROM steps, fixed WHERE epoch < {EPOCHS} AND idle < 10)))
SELECT epoch, round(loss, 6) AS loss, round(val_loss, 6) AS val_loss, used AS rate, row_number() OVER (ORDER BY val_loss, epoch) = 1 AS is_best FROM steps WHERE epoch > 0"""


@query("training_history", HISTORY_SQL)
def training_history(spark, sf):
    """Loss per epoch on the engines of either side, with early stopping; the best epoch's model is kept."""
    marked = split_by_engine(_panel(spark, sf), 0.2)
    sides = window_moments(marked, FEATURES, size=STEPS, by="is_test", dense=True, length="life")
    state, _ = models.train_by_steps(sides[False], sides[True], EPOCHS, spark=spark, folder=fresh_path(spark, "training"))
    return rounded(models.history_table(spark, state), ["loss", "val_loss"])
