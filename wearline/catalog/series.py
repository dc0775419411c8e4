"""Per-engine window features and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.catalog.registry import ENGINE, PANEL_SQL, SERIES, frame, query, rounded
from wearline.operators import sequences as seq
from wearline.operators import windows as win
from wearline.operators.ordering import number_rows
from wearline.operators.splits import split_chronological
from wearline.panel import PANEL_SENSORS, engine_panel
from wearline.plans.rul import train_rul
from wearline.schema import ENTITY, RUL
from wearline.session import stage

KEY = "dataset_id, engine_id, cycle"


def _mean(c: str, n: int) -> str:
    return f"round(avg({c}) OVER {frame(n)}, 6)"


def _std(c: str, n: int) -> str:
    return f"round(stddev_samp({c}) OVER {frame(n)}, 6)"


def _diff(c: str) -> str:
    return f"round(coalesce({c} - lag({c}) OVER ({SERIES}), 0), 6)"


@query("rolling_mean", PANEL_SQL + f"""
SELECT {KEY}, {', '.join(f"{_mean(c, n)} AS {c}_rollmean{n}" for c in ('sensor_1', 'sensor_3') for n in (3, 5))} FROM panel""")
def rolling_mean(spark, sf):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle", "sensor_1", "sensor_3")
    out = win.rolling_mean(panel, ["sensor_1", "sensor_3"], [3, 5], dense=True).drop("sensor_1", "sensor_3")
    return rounded(out, out.columns[3:])


@query("rolling_std", PANEL_SQL + f"""
SELECT {KEY}, {_std('sensor_1', 3)} AS sensor_1_rollstd3, {_std('sensor_1', 5)} AS sensor_1_rollstd5,
       coalesce({_std('sensor_1', 3)}, 0) AS filled FROM panel""")
def rolling_std(spark, sf):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle", "sensor_1")
    out = win.rolling_std(panel, ["sensor_1"], [3, 5], dense=True).drop("sensor_1")
    out = out.withColumn("filled", F.coalesce("sensor_1_rollstd3", F.lit(0.0)))
    return rounded(out, out.columns[3:])


@query("lag_diff", PANEL_SQL + f"SELECT {KEY}, {_diff('sensor_1')} AS sensor_1_diff1, {_diff('sensor_2')} AS sensor_2_diff1 FROM panel")
def lag_diff(spark, sf):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle", "sensor_1", "sensor_2")
    out = win.difference(panel, ["sensor_1", "sensor_2"], dense=True).drop("sensor_1", "sensor_2")
    return rounded(out, out.columns[3:])


@query("pct_of_group_max", PANEL_SQL + f"""
SELECT {KEY}, round(cycle / max(cycle) OVER ({ENGINE}), 6) AS cycle_pct_max FROM panel""")
def pct_of_group_max(spark, sf):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle")
    return rounded(win.share_of_group_max(panel, "cycle", "cycle_pct_max"), ["cycle_pct_max"])


SETTINGS = ["op_setting_1", "op_setting_2", "op_setting_3"]


@query("rolling_opsettings", PANEL_SQL + f"""
SELECT {KEY}, {_mean('cycle', 3)} AS cycle_rollmean3,
       {', '.join(f"{_mean(c, 3)} AS {c}_rollmean3" for c in SETTINGS)},
       {', '.join(f"{_diff(c)} AS {c}_diff1" for c in SETTINGS)} FROM panel""")
def rolling_opsettings(spark, sf):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle", *SETTINGS)
    features = {f"{c}_rollmean3": win.rolling_mean_of(c, 3) for c in ["cycle", *SETTINGS]}
    features |= {f"{c}_diff1": win.difference_of(c) for c in SETTINGS}
    out = win.over_series(panel, features, 2, ENTITY, "cycle", dense=True).drop(*SETTINGS)
    return rounded(out, out.columns[3:])


def _filled(c: str, method: str = "ffill") -> str:
    past = f"last_value({c} IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = f"first_value({c} IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"coalesce({past}, {ahead})" if method == "ffill" else f"coalesce({ahead}, {past})"


FILL_SQL = _filled("sensor_3")
FILLED = [*SETTINGS, *PANEL_SENSORS]
# More columns with gaps: at the start, in the middle and at the end of engines.
GAPPED = {"sensor_2": "cycle % 5 >= 2", "op_setting_2": "cycle > 3", "sensor_5": "cycle < life - 1"}


@query("ffill_bfill", PANEL_SQL + f"""
, g AS (SELECT {KEY}, {', '.join(f"CASE WHEN {GAPPED[c]} THEN {c} END AS {c}" if c in GAPPED else c for c in FILLED)} FROM panel)
""" + " UNION ALL ".join(f"SELECT {KEY}, '{m}' AS method, {', '.join(f'{_filled(c, m)} AS {c}' for c in FILLED)} FROM g" for m in ("ffill", "bfill")))
def ffill_bfill(spark, sf):
    gaps = {c: F.when(F.expr(condition), F.col(c)) for c, condition in GAPPED.items()}
    panel = stage(engine_panel(spark, sf).withColumns(gaps).select(*ENTITY, "cycle", *FILLED), "panel")
    forward, backward = (win.fill_series(panel, FILLED, m).withColumn("method", F.lit(m)) for m in ("ffill", "bfill"))
    return forward.unionByName(backward)


@query("latest_per_engine", PANEL_SQL + f"""
SELECT {KEY}, sensor_1, sensor_3 FROM test
QUALIFY row_number() OVER ({ENGINE} ORDER BY cycle DESC) = 1""")
def latest_per_engine(spark, sf):
    panel = engine_panel(spark, sf).where("cycle <= cutoff")
    return win.latest_rows(panel.select(*ENTITY, "cycle", "sensor_1", "sensor_3"))


@query("head_tail_per_engine", PANEL_SQL + f"""
, e AS (SELECT DISTINCT dataset_id, engine_id FROM panel ORDER BY 1, 2 LIMIT 3),
n AS (SELECT *, row_number() OVER ({SERIES}) AS up, row_number() OVER ({ENGINE} ORDER BY cycle DESC) AS down
      FROM panel JOIN e USING (dataset_id, engine_id))
SELECT {KEY}, life - cycle AS "RUL", up AS rank, 'head' AS part FROM n WHERE up <= 10
UNION ALL SELECT {KEY}, life - cycle, down, 'tail' FROM n WHERE down <= 10""")
def head_tail_per_engine(spark, sf):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle", (F.col("life") - F.col("cycle")).alias(RUL))
    chosen = panel.join(F.broadcast(win.first_engines(panel, 3)), ENTITY, "left_semi")
    return win.head_tail(chosen, 10).withColumn("rank", F.col("rank").cast("long"))


WINDOW_SUMS = """{key}, count(*) OVER w AS n_steps,
  sum(cycle * {a}) OVER w - (cycle - 30) * sum({a}) OVER w AS weighted_{a},
  sum(cycle * {b}) OVER w - (cycle - 30) * sum({b}) OVER w AS weighted_{b}"""


def _weighted(i: int):
    return F.aggregate(F.transform("seq", lambda s, t: (t + 1) * s[i]), F.lit(0.0), lambda a, x: a + x)


@query("rolling_sequences", PANEL_SQL + f"""
, s AS (SELECT {WINDOW_SUMS.format(key=KEY, a='sensor_1', b='sensor_2')} FROM panel WINDOW w AS {frame(30)})
SELECT {KEY}, n_steps, round(weighted_sensor_1, 4) AS weighted_1, round(weighted_sensor_2, 4) AS weighted_2
FROM s WHERE n_steps = 30""")
def rolling_sequences(spark, sf):
    made = seq.rolling_sequences(engine_panel(spark, sf), ["sensor_1", "sensor_2"], dense=True)
    out = made.select(*ENTITY, "cycle", F.size("seq").cast("long").alias("n_steps"),
                      _weighted(0).alias("weighted_1"), _weighted(1).alias("weighted_2"))
    return rounded(out, ["weighted_1", "weighted_2"], 4)


@query("sequence_index", PANEL_SQL + f"""
SELECT {KEY}, row_number() OVER (ORDER BY dataset_id, engine_id, cycle) - 1 AS sequence_idx FROM panel WHERE cycle >= 30""")
def sequence_index(spark, sf):
    panel = engine_panel(spark, sf)
    return seq.with_sequence_index(seq.rolling_sequences(panel, ["sensor_1"], dense=True), panel, dense=True).drop("seq")


@query("forecast_windows", PANEL_SQL + f"""
, f AS (SELECT {KEY}, {', '.join(f'lag(sensor_1, {6 - i}) OVER ({SERIES}) AS x{i}' for i in range(1, 6))}, sensor_1 AS y FROM panel)
SELECT * FROM f WHERE cycle > 5""")
def forecast_windows(spark, sf):
    made = seq.forecast_windows(engine_panel(spark, sf), "sensor_1", 5, dense=True)
    return made.select(*ENTITY, "cycle", *[F.col("x")[i - 1].alias(f"x{i}") for i in range(1, 6)], "y")


@query("impute_group_mean", PANEL_SQL + f"""
SELECT {KEY}, round(coalesce(sensor_3, avg(sensor_3) OVER ({ENGINE})), 6) AS sensor_3 FROM panel""")
def impute_group_mean(spark, sf):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle", "sensor_3")
    return rounded(win.impute_by_group(panel, ["sensor_3"], ENTITY, "mean"), ["sensor_3"])


@query("impute_group_median", PANEL_SQL + f"""
SELECT {KEY}, round(coalesce(sensor_3, quantile_cont(sensor_3, 0.5) OVER (PARTITION BY dataset_id)), 6) AS sensor_3 FROM panel""")
def impute_group_median(spark, sf):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle", "sensor_3")
    return rounded(win.impute_by_group(panel, ["sensor_3"], ["dataset_id"], "median"), ["sensor_3"])


@query("check_sequence_order", PANEL_SQL + f"""
, o AS (SELECT cycle < lag(cycle) OVER ({ENGINE} ORDER BY event_id) AS falls FROM panel),
s AS (SELECT count(*) OVER {frame(30)} AS n FROM panel)
SELECT (SELECT count(*) FROM o) AS n_rows, (SELECT count(*) FILTER (falls) FROM o) AS order_violations,
       count(*) AS n_windows, min(n) AS min_length, max(n) AS max_length FROM s WHERE n = 30""")
def check_sequence_order(spark, sf):
    panel = engine_panel(spark, sf)
    arrived = number_rows(panel.select(*ENTITY, "cycle", "event_id"), ENTITY, ["event_id"], "arrival")
    orders = seq.order_report(arrived, position="arrival", value="cycle")
    lengths = seq.length_report(seq.rolling_sequences(panel, ["sensor_1"], dense=True))
    return orders.select("*", *[lengths.select(c).scalar().alias(c) for c in lengths.columns])


@query("feature_engineering", PANEL_SQL + "SELECT {key}, {sensors}, {settings}, {cycle} FROM panel".format(
    key=KEY,
    sensors=", ".join(
        f"{_mean(c, 3)} AS {c}_rollmean3, coalesce({_std(c, 3)}, 0) AS {c}_rollstd3, {_mean(c, 5)} AS {c}_rollmean5, "
        f"coalesce({_std(c, 5)}, 0) AS {c}_rollstd5, {_diff(c)} AS {c}_diff1" for c in ("sensor_1", "sensor_2", "sensor_3", "sensor_5")),
    settings=", ".join(f"{_mean(c, 3)} AS {c}_rollmean3, {_diff(c)} AS {c}_diff1" for c in SETTINGS),
    cycle=f"{_mean('cycle', 3)} AS cycle_rollmean, round(cycle / max(cycle) OVER ({ENGINE}), 6) AS cycle_pct_max"))
def feature_engineering(spark, sf):
    from wearline.operators.quality import constant_columns

    panel = engine_panel(spark, sf).drop("event_id", "cutoff")
    sensors = [f"sensor_{i}" for i in range(1, 6)]
    out = win.add_engine_features(panel, constant_columns(panel, sensors), with_life_share=True, life="life", dense=True)
    out = out.drop(*sensors, *SETTINGS, "life")
    return rounded(out, out.columns[3:])


@query("window_position_stats", PANEL_SQL + f"""
, s AS (SELECT {KEY}, life, sensor_1, sensor_2 FROM panel),
t AS (SELECT unnest(generate_series(0, 29)) AS t)
SELECT t.t, f, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM (
  SELECT t.t, 0 AS f, sensor_1 AS v FROM s JOIN t ON s.cycle >= t.t + 1 AND s.cycle <= s.life - 29 + t.t
  UNION ALL SELECT t.t, 1, sensor_2 FROM s JOIN t ON s.cycle >= t.t + 1 AND s.cycle <= s.life - 29 + t.t) t
GROUP BY 1, 2""")
def window_position_stats(spark, sf):
    features = ["sensor_1", "sensor_2"]
    return rounded(seq.position_stats_of_rows(engine_panel(spark, sf), features, dense=True, length="life"), ["mean", "std"])


@query("window_position_stats_far_from_zero", PANEL_SQL + f"""
, s AS (SELECT {KEY}, life, 1e8 + sensor_1 / 1000 AS v FROM panel), t AS (SELECT unnest(generate_series(0, 29)) AS t)
SELECT t.t, 0 AS f, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std
FROM s JOIN t ON s.cycle >= t.t + 1 AND s.cycle <= s.life - 29 + t.t GROUP BY 1""")
def window_position_stats_far_from_zero(spark, sf):
    """Values whose spread is a billionth of their size."""
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle", (F.lit(1e8) + F.col("sensor_1") / 1000).alias("v"))
    return rounded(seq.position_stats_of_rows(panel, ["v"], dense=True), ["mean", "std"], 4)


@query("flat_windows_scaled", PANEL_SQL + f"""
, w AS (SELECT {KEY}, lag(sensor_1, 29) OVER ({SERIES}) AS a, lag(sensor_2, 14) OVER ({SERIES}) AS b, sensor_1 AS c
        FROM panel QUALIFY cycle >= 30)
SELECT {KEY}, round((a - avg(a) OVER ()) / stddev_pop(a) OVER (), 5) AS t0_f0, round((b - avg(b) OVER ()) / stddev_pop(b) OVER (), 5) AS t15_f1,
       round((c - avg(c) OVER ()) / stddev_pop(c) OVER (), 5) AS t29_f0 FROM w""")
def flat_windows_scaled(spark, sf):
    """Windows scaled by the statistics of each (time step, feature) place, then flattened."""
    features = ["sensor_1", "sensor_2"]
    panel = engine_panel(spark, sf)
    made = seq.rolling_sequences(panel, features, dense=True)
    scaled = seq.scale_flat_windows(made, seq.position_stats_of_rows(panel, features, dense=True, length="life"), 30, 2, [*ENTITY, "cycle"])
    flat = seq.flatten_windows(scaled, 30, 2, [*ENTITY, "cycle"])
    return rounded(flat.select(*ENTITY, "cycle", "t0_f0", "t15_f1", "t29_f0"), ["t0_f0", "t15_f1", "t29_f0"], 5)


@query("rul_on_sequences", PANEL_SQL + f"""
SELECT {KEY}, max(cycle) OVER ({ENGINE}) - cycle AS "RUL" FROM panel WHERE cycle >= 30""")
def rul_on_sequences(spark, sf):
    made = seq.rolling_sequences(engine_panel(spark, sf), ["sensor_1"], dense=True)
    return train_rul(made.select(*ENTITY, "cycle"))


GAPS_SQL = PANEL_SQL.replace("test AS (", "gaps AS (SELECT * FROM panel WHERE cycle >= 7 AND cycle % 5 <> 0),\ntest AS (")


def _panel_with_gaps(spark, sf):
    """Cycles start at 7 and every fifth is missing."""
    return engine_panel(spark, sf).where("cycle >= 7 AND cycle % 5 <> 0")


@query("rolling_with_gaps", GAPS_SQL + f"""
SELECT {KEY}, {_mean('sensor_1', 3)} AS sensor_1_rollmean3, {_mean('sensor_1', 5)} AS sensor_1_rollmean5,
       {_diff('sensor_2')} AS sensor_2_diff1 FROM gaps""")
def rolling_with_gaps(spark, sf):
    panel = _panel_with_gaps(spark, sf).select(*ENTITY, "cycle", "sensor_1", "sensor_2")
    out = win.difference(win.rolling_mean(panel, ["sensor_1"], [3, 5]), ["sensor_2"]).drop("sensor_1", "sensor_2")
    return rounded(out, out.columns[3:])


@query("sequences_with_gaps", GAPS_SQL + f"""
, s AS (SELECT dataset_id, engine_id, cycle, count(*) OVER {frame(12)} AS n_steps, avg(sensor_1) OVER {frame(12)} AS mean_1,
        row_number() OVER ({SERIES}) AS place FROM gaps),
w AS (SELECT *, row_number() OVER (ORDER BY dataset_id, engine_id, cycle) - 1 AS sequence_idx FROM s WHERE n_steps = 12)
SELECT {KEY}, n_steps, round(mean_1, 6) AS mean_1, sequence_idx FROM w""")
def sequences_with_gaps(spark, sf):
    panel = _panel_with_gaps(spark, sf)
    made = seq.with_sequence_index(seq.rolling_sequences(panel, ["sensor_1"], size=12), panel, size=12)
    total = F.aggregate("seq", F.lit(0.0), lambda a, s: a + s[0])
    out = made.select(*ENTITY, "cycle", F.size("seq").cast("long").alias("n_steps"), (total / 12).alias("mean_1"), "sequence_idx")
    return rounded(out, ["mean_1"])


@query("split_with_gaps", GAPS_SQL + f"""
SELECT {KEY}, row_number() OVER ({SERIES}) <= floor(count(*) OVER ({ENGINE}) * 0.8) AS is_train FROM gaps""")
def split_with_gaps(spark, sf):
    return split_chronological(_panel_with_gaps(spark, sf).select(*ENTITY, "cycle"))
