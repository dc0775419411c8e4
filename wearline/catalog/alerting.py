"""RUL targets, risk levels, alert zones and boards."""

from __future__ import annotations

from wearline.catalog.registry import ENGINE, PANEL_SQL, query
from wearline.catalog.series import KEY
from wearline.panel import engine_panel, truth
from wearline.plans import alerts
from wearline.plans.rul import capped_rul, test_rul, train_rul
from wearline.plans.serving import maintenance
from wearline.schema import ENTITY, RUL

CYCLES = [*ENTITY, "cycle"]


def _unfinished(spark, sf):
    """Test series with their target: true life at the cut-off plus the cycles until then."""
    panel = engine_panel(spark, sf)
    return test_rul(panel.where("cycle <= cutoff").select(*CYCLES), truth(panel))


LATEST_SQL = PANEL_SQL + f"""
, latest AS (SELECT {KEY}, life - cycle AS rul FROM test QUALIFY row_number() OVER ({ENGINE} ORDER BY cycle DESC) = 1),
zones AS (SELECT *, CASE WHEN rul > -1 AND rul <= 10 THEN 'Critical' WHEN rul > 10 AND rul <= 30 THEN 'Warning'
                         WHEN rul > 30 THEN 'Safe' END AS alert FROM latest),
labels3 AS (SELECT 1 AS pos, 'Critical' AS label UNION ALL SELECT 2, 'Warning' UNION ALL SELECT 3, 'Safe'),
counts AS (SELECT cast(pos AS bigint) AS pos, label, count(alert) AS n FROM labels3 LEFT JOIN zones ON alert = label GROUP BY 1, 2)
"""


@query("rul_train", PANEL_SQL + f"SELECT {KEY}, life - cycle AS \"RUL\" FROM panel")
def rul_train(spark, sf):
    return train_rul(engine_panel(spark, sf).select(*CYCLES))


@query("rul_test_truth", PANEL_SQL + f"""
SELECT {KEY}, life - cycle AS "RUL" FROM test""")
def rul_test_truth(spark, sf):
    return _unfinished(spark, sf)


@query("rul_without_truth", PANEL_SQL + f"SELECT {KEY}, cast(0 AS bigint) AS \"RUL\" FROM test")
def rul_without_truth(spark, sf):
    return test_rul(engine_panel(spark, sf).where("cycle <= cutoff").select(*CYCLES))


@query("rul_capped", PANEL_SQL + f"SELECT {KEY}, least(life - cycle, 40) AS \"RUL\" FROM panel")
def rul_capped(spark, sf):
    return capped_rul(train_rul(engine_panel(spark, sf).select(*CYCLES)), 40)


@query("risk_level_thresholds", PANEL_SQL + f"""
SELECT {KEY}, CASE WHEN life - cycle <= 20 THEN 'Critical' WHEN life - cycle <= 50 THEN 'Warning' ELSE 'Normal' END AS risk
FROM test""")
def risk_level_thresholds(spark, sf):
    return _unfinished(spark, sf).select(*CYCLES, alerts.risk_level().alias("risk"))


@query("alert_zone_latest", LATEST_SQL + f"SELECT {KEY}, rul AS \"RUL\", alert AS \"Alert\" FROM zones")
def alert_zone_latest(spark, sf):
    return alerts.latest_zones(_unfinished(spark, sf))


@query("alert_zone_counts", LATEST_SQL + "SELECT pos, label AS \"Alert\", n FROM counts")
def alert_zone_counts(spark, sf):
    return alerts.zone_counts(alerts.latest_zones(_unfinished(spark, sf)))


@query("alert_metrics", LATEST_SQL + """
SELECT count(*) FILTER (alert = 'Critical') AS critical, count(*) FILTER (alert = 'Warning') AS warning,
       count(*) FILTER (alert = 'Safe') AS safe, count(*) FILTER (alert IS NULL) AS null_zone FROM zones""")
def alert_metrics(spark, sf):
    return alerts.zone_metrics(alerts.latest_zones(_unfinished(spark, sf)))


@query("alert_messages", LATEST_SQL + """
SELECT pos, label AS level, CASE label WHEN 'Critical' THEN concat('URGENT: ', n, ' engine(s) CRITICAL (RUL <= 10)')
       WHEN 'Warning' THEN concat('HIGH PRIORITY: ', n, ' engine(s) WARNING (10-30)')
       ELSE concat(n, ' engine(s) SAFE') END AS message FROM counts WHERE n > 0""")
def alert_messages(spark, sf):
    return alerts.zone_messages(alerts.zone_counts(alerts.latest_zones(_unfinished(spark, sf))))


EDGES = [-1.0, 5.0, 15.0, 40.0, float("inf")]
OWN_LABELS = ["Ground", "Inspect", "Watch", "Fly"]
OWN_MESSAGES = {"Ground": "ground %d now", "Watch": "watch %d"}
OWN_SQL = LATEST_SQL.replace("""CASE WHEN rul > -1 AND rul <= 10 THEN 'Critical' WHEN rul > 10 AND rul <= 30 THEN 'Warning'
                         WHEN rul > 30 THEN 'Safe' END""", """CASE WHEN rul > -1 AND rul <= 5 THEN 'Ground' WHEN rul > 5 AND rul <= 15 THEN 'Inspect'
                         WHEN rul > 15 AND rul <= 40 THEN 'Watch' WHEN rul > 40 THEN 'Fly' END""").replace(
    "SELECT 1 AS pos, 'Critical' AS label UNION ALL SELECT 2, 'Warning' UNION ALL SELECT 3, 'Safe'",
    "SELECT unnest([1, 2, 3, 4]) AS pos, unnest(['Ground', 'Inspect', 'Watch', 'Fly']) AS label")


def _own_zones(spark, sf):
    predictions = _unfinished(spark, sf).withColumnRenamed(RUL, "prediction")
    return maintenance(predictions, EDGES, OWN_LABELS, OWN_MESSAGES)


@query("own_zone_counts", OWN_SQL + "SELECT pos, label AS \"Alert\", n FROM counts")
def own_zone_counts(spark, sf):
    """Four zones of the caller's."""
    return _own_zones(spark, sf)["counts"]


@query("own_zone_metrics", OWN_SQL + "SELECT " + ", ".join(f"count(*) FILTER (alert = '{z}') AS {z.lower()}" for z in OWN_LABELS)
       + ", count(*) FILTER (alert IS NULL) AS null_zone FROM zones")
def own_zone_metrics(spark, sf):
    return _own_zones(spark, sf)["metrics"]


@query("own_zone_messages", OWN_SQL + """
SELECT pos, label AS level, CASE label WHEN 'Ground' THEN concat('ground ', n, ' now') WHEN 'Watch' THEN concat('watch ', n)
       ELSE concat(n, ' engine(s) ', upper(label)) END AS message FROM counts WHERE n > 0""")
def own_zone_messages(spark, sf):
    return _own_zones(spark, sf)["messages"]


@query("alert_board", LATEST_SQL + f"SELECT {KEY}, cast(rul AS double) AS \"RUL\", alert AS \"Alert\" FROM zones")
def alert_board(spark, sf):
    return alerts.alert_board(alerts.latest_zones(_unfinished(spark, sf)))


@query("rul_trend_selected", PANEL_SQL + f"""
, e AS (SELECT DISTINCT dataset_id, engine_id FROM test ORDER BY 1, 2 LIMIT 5)
SELECT {KEY}, life - cycle AS "RUL" FROM test JOIN e USING (dataset_id, engine_id)""")
def rul_trend_selected(spark, sf):
    return alerts.rul_trend(_unfinished(spark, sf))
