"""Scaling, encoding, binning, alignment, splits, balancing and the composed preparations."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.catalog.projection import LINE_KEY, LINE_KEY_SQL
from wearline.catalog.registry import ENGINE, PANEL_SQL, SERIES, frame, query, rounded
from wearline.catalog.series import FILL_SQL, KEY
from wearline.functions.scalar import cut
from wearline.operators import rows, splits, transforms
from wearline.operators.sequences import window_totals
from wearline.operators.windows import rolling_mean
from wearline.panel import PANEL_SENSORS, engine_panel, table
from wearline.plans.preparation import prepare_complete, prepare_test, prepare_train
from wearline.panel import truth as engine_truth
from wearline.schema import ENTITY, RUL
from wearline.session import fresh_path, stage
from wearline.sources.tables import load_manifest, load_scaler, save_manifest, save_scaler

SCALED = ["l_quantity", "l_extendedprice"]


@query("scale_standard", "SELECT " + LINE_KEY_SQL + ", " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 6) AS {c}" for c in SCALED)
    + ", 0.0::double AS fixed FROM lineitem")
def scale_standard(spark, sf):
    line = table(spark, sf, "lineitem").select(*LINE_KEY, *SCALED, F.lit(21.61).alias("fixed"))
    columns = [*SCALED, "fixed"]
    return rounded(transforms.apply_scaler(line, transforms.fit_scaler(line, columns)), SCALED).withColumn(
        "fixed", F.round("fixed", 9) + F.lit(0.0)
    )


@query("scale_minmax", "SELECT " + LINE_KEY_SQL + ", " + ", ".join(
    f"round(({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem), 6) AS {c}" for c in SCALED)
    + " FROM lineitem")
def scale_minmax(spark, sf):
    line = table(spark, sf, "lineitem").select(*LINE_KEY, *SCALED)
    return rounded(transforms.apply_scaler(line, transforms.fit_scaler(line, SCALED), "minmax"), SCALED)


@query("scale_apply_fitted", PANEL_SQL + f"""
SELECT {KEY}, round((sensor_1 - (SELECT avg(sensor_1) FROM panel)) / (SELECT stddev_pop(sensor_1) FROM panel), 6) AS sensor_1,
       round((sensor_2 - (SELECT avg(sensor_2) FROM panel)) / (SELECT stddev_pop(sensor_2) FROM panel), 6) AS sensor_2
FROM test""")
def scale_apply_fitted(spark, sf):
    columns = ["sensor_1", "sensor_2"]
    panel = engine_panel(spark, sf)
    path = fresh_path(spark, "scaler")
    save_scaler(transforms.fit_scaler(panel, columns), path)
    unfinished = panel.where("cycle <= cutoff").select(*ENTITY, "cycle", *columns)
    return rounded(transforms.apply_scaler(unfinished, load_scaler(spark, path)), columns)


@query("onehot_drop_first", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS "seg_BUILDING",
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS "seg_FURNITURE",
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS "seg_HOUSEHOLD" FROM customer""")
def onehot_drop_first(spark, sf):
    customers = table(spark, sf, "customer")
    known = transforms.categories(customers.where("c_mktsegment <> 'MACHINERY'"), "c_mktsegment")
    return transforms.one_hot(customers.select("c_custkey", "c_mktsegment"), "c_mktsegment", known, True, "seg").drop("c_mktsegment")


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("get_dummies", "SELECT p_partkey, " + ", ".join(
    f"CASE WHEN p_type = '{t}' THEN 1 ELSE 0 END AS \"type_{t}\"" for t in TYPES) + " FROM part")
def get_dummies(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    return transforms.one_hot(part, "p_type", transforms.categories(part, "p_type"), False, "type").drop("p_type")


@query("cut_bins", """
SELECT o_orderkey, CASE WHEN o_totalprice > 1000 AND o_totalprice <= 50000 THEN 'low'
       WHEN o_totalprice > 50000 AND o_totalprice <= 200000 THEN 'mid'
       WHEN o_totalprice > 200000 AND o_totalprice <= 400000 THEN 'high' END AS band FROM orders""")
def cut_bins(spark, sf):
    band = cut("o_totalprice", [1000.0, 50000.0, 200000.0, 400000.0], ["low", "mid", "high"])
    return table(spark, sf, "orders").select("o_orderkey", band.alias("band"))


@query("qcut_quartiles", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS b,
                  quantile_cont(o_totalprice, 0.75) AS c FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice <= a THEN 0 WHEN o_totalprice <= b THEN 1 WHEN o_totalprice <= c THEN 2 ELSE 3 END AS quartile
FROM orders, q""")
def qcut_quartiles(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return transforms.quantile_bins(orders, "o_totalprice", 4, "quartile").drop("o_totalprice")


@query("feature_alignment", PANEL_SQL + f"""
SELECT {KEY}, op_setting_1, op_setting_2, op_setting_3, sensor_1, cast(0 AS double) AS sensor_2, sensor_3 FROM test""")
def feature_alignment(spark, sf):
    panel = engine_panel(spark, sf).drop("event_id", "life")
    path = fresh_path(spark, "manifest")
    save_manifest(transforms.feature_manifest(spark, panel.columns, 6), path)
    unfinished = panel.where("cycle <= cutoff").drop("sensor_2").withColumn("extra", F.lit(1.0))
    return transforms.align_features(unfinished, load_manifest(spark, path), [*ENTITY, "cycle"])


@query("split_random", """
SELECT o_orderkey, row_number() OVER (ORDER BY (o_orderkey * 48271 + 42) % 2147483647, o_orderkey)
       <= ceil(0.2 * (SELECT count(*) FROM orders)) AS is_test FROM orders""")
def split_random(spark, sf):
    return splits.split_random(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2)


@query("split_by_engine", PANEL_SQL + """
, e AS (SELECT dataset_id, engine_id, row_number() OVER (ORDER BY dataset_id, engine_id) AS no
        FROM (SELECT DISTINCT dataset_id, engine_id FROM panel)),
d AS (SELECT *, row_number() OVER (ORDER BY (no * 48271 + 42) % 2147483647, no) <= ceil(0.2 * (SELECT count(*) FROM e)) AS is_test FROM e)
SELECT dataset_id, engine_id, cycle, is_test FROM panel JOIN d USING (dataset_id, engine_id)""")
def split_by_engine(spark, sf):
    return splits.split_by_engine(engine_panel(spark, sf).select(*ENTITY, "cycle"), 0.2)


@query("split_chronological", PANEL_SQL + f"""
SELECT {KEY}, cycle <= floor(max(cycle) OVER ({ENGINE}) * 0.8) AS is_train FROM panel""")
def split_chronological(spark, sf):
    return splits.split_chronological(engine_panel(spark, sf).select(*ENTITY, "cycle"), dense=True)


BALANCED_SQL = """
WITH s AS (SELECT count(*) FILTER (quality = 0) AS bad, count(*) FILTER (quality = 1) AS good FROM labels),
minor AS (SELECT doc_id, quality, toxic, row_number() OVER (ORDER BY doc_id) AS no
          FROM labels WHERE quality = (SELECT CASE WHEN bad <= good THEN 0 ELSE 1 END FROM s)),
draws AS (SELECT unnest(generate_series(1, (SELECT greatest(bad, good) FROM s))) AS draw),
picked AS (SELECT draw, (draw * 48271 + 42) % 2147483647 % (SELECT count(*) FROM minor) + 1 AS no FROM draws),
balanced AS (
  SELECT doc_id, quality, toxic, cast(0 AS bigint) AS draw FROM labels
  WHERE quality <> (SELECT CASE WHEN bad <= good THEN 0 ELSE 1 END FROM s)
  UNION ALL SELECT doc_id, quality, toxic, draw FROM picked JOIN minor USING (no))
"""


@query("oversample_minority", BALANCED_SQL + "SELECT doc_id, quality, toxic, draw FROM balanced")
def oversample_minority(spark, sf):
    return splits.oversample_minority(table(spark, sf, "labels").select("doc_id", "quality", "toxic"), "quality", "doc_id")


@query("class_balance", BALANCED_SQL + """
SELECT 'before' AS stage, quality, count(*) AS n FROM labels GROUP BY 1, 2
UNION ALL SELECT 'after', quality, count(*) FROM balanced GROUP BY 1, 2""")
def class_balance(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    before = splits.class_balance(labels, "quality").select(F.lit("before").alias("stage"), "quality", "n")
    after = splits.class_balance(splits.oversample_minority(labels, "quality", "doc_id"), "quality")
    return rows.union_all(before, after.select(F.lit("after").alias("stage"), "quality", "n"))


CLASSES_SQL = """
WITH c AS (SELECT doc_id, CASE WHEN quality = 1 THEN CASE toxic WHEN 0 THEN 'good' ELSE 'rude' END WHEN toxic = 0 THEN 'poor' END AS class FROM labels),
s AS (SELECT class, count(*) AS n, max(count(*)) OVER () AS top FROM c WHERE class IS NOT NULL GROUP BY 1),
numbered AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY doc_id) AS no FROM c JOIN s USING (class) WHERE n < top),
draws AS (SELECT class, n, unnest(generate_series(1, top)) AS draw FROM s WHERE n < top),
picked AS (SELECT class, draw, (draw * 48271 + 42) % 2147483647 % n + 1 AS no FROM draws)
SELECT doc_id, class, cast(0 AS bigint) AS draw FROM c LEFT JOIN s USING (class) WHERE class IS NULL OR n = top
UNION ALL SELECT doc_id, class, draw FROM picked JOIN numbered USING (class, no)
"""


@query("oversample_classes", CLASSES_SQL)
def oversample_classes(spark, sf):
    """Three classes and rows without one."""
    label = F.when(F.col("quality") == 1, F.when(F.col("toxic") == 0, "good").otherwise("rude")).when(F.col("toxic") == 0, "poor")
    return splits.oversample_minority(table(spark, sf, "labels").select("doc_id", label.alias("class")), "class", "doc_id")


def _steps_sql(c: str) -> str:
    return f"""
f_{c} AS (SELECT p_partkey, coalesce({c}, (SELECT avg({c}) FROM p)) AS v FROM p),
b_{c} AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
          (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM f_{c})),
l_{c} AS (SELECT p_partkey, ln(1 + greatest(least(greatest(v, lo), hi), 0)) AS v FROM f_{c}, b_{c}),
s_{c} AS (SELECT p_partkey, round((v - (SELECT avg(v) FROM l_{c})) / (SELECT stddev_pop(v) FROM l_{c}), 6) AS {c} FROM l_{c})"""


@query("preprocess_columns", f"""
WITH p AS (SELECT p_partkey, cast(nullif(p_size, 7) AS double) AS p_size, p_retailprice, nullif(p_type, 'SMALL') AS p_type FROM part),
{_steps_sql('p_size')}, {_steps_sql('p_retailprice')},
m AS (SELECT p_type AS v FROM p WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
t AS (SELECT p_partkey, coalesce(p_type, (SELECT v FROM m)) AS ty FROM p)
SELECT p_partkey, p_size, p_retailprice, """ + ", ".join(
    f"CASE WHEN ty = '{t}' THEN 1 ELSE 0 END AS \"p_type_{t}\"" for t in TYPES if t not in ("ECONOMY", "SMALL")) + """
FROM t JOIN s_p_size USING (p_partkey) JOIN s_p_retailprice USING (p_partkey)""")
def preprocess_columns(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", F.expr("nullif(p_size, 7)").cast("double").alias("p_size"), "p_retailprice",
        F.expr("nullif(p_type, 'SMALL')").alias("p_type"),
    )
    fitted = transforms.fit_column_transform(part, ["p_size", "p_retailprice"], ["p_type"])
    return rounded(fitted.transform(part), ["p_size", "p_retailprice"])


SEEN = "l_linenumber <= 4"


def _cleaned_sql(c: str) -> str:
    """Steps fitted on the rows seen, applied to all."""
    return f"""
f_{c} AS (SELECT *, coalesce({c}, (SELECT avg({c}) FROM p WHERE {SEEN})) AS v FROM p),
b_{c} AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
          (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM f_{c} WHERE {SEEN})),
l_{c} AS (SELECT row_id, l_linenumber, ln(1 + greatest(least(greatest(v, lo), hi), 0)) AS v FROM f_{c}, b_{c}),
s_{c} AS (SELECT row_id, (v - (SELECT avg(v) FROM l_{c} WHERE {SEEN})) / (SELECT stddev_pop(v) FROM l_{c} WHERE {SEEN}) AS {c} FROM l_{c})"""


FEW_SQL = "coalesce(few, (SELECT few FROM p WHERE few IS NOT NULL AND {seen} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))".format(seen=SEEN)
FITTED_COLUMNS_SQL = f"""
WITH p AS MATERIALIZED (SELECT row_number() OVER () AS row_id, l_orderkey, l_linenumber, nullif(l_quantity, 7) AS l_quantity, l_extendedprice,
             nullif(l_returnflag, 'A') AS few, 'k' || (l_orderkey * 7 + l_linenumber) % 5003 AS many FROM lineitem),
{_cleaned_sql('l_quantity')}, {_cleaned_sql('l_extendedprice')},
few_at AS (SELECT few, row_number() OVER (ORDER BY few) - 2 AS at FROM (SELECT DISTINCT few FROM p WHERE few IS NOT NULL AND {SEEN})),
many_at AS (SELECT many, row_number() OVER (ORDER BY many) - 2 AS at FROM (SELECT DISTINCT many FROM p WHERE {SEEN})),
t AS (SELECT *, {FEW_SQL} AS few_filled FROM p),
j AS (SELECT t.row_id, l_orderkey, l_linenumber, s1.l_quantity AS q, s2.l_extendedprice AS e, few_at.at AS a, many_at.at AS m
      FROM t JOIN s_l_quantity s1 USING (row_id) JOIN s_l_extendedprice s2 USING (row_id)
      LEFT JOIN few_at ON few_at.few = few_filled AND few_at.at >= 0 LEFT JOIN many_at ON many_at.many = t.many AND many_at.at >= 0)
SELECT l_orderkey, l_linenumber, (SELECT 2 + count(*) - 1 FROM few_at) + (SELECT count(*) - 1 FROM many_at) AS size,
       concat_ws(',', '0', '1', a + 2, m + 2 + (SELECT count(*) - 1 FROM few_at)) AS places, round(q, 5) AS l_quantity, round(e, 5) AS l_extendedprice
FROM j WHERE NOT ({SEEN})"""


@query("transform_saved_columns", FITTED_COLUMNS_SQL)
def transform_saved_columns(spark, sf):
    """Fitted on some rows, saved, loaded and applied to the others: about 5,000 categories, some of them unseen."""
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr("nullif(l_quantity, 7)").cast("double").alias("l_quantity"), "l_extendedprice",
        F.expr("nullif(l_returnflag, 'A')").alias("few"), F.concat(F.lit("k"), ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 5003).cast("string")).alias("many"),
    )
    path = fresh_path(spark, "columns")
    transforms.fit_column_transform(line.where(SEEN), ["l_quantity", "l_extendedprice"], ["few", "many"]).save(path)
    found = transforms.ColumnTransform.load(spark, path).vectors(line.where(f"NOT ({SEEN})"))
    return rounded(found.select(
        "l_orderkey", "l_linenumber", "features.size", F.concat_ws(",", F.col("features.places").cast("array<string>")).alias("places"),
        F.col("features.values")[0].alias("l_quantity"), F.col("features.values")[1].alias("l_extendedprice"),
    ), ["l_quantity", "l_extendedprice"], 5)


def _roll5(c: str) -> str:
    w = f"({SERIES} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
    return f"cast({c} AS float) AS {c}, cast(avg({c}) OVER {w} AS float) AS {c}_rollmean5, stddev_samp({c}) OVER {w} AS {c}_std"


def _scaled(c: str) -> str:
    return f"round((cast({c} AS double) - (SELECT avg(cast({c} AS double)) FROM r)) / (SELECT stddev_pop(cast({c} AS double)) FROM r), 4) AS {c}"


MOVING = ["sensor_1", "sensor_2", "sensor_3", "sensor_5"]
PREPARED = ["op_setting_1", "op_setting_2", *MOVING, *[f"{c}_roll{n}5" for c in MOVING for n in ("mean", "std")]]


def _complete_sql(filled: str = FILL_SQL, where: str = "TRUE", scaled=_scaled) -> str:
    """The twelve steps with `filled` for the missing values of sensor_3."""
    return PANEL_SQL + f"""
, f AS (SELECT {KEY}, op_setting_1, op_setting_2, sensor_1, sensor_2, {filled} AS sensor_3, sensor_5 FROM panel WHERE {where}),
w AS (SELECT {KEY}, cast(op_setting_1 AS float) AS op_setting_1, cast(op_setting_2 AS float) AS op_setting_2, {', '.join(map(_roll5, MOVING))} FROM f),
r AS (SELECT *, {', '.join(f'cast({c}_std AS float) AS {c}_rollstd5' for c in MOVING)} FROM w WHERE {' AND '.join(f'{c}_std IS NOT NULL' for c in MOVING)})
SELECT {KEY}, {', '.join(map(scaled, PREPARED))} FROM r"""


def _spanned(c: str) -> str:
    low = f"(SELECT min(cast({c} AS double)) FROM r)"
    return f"round((cast({c} AS double) - {low}) / ((SELECT max(cast({c} AS double)) FROM r) - {low}), 4) AS {c}"


def _complete(spark, sf, doubled=False, **switches):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle", "op_setting_1", "op_setting_2", "op_setting_3", *PANEL_SENSORS)
    panel = panel.unionByName(panel) if doubled else panel
    return rounded(prepare_complete(panel, with_reports=False, **switches)["data"], PREPARED, 4)


@query("preprocess_complete", _complete_sql())
def preprocess_complete(spark, sf):
    """The whole panel; the constant setting and sensor go."""
    return _complete(spark, sf)


@query("preprocess_mean_minmax", _complete_sql(f"coalesce(sensor_3, avg(sensor_3) OVER ({ENGINE}))", scaled=_spanned))
def preprocess_mean_minmax(spark, sf):
    return _complete(spark, sf, fill="mean", method="minmax")


@query("preprocess_median", _complete_sql(f"coalesce(sensor_3, quantile_cont(sensor_3, 0.5) OVER ({ENGINE}))"))
def preprocess_median(spark, sf):
    return _complete(spark, sf, fill="median")


@query("preprocess_drop", _complete_sql("sensor_3", "sensor_3 IS NOT NULL"))
def preprocess_drop(spark, sf):
    return _complete(spark, sf, fill="drop")


@query("preprocess_unique", _complete_sql())
def preprocess_unique(spark, sf):
    """Every row stands twice in the input."""
    return _complete(spark, sf, doubled=True, remove_duplicates=True)


def _engineered() -> dict[str, str]:
    """Every feature of the preparation in SQL; the constant sensor has none."""
    settings = ["op_setting_1", "op_setting_2", "op_setting_3"]
    found = {c: c for c in [*settings, *MOVING]}
    for c in MOVING:
        for n in (3, 5):
            found[f"{c}_rollmean{n}"] = f"avg({c}) OVER {frame(n)}"
            found[f"{c}_rollstd{n}"] = f"coalesce(stddev_samp({c}) OVER {frame(n)}, 0)"
        found[f"{c}_diff1"] = f"coalesce({c} - lag({c}) OVER ({SERIES}), 0)"
    for c in settings:
        found[f"{c}_rollmean3"] = f"avg({c}) OVER {frame(3)}"
        found[f"{c}_diff1"] = f"coalesce({c} - lag({c}) OVER ({SERIES}), 0)"
    return found | {"cycle_rollmean": f"avg(cycle) OVER {frame(3)}"}


ENGINEERED = _engineered()


@query("train_and_test_preparation", PANEL_SQL + f"""
, v AS MATERIALIZED (SELECT {KEY}, cutoff, life - cycle AS rul, {', '.join(f'{e} AS f_{n}' for n, e in ENGINEERED.items())} FROM panel),
s AS MATERIALIZED (SELECT {', '.join(f'avg(f_{n}) AS a_{n}, CASE WHEN min(f_{n}) = max(f_{n}) THEN 1 ELSE stddev_pop(f_{n}) END AS b_{n}' for n in ENGINEERED)} FROM v),
e AS (SELECT {KEY}, cutoff, rul, {', '.join(f'(f_{n} - a_{n}) / b_{n} AS f_{n}' for n in ENGINEERED)} FROM v, s),
q AS MATERIALIZED (SELECT {KEY}, cutoff, rul, count(*) OVER w AS n, {', '.join(f'round(CASE WHEN count(f_{n}) OVER w = 30 THEN sum(f_{n}) OVER w END, 3) AS {n}' for n in ENGINEERED)}
      FROM e WINDOW w AS ({SERIES} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
SELECT 'train' AS part, {KEY}, rul AS "RUL", {', '.join(ENGINEERED)} FROM q WHERE n = 30
UNION ALL SELECT 'test', {KEY}, rul, {', '.join(ENGINEERED)} FROM q WHERE n = 30 AND cycle <= cutoff""")
def train_and_test_preparation(spark, sf):
    """The whole panel; of every feature, the sum over each window."""
    panel = stage(engine_panel(spark, sf), "panel")
    columns = [*ENTITY, "cycle", "op_setting_1", "op_setting_2", "op_setting_3", *PANEL_SENSORS]
    train = prepare_train(panel.select(*columns))
    test = prepare_test(panel.where("cycle <= cutoff").select(*columns), engine_truth(panel), train["manifest"], train["scaler"])
    names = transforms.manifest_names(train["manifest"])

    parts = [
        window_totals(d["sequences"].select(F.lit(p).alias("part"), *ENTITY, "cycle", RUL, "seq"), names) for p, d in (("train", train), ("test", test))
    ]
    return rounded(rows.union_all(*parts), names, 3)
