"""Group statistics, counts, correlations and matrix sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.catalog.projection import CELLS_SQL
from wearline.catalog.registry import PANEL_SQL, SERIES, frame, query, rounded
from wearline.functions import arrays
from wearline.operators import aggregates as agg
from wearline.operators import products, sequences
from wearline.operators.quantiles import exact_quantiles
from wearline.operators.sequences import flatten_windows, rolling_sequences
from wearline.panel import engine_panel, table
from wearline.schema import ENTITY

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _each(template: str, columns: list[str]) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in columns)


@query("agg_max_cycle", PANEL_SQL + "SELECT dataset_id, engine_id, max(cycle) AS max_cycle FROM panel GROUP BY 1, 2")
def agg_max_cycle(spark, sf):
    return agg.max_cycle(engine_panel(spark, sf))


SENSOR_STATS_SQL = ", ".join(
    f"round(avg(sensor_{i}), 6) AS sensor_{i}_mean, round(stddev_samp(sensor_{i}), 6) AS sensor_{i}_std, "
    f"min(sensor_{i}) AS sensor_{i}_min, max(sensor_{i}) AS sensor_{i}_max" for i in range(1, 6)
)


@query("agg_engine_stats", PANEL_SQL + f"SELECT dataset_id, engine_id, {SENSOR_STATS_SQL} FROM panel GROUP BY 1, 2")
def agg_engine_stats(spark, sf):
    stats = agg.engine_stats(engine_panel(spark, sf))
    return rounded(stats, [c for c in stats.columns if c.endswith(("_mean", "_std"))])


@query("agg_group_sum_mean", """
SELECT l_returnflag, sum(l_quantity) AS sum_quantity, round(sum(l_extendedprice), 2) AS sum_price,
       round(avg(l_extendedprice), 4) AS mean_price FROM lineitem GROUP BY 1""")
def agg_group_sum_mean(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum("l_quantity").alias("sum_quantity"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.round(F.avg("l_extendedprice"), 4).alias("mean_price"),
    )


@query("value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC")
def value_counts(spark, sf):
    return agg.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("agg_two_level", PANEL_SQL + """
, c AS (SELECT count(*) AS n FROM panel GROUP BY dataset_id, engine_id)
SELECT count(*) AS n_groups, cast(min(n) AS double) AS smallest, cast(quantile_cont(n, 0.5) AS double) AS median,
       cast(max(n) AS double) AS largest FROM c""")
def agg_two_level(spark, sf):
    return agg.two_level_counts(engine_panel(spark, sf), ENTITY)


@query("agg_global_stats", """
SELECT round(avg(l_extendedprice), 4) AS mean, round(stddev_pop(l_extendedprice), 4) AS std_pop,
       round(sum(l_extendedprice), 2) AS total, min(l_extendedprice) AS min, max(l_extendedprice) AS max,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem""")
def agg_global_stats(spark, sf):
    stats = agg.global_stats(table(spark, sf, "lineitem"), "l_extendedprice")
    return rounded(rounded(stats, ["mean", "std_pop", "median"], 4), ["total"], 2)


@query("describe_numeric", _each("""
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median,
       round(quantile_cont({c}, 0.75), 4) AS q3, max({c}) AS max FROM lineitem""", NUMBERS))
def describe_numeric(spark, sf):
    return rounded(agg.describe(table(spark, sf, "lineitem"), NUMBERS), ["mean", "std", "q1", "median", "q3"], 4)


PANEL_COLUMNS = ["dataset_id", "engine_id", "cycle", "sensor_1", "sensor_2", "sensor_3", "sensor_4"]


@query("null_counts", PANEL_SQL + _each("""
SELECT '{c}' AS "column", count(*) - count({c}) AS n_missing,
       round(100.0 * (count(*) - count({c})) / count(*), 4) AS pct_missing FROM panel""", PANEL_COLUMNS))
def null_counts(spark, sf):
    return rounded(agg.null_counts(engine_panel(spark, sf), PANEL_COLUMNS), ["pct_missing"], 4)


@query("inf_nan_counts", PANEL_SQL + f"""
, s AS (SELECT count(*) OVER w AS n, count(sensor_3) OVER w AS present FROM panel WINDOW w AS {frame(30)})
SELECT 'sensor_1' AS "column", count(*) FILTER (sensor_1 = 0) AS n_inf, cast(0 AS bigint) AS n_missing FROM panel
UNION ALL SELECT 'windows of sensor_3', 0, cast(sum(n - present) FILTER (n = 30) AS bigint) FROM s""")
def inf_nan_counts(spark, sf):
    panel = engine_panel(spark, sf)
    marked = panel.withColumn("sensor_1", F.when(F.col("sensor_1") == 0, F.lit(float("inf"))).otherwise(F.col("sensor_1")))
    table_part = agg.infinite_and_nan_counts(marked, ["sensor_1"]).withColumnRenamed("n_nan", "n_missing")
    windows = sequences.missing_in_windows(sequences.rolling_sequences(panel, ["sensor_3"], dense=True))
    return table_part.unionByName(
        windows.select(F.lit("windows of sensor_3").alias("column"), F.lit(0).cast("long").alias("n_inf"), "n_missing")
    )


@query("distinct_counts", _each("""
SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM lineitem""", [*NUMBERS, "l_suppkey", "l_returnflag"]))
def distinct_counts(spark, sf):
    return agg.distinct_counts(table(spark, sf, "lineitem"), [*NUMBERS, "l_suppkey", "l_returnflag"])


CORRELATED = ["sensor_1", "sensor_2", "sensor_3", "op_setting_1", "rul"]


@query("corr_matrix", PANEL_SQL + ", r AS (SELECT *, cast(life - cycle AS double) AS rul FROM panel)" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM r" for a in CORRELATED for b in CORRELATED))
def corr_matrix(spark, sf):
    panel = engine_panel(spark, sf).withColumn("rul", F.col("life") - F.col("cycle"))
    return rounded(agg.correlations(panel, CORRELATED), ["r"])


@query("crosstab_counts", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
       count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def crosstab_counts(spark, sf):
    return agg.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("count_by_two", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def count_by_two(spark, sf):
    return agg.count_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("share_of_total", """
SELECT c_mktsegment, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM customer), 1) AS pct
FROM customer GROUP BY 1""")
def share_of_total(spark, sf):
    return agg.share_of_total(table(spark, sf, "customer"), "c_mktsegment")


@query("engine_mean_vector", PANEL_SQL + """
SELECT dataset_id, engine_id, round(avg(sensor_1), 6) AS sensor_1_mean, round(avg(sensor_2), 6) AS sensor_2_mean,
       round(avg(sensor_3), 6) AS sensor_3_mean
FROM panel WHERE cycle >= 30 GROUP BY 1, 2""")
def engine_mean_vector(spark, sf):
    features = ["sensor_1", "sensor_2", "sensor_3"]
    means = sequences.engine_means_of_rows(engine_panel(spark, sf), features, dense=True)
    return rounded(means, [f"{f}_mean" for f in features])


@query("dot_product", CELLS_SQL + """
SELECT vec_id, round(sum(x * x), 6) AS dot_self FROM c GROUP BY 1""")
def dot_product(spark, sf):
    e = F.col("embedding").cast("array<double>")
    vectors = table(spark, sf, "embeddings").select("vec_id", e.alias("e"))
    return rounded(vectors.select("vec_id", arrays.dot("e", "e").alias("dot_self")), ["dot_self"])


@query("matmul_coo", CELLS_SQL + """
, a AS (SELECT vec_id AS i, i AS k, x AS v FROM c),
b AS (SELECT c.i AS k, label AS j, avg(x) AS v FROM c JOIN embeddings USING (vec_id) GROUP BY 1, 2)
SELECT a.i, b.j, round(sum(a.v * b.v), 6) AS v FROM a JOIN b USING (k) GROUP BY 1, 2""")
def matmul_coo(spark, sf):
    cells = table(spark, sf, "embeddings").select("vec_id", "label", F.posexplode(F.col("embedding").cast("array<double>")).alias("k", "v"))
    left = cells.select(F.col("vec_id").alias("i"), "k", "v")
    right = cells.groupBy("k", F.col("label").alias("j")).agg(F.avg("v").alias("v"))
    return rounded(products.multiply(left, right), ["v"])


@query("quantiles_exact", _each("""
SELECT '{c}' AS "column", count({c}) AS n, round(quantile_cont({c}, 0.25), 6) AS q1,
       round(quantile_cont({c}, 0.5), 6) AS q2, round(quantile_cont({c}, 0.75), 6) AS q3 FROM lineitem""", NUMBERS))
def quantiles_exact(spark, sf):
    found = exact_quantiles(table(spark, sf, "lineitem"), NUMBERS, [0.25, 0.5, 0.75], ["q1", "q2", "q3"])
    return rounded(found, ["q1", "q2", "q3"])


@query("matmul_heavy_inner", """
WITH a AS (SELECT l_orderkey AS i, CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey % 97 + 1 END AS k, sum(l_linenumber) AS v FROM lineitem GROUP BY 1, 2),
b AS (SELECT c_nationkey * 12 + c_custkey % 12 AS j, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey % 97 + 1 END AS k, count(*) AS v FROM customer GROUP BY 1, 2),
c AS (SELECT i, j, sum(a.v * b.v) AS v FROM a JOIN b USING (k) GROUP BY 1, 2)
SELECT i, count(*) AS n, cast(sum(v) AS bigint) AS total, cast(sum(v * (j % 1009)) AS bigint) AS weighted FROM c GROUP BY 1""")
def matmul_heavy_inner(spark, sf):
    """One inner index holds a third of the entries of either side."""
    inner = lambda c, other: F.when(F.col(c) % 3 == 0, 0).otherwise(F.col(other) % 97 + 1).alias("k")
    left = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("i"), inner("l_orderkey", "l_partkey")).agg(F.sum("l_linenumber").alias("v"))
    right = table(spark, sf, "customer").groupBy((F.col("c_nationkey") * 12 + F.col("c_custkey") % 12).alias("j"), inner("c_custkey", "c_custkey")).agg(F.count(F.lit(1)).alias("v"))
    product = products.multiply(left, right)
    return product.groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").cast("long").alias("total"), F.sum(F.col("v") * (F.col("j") % 1009)).cast("long").alias("weighted")
    )


WIDE_STEPS = 6
WIDE = [f"t{t}_{f}" for t in range(WIDE_STEPS) for f in ("sensor_1", "sensor_2", "sensor_3", "op_setting_1", "op_setting_2")]


@query("corr_flat_windows", PANEL_SQL + f"""
, w AS (SELECT [{', '.join(f"lag({f}, {WIDE_STEPS - 1 - t}) OVER ({SERIES})" for t in range(WIDE_STEPS) for f in ("sensor_1", "sensor_2", "sensor_3", "op_setting_1", "op_setting_2"))}] AS x
        FROM panel QUALIFY cycle >= {WIDE_STEPS}), names AS (SELECT ['{"', '".join(WIDE)}'] AS c)
SELECT c[i] AS a, c[j] AS b, round(corr(x[i], x[j]), 5) AS r
FROM w, names, (SELECT unnest(range(1, {len(WIDE) + 1})) AS i), (SELECT unnest(range(1, {len(WIDE) + 1})) AS j) GROUP BY c, i, j""")
def corr_flat_windows(spark, sf):
    """All pairs of the places of flattened windows, with missing values, by tiles of matrices."""
    features = ["sensor_1", "sensor_2", "sensor_3", "op_setting_1", "op_setting_2"]
    flat = flatten_windows(rolling_sequences(engine_panel(spark, sf), features, WIDE_STEPS, dense=True), WIDE_STEPS, len(features), [])
    return rounded(agg.correlations(flat.toDF(*WIDE), WIDE), ["r"], 5)
