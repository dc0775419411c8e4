"""Sources, sinks and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.catalog.registry import ENGINE, PANEL_SQL, SERIES, frame, query, rounded
from wearline.operators.aggregates import max_cycle
from wearline.operators.joins import attach
from wearline.operators.sequences import rolling_sequences
from wearline.operators.ordering import number_rows
from wearline.panel import engine_panel, table, test_panel, truth
from wearline.schema import ENTITY, OP_SETTINGS
from wearline.session import fresh_path
from wearline.sources.logs import read_engine_log, read_engine_logs, read_positional_truth
from wearline.sources.tables import read_csv, read_sequences, write_csv, write_sequences


def _log_lines(panel, engine):
    """Panel rows as raw log lines: 26 fields, uneven blanks, a mark where a value is missing."""
    fields = [engine, F.col("cycle"), *[F.col(c) for c in OP_SETTINGS], *[F.col(f"sensor_{i}") for i in range(1, 6)]]
    fields += [F.col("sensor_5") + i for i in range(6, 22)]
    # Both an unknown word and NaN stand for a missing value.
    text = [F.coalesce(f.cast("string"), F.when(F.col("cycle") % 2 == 0, "NA").otherwise("NaN")) for f in fields]
    return F.concat(F.lit(" "), F.concat_ws("  ", *text), F.lit("  ")).alias("value")


@query("src_whitespace_log", PANEL_SQL + """
SELECT cast(engine_id * 4 + cast(substr(dataset_id, 5, 1) AS bigint) - 1 AS integer) AS engine_id,
       cast(cycle AS integer) AS cycle, op_setting_2, sensor_1, sensor_2, sensor_3, sensor_5 + 21 AS sensor_21
FROM panel""")
def src_whitespace_log(spark, sf):
    panel = engine_panel(spark, sf)
    user = F.col("engine_id") * 4 + F.substring("dataset_id", 5, 1).cast("long") - 1
    path = fresh_path(spark, "log")
    panel.select(_log_lines(panel, user)).write.text(path)
    log = read_engine_log(spark, path)
    return log.select("engine_id", "cycle", "op_setting_2", "sensor_1", "sensor_2", "sensor_3", "sensor_21")


@query("src_multi_dataset_union", PANEL_SQL + """
SELECT dataset_id, cast(engine_id AS integer) AS engine_id, cast(cycle AS integer) AS cycle, sensor_1, sensor_3
FROM panel""")
def src_multi_dataset_union(spark, sf):
    panel = engine_panel(spark, sf)
    path = fresh_path(spark, "logs")
    file = F.concat(F.lit("train_"), F.col("dataset_id"), F.lit(".txt")).alias("file")
    panel.select(_log_lines(panel, F.col("engine_id")), file).write.partitionBy("file").text(path)
    logs = read_engine_logs(spark, path, [1, 2, 3, 4, 5], "file=train_FD00{}.txt")
    return logs.select("dataset_id", "engine_id", "cycle", "sensor_1", "sensor_3")


@query("src_positional_truth", PANEL_SQL + """
, t AS (SELECT dataset_id, engine_id, max(life) - max(cutoff) AS rul_true FROM panel GROUP BY 1, 2)
, n AS (SELECT dataset_id, row_number() OVER (PARTITION BY dataset_id ORDER BY engine_id) AS engine_id, rul_true FROM t)
SELECT dataset_id, engine_id, CASE WHEN engine_id % 7 <> 3 THEN rul_true END AS rul_true FROM n""")
def src_positional_truth(spark, sf):
    """Every seventh line does not parse; the engines after it keep their own truth."""
    path = fresh_path(spark, "truth")
    known = number_rows(truth(engine_panel(spark, sf)), ["dataset_id"], ["engine_id"], "_line")
    lines = known.select(
        F.when(F.col("_line") % 7 == 3, "NA").otherwise(F.concat(F.col("rul_true").cast("string"), F.lit(" "))).alias("value"),
        F.concat(F.lit("RUL_"), F.col("dataset_id"), F.lit(".txt")).alias("file"),
        "engine_id",
    )
    lines.orderBy("file", "engine_id").select("value", "file").write.partitionBy("file").text(path)
    return read_positional_truth(spark, [f"{path}/file=RUL_FD00{i}.txt" for i in range(1, 5)])


@query("src_csv_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate AS date) AS o_orderdate, o_orderpriority
FROM orders""")
def src_csv_roundtrip(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    path = fresh_path(spark, "csv")
    write_csv(orders, path)
    return read_csv(spark, path, orders.schema)


WEIGHTED = """cycle, count(*) OVER w AS n_steps,
  sum(cycle * {c}) OVER w - (cycle - 30) * sum({c}) OVER w AS weighted"""


@query("src_sequence_table", PANEL_SQL + f"""
, s AS (SELECT dataset_id, engine_id, {WEIGHTED.format(c='sensor_1')} FROM panel WINDOW w AS {frame(30)})
SELECT dataset_id, engine_id, cycle, n_steps, round(weighted, 4) AS weighted FROM s WHERE n_steps = 30""")
def src_sequence_table(spark, sf):
    path = fresh_path(spark, "sequences")
    write_sequences(rolling_sequences(engine_panel(spark, sf), ["sensor_1", "sensor_2"], dense=True), path)
    seqs = read_sequences(spark, path)
    terms = F.transform("seq", lambda s, t: (t + 1) * s[0])
    weighted = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    out = seqs.select(*ENTITY, "cycle", F.size("seq").cast("long").alias("n_steps"), weighted.alias("weighted"))
    return rounded(out, ["weighted"], 4)


@query("join_agg_back", PANEL_SQL + f"""
SELECT dataset_id, engine_id, cycle, max(cycle) OVER ({ENGINE}) AS max_cycle FROM panel""")
def join_agg_back(spark, sf):
    panel = engine_panel(spark, sf).select(*ENTITY, "cycle")
    return attach(panel, max_cycle(panel), ENTITY)


@query("join_truth_inner", PANEL_SQL + """
, t AS (SELECT dataset_id, engine_id, max(life) - max(cutoff) AS rul_true FROM panel WHERE life >= 66 GROUP BY 1, 2),
last AS (SELECT dataset_id, engine_id, max(cycle) AS cycle_last FROM test GROUP BY 1, 2)
SELECT dataset_id, engine_id, cycle_last, rul_true FROM last JOIN t USING (dataset_id, engine_id)""")
def join_truth_inner(spark, sf):
    known = truth(engine_panel(spark, sf).where("life >= 66"))
    last = max_cycle(test_panel(spark, sf)).withColumnRenamed("max_cycle", "cycle_last")
    return last.join(known, ENTITY, "inner")


@query("join_left_max", PANEL_SQL + """
, m AS (SELECT dataset_id, engine_id, max(cycle) AS max_cycle FROM panel WHERE life >= 66 GROUP BY 1, 2)
SELECT dataset_id, engine_id, cycle, max_cycle FROM panel LEFT JOIN m USING (dataset_id, engine_id)""")
def join_left_max(spark, sf):
    panel = engine_panel(spark, sf)
    return attach(panel.select(*ENTITY, "cycle"), max_cycle(panel.where("life >= 66")), ENTITY, "left")
