"""Readers, writers and the composed preparations."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wearline.operators import sequences
from wearline.plans.preparation import fill_missing, prepare_complete, prepare_test, prepare_train
from wearline.schema import LOG_COLUMNS
from wearline.session import fresh_path
from wearline.sources.logs import read_engine_log, read_engine_logs, read_positional_truth
from wearline.sources.tables import load_scaler, read_csv, write_csv


def write_text(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_log_with_uneven_blanks(spark, tmp_path):
    line = "  ".join(str(i) for i in range(1, 27))
    path = write_text(tmp_path, "train_FD001.txt", f"{line} \n\n   {line}  \n")
    rows = read_engine_log(spark, path).collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    assert rows[0]["engine_id"] == 1 and rows[0]["sensor_21"] == 26.0 and list(rows[0].asDict()) == LOG_COLUMNS


def test_short_and_broken_fields_become_missing(spark, tmp_path):
    row = read_engine_log(spark, write_text(tmp_path, "a.txt", "3 x 0.5\n")).first()
    assert (row["engine_id"], row["cycle"], row["op_setting_1"], row["sensor_1"]) == (3, None, 0.5, None)


def test_missing_subsets_are_skipped(spark, tmp_path):
    for i in (1, 3):
        write_text(tmp_path, f"train_FD00{i}.txt", f"{i} 1 0.1\n")
    logs = read_engine_logs(spark, str(tmp_path), [1, 2, 3, 4])
    assert {(r["dataset_id"], r["engine_id"]) for r in logs.collect()} == {("FD001", 1), ("FD003", 3)}
    with pytest.raises(FileNotFoundError):
        read_engine_logs(spark, str(tmp_path), [2, 4])


def test_truth_by_line(spark, tmp_path):
    path = write_text(tmp_path, "RUL_FD001.txt", "112 \n98 \n69 \n")
    other = write_text(tmp_path, "RUL_FD002.txt", "5\n")
    got = {tuple(r) for r in read_positional_truth(spark, [path, other]).collect()}
    assert got == {("FD001", 1, 112), ("FD001", 2, 98), ("FD001", 3, 69), ("FD002", 1, 5)}


def test_unparsable_truth_lines_keep_their_engine(spark, tmp_path):
    path = write_text(tmp_path, "RUL_FD001.txt", "112\n\nNA\n69\n82\n")
    got = {tuple(r) for r in read_positional_truth(spark, [path]).collect()}
    assert got == {("FD001", 1, 112), ("FD001", 2, None), ("FD001", 3, 69), ("FD001", 4, 82)}


def test_tag_comes_from_the_file(spark, tmp_path):
    (tmp_path / "FD009").mkdir()
    path = write_text(tmp_path / "FD009", "RUL_FD001.txt", "1\n")
    assert read_positional_truth(spark, [path]).first()["dataset_id"] == "FD001"
    with pytest.raises(Exception, match="no data set tag"):
        read_positional_truth(spark, [write_text(tmp_path, "RUL.txt", "1\n")]).collect()


def test_nan_is_missing(spark, tmp_path):
    row = read_engine_log(spark, write_text(tmp_path, "b.txt", "3 1 NaN nan 2.5\n")).first()
    assert (row["op_setting_1"], row["op_setting_2"], row["op_setting_3"]) == (None, None, 2.5)


def test_truth_of_a_file_read_in_many_splits(spark, tmp_path, small_limits):
    path = write_text(tmp_path, "RUL_FD001.txt", "".join(f"{i} \n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = read_positional_truth(spark, [path])
        assert got.where("engine_id - 1 <> rul_true").count() == 0 and got.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_infers_types(spark):
    path = fresh_path(spark, "csv")
    write_csv(spark.createDataFrame([(1, 2.5, "a")], "k int, x double, s string"), path)
    assert [k for _, k in read_csv(spark, path).dtypes] == ["int", "double", "string"]


def test_scaler_must_exist(spark, tmp_path):
    with pytest.raises(Exception):
        load_scaler(spark, str(tmp_path / "nothing")).collect()


def log(spark, engines=3, cycles=40):
    rows = spark.range(engines * cycles)
    cycle = (F.col("id") % cycles + 1).cast("int")
    return rows.select(
        F.lit("FD001").alias("dataset_id"), F.expr(f"cast(id div {cycles} AS int)").alias("engine_id"), cycle.alias("cycle"),
        F.sin(F.col("id")).alias("op_setting_1"),
        F.when(F.col("id") % 9 != 4, F.cos(F.col("id") * 2)).alias("sensor_1"), F.lit(21.61).alias("sensor_2"),
    )


def test_train_and_test_preparation(spark):
    df = log(spark)
    train = prepare_train(df)
    names = [r["name"] for r in train["manifest"].orderBy("pos").collect()]
    assert "sensor_2" not in names and "cycle_pct_max" not in names and "sensor_1_rollstd5" in names
    assert train["sequences"].count() == 3 * 11
    truth = spark.createDataFrame([("FD001", 0, 7)], "dataset_id string, engine_id int, rul_true long")
    test = prepare_test(df.where("cycle <= 35"), truth, train["manifest"], train["scaler"])
    row = test["sequences"].orderBy("cycle").first()
    assert test["sequences"].count() == 6 and row["RUL"] == 12 and len(row["seq"]) == 30 and len(row["seq"][0]) == len(names)


def test_totals_of_windows(spark):
    """Sums by feature, missing ones kept; windows are not gathered in few tasks for the few bytes they are made of."""
    df = log(spark)
    features = ["op_setting_1", "sensor_1"]
    seqs = sequences.rolling_sequences(df, features, 5, dense=True)
    names, step = ["a", "b"], lambda i: lambda s: s[i]
    plain = seqs.select("cycle", "engine_id", *[F.aggregate(F.transform("seq", step(i)), F.lit(0.0), lambda x, y: x + y).alias(n) for i, n in enumerate(names)])
    found = sequences.window_totals(seqs.select("cycle", "engine_id", "seq"), names)
    rows = lambda d: sorted([(r[0], r[1], round(r[2], 9), r[3] is None or round(r[3], 9)) for r in d.collect()], key=str)
    assert found.columns == ["cycle", "engine_id", *names] and rows(found) == rows(plain)
    assert found.where("b IS NULL").count() > 0
    assert "REPARTITION_BY_NUM" in seqs._jdf.queryExecution().executedPlan().toString()


def test_complete_preparation_switches(spark):
    df = log(spark)
    doubled = df.unionByName(df.where("cycle = 40"))
    full = prepare_complete(doubled, remove_duplicates=True)
    data = full["data"]
    assert full["reports"]["constant"] == ["sensor_2"] and data.count() == 3 * 39
    stats = data.agg(F.avg("sensor_1"), F.stddev_pop("sensor_1")).first()
    assert abs(stats[0]) < 1e-6 and abs(stats[1] - 1) < 1e-6
    assert "dataset_id" not in full["matrix"].columns
    report = {r["metric"]: r["value"] for r in full["reports"]["quality"].collect()}
    assert report["missing_values"] == 0 and report["total_rows"] == 117
    plain = prepare_complete(df, remove_constant=False, create_rolling=False, optimize_types=False, scale=False)
    assert plain["data"].columns == df.columns and plain["data"].count() == 120


@pytest.mark.parametrize("method", ["ffill", "bfill", "mean", "median", "drop"])
def test_fill_methods(spark, method):
    filled = fill_missing(log(spark), method, ["dataset_id", "engine_id"], "cycle")
    assert filled.where("sensor_1 IS NULL").count() == 0
    assert filled.count() == (120 if method != "drop" else log(spark).na.drop().count())
    with pytest.raises(ValueError):
        fill_missing(log(spark), "guess", ["engine_id"], "cycle")
