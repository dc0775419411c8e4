"""Window features, fills and sequences on hand-made series."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearline.operators import ordering, sequences
from wearline.operators.ordering import number_rows, running_total
from wearline.operators.sequences import (
    check_sequences, engine_mean_vectors, engine_means_of_rows, explode_steps, flatten_windows, forecast_windows, of_shape,
    position_stats, position_stats_of_rows, rolling_sequences,
    scale_flat_windows, with_sequence_index,
)
from wearline.operators.windows import (
    add_engine_features, difference, fill_series, head_tail, impute_by_group, latest_rows, rolling_mean, rolling_std,
)

KEYS = ["dataset_id", "engine_id"]


def series(spark, values, dataset="FD001", engine=1):
    rows = [(dataset, engine, i + 1, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "dataset_id string, engine_id int, cycle long, sensor_1 double")


def by_cycle(df, column):
    return [r[column] for r in df.orderBy("dataset_id", "engine_id", "cycle").collect()]


@pytest.mark.parametrize("block_rows", [3, 4, 100])
def test_rolling_mean_with_missing_value(spark, block_rows):
    df = series(spark, [1.0, 4.0, None, 2.0, 8.0, 3.0])
    got = by_cycle(rolling_mean(df, ["sensor_1"], [3], block_rows=block_rows), "sensor_1_rollmean3")
    assert np.allclose(got, [1, 2.5, 2.5, 3, 5, 13 / 3])


def test_rolling_std_of_first_row(spark):
    df = series(spark, [5.0])
    assert by_cycle(rolling_std(df, ["sensor_1"], [3]), "sensor_1_rollstd3") == [None]
    assert by_cycle(rolling_std(df, ["sensor_1"], [3], first=0.0), "sensor_1_rollstd3") == [0.0]


def test_difference_starts_at_zero_per_engine(spark):
    df = series(spark, [1.0, 3.0]).unionByName(series(spark, [10.0, 9.0], "FD002"))
    assert by_cycle(difference(df, ["sensor_1"]), "sensor_1_diff1") == [0, 2, 0, -1]


@pytest.mark.parametrize("block_rows", [1, 2, 3, 50])
def test_fill_both_ways(spark, block_rows):
    df = series(spark, [None, 2.0, None, None, 5.0, None]).unionByName(series(spark, [None, None], engine=2))
    forward = by_cycle(fill_series(df, ["sensor_1"], block_rows=block_rows), "sensor_1")
    backward = by_cycle(fill_series(df, ["sensor_1"], "bfill", block_rows=block_rows), "sensor_1")
    assert forward == [2, 2, 2, 2, 5, 5, None, None]
    assert backward == [2, 2, 5, 5, 5, 5, None, None]


@pytest.mark.parametrize("block_rows", [29, 30, 1000])
def test_window_counts(spark, block_rows):
    parts = [series(spark, [float(i) for i in range(n)], engine=n) for n in (29, 30, 31)]
    df = parts[0].unionByName(parts[1]).unionByName(parts[2])
    seqs = with_sequence_index(rolling_sequences(df, ["sensor_1"], block_rows=block_rows), df)
    got = [(r["engine_id"], r["cycle"], r["sequence_idx"]) for r in seqs.orderBy("sequence_idx").collect()]
    assert got == [(30, 30, 0), (31, 30, 1), (31, 31, 2)]
    last = seqs.where("sequence_idx = 2").first()["seq"]
    assert last == [[float(i)] for i in range(1, 31)]
    check_sequences(seqs, 30, 1)
    with pytest.raises(ValueError):
        check_sequences(seqs, 30, 2)


def test_sequences_keep_missing_values_in_place(spark):
    seqs = rolling_sequences(series(spark, [1.0, None, 3.0]), ["sensor_1"], size=3)
    assert seqs.first()["seq"] == [[1.0], [None], [3.0]]


def test_non_numeric_features_are_refused(spark):
    with pytest.raises(TypeError):
        rolling_sequences(series(spark, [1.0]).withColumn("sensor_1", F.lit("x")), ["sensor_1"])


def test_forecast_windows_keep_missing_values(spark):
    made = forecast_windows(series(spark, [1.0, None, 3.0, 4.0]), "sensor_1", 2, block_rows=2).orderBy("cycle").collect()
    assert [(r["x"], r["y"]) for r in made] == [([1.0, None], 3.0), ([None, 3.0], 4.0)]


def test_flat_windows_and_their_scaling(spark):
    df = series(spark, [1.0, 2.0, 4.0, 7.0])
    seqs = rolling_sequences(df, ["sensor_1"], size=2)
    flat = flatten_windows(seqs, 2, 1, ["cycle"]).orderBy("cycle").collect()
    assert [(r["t0_f0"], r["t1_f0"]) for r in flat] == [(1, 2), (2, 4), (4, 7)]
    scaled = scale_flat_windows(seqs, position_stats(seqs, ["sensor_1"]), 2, 1, ["cycle"])
    steps = explode_steps(scaled, ["x"], ["cycle"]).groupBy("t").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    for r in steps.collect():
        assert abs(r["m"]) < 1e-9 and abs(r["s"] - 1) < 1e-9


def test_group_fill_leaves_empty_group(spark):
    df = series(spark, [1.0, None, 4.0]).unionByName(series(spark, [None], engine=2))
    assert by_cycle(impute_by_group(df, ["sensor_1"], KEYS, "mean"), "sensor_1") == [1, 2.5, 4, None]
    assert by_cycle(impute_by_group(df, ["sensor_1"], KEYS, "median"), "sensor_1") == [1, 2.5, 4, None]


def test_latest_and_ends(spark):
    df = series(spark, [1.0, 2.0, None]).unionByName(series(spark, [9.0], "FD002"))
    assert {tuple(r) for r in latest_rows(df).collect()} == {("FD001", 1, 3, None), ("FD002", 1, 1, 9.0)}
    ends = {(r["dataset_id"], r["cycle"], r["part"]) for r in head_tail(df, 1).collect()}
    assert ends == {("FD001", 1, "head"), ("FD001", 3, "tail"), ("FD002", 1, "head"), ("FD002", 1, "tail")}


def skewed_frame(spark, rows=6000):
    """A third of all rows belongs to one engine; cycles have gaps and arrive in no order."""
    rng = np.random.default_rng(7)
    engine = np.where(rng.random(rows) < 1 / 3, 0, rng.integers(1, 60, rows))
    pdf = pd.DataFrame({"dataset_id": "FD001", "engine_id": engine, "stamp": rng.permutation(rows) * 3,
                        "sensor_1": rng.normal(size=rows).round(3)})
    pdf.loc[rng.random(rows) < 0.2, "sensor_1"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("sensor_1", F.when(~F.isnan("sensor_1"), F.col("sensor_1")))
    return pdf.sort_values(["engine_id", "stamp"]), df


@pytest.mark.parametrize("bounded_rows", [5, 200])
def test_skewed_engine_matches_pandas(spark, small_limits, monkeypatch, bounded_rows):
    """All engines count as large, or only the skewed one does."""
    monkeypatch.setattr(ordering, "BOUNDED_ROWS", bounded_rows)
    pdf, df = skewed_frame(spark)
    numbered = number_rows(df, KEYS, ["stamp"], "cycle", total="life")
    got = add_engine_features(numbered, []).toPandas().sort_values(["engine_id", "stamp"])
    grouped = pdf.groupby("engine_id")["sensor_1"]
    assert (got["cycle"].to_numpy() == pdf.groupby("engine_id").cumcount().to_numpy() + 1).all()
    assert (got["life"].to_numpy() == grouped.transform("size").to_numpy()).all()
    for n in (3, 5):
        mean = grouped.rolling(n, min_periods=1).mean().to_numpy()
        std = grouped.rolling(n, min_periods=1).std().fillna(0).to_numpy()
        assert np.allclose(got[f"sensor_1_rollmean{n}"], mean, equal_nan=True)
        assert np.allclose(got[f"sensor_1_rollstd{n}"], std, atol=1e-9)
    assert np.allclose(got["sensor_1_diff1"], grouped.diff().fillna(0))
    filled = fill_series(numbered, ["sensor_1"]).toPandas().sort_values(["engine_id", "stamp"])
    assert np.allclose(filled["sensor_1"], grouped.transform(lambda x: x.ffill().bfill()), equal_nan=True)


def test_no_task_receives_the_skewed_engine(spark, small_limits):
    _, df = skewed_frame(spark)
    numbered = number_rows(df, KEYS, ["stamp"], "cycle")
    laid = ordering.lay_blocks(numbered, "cycle", before=4)
    assert laid.groupBy(*KEYS, "_block").count().agg(F.max("count")).first()[0] <= ordering.BLOCK_ROWS + 4
    assert laid.where("_own").count() == df.count()


@pytest.mark.parametrize("bounded_rows", [5, 200])
def test_running_total_matches_pandas(spark, small_limits, monkeypatch, bounded_rows):
    monkeypatch.setattr(ordering, "BOUNDED_ROWS", bounded_rows)
    pdf, df = skewed_frame(spark)
    amounts = df.select(*KEYS, "stamp", (F.col("stamp") % 5).alias("amount"))
    got = running_total(amounts, KEYS, ["stamp"], "amount", "upto", total="whole").toPandas()
    got = got.sort_values(["engine_id", "stamp"])
    want = (pdf["stamp"] % 5).groupby(pdf["engine_id"])
    assert (got["upto"].to_numpy() == want.cumsum().to_numpy()).all()
    assert (got["whole"].to_numpy() == want.transform("sum").to_numpy()).all()


def test_frames_longer_than_a_block_make_blocks_longer(spark):
    values = [float(v * v % 11) for v in range(40)]
    got = by_cycle(rolling_mean(series(spark, values), ["sensor_1"], [5], block_rows=3), "sensor_1_rollmean5")
    assert got == pytest.approx(pd.Series(values).rolling(5, min_periods=1).mean().tolist())


def test_window_statistics_from_rows(spark):
    rows = [("FD001", e, 10 + 3 * c, float(e * c % 5), float(c)) for e, n in ((1, 9), (2, 4), (3, 2)) for c in range(n)]
    df = spark.createDataFrame(rows, "dataset_id string, engine_id long, cycle long, sensor_1 double, sensor_2 double")
    names = ["sensor_1", "sensor_2"]
    seqs = rolling_sequences(df, names, size=3)
    key = lambda r: (r["t"], r["f"])
    want = {key(r): (r["mean"], r["std"]) for r in position_stats(seqs, names).collect()}
    got = {key(r): (r["mean"], r["std"]) for r in position_stats_of_rows(df, names, size=3).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    means = {r["engine_id"]: r["sensor_1_mean"] for r in engine_means_of_rows(df, names, size=3).collect()}
    assert means == pytest.approx({r["engine_id"]: r["sensor_1_mean"] for r in engine_mean_vectors(seqs, names).collect()})
    with pytest.raises(Exception, match="does not have shape"):
        of_shape(seqs, 4, 2).collect()


def test_a_large_group_without_a_key_is_split(spark):
    rows = [(None, k) for k in range(12)] + [("a", k) for k in range(3)] + [("b", k) for k in range(9)]
    df = spark.createDataFrame(rows, "g string, k long")
    usual, large = ordering.split_by_size(df, ["g"], 5)
    assert usual.groupBy("g").count().collect() == [("a", 3)]
    assert sorted(map(tuple, large.groupBy("g").count().collect()), key=str) == [("b", 9), (None, 12)]
    numbered = ordering.number_rows(df, ["g"], ["k"], "place", total="all", bounded_rows=5).collect()
    assert all(r["place"] == r["k"] + 1 for r in numbered) and len(numbered) == 24
    assert {(r["g"], r["all"]) for r in numbered} == {(None, 12), ("a", 3), ("b", 9)}


def test_merged_moments():
    import numpy as np

    values = np.random.default_rng(1).uniform(size=1_000) + 1e8
    parts = [(len(p), float(p.mean()), float(((p - p.mean()) ** 2).sum())) for p in np.split(values, [100, 101, 500])]
    n, mean, m2 = sequences.merge_moments([(0, None, None), *parts])
    assert n == 1_000 and abs(mean - values.mean()) < 1e-7
    assert abs(m2 / n - values.var()) < 1e-9
