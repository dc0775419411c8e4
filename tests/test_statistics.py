"""Quantiles, quality checks, transforms, splits and targets on hand-made rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wearline.functions import arrays, scalar
from wearline.operators import aggregates, quality, quantiles, rows, splits, transforms
from wearline.operators.joins import attach
from wearline.plans import alerts, rul

SEVEN = [1.0, 2.0, 3.0, 4.0, 10.0, 11.0, 12.5]


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, x {kind}")


def values(df, c="x"):
    return [r[c] for r in df.orderBy("id").collect()]


def test_quantiles_interpolate(spark):
    assert quantiles.quantile_row(column(spark, [*SEVEN, None, float("nan")]), ["x"], [0.25, 0.5, 0.75])["x"] == [2.5, 4, 10.5]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([-3.0, 0.0, 0.5, 1.0, 2.25, 7.0, 1e6]), min_size=1, max_size=60))
def test_ranked_quantiles_equal_numpy(spark, sample):
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    names = list("abcde")
    found = quantiles.exact_quantiles(column(spark, sample), ["x"], probs, names, bounded_values=0).first()
    assert np.allclose([found[n] for n in names], np.quantile(sample, probs))


def test_ranked_quantiles_through_a_coarse_sketch(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 50)
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.exponential(10, 3000), np.full(1500, 4.0)])
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(data)), "x": data}))
    kept = quantiles._collapse(df, ["x"], [0.25, 0.75])
    assert kept.select("value").distinct().count() < 1000
    found = quantiles.exact_quantiles(df, ["x"], [0.25, 0.75], ["a", "b"], bounded_values=10).first()
    assert np.allclose([found["a"], found["b"]], np.quantile(data, [0.25, 0.75]))


def test_ranked_quantiles_when_the_sketch_misses(spark, monkeypatch):
    """Brackets that do not hold the rank are noticed and the whole column is ranked instead."""
    real = quantiles._collapse

    def shifted(df, columns, probs):
        return real(df, columns, probs).withColumn("gap", F.lit(1))

    monkeypatch.setattr(quantiles, "_collapse", shifted)
    found = quantiles.exact_quantiles(column(spark, SEVEN), ["x"], [0.5], ["m"], bounded_values=1).first()
    assert found["m"] == 4.0


@pytest.mark.parametrize("limit", [0, 10**6])
def test_grouped_quantiles(spark, limit):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": np.where(rng.random(900) < 0.34, "hot", rng.choice(list("abc"), 900)), "x": rng.normal(size=900)})
    got = quantiles.exact_quantiles(spark.createDataFrame(pdf), ["x"], [0.5], ["m"], by=["g"], bounded_values=limit)
    got = {r["g"]: r["m"] for r in got.collect()}
    for g, want in pdf.groupby("g")["x"].median().items():
        assert math.isclose(got[g], want)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_attach(spark, how):
    df = spark.range(1000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("k"), "id")
    side = spark.createDataFrame([(0, "zero"), (1, "one")], "k long, name string")
    got = {tuple(r) for r in attach(df, side, ["k"], how).select("k", "id", "name").collect()}
    assert got == {tuple(r) for r in df.join(side, ["k"], how).select("k", "id", "name").collect()}


def test_constant_columns_despite_float_noise(spark):
    df = spark.createDataFrame([(518.67, 21.61, 14.62, float(i % 2)) for i in range(2063)], "a double, b double, c double, d double")
    assert quality.constant_columns(df) == ["a", "b", "c"]


def test_population_scale(spark):
    fitted = transforms.fit_scaler(column(spark, SEVEN), ["x"])
    assert math.isclose(fitted.first()["scale"], 4.422807, rel_tol=1e-6)
    scaled = transforms.apply_scaler(column(spark, SEVEN), fitted).agg(F.avg("x"), F.stddev_pop("x")).first()
    assert abs(scaled[0]) < 1e-12 and math.isclose(scaled[1], 1.0)
    with pytest.raises(ValueError):
        transforms.apply_scaler(column(spark, SEVEN), fitted, columns=["y"])
    constant = column(spark, [21.61] * 9)
    assert set(values(transforms.apply_scaler(constant, transforms.fit_scaler(constant, ["x"]), "minmax"))) == {0.0}


def test_alert_zone_edges(spark):
    df = column(spark, [-5.0, -1.0, -0.5, 10.0, 10.1, 30.0, 31.0, None, float("nan")])
    zones = values(df.withColumn("x", alerts.alert_zone("x")))
    assert zones == [None, None, "Critical", "Critical", "Warning", "Warning", "Safe", None, None]


def test_risk_level_edges(spark):
    df = column(spark, [20.0, 20.1, 50.0, 50.1, None, float("nan")])
    assert values(df.withColumn("x", alerts.risk_level("x"))) == ["Critical", "Warning", "Warning", "Normal", "Normal", "Normal"]


def test_zone_counts_show_zero(spark):
    df = spark.createDataFrame([("FD001", i, 1, v) for i, v in enumerate([15.0, 99.0, -7.0])], "dataset_id string, engine_id int, cycle int, RUL double")
    zones = alerts.latest_zones(df)
    counts = alerts.zone_counts(zones)
    assert [(r["Alert"], r["n"]) for r in counts.collect()] == [("Critical", 0), ("Warning", 1), ("Safe", 1)]
    assert alerts.zone_metrics(zones).first()["null_zone"] == 1
    assert [r["level"] for r in alerts.zone_messages(counts).collect()] == ["Warning", "Safe"]
    assert alerts.alert_board(zones).count() == 3


def test_quantile_bins_with_equal_edges(spark):
    df = column(spark, [0.0, 0.0, 0.0, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    with pytest.raises(ValueError):
        transforms.quantile_bins(df, "x", 4, "bin")
    assert values(transforms.quantile_bins(df, "x", 4, "bin", merge_duplicates=True), "bin") == [0, 0, 0, 0, 0, 1, 1, 2, 2, 2]


def test_duplicates_with_missing_values(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    assert quality.duplicate_count(df).first()[0] == 1
    assert quality.drop_duplicates(df).count() == 2
    kept = quality.drop_duplicates(spark.createDataFrame([(1, 5, "x"), (1, 3, "y")], "k int, o int, v string"), ["k"], ["o"])
    assert [tuple(r) for r in kept.collect()] == [(1, 3, "y")]


def test_histogram_closes_the_last_bin(spark):
    got = quality.histogram(column(spark, [0.0, 1.0, 2.0, 10.0, None]), "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in got] == [2, 1, 0, 0, 1]


def test_alignment(spark):
    manifest = transforms.feature_manifest(spark, ["engine_id", "cycle", "f1", "f2", "f3", "RUL"], limit=2)
    test = spark.createDataFrame([(1, 2.5, 9.0)], "engine_id int, f1 double, f9 double")
    aligned = transforms.align_features(test, manifest, ["engine_id"])
    assert aligned.columns == ["engine_id", "f1", "f2"] and tuple(aligned.first()) == (1, 2.5, 0.0)


def test_one_hot_of_unknown_and_missing(spark):
    df = column(spark, ["a", "b", "z", None], "string")
    assert values(transforms.one_hot(df, "x", ["a", "b"]), "x_b") == [0, 1, 0, 0]


def test_guarded_ratio_and_clip(spark):
    df = spark.createDataFrame([(0, 3.0, 0.0), (1, 3.0, 4.0), (2, None, 1.0)], "id int, a double, b double")
    assert values(df.withColumn("x", scalar.guarded_ratio("a", "b"))) == [6.0, 0.75, None]
    assert values(df.withColumn("x", scalar.clip("a", 5.0, 9.0))) == [5.0, 5.0, None]


def test_array_functions(spark):
    df = spark.createDataFrame([(0, [1.0, 5.0, 3.0, 0.0])], "id int, a array<double>")
    row = df.select(
        arrays.positions_where("a", lambda x: x > 2).alias("p"), arrays.reshape("a", 2, 2).alias("m"),
        arrays.elementwise("a", F.reverse("a"), "div").alias("d"), arrays.dot("a", "a").alias("dot"),
    ).first()
    assert row["p"] == [1, 2] and row["m"] == [[1, 5], [3, 0]] and row["d"][0] is None and row["dot"] == 35


@pytest.mark.parametrize("fixture_limits", [False, True])
def test_splits_are_exact_and_complete(spark, fixture_limits, request):
    if fixture_limits:
        request.getfixturevalue("small_limits")
    df = spark.range(103).select(F.col("id").alias("k"))
    marked = splits.split_random(df, "k", 0.2)
    assert marked.where("is_test").count() == 21 and marked.count() == 103


def test_oversampling_reaches_balance(spark):
    df = spark.createDataFrame([(i, int(i < 3)) for i in range(20)], "k long, label int")
    balanced = splits.oversample_minority(df, "label", "k")
    assert {tuple(r) for r in splits.class_balance(balanced, "label").collect()} == {(0, 17), (1, 17)}


def test_chronological_split(spark):
    df = spark.createDataFrame([("FD001", 1, c) for c in range(1, 11)], "dataset_id string, engine_id int, cycle int")
    assert splits.split_chronological(df).where("is_train").agg(F.max("cycle"), F.count("*")).first() == (8, 8)


def test_targets(spark):
    df = spark.createDataFrame([("FD001", e, c) for e in (1, 2) for c in (1, 2, 3)], "dataset_id string, engine_id int, cycle long")
    assert {r["RUL"] for r in rul.train_rul(df).where("cycle = 3").collect()} == {0}
    truth = spark.createDataFrame([("FD001", 1, 112)], "dataset_id string, engine_id int, rul_true long")
    tested = {(r["engine_id"], r["cycle"]): r["RUL"] for r in rul.test_rul(df, truth).collect()}
    assert tested == {(1, 1): 114, (1, 2): 113, (1, 3): 112}
    assert {r["RUL"] for r in rul.test_rul(df).collect()} == {0}
    assert {r["RUL"] for r in rul.capped_rul(rul.test_rul(df, truth), 113).collect()} == {112, 113}


def test_describe_and_crosstab(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 4.0, None], "y": [3.0, 3.0, 9.0, 1.0], "a": ["p", "p", "q", "q"], "b": ["u", "v", "u", "u"]})
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    for r in aggregates.describe(df, ["x", "y"]).collect():
        assert np.allclose([r[c] for c in aggregates.DESCRIBE], pdf[r["column"]].describe().to_numpy()[[0, 1, 2, 3, 4, 5, 6, 7]])
    assert {tuple(r) for r in aggregates.crosstab(df, "a", "b", ["u", "v"]).collect()} == {("p", 1, 1), ("q", 2, 0)}


def test_variance_inflation_of_dependent_columns(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=400), rng.normal(size=400)
    x = np.column_stack([a, b, a + 0.1 * b + rng.normal(scale=0.5, size=400)])
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")))
    got = {r["column"]: r["vif"] for r in quality.variance_inflation(df, list("abc")).collect()}
    for i, c in enumerate("abc"):
        others = np.delete(x, i, 1)
        rest = x[:, i] - others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        assert math.isclose(got[c], (x[:, i] @ x[:, i]) / (rest @ rest), rel_tol=1e-6)


def test_membership_and_positions(spark):
    df = column(spark, [float(i) for i in range(10)])
    assert rows.keep_selected(df, "x", [], True).count() == 10
    assert rows.keep_selected(df, "x", [], False).count() == 0
    assert values(rows.rows_between(df, ["id"], 1, 3), "id") == [1, 2]
    assert sorted(values(rows.tail(df, ["id"], 2), "id")) == [8, 9]


def test_downcast_types(spark):
    df = spark.createDataFrame([(0, -5, 300, 1.5), (126, 126, 70000, 2.5)], "a long, b long, c long, d double")
    assert [k for _, k in transforms.downcast(df).dtypes] == ["tinyint", "tinyint", "int", "float"]


@pytest.mark.parametrize(
    ("low", "high", "kind"),
    [(0, 127, "tinyint"), (0, 128, "smallint"), (-128, 100, "tinyint"), (-129, 0, "smallint"), (0, 32767, "smallint"), (0, 32768, "int"),
     (0, 2**31 - 1, "int"), (0, 2**31, "bigint"), (-(2**63), 0, "bigint")],
)
def test_narrowest_integer(low, high, kind):
    assert transforms.narrowest_integer(low, high) == kind


def test_statistics_of_degenerate_columns(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert [(r["n_missing"], r["pct_missing"]) for r in aggregates.null_counts(empty).collect()] == [(0, None), (0, None)]
    assert [r["pct"] for r in quality.zscore_outliers(empty, ["a"]).collect()] == [None]
    assert [r["n"] for r in quality.histogram(empty, "a", 3).orderBy("bin").collect()] == [0, 0, 0]
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "a double")
    assert aggregates.distinct_counts(zeros, ["a"]).first()["n_distinct"] == 2
    lines = spark.createDataFrame([(float(i), 2.0 * i, float(i * i % 7)) for i in range(1, 20)], "a double, b double, c double")
    factors = {r["column"]: r["vif"] for r in quality.variance_inflation(lines, ["a", "b", "c"]).collect()}
    assert factors["a"] == factors["b"] == math.inf and math.isfinite(factors["c"])
    with pytest.raises(ValueError):
        quality.density_grid(spark.createDataFrame([(1.0,), (1.0,)], "a double"), "a")


def test_metrics_of_a_constant_target(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0), (9.0, None)], "y double, p double")
    row = rul.regression_metrics(df, "y", "p").first()
    assert (row["n"], row["mse"], row["r2"]) == (2, 1.0, None)


def test_null_reports(spark):
    counts = aggregates.null_counts(spark.createDataFrame([(None, 1, None), (None, 2, 3)], "a int, b int, c int"))
    assert [r["column"] for r in aggregates.columns_with_nulls(counts).collect()] == ["a", "c"]
    assert aggregates.total_nulls(counts).first()["n_missing"] == 3


def test_sparse_categories_of_any_number(spark):
    df = spark.range(3000).select("id", F.format_string("c%04d", "id").alias("c"))
    index = transforms.category_index(df, "c")
    extra = df.unionByName(spark.createDataFrame([(-1, "unknown"), (-2, None)], "id long, c string"))
    got = {r["id"]: (r["c_vector"]["size"], r["c_vector"]["ones"]) for r in transforms.one_hot_sparse(extra, "c", index).collect()}
    assert got[0] == got[-1] == got[-2] == (2999, []) and got[2999] == (2999, [2998]) and len(got) == 3002


def test_all_chosen_engines_are_shown(spark):
    df = spark.createDataFrame([("FD001", e, c, 9 - c) for e in range(8) for c in range(3)], "dataset_id string, engine_id long, cycle long, RUL long")
    assert alerts.rul_trend(df, df.select("dataset_id", "engine_id")).count() == 24
    assert alerts.rul_trend(df).select("engine_id").distinct().count() == 5
    assert alerts.rul_trend(df, df.where("engine_id > 99")).count() == 24
    assert alerts.latest_zones(df, edges=[-1, 7, 100], labels=["Low", "High"]).where("Alert = 'Low'").count() == 8


@pytest.mark.parametrize("accuracy", [2_000, 20])
def test_quantiles_of_groups_with_sketches(spark, monkeypatch, accuracy):
    """A hot group, ties, missing values, and brackets so narrow that some miss."""
    from wearline.operators import quantiles

    monkeypatch.setattr(quantiles, "SKETCH_FROM", 50)
    monkeypatch.setattr(quantiles, "GROUP_ACCURACY", accuracy)
    rng = np.random.default_rng(accuracy)
    rows = [("hot", float(v), float(round(v))) for v in rng.normal(size=4_000) * 10]
    rows += [("ties", 5.0, None)] * 300 + [("few", float(v), 1.0) for v in range(7)] + [("two", float(v % 2), float(v)) for v in range(200)]
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(4)
    got = quantiles.exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.9, 1.0], list("vwxyz"), by=["g"]).collect()
    found = {(r["g"], r["column"]): (r["n"], *(r[c] for c in "vwxyz")) for r in got}
    for group in ("hot", "ties", "few", "two"):
        for i, column in ((1, "a"), (2, "b")):
            values = [r[i] for r in rows if r[0] == group and r[i] is not None]
            if values:
                want = (len(values), *np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0]))
                assert found[group, column] == pytest.approx(want), (group, column)
            else:
                assert (group, column) not in found


def test_only_values_near_the_ranks_are_shuffled(spark):
    from wearline.operators import quantiles

    df = spark.range(300_000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("a"))
    near = quantiles._collapse_groups(df, ["a"], ["g"], [0.25, 0.5, 0.75])
    assert near.groupBy("g", "value", "gap").count().count() < 10_000


def test_column_transform_survives_saving(spark, tmp_path):
    rows = [(k, float(k % 11) if k % 5 else None, f"c{k % 1_500}", "x" if k % 3 else None) for k in range(6_000)]
    df = spark.createDataFrame(rows, "id long, n double, many string, few string")
    fitted = transforms.fit_column_transform(df, ["n"], ["many", "few"])
    fitted.save(str(tmp_path / "fitted"))
    again = transforms.ColumnTransform.load(spark, str(tmp_path / "fitted"))
    unseen = spark.createDataFrame([(1, None, "c10", "y"), (2, 100.0, "new", None), (3, 3.0, None, "x"), (4, 3.0, "c0", "x")], df.schema)
    got, want = (sorted(map(tuple, t.transform(unseen).collect())) for t in (again, fitted))
    assert got == want
    order = sorted({f"c{k}" for k in range(1_500)})
    vectors = {r["id"]: r["many_vector"] for r in again.transform(unseen).collect()}
    assert [vectors[k]["size"] for k in (1, 2, 3, 4)] == [1_499] * 4
    assert vectors[1]["ones"] == [order.index("c10") - 1] and vectors[2]["ones"] == [] and vectors[4]["ones"] == []
    wide = {r["id"]: r["features"] for r in again.vectors(unseen).collect()}
    assert wide[1]["size"] == 1 + 1_499 and wide[1]["places"] == [0, 1 + order.index("c10") - 1] and wide[1]["values"][1] == 1.0
    assert again.transform(unseen.limit(0)).collect() == []


def test_column_transform_of_another_version_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "n double, c string")
    fitted = transforms.fit_column_transform(df, ["n"], ["c"])
    fitted.params.withColumn("version", F.lit(0)).write.parquet(str(tmp_path / "old"))
    with pytest.raises(ValueError, match="version"):
        transforms.ColumnTransform.load(spark, str(tmp_path / "old"))
