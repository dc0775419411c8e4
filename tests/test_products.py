"""Tiles and cells against numpy; copies kept by their order."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearline.operators import aggregates, products, quality


def matrix(spark, x, parts=5):
    columns = [f"c{i}" for i in range(x.shape[1])]
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(parts), columns


def pairwise(x):
    k = x.shape[1]
    r = np.full((k, k), np.nan)
    for i in range(k):
        for j in range(k):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            if both.any() and a.std() > 0 and b.std() > 0:
                r[i, j] = np.corrcoef(a, b)[0, 1]
    return r


@pytest.mark.parametrize(("tile", "fan"), [(256, 32), (3, 2)])
def test_tiled_correlations(spark, monkeypatch, tile, fan):
    monkeypatch.setattr(products, "FAN", fan)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8)) @ rng.normal(size=(8, 8)) + 1e6
    x[rng.uniform(size=x.shape) < 0.1] = np.nan
    x[:, 5] = 7.0
    x[:, 6] = np.nan
    df, columns = matrix(spark, x)
    got = {(r["a"], r["b"]): r["r"] for r in products.tiled_correlations(df, columns, tile).collect()}
    assert len(got) == 64
    want = pairwise(x)
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            if np.isnan(want[i, j]):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want[i, j], abs=1e-8)


def test_tiled_gram(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 7)) * 3 + 1000
    df, columns = matrix(spark, x)
    np.testing.assert_allclose(products.tiled_gram(df, columns, 3), x.T @ x, rtol=1e-12)


def test_many_columns_take_the_tiled_way(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 6))
    x[:, 4] += x[:, 0]
    df, columns = matrix(spark, x)
    plain = {(r["a"], r["b"]): r["r"] for r in aggregates.correlations(df, columns).collect()}
    factors = {r["column"]: r["vif"] for r in quality.variance_inflation(df, columns).collect()}
    for module in (aggregates, quality):
        monkeypatch.setattr(module, "PAIR_EXPRESSIONS", 5)
    assert {(r["a"], r["b"]): r["r"] for r in aggregates.correlations(df, columns).collect()} == pytest.approx(plain)
    assert {r["column"]: r["vif"] for r in quality.variance_inflation(df, columns).collect()} == pytest.approx(factors)


def test_nothing_to_correlate(spark):
    df, columns = matrix(spark, np.zeros((0, 3)))
    assert products.tiled_correlations(df, columns).collect() == []


@pytest.mark.parametrize("cell", [2_048, 4])
def test_matrix_product_with_heavy_inner_indices(spark, cell):
    rng = np.random.default_rng(4)
    a, b = rng.integers(-3, 4, (30, 6)), rng.integers(-3, 4, (6, 25))
    a[:, 1:] *= rng.integers(0, 2, (30, 5))
    left = spark.createDataFrame([(i, k, int(a[i, k])) for i in range(30) for k in range(6) if a[i, k]], "i long, k long, v long")
    right = spark.createDataFrame([(k, j, int(b[k, j])) for k in range(6) for j in range(25) if b[k, j]], "k long, j long, v long")
    got = np.zeros((30, 25), int)
    for r in products.multiply(left, right, cell).collect():
        got[r["i"], r["j"]] = r["v"]
    assert np.array_equal(got, a @ b)


def test_a_heavy_index_fills_many_even_cells(spark):
    n = 6_000
    side = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id"), F.lit(1).alias("v"))
    left, right = side.withColumnRenamed("id", "i"), side.withColumnRenamed("id", "j")
    seen = []
    sums = type(left).groupBy

    def spy(self, *keys):
        if keys == ("i", "j"):
            seen.append(self)
        return sums(self, *keys)

    type(left).groupBy = spy
    try:
        products.multiply(left, right, 250)
    finally:
        type(left).groupBy = sums
    cells = seen[0].where("k = 0").groupBy("_x", "_y").count()
    sizes = [r["count"] for r in cells.collect()]
    assert sum(sizes) == 2_000**2 and len(sizes) == 64
    assert max(sizes) < 4 * np.median(sizes)


def test_keep_first_in_two_phases(spark):
    rows = [("a", None, 3, "x"), ("a", None, 1, "y"), ("a", "b", 2, None), (None, None, 9, "z"), (None, None, 8, "w"), ("c", "d", 5, "v")] + [("hot", "hot", k, str(k)) for k in range(500, 0, -1)]
    df = spark.createDataFrame(rows, "g string, h string, k long, rest string").repartition(6)
    kept = quality.drop_duplicates(df, ["g", "h"], ["k"])
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([("a", None, 1, "y"), ("a", "b", 2, None), (None, None, 8, "w"), ("c", "d", 5, "v"), ("hot", "hot", 1, "1")], key=str)
    assert "SortAggregate" not in kept._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
    alone = df.where("g = 'c'")
    assert quality.drop_duplicates(alone, ["g", "h"], ["k"]).collect() == alone.collect()


def test_a_small_matrix_shuffles_no_products(spark, monkeypatch):
    """Rows of the large side are dealt once; sums by place and by row need no further shuffle."""
    monkeypatch.setattr(products, "ROW_PRODUCTS", 20_000)
    left = spark.range(5_000).select((F.col("id") % 700).alias("i"), (F.col("id") % 13).alias("k"), F.lit(2).alias("v"))
    right = spark.range(400).select((F.col("id") % 13).alias("k"), (F.col("id") % 150).alias("j"), F.lit(3).alias("v"))
    for a, b, row in ((left, right, "i"), (right.select(F.col("j").alias("i"), "k", "v"), left.select("k", F.col("i").alias("j"), "v"), "j")):
        plain = a.withColumnRenamed("v", "_a").join(b.withColumnRenamed("v", "_b"), "k").groupBy("i", "j").agg(F.sum(F.expr("_a * _b")).alias("v"))
        got = products.multiply(a, b)
        assert sorted(got.collect()) == sorted(plain.select("i", "j", "v").collect())
        plan = got.groupBy(row).agg(F.sum("v"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
