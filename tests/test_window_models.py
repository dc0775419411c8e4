"""Moments over windows, linear models on them, grid search and training by steps, against windows in numpy."""

from __future__ import annotations

import numpy as np
import pytest

from wearline.operators import ordering
from wearline.plans import window_models as models
from wearline.plans.window_moments import window_moments
from wearline.schema import ENTITY

FEATURES = ["a", "b", "c"]


def series(seed, lengths, offset=0.0):
    """Rows (dataset_id, engine_id, cycle, a, b, c, RUL, side) with gaps in cycle."""
    rng = np.random.default_rng(seed)
    rows = []
    for engine, n in enumerate(lengths):
        x = rng.normal(size=(n, 3)) + offset
        x[:, 1] = np.cumsum(x[:, 1] - offset) / 5
        for k in range(n):
            rows.append(("FD001", engine, 3 + 2 * k, *map(float, x[k]), float(n - k + 3 * x[k, 0] - offset), engine % 3))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "dataset_id string, engine_id long, cycle long, a double, b double, c double, RUL double, side int").repartition(3)


def windows(rows, size, side=None):
    """Flat inputs and targets of all windows."""
    x, y = [], []
    for engine in sorted({r[1] for r in rows}):
        own = sorted(r for r in rows if r[1] == engine and (side is None or r[7] == side))
        for end in range(size, len(own) + 1):
            x.append(np.array([r[3:6] for r in own[end - size : end]]).ravel())
            y.append(own[end - 1][6])
    return np.array(x), np.array(y)


def least_squares(x, y):
    centred = x - x.mean(axis=0)
    w = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
    return w, y.mean() - w @ x.mean(axis=0)


@pytest.mark.parametrize("block", [None, 7])
def test_moments_are_those_of_the_windows(spark, block):
    rows = series(1, [3, 4, 5, 40, 17, 60])
    moments = window_moments(frame(spark, rows), FEATURES, size=5, block_rows=block)[None]
    x, y = windows(rows, 5)
    whole = np.column_stack([x, y])
    assert moments.n == len(x)
    np.testing.assert_allclose(moments.means(), whole.mean(axis=0), atol=1e-12)
    np.testing.assert_allclose(moments.about(moments.means()), np.cov(whole.T, bias=True), atol=1e-10)
    np.testing.assert_allclose(moments.about(np.zeros(16)), whole.T @ whole / len(whole), atol=1e-9)


def test_large_offsets_lose_nothing(spark):
    rows = series(2, [30, 50, 41], offset=1e8)
    moments = window_moments(frame(spark, rows), FEATURES, size=4)[None]
    x, y = windows(rows, 4)
    whole = np.column_stack([x, y])
    np.testing.assert_allclose(moments.about(moments.means()), np.cov(whole.T, bias=True), rtol=1e-6, atol=1e-6)


def test_whole_windows_of_thirty_steps(spark):
    rows = series(3, [200, 150, 29, 30, 90])
    moments = window_moments(frame(spark, rows), FEATURES)[None]
    x, y = windows(rows, 30)
    model = models.fit_window_model(moments)
    w, b = least_squares(x, y)
    np.testing.assert_allclose(model.weights.ravel(), w, atol=1e-7)
    assert model.intercept == pytest.approx(b, abs=1e-6)


def test_groups_add_up(spark):
    rows = series(4, [20, 30, 25, 40, 8])
    df = frame(spark, rows)
    sides = window_moments(df, FEATURES, size=3, by="side")
    whole = window_moments(df, FEATURES, size=3)[None]
    assert sorted(sides) == [0, 1, 2]
    added = sides[0] + sides[1] + sides[2]
    np.testing.assert_allclose(added.about(whole.means()), whole.about(whole.means()), atol=1e-10)
    np.testing.assert_allclose((whole - sides[1]).means(), (sides[0] + sides[2]).means(), atol=1e-12)


def test_no_window_is_built(spark):
    rows = frame(spark, series(5, [20, 30]))
    made = []
    collect = type(rows).collect
    type(rows).collect = lambda self: (made.append(self._jdf.queryExecution().toString()), collect(self))[1]
    try:
        window_moments(rows, FEATURES, size=3)
    finally:
        type(rows).collect = collect
    assert made and not any("collect_list" in plan for plan in made)


def test_constant_and_dependent_inputs(spark):
    rows = [(*r[:3], r[3], 518.67, r[3] * 2, r[6], r[7]) for r in series(6, [40, 60])]
    moments = window_moments(frame(spark, rows), FEATURES, size=4)[None]
    model = models.fit_window_model(moments)
    assert np.all(model.weights[:, 1] == 0)
    x, y = windows(rows, 4)
    w, b = least_squares(x[:, [c for c in range(12) if c % 3 == 0]], y)
    np.testing.assert_allclose(x @ model.weights.ravel() + model.intercept, x[:, [c for c in range(12) if c % 3 == 0]] @ w + b, atol=1e-8)


def test_missing_values_and_short_series_are_errors(spark):
    rows = series(7, [20])
    with pytest.raises(ValueError, match="missing"):
        window_moments(frame(spark, [*rows[:-1], (*rows[-1][:3], None, *rows[-1][4:])]), FEATURES, size=3)
    short = series(7, [2, 2])
    moments = window_moments(frame(spark, short), FEATURES, size=3)[None]
    assert moments.n == 0
    with pytest.raises(ValueError, match="whole window"):
        models.fit_window_model(moments)
    assert window_moments(frame(spark, []), FEATURES, size=3) == {}


@pytest.mark.parametrize("dense", [False, True])
def test_scores_without_windows(spark, monkeypatch, dense):
    monkeypatch.setattr(ordering, "BLOCK_ROWS", 6)
    rows = series(8, [3, 4, 25, 13])
    if dense:
        rows = [(*r[:2], (r[2] - 1) // 2, *r[3:]) for r in rows]
    model = models.WindowModel(FEATURES, np.arange(12).reshape(4, 3) / 7, 2.5)
    got = models.score_rows(frame(spark, rows), model, dense=dense).orderBy(*ENTITY, "cycle").collect()
    x, _ = windows(rows, 4)
    np.testing.assert_allclose([r["prediction"] for r in got], x @ model.weights.ravel() + 2.5)


def test_saved_model_is_the_same(spark, tmp_path):
    model = models.WindowModel(["b", "a"], np.array([[1.5, -2.0], [0.0, 4.0], [1e-9, 3.0]]), -7.25)
    models.save_model(model, spark, str(tmp_path / "model"))
    got = models.load_model(spark, str(tmp_path / "model"))
    assert got.features == model.features and got.intercept == model.intercept and np.array_equal(got.weights, model.weights)


def elastic_net_by_steps(x, y, reg, mix, intercept, steps=60_000):
    """Proximal gradient on standardised inputs."""
    scale = x.std(axis=0)
    z, r = ((x - x.mean(axis=0)) / scale, y - y.mean()) if intercept else (x / scale, y)
    a, c = z.T @ z / len(z), z.T @ r / len(z)
    rate = 1 / np.linalg.eigvalsh(a)[-1]
    w = np.zeros(len(c))
    for _ in range(steps):
        v = w - rate * (a @ w - c + reg * (1 - mix) * w)
        w = np.sign(v) * np.maximum(np.abs(v) - rate * reg * mix, 0)
    w = w / scale
    return w, y.mean() - w @ x.mean(axis=0) if intercept else 0.0


def test_grid_search_is_cross_validation(spark):
    rows = series(9, [40, 60, 50, 45, 30, 70])
    scored, best = models.grid_search(window_moments(frame(spark, rows), FEATURES, size=2, by="side"))
    sides = {s: windows(rows, 2, s) for s in range(3)}
    for reg, mix, intercept, rmse, _ in scored:
        errors = []
        for s in range(3):
            x, y = (np.concatenate([sides[o][k] for o in range(3) if o != s]) for k in range(2))
            w, b = elastic_net_by_steps(x, y, reg, mix, intercept)
            errors.append(np.sqrt(np.mean((sides[s][1] - sides[s][0] @ w - b) ** 2)))
        assert rmse == pytest.approx(np.mean(errors), rel=1e-6)
    assert sum(s[4] for s in scored) == 1 and len(scored) == 8
    winner = next(s for s in scored if s[4])
    w, b = elastic_net_by_steps(*windows(rows, 2), *winner[:3])
    np.testing.assert_allclose(best.weights.ravel(), w, atol=1e-5)


def test_training_stops_early_and_keeps_the_best(spark, tmp_path):
    few, other = series(10, [9, 8]), series(11, [60, 70])
    rows = [(*r[:7], 0) for r in few] + [(r[0], r[1] + 10, *r[2:7], 1) for r in other]
    sides = window_moments(frame(spark, rows), FEATURES, size=4, by="side")
    state, model = models.train_by_steps(sides[0], sides[1], epochs=500, rate=0.2, patience=5, spark=spark, folder=str(tmp_path / "a"))
    assert state.stopped and len(state.history) == state.best_epoch + 5 < 500
    assert min(h[2] for h in state.history) == state.best_loss == state.history[state.best_epoch - 1][2]
    x, y = windows(rows, 4, 1)
    assert np.mean((y - x @ model.weights.ravel() - model.intercept) ** 2) == pytest.approx(state.best_loss)
    assert [h[3] for h in state.history] == sorted((h[3] for h in state.history), reverse=True)


def test_training_goes_on_from_its_state(spark, tmp_path):
    sides = window_moments(frame(spark, series(12, [50, 60, 40])), FEATURES, size=3, by="side")
    whole, _ = models.train_by_steps(sides[0], sides[1], epochs=12)
    models.train_by_steps(sides[0], sides[1], epochs=5, spark=spark, folder=str(tmp_path / "run"))
    again, _ = models.train_by_steps(sides[0], sides[1], epochs=12, spark=spark, folder=str(tmp_path / "run"))
    assert again == whole
