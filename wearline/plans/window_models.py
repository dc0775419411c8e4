"""Linear models on whole windows, fitted, searched and trained from window moments.

Inputs are all (time step, feature) places of a window. Penalties apply to standardised inputs
(population standard deviation); an input that is constant has the weight 0.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.operators.ordering import over_series
from wearline.plans.window_moments import Moments
from wearline.schema import CYCLE, ENTITY
from wearline.session import last_text, write_text

SWEEPS = 10_000
SETTLED = 1e-12


@dataclass(frozen=True)
class WindowModel:
    """prediction = intercept + sum of weights[t, f] * value of feature f at time step t."""

    features: list[str]
    weights: np.ndarray
    intercept: float

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per term: t (null for the intercept), feature, value."""
        rows = [(t, f, float(self.weights[t, i])) for t in range(len(self.weights)) for i, f in enumerate(self.features)]
        return spark.createDataFrame([*rows, (None, "intercept", float(self.intercept))], "t int, feature string, value double")


def save_model(model: WindowModel, spark: SparkSession, path: str) -> None:
    model.table(spark).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> WindowModel:
    rows = spark.read.parquet(path).collect()
    features = list(dict.fromkeys(r["feature"] for r in sorted((r for r in rows if r["t"] == 0), key=rows.index)))
    weights = np.zeros((1 + max(r["t"] for r in rows if r["t"] is not None), len(features)))
    for r in rows:
        if r["t"] is not None:
            weights[r["t"], features.index(r["feature"])] = r["value"]
    return WindowModel(features, weights, next(r["value"] for r in rows if r["t"] is None))


# Fitting ---------------------------------------------------------------------------------


def _standard(moments: Moments, point: np.ndarray, scales: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean products of inputs with inputs, with the target, and of the target, in units of `scales` relative to `point`."""
    products = moments.about(point)
    inverse = np.divide(1.0, scales, out=np.zeros_like(scales), where=scales > 0)
    return products[:-1, :-1] * np.outer(inverse, inverse), products[:-1, -1] * inverse, float(products[-1, -1])


def _elastic_net(a: np.ndarray, c: np.ndarray, reg: float, mix: float) -> np.ndarray:
    """Minimum of w a w / 2 - c w + reg * (mix * |w| + (1 - mix) / 2 * w ** 2), by coordinate descent where mix counts."""
    own = np.diag(a) > 0
    w = np.zeros(len(c))
    if reg * mix == 0:
        w[own] = np.linalg.lstsq(a[np.ix_(own, own)] + reg * np.eye(own.sum()), c[own], rcond=1e-12)[0]
        return w
    slope = a @ w
    for _ in range(SWEEPS):
        moved = 0.0
        for j in np.flatnonzero(own):
            pull = c[j] - slope[j] + a[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - reg * mix, 0.0) / (a[j, j] + reg * (1 - mix))
            if new != w[j]:
                slope += a[j] * (new - w[j])
                moved = max(moved, abs(new - w[j]))
                w[j] = new
        if moved < SETTLED * (1 + np.abs(w).max()):
            break
    return w


def _weights(moments: Moments, reg: float, mix: float, intercept: bool) -> tuple[np.ndarray, float]:
    """Weights of the inputs in their own units, and the intercept."""
    scales, means = moments.scales(), moments.means()
    point = means if intercept else np.zeros_like(means)
    a, c, _ = _standard(moments, point, scales)
    w = np.divide(_elastic_net(a, c, reg, mix), scales, out=np.zeros_like(scales), where=scales > 0)
    return w, float(means[-1] - w @ means[:-1]) if intercept else 0.0


def _model(moments: Moments, w: np.ndarray, b: float) -> WindowModel:
    return WindowModel(moments.features, w.reshape(moments.size, -1), b)


def _error(moments: Moments, w: np.ndarray, b: float) -> float:
    """Mean squared error of weights on the windows of `moments`."""
    point = moments.means()
    products = moments.about(point)
    offset = point[-1] - b - w @ point[:-1]
    return max(0.0, float(products[-1, -1] - 2 * w @ products[:-1, -1] + w @ products[:-1, :-1] @ w + offset**2))


def fit_window_model(moments: Moments, reg: float = 0.0, elastic_net: float = 0.0, intercept: bool = True) -> WindowModel:
    """Linear regression on all places of the windows; the shortest solution where inputs depend on each other."""
    if not moments.n:
        raise ValueError("no engine has a whole window")
    return _model(moments, *_weights(moments, reg, elastic_net, intercept))


def grid_search(folds: dict, regs=(0.0, 0.1), mixes=(0.0, 0.5), intercepts=(True, False)) -> tuple[list[tuple], WindowModel]:
    """Each combination with its mean RMSE over the folds and whether it is the best, and the best one fitted on all rows.

    `folds` has the moments of each fold; the train side of a fold is the sum of all less its own, so
    no combination reads rows. Equal scores (to 6 digits) go to the first combination.
    """
    folds = [m for m in folds.values() if m.n]
    if len(folds) < 2:
        raise ValueError("cross validation needs windows in two folds")
    whole = sum(folds[1:], folds[0])
    scored = []
    for reg, mix, intercept in product(regs, mixes, intercepts):
        errors = [_error(fold, *_weights(whole - fold, reg, mix, intercept)) for fold in folds]
        scored.append((reg, mix, intercept, float(np.mean(np.sqrt(errors)))))
    best = min(range(len(scored)), key=lambda i: (round(scored[i][3], 6), i))
    return [(*s, i == best) for i, s in enumerate(scored)], fit_window_model(whole, *scored[best][:3])


def grid_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "reg_param double, elastic_net double, fit_intercept boolean, rmse double, is_best boolean")


# Training by steps -----------------------------------------------------------------------


@dataclass
class Training:
    """State of a training run after some epochs; `history` has (epoch, loss, val_loss, rate)."""

    weights: list[float]
    rate: float
    history: list[list]
    best_epoch: int = 0
    best_loss: float = float("inf")
    best_weights: list[float] | None = None
    idle: int = 0
    plateau_loss: float = float("inf")
    plateau_idle: int = 0
    stopped: bool = False


def train_by_steps(
    train: Moments, validation: Moments, epochs: int = 30, rate: float = 0.1, patience: int = 10,
    factor: float = 0.5, plateau: int = 3, least_rate: float = 1e-5, least_gain: float = 1e-4,
    spark: SparkSession | None = None, folder: str | None = None,
) -> tuple[Training, WindowModel]:
    """Gradient descent on standardised inputs with early stopping; the model of the best epoch.

    Losses are mean squared errors after each epoch's step. Without a lower validation loss in
    `patience` epochs training stops. The rate is multiplied by `factor` after `plateau` epochs without
    a gain of `least_gain`, down to `least_rate`. With `folder`, the state is written there after each epoch, and
    a run that finds a state goes on from it.
    """
    point, scales = train.means(), train.scales()
    a, c, yy = _standard(train, point, scales)
    checks = _standard(validation, point, scales)
    loss = lambda w, p: float(p[2] - 2 * w @ p[1] + w @ p[0] @ w)
    state = Training([0.0] * len(c), rate, [])
    if folder and (saved := last_text(spark, folder, ".json")):
        state = Training(**json.loads(saved))
    while not state.stopped and len(state.history) < epochs:
        w = np.array(state.weights)
        w = w - state.rate * (a @ w - c)
        epoch, error = len(state.history) + 1, loss(w, checks)
        state.weights = w.tolist()
        state.history.append([epoch, loss(w, (a, c, yy)), error, state.rate])
        if error < state.best_loss:
            state.best_epoch, state.best_loss, state.best_weights, state.idle = epoch, error, state.weights, 0
        else:
            state.idle += 1
            state.stopped = state.idle >= patience
        if error < state.plateau_loss - least_gain:
            state.plateau_loss, state.plateau_idle = error, 0
        else:
            state.plateau_idle += 1
            if state.plateau_idle >= plateau:
                state.rate, state.plateau_idle = max(state.rate * factor, least_rate), 0
        if folder:
            write_text(spark, f"{folder}/epoch-{epoch:08d}.json", json.dumps(vars(state)))
    best = np.array(state.best_weights if state.best_weights is not None else state.weights)
    w = np.divide(best, scales, out=np.zeros_like(scales), where=scales > 0)
    return state, _model(train, w, float(point[-1] - w @ point[:-1]))


def history_table(spark: SparkSession, state: Training) -> DataFrame:
    rows = [(*h, h[0] == state.best_epoch) for h in state.history]
    return spark.createDataFrame(rows, "epoch int, loss double, val_loss double, rate double, is_best boolean")


# Scoring ---------------------------------------------------------------------------------


def score_rows(df: DataFrame, model: WindowModel, keep: list[str] | None = None, keys=ENTITY, position=CYCLE, dense: bool = False, block_rows: int | None = None) -> DataFrame:
    """Prediction of the window that ends at each row, for rows that end one.

    A prediction is a sum of earlier rows' weighted values, so no window is built. A missing value in
    a window makes its prediction missing.
    """
    size = len(model.weights)

    def weighted(t: int):
        terms = [F.lit(float(model.weights[t, i])) * F.col(f).cast("double") for i, f in enumerate(model.features)]
        return sum(terms[1:], terms[0])

    steps = df.select(*dict.fromkeys([*keys, position, *(keep or [])]), *[weighted(t).alias(f"_z{t}") for t in range(size)])

    def total(w):
        parts = [F.lag(f"_z{t}", size - 1 - t).over(w) if t < size - 1 else F.col(f"_z{t}") for t in range(size)]
        return sum(parts, F.lit(float(model.intercept)))

    features = {"prediction": total, "_whole": lambda w: F.lag(F.lit(1), size - 1).over(w).isNotNull() if size > 1 else F.lit(True)}
    scored = over_series(steps, features, size - 1, keys, position, block_rows, dense)
    return scored.where("_whole").drop("_whole", *[f"_z{t}" for t in range(size)])
