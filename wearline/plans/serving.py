"""From window features to maintenance alerts by predicted life."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.operators.splits import split_by_engine
from wearline.operators.transforms import apply_scaler, fit_scaler
from wearline.plans.alerts import latest_zones, zone_counts, zone_messages, zone_metrics
from wearline.plans.learning import score_features, train_regressor
from wearline.plans.rul import regression_metrics
from wearline.schema import CYCLE, ENTITY, RUL
from wearline.session import stage


def train_and_validate(features: DataFrame, inputs: list[str], test_share: float = 0.2, seed: int = 42) -> dict:
    """Scaler and model from the train engines, predictions for all windows, metrics on the others.

    `features` has the window inputs and the target; whole engines are on either side, and nothing
    fitted has seen a validation engine.
    """
    marked = stage(split_by_engine(features, test_share, seed), "split")
    train = marked.where("NOT is_test")
    scaler = stage(fit_scaler(train, inputs), "scaler")
    scaled = stage(apply_scaler(marked, scaler, "standard"), "scaled")
    model = train_regressor(scaled.where("NOT is_test"), inputs)
    predictions = score_features(scaled, model, [RUL, "is_test"])
    return {
        "model": model,
        "scaler": scaler,
        "predictions": predictions,
        "metrics": regression_metrics(predictions.where("is_test"), RUL, "prediction"),
    }


def maintenance(
    predictions: DataFrame, edges: list[float] | None = None, labels: list[str] | None = None, messages: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Latest predicted life per engine, its zone, the engines per zone, as metrics too, and the messages."""
    latest = latest_zones(predictions.select(*ENTITY, CYCLE, F.col("prediction").alias(RUL)), edges=edges, labels=labels)
    counts = zone_counts(latest, labels)
    return {"latest": latest, "counts": counts, "metrics": zone_metrics(latest, labels), "messages": zone_messages(counts, messages)}
