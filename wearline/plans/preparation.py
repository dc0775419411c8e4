"""The two composed preparations: from raw log to scaled features, and on to windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.operators.ordering import number_rows
from wearline.operators.quality import constant_columns, drop_duplicates, iqr_outliers, profile, quality_report
from wearline.operators.sequences import rolling_sequences
from wearline.operators.transforms import (
    align_features,
    apply_scaler,
    downcast,
    feature_manifest,
    fit_scaler,
    manifest_names,
    without_dataset,
)
from wearline.operators.windows import add_engine_features, fill_series, impute_by_group, rolling_mean_of, rolling_std_of
from wearline.operators.ordering import over_series
from wearline.plans.rul import test_rul, train_rul
from wearline.schema import CYCLE, DATASET_ID, ENGINE_ID, ENTITY, RUL, WINDOW_SIZE, columns_with_prefix, numeric_columns
from wearline.session import stage

# Column of the numbered rows while a preparation runs.
PLACE = "_place"


def prepare_train(df: DataFrame, method: str = "standard", size: int = WINDOW_SIZE, max_features: int | None = None) -> dict[str, DataFrame]:
    """Target, features, manifest, scaler and windows from a complete-life log.

    The log's rows are numbered once, so cycles may have gaps or start late. All features are kept
    unless `max_features` asks for the first ones only.
    """
    labelled = number_rows(train_rul(df), list(ENTITY), [CYCLE], PLACE)
    constant = constant_columns(labelled, columns_with_prefix(df.columns, "sensor_"))
    features = stage(add_engine_features(labelled, constant, position=PLACE, dense=True), "features")
    manifest = feature_manifest(df.sparkSession, [c for c in features.columns if c != PLACE], max_features)
    names = manifest_names(manifest)
    scaler = stage(fit_scaler(features, names), "scaler")
    scaled = apply_scaler(align_features(features, manifest, [*ENTITY, CYCLE, RUL, PLACE]), scaler, method)
    return {"manifest": manifest, "scaler": scaler} | _scaled_and_windows(scaled, names, size)


def _scaled_and_windows(scaled: DataFrame, names: list[str], size: int) -> dict[str, DataFrame]:
    windows = rolling_sequences(scaled, names, size, position=PLACE, carry=[CYCLE, RUL], dense=True)
    return {"scaled": scaled.drop(PLACE), "sequences": windows.select(*ENTITY, CYCLE, RUL, "seq")}


def prepare_test(
    df: DataFrame, truth: DataFrame | None, manifest: DataFrame, scaler: DataFrame, method: str = "standard", size: int = WINDOW_SIZE
) -> dict[str, DataFrame]:
    """The same steps on unfinished engines, with the train manifest and scaler."""
    numbered = number_rows(test_rul(df, truth), list(ENTITY), [CYCLE], PLACE)
    features = add_engine_features(numbered, [], position=PLACE, dense=True)
    names = manifest_names(manifest)
    scaled = apply_scaler(align_features(features, manifest, [*ENTITY, CYCLE, RUL, PLACE]), scaler, method)
    return _scaled_and_windows(scaled, names, size)


def fill_missing(df: DataFrame, method: str, keys: list[str], position: str) -> DataFrame:
    """Fill missing sensor and setting values by one of the named methods, or drop their rows."""
    columns = [c for c in numeric_columns(df.schema) if c not in (*keys, position, CYCLE)]
    if method in ("ffill", "bfill"):
        return fill_series(df, columns, method, keys, position)
    if method in ("mean", "median"):
        return impute_by_group(df, columns, keys, method)
    if method == "drop":
        return df.na.drop("any")
    raise ValueError(f"unknown method: {method}")


def prepare_complete(
    df: DataFrame,
    fill: str = "ffill",
    remove_constant: bool = True,
    remove_duplicates: bool = False,
    create_rolling: bool = True,
    window: int = 5,
    optimize_types: bool = True,
    scale: bool = True,
    method: str = "standard",
    keys: list[str] | None = None,
    with_reports: bool = True,
) -> dict:
    """All cleaning and feature steps in their fixed order, with switches.

    Positions are numbered once after the optional removal of duplicates. The table is written after it
    is filled and after the windows, since several passes read it there. The profile, outlier and
    quality reports are passes of their own; a caller who does not want them says `with_reports=False`.
    """
    keys = list(keys or ENTITY)
    steps = ["load", "profile", "sort"]
    reports: dict = {"profile": profile(df)} if with_reports else {}
    numbered = number_rows(df, keys, [CYCLE], "_pos")
    filled = fill_missing(numbered, fill, keys, "_pos")
    if fill == "drop":  # the rows that stay are numbered anew
        filled = number_rows(filled.drop("_pos"), keys, [CYCLE], "_pos")
    filled = stage(filled, "filled")
    steps.append("fill")
    sensors = [c for c in numeric_columns(df.schema, (ENGINE_ID, CYCLE, *keys))]
    constant = constant_columns(filled, sensors) if remove_constant else []
    filled = filled.drop(*constant)
    steps.append("constant columns")
    reports["constant"] = constant
    if remove_duplicates:
        plain = drop_duplicates(filled.drop("_pos"))
        filled = stage(number_rows(plain, keys, [CYCLE], "_pos"), "unique")
    steps.append("duplicates")
    sensors = columns_with_prefix(filled.columns, "sensor_")
    if with_reports:
        reports["outliers"] = iqr_outliers(filled, sensors)
        steps.append("outliers")
    out = filled
    if create_rolling:
        features = {}
        for c in sensors:
            features[f"{c}_rollmean{window}"] = rolling_mean_of(c, window)
            features[f"{c}_rollstd{window}"] = rolling_std_of(c, window)
        out = over_series(filled, features, window - 1, keys, "_pos", dense=True).na.drop("any")
        steps.append("rolling")
    out = out.drop("_pos")
    if optimize_types or scale:
        out = stage(out, "rolled")
    if optimize_types:
        out = downcast(out, exclude=[*keys, CYCLE])
        steps.append("types")
    if scale:
        columns = numeric_columns(out.schema, (ENGINE_ID, CYCLE, DATASET_ID, *keys))
        scaler = stage(fit_scaler(out, columns), "scaler")
        out = apply_scaler(out, scaler, method)
        reports["scaler"] = scaler
        steps.append("scale")
    if with_reports:
        reports["quality"] = quality_report(out)
        steps.append("validate")
    return {"data": out, "matrix": without_dataset(out), "reports": reports, "steps": steps}
