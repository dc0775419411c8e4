"""Per-engine window features and fills."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wearline.operators.joins import attach
from wearline.operators.ordering import BLOCK_ROWS, block_of, over_series
from wearline.operators.quantiles import exact_quantiles
from wearline.schema import CYCLE, ENTITY, columns_with_prefix

Feature = Callable[[WindowSpec], Column]


def rolling_mean_of(column: str, n: int) -> Feature:
    return lambda w: F.avg(column).over(w.rowsBetween(1 - n, 0))


def rolling_std_of(column: str, n: int, first: float | None = None) -> Feature:
    """Sample standard deviation of the last n rows; `first` replaces the missing one-row value."""

    def make(w: WindowSpec) -> Column:
        std = F.stddev_samp(column).over(w.rowsBetween(1 - n, 0))
        return std if first is None else F.coalesce(std, F.lit(first))

    return make


def difference_of(column: str) -> Feature:
    return lambda w: F.coalesce(F.col(column) - F.lag(column).over(w), F.lit(0.0))


def rolling_mean(df: DataFrame, columns: list[str], sizes: list[int], keys=ENTITY, position=CYCLE, block_rows=None, dense=False) -> DataFrame:
    features = {f"{c}_rollmean{n}": rolling_mean_of(c, n) for c in columns for n in sizes}
    return over_series(df, features, max(sizes) - 1, keys, position, block_rows, dense)


def rolling_std(
    df: DataFrame, columns: list[str], sizes: list[int], first: float | None = None, keys=ENTITY, position=CYCLE, block_rows=None, dense=False
) -> DataFrame:
    features = {f"{c}_rollstd{n}": rolling_std_of(c, n, first) for c in columns for n in sizes}
    return over_series(df, features, max(sizes) - 1, keys, position, block_rows, dense)


def difference(df: DataFrame, columns: list[str], keys=ENTITY, position=CYCLE, block_rows=None, dense=False) -> DataFrame:
    return over_series(df, {f"{c}_diff1": difference_of(c) for c in columns}, 1, keys, position, block_rows, dense)


def share_of_group_max(df: DataFrame, column: str, name: str, keys=ENTITY) -> DataFrame:
    """A maximum of 0 gives no share."""
    tops = df.groupBy(*keys).agg(F.max(column).alias("_top"))
    return attach(df, tops, keys).withColumn(name, F.try_divide(F.col(column), F.col("_top"))).drop("_top")


def engine_features(sensors: list[str], settings: list[str]) -> dict[str, Feature]:
    """The full feature set: five columns per sensor, two per setting, one of the cycle."""
    features: dict[str, Feature] = {}
    for c in sensors:
        for n in (3, 5):
            features[f"{c}_rollmean{n}"] = rolling_mean_of(c, n)
            features[f"{c}_rollstd{n}"] = rolling_std_of(c, n, first=0.0)
        features[f"{c}_diff1"] = difference_of(c)
    for c in settings:
        features[f"{c}_rollmean3"] = rolling_mean_of(c, 3)
        features[f"{c}_diff1"] = difference_of(c)
    features["cycle_rollmean"] = rolling_mean_of(CYCLE, 3)
    return features


FEATURE_REACH = 4


def add_engine_features(
    df: DataFrame,
    constant: list[str],
    with_life_share: bool = False,
    life: str | None = None,
    keys=ENTITY,
    position=CYCLE,
    block_rows=None,
    dense=False,
) -> DataFrame:
    """Drop constant sensors and add the engineered features in one pass.

    The share of the engine's life leaks the target, so it is added on request only. A `life`
    column with the engine's last cycle, where there is one, saves looking that up.
    """
    kept = df.drop(*constant)
    features = engine_features(columns_with_prefix(kept.columns, "sensor_"), columns_with_prefix(kept.columns, "op_setting_"))
    out = over_series(kept, features, FEATURE_REACH, keys, position, block_rows, dense)
    if not with_life_share:
        return out
    if life:
        return out.withColumn("cycle_pct_max", F.try_divide(F.col(position), F.col(life)))
    return share_of_group_max(out, position, "cycle_pct_max", keys)


def fill_series(
    df: DataFrame, columns: list[str], method: str = "ffill", keys=ENTITY, position=CYCLE, block_rows: int | None = None
) -> DataFrame:
    """Carry the last present value forward and fill what stays empty backward, or the mirror.

    Carries run inside each block of positions; a small table with the last and first present
    value of each block supplies what lies before and after it.
    """
    if method not in ("ffill", "bfill"):
        raise ValueError(f"unknown fill method: {method}")
    blocked = df.withColumn("_block", block_of(position, block_rows))
    at = F.col(position)
    edges = blocked.groupBy(*keys, "_block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_last_{c}") for c in columns],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_first_{c}") for c in columns],
    )
    by_engine = Window.partitionBy(*keys)
    earlier = by_engine.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    later = by_engine.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        *keys,
        "_block",
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_before_{c}") for c in columns],
        *[F.last(f"_first_{c}", ignorenulls=True).over(later).alias(f"_after_{c}") for c in columns],
    )
    # Looking ahead is looking back in falling order: a frame that grows costs one step per row,
    # one that shrinks from the front is evaluated anew for each.
    inside = Window.partitionBy(*keys, "_block")
    past = inside.orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = inside.orderBy(F.desc(position)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {}
    for c in columns:
        forward = (F.last(c, ignorenulls=True).over(past), F.col(f"_before_{c}"))
        backward = (F.last(c, ignorenulls=True).over(ahead), F.col(f"_after_{c}"))
        filled[c] = F.coalesce(*forward, *backward) if method == "ffill" else F.coalesce(*backward, *forward)
    joined = blocked.join(carried, [*keys, "_block"])
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def impute_by_group(df: DataFrame, columns: list[str], by: list[str], statistic: str = "mean") -> DataFrame:
    """Fill missing values with the group's mean or median; an all-missing group stays empty."""
    if statistic == "mean":
        side = df.groupBy(*by).agg(*[F.avg(c).alias(f"_fill_{c}") for c in columns])
    elif statistic == "median":
        medians = exact_quantiles(df, columns, [0.5], ["median"], by=by)
        side = medians.groupBy(*by).agg(
            *[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"_fill_{c}") for c in columns]
        )
    else:
        raise ValueError(f"unknown statistic: {statistic}")
    joined = attach(df, side, by, "left")
    return joined.select(*[F.coalesce(c, f"_fill_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def latest_rows(df: DataFrame, keys=ENTITY, position=CYCLE) -> DataFrame:
    """The last row of each engine (`position` is unique there); partial maxima travel, not the series.

    One `max_by` per column keeps the buffers fixed-width, so Spark aggregates by hash without a sort.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.max_by(c, position).alias(c) for c in rest]).select(*df.columns)


def first_engines(df: DataFrame, k: int, keys=ENTITY) -> DataFrame:
    """The first k engines by key; k is the feature, as on a chart with k lines."""
    return df.select(*keys).distinct().orderBy(*keys).limit(k)


def head_tail(df: DataFrame, k: int, keys=ENTITY, position=CYCLE) -> DataFrame:
    """First and last k rows of each engine, tagged; Spark limits each group before the shuffle."""
    up = Window.partitionBy(*keys).orderBy(F.col(position))
    down = Window.partitionBy(*keys).orderBy(F.col(position).desc())
    head = df.withColumn("rank", F.row_number().over(up)).where(F.col("rank") <= k).withColumn("part", F.lit("head"))
    tail = df.withColumn("rank", F.row_number().over(down)).where(F.col("rank") <= k).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)
