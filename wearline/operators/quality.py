"""Data quality: profiles, constant columns, outliers, duplicates, distributions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.functions.scalar import clip, infinite_to_missing, is_infinite
from wearline.operators.aggregates import distinct_counts, stack
from wearline.operators.joins import attach
from wearline.operators.products import PAIR_EXPRESSIONS, pair_count, tiled_gram
from wearline.operators.quantiles import exact_quantiles, quantile_row
from wearline.schema import CYCLE, DATASET_ID, ENGINE_ID, columns_with_prefix, numeric_columns
from wearline.session import stage_counted


def _metrics(row: DataFrame, names: list[str]) -> DataFrame:
    """One aggregated row as (metric, value) rows."""
    return stack(
        row.select(*[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").cast("double").alias("value")).alias(f"_{i}")
                     for i, n in enumerate(names)]),
        [], len(names),
    )


def _duplicate_count(df: DataFrame, subset: list[str] | None = None) -> Column:
    """Rows that repeat an earlier one, as a scalar subquery; missing values count as equal."""
    groups = df.groupBy(*(subset or df.columns)).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return groups.agg(F.coalesce(F.sum("extra"), F.lit(0))).scalar()


def duplicate_count(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    groups = df.groupBy(*(subset or df.columns)).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return groups.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n_duplicates"))


def drop_duplicates(df: DataFrame, subset: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Keep one row per distinct key: the first in `order`, which must tell copies apart.

    Two phases. Rows are counted by a 128-bit hash of their key, in buffers of fixed width; those whose hash is alone
    stay as they are. Only the others are compared by their whole keys, and a task sends at most its
    first row of each key, so that a key with very many copies stays cheap.
    """
    if subset is None:
        return df.distinct()
    hashes = {"_h1": F.xxhash64(*subset), "_h2": F.xxhash64(F.lit(1), *subset)}
    hashed = df.withColumns(hashes)
    copied = hashed.groupBy(*hashes).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*hashes)
    copies, found = stage_counted(copied, "copied")
    if not found:
        return df
    rest = [c for c in df.columns if c not in subset]
    first = Window.partitionBy(*subset).orderBy(*(order or rest or subset))
    repeated = hashed.join(copies, [*hashes], "left_semi").withColumn("_place", F.row_number().over(first)).where("_place = 1")
    return hashed.join(copies, [*hashes], "left_anti").select(*df.columns).union(repeated.select(*df.columns))


def profile(df: DataFrame) -> DataFrame:
    """Rows, columns, columns per type, missing cells, duplicates, rows per data set, sensor statistics."""
    sensors = columns_with_prefix(df.columns, "sensor_")
    missing = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    aggregates: dict[str, Column] = {
        "rows": F.count(F.lit(1)),
        "columns": F.lit(len(df.columns)),
        "missing": missing,
    }
    for kind in sorted({f.dataType.simpleString() for f in df.schema.fields}):
        aggregates[f"type_{kind}"] = F.lit(sum(f.dataType.simpleString() == kind for f in df.schema.fields))
    for c in sensors:
        for name, how in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
            aggregates[f"{c}_{name}"] = how(c)
    row = df.agg(*[e.alias(n) for n, e in aggregates.items()]).withColumn("duplicates", _duplicate_count(df))
    out = _metrics(row, [*aggregates, "duplicates"])
    if DATASET_ID in df.columns:
        per_set = df.groupBy(DATASET_ID).agg(F.count(F.lit(1)).cast("double").alias("value"))
        out = out.unionByName(per_set.select(F.concat(F.lit("rows_"), DATASET_ID).alias("metric"), "value"))
    return out


def quality_report(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells, duplicates, numeric columns and infinite values."""
    numeric = numeric_columns(df.schema)
    row = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0)).alias("missing_values"),
        F.lit(len(numeric)).alias("numeric_columns"),
        sum((F.count_if(is_infinite(c)) for c in numeric), F.lit(0)).alias("inf_values"),
    ).withColumn("duplicate_rows", _duplicate_count(df))
    return _metrics(row, ["total_rows", "total_columns", "missing_values", "duplicate_rows", "numeric_columns", "inf_values"])


def constant_report(df: DataFrame, columns: list[str] | None = None, threshold: float = 0.0) -> DataFrame:
    """Std and number of values per column, with `is_constant`.

    A repeated value can show a tiny float std, so equal minimum and maximum also count.
    """
    columns = columns or numeric_columns(df.schema, (ENGINE_ID, CYCLE))
    moments = stack(
        df.agg(
            *[F.struct(F.lit(c).alias("column"), F.stddev_samp(c).alias("std"),
                       ((F.min(c) == F.max(c)) | (F.stddev_samp(c) <= threshold)).alias("is_constant")).alias(f"_{j}")
              for j, c in enumerate(columns)]
        ),
        [], len(columns),
    )
    return moments.join(distinct_counts(df, columns), "column")


def constant_columns(df: DataFrame, columns: list[str] | None = None, threshold: float = 0.0) -> list[str]:
    columns = columns or numeric_columns(df.schema, (ENGINE_ID, CYCLE))
    row = df.agg(
        *[F.coalesce((F.min(c) == F.max(c)) | (F.stddev_samp(c) <= threshold), F.lit(False)).alias(c) for c in columns]
    ).first()
    return [c for c in columns if row[c]]


def iqr_bounds(df: DataFrame, columns: list[str], k: float = 1.5) -> dict[str, tuple[float, float]]:
    bounds = {}
    for c, (q1, q3) in quantile_row(df, columns, [0.25, 0.75]).items():
        bounds[c] = (None, None) if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return bounds


def _outlier_rows(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    counted = df.agg(
        *[F.struct(F.lit(c).alias("column"), F.count_if(flag).alias("n_outliers"),
                   (100.0 * F.try_divide(F.count_if(flag), F.count(F.lit(1)))).alias("pct")).alias(f"_{j}")
          for j, (c, flag) in enumerate(flags.items())]
    )
    return stack(counted, [], len(flags))


def iqr_outliers(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Values outside the quartiles widened by k times their distance, per column."""
    flags = {c: (F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)) for c, (lo, hi) in iqr_bounds(df, columns, k).items()}
    return _outlier_rows(df, flags)


def zscore_outliers(df: DataFrame, columns: list[str], threshold: float = 1.5) -> DataFrame:
    """Values further than `threshold` sample standard deviations from the mean, per column."""
    row = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in columns]).first()
    flags = {}
    for c in columns:
        mean, std = row[c]["m"], row[c]["s"]
        flags[c] = F.abs((F.col(c) - F.lit(mean)) / F.lit(std)) > threshold if std else F.lit(False)
    return _outlier_rows(df, flags)


def top_outlier_columns(outliers: DataFrame, k: int = 10) -> DataFrame:
    """The k columns with most outliers; k rows are the report."""
    return outliers.where("n_outliers > 0").orderBy(F.col("n_outliers").desc(), "column").limit(k)


def drop_outlier_rows(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Rows inside the bounds of every column; rows with a missing value fall out."""
    for c, (lo, hi) in iqr_bounds(df, columns, k).items():
        df = df.where(F.col(c).between(lo, hi))
    return df


def cap_outliers(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in iqr_bounds(df, columns, k).items()})


def inflation_factor(gram: np.ndarray, i: int) -> float:
    """Of column i in a matrix of column products; infinite where the others determine it.

    1 / (1 - R2) of the regression on the other columns, whose own dependences do not matter.
    """
    rest = [j for j in range(len(gram)) if j != i]
    if not gram[i, i] > 0:
        return float("nan")
    # Columns of very different sizes are brought to length 1 first.
    length = np.sqrt(np.maximum(np.diag(gram), np.finfo(float).tiny))
    unit = gram / np.outer(length, length)
    left = 1 - unit[i, rest] @ np.linalg.pinv(unit[np.ix_(rest, rest)], rcond=1e-12, hermitian=True) @ unit[rest, i] if rest else 1.0
    return float("inf") if left < 1e-10 else float(1 / left)


def inflation_factors(gram: np.ndarray) -> list[float]:
    """All factors from one inverse where the columns are independent; else one by one."""
    length = np.sqrt(np.maximum(np.diag(gram), np.finfo(float).tiny))
    unit = gram / np.outer(length, length)
    if np.linalg.eigvalsh(unit)[0] > 1e-9:
        return [float(v) for v in np.diag(np.linalg.inv(unit))]
    return [inflation_factor(gram, i) for i in range(len(gram))]


def variance_inflation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Variance inflation factor per column without intercept.

    Infinite values become missing and missing ones the mean. One aggregation yields the
    k x k matrix of column products; only that matrix is inverted on the driver.
    """
    finite = df.select(*[infinite_to_missing(c).cast("double").alias(c) for c in columns])
    means = finite.agg(*[F.avg(c).alias(c) for c in columns]).first()
    filled = finite.select(*[F.coalesce(F.col(c), F.lit(means[c])).alias(c) for c in columns])
    k = len(columns)
    if pair_count(columns) > PAIR_EXPRESSIONS:
        factors = inflation_factors(tiled_gram(filled, columns))
    else:
        sums = filled.agg(
            *[F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"{i}_{j}") for i in range(k) for j in range(i, k)]
        ).first()
        gram = np.array([[sums[f"{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], float)
        factors = [inflation_factor(gram, i) for i in range(k)]
    schema = T.StructType([T.StructField("column", T.StringType()), T.StructField("vif", T.DoubleType())])
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(columns, factors)], schema)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width counts; the last bin includes the maximum and empty bins show zero."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:  # nothing present: empty bins over the unit interval
        low, high = 0.0, 1.0
    width = (high - low) / bins if high > low else 1.0 / bins
    low = low if high > low else low - 0.5
    place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("long")
    counted = df.where(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(
        F.col("id").alias("bin"), (F.lit(low) + F.col("id") * width).alias("left_edge"),
        (F.lit(low) + (F.col("id") + 1) * width).alias("right_edge"),
    )
    return grid.join(counted, "bin", "left").na.fill(0, ["n"])


def density_grid(df: DataFrame, column: str, points: int = 50) -> DataFrame:
    """Gaussian kernel density at equally spaced points, Scott bandwidth.

    All points are sums of one partial aggregation, so no value is shuffled.
    """
    n, std, low, high = df.agg(
        F.count(column), F.stddev_samp(column), F.min(column).cast("double"), F.max(column).cast("double")
    ).first()
    if not std:
        raise ValueError(f"{column} has no spread, so it has no density")
    h = std * n ** (-0.2)
    step = (high - low) / (points - 1)
    scale = 1.0 / (n * h * float(np.sqrt(2 * np.pi)))
    sums = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x")).agg(
        *[F.struct(F.lit(i).cast("long").alias("point"), F.lit(low + i * step).alias("x"),
                   (F.sum(F.exp(-0.5 * F.pow((F.lit(low + i * step) - F.col("x")) / h, F.lit(2.0)))) * scale)
                   .alias("density")).alias(f"_{i}") for i in range(points)]
    )
    return stack(sums, [], points)


def box_stats(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """Quartiles, whiskers at the extreme points within 1.5 quartile distances, and outliers."""
    by = list(by or [])
    quartiles = exact_quantiles(df, [column], [0.25, 0.5, 0.75], ["q1", "median", "q3"], by=by).drop("column", "n")
    if by:
        joined = attach(df.select(*by, column), quartiles, by)
    else:
        q1, median, q3 = quartiles.first()
        joined = df.select(column, F.lit(q1).alias("q1"), F.lit(median).alias("median"), F.lit(q3).alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(column).between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.groupBy(*by).agg(
        F.count(column).alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col(column))).alias("whisker_low"),
        F.max(F.when(inside, F.col(column))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )
