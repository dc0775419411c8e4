"""Aggregations: group statistics, counts, distributions and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.functions.scalar import is_infinite
from wearline.operators.products import PAIR_EXPRESSIONS, pair_count, tiled_correlations
from wearline.operators.quantiles import exact_quantiles, quantiles_and
from wearline.schema import CYCLE, ENTITY, columns_with_prefix


def stack(row: DataFrame, by: list[str], structs: int) -> DataFrame:
    """Turn struct columns _0 .. _n-1 of an aggregated frame into rows."""
    return row.select(*by, F.explode(F.array(*[F.col(f"_{j}") for j in range(structs)])).alias("_s")).select(*by, "_s.*")


def max_cycle(df: DataFrame, keys=ENTITY, position=CYCLE) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(position).alias("max_cycle"))


def engine_stats(df: DataFrame, prefix: str = "sensor_", keys=ENTITY) -> DataFrame:
    """Mean, sample std, min and max of every sensor, as sensor_k_mean and so on."""
    aggregates = []
    for c in columns_with_prefix(df.columns, prefix):
        aggregates += [
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_samp(c).alias(f"{c}_std"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    return df.groupBy(*keys).agg(*aggregates)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Present values with their counts, most frequent first."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), column)


def counts_for_labels(df: DataFrame, column: str, labels: list[str]) -> DataFrame:
    """Counts for a fixed label list in its order, zero where a label does not occur."""
    counted = df.agg(
        *[F.struct(F.lit(i + 1).cast("long").alias("pos"), F.lit(x).alias(column),
                   F.count_if(F.col(column) == x).alias("n")).alias(f"_{i}") for i, x in enumerate(labels)]
    )
    return stack(counted, [], len(labels)).orderBy("pos")


def two_level_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest, median and largest number of rows per group."""
    per_group = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    found = exact_quantiles(per_group, ["n_rows"], [0.0, 0.5, 1.0], ["smallest", "median", "largest"])
    return found.select(F.col("n").alias("n_groups"), "smallest", "median", "largest")


def global_stats(df: DataFrame, column: str) -> DataFrame:
    """Mean, median, population std, sum, min and max of one column, in one row."""
    moments = df.agg(
        F.avg(column).alias("mean"), F.stddev_pop(column).alias("std_pop"), F.sum(column).alias("total"),
        F.min(column).alias("min"), F.max(column).alias("max"),
    )
    median = exact_quantiles(df, [column], [0.5], ["median"]).select("median")
    return moments.withColumn("median", median.scalar())


# The columns of a numeric summary, in order.
DESCRIBE = ["count", "mean", "std", "min", "q1", "median", "q3", "max"]


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per numeric column: count, mean, sample std, min, quartiles, max."""
    moments = [
        F.struct(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
                 F.max(c).cast("double").alias("max")).alias(f"_m{j}") for j, c in enumerate(columns)
    ]
    quartiles, row = quantiles_and(df, columns, [0.25, 0.5, 0.75], ["q1", "median", "q3"], moments)
    found = [(c, *row[f"_m{j}"]) for j, c in enumerate(columns)]
    shared = df.sparkSession.createDataFrame(found, "column string, count long, mean double, std double, min double, max double")
    return shared.join(quartiles.drop("n"), "column", "left").select("column", *DESCRIBE)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column with their share in percent; one pass over the data.

    An empty table has counts of 0 and no share.
    """
    columns = columns or df.columns
    counted = df.agg(
        *[F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("n_missing"),
                   (100.0 * F.try_divide(F.count_if(F.col(c).isNull()), F.count(F.lit(1)))).alias("pct_missing")).alias(f"_{j}")
          for j, c in enumerate(columns)]
    )
    return stack(counted, [], len(columns))


def columns_with_nulls(counts: DataFrame) -> DataFrame:
    """Of null counts, the columns that have any, most first."""
    return counts.where("n_missing > 0").orderBy(F.col("n_missing").desc(), "column")


def total_nulls(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("n_missing"), F.lit(0)).alias("n_missing"))


def infinite_and_nan_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    counted = df.agg(
        *[F.struct(F.lit(c).alias("column"), F.count_if(is_infinite(c)).alias("n_inf"),
                   F.count_if(F.isnan(F.col(c).cast("double"))).alias("n_nan")).alias(f"_{j}")
          for j, c in enumerate(columns)]
    )
    return stack(counted, [], len(columns))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of different present values per column.

    The values are made rows first, so that one shuffle on (column, value) serves all columns
    and repeated values are combined before it.
    """
    kinds = dict(df.dtypes)
    # -0.0 equals 0.0 but is written otherwise.
    plain = {c: F.col(c) + 0.0 if kinds[c] in ("double", "float") else F.col(c) for c in columns}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), plain[c].cast("string").alias("value")) for c in columns])
    values = df.select(F.explode(pairs).alias("_p")).select("_p.*").distinct()
    return values.groupBy("column").agg(F.count("value").alias("n_distinct"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair over rows where both are present.

    Many columns are multiplied as tiles of matrices, few as expressions of one aggregation.
    """
    if pair_count(columns) > PAIR_EXPRESSIONS:
        return tiled_correlations(df, columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                   F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r")).alias(f"_{j}")
          for j, (a, b) in enumerate(pairs)]
    )
    half = stack(row, [], len(pairs))
    mirror = half.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    return half.unionByName(mirror)


def crosstab(df: DataFrame, rows: str, columns: str, values: list) -> DataFrame:
    """Counts of `rows` x `columns`, zero for pairs that do not occur."""
    return df.groupBy(rows).pivot(columns, values).agg(F.count(F.lit(1))).na.fill(0, [str(v) for v in values])


def count_by(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def share_of_total(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Counts per value and their percentage of all rows."""
    counted = count_by(df.where(F.col(column).isNotNull()), [column])
    whole = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("pct", F.round(100.0 * F.col("n") / whole, digits))


def group_spread(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """Median, quartile distance and sample std of a column per group."""
    spread = df.groupBy(*by).agg(F.count(column).alias("n"), F.stddev_samp(column).alias("std"))
    quartiles = exact_quantiles(df, [column], [0.25, 0.5, 0.75], ["q1", "median", "q3"], by=by)
    return spread.join(quartiles.drop("n", "column"), by).withColumn("iqr", F.col("q3") - F.col("q1"))
