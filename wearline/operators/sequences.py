"""Fixed-length windows of consecutive rows, each stored in one row with its keys."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wearline.operators.joins import attach
from wearline.operators.ordering import lay_blocks, number_rows, over_series, running_total, series_window
from wearline.schema import CYCLE, ENTITY, WINDOW_SIZE, require_numeric
from wearline.session import stage

# Windows whose values are summed at once.
TOTAL_ROWS = 1_000


def rolling_sequences(
    df: DataFrame,
    features: list[str],
    size: int = WINDOW_SIZE,
    keys=ENTITY,
    position=CYCLE,
    carry: list[str] | None = None,
    block_rows: int | None = None,
    dense: bool = False,
) -> DataFrame:
    """For each row with size-1 predecessors, the size x features block that ends there as `seq`.

    Engines shorter than `size` give no row. `dense` says that `position` counts an engine's rows
    from 1; otherwise they are numbered in its order.
    """
    require_numeric(df.schema, features)
    if not dense:
        numbered = number_rows(df.select(*dict.fromkeys([*keys, position, *features, *(carry or [])])), list(keys), [position], "_place")
        carried = [c for c in [position, *(carry or [])]]
        return rolling_sequences(numbered, features, size, keys, "_place", carried, block_rows, True).drop("_place")
    kept = [*keys, position, *(carry or [])]
    step = F.array(*[F.col(c).cast("double") for c in features])
    narrow = df.select(*kept, step.alias("_step"))
    w = series_window(keys, position).rowsBetween(1 - size, 0)
    # Windows hold `size` times the bytes that are shuffled, so those bytes must not merge the partitions.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = lay_blocks(narrow, position, size - 1, block_rows).repartition(parts, *keys, "_block")
    seqs = laid.select(*kept, "_own", F.collect_list("_step").over(w).alias("seq"))
    return seqs.where(F.col("_own") & (F.col(position) >= size)).drop("_own")


def window_totals(seqs: DataFrame, names: list[str]) -> DataFrame:
    """The other columns, and for each feature of `seq` its sum over the window; missing where a value of it is missing.

    All windows have the same number of steps.
    """
    others = [f for f in seqs.schema.fields if f.name != "seq"]
    schema = StructType([*others, *(StructField(n, DoubleType()) for n in names)])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOTAL_ROWS):
                part = batch.slice(at, TOTAL_ROWS)
                values = part.column("seq").flatten().flatten()
                shape = (part.num_rows, -1, len(names))
                missing = values.is_null().to_numpy(zero_copy_only=False).reshape(shape).any(1)
                sums = values.to_numpy(zero_copy_only=False).reshape(shape).sum(1) + 0.0  # no negative zero
                columns = [pa.array(sums[:, i], mask=missing[:, i]) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in others), *columns], [*(f.name for f in others), *names])

    return seqs.mapInArrow(total, schema)


def with_sequence_index(
    seqs: DataFrame, df: DataFrame, size: int = WINDOW_SIZE, keys=ENTITY, position=CYCLE, dense: bool = False
) -> DataFrame:
    """Number all windows from 0 in (engine, cycle) order: windows of earlier engines plus own place."""
    counts = df.groupBy(*keys).agg((F.count(F.lit(1)) - (size - 1)).alias("_windows")).where("_windows > 0")
    if not dense:
        seqs = number_rows(seqs, list(keys), [position], "_place")
    offsets = running_total(counts, [], list(keys), "_windows", "_upto")
    placed = attach(seqs, offsets.select(*keys, (F.col("_upto") - F.col("_windows")).alias("_before")), keys)
    place = F.col(position) - size if dense else F.col("_place") - 1
    return placed.withColumn("sequence_idx", F.col("_before") + place).drop("_before", "_place")


def forecast_windows(
    df: DataFrame, column: str, length: int, keys=ENTITY, position=CYCLE, block_rows: int | None = None, dense: bool = False
) -> DataFrame:
    """The previous `length` values as `x` and the current one as `y`, where all exist."""
    if not dense:
        numbered = number_rows(df.select(*keys, position, column), list(keys), [position], "_place")
        made = forecast_windows(numbered.withColumnRenamed(position, "_was"), column, length, keys, "_place", block_rows, True)
        was = numbered.select(*keys, "_place", position)
        return attach(made, was, [*keys, "_place"]).select(*keys, position, "y", "x")
    w = series_window(keys, position).rowsBetween(-length, -1)
    laid = lay_blocks(df.select(*keys, position, column), position, length, block_rows)
    made = laid.select(*keys, position, "_own", F.collect_list(F.struct(column)).over(w).alias("_x"), F.col(column).alias("y"))
    kept = made.where(F.col("_own") & (F.col(position) > length)).drop("_own")
    return kept.withColumn("x", F.col(f"_x.{column}")).drop("_x")


def order_report(df: DataFrame, keys=ENTITY, position=CYCLE, value=CYCLE, block_rows: int | None = None) -> DataFrame:
    """How often `value` falls from one row of an engine to the next, over all rows."""
    falls = over_series(
        df.select(*dict.fromkeys([*keys, position, value])),
        {"_falls": lambda w: F.coalesce((F.col(value) < F.lag(value).over(w)).cast("long"), F.lit(0))},
        1, keys, position, block_rows,
    )
    return falls.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("_falls"), F.lit(0)).alias("order_violations"))


def length_report(seqs: DataFrame) -> DataFrame:
    """Number of windows with their shortest and longest length."""
    size = F.size("seq").cast("long")
    return seqs.agg(F.count(F.lit(1)).alias("n_windows"), F.min(size).alias("min_length"), F.max(size).alias("max_length"))


def check_sequences(seqs: DataFrame, size: int, features: int) -> DataFrame:
    """Raise when any window has another shape; one aggregation, no rows travel."""
    wrong = seqs.where((F.size("seq") != size) | F.exists("seq", lambda s: F.size(s) != features)).count()
    if wrong:
        raise ValueError(f"{wrong} windows do not have shape {size} x {features}")
    return seqs


def of_shape(seqs: DataFrame, size: int, features: int) -> DataFrame:
    """The same windows; one of another shape raises when it is read, without a pass of its own."""
    fine = (F.size("seq") == size) & F.forall("seq", lambda s: F.size(s) == features)
    message = F.lit(f"a window does not have shape {size} x {features}")
    return seqs.withColumn("seq", F.when(fine, F.col("seq")).otherwise(F.raise_error(message).cast(seqs.schema["seq"].dataType)))


def explode_steps(seqs: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """One row per window and time step t, with the features as columns."""
    steps = seqs.select(*keep, F.posexplode("seq").alias("t", "_step"))
    return steps.select(*keep, F.col("t").cast("long").alias("t"), *[F.col("_step")[i].alias(f) for i, f in enumerate(features)])


def position_stats(seqs: DataFrame, features: list[str]) -> DataFrame:
    """Mean and population std of each (time step, feature) place over all windows."""
    steps = explode_steps(seqs, features, [])
    stats = steps.groupBy("t").agg(
        *[F.struct(F.lit(i).alias("f"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(f"_{i}")
          for i, c in enumerate(features)]
    )
    stacked = stats.select("t", F.explode(F.array(*[F.col(f"_{i}") for i in range(len(features))])).alias("_s"))
    return stacked.select("t", "_s.*")


def position_stats_of_rows(
    df: DataFrame, features: list[str], size: int = WINDOW_SIZE, keys=ENTITY, position=CYCLE, dense: bool = False, length: str | None = None
) -> DataFrame:
    """The same numbers as `position_stats` of all windows, from the rows themselves.

    Place t of the windows holds every row of an engine but its first t and its last size - 1 - t.
    One aggregation takes count, mean and squared distance from the mean of the rows by their distance to either
    end, as far as that is below `size`; the groups of a place are then merged, which loses no digits
    to large values. `length` names a column with the number of an engine's rows, as `number_rows` gives
    it; without one the rows are numbered or, if `dense`, written once and counted.
    """
    values = [F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(features)]
    if dense and length:
        placed = df.select(F.col(position).alias("_place"), F.col(length).alias("_length"), *values)
    elif dense:
        rows = stage(df.select(*keys, F.col(position).alias("_place"), *values), "series")
        placed = attach(rows, rows.groupBy(*keys).agg(F.max("_place").alias("_length")), list(keys))
    else:
        placed = number_rows(df.select(*keys, position, *values), list(keys), [position], "_place", total="_length")
    to_end = F.col("_length") - F.col("_place")
    moments = [F.struct(F.count(f"_v{i}").alias("n"), F.avg(f"_v{i}").alias("mean"), (F.var_pop(f"_v{i}") * F.count(f"_v{i}")).alias("m2")).alias(f"_{i}") for i in range(len(features))]
    ends = placed.where(F.col("_length") >= size).groupBy(
        F.when(F.col("_place") < size, F.col("_place")).alias("head"), F.when(to_end < size - 1, to_end).alias("tail")
    )
    rows = ends.agg(*moments).collect()  # at most size x size groups
    found = []
    for t in range(size):
        inside = [r for r in rows if (r["head"] is None or r["head"] > t) and (r["tail"] is None or r["tail"] >= size - 1 - t)]
        for i in range(len(features)):
            n, mean, m2 = merge_moments([tuple(r[f"_{i}"]) for r in inside])
            found.append((t, i, mean if n else None, math.sqrt(m2 / n) if n else None))
    return df.sparkSession.createDataFrame(found, "t long, f int, mean double, std double")


def merge_moments(parts: list[tuple[int, float | None, float | None]]) -> tuple[int, float, float]:
    """Count, mean and sum of squared distances from the mean of all parts together, without sums of squares."""
    n, mean, m2 = 0, 0.0, 0.0
    for size, own, squares in parts:
        if size:
            apart = own - mean
            m2 += squares + apart * apart * n * size / (n + size)
            mean += apart * size / (n + size)
            n += size
    return n, mean, m2


def engine_means_of_rows(df: DataFrame, features: list[str], size: int = WINDOW_SIZE, keys=ENTITY, position=CYCLE, dense: bool = False) -> DataFrame:
    """The same means as `engine_mean_vectors`: rows that end a window are those from position `size` on."""
    placed, place = (df, position) if dense else (number_rows(df, list(keys), [position], "_place"), "_place")
    return placed.where(F.col(place) >= size).groupBy(*keys).agg(*[F.avg(F.col(f).cast("double")).alias(f"{f}_mean") for f in features])


def flatten_windows(seqs: DataFrame, size: int, features: int, keep: list[str]) -> DataFrame:
    """Wide form, one column t{t}_f{f} per place."""
    return seqs.select(
        *keep, *[F.col("seq")[t][f].alias(f"t{t}_f{f}") for t in range(size) for f in range(features)]
    )


def scale_flat_windows(seqs: DataFrame, stats: DataFrame, size: int, features: int, keep: list[str]) -> DataFrame:
    """Standard-scale each place with the fitted `stats` (one row per place)."""
    at = {(r["t"], r["f"]): (r["mean"], r["std"] or 1.0) for r in stats.collect()}
    steps = [
        F.array(*[(F.col("seq")[t][f] - at[t, f][0]) / at[t, f][1] for f in range(features)]) for t in range(size)
    ]
    return seqs.select(*keep, F.array(*steps).alias("seq"))


def engine_mean_vectors(seqs: DataFrame, features: list[str], keys=ENTITY) -> DataFrame:
    """Mean of each feature over the last time step of an engine's windows."""
    last = seqs.select(*keys, F.element_at("seq", -1).alias("_last"))
    return last.groupBy(*keys).agg(*[F.avg(F.col("_last")[i]).alias(f"{f}_mean") for i, f in enumerate(features)])


def missing_in_windows(seqs: DataFrame) -> DataFrame:
    """Missing values (NULL or NaN) inside all windows."""
    inside = F.aggregate(
        F.flatten("seq"), F.lit(0).cast("long"), lambda n, x: n + F.when(x.isNull() | F.isnan(x), 1).otherwise(0)
    )
    return seqs.agg(F.coalesce(F.sum(inside), F.lit(0)).alias("n_missing"))
