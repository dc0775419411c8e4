"""Exact quantiles with linear interpolation."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from wearline.operators.joins import attach
from wearline.operators.ordering import running_total, split_by_size
from wearline.session import stage, stage_counted

# Groups with up to this many values are ordered by one window task each.
BOUNDED_VALUES = 1_000_000
SKETCH_ACCURACY = 10_000
# Groups with more values than this are sketched first; a sketch of a group holds some thousand values.
SKETCH_FROM = 200_000
GROUP_ACCURACY = 2_000


def _present(column: str):
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _long(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _present(c).alias("value")) for c in columns])
    return (
        df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in by)) if by else F.lit(True))
        .select(*by, F.explode(pairs).alias("_pair"))
        .select(*by, "_pair.column", "_pair.value")
        .where(F.col("value").isNotNull())
    )


def _collapse(df: DataFrame, columns: list[str], probs: list[float], more: list[Column] | None = None, rows: list[Row] | None = None) -> DataFrame:
    """Keep only the values near the wanted ranks apart; count the others together.

    `more` are aggregates to take in the sketch pass; its row goes to `rows`.

    A sketch pass brackets every rank. Values outside the brackets become one counted row per
    gap (`gap` = 1), so the later shuffle carries a small share of the distinct values.
    """
    reach = 2.0 / SKETCH_ACCURACY
    asked = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-reach, reach)})
    sketch = df.agg(*[F.percentile_approx(_present(c), asked, SKETCH_ACCURACY).alias(c) for c in columns], *(more or [])).first()
    if rows is not None:
        rows.append(sketch)
    brackets = []
    for c in columns:
        at = dict(zip(asked, sketch[c] or []))
        if at:
            brackets.append((c, *[at[edge] for p in probs for edge in (max(0.0, p - reach), min(1.0, p + reach))]))
    edges = [(f"_low{i}", f"_high{i}") for i in range(len(probs))]
    schema = ", ".join(["column string", *[f"{low} double, {high} double" for low, high in edges]])
    table = df.sparkSession.createDataFrame(brackets, schema)
    value, inside, floor = F.col("value"), F.lit(False), [F.lit(float("-inf"))]
    for low, high in edges:
        inside = inside | value.between(F.col(low), F.col(high))
        floor.append(F.when(value > F.col(high), F.col(high)))
    joined = _long(df, columns, []).join(F.broadcast(table), "column")
    return joined.select(
        "column", F.when(inside, value).otherwise(F.greatest(*floor)).alias("value"), F.when(inside, 0).otherwise(1).alias("gap")
    )


def _collapse_groups(df: DataFrame, columns: list[str], by: list[str], probs: list[float]) -> DataFrame:
    """As `_collapse` within groups: partial sketches are merged per group, and the brackets stay a table."""
    reach = 2.0 / GROUP_ACCURACY
    lows, highs = [max(0.0, p - reach) for p in probs], [min(1.0, p + reach) for p in probs]
    sketch = df.groupBy(*by).agg(*[F.percentile_approx(_present(c), lows + highs, GROUP_ACCURACY).alias(f"_s{i}") for i, c in enumerate(columns)])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_s{i}").alias("_edges")) for i, c in enumerate(columns)])
    brackets = sketch.select(*by, F.explode(each).alias("_e")).select(*by, "_e.*")
    value, inside, floor = F.col("value"), F.lit(False), [F.lit(float("-inf"))]
    for i in range(len(probs)):
        low, high = F.col("_edges")[i], F.col("_edges")[len(probs) + i]
        inside = inside | value.between(low, high)
        floor.append(F.when(value > high, high))
    joined = attach(_long(df, columns, by), brackets, [*by, "column"])
    return joined.select(
        *by, "column", F.when(inside, value).otherwise(F.greatest(*floor)).alias("value"), F.when(inside, 0).otherwise(1).alias("gap")
    )


def _counted(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Rows per distinct value."""
    counted = _long(df, columns, by).groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("gap", F.lit(0))


def _quantiles_of_large_groups(df: DataFrame, columns: list[str], probs: list[float], names: list[str], by: list[str], limit: float) -> DataFrame:
    """Groups worth a sketch: exact counts inside the brackets; a group whose bracket misses is counted whole."""
    near = _collapse_groups(df, columns, by, probs).groupBy(*by, "column", "value", "gap").agg(F.count(F.lit(1)).alias("n"))
    near, rows = stage_counted(near, "near")
    observation = Observation()
    picked = _pick(near, by, names, probs, math.inf if rows <= limit else limit)
    picked = stage(picked.observe(observation, F.count_if(F.col("_missed") > 0).alias("missed")), "picked")
    if not observation.get["missed"]:
        return picked.drop("_missed")
    hit, missed = picked.where("_missed = 0"), picked.where("_missed > 0").select(*by).distinct()
    again = _pick(stage(_counted(df.join(missed, by, "left_semi"), columns, by), "counted"), by, names, probs, limit)
    return attach(hit, missed, by, "left_anti").drop("_missed").unionByName(again.drop("_missed"))


def _pick(counted: DataFrame, by: list[str], names: list[str], probs: list[float], bounded_rows: float) -> DataFrame:
    """Values at the wanted ranks of (by, column), from counts per distinct value."""
    ranked = running_total(
        counted, [*by, "column"], ["value", "gap"], "n", "_upto", total="_n", bounded_rows=bounded_rows
    )
    last = F.col("_upto") - 1
    first = F.col("_upto") - F.col("n")
    # Few rows hold a wanted rank; dropping the others first keeps the wide aggregation short.
    near = F.lit(False)
    for p in probs:
        rank = (F.col("_n") - 1) * F.lit(float(p))
        near = near | ((F.floor(rank) <= last) & (F.ceil(rank) >= first))
    aggregates = [F.max("_n").alias("n")]
    for i, p in enumerate(probs):
        rank = (F.col("_n") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            hit = at.between(first, last)
            aggregates.append(F.max(F.when(hit, F.col("value"))).alias(f"_{side}{i}"))
            aggregates.append(F.max(F.when(hit, F.col("gap"))).alias(f"_{side}gap{i}"))
    found = ranked.where(near).groupBy(*by, "column").agg(*aggregates)
    result, missed = [], F.lit(0)
    for i, (name, p) in enumerate(zip(names, probs)):
        rank = (F.col("n") - 1) * F.lit(float(p))
        share = rank - F.floor(rank)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        result.append((lo + (hi - lo) * share).alias(name))
        missed = missed + F.col(f"_logap{i}") + F.col(f"_higap{i}")
    return found.select(*by, "column", F.col("n").cast("long").alias("n"), *result, missed.alias("_missed"))


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    names: list[str],
    by: list[str] | None = None,
    bounded_values: int | None = None,
) -> DataFrame:
    """One row per group and column: `n` present values and the quantiles as `names`.

    Values are counted per distinct value, ordered with running totals, and read off at their
    ranks. Whole columns and groups of more than SKETCH_FROM rows first drop to the values near the
    ranks, which a mergeable sketch brackets; the others are counted per gap. Smaller groups are ordered by a
    window each. (The built-in `percentile` gives the same numbers from one buffer per group.)
    """
    by = list(by or [])
    limit = BOUNDED_VALUES if bounded_values is None else bounded_values
    if by:
        sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n"), F.max("n")).first()
        if (sizes[1] or 0) <= SKETCH_FROM:
            usual, large = df, None
        elif sizes[0] > SKETCH_FROM:
            usual, large = None, df
        else:
            usual, large = split_by_size(df, by, SKETCH_FROM)
        found = []
        if usual is not None:
            found.append(_pick(_counted(usual, columns, by), by, names, probs, math.inf).drop("_missed"))
        if large is not None:
            found.append(_quantiles_of_large_groups(large, columns, probs, names, by, limit))
        return reduce(DataFrame.unionByName, found)
    return quantiles_and(df, columns, probs, names, [], limit)[0]


def quantiles_and(
    df: DataFrame, columns: list[str], probs: list[float], names: list[str], more: list[Column], bounded_values: int | None = None
) -> tuple[DataFrame, Row | None]:
    """Exact quantiles of whole columns, and the row of the aggregates `more`, which share a pass with the sketches."""
    limit = BOUNDED_VALUES if bounded_values is None else bounded_values
    found: list[Row] = []
    near = _collapse(df, columns, probs, more, found) if more else _collapse(df, columns, probs)
    row = found[0] if found else None
    near, kept = stage_counted(near.groupBy("column", "value", "gap").agg(F.count(F.lit(1)).alias("n")), "near")
    picked = _pick(near, [], names, probs, math.inf if kept <= limit else limit)
    rows = picked.collect()
    if all(r["_missed"] == 0 for r in rows):
        return df.sparkSession.createDataFrame(rows, picked.schema).drop("_missed"), row
    return _pick(stage(_counted(df, columns, [])), [], names, probs, limit).drop("_missed"), row


def quantile_row(df: DataFrame, columns: list[str], probs: list[float], bounded_values: int | None = None) -> dict:
    """Quantiles of whole columns on the driver: one short list per column."""
    names = [f"q{i}" for i in range(len(probs))]
    found = {r["column"]: [r[n] for n in names]
             for r in exact_quantiles(df, columns, probs, names, bounded_values=bounded_values).collect()}
    return {c: found.get(c, [None] * len(probs)) for c in columns}
