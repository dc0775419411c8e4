"""Sums of products over all windows of a series table, without building a window.

A window has `size` consecutive rows of an engine and the target of its last row. For two places t <= u
of the window, the sum of x_f(t) * x_g(u) over all windows is the sum of x_f(r) * x_g(r + u - t) over
all rows r of an engine, less the pairs near its ends that no window holds at these places: those whose
earlier row is one of the first t, and those whose later row is one of the last size - 1 - u. So
each task needs, for each lag, one matrix product of its rows with the rows that many places later, and
small ones for the rows near the ends. All values are taken relative to a pivot near their mean, which
keeps the sums small; sums of several tasks, or of several groups of engines, simply add up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.operators.joins import attach
from wearline.operators.ordering import lay_blocks, number_rows
from wearline.schema import CYCLE, ENTITY, RUL, WINDOW_SIZE, require_numeric
from wearline.session import stage


@dataclass(frozen=True)
class Moments:
    """Second moments of the inputs (time step, feature), then the target, then 1; relative to `pivot`."""

    features: list[str]
    size: int
    pivot: np.ndarray
    sums: np.ndarray

    @property
    def n(self) -> int:
        """Number of windows."""
        return round(float(self.sums[-1, -1]))

    def __add__(self, other: Moments) -> Moments:
        return replace(self, sums=self.sums + other.sums)

    def __sub__(self, other: Moments) -> Moments:
        return replace(self, sums=self.sums - other.sums)

    def means(self) -> np.ndarray:
        """Mean of every input and of the target."""
        return self.sums[:-1, -1] / self.n + self.pivot[:-1]

    def about(self, point: np.ndarray) -> np.ndarray:
        """Mean products of inputs and target, each taken relative to `point`."""
        shift = self.pivot[:-1] - point
        means = self.sums[:-1, -1] / self.n
        return self.sums[:-1, :-1] / self.n + np.outer(shift, means) + np.outer(means, shift) + np.outer(shift, shift)

    def scales(self) -> np.ndarray:
        """Population standard deviation of every input; 0 where it is constant."""
        own = np.diag(self.about(self.means()))[:-1]
        level = 1e-12 * (1 + np.abs(self.means()[:-1] - self.pivot[:-2]))
        return np.where(own > level**2, np.sqrt(np.maximum(own, 0)), 0.0)


class _Sums:
    """A task's sums by lag, and by lag and distance to the ends."""

    def __init__(self, size: int, width: int):
        self.size = size
        self.all = np.zeros((size, width, width))
        self.head = np.zeros((size, size, width, width))
        self.tail = np.zeros((size, size, width, width))

    def add(self, x, run, place, to_end, fresh) -> None:
        """Pairs whose later row is `fresh` (new here, and its block's own)."""
        n = len(x)
        for lag in range(min(self.size, n)):
            first, last = slice(0, n - lag), slice(lag, n)
            pair = fresh[last] & (run[first] == run[last]) & (place[last] - place[first] == lag)
            self.all[lag] += x[first].T @ np.where(pair[:, None], x[last], 0.0)
            for into, distance in ((self.head, place[first] - 1), (self.tail, to_end[last])):
                at = np.flatnonzero(pair & (distance < self.size - 1 - lag))
                for d in np.unique(distance[at]):
                    rows = at[distance[at] == d]
                    into[lag, d] += x[rows].T @ x[rows + lag]

    def places(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """For each t <= u the sum over windows of the outer product of both rows."""
        for lag in range(self.size):
            head, tail = np.cumsum(self.head[lag], axis=0), np.cumsum(self.tail[lag], axis=0)
            for t in range(self.size - lag):
                left = self.size - 2 - t - lag
                total = self.all[lag] - (head[t - 1] if t else 0.0) - (tail[left] if left >= 0 else 0.0)
                yield t, t + lag, total


def window_moments(
    df: DataFrame, features: list[str], label: str = RUL, size: int = WINDOW_SIZE, keys=ENTITY, position=CYCLE,
    by: str | None = None, dense: bool = False, block_rows: int | None = None, length: str | None = None,
) -> dict:
    """Moments of all windows for each value of `by`, a column that is constant within an engine (None: one entry, None).

    The input is read once. `length` names a column with the number of an engine's rows, as the pass that
    numbers them gives it; without one it is counted from the written rows. Engines shorter than a window have none. A missing or non-finite input or
    target in an engine that has windows is an error: fill before.
    """
    require_numeric(df.schema, [*features, label])
    values = F.array(*[F.col(c).cast("double") for c in [*features, label]])
    group = (F.col(by) if by else F.lit(None).cast("string")).alias("_by")
    if not dense:
        narrow = number_rows(df.select(*keys, position, group, values.alias("_x")), list(keys), [position], "_place", total="_length").drop(position)
    elif length:
        narrow = df.select(*keys, F.col(position).alias("_place"), F.col(length).alias("_length"), group, values.alias("_x"))
    else:
        narrow = df.select(*keys, F.col(position).alias("_place"), group, values.alias("_x"))
    rows = stage(narrow, "series")
    if dense and not length:
        rows = attach(rows, rows.groupBy(*keys).agg(F.max("_place").alias("_length")), list(keys))
    whole = rows.where(F.col("_length") >= size)
    width = len(features) + 2
    odd = F.exists("_x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    checked = whole.agg(F.count_if(odd).alias("odd"), *[F.avg(F.col("_x")[i]).alias(f"_{i}") for i in range(width - 1)]).first()
    if checked["odd"]:
        raise ValueError(f"{checked['odd']} rows have a missing or non-finite input or target")
    centre = np.array([*(checked[f"_{i}"] or 0.0 for i in range(width - 1)), 0.0])

    groups = [r[0] for r in rows.select("_by").distinct().collect()]
    number = {value: n for n, value in enumerate(groups)}
    numbers = F.coalesce(*[F.when(F.col("_by").eqNullSafe(F.lit(v)), n) for v, n in number.items()]) if groups else F.lit(0)
    laid = lay_blocks(whole, "_place", size - 1, block_rows)
    sorted_rows = (
        laid.repartition(*[F.col(k) for k in keys], "_block").sortWithinPartitions(*keys, "_block", "_place")
        .select(F.xxhash64(*keys, "_block").alias("run"), F.col("_place").alias("place"), (F.col("_length") - F.col("_place")).alias("to_end"),
                numbers.cast("int").alias("by"), F.col("_own").alias("own"), F.col("_x").alias("x"))
    )

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, _Sums] = {}
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(-1, width - 1)
            columns = [np.column_stack([x, np.ones(len(x))]) - centre]
            columns += [batch.column(c).to_numpy(zero_copy_only=False) for c in ("run", "place", "to_end", "by", "own")]
            held = 0
            if kept is not None:
                held = len(kept[0])
                columns = [np.concatenate(pair) for pair in zip(kept, columns)]
            x, run, place, to_end, number, own = columns
            fresh = own.astype(bool)
            fresh[:held] = False
            for value in np.unique(number[fresh]):
                if value not in sums:
                    sums[int(value)] = _Sums(size, width)
                sums[int(value)].add(x, run, place, to_end, fresh & (number == value))
            kept = [c[max(0, len(c) - size + 1) :] for c in columns] if size > 1 else None
        for value, own_sums in sums.items():
            for t, u, total in own_sums.places():
                yield pa.record_batch(
                    [pa.array([value] * width, pa.int32()), pa.array([t] * width, pa.int32()), pa.array([u] * width, pa.int32()),
                     pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                    names=["by", "t", "u", "f", "row"],
                )

    parts = sorted_rows.mapInArrow(sum_up, "by int, t int, u int, f int, row array<double>")
    added = parts.groupBy("by", "t", "u", "f").agg(F.array(*[F.sum(F.col("row")[g]) for g in range(width)]).alias("row"))
    found = {n: np.zeros((size, size, width, width)) for n in number.values()}
    for r in added.collect():  # at most (size * width) ** 2 / 2 numbers for each group
        found[r["by"]][r["t"], r["u"], r["f"]] = r["row"]
    pivot = np.concatenate([np.tile(centre[:-2], size), centre[-2:]])
    return {value: Moments(features, size, pivot, _whole(found[n])) for value, n in number.items()}


def _whole(places: np.ndarray) -> np.ndarray:
    """Symmetric matrix over (time step, feature), target, 1 from the sums by places."""
    size, width = places.shape[0], places.shape[2]
    k = width - 2
    sums = np.zeros((size * k + 2, size * k + 2))
    for t in range(size):
        for u in range(t, size):
            block = places[t, u, :k, :k]
            sums[t * k : (t + 1) * k, u * k : (u + 1) * k] = block
            sums[u * k : (u + 1) * k, t * k : (t + 1) * k] = block.T
        sums[t * k : (t + 1) * k, -2:] = places[t, size - 1, :k, k:]
        sums[-2:, t * k : (t + 1) * k] = places[t, size - 1, :k, k:].T
    sums[-2:, -2:] = places[size - 1, size - 1, k:, k:]
    return sums
