"""Scalar column functions; a missing value stays missing unless a function says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(column: str | Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a value on one or both sides; a missing value stays missing."""
    value = F.col(column) if isinstance(column, str) else column
    out = value
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(value.isNotNull(), out)


def log1p_clipped(column: str | Column) -> Column:
    return F.log1p(clip(column, lower=0.0))


def map_values(column: str, mapping: dict, otherwise: Column | None = None) -> Column:
    """Look a value up in a small dictionary; values outside it become missing."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), F.col(column))
    return found if otherwise is None else F.coalesce(found, otherwise)


def replace_value(column: str, old, new) -> Column:
    return F.when(F.col(column) == F.lit(old), F.lit(new)).otherwise(F.col(column))


def is_infinite(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.abs(value.cast("double")) == F.lit(float("inf"))


def infinite_to_missing(column: str) -> Column:
    return F.when(~is_infinite(column), F.col(column))


def nan_to_missing(column: str) -> Column:
    return F.when(~F.isnan(column), F.col(column))


def guarded_ratio(numerator: str, denominator: str, substitute: float = 0.5, digits: int = 2) -> Column:
    """Ratio rounded half-even, with `substitute` for a divisor that is not positive."""
    divisor = F.when(F.col(denominator) > 0, F.col(denominator)).otherwise(F.lit(substitute))
    return F.bround(F.col(numerator) / divisor, digits)


def cut(column: str | Column, edges: Sequence[float], labels: Sequence, include_lowest: bool = False) -> Column:
    """Right-closed bins: (edge, next edge] gets its label, anything else is missing."""
    if len(edges) != len(labels) + 1 or any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError("bin edges must rise and be one more than the labels")
    value = F.col(column) if isinstance(column, str) else column
    known = value.isNotNull() & ~F.isnan(value.cast("double"))
    out = None
    for i, label in enumerate(labels):
        low = value >= edges[i] if include_lowest and i == 0 else value > edges[i]
        inside = known & low & (value <= edges[i + 1])
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def modular_hash(key: str | Column, seed: int = 42) -> Column:
    """Deterministic spread of integer keys below 2**31 - 1, the same in any engine."""
    value = F.col(key) if isinstance(key, str) else key
    return (value.cast("long") * F.lit(48271) + F.lit(seed)) % F.lit(2147483647)
