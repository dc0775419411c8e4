"""Vectors and matrices held in array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four elementwise operations by name.
OPERATIONS = {
    "add": lambda x, y: x + y,
    "sub": lambda x, y: x - y,
    "mul": lambda x, y: x * y,
    "div": lambda x, y: F.try_divide(x, y),
}


def elementwise(a: str | Column, b: str | Column, operation: str) -> Column:
    return F.zip_with(a, b, OPERATIONS[operation])


def positions_where(array: str | Column, predicate) -> Column:
    """0-based positions at which `predicate` holds."""
    tagged = F.transform(array, lambda x, i: F.when(predicate(x), i))
    return F.filter(tagged, lambda i: i.isNotNull())


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(elementwise(a, b, "mul"), F.lit(0.0), lambda total, x: total + x)


def reshape(array: str | Column, rows: int, columns: int) -> Column:
    """Cut a flat array into `rows` arrays of `columns` elements."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(array, i * columns + 1, F.lit(columns))
    )


def cell(matrix: Column, row: int, column: int) -> Column:
    return matrix[row][column]
