"""Null-aware comparisons, safe division and infinity handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def same(left: Column, right: Column) -> Column:
    """Equality in which an unknown side is never equal, not even to another unknown."""
    return F.coalesce(left == right, F.lit(False))


def differs(left: Column, right: Column) -> Column:
    return ~same(left, right)


def is_infinite(value: Column) -> Column:
    return F.coalesce(F.abs(value) == F.lit(float("inf")), F.lit(False))


def is_missing(value: Column, dtype: T.DataType) -> Column:
    """Null, or NaN for floating point columns."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def is_finite(value: Column) -> Column:
    """One comparison, as NaN is above infinity here; unknown for null. Rows of many columns stay small enough to be compiled."""
    return F.abs(value) < F.lit(float("inf"))


def finite_or_null(value: Column) -> Column:
    return F.when(is_finite(value), value)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Division in which a zero denominator counts as one."""
    return numerator / F.when(denominator == 0, 1).otherwise(denominator)


def rate(numerator: Column, denominator: Column) -> Column:
    """Share as double; 0.0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def band(value: Column, edges: list[tuple[float, object]], otherwise: object) -> Column:
    """First label whose lower edge the value reaches; edges are listed highest first."""
    chain = None
    for edge, label in edges:
        reached = value >= F.lit(edge)
        chain = F.when(reached, F.lit(label)) if chain is None else chain.when(reached, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def grid_position(value: Column, grid: list[float]) -> Column:
    """How many entries of the ascending ``grid`` the value reaches, by binary search.

    Compares with the grid entries themselves, so a value equal to an entry is on the right
    side of it without any floating point scaling.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(grid[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(grid))
