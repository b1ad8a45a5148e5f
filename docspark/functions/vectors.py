"""Vector expressions on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector is zero.

    Null when either has a component that is null, infinite or not a number: the search
    leaves such vectors out.
    """
    value = F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
    return F.when(finite(a) & finite(b), value)


def finite(a: Column) -> Column:
    """Whether all components are numbers; null for a null vector."""
    return F.forall(a, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))
