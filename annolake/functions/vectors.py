"""Vector arithmetic on array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where either vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def normalised(a: Column) -> Column:
    """Unit length; a vector of no length stays as it is."""
    size = norm(a)
    return F.when(size > 0, F.transform(a, lambda x: x / size)).otherwise(a)


def blended(new: Column, old: Column, share: float) -> Column:
    """share * new + (1 - share) * old, at unit length."""
    return normalised(F.zip_with(new, old, lambda x, y: x * share + y * (1 - share)))


def squared_distance(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def argmax(values: Column) -> Column:
    """Place of the first largest value, from 0."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
