"""Vector expressions on array columns, evaluated in the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastemill.functions.scalar import col


def as_double(v: Column | str) -> Column:
    return col(v).cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; 0 when either vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), size))


def squared_distance(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def weighted_sum(values: Column, weights: Column) -> Column:
    return dot(values, weights)


def sinusoid(position: Column, dims: int) -> Column:
    """Position encoding: sin on even, cos on odd places, angle p / 10000^(2i/dims)."""
    cells = []
    for i in range(dims):
        rate = math.exp(-math.log(10000.0) * 2 * i / dims)
        angle = position.cast("double") * F.lit(rate)
        cells.append(F.sin(angle) if i % 2 == 0 else F.cos(angle))
    return F.array(*cells)
