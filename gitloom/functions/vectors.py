"""Dense-vector and set-distance expressions; sums run in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """0.0 when either vector has no length; null when either is missing."""
    scale = norm(a) * norm(b)
    return F.when(a.isNull() | b.isNull(), None).when(scale == 0, 0.0).otherwise(dot(a, b) / scale)


def squared_distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def set_cosine_distance(shared: Column, size_a: Column, size_b: Column) -> Column:
    """Cosine distance of two 0/1 vectors; null (not NaN) when one set is empty."""
    scale = F.sqrt(size_a.cast("double") * size_b.cast("double"))
    return F.when(scale > 0, 1 - shared / scale)


def set_euclidean_distance(shared: Column, size_a: Column, size_b: Column) -> Column:
    return F.sqrt((size_a + size_b - 2 * shared).cast("double"))
