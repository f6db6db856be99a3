"""Vectors held in array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Inner product in double. Vectors of different width are an error."""
    total = F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y),
                        F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(a) == F.size(b), total).when(
        a.isNotNull() & b.isNotNull(),
        F.raise_error(F.lit("vectors differ in width")).cast("double"))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(doubles(a), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector is all zero."""
    length = norm(a) * norm(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), length))


def unit(a: Column) -> Column:
    """The vector scaled to length 1; an all-zero vector stays as it is."""
    length = norm(a)
    return F.when(length == 0, doubles(a)).otherwise(
        F.transform(doubles(a), lambda x: x / length))


def is_finite(vector: Column) -> Column:
    """True when no element is NULL, NaN or infinite."""
    return F.forall(doubles(vector), lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))


def flatten(tensor: Column) -> Column:
    return F.flatten(tensor)
