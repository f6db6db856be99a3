"""Popularity and scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the popularity metric.
PRIOR_REVIEWS = 15.0
RATING_WEIGHT = 5.0
EPSILON = 1e-5


def popularity(reviews: Column, rating: Column) -> Column:
    """s(15+n) / (n + 5s + 1e-5), in double; NULL where undefined."""
    n = reviews.cast("double")
    s = rating.cast("double")
    return F.try_divide(s * (F.lit(PRIOR_REVIEWS) + n),
                        n + F.lit(RATING_WEIGHT) * s + F.lit(EPSILON))


def minmax(value: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a constant column scales to 0."""
    return F.when(high == low, F.when(value.isNotNull(), F.lit(0.0))).otherwise(
        F.try_divide(value - low, high - low))
