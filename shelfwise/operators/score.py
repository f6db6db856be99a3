"""Popularity scores and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scores import minmax, popularity
from shelfwise.functions.text import coerce_count, coerce_numeric, finite_or_null
from shelfwise.schema import DEFAULT_REVIEWS
from shelfwise.sources.products import add_default_column


def coerce_scores(df: DataFrame, default_rating: float,
                  default_reviews: int = DEFAULT_REVIEWS) -> DataFrame:
    """Rating and review count as numbers.

    The rating default is a required argument: training and serving differ.
    """
    full = add_default_column(df, "no_of_reviews", default_reviews)
    return full.withColumns({
        "rating": coerce_numeric(F.col("rating"), default_rating),
        "no_of_reviews": coerce_count(F.col("no_of_reviews"), default_reviews),
    })


def minmax_stats(df: DataFrame, value: str) -> DataFrame:
    """One row: lowest and highest value."""
    return df.agg(F.min(value).alias("low"), F.max(value).alias("high"))


def scale_minmax(df: DataFrame, value: str, out: str | None = None,
                 fit_on: DataFrame | None = None) -> DataFrame:
    """Scale a column to [0, 1] by the range it has in `fit_on`, or in itself.

    The range is a scalar subquery, so the rows themselves never move.
    """
    stats = minmax_stats(df if fit_on is None else fit_on, value)
    bounds = stats.select(F.struct("low", "high").alias("bounds")).scalar()
    return (df.withColumn("__b", bounds)
            .withColumn(out or value, minmax(F.col(value), F.col("__b.low"), F.col("__b.high")))
            .drop("__b"))


def score_popularity(df: DataFrame, default_rating: float,
                     default_reviews: int = DEFAULT_REVIEWS,
                     scale: bool = True) -> DataFrame:
    """Numeric rating and reviews plus the popularity they imply.

    Values that are not finite become NULL before scaling.
    """
    scored = coerce_scores(df, default_rating, default_reviews).withColumn(
        "popularity", finite_or_null(popularity(F.col("no_of_reviews"), F.col("rating"))))
    return scale_minmax(scored, "popularity") if scale else scored


def rank_by_popularity(df: DataFrame, key: str = "product_id", limit: int | None = None) -> DataFrame:
    """Most popular first, ties by key."""
    ranked = df.orderBy(F.desc_nulls_last("popularity"), key)
    return ranked if limit is None else ranked.limit(limit)
