"""End-to-end compositions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from shelfwise.operators.clean import clean_products
from shelfwise.operators.matching import join_products_images
from shelfwise.operators.models import (
    VALIDATION_SHARE,
    fit_popularity,
    positional_split,
    with_features,
)
from shelfwise.operators.score import rank_by_popularity, score_popularity
from shelfwise.operators.similarity import finite_vectors
from shelfwise.schema import TRAINING_RATING
from shelfwise.session import materialize


def product_table(raw: DataFrame) -> DataFrame:
    """Raw harvest to the clean product table, written once.

    Scoring reads it twice, for the range and for the rows; the harvest and
    its dedup shuffle should not run twice.
    """
    return materialize(clean_products(raw), "products")


def ranked_products(raw: DataFrame, default_rating: float = TRAINING_RATING) -> DataFrame:
    """Raw harvest to products with popularity, most popular first."""
    return rank_by_popularity(score_popularity(product_table(raw), default_rating))


def training_rows(products: DataFrame, vectors: DataFrame,
                  default_rating: float = TRAINING_RATING) -> DataFrame:
    """Products with a usable vector and their popularity, split by position.

    Written once, as fitting and scoring read them many times.
    """
    joined = join_products_images(products, vectors)
    scored = finite_vectors(score_popularity(joined, default_rating), score="popularity")
    kept = materialize(scored.select("product_id", "embedding", "popularity"), "training")
    return with_features(positional_split(kept, ["product_id"], 1 - VALIDATION_SHARE))


def train_popularity(rows: DataFrame, **options) -> PipelineModel:
    return fit_popularity(rows.where("is_train"), **options)
