"""Recommendations for whole batches of query images."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import coerce_numeric
from shelfwise.operators.models import TOP_FEATURES, predict_popularity, with_features
from shelfwise.operators.similarity import topk_similar
from shelfwise.schema import SERVING_RATING


def serving_catalogue(products: DataFrame, vectors: DataFrame, key: str = "product_id",
                      vector: str = "embedding", model: PipelineModel | None = None) -> DataFrame:
    """Products with a vector, serving rating, and predicted popularity if there is a model."""
    joined = products.withColumn("rating", coerce_numeric(F.col("rating"), SERVING_RATING)) \
        .join(vectors.select(key, vector), key)
    if model is not None:
        joined = predict_popularity(with_features(joined, vector), model) \
            .withColumnRenamed("predicted", "popularity").drop(TOP_FEATURES)
    return joined


def project_result(hits: DataFrame, catalogue: DataFrame, key: str = "product_id") -> DataFrame:
    """Hits with the name, rating and popularity of the product they point to."""
    shown = [c for c in ("name", "rating", "popularity", "product_url") if c in catalogue.columns]
    return hits.join(catalogue.select(F.col(key).alias("candidate_id"), *shown), "candidate_id") \
        .withColumnRenamed("candidate_id", key)


def recommend(queries: DataFrame, catalogue: DataFrame, k: int = 5, *,
              query_key: str = "query_id", key: str = "product_id", vector: str = "embedding",
              model: PipelineModel | None = None, **options) -> DataFrame:
    """Top-k similar products of every query, and its own predicted popularity.

    One row per (query, rank). All predictions are made in one pass per table,
    not per hit.
    """
    hits = topk_similar(queries, catalogue, k, query_key=query_key, candidate_key=key,
                        vector=vector, **options)
    found = project_result(hits, catalogue, key)
    if model is None:
        return found
    scores = predict_popularity(with_features(queries, vector), model).select(
        F.col(query_key).cast("bigint").alias("query_id"),
        F.col("predicted").alias("query_popularity"))
    return found.join(scores, "query_id")
