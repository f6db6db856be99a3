"""Trend groups: clusters of embeddings, largest popular, smallest lagging."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.vectors import doubles
from shelfwise.operators.similarity import topk


def fit_clusters(df: DataFrame, k: int, seed: int = 42, vector: str = "embedding",
                 max_iter: int = 20) -> KMeansModel:
    points = df.select(array_to_vector(doubles(F.col(vector))).alias("features"))
    return KMeans(k=k, seed=seed, maxIter=max_iter).fit(points)


def cluster_products(df: DataFrame, model: KMeansModel, vector: str = "embedding") -> DataFrame:
    """Add the cluster of every row."""
    points = df.withColumn("features", array_to_vector(doubles(F.col(vector))))
    return model.transform(points).withColumnRenamed("prediction", "cluster").drop("features")


def trend_labels(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Size and trend of each cluster; clusters of equal size share the label."""
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    ends = sizes.agg(F.struct(F.max("n").alias("top"), F.min("n").alias("low"))).scalar()
    return sizes.withColumn("__e", ends).select(
        cluster, "n",
        F.when(F.col("n") == F.col("__e.top"), "popular")
        .when(F.col("n") == F.col("__e.low"), "lagging")
        .otherwise("steady").alias("trend"))


def centroids(df: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per group, combined within each task before the shuffle."""
    points = df.select(group, array_to_vector(doubles(F.col(vector))).alias("__v"))
    return points.groupBy(group).agg(
        vector_to_array(Summarizer.mean(F.col("__v"))).alias(vector))


def assign_nearest(df: DataFrame, centers: DataFrame, key: str, center_key: str,
                   vector: str = "embedding", **options) -> DataFrame:
    """Nearest centre of every row: (key, center, squared distance)."""
    nearest = topk(df, centers, 1, "euclidean", query_key=key, candidate_key=center_key,
                   vector=vector, **options)
    return nearest.select(F.col("query_id").alias(key), F.col("candidate_id").alias(center_key),
                          (-F.col("score")).alias("distance"))
