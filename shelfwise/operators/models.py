"""Learned embeddings and the popularity regression, on MLlib."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.vectors import doubles
from shelfwise.operators.ordinals import row_ordinal

# Share of rows that train, and the last share that validates.
TRAIN_SHARE = 0.85
VALIDATION_SHARE = 0.2
TOP_FEATURES = "features"


def with_features(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.withColumn(TOP_FEATURES, array_to_vector(doubles(F.col(vector))))


def positional_split(df: DataFrame, order, share: float = TRAIN_SHARE,
                     out: str = "is_train") -> DataFrame:
    """Mark the first int(share * n) rows in the order of unique key `order`.

    Only the keys are numbered, to find the first one past the cut; the rows
    themselves are compared with it where they are.
    """
    keys = row_ordinal(df.select(*order), order)
    cut = keys.agg(F.floor(F.lit(share) * F.count(F.lit(1)))).scalar()
    past = keys.where(F.col("ordinal") == cut).agg(F.min(F.struct(*order))).scalar()
    return df.withColumn(out, F.coalesce(F.struct(*order) < past, F.lit(True)))


def fit_embedding(df: DataFrame, width: int, vector: str = "embedding") -> PCAModel:
    """Learn a linear encoder by reconstruction.

    The best linear autoencoder spans the principal subspace. The driver holds
    one square matrix of the input width, so pool the pixels first.
    """
    return PCA(k=width, inputCol=TOP_FEATURES, outputCol="encoded").fit(with_features(df, vector))


def encode(df: DataFrame, model: PCAModel, vector: str = "embedding",
           out: str = "encoded") -> DataFrame:
    encoded = model.transform(with_features(df, vector))
    return encoded.withColumn("encoded", vector_to_array("encoded", "float32")) \
        .withColumnRenamed("encoded", out).drop(TOP_FEATURES)


def reconstruction_error(df: DataFrame, model: PCAModel, key: str,
                         vector: str = "embedding") -> DataFrame:
    """Mean squared error of encoding and decoding each row: (key, mse).

    The model's matrix and the mean vector are one row per input element.
    """
    spark = df.sparkSession
    mean = with_features(df, vector).agg(Summarizer.mean(F.col(TOP_FEATURES))).first()[0]
    shared = spark.sparkContext.broadcast((mean.toArray(), model.pc.toArray()))

    def errors(batches):
        center, basis = shared.value
        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"].to_numpy()).astype(np.float64) - center
                gap = x - (x @ basis) @ basis.T
                yield pd.DataFrame({"k": batch["k"], "mse": (gap * gap).mean(axis=1)})

    rows = df.select(F.col(key).cast("bigint").alias("k"), F.col(vector).alias("v"))
    return rows.mapInPandas(errors, "k bigint, mse double").withColumnRenamed("k", key)


def fit_popularity(df: DataFrame, label: str = "popularity", validation: str | None = None,
                   kind: str = "trees", **options) -> PipelineModel:
    """Regress popularity on the feature vector.

    `kind` is `trees` or `linear`. Naming a boolean `validation` column makes
    the trees stop once their error on those rows no longer falls.
    """
    if kind == "linear":
        estimator = LinearRegression(featuresCol=TOP_FEATURES, labelCol=label,
                                     predictionCol="predicted", **options)
    else:
        estimator = GBTRegressor(featuresCol=TOP_FEATURES, labelCol=label,
                                 predictionCol="predicted",
                                 **{"maxIter": 10, "maxDepth": 3, "seed": 42, **options})
        if validation:
            estimator = estimator.setValidationIndicatorCol(validation)
    return Pipeline(stages=[estimator]).fit(df)


def predict_popularity(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add `predicted` to every row in one pass."""
    return model.transform(df)


def kept_trees(model: PipelineModel) -> int:
    return model.stages[-1].getNumTrees
