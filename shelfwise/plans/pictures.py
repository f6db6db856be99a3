"""Image files to keyed vectors, to the rows that a popularity model learns from."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.clean import first_per_key
from shelfwise.operators.imaging import encoded, grid_encoder
from shelfwise.plans.catalogue import training_rows
from shelfwise.schema import TRAINING_RATING
from shelfwise.session import materialize
from shelfwise.sources.images import decode_images, product_of_crop

# Names of first crops, before the ending.
FIRST_CROPS = "*_0"


def picture_vectors(pictures: DataFrame, encoder: Callable[[np.ndarray], np.ndarray] | None = None,
                    height: int = 320, width: int = 192, batch_size: int = 32) -> DataFrame:
    """(file_name, origin, product_id, crop_ordinal, status, embedding): a row for each decoded file.

    Key and crop number are read from the name. A file that could not be decoded
    keeps its row, without a vector, so one pass yields vectors and failures.
    """
    encode = encoder or grid_encoder()

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), batch_size):
                part = batch.iloc[start:start + batch_size]
                sound = (part["status"] == "ok").to_numpy()
                vectors = np.full(len(part), None, object)
                if sound.any():
                    for at, vector in zip(np.flatnonzero(sound), encoded(part[sound], encode, height, width)):
                        vectors[at] = vector
                yield part[["file_name", "origin", "status"]].assign(embedding=vectors)

    size = [F.coalesce(c, F.lit(0)).alias(c) for c in ("height", "width", "nChannels")]
    rows = pictures.select("file_name", "origin", "status", *size, "data").mapInPandas(
        embed, "file_name string, origin string, status string, embedding array<float>")
    return rows.withColumn("key", product_of_crop(F.col("file_name"))).select(
        "file_name", "origin", "key.product_id", "key.crop_ordinal", "status", "embedding")


class ProductPictures(NamedTuple):
    """`vectors`: (product_id, embedding) of first crops; `status`: how reading each file ended."""

    vectors: DataFrame
    status: DataFrame


def product_pictures(spark: SparkSession, folder: str, encoder: Callable[[np.ndarray], np.ndarray] | None = None,
                     height: int = 320, width: int = 192, stem: str = FIRST_CROPS) -> ProductPictures:
    """The vector of each product's first crop under `folder`, in one pass over its files.

    Only files named like first crops are opened. If folders repeat a name, the
    first readable file in the order of their paths counts.
    """
    rows = materialize(picture_vectors(decode_images(spark, folder, stem=stem), encoder, height, width), "pictures")
    first = first_per_key(rows.where("status = 'ok' and crop_ordinal = 0 and product_id is not null"),
                          ["product_id"], ["origin"])
    return ProductPictures(first.select("product_id", "embedding"),
                           rows.select("file_name", "origin", "product_id", "crop_ordinal", "status"))


def training_rows_from_pictures(products: DataFrame, folder: str,
                                encoder: Callable[[np.ndarray], np.ndarray] | None = None,
                                height: int = 320, width: int = 192,
                                default_rating: float = TRAINING_RATING) -> DataFrame:
    """Products with the vector of their first crop and their popularity, split by position.

    Products whose first crop is missing or unreadable are left out.
    """
    pictures = product_pictures(products.sparkSession, folder, encoder, height, width)
    return training_rows(products, pictures.vectors, default_rating)
