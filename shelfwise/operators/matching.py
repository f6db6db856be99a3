"""Products and their images, matched by key.

Rows are never matched by position: the product key is carried in the crop
table or read from the crop's file name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.images import product_of_crop


def crops_by_product(files: DataFrame, name: str = "file_name") -> DataFrame:
    """First crop of each product, from crop files named by product and ordinal."""
    keyed = files.withColumn("__key", product_of_crop(F.col(name)))
    return (keyed.where(F.col("__key.crop_ordinal") == 0)
            .withColumn("product_id", F.col("__key.product_id")).drop("__key"))


def join_products_images(products: DataFrame, images: DataFrame,
                         key: str = "product_id") -> DataFrame:
    """Products with the image columns of their first crop."""
    return products.join(images, key)


def products_with_images(products: DataFrame, images: DataFrame,
                         key: str = "product_id") -> DataFrame:
    """Products that have a readable image."""
    return products.join(images.select(key), key, "left_semi")
