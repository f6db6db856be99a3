"""Product table cleaning, filters and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.text import clean_price, clean_rating
from shelfwise.schema import MISSING

PRODUCT_KEYS = ("name", "source")


def filter_named(df: DataFrame, name: str = "name") -> DataFrame:
    return df.where(F.col(name) != MISSING)


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The first row of every key in the stated order.

    The rank filter lets Spark drop all but one row per key inside each map
    task, so a key that holds a large share of the rows is not gathered.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def dedup_products(df: DataFrame, keys=PRODUCT_KEYS, order=("product_id",)) -> DataFrame:
    return first_per_key(df, keys, order)


def clean_products(df: DataFrame, keys=PRODUCT_KEYS, order=("product_id",)) -> DataFrame:
    """Keep-first dedup, plain prices, numeric rating text, named rows only."""
    cleaned = {"price": clean_price(F.col("price")), "rating": clean_rating(F.col("rating"))}
    return filter_named(dedup_products(df, keys, order)).withColumns(cleaned)


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all sources under one schema; absent fields are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag_bad_records(df: DataFrame, checks: dict[str, Column],
                    reason: str = "reject_reason") -> DataFrame:
    """Name the first check a record fails; NULL for a good record.

    A check that cannot be evaluated to true counts as failed.
    """
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    return df.withColumn(reason, F.coalesce(*failed, F.lit(None).cast("string")))


def split_bad_records(df: DataFrame, checks: dict[str, Column],
                      reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(good records, rejected records with their reason)."""
    tagged = tag_bad_records(df, checks, reason)
    return (tagged.where(F.col(reason).isNull()).drop(reason),
            tagged.where(F.col(reason).isNotNull()))


def image_manifest(df: DataFrame, url: str = "image_url", key: str = "product_id") -> DataFrame:
    """Download plan: what to fetch, and under which file name."""
    fetch = F.coalesce(F.col(url).startswith("http"), F.lit(False))
    return df.select(
        key, url,
        F.when(fetch, "fetch").otherwise("skip").alias("action"),
        F.when(fetch, F.concat(F.col(key).cast("string"), F.lit(".jpg"))).alias("file_name"),
    )


def sample_head(df: DataFrame, order, n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def limit_then_keyword(df: DataFrame, order, limit: int, text: str, keyword: str) -> DataFrame:
    """The first `limit` rows, of which those whose text holds the keyword."""
    return df.orderBy(*order).limit(limit).where(F.contains(F.lower(text), F.lit(keyword.lower())))
