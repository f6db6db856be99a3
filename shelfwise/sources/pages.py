"""Fetched listing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages as (page_id, url, html)."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-z]+://([^/?#:]+)", 1)
