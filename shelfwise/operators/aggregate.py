"""Counts and summary documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_counts(df: DataFrame, source: str = "source") -> DataFrame:
    """Rows per source, most frequent first."""
    return (df.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), source))


def total_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def summary_document(df: DataFrame, search_terms, source: str = "source",
                     stamped: bool = True) -> DataFrame:
    """One row: total, rows per source, time of the run, search terms.

    Only the per-source counts are gathered, one entry for each source.
    """
    counts = df.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    doc = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_products"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(source, "n")))).alias("sources"),
    )
    if stamped:
        doc = doc.withColumn("scraping_timestamp",
                             F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
    return doc.withColumn("search_terms", F.array(*[F.lit(t) for t in search_terms]))


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       by=()) -> DataFrame:
    """Mean squared and mean absolute error."""
    error = F.col(prediction) - F.col(label)
    return df.groupBy(*by).agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"))
