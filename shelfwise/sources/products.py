"""Product records from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import normalize_missing


def read_products(spark: SparkSession, path: str, multi_line: bool = True, by_name: bool = False) -> DataFrame:
    """Product CSV with a header, every field text, missing tokens as NULL.

    Columns come from the header, so optional ones may be absent or added. A
    file whose header differs from the first one's is an error, unless `by_name`
    matches columns by name, file by file; that reads first lines in a pass of
    its own. Fields with line breaks need `multi_line`, which reads each file in
    one task: harvest into many files, or say that there are none to read files
    in splits.
    """
    reader = (spark.read.option("header", True).option("multiLine", multi_line).option("enforceSchema", False)
              .option("quote", '"').option("escape", '"'))
    raw = None
    for files in _files_by_header(spark, path) if by_name else [path]:
        part = reader.csv(files)
        raw = part if raw is None else raw.unionByName(part, allowMissingColumns=True)
    return raw.select([normalize_missing(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files, in lists of equal first lines."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("place"))
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    rows = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [r["files"] for r in rows]


def add_default_column(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant column unless the table already has one of that name."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))
