"""Image files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import file_name
from shelfwise.schema import FLAT_IMAGE_EXTENSIONS, IMAGE_EXTENSIONS


def _files(spark: SparkSession, kind: str, path: str, recursive: bool, extensions, stem: str = "*") -> DataFrame:
    """Files with the given endings in any case, and a name like `stem`; others are not even opened."""
    def any_case(word):
        return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)

    known = IMAGE_EXTENSIONS if recursive else FLAT_IMAGE_EXTENSIONS
    endings = ",".join(any_case(e) for e in extensions or known)
    return (spark.read.format(kind).option("recursiveFileLookup", recursive)
            .option("pathGlobFilter", f"{stem}.{{{endings}}}").load(path))


def scan_images(spark: SparkSession, path: str, recursive: bool = True,
                extensions=None) -> DataFrame:
    """Image files under a folder, endings compared without case."""
    files = _files(spark, "binaryFile", path, recursive, extensions)
    return files.withColumn("file_name", file_name(F.col("path")))


def decode_images(spark: SparkSession, path: str, recursive: bool = True,
                  extensions=None, stem: str = "*") -> DataFrame:
    """Decoded pixels, 3 channels in BGR order, one row per image file whose name before the ending is like `stem`.

    A file that cannot be decoded stays as a row with status `failed` and no
    pixels, so a bad file never fails the job and never vanishes.
    """
    raw = _files(spark, "image", path, recursive, extensions, stem).select("image.*")
    ok = F.col("height") > 0
    return raw.select(
        file_name(F.col("origin")).alias("file_name"), "origin",
        F.when(ok, F.col("height")).alias("height"),
        F.when(ok, F.col("width")).alias("width"),
        F.when(ok, F.col("nChannels")).alias("nChannels"),
        F.when(ok, F.col("data")).alias("data"),
        F.when(ok, "ok").otherwise("failed").alias("status"),
    )


def product_of_crop(name, pattern: str = "([0-9]+)_([0-9]+)[.][A-Za-z]+$"):
    """Key and 0-based ordinal held in a crop's file name, NULL if it has none."""
    def part(i):
        return F.regexp_extract(name, pattern, i).try_cast("bigint")
    return F.struct(part(1).alias("product_id"), part(2).alias("crop_ordinal"))
