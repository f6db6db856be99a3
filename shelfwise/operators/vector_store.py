"""Vectors kept between runs, so that only new and changed images are embedded.

A store is a folder of runs, each written by one job. A run counts once the job
has committed it, so readers see all of it or nothing, and a run that failed
half-way is ignored. A vector belongs to an image's content and an encoder:
pixels are known by their digest, encoders by a name that the caller changes
with them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.clean import first_per_key
from shelfwise.operators.imaging import embed_images, readable
from shelfwise.session import materialize

SCHEMA = "image_id bigint, digest string, encoder string, embedding array<float>, run string"
# Ids of changed images are broadcast up to here, 16 bytes each; beyond, pixels are shuffled to meet them.
CHANGED_IDS = 1 << 20


def content_digest() -> Column:
    """Digest of an image row's size and pixels."""
    head = F.encode(F.concat_ws("x", "height", "width", "nChannels"), "UTF-8")
    return F.sha2(F.concat(head, F.lit(b"\0"), F.col("data")), 256)


def _runs(spark: SparkSession, store: str) -> list[str]:
    """Committed runs, oldest first."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{store}/run=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(status.getPath().getParent().getName().removeprefix("run=") for status in found)


def stored_vectors(spark: SparkSession, store: str, encoder: str) -> DataFrame:
    """(image_id, digest, embedding, run): the newest vector of each image by the named encoder."""
    rows = _stored(spark, store).where(F.col("encoder") == encoder)
    return first_per_key(rows, ["image_id"], [F.desc("run")]).select("image_id", "digest", "embedding", "run")


def _stored(spark: SparkSession, store: str) -> DataFrame:
    runs = _runs(spark, store)
    if not runs:
        return spark.createDataFrame([], SCHEMA)
    return (spark.read.schema(SCHEMA).option("basePath", store)
            .parquet(*[f"{store}/run={run}" for run in runs]))


def changed_images(images: DataFrame, known: DataFrame) -> DataFrame:
    """(image_id, digest) of readable images whose content `known` (image_id, digest) has not.

    Digests are taken where the pixels are; only they are compared.
    """
    return readable(images).select("image_id", content_digest().alias("digest")).join(
        known.select("image_id", "digest"), ["image_id", "digest"], "left_anti")


def refresh_vectors(images: DataFrame, store: str, encoder: str,
                    encode: Callable[[np.ndarray], np.ndarray] | None = None,
                    height: int = 320, width: int = 192) -> int:
    """Embed images that are new or have changed since the store's last run, and append them; their number.

    Image ids are unique. Images that are gone keep their vectors in the store:
    `stored_vectors` joined with what is there leaves them out.
    """
    spark = images.sparkSession
    known = stored_vectors(spark, store, encoder).select("image_id", "digest")
    first = not _runs(spark, store)
    changed = materialize(changed_images(images, known), "changed")
    many = changed.count()
    if not many:
        return 0
    wanted = images
    if not first:
        ids = changed.select("image_id")
        wanted = images.join(F.broadcast(ids) if many <= CHANGED_IDS else ids, "image_id", "left_semi")
    vectors = embed_images(wanted, encode, height, width).join(changed, "image_id")
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    (vectors.select("image_id", "digest", F.lit(encoder).alias("encoder"), "embedding")
     .write.parquet(f"{store}/run={run}"))
    return many


def compact(spark: SparkSession, store: str) -> None:
    """The newest vector of each image and encoder in one run, older runs removed. Not while others refresh."""
    runs = _runs(spark, store)
    if len(runs) < 2:
        return
    newest = first_per_key(_stored(spark, store), ["image_id", "encoder"], [F.desc("run")]).drop("run")
    newest.write.parquet(f"{store}/run={time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(store)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for run in runs:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{store}/run={run}"), True)
