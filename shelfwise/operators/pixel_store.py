"""Pixels in buckets by image, so that crops come to them and they never move.

Images are written once as a bucketed table. Boxes are then dealt to the same
buckets, and each task cuts its own images: the only exchange carries boxes. If
few images have boxes, only their buckets and row groups are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.imaging import boxes_of, crop_images, cut_boxes, readable

# Up to so many images with boxes are named in the scan's filter.
NAMED_IMAGES = 1000
# An image with more crops is cut by many tasks, to which its pixels are sent.
HEAVY_CROPS = 1_000_000
_COLUMNS = "image_id bigint, height int, width int, nChannels int, data binary"


def write_pixel_store(images: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Write readable images (ids are unique) as `table` with its files in `path`, and return it."""
    columns = [c.split()[0] for c in _COLUMNS.split(", ")]
    rows = readable(images).select(*columns).repartition(buckets, "image_id")
    rows.write.bucketBy(buckets, "image_id").sortBy("image_id").option("path", path).saveAsTable(table)
    return images.sparkSession.table(table)


def open_pixel_store(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """A store that another session has written, under the number of buckets it has."""
    if not spark.catalog.tableExists(table):
        place = path.replace("'", "\\'")
        spark.sql(f"create table {table} ({_COLUMNS}) using parquet clustered by (image_id) "
                  f"sorted by (image_id) into {int(buckets)} buckets location '{place}'")
    return spark.table(table)


def crop_stored_images(store: DataFrame, crops: DataFrame, buckets: int, chunk_size: int = 1000,
                       heavy_crops: int = HEAVY_CROPS) -> DataFrame:
    """What `crop_images` returns, with pixels read where they lie.

    `crops` is read more than once: write it to a table first if it is costly.
    Boxes of one bucket must fit a task's memory, images with more than
    `heavy_crops` aside: those few are joined by shuffle, which can split them.
    """
    counts = crops.groupBy("image_id").count()
    heavy = counts.where(F.col("count") > heavy_crops).select("image_id")
    named = [row[0] for row in counts.select("image_id").take(NAMED_IMAGES + 1)]
    if len(named) <= NAMED_IMAGES:
        store = store.where(F.col("image_id").isin(named))
    some = not heavy.isEmpty()
    light = crops.join(F.broadcast(heavy), "image_id", "left_anti") if some else crops
    lists = boxes_of(light.repartition(buckets, "image_id"), chunk_size)
    cut = cut_boxes(store.join(lists.hint("shuffle_hash"), "image_id"))
    if some:
        few = crops.join(F.broadcast(heavy), "image_id", "left_semi")
        cut = cut.unionByName(crop_images(store.join(F.broadcast(heavy), "image_id", "left_semi"), few, chunk_size))
    return cut
