"""Detections to crops and per-image metadata.

Detections are rows (image_id, seq, class_name, confidence, bbox), `seq` giving
their order inside the image.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.boxes import has_area, is_apparel, padded_box
from shelfwise.operators.clean import first_per_key
from shelfwise.operators.ordinals import group_ordinal
from shelfwise.schema import BOX_PADDING, MIN_CONFIDENCE


def filter_detections(detections: DataFrame, min_confidence: float = MIN_CONFIDENCE,
                      keywords=None) -> DataFrame:
    """Apparel or people, strictly above the confidence threshold."""
    return detections.where(is_apparel(F.col("class_name"), keywords)
                            & (F.col("confidence") > min_confidence))


def crop_boxes(detections: DataFrame, width: Column | int, height: Column | int,
               padding: int = BOX_PADDING) -> DataFrame:
    """Clipped pixel boxes; boxes without area inside the image are dropped."""
    boxed = detections.withColumn("box", padded_box(F.col("bbox"), width, height, padding))
    whole = F.forall("bbox", lambda x: x.isNotNull() & ~F.isnan(x))
    return boxed.where(whole & has_area(F.col("box")))


def accepted_crops(detections: DataFrame, width: Column | int, height: Column | int,
                   min_confidence: float = MIN_CONFIDENCE, padding: int = BOX_PADDING,
                   keywords=None) -> DataFrame:
    return crop_boxes(filter_detections(detections, min_confidence, keywords),
                      width, height, padding)


def crop_ordinal(crops: DataFrame) -> DataFrame:
    """Number the crops of each image from 0, in detection order."""
    return group_ordinal(crops, ["image_id"], ["seq"], "crop_ordinal")


def first_crop(crops: DataFrame) -> DataFrame:
    """The crop numbered 0 of every image."""
    return first_per_key(crops, ["image_id"], ["seq"])


def processed_images(status: DataFrame) -> DataFrame:
    """Images that were read, with detections or without: those whose `status` is ok."""
    return status.where(F.col("status") == "ok").select("image_id")


def failed_images(images: DataFrame, processed: DataFrame) -> DataFrame:
    """Images that were not processed. `processed` comes from a run's status: an image on which nothing
    was found has no detections, yet has not failed."""
    return images.join(processed.select("image_id").distinct(), "image_id", "left_anti")


def detection_totals(images: DataFrame, processed: DataFrame, crops: DataFrame) -> DataFrame:
    """One row of run counters.

    Each input is reduced to its own counts first; the rows are never joined.
    """
    seen = processed.select("image_id").distinct().select(
        "image_id", F.lit(1).alias("ok"))
    status = images.select("image_id").join(seen, "image_id", "left").agg(
        F.count_if(F.col("ok").isNotNull()).alias("processed_images"),
        F.count_if(F.col("ok").isNull()).alias("failed_images"),
    )
    cropped = crops.agg(F.count(F.lit(1)).alias("n")).scalar()
    return status.withColumn("__n", cropped).select(
        "processed_images", F.col("__n").alias("total_detections"),
        F.col("__n").alias("cropped_count"), "failed_images")


def detections_per_image(images: DataFrame, numbered: DataFrame,
                         chunk_size: int = 1000) -> DataFrame:
    """Ordered detections of every processed image, with their number.

    An image with up to `chunk_size` crops is one row, `chunk` 0. A larger one
    continues in further rows, so no list grows with the data and none is cut
    short. An image without crops has an empty list.
    """
    item = F.struct("crop_ordinal", "class_name", "confidence", "bbox")
    chunks = (
        numbered.withColumn("chunk", F.floor(F.col("crop_ordinal") / chunk_size))
        .groupBy("image_id", "chunk").agg(F.sort_array(F.collect_list(item)).alias("items"))
        .select("image_id", "chunk", F.transform("items", lambda d: F.struct(
            d["class_name"].alias("class_name"), d["confidence"].alias("confidence"),
            d["bbox"].alias("bbox"))).alias("detections"))
    )
    counts = numbered.groupBy("image_id").agg(F.count(F.lit(1)).alias("cropped_count"))
    # The lists join a row per image from their own side, so that a skewed
    # image can be split; images without crops are added apart.
    filled = chunks.join(counts, "image_id").select(
        "image_id", "chunk", "detections", "cropped_count")
    bare = images.select("image_id").join(counts, "image_id", "left_anti").select(
        "image_id", F.lit(0).cast("bigint").alias("chunk"),
        F.array().cast("array<struct<class_name:string,confidence:double,bbox:array<double>>>")
        .alias("detections"), F.lit(0).cast("bigint").alias("cropped_count"))
    return filled.unionByName(bare)
