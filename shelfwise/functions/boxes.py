"""Detected classes and bounding boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.schema import APPAREL_KEYWORDS, BOX_PADDING, PERSON_CLASS


def is_apparel(class_name: Column, keywords=None, person: str = PERSON_CLASS) -> Column:
    """True when the class name contains a keyword anywhere, whatever its case."""
    words = [*(keywords or APPAREL_KEYWORDS), person]
    hits = [F.lower(class_name).contains(word.lower()) for word in words]
    found = hits[0]
    for hit in hits[1:]:
        found = found | hit
    return found


def padded_box(bbox: Column, width: Column | int, height: Column | int,
               padding: int = BOX_PADDING) -> Column:
    """Pad, clamp to the image, and truncate toward zero: (x1, y1, x2, y2).

    An edge is NULL when its coordinate is missing or not a number.
    """
    def edge(i, shift, clamp, limit):
        coordinate = F.get(bbox, F.lit(i))
        clamped = clamp(coordinate + shift, F.lit(limit).cast("double"))
        return F.when(coordinate.isNotNull(), clamped.try_cast("int"))

    return F.struct(
        edge(0, -padding, F.greatest, 0).alias("x1"),
        edge(1, -padding, F.greatest, 0).alias("y1"),
        edge(2, padding, F.least, width).alias("x2"),
        edge(3, padding, F.least, height).alias("y2"),
    )


def has_area(box: Column) -> Column:
    return (box["x2"] > box["x1"]) & (box["y2"] > box["y1"])
