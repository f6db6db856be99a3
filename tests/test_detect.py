import pytest

from shelfwise.operators import detect
from shelfwise.schema import IMAGE_METADATA

W, H = 100, 80


def found(spark, rows):
    return spark.createDataFrame(
        rows, "image_id long, seq long, class_name string, confidence double, bbox array<double>")


BOX = [30.0, 30.0, 50.0, 50.0]


def test_keyword_is_a_substring_and_threshold_is_strict(spark):
    names = ["person", "T-Shirt", "Blouse", "laptop", "car", "JERSEY", "table"]
    rows = [(1, i, n, 0.9, BOX) for i, n in enumerate(names)]
    rows += [(2, 0, "shirt", 0.3, BOX), (2, 1, "shirt", 0.30001, BOX), (2, 2, "shirt", None, BOX)]
    kept = detect.filter_detections(found(spark, rows)).collect()
    assert [r["class_name"] for r in kept if r["image_id"] == 1] == [
        "person", "T-Shirt", "Blouse", "laptop", "JERSEY"]
    assert [r["seq"] for r in kept if r["image_id"] == 2] == [1]
    other = detect.filter_detections(found(spark, rows), 0.5, ["car"])
    assert {r["class_name"] for r in other.collect()} == {"person", "car"}


@pytest.mark.parametrize("bbox, box", [
    ([30.9, 30.9, 50.9, 50.9], (10, 10, 70, 70)),
    ([5.5, 5.5, 95.5, 75.5], (0, 0, 100, 80)),     # past every edge
    ([19.5, 20.5, 30.0, 30.0], (0, 0, 50, 50)),    # -0.5 and 0.5 both truncate to 0
])
def test_boxes_pad_truncate_and_clamp(spark, bbox, box):
    row = detect.crop_boxes(found(spark, [(1, 0, "shirt", 0.9, bbox)]), W, H).first()
    assert tuple(row["box"]) == box


def test_boxes_without_area_are_dropped(spark):
    rows = [(1, 0, "shirt", 0.9, [150.0, 10.0, 170.0, 20.0]),   # right of the image
            (1, 1, "shirt", 0.9, [-90.0, 10.0, -60.0, 20.0]),   # left of it
            (1, 2, "shirt", 0.9, [10.0, 10.0, 10.0, 20.0]),     # no width, but padded
            (1, 3, "shirt", 0.9, None),
            (1, 4, "shirt", 0.9, [float("nan"), 0.0, 9.0, 9.0]),
            (1, 5, "shirt", 0.9, [1.0, 2.0])]
    boxed = detect.crop_boxes(found(spark, rows), W, H)
    assert [r["seq"] for r in boxed.collect()] == [2]
    assert detect.crop_boxes(found(spark, rows), W, H, padding=0).count() == 0


@pytest.fixture(scope="module")
def crops(spark):
    rows = [(1, s, "shirt", 0.9, BOX) for s in range(0, 50, 2)] + [(2, 7, "top", 0.8, BOX)]
    return detect.accepted_crops(found(spark, rows), W, H)


def test_ordinal_counts_accepted_crops(spark, crops):
    rows = detect.crop_ordinal(crops).where("image_id = 1").orderBy("seq").collect()
    assert [r["crop_ordinal"] for r in rows] == list(range(25))
    assert {(r["image_id"], r["seq"]) for r in detect.first_crop(crops).collect()} == {(1, 0), (2, 7)}


def test_metadata_is_whole_in_bounded_lists(spark, crops):
    images = spark.createDataFrame([(1,), (2,), (3,)], "image_id long")
    numbered = detect.crop_ordinal(crops)
    docs = detect.detections_per_image(images, numbered, chunk_size=10)
    sizes = {(r["image_id"], r["chunk"]): (len(r["detections"]), r["cropped_count"])
             for r in docs.collect()}
    assert sizes == {(1, 0): (10, 25), (1, 1): (10, 25), (1, 2): (5, 25), (2, 0): (1, 1), (3, 0): (0, 0)}
    whole = detect.detections_per_image(images, numbered)
    assert whole.count() == 3
    assert whole.schema["detections"].dataType.simpleString() == \
        IMAGE_METADATA["detections"].dataType.simpleString()


def test_failed_and_totals_add_up(spark, crops):
    images = spark.createDataFrame([(i,) for i in range(1, 6)], "image_id long")
    failed = detect.failed_images(images, crops)
    assert {r[0] for r in failed.collect()} == {3, 4, 5}
    row = detect.detection_totals(images, crops, crops).first()
    assert row.asDict() == {"processed_images": 2, "failed_images": 3, "total_detections": 26,
                            "cropped_count": 26}
