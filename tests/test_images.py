import os
import struct
import zlib

import numpy as np
import pytest

from shelfwise.operators import detect, imaging, matching
from shelfwise.session import fresh_path
from shelfwise.sinks import files
from shelfwise.sources import images as sources


def png(pixels):
    """An RGB array as PNG bytes."""
    height, width, _ = pixels.shape
    raw = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("pictures")
    rng = np.random.default_rng(5)
    pictures = {"item_1_0.png": rng.integers(0, 256, (6, 4, 3)),
                "item_1_1.PNG": rng.integers(0, 256, (5, 5, 3)),
                "nested/item_2_0.png": rng.integers(0, 256, (3, 9, 3))}
    os.makedirs(root / "nested")
    for name, pixels in pictures.items():
        (root / name).write_bytes(png(pixels))
    (root / "broken_3_0.jpg").write_bytes(b"this is not a picture")
    (root / "notes.txt").write_text("skip me")
    return str(root), pictures


def test_scan_compares_endings_without_case(spark, folder):
    root, _ = folder
    names = {r["file_name"] for r in sources.scan_images(spark, root).select("file_name").collect()}
    assert names == {"item_1_0.png", "item_1_1.PNG", "item_2_0.png", "broken_3_0.jpg"}
    flat = sources.scan_images(spark, root, recursive=False, extensions=["jpg"])
    assert [r["file_name"] for r in flat.select("file_name").collect()] == ["broken_3_0.jpg"]


@pytest.fixture(scope="module")
def decoded(spark, folder):
    return sources.decode_images(spark, folder[0])


def test_broken_files_stay_as_failed_rows(spark, decoded):
    status = {r["file_name"]: r["status"] for r in decoded.select("file_name", "status").collect()}
    assert status == {"item_1_0.png": "ok", "item_1_1.PNG": "ok", "item_2_0.png": "ok",
                      "broken_3_0.jpg": "failed"}


def keyed(decoded):
    return decoded.selectExpr("cast(height * 100 + width as bigint) as image_id", "height", "width",
                              "nChannels", "data", "file_name", "status")


def test_statistics(spark, folder, decoded):
    by_size = {p.shape[0] * 100 + p.shape[1]: p for p in folder[1].values()}
    rows = imaging.image_stats(keyed(decoded)).collect()
    assert len(rows) == 3
    for r in rows:
        rgb = by_size[r["image_id"]]
        mean = rgb.reshape(-1, 3).mean(axis=0)
        assert (r["mean_red"], r["mean_green"], r["mean_blue"]) == pytest.approx(tuple(mean))
        grey = np.floor(rgb @ [0.299, 0.587, 0.114] + 0.5)
        assert r["brightness"] == pytest.approx(grey.mean(), abs=0.1)
        assert r["area"] == rgb.shape[0] * rgb.shape[1]
        assert r["aspect_ratio"] == rgb.shape[1] / rgb.shape[0]


def test_crops_are_the_pixels_of_the_box(spark, folder, decoded):
    images = keyed(decoded).where("file_name = 'item_1_1.PNG'")
    rows = [(505, s, "shirt", 0.9, [float(s), 0.0, float(s + 2), 3.0]) for s in range(6)]
    found = spark.createDataFrame(
        rows, "image_id long, seq long, class_name string, confidence double, bbox array<double>")
    numbered = detect.crop_ordinal(detect.accepted_crops(found, 5, 5, padding=1))
    path = fresh_path(spark, "crops")
    files.write_table(imaging.crop_images(images, numbered, chunk_size=4), path)
    cut = spark.read.parquet(path).collect()
    assert sorted(r["crop_ordinal"] for r in cut) == list(range(6))
    rgb = folder[1]["item_1_1.PNG"]
    for r in cut:
        want = rgb[r["y1"]:r["y2"], r["x1"]:r["x2"], ::-1].astype(np.uint8)
        assert bytes(r["data"]) == want.tobytes() and (r["height"], r["width"]) == want.shape[:2]


def test_crops_are_handed_on_in_parts(spark, decoded, monkeypatch):
    images = keyed(decoded).where("file_name = 'item_1_1.PNG'")
    numbered = spark.range(50).selectExpr(
        "505L as image_id", "id as crop_ordinal", "named_struct('x1', 0, 'y1', 0, 'x2', 5, 'y2', 5) as box")
    monkeypatch.setattr(imaging, "OUTPUT_BYTES", 200)
    cut = imaging.crop_images(images, numbered).collect()
    assert sorted(r["crop_ordinal"] for r in cut) == list(range(50))
    assert {len(r["data"]) for r in cut} == {75}


def test_products_meet_their_first_crop_by_key(spark, decoded):
    products = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "product_id long, name string")
    readable = matching.crops_by_product(decoded.where("status = 'ok'")).select("product_id", "file_name")
    joined = matching.join_products_images(products, readable)
    assert {(r["name"], r["file_name"]) for r in joined.collect()} == {
        ("a", "item_1_0.png"), ("b", "item_2_0.png")}
    valid = matching.products_with_images(products, readable)
    missing = products.join(readable, "product_id", "left_anti")
    assert valid.count() + missing.count() == products.count()


def test_resize_matches_hand_values():
    grid = np.array([[0, 255]], dtype=np.uint8)[..., None].repeat(3, axis=2)
    assert imaging.resize(grid, 1, 4)[0, :, 0] == pytest.approx([0, 0.25, 0.75, 1])
    flat = np.full((7, 5, 3), 51, dtype=np.uint8)
    assert imaging.resize(flat, 3, 11) == pytest.approx(np.full((3, 11, 3), 0.2))


def test_embeddings_have_the_encoder_width(spark, decoded):
    images = keyed(decoded)
    rows = imaging.embed_images(images, batch_size=2).collect()
    assert {len(r["embedding"]) for r in rows} == {1920} and len(rows) == 3
    small = imaging.embed_images(images, imaging.flat_encoder, 4, 4, partitions=3).collect()
    assert {len(r["embedding"]) for r in small} == {48}
    assert all(0 <= x <= 1 for r in small for x in r["embedding"])


def test_grid_encoder_is_mean_and_spread_per_cell():
    batch = np.random.default_rng(2).random((2, 8, 6, 3))
    got = imaging.grid_encoder(2, 3)(batch).reshape(2, 2, 3, 8)
    cell = batch[1, 4:8, 2:4].reshape(-1, 3)
    assert got[1, 1, 1, :3] == pytest.approx(cell.mean(axis=0), abs=1e-6)
    assert got[1, 1, 1, 4:7] == pytest.approx(cell.std(axis=0), abs=1e-4)
    with pytest.raises(ValueError):
        imaging.grid_encoder(3, 3)(batch)
