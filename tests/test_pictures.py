import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import detect, imaging, pixel_store, vector_store
from shelfwise.plans import bindings, pictures
from shelfwise.session import fresh_path
from shelfwise.sinks import files
from shelfwise.sources import images as sources

IMAGES = "image_id long, height int, width int, nChannels int, data binary"


def picture(rng, side=6):
    return rng.integers(0, 256, (side, side, 3)).astype(np.uint8)


def frame(spark, named):
    rows = [(k, *(p.shape if p is not None else (None,) * 3), p.tobytes() if p is not None else None)
            for k, p in named.items()]
    return spark.createDataFrame(rows, IMAGES)


@pytest.fixture(scope="module")
def some():
    rng = np.random.default_rng(8)
    return {i: picture(rng) for i in range(12)}


def test_written_files_decode_to_the_same_pixels(spark, some):
    folder = fresh_path(spark, "files")
    named = frame(spark, some).withColumn("file_name", F.format_string("shirt_%d_0.PNG", "image_id"))
    written = files.write_binary_files(imaging.encode_png(named), folder).collect()
    assert len(written) == 12 and not [f for f in os.listdir(folder) if f.startswith(".shirt")]
    files.write_binary_files(imaging.encode_png(named.where("image_id < 3")), f"file:{folder}").collect()
    back = {r["file_name"]: bytes(r["data"]) for r in sources.decode_images(spark, folder).collect()}
    assert back == {f"shirt_{i}_0.PNG": p.tobytes() for i, p in some.items()}


def test_names_that_leave_the_folder_are_refused(spark):
    bad = spark.createDataFrame([("../x.png", b"1")], "file_name string, content binary")
    with pytest.raises(Exception, match="plain file name"):
        files.write_binary_files(bad, fresh_path(spark, "files")).collect()
    assert files.write_binary_files(bad.selectExpr("file_name", "cast(null as binary) as content"),
                                    fresh_path(spark, "files")).count() == 0


@pytest.fixture(scope="module")
def folder(spark, some, tmp_path_factory):
    root = tmp_path_factory.mktemp("crops")
    for i, p in some.items():
        (root / f"shirt_{i}_0.png").write_bytes(imaging.png(p) if i != 4 else b"broken")
        (root / f"shirt_{i}_1.png").write_bytes(imaging.png(p[::-1]))
    os.makedirs(root / "again")
    (root / "again" / "shirt_5_0.png").write_bytes(imaging.png(some[6]))  # comes first in path order
    (root / "again" / "shirt_4_0.png").write_bytes(imaging.png(some[7]))  # the readable one of two
    (root / "noname_0.png").write_bytes(imaging.png(some[0]))
    return str(root)


def test_one_pass_from_files_to_vectors_and_failures(spark, some, folder):
    found = pictures.product_pictures(spark, folder, imaging.flat_encoder, 6, 6)
    vectors = {r["product_id"]: np.array(r["embedding"]) for r in found.vectors.collect()}
    want = {i: p for i, p in some.items()} | {5: some[6], 4: some[7]}
    assert sorted(vectors) == sorted(want)
    for i, p in want.items():
        assert vectors[i] == pytest.approx(p.ravel() / 255, abs=1e-6)
    status = {(r["file_name"], r["status"]) for r in found.status.collect()}
    assert ("shirt_4_0.png", "failed") in status and ("shirt_4_0.png", "ok") in status
    assert ("noname_0.png", "ok") in status and not [n for n, _ in status if n.endswith("_1.png")]


def test_no_exchange_on_the_way_to_vectors(spark, folder):
    rows = pictures.picture_vectors(sources.decode_images(spark, folder), imaging.flat_encoder, 6, 6)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_training_rows_from_files(spark, folder):
    products = spark.createDataFrame([(i, f"p{i}", str(1 + i % 5), str(i)) for i in range(20)],
                                     "product_id long, name string, rating string, no_of_reviews string")
    rows = pictures.training_rows_from_pictures(products, folder, imaging.flat_encoder, 6, 6).collect()
    assert sorted(r["product_id"] for r in rows) == list(range(12))
    assert sum(r["is_train"] for r in rows) == int(0.8 * 12) and {len(r["embedding"]) for r in rows} == {108}


def embedded(spark, images, store, name="flat"):
    return vector_store.refresh_vectors(images, store, name, imaging.flat_encoder, 6, 6)


def test_only_changed_images_are_embedded(spark, some):
    store, rng = fresh_path(spark, "store"), np.random.default_rng(9)
    now = dict(some) | {50: None}
    assert embedded(spark, frame(spark, now), store) == 12
    assert embedded(spark, frame(spark, now), store) == 0 and len(vector_store._runs(spark, store)) == 1
    now |= {3: picture(rng), 60: picture(rng)}
    assert embedded(spark, frame(spark, now), store) == 2
    now[7] = now[7].reshape(3, 12, 3)  # same bytes in another shape
    assert embedded(spark, frame(spark, now), store) == 1
    assert embedded(spark, frame(spark, now), store, "other") == 13
    rows = {r["image_id"]: r for r in vector_store.stored_vectors(spark, store, "flat").collect()}
    assert sorted(rows) == sorted(set(now) - {50})
    for i in (0, 3, 60):
        assert np.array(rows[i]["embedding"]) == pytest.approx(now[i].ravel() / 255, abs=1e-6)
    before = {i: (r["digest"], list(r["embedding"])) for i, r in rows.items()}
    vector_store.compact(spark, store)
    assert len(vector_store._runs(spark, store)) == 1
    rows = vector_store.stored_vectors(spark, store, "flat").collect()
    assert {r["image_id"]: (r["digest"], list(r["embedding"])) for r in rows} == before


def test_runs_that_did_not_commit_are_ignored(spark, some):
    store = fresh_path(spark, "store")
    embedded(spark, frame(spark, some), store)
    run = vector_store._runs(spark, store)[0]
    spark.read.parquet(f"{store}/run={run}").write.parquet(f"{store}/run=99999999999999999999-half")
    os.remove(f"{store}/run=99999999999999999999-half/_SUCCESS")
    assert vector_store._runs(spark, store) == [run]
    assert vector_store.stored_vectors(spark, store, "flat").count() == 12


def test_many_changed_images_meet_their_pixels_by_shuffle(spark, some, monkeypatch):
    store = fresh_path(spark, "store")
    embedded(spark, frame(spark, {0: some[0]}), store)
    monkeypatch.setattr(vector_store, "CHANGED_IDS", 0)
    assert embedded(spark, frame(spark, some), store) == 11
    assert vector_store.stored_vectors(spark, store, "flat").count() == 12


@pytest.fixture(scope="module")
def crops(spark):
    rows = [(i, s, "shirt", 0.9, [float(s % 4), 0.0, float(s % 4 + 2), 3.0]) for i in range(8) for s in range(5 + 20 * (i == 2))]
    found = spark.createDataFrame(
        rows, "image_id long, seq long, class_name string, confidence double, bbox array<double>")
    return detect.crop_ordinal(detect.accepted_crops(found, 6, 6, padding=1))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, [line for line in plan.split("\n") if "Exchange" in line]


@pytest.mark.parametrize("heavy", [1000, 10])
def test_stored_pixels_are_cut_where_they_lie(spark, some, crops, heavy):
    images, path = frame(spark, some), fresh_path(spark, "pixels")
    store = pixel_store.write_pixel_store(images, f"pixels_{heavy}", path, 4)
    cut = pixel_store.crop_stored_images(store, crops, 4, 4, heavy)
    expected = sorted(map(tuple, imaging.crop_images(images, crops, 4).collect()))
    assert sorted(map(tuple, cut.collect())) == expected and len(expected) == 60
    again = pixel_store.open_pixel_store(spark, f"opened_{heavy}", path, 4)
    assert sorted(map(tuple, pixel_store.crop_stored_images(again, crops, 4, 4, heavy).collect())) == expected
    spark.sql(f"drop table pixels_{heavy}")
    spark.sql(f"drop table opened_{heavy}")


def test_no_exchange_carries_pixels(spark, some, crops):
    images, path = frame(spark, some), fresh_path(spark, "pixels")
    store = pixel_store.write_pixel_store(images, "pixels_plan", path, 4)
    held = spark.createDataFrame(crops.collect(), crops.schema)
    plan, moved = exchanges(pixel_store.crop_stored_images(store, held, 4, 4))
    assert len(moved) == 1 and "image_id" in moved[0]
    assert "ShuffledHashJoin" in plan and "Sort [image_id" not in plan
    few = held.where("image_id = 3")
    plan, _ = exchanges(pixel_store.crop_stored_images(store, few, 4, 4))
    assert "SelectedBucketsCount: 1 out of 4" in plan
    spark.sql("drop table pixels_plan")


def test_tile_files_hold_the_tiles(spark, sf_dir):
    folder = bindings.tile_files(spark, sf_dir)
    status = {r["status"]: r["n"] for r in sources.decode_images(spark, folder).groupBy("status").agg(
        F.count("*").alias("n")).collect()}
    n = bindings.table(spark, sf_dir, "embeddings").count()
    assert status["failed"] == len(range(0, n, 17)) and status["ok"] == n - status["failed"] + len(range(0, n, 3))
