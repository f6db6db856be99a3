import os

import pytest

from pyspark.sql import functions as F

from shelfwise.operators.similarity import topk_similar
from shelfwise.plans import registry
from shelfwise.plans.bindings import table
from shelfwise.session import fresh_path, work_dir
from shelfwise.streaming.catalogue import CurrentCatalogue, publish, stream_recommend_current
from shelfwise.streaming.dedup import KEY_BUCKETS, stream_dedup, stream_dedup_within, stream_first_after_gap, unpack
from shelfwise.streaming.recommend import stream_recommend


def source(spark, path, schema, **options):
    return spark.readStream.schema(schema).options(**options).parquet(path)


@pytest.fixture(scope="module")
def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def test_stream_equals_batch_and_restarts_quietly(spark, vectors):
    path, out, state = (fresh_path(spark, n) for n in ("queries", "hits", "state"))
    queries = vectors.where("vec_id < 30")
    queries.repartition(3).write.parquet(path)
    keys = {"query_key": "vec_id", "candidate_key": "vec_id"}

    def run():
        stream_recommend(source(spark, path, queries.schema, maxFilesPerTrigger=1), vectors, out,
                         state, **keys).awaitTermination()
        hits = spark.read.parquet(out)
        return sorted(tuple(r) for r in hits.select("query_id", "rank", "candidate_id", "similarity").collect())

    batch = sorted(tuple(r) for r in topk_similar(queries, vectors, **keys).collect())
    assert run() == batch
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 3
    assert run() == batch  # nothing new
    vectors.where("vec_id = 40").write.mode("append").parquet(path)
    assert len(run()) == len(batch) + 5


def record(spark, path, rows):
    spark.createDataFrame(rows, "product_id long, name string, source string").coalesce(1) \
        .write.mode("append").parquet(path)


def test_dedup_keeps_the_first_over_all_batches(spark):
    path, out, state = (fresh_path(spark, n) for n in ("records", "kept", "state"))
    schema = "product_id long, name string, source string"

    def run():
        stream_dedup(source(spark, path, schema), out, state).awaitTermination()
        return sorted((r["batch_id"], r["product_id"]) for r in spark.read.parquet(out).collect())

    record(spark, path, [(5, "a", "s"), (4, "a", "s"), (6, "a", "t"), (7, None, "t")])
    assert run() == [(0, 4), (0, 6), (0, 7)]
    record(spark, path, [(1, "a", "s"), (8, "b", "s"), (9, "b", "s"), (2, None, "t")])
    assert run() == [(0, 4), (0, 6), (0, 7), (1, 8)]
    assert run() == [(0, 4), (0, 6), (0, 7), (1, 8)]


def test_dedup_of_a_new_stream_keeps_what_is_there(spark):
    path, more, out = (fresh_path(spark, n) for n in ("records", "records", "kept"))
    schema = "product_id long, name string, source string"
    record(spark, path, [(1, "a", "s"), (2, "b", "s")])
    stream_dedup(source(spark, path, schema), out, fresh_path(spark, "state")).awaitTermination()
    record(spark, more, [(3, "c", "s"), (4, "a", "s")])
    stream_dedup(source(spark, more, schema), out, fresh_path(spark, "state")).awaitTermination()
    assert sorted(r["product_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_dedup_leaves_no_copies_and_reads_its_own_buckets(spark):
    path, out, state = (fresh_path(spark, n) for n in ("records", "kept", "state"))
    before = copies(spark)
    for i in range(3):
        record(spark, path, [(i, f"n{i}", "s"), (i + 10, "n0", "s")])
    stream_dedup(source(spark, path, "product_id long, name string, source string", maxFilesPerTrigger=1),
                 out, state).awaitTermination()
    kept = spark.read.parquet(out)
    assert sorted(r["name"] for r in kept.collect()) == ["n0", "n1", "n2"]
    assert kept.select("bucket").distinct().count() == 3 and copies(spark) == before


def copies(spark):
    folder = work_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(folder) if n.startswith("stream-batch")} if os.path.isdir(folder) else set()


def test_dedup_within_a_horizon(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path, out, state = (fresh_path(spark, n) for n in ("events", "kept", "state"))
    events.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")) \
        .write.parquet(path)
    stream = source(spark, path, spark.read.parquet(path).schema)
    kept = stream_dedup_within(stream, ["user_id", "event_type"], "ts", "1 hour")
    kept.writeStream.format("parquet").option("checkpointLocation", state) \
        .trigger(availableNow=True).start(out).awaitTermination()
    want = events.select("user_id", "event_type").distinct().count()
    assert spark.read.parquet(out).count() == want


def test_dedup_query_reads_every_event(spark, tmp_path):
    rows = [(None, 1, "a"), (7, 2, "a"), (4, 2, "a"), (None, 2, "a"), (-1, 3, "b"), (8, 3, "b"), (5, 4, None)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    found = registry._stream_dedup_events(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=str) == sorted(
        [(None, 1, "a"), (4, 2, "a"), (-1, 3, "b"), (5, 4, None)], key=str)


def gaps(spark, path, out, state, **options):
    stream = source(spark, path, "event_id long, user_id long, ts timestamp")
    stream_first_after_gap(stream, out, state, ["user_id"], "ts", "event_id", 60, **options).awaitTermination()
    return sorted((r["event_id"] for r in spark.read.schema("event_id long").parquet(out).collect()))


def timed(spark, path, rows):
    spark.createDataFrame(rows, "event_id long, user_id long, s long").selectExpr(
        "event_id", "user_id", "timestamp_seconds(1000000 + s) as ts").coalesce(1).write.mode("append").parquet(path)


def test_first_after_gap_over_restarts(spark):
    path, out, state = (fresh_path(spark, n) for n in ("events", "kept", "state"))
    timed(spark, path, [(1, 1, 0), (2, 1, 60), (3, 1, 121), (4, 2, 5), (5, None, 7), (6, 1, 121), (0, 3, None)])
    assert gaps(spark, path, out, state) == [1, 3, 4, 5]
    timed(spark, path, [(7, 1, 180), (8, 2, 300), (9, None, 400)])  # 7 goes on from the state of the run before
    assert gaps(spark, path, out, state) == [1, 3, 4, 5, 8, 9]
    timed(spark, path, [(10, 4, 10), (11, 1, 401)])  # 10 is behind the watermark
    assert gaps(spark, path, out, state) == [1, 3, 4, 5, 8, 9, 11]


def test_records_that_are_out_of_order_but_not_late(spark):
    path, out, state = (fresh_path(spark, n) for n in ("events", "kept", "state"))
    timed(spark, path, [(1, 1, 500)])
    assert gaps(spark, path, out, state, delay="10 minutes") == [1]
    timed(spark, path, [(2, 1, 100), (3, 1, 550), (4, 2, 100)])
    assert gaps(spark, path, out, state, delay="10 minutes") == [1, 4]
    timed(spark, path, [(5, 1, 611)])
    assert gaps(spark, path, out, state, delay="10 minutes") == [1, 4, 5]


def test_state_is_bounded_by_the_gap(spark):
    path, out, state = (fresh_path(spark, n) for n in ("events", "kept", "state"))
    rows = []
    for batch in range(4):
        timed(spark, path, [(100 * batch + i, 100 * batch + i, 1000 * batch + i) for i in range(40)])
        stream = source(spark, path, "event_id long, user_id long, ts timestamp")
        query = stream_first_after_gap(stream, out, state, ["user_id"], "ts", "event_id", 60)
        query.awaitTermination()
        rows.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(rows) <= 80 and rows[-1] <= 80  # of 160 keys
    assert spark.read.schema("event_id long").parquet(out).count() == 160
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_keys_share_calls_and_states(spark):
    path, out, state = (fresh_path(spark, n) for n in ("events", "kept", "state"))

    def held(rows):
        timed(spark, path, rows)
        stream = source(spark, path, "event_id long, user_id long, ts timestamp")
        query = stream_first_after_gap(stream, out, state, ["user_id"], "ts", "event_id", 60)
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= KEY_BUCKETS
        states = spark.read.format("statestore").load(state).selectExpr("value.groupState.seen").collect()
        return {k: us // 1000000 - 1000000 for r in states for k, us in unpack(r["seen"])[["k0", "us"]].to_numpy().tolist()}

    assert held([(i, i, i % 40) for i in range(3000)]) == {i: i % 40 for i in range(3000)}
    # the odd keys come again after 50 s, and of the even ones those of the last 60 s are held
    assert held([(3000 + i, i, 50 + i % 40) for i in range(1, 3000, 2)]) == {
        i: i % 40 + 50 * (i % 2) for i in range(3000) if i % 2 or i % 40 >= 29}
    assert held([(6000 + i, i, 150 + i % 40) for i in range(3000)]) == {i: 150 + i % 40 for i in range(3000)}
    assert held([(9000, 7, 1000)]) == {7: 1000}
    found = [r["event_id"] for r in spark.read.schema("event_id long").parquet(out).collect()]
    assert sorted(found) == [*range(3000), *range(6000, 9000), 9000]


def test_first_after_gap_keeps_ids_of_any_size_and_null(spark):
    path, out, state = (fresh_path(spark, n) for n in ("events", "kept", "state"))
    big = 2 ** 62
    rows = [(big + 1, big + 1, "a", 0), (big + 3, big + 1, "a", 30), (None, big + 2, None, 0), (big + 5, None, "a", 1),
            (big + 7, None, None, 2), (None, 0, "a", 3), (4, 0, "a", 3)]
    for late in (0, 80):
        spark.createDataFrame([(i, u, e, s + late) for i, u, e, s in rows], "event_id long, user_id long, e string, s long").selectExpr(
            "event_id", "user_id", "e", "timestamp_seconds(1000000 + s) as ts").write.mode("append").parquet(path)
        stream = source(spark, path, "event_id long, user_id long, e string, ts timestamp")
        stream_first_after_gap(stream, out, state, ["user_id", "e"], "ts", "event_id", 60).awaitTermination()
    found = spark.read.parquet(out).selectExpr("event_id", "user_id", "e", "unix_seconds(ts) - 1000000").collect()
    want = [(i, u, e, s + late) for late in (0, 80) for i, u, e, s in rows if (i, late) != (big + 3, 0) and (i, s) != (None, 3)]
    want.remove((big + 1, big + 1, "a", 80))  # 50 s after the one at 30
    want.remove((big + 3, big + 1, "a", 110))
    assert sorted((tuple(r) for r in found), key=str) == sorted(want, key=str)


def test_hits_follow_the_catalogue(spark, vectors):
    store, path, out, state = (fresh_path(spark, n) for n in ("catalogue", "queries", "hits", "state"))
    current = CurrentCatalogue(spark, store, "vec_id")
    keys = {"query_key": "vec_id"}

    def run(rows):
        rows.write.mode("append").parquet(path)
        stream_recommend_current(source(spark, path, vectors.schema), current, out, state, **keys).awaitTermination()
        return {(r["query_id"], r["rank"], r["candidate_id"], r["catalogue_version"])
                for r in spark.read.parquet(out).collect()}

    with pytest.raises(Exception, match="no catalogue"):
        run(vectors.where("vec_id = 3"))
    assert publish(vectors.where("vec_id < 20"), store) == 1
    run(vectors.where("vec_id = 4"))
    hits = run(vectors.where("vec_id = 5"))
    assert current.preparations == 1 and {h[3] for h in hits} == {1} and max(h[2] for h in hits) < 20
    assert publish(vectors.where("vec_id >= 20"), store) == 2
    new = run(vectors.where("vec_id = 6")) - hits
    assert current.preparations == 2 and {h[3] for h in new} == {2} and min(h[2] for h in new) >= 20
    vectors.write.parquet(f"{store}/version=9")
    os.remove(f"{store.removeprefix('file:')}/version=9/_SUCCESS")  # not published whole
    run(vectors.where("vec_id = 7"))
    assert current.preparations == 2 and current.version == 2
