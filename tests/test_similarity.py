import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.functions.vectors import cosine, flatten, is_finite, unit
from shelfwise.operators import similarity, trends


def frame(spark, vectors, key, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)],
                                 f"{key} long, embedding array<double>")


def brute(queries, catalogue, k, exclude_self=False):
    def normed(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n == 0, 1, n)
    sims = np.round(normed(queries) @ normed(catalogue).T, 6) + 0.0
    out = []
    for i, row in enumerate(sims):
        order = [j for j in np.lexsort((np.arange(len(row)), -row)) if not (exclude_self and i == j)]
        out += [(i, r + 1, int(j), float(row[j])) for r, j in enumerate(order[:k])]
    return out


@pytest.fixture(scope="module")
def data():
    """Vectors of which a third are copies of one, with zeros and repeats."""
    rng = np.random.default_rng(3)
    m = rng.integers(-2, 3, (150, 4)).astype(float)
    m[rng.permutation(150)[:50]] = [1, 2, 0, 1]
    m[7] = 0
    return m


# How the sides are split, by the limits given to the size check.
ROUTES = {"broadcast catalogue": {}, "broadcast queries": {"broadcast_rows": 60},
          "grid": {"broadcast_rows": 10, "block_rows": 32}}


@pytest.mark.parametrize("route", ROUTES)
@pytest.mark.parametrize("exclude_self", [False, True])
def test_every_route_equals_brute_force(spark, data, route, exclude_self):
    queries, catalogue = data[:50], data
    hits = similarity.topk_similar(
        frame(spark, queries, "query_id").repartition(3),
        frame(spark, catalogue, "candidate_id").repartition(4), 5,
        exclude_self=exclude_self, **ROUTES[route])
    got = sorted(tuple(r) for r in hits.collect())
    assert got == sorted(brute(queries, catalogue, 5, exclude_self))


def test_too_many_pairs_are_refused(spark, data):
    few, all_rows = frame(spark, data[:20], "query_id"), frame(spark, data, "candidate_id")
    assert similarity.similarity_scores(few, all_rows, max_pairs=3000).count() == 3000
    with pytest.raises(ValueError, match="3000 pairs"):
        similarity.similarity_scores(few, all_rows, max_pairs=2999)


@pytest.mark.parametrize("route", ROUTES)
def test_scores_cover_the_catalogue(spark, data, route):
    df = similarity.similarity_scores(frame(spark, data[:20], "query_id"),
                                      frame(spark, data, "candidate_id"), **ROUTES[route])
    got = {(r["query_id"], r["candidate_id"]): r["similarity"] for r in df.collect()}
    assert len(got) == 20 * 150
    assert got == {(q, c): s for q, _, c, s in brute(data[:20], data, 150)}


def test_grid_blocks_are_bounded_and_plan_has_no_cross_join(spark, data):
    hits = similarity.topk_similar(frame(spark, data, "query_id"), frame(spark, data, "candidate_id"),
                                   5, broadcast_rows=10, block_rows=32)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_small_blocks_make_no_more_copies_than_tasks_ask_for(spark, data):
    counts = [similarity.block_count(spark, n, 64, 100) for n in (150, 10_000, 100_000, 600_000)]
    assert counts[0] == 2 and counts[1] == counts[2] <= 8 and counts[3] == 10
    assert similarity.block_count(spark, 600_000, 2048, 65_536) == 147  # of bounded bytes
    hits = similarity.topk_similar(frame(spark, data, "query_id"), frame(spark, data, "candidate_id"), 5,
                                   broadcast_rows=10, block_rows=1)
    assert sorted(tuple(r) for r in hits.collect()) == sorted(brute(data, data, 5))


def test_fewer_candidates_than_k(spark, data):
    hits = similarity.topk_similar(frame(spark, data[:3], "query_id"),
                                   frame(spark, data[:2], "candidate_id"), 5)
    assert hits.count() == 6


def test_vectors_that_are_not_finite_take_no_part(spark):
    catalogue = frame(spark, [[1, 0], [float("nan"), 1], [float("inf"), 1]], "candidate_id")
    for rows in (10, 1, 0):
        hits = similarity.topk_similar(frame(spark, [[1, 1]], "query_id"), catalogue, 5,
                                       broadcast_rows=rows)
        assert [r["candidate_id"] for r in hits.collect()] == [0]


def test_zero_vector_has_similarity_zero(spark):
    hits = similarity.topk_similar(frame(spark, [[0, 0]], "query_id"),
                                   frame(spark, [[1, 0], [0, 1]], "candidate_id"), 5)
    assert [(r["candidate_id"], r["similarity"]) for r in hits.orderBy("rank").collect()] == [
        (0, 0.0), (1, 0.0)]


def test_empty_sides(spark, data):
    none = frame(spark, data, "query_id").where("query_id < 0")
    some = frame(spark, data, "candidate_id")
    assert similarity.topk_similar(none, some).count() == 0
    empty = some.where("candidate_id < 0")
    assert similarity.topk_similar(frame(spark, data, "query_id"), empty).count() == 0


def test_prepared_catalogue_serves_many_batches(spark, data):
    side = similarity.prepare_side(frame(spark, data, "candidate_id"), "candidate_id")
    for part in (data[:5], data[5:9]):
        got = similarity.topk_similar(frame(spark, part, "query_id"), side, 3).collect()
        assert sorted(tuple(r) for r in got) == sorted(brute(part, data, 3))


def test_width_mismatch_is_an_error(spark):
    catalogue = frame(spark, [[1, 0], [1, 0, 0]], "candidate_id")
    with pytest.raises(Exception, match="differ in width"):
        similarity.topk_similar(frame(spark, [[1, 1]], "query_id"), catalogue).collect()
    df = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception, match="differ in width"):
        df.select(cosine(F.col("a"), F.col("b"))).collect()


def test_cosine_is_symmetric_bounded_and_agrees_with_the_kernel(spark, data):
    a = frame(spark, data, "i").select("i", F.col("embedding").alias("a"))
    b = frame(spark, data, "j").select("j", F.col("embedding").alias("b"))
    pairs = a.join(b, F.expr("j = (i * 7 + 3) % 150")).select(
        "i", "j", cosine(F.col("a"), F.col("b")).alias("ab"), cosine(F.col("b"), F.col("a")).alias("ba"))
    exact = {(q, c): s for q, _, c, s in brute(data, data, 150)}
    for r in pairs.collect():
        assert r["ab"] == pytest.approx(r["ba"]) and -1.000001 <= r["ab"] <= 1.000001
        assert r["ab"] == pytest.approx(exact[r["i"], r["j"]], abs=1e-6)


def test_vector_functions(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]),
                                (4, [float("-inf"), 1.0]), (5, [None, 1.0])], "i int, v array<double>")
    rows = {r["i"]: r for r in df.select("i", unit(F.col("v")).alias("u"),
                                         is_finite(F.col("v")).alias("f")).collect()}
    assert rows[1]["u"] == [0.6, 0.8] and rows[2]["u"] == [0.0, 0.0]
    assert [rows[i]["f"] for i in range(1, 6)] == [True, True, False, False, False]
    scored = df.withColumn("s", F.expr("if(i = 1, null, 1D)"))
    assert [r["i"] for r in similarity.finite_vectors(scored, "v", "s").collect()] == [2]
    nested = spark.createDataFrame([([[1.0, 2.0], [3.0]],)], "t array<array<double>>")
    assert nested.select(flatten(F.col("t"))).first()[0] == [1.0, 2.0, 3.0]
    wide = similarity.expand_vector(df.where("i = 1"), 2, "v")
    assert wide.columns == ["i", "feature_0", "feature_1"] and tuple(wide.first()) == (1, 3.0, 4.0)


def test_centroids_and_nearest(spark, data):
    labelled = frame(spark, data, "vec_id").withColumn("label", (F.col("vec_id") % 4).cast("int"))
    means = {r["label"]: r["embedding"] for r in trends.centroids(labelled, "label").collect()}
    for label, mean in means.items():
        assert mean == pytest.approx(list(data[label::4].mean(axis=0)))
    centers = np.array([means[i] for i in range(4)])
    want = np.round(((data[:, None, :] - centers) ** 2).sum(axis=2), 6)
    for rows in (100, 2):
        got = trends.assign_nearest(labelled, trends.centroids(labelled, "label"), "vec_id", "label",
                                    broadcast_rows=rows, block_rows=40)
        assert {r["vec_id"]: r["label"] for r in got.collect()} == dict(enumerate(want.argmin(axis=1)))


def test_trend_labels_share_ties(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbbccde"], "cluster string")
    got = {r["cluster"]: (r["n"], r["trend"]) for r in trends.trend_labels(df).collect()}
    assert got == {"a": (3, "popular"), "b": (3, "popular"), "c": (2, "steady"),
                   "d": (1, "lagging"), "e": (1, "lagging")}
    one = trends.trend_labels(df.where("cluster = 'a'")).first()
    assert one["trend"] == "popular"


def test_kmeans_separates_clear_groups(spark):
    rng = np.random.default_rng(1)
    points = np.vstack([rng.normal(c, 0.05, (30 - 10 * i, 3)) for i, c in enumerate([0, 5, 10][:2])])
    df = frame(spark, points, "vec_id")
    clustered = trends.cluster_products(df, trends.fit_clusters(df, 2)).collect()
    assert len({r["cluster"] for r in clustered if r["vec_id"] < 30}) == 1
    assert len({r["cluster"] for r in clustered}) == 2


def test_repeated_query_keys_have_one_result_on_every_route(spark, data):
    vectors = np.concatenate([data[:50], data[60:65], data[:2]])
    queries = frame(spark, vectors, "query_id", [*range(50), *range(5), 0, 1]).repartition(4)
    smallest = [min([list(data[i])] + ([list(data[60 + i])] if i < 5 else [])) for i in range(50)]
    want = sorted(brute(np.array(smallest), data, 5))
    for options in ROUTES.values():
        hits = similarity.topk_similar(queries, frame(spark, data, "candidate_id").repartition(4), 5, **options)
        assert sorted(tuple(r) for r in hits.collect()) == want
