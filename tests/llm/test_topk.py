import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import topk


def brute(rows, queries, k):
    out = []
    for q, a in queries.items():
        scores = sorted(((-int(np.dot(a, b)), c) for c, b in rows.items() if c != q and len(a) == len(b)))[:k]
        out += [(q, i, c, -s) for i, (s, c) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("tile_rows,shard_rows,fan", [(2000, 9000, 16), (3, 7, 2), (1, 50, 3)])
def test_equals_brute_force(spark, tile_rows, shard_rows, fan):
    rng = np.random.default_rng(3)
    rows = {i: rng.integers(-3, 4, 6).tolist() for i in range(90)}  # many ties
    rows |= {i: [1] * 6 for i in range(90, 120)}  # copies
    df = spark.createDataFrame([(i, v) for i, v in rows.items()] + [(None, [1] * 6), (500, None)],
                               "id long, v array<long>")
    found = topk.exact_topk(df.where("id % 10 = 0"), df, 5, tile_rows, shard_rows, fan)
    expected = brute(rows, {i: v for i, v in rows.items() if i % 10 == 0}, 5)
    assert sorted(tuple(r) for r in found.collect()) == expected


@pytest.mark.parametrize("tile_rows,shard_rows", [(2000, 9000), (2, 5)])
def test_repeated_ids(spark, tile_rows, shard_rows):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.integers(-4, 5, 3).tolist()) for i in rng.integers(0, 25, 120)]
    rows += [(7, [4, 4, 4])] * 40 + [(10, [1, 2, 3])] * 3  # equal rows, also of a query
    df = spark.createDataFrame(rows, "id long, v array<long>")
    expected = []
    for q in sorted({i for i, _ in rows if i % 5 == 0}):
        own = {tuple(v) for i, v in rows if i == q}
        pairs = sorted((-int(np.dot(a, b)), c) for a in own for c, b in rows if c != q)[:5]
        expected += [(q, r, c, -s) for r, (s, c) in enumerate(pairs, 1)]
    found = topk.exact_topk(df.where("id % 5 = 0"), df, 5, tile_rows, shard_rows, 2)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_best_row_of_a_repeated_id(spark):
    df = spark.createDataFrame([(0, [0, 5]), (1, [2, 2]), (1, [9, 9])], "id long, v array<long>")
    found = topk.exact_topk(df.where("id = 0"), df)
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, 45), (0, 2, 1, 10)]


def test_whole_vectors(spark):
    df = spark.createDataFrame([([0.1, -0.1, 1.0],), ([float("nan")],), ([None],), (None,), ([float("inf")],), ([],)],
                               "e array<float>")
    assert [r[0] for r in df.select(topk.whole_vector(F.col("e"))).collect()] == [[25, -26, 256], None, None, None, None, []]


def test_few_candidates_and_lengths(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [3, 4]), (2, [5])], "id long, v array<long>")
    assert [tuple(r) for r in topk.exact_topk(df.where("id = 0"), df).collect()] == [(0, 1, 1, 11)]
    assert topk.exact_topk(df.limit(0), df).count() == 0
    assert topk.exact_topk(df, df.limit(0)).count() == 0
    big = spark.createDataFrame([(0, [1 << 40]), (1, [1 << 40])], "id long, v array<long>")
    with pytest.raises(Exception, match="too large"):
        topk.exact_topk(big, big).count()
