import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import queries, whitening
from shelfwise.llm.topk import whole_vector


def frame(spark, rows):
    return spark.createDataFrame([(k, [int(v) for v in x] if x is not None else None) for k, x in rows],
                                 "key long, v array<long>")


def plain(x):
    """Eigenvalues and vectors of the covariance of the different rows, by the singular values of all of them."""
    fit = np.unique(x, axis=0).astype(float)
    _, sigma, right = np.linalg.svd(fit - fit.mean(axis=0), full_matrices=False)
    values = sigma ** 2 / len(fit)
    return len(fit), fit.sum(axis=0), values, right.T, values.sum()


def check(found, x, keys, tolerance=1e-8):
    n, sums, values, vectors, trace = plain(x)
    rows = {}
    for r in found.collect():
        rows.setdefault((r["key"], r["component"]), []).append(r)
    for key, v in zip(keys, x):
        for c in range(1, min(4, x.shape[1]) + 1):
            for r in rows[key, c]:
                assert r["n"] == n and r["identity_error"] < 1e-8
                assert r["explained"] == pytest.approx(values[c - 1] / trace, rel=1e-7)
                own = (v - sums / n) @ vectors[:, c - 1] / np.sqrt(values[c - 1])
                assert abs(r["whitened"]) == pytest.approx(abs(own), rel=1e-6, abs=tolerance)
                assert r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums))
    return rows


def test_equals_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(400, 7)) @ rng.normal(size=(7, 7)) * 90 + rng.normal(size=7) * 500).astype(int)
    x = np.concatenate([x, np.repeat(x[:1], 200, axis=0)])  # a third are copies
    rows = check(whitening.whiten(frame(spark, enumerate(x)).repartition(5)), x, range(len(x)))
    assert len(rows) == 4 * len(x)


def test_one_sign_for_all_rows(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(-50, 50, (60, 3))
    found = whitening.whiten(frame(spark, enumerate(x)).repartition(4)).collect()
    n, sums, values, vectors, _ = plain(x)
    for c in (1, 2, 3):
        signs = {np.sign(r["whitened"]) * np.sign((x[r["key"]] - sums / n) @ vectors[:, c - 1])
                 for r in found if r["component"] == c and abs(r["whitened"]) > 1e-6}
        assert len(signs) == 1


@pytest.mark.parametrize("spread", [1, 1000, 1_000_000])
def test_ill_conditioned_and_large_numbers(spark, spread):
    rng = np.random.default_rng(7)
    x = np.floor(rng.normal(size=(300, 5)) * np.array([1, 7, spread, 3 * spread, 40])).astype(int)
    check(whitening.whiten(frame(spark, enumerate(x))), x, range(len(x)), 1e-6)


def test_columns_without_variance(spark):
    rng = np.random.default_rng(8)
    a = rng.integers(-90, 90, (50, 2))
    x = np.column_stack([a, a.sum(axis=1), np.full(50, 13), -2 * a[:, 0]])  # rank 2 of 5
    rows = whitening.whiten(frame(spark, enumerate(x))).collect()
    assert {r["component"] for r in rows} == {1, 2}
    n, _, values, _, trace = plain(x)
    assert {round(r["explained"], 9) for r in rows} == {round(v / trace, 9) for v in values[:2]}
    assert max(r["identity_error"] for r in rows) < 1e-9


def test_fewer_rows_than_columns(spark):
    x = np.array([[1, 2, 3, 4, 5, 6], [2, 2, 9, 4, 0, 1], [7, 1, 1, 1, 1, 1]])
    rows = whitening.whiten(frame(spark, enumerate(x))).collect()
    assert {r["component"] for r in rows} == {1, 2} and max(r["identity_error"] for r in rows) < 1e-9


def test_odd_rows(spark):
    rows = [(1, [1, 2]), (1, [1, 2]), (None, [3, 9]), (2, [-4, 5]), (3, None), (4, [1]), (5, []), (6, [0, 0])]
    df = frame(spark, rows).withColumn("n", F.lit(1)).withColumn("whitened", F.lit("x"))
    df = df.unionByName(spark.createDataFrame([(7, [None, 1], 1, "x")], df.schema))
    found = whitening.whiten(df)
    got = sorted(((r["key"], r["component"]) for r in found.collect()), key=str)
    assert got == sorted([(k, c) for k in (1, 1, None, 2, 6) for c in (1, 2)], key=str)
    assert {r["n"] for r in found.collect()} == {4}
    assert whitening.whiten(df.limit(0)).columns == found.columns and not whitening.whiten(df.limit(0)).count()
    assert not whitening.whiten(frame(spark, [(1, [5, 5]), (2, [5, 5])])).count()
    assert not whitening.whiten(frame(spark, [(1, []), (2, None)])).count()


def test_deviation_beyond_a_long_is_null():
    middle = whitening.Centre(3_000_000_000, np.array([0, 0]))
    assert middle.deviations(np.array([[1, 1], [2, 0], [900, 900]])) == [None, None, None]
    assert middle.deviations(np.array([[1, 0], [0, 0]])) == [9 * 10 ** 18, 0]
    assert middle.of(np.array([[10 ** 10, 1]])).tolist() == [[1e10, 1.0]]


def test_triangular_solve():
    rng = np.random.default_rng(9)
    a, u, v = rng.normal(size=(9, 4)), np.triu(rng.normal(size=(4, 4))) + 3 * np.eye(4), np.triu(np.ones((4, 4)))
    assert np.allclose(whitening.triangular_solve(a, [u, v]), a @ np.linalg.inv(u) @ np.linalg.inv(v))


def test_query_on_whole_table(spark, sf_dir):
    found = queries.op11(spark, sf_dir)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", whole_vector(F.col("embedding")).alias("v"))
    rows = table.collect()
    check(found.withColumnRenamed("vec_id", "key"), np.array([r["v"] for r in rows]), [r["vec_id"] for r in rows])
