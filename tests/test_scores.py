import math

import pytest

from shelfwise.operators import aggregate, score


def rated(spark, rows):
    return spark.createDataFrame(rows, "product_id long, rating string, no_of_reviews string")


def scores(df):
    return {r["product_id"]: r["popularity"] for r in df.collect()}


def metric(n, s):
    return s * (15 + n) / (n + 5 * s + 1e-5)


def test_metric_and_defaults(spark):
    df = rated(spark, [(1, "4", "20"), (2, None, "20"), (3, "4", "x")])
    raw = scores(score.score_popularity(df, 3.0, scale=False))
    assert raw == pytest.approx({1: metric(20, 4), 2: metric(20, 3), 3: metric(10, 4)})
    serving = scores(score.score_popularity(df, 0.0, scale=False))
    assert serving[2] == 0.0


def test_reviews_default_when_the_column_is_absent(spark):
    df = rated(spark, [(1, "4", "20")]).drop("no_of_reviews")
    assert scores(score.score_popularity(df, 3.0, scale=False))[1] == pytest.approx(metric(10, 4))


def test_scaling_stays_in_range(spark):
    df = rated(spark, [(i, str(1 + i % 5), str(i)) for i in range(50)])
    values = scores(score.score_popularity(df, 3.0)).values()
    assert min(values) == 0.0 and max(values) == 1.0


def test_constant_popularity_scales_to_zero(spark):
    df = rated(spark, [(1, "4", "5"), (2, "4", "5")])
    assert scores(score.score_popularity(df, 3.0)) == {1: 0.0, 2: 0.0}


def test_all_ratings_missing(spark):
    df = rated(spark, [(1, None, "5"), (2, "", "8")])
    assert scores(score.score_popularity(df, 3.0)) == {1: 0.0, 2: 1.0}


def test_infinite_rating_is_dropped_before_scaling(spark):
    df = rated(spark, [(1, "inf", "5"), (2, "4", "5"), (3, "2", "5")])
    got = scores(score.score_popularity(df, 3.0))
    assert got[1] is None and {got[2], got[3]} == {0.0, 1.0}


def test_range_can_come_from_training_rows(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (20.0,)], "v double")
    scaled = score.scale_minmax(df, "v", fit_on=df.where("v < 10"))
    assert [r["v"] for r in scaled.orderBy("v").collect()] == [0.0, 1.0, 4.0]


def test_scaling_uses_no_join(spark):
    df = spark.createDataFrame([(0.0,), (5.0,)], "v double")
    plan = score.scale_minmax(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_rank_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(2, 0.5), (1, 0.5), (3, 0.9), (4, None)], "product_id int, popularity double")
    assert [r["product_id"] for r in score.rank_by_popularity(df).collect()] == [3, 1, 2, 4]
    assert [r["product_id"] for r in score.rank_by_popularity(df, limit=2).collect()] == [3, 1]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "label double, prediction double")
    row = aggregate.regression_metrics(df).first()
    assert row["mse"] == 2.5 and math.isclose(row["mae"], 1.5)
