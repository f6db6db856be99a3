import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import models, recommend
from shelfwise.plans import catalogue
from shelfwise.session import fresh_path
from shelfwise.sinks.files import save_model
from shelfwise.sources.models import load_model


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(11)
    return rng.normal(size=(60, 5)) * [5, 3, 1, 0.1, 0.1] + 2


@pytest.fixture(scope="module")
def rows(spark, points):
    data = [(i, [float(x) for x in p], float(p[0] / 10 - p[1] / 20)) for i, p in enumerate(points)]
    return spark.createDataFrame(data, "product_id long, embedding array<double>, popularity double")


def test_split_takes_the_first_rows(spark, rows):
    for share, n in ((0.85, 51), (0.8, 48), (0.99, 59)):
        marked = models.positional_split(rows.repartition(5), ["product_id"], share).collect()
        assert sorted(r["product_id"] for r in marked if r["is_train"]) == list(range(n))
        assert len(marked) == 60


def test_encoder_spans_the_principal_subspace(spark, rows, points):
    model = models.fit_embedding(rows, 2)
    errors = {r["product_id"]: r["mse"] for r in
              models.reconstruction_error(rows, model, "product_id").collect()}
    centered = points - points.mean(axis=0)
    _, _, vt = np.linalg.svd(centered, full_matrices=False)
    gap = centered - centered @ vt[:2].T @ vt[:2]
    assert [errors[i] for i in range(60)] == pytest.approx(list((gap ** 2).mean(axis=1)))
    assert {len(r["encoded"]) for r in models.encode(rows, model).collect()} == {2}


def test_full_width_reconstructs_exactly(spark, rows):
    model = models.fit_embedding(rows, 5)
    worst = models.reconstruction_error(rows, model, "product_id").agg(F.max("mse")).first()[0]
    assert worst < 1e-20


def test_linear_model_round_trip(spark, rows):
    featured = models.with_features(rows)
    model = models.fit_popularity(featured, kind="linear")
    path = fresh_path(spark, "model")
    save_model(model, path)
    scored = models.predict_popularity(featured, load_model(path))
    worst = scored.agg(F.max(F.abs(F.col("predicted") - F.col("popularity")))).first()[0]
    assert worst < 1e-6


def test_trees_stop_early_on_a_validation_column(spark, rows):
    rng = np.random.default_rng(0)
    noisy = spark.createDataFrame(
        [(i, [float(x) for x in rng.normal(size=3)], float(rng.normal()), i >= 48) for i in range(60)],
        "product_id long, embedding array<double>, popularity double, held_out boolean")
    featured = models.with_features(noisy)
    stopped = models.fit_popularity(featured, validation="held_out", maxIter=15)
    assert models.kept_trees(stopped) < 15
    full = models.fit_popularity(featured, maxIter=4)
    assert models.kept_trees(full) == 4


def test_training_rows_drop_what_cannot_train(spark):
    products = spark.createDataFrame(
        [(i, f"p{i}", str(1 + i % 5), str(i)) for i in range(20)],
        "product_id long, name string, rating string, no_of_reviews string")
    vectors = spark.createDataFrame(
        [(i, [float(i), float("nan") if i == 3 else 1.0]) for i in range(2, 30)],
        "product_id long, embedding array<double>")
    kept = catalogue.training_rows(products, vectors).collect()
    assert sorted(r["product_id"] for r in kept) == [2, *range(4, 20)]
    assert sum(r["is_train"] for r in kept) == int(0.8 * 17)
    model = catalogue.train_popularity(catalogue.training_rows(products, vectors), kind="linear")
    assert model.stages[-1].coefficients.size == 2


def test_recommendations_carry_product_and_predictions(spark, rows):
    products = spark.createDataFrame([(i, f"p{i}", None if i == 0 else "4.5") for i in range(60)],
                                     "product_id long, name string, rating string")
    model = models.fit_popularity(models.with_features(rows), kind="linear")
    shown = recommend.serving_catalogue(products, rows, model=model)
    queries = rows.where("product_id in (0, 9)").withColumnRenamed("product_id", "query_id")
    found = recommend.recommend(queries, shown, 3, model=model).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"]) for r in found] == [(q, k) for q in (0, 9) for k in (1, 2, 3)]
    first = found[0]
    assert first["product_id"] == 0 and first["similarity"] == 1.0 and first["rating"] == 0.0
    assert first["popularity"] == pytest.approx(first["query_popularity"])
    assert found[3]["name"] == "p9" and found[3]["rating"] == 4.5
