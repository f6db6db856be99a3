import numpy as np
import pytest

from shelfwise.operators import encoders, imaging, models
from shelfwise.session import fresh_path


def exact(x, k):
    """Mean, variances and components of the principal subspace, by singular values."""
    away = x - x.mean(axis=0)
    _, sigma, right = np.linalg.svd(away, full_matrices=False)
    return x.mean(axis=0), sigma[:k] ** 2 / len(x), right[:k]


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    return rng.normal(size=(200, 30)) @ rng.normal(size=(30, 30)) * 0.6 ** np.arange(30) + rng.normal(size=30) * 4


@pytest.fixture(scope="module")
def vectors(spark, points):
    return spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, embedding array<double>")


def test_subspace_is_the_principal_one(vectors, points):
    fitted = encoders.fit_vector_encoder(vectors.repartition(5), 4)
    mean, variances, right = exact(points, 4)
    assert fitted.mean == pytest.approx(mean, abs=1e-5) and fitted.variances == pytest.approx(variances, rel=1e-7)
    assert fitted.components @ fitted.components.T == pytest.approx(right.T @ right, abs=1e-5)
    again = encoders.fit_vector_encoder(vectors.repartition(2), 4)
    assert again.components == pytest.approx(fitted.components, abs=1e-5)


def test_agrees_with_the_square_matrix_fit(vectors, points):
    fitted, model = encoders.fit_vector_encoder(vectors, 3), models.fit_embedding(vectors, 3)
    assert np.abs(fitted.components.T @ model.pc.toArray()) == pytest.approx(np.eye(3), abs=1e-4)
    told = {r["id"]: r["encoded"] for r in encoders.encode_vectors(vectors, fitted, "id").collect()}
    assert np.array([told[i] for i in range(200)]) == pytest.approx(fitted(points), abs=1e-4)


def test_fewer_directions_than_asked(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0, float(i % 3)]) for i in range(40)]
    df = spark.createDataFrame(rows + [(90, [float("nan")] * 4), (91, None)], "id long, embedding array<double>")
    fitted = encoders.fit_vector_encoder(df, 4)
    assert fitted.components.shape == (4, 2)
    assert fitted.errors(np.array([r[1] for r in rows])).max() < 1e-8
    assert encoders.encode_vectors(df, fitted, "id").count() == 40


def test_refusals(spark):
    kind = "id long, embedding array<double>"
    with pytest.raises(ValueError, match="width"):
        encoders.fit_vector_encoder(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], kind), 1)
    with pytest.raises(ValueError, match="rows"):
        encoders.fit_vector_encoder(spark.createDataFrame([], kind), 1)


def test_saved_and_loaded(spark, vectors, points):
    fitted, path = encoders.fit_vector_encoder(vectors, 4), fresh_path(spark, "encoder")
    encoders.save_encoder(spark, fitted, path)
    loaded = encoders.load_encoder(spark, path)
    assert (loaded(points) == fitted(points)).all() and loaded.passes == fitted.passes
    assert loaded.variances.tolist() == fitted.variances.tolist()


@pytest.fixture(scope="module")
def pictures(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, (3, 20, 12, 3))
    mixed = [np.clip((base * rng.dirichlet([1, 1, 1])[:, None, None, None]).sum(axis=0), 0, 255).astype(np.uint8)
             for _ in range(14)]
    rows = [(i, 20, 12, 3, m.tobytes()) for i, m in enumerate(mixed)] + [(99, None, None, None, None)]
    df = spark.createDataFrame(rows, "image_id long, height int, width int, nChannels int, data binary")
    return df, np.stack(mixed)


def test_images_at_full_width(spark, pictures):
    """184,320 values an image: the sums that reach the driver are thin, and the subspace is exact."""
    df, mixed = pictures
    fitted = encoders.fit_image_encoder(df.repartition(3), 2)
    flat = np.stack([imaging.resize(m, 320, 192).ravel() for m in mixed]).astype(float)
    assert fitted.components.shape == (184_320, 2)
    _, variances, right = exact(flat, 2)
    assert fitted.variances == pytest.approx(variances, rel=1e-6)
    assert np.abs(right @ fitted.components) == pytest.approx(np.eye(2), abs=1e-3)
    told = {r["image_id"]: r["embedding"] for r in imaging.embed_images(df, fitted).collect()}
    assert np.array([told[i] for i in range(14)]) == pytest.approx(fitted(flat), abs=1e-3)
    errors = {r["image_id"]: r["mse"] for r in encoders.image_errors(df, fitted).collect()}
    assert [errors[i] for i in range(14)] == pytest.approx(list(fitted.errors(flat)), rel=1e-2, abs=1e-7)


def test_only_thin_sums_are_shuffled(pictures, monkeypatch):
    """The one exchange of a pass carries blocks of sums, no pixels."""
    plans = []
    collect = type(pictures[0]).toArrow

    def told(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(type(pictures[0]), "toArrow", told)
    encoders.fit_image_encoder(pictures[0], 2, 10, 6, passes=2)
    assert len(plans) == 3
    for plan in plans:
        exchanges = [line for line in plan.split("\n") if "Exchange" in line]
        assert len(exchanges) == 1 and "block" in exchanges[0] and "data" not in exchanges[0]
