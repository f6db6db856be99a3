import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import quality
from tests.llm.helpers import no_documents, odd_documents


def test_features_by_hand():
    x = quality.features(pa.array(["Good day.", "AB!! CD!!", None, "ab ab ab", "é É ÉÉ\na 7\na 7"]))
    assert x.shape == (5, 12) and np.isfinite(x).all()
    assert x[:, 0].tolist() == pytest.approx([0, 1, 0, 0, np.sqrt(1 / 7)])  # words in capitals
    assert x[1, 2] == pytest.approx(1)  # symbol pairs per word
    assert x[3, 4] == pytest.approx(np.sqrt(2 / 3))  # repeats of the word before
    assert x[4, 9] == pytest.approx(2 / 3)  # different lines
    assert (x[2] == quality.features(pa.array([""]))[0]).all()


def test_pairs_use_every_document():
    for good, bad, pairs in ((7, 3, 10), (3, 7, 10), (5, 5, 100), (4, 1, 2)):
        i, j = quality.preference_pairs(good, bad, pairs)
        assert set(i) == set(range(good)) and set(j) == set(range(bad))
        assert len(set(zip(i.tolist(), j.tolist()))) == len(i)


def test_separates_and_cuts_at_the_quantile():
    rng = np.random.default_rng(1)
    label = (np.arange(400) % 5 > 0).astype(int)
    x = rng.normal(size=(400, 4))
    x[:, 2] += 6 * label
    x[:, 3] = 1  # constant
    model = quality.fit_pairs(x, label)
    assert ((x @ np.array(model.weights) >= model.threshold) == (label == 1)).mean() > 0.99


def test_held_out_accuracy_and_no_leak(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    from shelfwise.llm.queries import quality_model
    model = quality_model(docs, labels)
    rows = quality.score_quality(docs, model).join(labels, "doc_id").toPandas()
    assert ((rows.quality_score >= model.cut) == (rows.quality == 1)).mean() > 0.97
    relabelled = docs.selectExpr("doc_id", "text", "'x' as lang", "'y' as source")
    again = quality.score_quality(relabelled, model).toPandas()
    merged = again.merge(rows, on="doc_id")
    assert (merged.quality_score_x == merged.quality_score_y).all()


def test_odd_rows(spark):
    docs = odd_documents(spark, ["x"])
    labels = spark.createDataFrame([(4, 0), (4, 1), (5, 1), (7, None), (100, 1), (None, 0), (1, 0), (2, 3)],
                                   "doc_id long, quality int")
    model = quality.fit_ranking(docs, labels)
    scores = quality.score_quality(docs, model)
    assert scores.count() == docs.count()
    assert scores.where("quality_score is null or quality_score < 0 or quality_score > 1").isEmpty()
    assert quality.keep_quality(docs, model).columns == docs.columns
    assert quality.score_quality(no_documents(spark), model).count() == 0
    for none in (quality.fit_ranking(no_documents(spark), labels), quality.fit_ranking(docs, labels.where("quality = 1"))):
        assert quality.score_quality(docs, none).where("quality_score <> 1").isEmpty()
