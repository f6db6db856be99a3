import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import toxicity
from shelfwise.llm.toxicity import LOW_ORDER, ORDER
from tests.llm.helpers import no_documents, odd_documents


def plain_models(docs):
    """Counts by the definition: class counts of the longest order, continuation counts below."""
    top = {0: {}, 1: {}}
    for text, toxic in docs:
        for word in text.split():
            padded = "\x02" * (ORDER - 1) + word + "\x03"
            for i in range(len(word) + 1):
                gram = padded[i:i + ORDER]
                top[toxic][gram] = top[toxic].get(gram, 0) + 1
    grams, lower = set(top[0]) | set(top[1]), {}
    for k in range(LOW_ORDER, 0, -1):
        counts = {}
        for gram in grams:
            counts[gram[-k:]] = counts.get(gram[-k:], 0) + 1
        lower[k], grams = counts, set(counts)
    return top, lower


def plain_chance(context, char, counts, below):
    total = sum(n for g, n in counts.items() if g[:-1] == context)
    if not total:
        return below
    kinds = sum(1 for g in counts if g[:-1] == context)
    return max(counts.get(context + char, 0) - 0.75, 0) / total + 0.75 * kinds / total * below


@pytest.fixture(scope="module")
def case(spark):
    docs = [("the cat sat on the mat", 0), ("a dog ran and the cat ran", 0), ("you vile badcat", 1), ("badness and badly the", 1)]
    df = spark.createDataFrame(docs, "text string, toxic int")
    return docs, toxicity.fit_models(df)


def test_likelihoods_equal_the_definition(case):
    docs, models = case
    top, lower = plain_models(docs)
    words = toxicity.split_words(pa.array(["cat bad badger the z"]))
    found = models.differences(words, np.arange(5))
    for word, value in zip("cat bad badger the z".split(), found):
        padded, expected = "\x02" * (ORDER - 1) + word + "\x03", 0.0
        for i in range(len(word) + 1):
            gram = padded[i:i + ORDER]
            chance = 1e-4
            for k in range(1, LOW_ORDER + 1):
                chance = plain_chance(gram[-k:-1], gram[-1], lower[k], chance)
            expected += np.log(plain_chance(gram[:-1], gram[-1], top[1], chance))
            expected -= np.log(plain_chance(gram[:-1], gram[-1], top[0], chance))
        assert value == pytest.approx(expected, rel=1e-4)
    assert found[1] > 1 > found[3]


def test_every_gram_and_order_has_its_own_count(spark):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 12)) for _ in range(60_000)]
    docs = [(" ".join(words[i:i + 600]), i // 600 % 2) for i in range(0, len(words), 600)]
    models = toxicity.fit_models(spark.createDataFrame(docs, "text string, toxic int"))
    grams, heads = {0: {}, 1: {}}, set()
    for text, toxic in docs:
        for word in text.split():
            padded = "\x02" * (ORDER - 1) + word + "\x03"
            for i in range(len(word) + 1):
                gram = padded[i:i + ORDER]
                grams[toxic][gram] = grams[toxic].get(gram, 0) + 1
                heads.add(gram[:-1])
    assert len(models.shared) == ORDER - 1
    for table, own in ((models.toxic, grams[1]), (models.ordinary, grams[0])):
        assert len(table.keys) == len(set(grams[0]) | set(grams[1])) > 500_000 and len(table.heads) == len(heads)
        assert sorted(own.values()) == sorted(table.grams[table.grams > 0].astype(int).tolist())


def test_evidence(case):
    _, models = case
    texts = ["bad bad the", None, "", "the badly cat dog", "!!"]
    x = toxicity.evidence(pa.array(texts, pa.string()), models)
    told = {w: models.differences(toxicity.split_words(pa.array([w])), np.arange(1))[0] for w in "bad the badly cat dog".split()}
    assert x[0, 0] == pytest.approx((2 * told["bad"] + told["the"]) / 3) and x[0, 1] == pytest.approx(told["bad"])
    assert x[0, 2] == pytest.approx((told["bad"] + told["the"]) / 2)
    best = sorted((told[w] for w in "the badly cat dog".split()), reverse=True)
    assert x[3, 1:4].tolist() == pytest.approx([best[0], np.mean(best[:2]), np.mean(best)])
    assert not x[[1, 2, 4]].any()


def test_held_out_toxic_documents(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.training_model(docs, labels)
    rows = toxicity.score_toxicity(docs, model).join(labels, "doc_id").toPandas()
    ranks, toxic = rows.toxic_score.rank(), rows.toxic == 1
    area = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert area > 0.8 and rows.toxic_score.between(0, 1).all()


def test_odd_rows(spark):
    docs = odd_documents(spark, ["vile words"])
    labels = spark.createDataFrame([(4, 0), (5, 0), (5, 1), (7, None), (100, 1), (None, 0), (1, 0), (2, 7)], "doc_id long, toxic int")
    from pyspark.sql import functions as F
    model = toxicity.fit_toxicity(docs, labels, F.col("doc_id") == 7)
    scores = toxicity.score_toxicity(docs, model)
    assert scores.count() == docs.count()
    assert scores.where("toxic_score is null or toxic_score < 0 or toxic_score > 1").isEmpty()
    assert toxicity.fit_toxicity(no_documents(spark), labels, F.lit(False)) is None
    assert toxicity.fit_toxicity(docs, labels.where("toxic = 0"), F.lit(False)) is None
    assert toxicity.score_toxicity(docs, None).where("toxic_score <> 0").isEmpty()
    assert toxicity.score_toxicity(no_documents(spark), model).count() == 0


@pytest.mark.parametrize("limit", [1 << 22, 12, 0])
def test_kept_words_change_nothing(case, monkeypatch, limit):
    monkeypatch.setattr(toxicity, "KNOWN_WORDS", limit)
    _, models = case
    rng, known = np.random.default_rng(1), toxicity.Known(models)
    pool = ["cat", "bad", "vile", "the", *("".join(rng.choice(list("abcde"), 4)) for _ in range(60))]
    for _ in range(12):
        texts = pa.array([" ".join(rng.choice(pool, rng.integers(0, 9))) for _ in range(5)])
        assert (toxicity.evidence(texts, known) == toxicity.evidence(texts, models)).all()
    assert len(known.keys) == len(known.told) and (np.diff(known.keys.astype(object)) > 0).all()
