from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import language
from shelfwise.llm.quality import held_out
from shelfwise.llm.tokens import split_words
from tests.llm.helpers import no_documents, odd_documents


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    unary, move = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    begin, size = np.array([0, 4, 5]), np.array([4, 1, 4])
    found, used, normal = language.marginals(unary, move, language.Chains.of(begin, size))
    expected, moves, total = np.zeros((9, 3)), np.zeros((3, 3)), 0.0
    for b, n in zip(begin, size):
        paths = list(product(range(3), repeat=n))
        weight = np.array([np.exp(sum(unary[b + i, y] for i, y in enumerate(p)) + sum(move[a, c] for a, c in zip(p, p[1:])))
                           for p in paths])
        total += np.log(weight.sum())
        for p, w in zip(paths, weight / weight.sum()):
            for i, y in enumerate(p):
                expected[b + i, y] += w
            for a, c in zip(p, p[1:]):
                moves[a, c] += w
    assert np.allclose(found, expected) and np.allclose(used, moves) and normal == pytest.approx(total)


def test_chains_cover_all_words():
    words = split_words(pa.array(["a b\nc d e\n\nf", None, "g " * 10]))
    begin, size = language.cut_chains(words, 4)
    spans = sorted(zip(begin.tolist(), size.tolist()))
    assert spans == [(0, 2), (2, 3), (5, 1), (6, 4), (10, 4), (14, 2)]
    at = language.Chains.of(begin, size).at
    assert sorted(np.concatenate(at).tolist()) == list(range(16))


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    return docs, language.train_tagger(docs.where(~held_out(F.col("doc_id"), 4, 2)))


def test_held_out_accuracy(trained):
    docs, tagger = trained
    rows = language.predict_language(docs, tagger).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.97 and rows.score.between(0, 1).all()


def test_code_switched_words(spark, trained):
    docs, tagger = trained
    pick = {r.lang: r.text.split("\n")[0].split()[:12] for r in docs.where("lang in ('en', 'de')").collect()}
    text = " ".join(pick["en"] + pick["de"])
    words = language.tag_words(spark.createDataFrame([(1, text)], "doc_id long, text string"), tagger).orderBy("word_no").toPandas()
    assert len(words) == len(text.split())
    half = len(pick["en"])
    assert (words.lang[:half] == "en").mean() > 0.7 and (words.lang[half:] == "de").mean() > 0.7


def test_odd_rows(spark, trained):
    _, tagger = trained
    docs = odd_documents(spark, ["12 34", "the and of the with", "漢字", "º"])
    rows = {r.doc_id: (r.lang_pred, r.score) for r in language.predict_language(docs, tagger).collect()}
    for none in (1, 2, 3, 6, 100):
        assert rows[none] == ("und", 0.0)
    assert rows[101][0] == "en" and rows[102][0] in tagger.langs and rows[103][0] in tagger.langs
    assert language.train_tagger(no_documents(spark)) is None
    assert language.predict_language(docs, None).where("lang_pred <> 'und' or score <> 0").isEmpty()
    assert language.predict_language(no_documents(spark), tagger).count() == 0
    assert language.train_tagger(docs).langs == ["en"]
