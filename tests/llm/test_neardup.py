import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import neardup
from shelfwise.llm.graph import components
from tests.llm.helpers import no_documents, odd_documents


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=14), st.integers(0, 8))
def test_banded_distance(a, b, band):
    assert neardup.banded_distance(a, b, band) == min(edit(a, b), band + 1)


def test_banded_distance_of_repeats():
    a, b = [1] * 300 + [2] * 40 + list(range(200)), [1] * 290 + [2] * 45 + list(range(3, 200))
    assert neardup.banded_distance(a, b, 60) == edit(a, b)


def runs(text):
    words = text.lower().split()
    return [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))]


def family(rng, size, copies, edits):
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 4) + str(rng.randint(0, 99)) for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = "new" + str(rng.randint(0, 10 ** 6))
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_classes_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    passage = " ".join(f"common{i}" for i in range(30))
    texts = []
    for n, size in enumerate((60, 90, 150, 40, 300, 25, 7)):
        texts += family(rng, size, 14, 3)
    for size in (9, 10, 14, 20):  # short texts with a word changed at an end
        base = [f"{c}{rng.randint(0, 999)}" for c in "qwertyuiopasdfghjklz"[:size]]
        texts += [" ".join(base), " ".join([*base[:-1], "else"]), " ".join(["now", *base[1:]])]
    texts += [f"{passage} {x}" for x in (" ".join(family(rng, 25, 0, 0)) for _ in range(25))]  # alike, but not enough
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    all_runs = [runs(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            longer = max(len(all_runs[i]), len(all_runs[j]))
            if len(set(all_runs[i]) & set(all_runs[j])) >= 0.5 * longer and edit(all_runs[i], all_runs[j]) <= 0.2 * longer + 1e-9:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert found == {i: root(i) for i in range(len(texts))}


def test_hot_group_is_one_class_in_linear_work(spark, monkeypatch):
    rng = random.Random(2)
    texts = family(rng, 120, 400, 2) + ["exact copy of a text that is long enough to have runs"] * 300
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = []
    compared = neardup._compared
    monkeypatch.setattr(neardup, "_compared", lambda p, t: pairs.append(p.count()) or compared(p, t))
    found = neardup.near_duplicates(df).toPandas()
    assert found.class_id.nunique() == 2 and sum(pairs) < 30 * len(texts)


def test_common_passage_brings_few_pairs(spark, monkeypatch):
    """Documents that share a passage, but are not linked, are compared a few times each, not with each other."""
    rng = random.Random(3)
    passage = " ".join(f"common{i}" for i in range(60))
    texts = [f"{passage} {family(rng, 50, 0, 0)[0]}" for _ in range(400)]
    texts += family(rng, 110, 30, 2)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = []
    compared = neardup._compared
    monkeypatch.setattr(neardup, "_compared", lambda p, t: pairs.append(p.count()) or compared(p, t))
    found = neardup.near_duplicates(df).toPandas()
    assert found.class_id.nunique() == 401
    assert sum(pairs[1:]) < len(texts) and sum(pairs) < 40 * len(texts)


def test_classes_made_already_save_comparisons(spark, monkeypatch):
    """Near copies of which many are not linked to a leader: pairs of mixed buckets, each made once."""
    texts = family(random.Random(4), 120, 300, 7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = []
    compared = neardup._compared
    monkeypatch.setattr(neardup, "_compared", lambda p, t: pairs.append(p.count()) or compared(p, t))
    found = neardup.near_duplicates(df).toPandas()
    assert found.class_id.nunique() == 74 and sum(pairs[1:]) < 15 * len(texts)


@pytest.mark.parametrize("keys", [neardup.KEYS, 1])
def test_pairs_of_several_buckets_are_made_once(spark, monkeypatch, keys):
    monkeypatch.setattr(neardup, "KEYS", keys)
    rows = [(key, doc, 9, int(doc == 5 or doc == 6), 1 if doc < 5 else doc) for key in (1, 2, 3) for doc in range(1, 8)]
    active = spark.createDataFrame(rows, "key long, doc long, n long, settled int, class long")
    found = [tuple(sorted(r)) for r in neardup._pairs(active, None).collect()]
    assert sorted(found) == [(a, b) for a in range(1, 8) for b in range(max(5, a + 1), 8) if (a, b) != (5, 6)]
    few = {tuple(sorted(r)) for r in neardup._pairs(active, 1).collect()}
    assert few < set(found) and len(few) == 2  # 5 leads: the first of classes 1 and 7


def test_edited_texts_of_all_lengths(spark):
    """Borderline links of short and long texts are found: at least 0.98 of them at each length."""
    rng = random.Random(9)
    for words in (5, 6, 7, 8, 9, 10, 12, 14, 18, 25, 40, 60, 80, 120):
        n = max(1, words - 4)
        missed = total = 0
        for _ in range(120):
            base = [f"w{rng.randint(0, 10 ** 9)}" for _ in range(words)]
            cut = int(0.2 * n + 1e-9)
            other = base[:words - cut] + [f"x{rng.randint(0, 10 ** 9)}" for _ in range(cut)]  # `cut` runs differ
            if rng.random() < 0.5:
                base, other = base[::-1], other[::-1]
            rows = []
            for text in (base, other):
                held = neardup.split_words(neardup.pa.array([" ".join(text)]))
                runs_, first = neardup.grams(held.hash, held.first, neardup.GRAM)
                rows.append(set(neardup.bucket_keys(np.diff(first), neardup.order_minhash(runs_, first))[0].tolist()))
            total += 1
            missed += not rows[0] & rows[1]
        assert missed <= 0.02 * total, (words, missed)


def test_order_is_part_of_the_picks():
    a = np.arange(40, dtype=np.uint64) * np.uint64(977)
    same, other = (neardup.order_minhash(neardup.mix(x), np.array([0, 40]))[4] for x in (a, a[::-1].copy()))
    assert (same == neardup.order_minhash(neardup.mix(a), np.array([0, 40]))[4]).all() and (same != other).mean() > 0.7


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 100), (300, 300), (7, 400), (500, 400)] + \
            [(1000, 1001 + i) for i in range(50)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {i: 1 for i in [*range(1, 61), 400, 500]} | {100: 100, 200: 100} | {1000 + i: 1000 for i in range(51)}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    docs = odd_documents(spark, ["same TEXT, here!", "a", "word " * 29_000])
    rows = sorted(((r.doc_id, r.class_id) for r in neardup.near_duplicates(docs).collect()), key=str)
    assert rows == sorted([(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (5, 5), (None, None), (6, 6), (7, 7), (100, 5),
                           (101, 7), (102, 4)], key=str)
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 6, 7, None], key=str)
    assert neardup.near_duplicates(no_documents(spark)).count() == 0


@pytest.mark.parametrize("texts,classes", [
    ([(1, "one two three four five six"), (1, "another text of some more words"), (2, "another text of some more words")], {1}),
    ([(5, "x y z"), (3, "x y z"), (4, None)], {3, 4}),
])
def test_shared_ids(spark, texts, classes):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.class_id for r in neardup.near_duplicates(df).collect()} == classes


def test_rows_of_one_id_are_kept_by_text(spark):
    rows = [(5, "one two three four five six"), (5, "another text of some more words"),
            (7, "Another text of some more words!"), (9, ""), (9, None), (9, ""), (8, "one two three four five six")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                               "doc_id long, text string, kept string, _kept int, row int")
    found = neardup.keep_first(df)
    assert found.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == sorted(
        [rows[0], rows[1], (9, ""), (9, None)], key=str)
