import random

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import decontaminate as dc
from tests.llm.helpers import no_documents, odd_documents


def weight(run):
    return sum(2 if len(w.encode()) > 3 else 1 for w in run)


def alike(item, window):
    counts = []
    for words in (item, window):
        own = {}
        for i in range(max(1, len(words) - 4)):
            run = tuple(words[i:i + 5])
            own[run] = own.get(run, 0) + 1
        counts.append(own)
    a, b = counts
    total = lambda c: sum(weight(r) * n for r, n in c.items())
    return sum(weight(r) * min(n, b.get(r, 0)) for r, n in a.items()) / max(total(a), total(b))


@pytest.fixture(scope="module")
def case():
    rng = random.Random(8)
    vocabulary = ["the", "of", "and", "a"] * 20 + [f"word{i}" for i in range(400)]
    words = lambda n: rng.choices(vocabulary, k=n)
    items = [words(n) for n in (15, 20, 20, 33, 47, 59, 3, 120)]
    docs = [words(rng.randint(0, 300)) for _ in range(40)]
    for n in range(40):
        item = list(items[n % len(items)])
        if n % 3 and len(item) > 10:
            item[rng.choice([0, -1, len(item) // 2])] = "edited"
        if n % 5 == 4:
            item = item[:len(item) // 2]
        at = rng.randint(0, len(docs[n]))
        docs[n][at:at] = item
    return items, docs


def test_equals_brute_force(case):
    items, docs = case
    index = dc.Index.of(pa.array(range(len(items))), [" ".join(i) for i in items]).listed()
    found = {(h.row, h.item): h.similarity for h in dc.find_items(pa.array([" ".join(d) for d in docs]), index)}
    expected = {}
    for d, words in enumerate(docs):
        for i, item in enumerate(items):
            best = max((alike(item, words[a:a + len(item)]) for a in range(max(1, len(words) - len(item) + 1))), default=0)
            if words and best >= dc.SIMILAR - 1e-9:
                expected[d, i] = best
    assert found.keys() == expected.keys() and len(found) > 20
    assert all(found[k] == pytest.approx(expected[k]) for k in found)


def test_index_returns_all_within_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    found = prints[rng.integers(300, size=3000)]
    for i in range(len(found)):
        bits = rng.choice(64, rng.integers(0, 25), replace=False)
        found[i] ^= np.uint64(sum(1 << int(b) for b in bits))
    distance = np.bitwise_count(found[:, None] ^ prints)
    expected = {(w, i): distance[w, i] for w, i in zip(*np.nonzero(distance <= dc.RADIUS))}
    pairs = [p for w, i, d in dc.Lists.of(prints).within(found, prints) for p in zip(zip(w.tolist(), i.tolist()), d)]
    assert len(pairs) > 1000 and len(pairs) == len(dict(pairs)) and dict(pairs) == expected
    assert [w for (w, _), _ in pairs] == sorted(w for (w, _), _ in pairs)


def test_index_selects_among_many_items():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(50_000)}" for _ in range(rng.randint(90, 110))) for _ in range(20_000)]
    index = dc.Index.of(pa.array(range(len(texts))), texts).listed()
    windows = np.random.default_rng(2).integers(0, 2 ** 63, 2000).astype(np.uint64)
    blocks = windows.view("<u2").reshape(-1, dc.BLOCKS)
    compared = sum(lists.count[i][blocks[:, i]].mean() for lists in index.lists for i in range(dc.BLOCKS))
    assert compared < 0.05 * len(texts)
    asked = [3, 777, 19_999]
    hits = dc.find_items(pa.array([f"before {texts[i]} after" for i in asked]), index)
    assert [(h.row, h.item, h.start, h.similarity) for h in hits] == [(r, i, 1, 1.0) for r, i in enumerate(asked)]


def test_recall_near_the_threshold():
    rng = random.Random(6)
    draw = lambda n: [f"word{rng.randrange(3000)}" for _ in range(n)]
    items = [draw(100) for _ in range(150)]
    index = dc.Index.of(pa.array(range(150)), [" ".join(t) for t in items]).listed()
    found = {}
    for kind, least in (("replaced", 0.9), ("cut", 0.95)):
        docs = []
        for item in items:
            at = rng.randint(0, 85)
            copy = item[:at] + draw(15) + item[at + 15:] if kind == "replaced" else item[:84] + draw(16)
            docs.append(draw(rng.randint(20, 80)) + copy + draw(40))
        hits = {(h.row, h.item) for h in dc.find_items(pa.array([" ".join(d) for d in docs]), index)}
        alike_enough = [i for i in range(150) if max(
            alike(items[i], docs[i][a:a + 100]) for a in range(len(docs[i]) - 99)) >= dc.SIMILAR]
        found[kind] = sum((i, i) in hits for i in alike_enough) / len(alike_enough)
        assert len(alike_enough) > 60 and found[kind] >= least, found


def test_item_ids_keep_their_type(spark):
    bench = spark.createDataFrame([("item-a", " ".join(f"word{i}" for i in range(30)))], "item_id string, text string")
    docs = spark.createDataFrame([(1, bench.first().text), (2, "clean")], "doc_id long, text string")
    found = dc.find_contamination(docs, bench)
    assert found.schema["item_id"].dataType.simpleString() == "string"
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, "item-a")]
    assert [r.doc_id for r in dc.drop_contaminated(docs, bench).collect()] == [2]


def test_query_forms(spark, case):
    items, docs = case
    df = spark.createDataFrame([(i, " ".join(d).upper(), 1) for i, d in enumerate(docs)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, ", ".join(t)) for i, t in enumerate(items)] + [(90, None), (91, "")],
                                  "item_id long, text string")
    found = dc.find_contamination(df, bench)
    one = {(r.doc_id, r.item_id, r.start_word) for r in found.collect()}
    blocks = {(r.doc_id, r.item_id, r.start_word) for r in dc.find_contamination(df, bench, items=2).collect()}
    assert one == blocks and len(one) > 20
    kept = dc.drop_contaminated(df, bench, items=3)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {d for d, _, _ in one}


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, "same text here"), (None, "word " * 70), (3, "")], "item_id long, text string")
    docs = odd_documents(spark)
    rows = sorted(((r.doc_id, r.item_id) for r in dc.find_contamination(docs, bench).collect()), key=str)
    assert rows == [(4, None), (5, 1), (5, 1)]
    assert dc.find_contamination(no_documents(spark), bench).count() == 0
    assert dc.find_contamination(docs, bench.limit(0)).count() == 0
    assert dc.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_clashing_columns_are_kept(spark):
    item = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"before {item} after", "a", 2), (2, "clean text", "b", 3)],
                                 "doc_id long, text string, lowered string, _lowered int")
    found = dc.drop_contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert found.columns == docs.columns and [tuple(r) for r in found.collect()] == [(2, "clean text", "b", 3)]
