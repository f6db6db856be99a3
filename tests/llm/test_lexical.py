import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import lexical, queries
from shelfwise.session import materialize
from tests.llm.helpers import no_documents, odd_documents
from tools.check_queries import compare, connect

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def scores(docs, items):
    """(item, doc) -> score by the formula, on rows of (id, text)."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    N, L = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    pools = {}
    for i, t in items:
        pools.setdefault(i, set()).update(terms(t))
    for item, pool in pools.items():
        for doc, c in counts:
            m = 10 + (90 * sum(c.values()) * N) // L
            yield item, doc, sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                                 * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in pool & set(c))


def brute(docs, items, k):
    found = {}
    for item, doc, score in scores(docs, items):
        if score > 0:
            found.setdefault(item, []).append((-score, doc is None, doc or 0, doc))
    return sorted(((item, r, x[3], -x[0]) for item, rows in found.items()
                   for r, x in enumerate(sorted(rows)[:k], 1)), key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Été", "ÀB", "x1"]
    weight = [1 / (i + 1) for i in range(len(words))]
    texts = [rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weight, k=rng.choice([1, 5, 30, 200]))) for _ in range(n)]
    texts += [texts[3]] * (n // 2) + [None, "", "  !", "W1 w1 W1", "w399 " * 3000]
    docs = list(enumerate(texts))
    docs += [(docs[0][0], "w7 w8"), (docs[1]), (docs[1]), (None, "w9 w390 w391 w392")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 20])))) for i in range(50)]
    items += [(0, "w390"), (90, None), (91, ""), (92, "nowhere"), (93, docs[3][1]), (94, "w1 W1 w1"), (None, "w392 w1")]
    return docs, items


@pytest.mark.parametrize("k,tile,partitions", [(10, 20_000, 3), (3, 20, 1)])
def test_equals_brute_force(spark, k, tile, partitions):
    docs, items = corpus(k)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions)
    b = spark.createDataFrame(items, "item_id long, text string")
    found = lexical.search(d, b, k, tile)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, items, k)


def test_shuffled_pairs_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BROADCAST_PAIRS", 0)
    docs, items = corpus(5, 80)
    found = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, items, 10)


def test_bounds_hold_and_are_close(spark):
    """No score is above its bound, and the bounds exclude most documents of an item."""
    docs, items = corpus(6, 2000)
    texts = [t for _, t in docs]
    pending = lexical.Pending()
    pending.add(np.arange(len(docs)), lexical.terms_of(pa.array(texts, pa.large_string())))
    counts = [Counter(terms(t)) for t in texts]
    held = Counter(t for c in counts for t in c)
    whole = lexical.Corpus(sum(map(bool, counts)), sum(sum(c.values()) for c in counts))
    asked = lexical.Items.of([i for i, _ in items], [t for _, t in items])
    names = {int(lexical.terms_of(pa.array([t], pa.large_string())).hash[0]): t for t in held}
    asked = asked.weighed({i: held[names[int(h)]] for i, h in enumerate(asked.terms) if int(h) in names}, whole)
    ids = [(n, t) for n, (_, t) in enumerate(docs)]
    exact = {(i, d): s for i, d, s in scores(ids, items)}
    tenth = {i: sorted((s for (j, _), s in exact.items() if j == i), reverse=True)[9] for i in asked.ids}
    total = kept = above = 0
    chunks = list(asked.chunks())
    for keys, sizes, height, bitmap in pending.blocks():
        for own, bound in lexical.bounds(asked, whole, sizes, height, bitmap, chunks):
            for i, name in enumerate(asked.ids[own]):
                for key, value in zip(keys.tolist(), bound[i]):
                    score = exact.get((name, key), 0)
                    assert value >= score
                    total += 1
                    kept += value >= max(tenth[name], 1)
                    above += score >= max(tenth[name], 1)
    assert total == sum(map(bool, counts)) * len(asked.ids)
    assert kept <= 1.5 * above + 0.02 * total


def test_levels():
    assert lexical.levels(1).tolist() == [1, 2] and lexical.levels(5).tolist() == [1, 2, 3, 4, 6]
    assert lexical.levels(6).tolist() == [1, 2, 3, 4, 6, 8]


def test_blocks_hold_all_documents(spark):
    docs, _ = corpus(8, 500)
    index = materialize(lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string")))
    rows = index.collect()
    assert sorted(n for r in rows for n in r["sizes"]) == sorted(n for n in (len(terms(t)) for _, t in docs) if n)
    assert all(len(r["bitmap"]) == r["height"] * -(-len(r["keys"]) // 8) for r in rows)


def test_odd_documents(spark):
    items = spark.createDataFrame([(1, "Same words"), (2, "id")], "item_id int, text string").selectExpr(
        "*", "1 as doc_id", "2 as key", "3 as rank", "4 as score")
    found = lexical.search(odd_documents(spark), items)
    assert dict(found.dtypes) == {"item_id": "int", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    rows = [tuple(r)[:3] for r in found.collect()]
    assert sorted(rows, key=str) == [(1, 1, None), (1, 2, 5), (1, 3, 5), (2, 1, None)]
    assert lexical.search(no_documents(spark), items).count() == 0
    assert lexical.search(odd_documents(spark), items.limit(0)).count() == 0


def test_query_equals_its_sql(spark, sf_dir):
    assert compare(queries.op13(spark, sf_dir), connect(sf_dir), queries.OP13_SQL) == ""
