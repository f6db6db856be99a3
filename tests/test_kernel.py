"""The top-k kernel against brute force, with matrices small enough to matter."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfwise.operators import similarity as s


@pytest.fixture(autouse=True)
def tiny_matrices(monkeypatch):
    monkeypatch.setattr(s, "MATRIX_ROWS", 3)
    monkeypatch.setattr(s, "MATRIX_COLUMNS", 4)
    monkeypatch.setattr(s, "FIRST_COLUMNS", 2)


vectors = st.lists(st.lists(st.integers(-1, 2), min_size=3, max_size=3), min_size=1, max_size=40)


def expected(query_ids, queries, ids, candidates, k, metric, exclude_self):
    prepare, score = s._METRICS[metric]
    scores = np.round(score(prepare(queries), prepare(candidates)), 6) + 0.0
    out = []
    for q, row in zip(query_ids, scores):
        ranked = sorted((-x, i) for x, i in zip(row, ids) if not (exclude_self and i == q))
        out += [(q, r + 1, i, -x + 0.0) for r, (x, i) in enumerate(ranked[:k])]
    return sorted(out)


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vectors, vectors, st.integers(1, 6), st.sampled_from(["cosine", "euclidean"]), st.booleans(),
       st.randoms())
def test_block_pair_equals_brute_force(queries, candidates, k, metric, exclude_self, rng):
    queries, candidates = np.array(queries, float), np.array(candidates, float)
    query_ids = np.array(rng.sample(range(100), len(queries)))
    ids = np.array(rng.sample(range(100), len(candidates)))
    prepare, score = s._METRICS[metric]
    found = s._best(s._Block(query_ids, queries, prepare), s._Block(ids, candidates, prepare),
                    score, k, 6, exclude_self)
    got = sorted(zip(*s._merge(found, k))) if found else []
    want = expected(query_ids, queries, ids, candidates, k, metric, exclude_self)
    assert [tuple(map(float, g)) for g in got] == [tuple(map(float, w)) for w in want]


@settings(max_examples=50, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vectors, vectors, st.integers(1, 4), st.integers(1, 5))
def test_merging_blocks_equals_one_block(queries, candidates, k, pieces):
    queries, candidates = np.array(queries, float), np.array(candidates, float)
    prepare, score = s._METRICS["cosine"]
    block = s._Block(np.arange(len(queries)), queries, prepare)
    found = []
    for part in np.array_split(np.arange(len(candidates))[::-1], pieces):
        found += s._best(block, s._Block(part, candidates[part], prepare), score, k, 6, False)
    want = expected(range(len(queries)), queries, range(len(candidates)), candidates, k, "cosine", False)
    assert [tuple(map(float, g)) for g in sorted(zip(*s._merge(found, k)))] == [
        tuple(map(float, w)) for w in want]


def test_all_pairs_cover_both_sides():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(7, 3)), rng.normal(size=(9, 3))
    prepare, score = s._METRICS["cosine"]
    parts = list(s._all_pairs(s._Block(np.arange(7), a, prepare), s._Block(np.arange(9), b, prepare), score, 6))
    pairs = {(q, c) for p in parts for q, c in zip(p[0], p[1])}
    assert len(pairs) == 63 == sum(len(p[0]) for p in parts)
