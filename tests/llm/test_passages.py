import random

import numpy as np

from shelfwise.llm import passages
from tests.llm.helpers import no_documents, odd_documents


def covered(rows, sizes):
    out = {i: np.zeros(n, bool) for i, n in sizes.items()}
    for r in rows:
        out[r.doc_id][r.start_word:r.end_word] = True
    return {i: c.nonzero()[0].tolist() for i, c in out.items() if c.any()}


def brute(docs, least=50):
    owners = {}
    for i, words in docs.items():
        for at in range(len(words) - least + 1):
            owners.setdefault(tuple(words[at:at + least]), set()).add(i)
    out = {}
    for i, words in docs.items():
        marks = np.zeros(len(words), bool)
        for at in range(len(words) - least + 1):
            if len(owners[tuple(words[at:at + least])]) > 1:
                marks[at:at + least] = True
        if marks.any():
            out[i] = marks.nonzero()[0].tolist()
    return out


def test_equals_brute_force(spark):
    rng = random.Random(11)
    word = lambda: "w" + str(rng.randint(0, 5000))
    shared = [[word() for _ in range(n)] for n in (49, 50, 51, 64, 120, 20)]
    docs = {}
    for i in range(60):
        words = [word() for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            words += rng.choice(shared) + [word() for _ in range(rng.randint(0, 30))]
        docs[i] = words
    docs[60] = ["same"] * 400
    docs[61] = ["same"] * 180 + [word()]
    docs[62] = shared[4] + shared[4]  # a repeat inside a document, too
    docs[63] = [word() for _ in range(70)] * 3  # only inside: no repeat
    docs[64] = ["a", "b", "c"] * 100
    docs[65] = ["b", "c", "a"] * 40
    # all share a line at the end; two share what stands before it
    line = [word() for _ in range(20)]
    before = [word() for _ in range(40)]
    docs |= {70 + i: [word() for _ in range(40)] + line for i in range(12)} | {90: before + line, 91: before + line}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    rows = passages.repeated_passages(df).collect()
    assert covered(rows, {i: len(w) for i, w in docs.items()}) == brute(docs)
    assert all(r.other != r.doc_id and r.end_word - r.start_word >= 50 for r in rows)


def test_minimisers_cover_every_window():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 50, 400).astype(np.uint64)
    first = np.array([0, 10, 10, 200, 400])
    at = passages.minimisers(hashes, first, 7)
    for a, b in zip(first, first[1:]):
        for i in range(a, b - 6):
            window = set(range(i, i + 7))
            equal = any((hashes[j] == hashes[j - 1]) for j in range(max(i, 1), i + 7))
            assert equal or window & set(at.tolist())
    assert passages.minimisers(np.zeros(100, np.uint64), np.array([0, 100]), 7).tolist() == list(range(7, 100, 7)) or \
        len(passages.minimisers(np.zeros(100, np.uint64), np.array([0, 100]), 7)) <= 15


def test_common_line_with_own_words(spark):
    rng = random.Random(8)
    word = lambda: "w" + str(rng.randint(0, 10 ** 6))
    some = lambda n: [word() for _ in range(n)]
    docs = {}
    for size in (40, 43, 45, 45, 45, 47, 49):  # too short to repeat alone
        line = some(size)
        for _ in range(80):
            docs[len(docs)] = some(40) + line + some(60)
        for before in (0, 3, 50 - size, 50 - size + 3):  # two documents share some words around it, too
            own, after = some(before), some(max(0, 50 - size - before))
            for _ in range(2):
                docs[len(docs)] = some(40) + own + line + after + some(60)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    rows = passages.repeated_passages(df).collect()
    expected = brute(docs)
    assert len(expected) >= 50 and covered(rows, {i: len(w) for i, w in docs.items()}) == expected


def test_runs_of_one_word_at_the_edge_of_a_passage(spark):
    rng = random.Random(9)
    some = lambda n: ["w" + str(rng.randint(0, 10 ** 6)) for _ in range(n)]
    docs = {}
    for n in range(17, 50):
        for shared in (some(50 - n) + ["same"] * n, ["same"] * n + some(50 - n)):
            for _ in range(2):  # the run goes on in the text
                docs[len(docs)] = some(40) + ["same"] * rng.randint(0, 9) + shared + ["same"] * rng.randint(0, 9) + some(40)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    assert covered(passages.repeated_passages(df).collect(), {i: len(w) for i, w in docs.items()}) == brute(docs)


def test_hot_passage(spark):
    rng = random.Random(3)
    shared = " ".join(f"s{i}" for i in range(70))
    texts = [f"{rng.random()} {i} x{i} {shared} y{i}" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = passages.repeated_passages(df).collect()
    assert len(rows) == 300 and all(r.end_word - r.start_word >= 70 for r in rows)


def test_merged_spans_do_not_gather_partners(spark):
    rows = [(1, 0, 60, i) for i in range(5, 900)] + [(1, 60, 120, 7), (1, 119, 180, 3), (1, 130, 140, 9), (2, 0, 50, 1),
                                                     (2, 10, 200, 4), (2, 60, 70, 6), (2, 199, 260, 5), (2, 260, 310, 8)]
    df = spark.createDataFrame(rows, "doc_id long, start_word long, end_word long, other long")
    found = passages.merged(df)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 0, 60, 5), (1, 60, 180, 3), (2, 0, 260, 1), (2, 260, 310, 8)]
    assert "collect_" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_odd_rows(spark):
    docs = odd_documents(spark, ["word " * 100, " ".join(str(i) for i in range(60))])
    rows = passages.repeated_passages(docs).collect()
    assert {r.doc_id for r in rows} == {4, 100}
    assert passages.repeated_passages(no_documents(spark)).count() == 0
