import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import mixing
from tests.llm.helpers import no_documents, odd_documents


def test_word_counts():
    texts = ["a b", None, "", " x\x0by\x0cz\r\n", "ab", "\x1c   é", "tail ", "b"]
    expected = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert mixing.count_words(pa.array(texts, pa.string())).tolist() == expected


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([(1, "b", 100), (2, "a", 10), (3, None, 100), (4, "B", 0), (5, "é", 90)],
                                  "doc_id long, source string, size long")
    rows = {r.source: r for r in mixing.source_targets(sizes).collect()}
    # by code point: B (3), a (1), b (2), é (3), null (1); total 450, caps 0, 20, 200, 180, 200
    assert [rows[s].source_no for s in ("B", "a", "b", "é", None)] == [0, 1, 2, 3, 4]
    assert rows["B"].target == 0 and rows["a"].target == 20 and rows["é"].target == 180
    assert rows["b"].target == pytest.approx(250 * 2 / 3) and rows[None].target == pytest.approx(250 / 3)


def test_permutation_is_one():
    for size in (1, 2, 3, 7, 64, 1000):
        for key in (1, 2):
            out = mixing.permuted(np.arange(size), np.full(size, size), np.full(size, key, np.uint64))
            assert sorted(out) == list(range(size))


def test_mix_on_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix_sources(docs, block=8, shard_slots=512).toPandas()
    assert len(rows) == docs.count() and (rows.taken <= 2 * rows["size"]).all()
    source = docs.select("doc_id", "source").toPandas()
    for _, own in rows.merge(source, on="doc_id").groupby("source", dropna=False):
        assert own["size"].sum() == own.source_size.iloc[0]
        assert abs(own.taken.sum() - own.target.iloc[0]) <= 0.5
    again = mixing.mix_sources(docs.orderBy("text").repartition(3), block=8, shard_slots=512).toPandas()
    key = ["doc_id", "taken"]
    assert rows[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()


def test_texts_are_the_words_taken(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}_{j}" for j in range(5 + 7 * i)), "s" + str(i % 2)) for i in range(8)],
                                 "doc_id long, text string, source string")
    sums = {r.doc_id: r.taken for r in mixing.mix_sources(docs, block=4, shard_slots=16).collect()}
    texts = mixing.mixed_texts(docs, block=4, shard_slots=16).toPandas()
    words = texts.groupby("doc_id").text.apply(lambda t: sum(len(x.split()) for x in t)).to_dict()
    assert words == {k: v for k, v in sums.items() if v}
    assert all(x.startswith(f"w{d}_") for d, t in zip(texts.doc_id, texts.text) for x in t.split())


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = mixing.mix_sources(docs).toPandas()
    assert len(rows) == docs.count()
    assert (rows["size"] == 0).sum() == 3 and (rows.taken[rows["size"] == 0] == 0).all()
    assert mixing.mix_sources(no_documents(spark)).count() == 0
    assert mixing.mix_sources(docs.where("doc_id = 2")).first().target == 0


def plain_targets(sizes):
    """Targets by the definition: (source_size, target) of each source."""
    names = sorted({s for s, _ in sizes if s is not None}) + [None] * any(s is None for s, _ in sizes)
    total = {n: sum(w for s, w in sizes if s == n) for n in names}
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    fixed, left = {}, 1.5 * sum(total.values())
    while True:
        free = [n for n in names if n not in fixed]
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if share[n] > 2 * total[n]]
        if not over:
            return {n: (total[n], float(fixed.get(n, share.get(n)))) for n in names}
        for n in over:
            fixed[n] = 2 * total[n]
            left -= fixed[n]


@pytest.mark.parametrize("shard_slots", [4096, 3])
def test_small_sources_reach_their_targets(spark, shard_slots):
    sizes = [("a", 30), ("b", 20), ("c", 10), ("d", 7), ("d", 913), ("e", 1), ("f", 0), (None, 64), (None, 66), ("g", 5000),
             ("h", 333), ("h", 333), ("i", 128)]
    docs = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(sizes)],
                                 "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in mixing.mix_sources(docs, shard_slots=shard_slots).collect()}
    expected = plain_targets(sizes)
    taken = dict.fromkeys(expected, 0)
    for i, (source, size) in enumerate(sizes):
        assert (rows[i].size, rows[i].source_size) == (size, expected[source][0])
        assert rows[i].target == pytest.approx(expected[source][1]) and rows[i].taken <= 2 * size
        taken[source] += rows[i].taken
    assert all(abs(taken[s] - target) <= 0.5 for s, (_, target) in expected.items())


def test_slots_are_dealt_to_all_tasks(spark):
    targets = spark.createDataFrame([(0, 64 * 50_000, 50_000, 50_000, 64), (1, 64 * 300 + 9, 300, 301, 9)],
                                    "source_no long, source_size long, whole long, slots long, last long")
    plan = mixing.slot_plan(targets, shard_slots=512)
    rows = plan.withColumn("task", F.spark_partition_id()).toPandas()
    assert rows.task.nunique() >= int(spark.conf.get("spark.sql.shuffle.partitions")) - 1
    for source, blocks in ((0, 50_000), (1, 301)):
        own = rows[rows.source_no == source]
        assert sorted(own.slot) == sorted(own.block) == list(range(blocks))
    assert rows["take"].sum() == 64 * 50_300 + 9
