import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import ordinals


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows of which one group holds two thirds; sparse, unordered keys."""
    rng = random.Random(7)
    keys = rng.sample(range(10**12), 3000)
    rows = [("hot" if i % 3 else f"g{i % 90}", k, rng.randint(-5, 9)) for i, k in enumerate(keys)]
    rows += [(None, 5, 1), (None, 2, 1)]
    return spark.createDataFrame(rows, "g string, k long, v long").repartition(6)


def expected(df, value, group):
    seen, out = {}, {}
    for r in sorted(df.collect(), key=lambda r: r["k"]):
        g = r["g"] if group else 0
        seen[g] = seen.get(g, 0) + value(r)
        out[(r["g"], r["k"])] = seen[g]
    return out


def test_row_ordinal_is_dense_and_ordered(spark, skewed):
    for partitions in (1, 3, 8):
        got = ordinals.row_ordinal(skewed, ["k"], partitions=partitions).orderBy("k").collect()
        assert [r["ordinal"] for r in got] == list(range(skewed.count()))


def test_row_ordinal_descending(spark, skewed):
    got = ordinals.row_ordinal(skewed, [F.desc("k")], partitions=4).orderBy(F.desc("k")).collect()
    assert [r["ordinal"] for r in got] == list(range(skewed.count()))


@pytest.mark.parametrize("pieces, heavy_rows", [(4, 10**6), (2, 10), (40, 10)])
def test_group_ordinal_spans_pieces(spark, skewed, pieces, heavy_rows):
    got = ordinals.group_ordinal(skewed, ["g"], ["k"], pieces=pieces, heavy_rows=heavy_rows).collect()
    want = expected(skewed, lambda r: 1, True)
    assert {(r["g"], r["k"]): r["ordinal"] + 1 for r in got} == want


def test_running_total_in_groups_and_overall(spark, skewed):
    for heavy_rows in (10, 10**6):
        grouped = ordinals.group_running_total(skewed, "v", ["k"], ["g"], pieces=7,
                                               heavy_rows=heavy_rows).collect()
        assert {(r["g"], r["k"]): r["running_total"] for r in grouped} == expected(
            skewed, lambda r: r["v"], True)
    overall = ordinals.running_total(skewed, "v", ["k"], partitions=5).collect()
    assert {(r["g"], r["k"]): r["running_total"] for r in overall} == expected(
        skewed, lambda r: r["v"], False)


def test_pieces_are_even_for_dense_orders(spark):
    """A hot group with 98 % of its order values in one dense run, and a thin far spread."""
    rows = [("hot", i if i < 19_600 else i * 10**9, 1) for i in range(20_000)] + [(f"g{i}", i, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    pieces = ordinals._ranged(df, ["g", "k"], 16).groupBy("__piece").count().collect()
    assert max(r["count"] for r in pieces) < 2 * len(rows) / 16
    got = ordinals.group_ordinal(df, ["g"], ["k"], pieces=16, heavy_rows=1000).where("g = 'hot'")
    assert [r["ordinal"] for r in got.orderBy("k").collect()] == list(range(20_000))


@pytest.mark.parametrize("made", [
    lambda: ["s"], lambda: [F.desc("k")], lambda: ["t"], lambda: [F.desc("d"), "s"],
    lambda: [F.col("k") % 7, F.col("k").desc()]], ids=["text", "descending", "time", "two", "expressions"])
def test_any_order_on_both_paths(spark, skewed, made):
    order = made()
    df = skewed.selectExpr("*", "concat('x', k) s", "timestamp_seconds(k % 1000000000) t", "date_add(date'2020-01-01', cast(k % 50 as int)) d")
    df = df.dropDuplicates(["g", "t"]) if isinstance(order[0], str) else df
    light, heavy = (sorted(((r["g"] or "", r["k"], r["ordinal"]) for r in ordinals.group_ordinal(
        df, ["g"], order, pieces=5, heavy_rows=n).collect())) for n in (None, 10))
    assert light == heavy


def test_rows_of_equal_or_missing_order(spark):
    same = spark.createDataFrame([("a", 5), ("a", 5), ("a", None), ("b", 5)], "g string, k long")
    for heavy_rows in (1, 100):
        got = ordinals.group_ordinal(same, ["g"], ["k"], pieces=4, heavy_rows=heavy_rows).collect()
        assert sorted((r["g"], r["ordinal"]) for r in got) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
        assert [r["ordinal"] for r in got if r["g"] == "a" and r["k"] is None] == [0]


def test_large_sides_are_never_joined_by_shuffle(spark, skewed):
    assert not ordinals.has_heavy_group(skewed, ["g"], 10**6)
    plan = ordinals.group_ordinal(skewed, ["g"], ["k"], heavy_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan


def test_empty(spark, skewed):
    none = skewed.where("k < 0")
    assert ordinals.row_ordinal(none, ["k"]).count() == 0
    assert ordinals.group_ordinal(none, ["g"], ["k"]).count() == 0
