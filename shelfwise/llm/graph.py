"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize, release


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) for each node of `links` (a, b): the smallest node of its component.

    In each round every node joins the neighbour (or itself) of smallest hash, and
    links between joined groups make the next, smaller graph, whose nodes have
    these hashes as names: a 64-bit hash of one long has no collisions, and the
    order changes from round to round. So the rounds grow with the logarithm of the
    nodes, also for long chains. Nothing is collected; nodes with many links
    are pre-aggregated (single longs, in hash tables), and joins on them can be split. The result is a table of
    its own, which `release` removes. With a limit of `rounds`, nodes of one group
    are connected, but a component may be in several groups still.
    """
    steps = []
    edges = materialize(links.where("a <> b").select(
        F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b")).distinct(), "links")
    while (rounds is None or len(steps) < rounds) and not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = (both.groupBy(F.col("a").alias("node")).agg(F.min(F.xxhash64("b")).alias("other"))
                   .select("node", F.least("other", F.xxhash64("node")).alias("parent"), F.lit(len(steps)).alias("turn")))
        parents = materialize(parents, "parents")
        steps.append(parents)
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("a_to"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("b_to"))
        moved = edges.join(left, "a").join(right, "b").where("a_to <> b_to")
        before, edges = edges, materialize(moved.select(
            F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "links")
        release(before)
    release(edges)
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    roots = steps.pop()
    while steps:
        later = roots.select(F.col("node").alias("parent"), F.col("parent").alias("root"), F.col("turn").alias("last"))
        before, own = roots, steps.pop()
        roots = materialize(own.join(later, "parent", "left").select(
            "node", F.coalesce("root", "parent").alias("parent"), F.coalesce("last", "turn").alias("turn")), "roots")
        release(before)
        release(own)
    least = materialize(roots.groupBy("parent", "turn").agg(F.min("node").alias("component")), "least")
    found = materialize(roots.join(least, ["parent", "turn"]).select("node", "component"), "components")
    release(roots)
    release(least)
    return found
