"""Exact top-k search by tiled matrix products.

Queries are cut into tiles and candidates into shards, both by a hash of id and
vector and both of bounded size; each (tile, shard) cell is one matrix product in
numpy with a partial selection of k per query. The cells' lists are merged up a
tree, `fan` shards at a time, until one list per query is left. Nothing is
broadcast. The work is |queries| x |candidates|, as an exact search asks for;
each query row is sent once per shard and each candidate once per tile.

Components are integers, and products are exact: they are computed in double
precision, and refused if a score could reach 2^53.

Defined results: rows with a null id, a null vector, or a null or non-finite
component take no part; a query's candidates are all rows of other ids, and rows
that are equal in id and vector are as many candidates; query rows of one id are
one query of all their pairs, equal ones counted once; vectors of different
lengths have no score with each other; ties go to the smaller id; a query with
fewer candidates than k gets them all. An empty side gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE_ROWS = 2048
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
FAN = 16
K = 5


def whole_vector(vector: Column) -> Column:
    """floor(256 x) of each component, as bytes of doubles would hold it; null unless all are finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long")))


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, score) of the k highest scores of each row, ties to smaller ids; `ids` ascend."""
    scores = np.where(own[:, None] == ids[None, :], -np.inf, scores)
    take = min(k, scores.shape[1])
    edge = np.partition(scores, scores.shape[1] - take, axis=1)[:, scores.shape[1] - take]
    row, col = np.nonzero((scores >= edge[:, None]) & (scores > -np.inf))
    value = scores[row, col]
    order = np.lexsort((ids[col], -value, row))
    row, col, value = row[order], col[order], value[order]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < take
    return row[keep], ids[col[keep]], value[keep]


def _matrices(rows: pd.DataFrame, vector: str):
    """(width, ids, matrix) for each vector length, ids ascending."""
    rows = rows.assign(width=[len(v) for v in rows[vector]]).sort_values("id", kind="stable")
    for width, group in rows.groupby("width"):
        matrix = np.concatenate(group[vector].to_numpy()).astype(np.float64).reshape(len(group), width)
        yield width, group["id"].to_numpy(np.int64), matrix


def _cell(k: int, block: int):
    def search(tile: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(tile) and len(shard):
            queries = {width: (ids, matrix) for width, ids, matrix in _matrices(tile, "v")}
            for width, ids, matrix in _matrices(shard, "w"):
                if width not in queries:
                    continue
                asked, left = queries[width]
                largest = np.abs(left).max(initial=0) * np.abs(matrix).max(initial=0) * max(width, 1)
                if largest >= 2.0 ** 53:
                    raise OverflowError("scores may not be exact: components are too large")
                for at in range(0, len(asked), block):
                    part = left[at:at + block]
                    row, vec_id, score = best(part @ matrix.T, ids, asked[at:at + block], k)
                    found.append(pd.DataFrame({"query_id": asked[at:at + block][row], "shard": shard["shard"].iloc[0],
                                               "vec_id": vec_id, "score": score.astype(np.int64)}))
        empty = pd.DataFrame({"query_id": [], "shard": [], "vec_id": [], "score": []}, dtype=np.int64)
        return pd.concat(found) if found else empty

    return search


def exact_topk(queries: DataFrame, candidates: DataFrame, k: int = K, tile_rows: int = TILE_ROWS,
               shard_rows: int = SHARD_ROWS, fan: int = FAN) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query.

    Both sides are (id long, v array<long>).
    """
    queries, candidates = (side.where("id is not null and v is not null").select(
        F.col("id").alias("id"), F.col("v").alias("v")) for side in (queries, candidates))
    queries = queries.distinct()
    # of equal rows no more than k can be among the k best
    copies = F.sequence(F.lit(1).cast("long"), F.least(F.col("count"), F.lit(k).cast("long")))
    candidates = candidates.groupBy("id", "v").count().select("id", F.col("v").alias("w"), F.explode(copies).alias("copy"))
    tiles = max(1, -(-queries.count() // tile_rows))
    shards = max(1, -(-candidates.count() // shard_rows))

    def numbered(side: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        each = F.sequence(F.lit(0), F.lit(others - 1))
        return (side.withColumn(own, F.pmod(F.xxhash64(*side.columns), F.lit(parts)).cast("int"))
                .withColumn(other, F.explode(each)))

    left = numbered(queries, "tile", tiles, "shard", shards)
    right = numbered(candidates, "shard", shards, "tile", tiles).drop("copy")
    lists = (left.groupBy("tile", "shard").cogroup(right.groupBy("tile", "shard"))
             .applyInPandas(_cell(k, BLOCK_ROWS), "query_id long, shard int, vec_id long, score long"))
    order = [F.col("score").desc(), F.col("vec_id")]
    while shards > 1:
        shards = -(-shards // fan)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / fan).cast("int"))
        lists = (lists.withColumn("rank", F.row_number().over(
            Window.partitionBy("query_id", "shard").orderBy(*order))).where(F.col("rank") <= k).drop("rank"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return lists.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
