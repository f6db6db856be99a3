"""Exact nearest neighbours between a table of queries and a catalogue.

Similarities are matrix products over blocks of vectors, and every block pair
keeps only its k best per query, so pairs are never emitted. Spark decides who
works on what:

* a side that a size check finds small is broadcast, and the other side streams
  past it partition by partition without being shuffled;
* otherwise both sides are cut into blocks of bounded size by a hash of their
  unique key, and each (query block, catalogue block) cell is one cogrouped
  task group. Block sizes depend on the number of rows, never on their content,
  so copies or clusters of any size cannot make a cell hot. A block costs a copy
  of the other side, so there are no more than all tasks or memory ask for.

Every way ends in the same ranking: rounded similarity, then smallest key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.vectors import is_finite
# A side is broadcast only if it has at most this many rows and vector bytes.
BROADCAST_ROWS = 16_384
BROADCAST_BYTES = 64 << 20
# Rows and vector bytes per block when both sides are large, and cells for each core.
BLOCK_ROWS, MIN_BLOCK_ROWS = 65_536, 4_096
BLOCK_BYTES = 64 << 20
CELLS_PER_CORE = 3
# Queries and candidates of one similarity matrix; the first matrix is narrow.
MATRIX_ROWS, MATRIX_COLUMNS, FIRST_COLUMNS = 1024, 4096, 512
# Pairs that `similarity_scores` may emit.
MAX_PAIRS = 10 ** 10

_SCHEMA = "query_id bigint, candidate_id bigint, score double"
_RANKED_SCHEMA = "query_id bigint, rank int, candidate_id bigint, score double"


def _matrix(batch, column: str) -> np.ndarray:
    """A list column as a 2-d double matrix; rows of other widths are an error."""
    values = batch.column(column)
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    n = len(values)
    if n == 0:
        return np.empty((0, 0))
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) % n or set(np.diff(values.offsets.to_numpy())) != {len(flat) // n}:
        raise ValueError("vectors differ in width")
    return flat.reshape(n, -1)


def _ids(batch, column: str) -> np.ndarray:
    return np.asarray(batch.column(column), dtype=np.int64)


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(lengths == 0, 1.0, lengths)


def _cosine(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    return queries @ candidates.T


def _negated_distance(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Minus the squared distance, so that larger is nearer.

    Taken from the differences rather than the expanded square, which would
    lose the digits that decide between near ties.
    """
    out = np.empty((len(queries), len(candidates)))
    for j, row in enumerate(candidates):
        gap = queries - row
        out[:, j] = -np.einsum("ij,ij->i", gap, gap)
    return out


_METRICS = {"cosine": (_unit_rows, _cosine), "euclidean": (lambda m: m, _negated_distance)}


class _Block:
    """Vectors of one side, sorted by key and prepared for the metric.

    A vector with an element that is not finite has no similarity to anything
    and takes no part.
    """

    def __init__(self, ids, vectors, prepare):
        usable = np.isfinite(vectors).all(axis=1)
        ids, vectors = ids[usable], vectors[usable]
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], prepare(vectors[order])

    def __len__(self):
        return len(self.ids)


def _pick(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best scores per row, lower columns first among equals."""
    if scores.shape[1] <= k:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    above = scores > kth
    level = scores == kth
    room = k - above.sum(axis=1, keepdims=True)
    chosen = above | (level & (np.cumsum(level, axis=1) <= room))
    return np.nonzero(chosen)[1].reshape(len(scores), k)


def _merge(parts, k):
    """(query, rank, candidate, score) of the k best of every query over all parts."""
    query_ids, candidate_ids, scores = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((candidate_ids, -scores, query_ids))
    query_ids, candidate_ids, scores = query_ids[order], candidate_ids[order], scores[order]
    starts = np.flatnonzero(np.r_[True, query_ids[1:] != query_ids[:-1]][:len(query_ids)])
    lengths = np.diff(np.r_[starts, len(query_ids)])
    rank = np.arange(len(query_ids)) - np.repeat(starts, lengths) + 1
    kept = rank <= k
    return query_ids[kept], rank[kept], candidate_ids[kept], scores[kept]


def _matrices(queries: _Block, candidates: _Block, score, exclude_self, first, paired=None):
    """Score matrices of a block pair: (query ids, candidate ids, scores), by query rows.

    `paired` tells by the ranges of rows and columns which pairs count.
    """
    cuts = [0, *range(min(first, len(candidates)), len(candidates), MATRIX_COLUMNS), len(candidates)]
    for top in range(0, len(queries), MATRIX_ROWS):
        ids = queries.ids[top:top + MATRIX_ROWS]
        for left, right in zip(cuts, cuts[1:]):
            if left == right:
                continue
            names = candidates.ids[left:right]
            scores = score(queries.vectors[top:top + MATRIX_ROWS], candidates.vectors[left:right])
            if exclude_self:
                at = np.minimum(np.searchsorted(names, ids), len(names) - 1)
                same = names[at] == ids
                scores[np.flatnonzero(same), at[same]] = -np.inf
            if paired is not None:
                np.copyto(scores, -np.inf, where=~paired(slice(top, top + MATRIX_ROWS), slice(left, right)))
            yield left == 0, ids, names, scores


def _all_pairs(queries: _Block, candidates: _Block, score, digits):
    """Every (query ids, candidate ids, scores) of a block pair."""
    for _, ids, names, scores in _matrices(queries, candidates, score, False, MATRIX_COLUMNS):
        yield (np.repeat(ids, len(names)), np.tile(names, len(ids)),
               np.round(scores, digits).ravel() + 0.0)


def _best(queries: _Block, candidates: _Block, score, k, digits, exclude_self, paired=None):
    """(query ids, candidate ids, scores) of the k best of every query.

    Candidates come in the order of their keys, so after the first matrix only
    a score that rounds to more than the query's k-th best can still enter.
    """
    found, best, ids = [], None, None
    for opens, ids, names, scores in _matrices(queries, candidates, score, exclude_self,
                                               max(FIRST_COLUMNS, 2 * k), paired):
        if opens:
            if best is not None:
                found.append(best)
            rounded = np.round(scores, digits) + 0.0
            columns = _pick(rounded, k)
            values = np.take_along_axis(rounded, columns, axis=1).ravel()
            keep = values > -np.inf
            best = (np.repeat(ids, columns.shape[1])[keep], names[columns].ravel()[keep], values[keep])
        else:
            rows, columns = np.divmod(np.flatnonzero(scores > limit[:, None]), scores.shape[1])
            if len(rows):
                values = np.round(scores[rows, columns], digits) + 0.0
                query_ids, _, candidate_ids, values = _merge(
                    [best, (ids[rows], names[columns], values)], k)
                best = query_ids, candidate_ids, values
        limit = np.full(len(ids), -np.inf)
        query_ids, rank, _, values = _merge([best], k)
        full = rank == k
        limit[np.searchsorted(ids, query_ids[full])] = values[full] + 0.4 * 10.0 ** -digits
    if best is not None:
        found.append(best)
    return found


def _to_batches(found) -> Iterator[pa.RecordBatch]:
    for query_ids, candidate_ids, scores in found:
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids), pa.array(candidate_ids), pa.array(scores)],
            names=["query_id", "candidate_id", "score"])


def _vectors(df: DataFrame, key: str, vector: str, out: str) -> DataFrame:
    """Two columns: the key as a number, and the vector."""
    return df.where(F.col(vector).isNotNull()).select(
        F.col(key).cast("bigint").alias(out), F.col(vector).alias("v"))


def _has_repeats(df: DataFrame, key: str, vector: str) -> bool:
    """Whether rows with a vector share a key; only keys are shuffled, counted in the map tasks first."""
    keys = _vectors(df, key, vector, "k").where(F.col("k").isNotNull())
    return not keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def one_row_per_key(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """The row of smallest vector for each key, key and vector only. Rows of one key meet only if there are any."""
    rows = df.where(F.col(vector).isNotNull()).select(key, vector)
    if not _has_repeats(df, key, vector):
        return rows
    return rows.groupBy(key).agg(F.min(vector).alias(vector))


class Side(NamedTuple):
    """One side of the comparison: its rows, and their broadcast if they are few."""

    rows: DataFrame
    shared: Broadcast | None
    width: int


def prepare_side(df: DataFrame, key: str, vector: str = "embedding", *, out: str = "candidate_id",
                 broadcast_rows: int = BROADCAST_ROWS) -> Side:
    """Check the size of a side, and broadcast it when it is small.

    The check takes vector widths only, and stops at one row more than allowed.
    Prepare a catalogue once to serve many batches of queries from it.
    """
    rows = _vectors(df, key, vector, out)
    # Held between check and fetch, so that an aggregate is not computed twice.
    held = _vectors(df, key, vector, out).persist()
    try:
        widths = [row[0] for row in held.select(F.size("v")).take(broadcast_rows + 1)]
        if len(widths) > broadcast_rows or 8 * sum(widths) > BROADCAST_BYTES:
            return Side(rows, None, max(widths))
        table = held.toArrow()
    finally:
        held.unpersist()
    shared = df.sparkSession.sparkContext.broadcast((_ids(table, out), _matrix(table, "v")))
    return Side(rows, shared, max(widths, default=0))


def block_count(spark: SparkSession, n: int, width: int, block_rows: int) -> int:
    """How many blocks `n` rows make: of `block_rows`, unless all tasks have cells with fewer; of bounded bytes always.

    Each block is a copy of the other side, so small ones would make copies by the square of the rows.
    """
    largest = min(BLOCK_ROWS, max(1, BLOCK_BYTES // (8 * max(1, width))))
    enough = math.ceil(math.sqrt(CELLS_PER_CORE * spark.sparkContext.defaultParallelism))
    return max(1, math.ceil(n / largest), min(enough, math.ceil(n / min(block_rows, MIN_BLOCK_ROWS))))


def _scores(queries: DataFrame, catalogue: DataFrame | Side, k, metric, query_key, candidate_key,
            vector, exclude_self, digits, broadcast_rows, block_rows) -> DataFrame:
    prepare, score = _METRICS[metric]
    if k is not None:
        queries = one_row_per_key(queries, query_key, vector)
    if not isinstance(catalogue, Side):
        catalogue = prepare_side(catalogue, candidate_key, vector, broadcast_rows=broadcast_rows)

    if catalogue.shared is not None:
        shared = catalogue.shared

        def stream_queries(batches):
            candidates = _Block(*shared.value, prepare)
            for batch in batches:
                block = _Block(_ids(batch, "query_id"), _matrix(batch, "v"), prepare)
                if k is None:
                    yield from _to_batches(_all_pairs(block, candidates, score, digits))
                    continue
                found = _best(block, candidates, score, k, digits, exclude_self)
                if found:
                    # Every candidate was seen, so these ranks are final.
                    query_ids, rank, candidate_ids, scores = _merge(found, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query_ids), pa.array(rank, pa.int32()),
                         pa.array(candidate_ids), pa.array(scores)],
                        names=["query_id", "rank", "candidate_id", "score"])

        return _vectors(queries, query_key, vector, "query_id").mapInArrow(
            stream_queries, _SCHEMA if k is None else _RANKED_SCHEMA)

    asked = prepare_side(queries, query_key, vector, out="query_id", broadcast_rows=broadcast_rows)
    if asked.shared is not None:
        shared = asked.shared

        def stream_catalogue(batches):
            block = _Block(*shared.value, prepare)
            best = None
            for batch in batches:
                candidates = _Block(_ids(batch, "candidate_id"), _matrix(batch, "v"), prepare)
                if k is None:
                    yield from _to_batches(_all_pairs(block, candidates, score, digits))
                    continue
                found = _best(block, candidates, score, k, digits, exclude_self)
                if found:
                    query_ids, _, ids, scores = _merge(found if best is None else [best, *found], k)
                    best = query_ids, ids, scores
            if best is not None:
                yield from _to_batches([best])

        return catalogue.rows.mapInArrow(stream_catalogue, _SCHEMA)

    # Both sides are large: a grid of blocks, each row copied along its strip.
    query_blocks, catalogue_blocks = (
        block_count(queries.sparkSession, rows.count(), asked.width, block_rows) for rows in (asked.rows, catalogue.rows))

    def block_of(key, n):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    left = asked.rows.withColumns({
        "qb": block_of("query_id", query_blocks),
        "cb": F.explode(F.sequence(F.lit(0), F.lit(catalogue_blocks - 1)))})
    right = catalogue.rows.withColumns({
        "cb": block_of("candidate_id", catalogue_blocks),
        "qb": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))})

    def cell(left_table: pa.Table, right_table: pa.Table) -> pa.Table:
        block = _Block(_ids(left_table, "query_id"), _matrix(left_table, "v"), prepare)
        candidates = _Block(_ids(right_table, "candidate_id"), _matrix(right_table, "v"), prepare)
        if k is None:
            found = _all_pairs(block, candidates, score, digits)
        else:
            found = _best(block, candidates, score, k, digits, exclude_self)
        return pa.Table.from_batches(_to_batches(found), schema=pa.schema(
            [("query_id", pa.int64()), ("candidate_id", pa.int64()), ("score", pa.float64())]))

    return left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(cell, _SCHEMA)


def topk(queries: DataFrame, catalogue: DataFrame | Side, k: int = 5, metric: str = "cosine", *,
         query_key: str = "query_id", candidate_key: str = "candidate_id",
         vector: str = "embedding", exclude_self: bool = False, digits: int = 6,
         broadcast_rows: int = BROADCAST_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k nearest catalogue rows of every query: (query_id, rank, candidate_id, score).

    Catalogue keys are unique whole numbers. Of query rows that share a key, one
    counts, the smallest vector in the order of its elements, on every route. For
    `euclidean` the score is minus the squared distance. A query that is itself in the catalogue finds itself
    unless `exclude_self` is set. Inputs with a costly history should be
    written to a table first, as large ones are read more than once. If both
    sides are large, their blocks hold `block_rows` (`BLOCK_ROWS` and
    `BLOCK_BYTES` at most), and more where that is enough for all tasks.
    """
    scored = _scores(queries, catalogue, k, metric, query_key, candidate_key, vector,
                     exclude_self, digits, broadcast_rows, block_rows)
    if "rank" in scored.columns:
        return scored
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "candidate_id"))
    return (scored.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "candidate_id", "score"))


def topk_similar(queries: DataFrame, catalogue: DataFrame | Side, k: int = 5, **options) -> DataFrame:
    """Cosine top-k: (query_id, rank, candidate_id, similarity)."""
    return topk(queries, catalogue, k, "cosine", **options).withColumnRenamed("score", "similarity")


def similarity_scores(queries: DataFrame, catalogue: DataFrame, *, query_key: str = "query_id",
                      candidate_key: str = "candidate_id", vector: str = "embedding",
                      digits: int = 6, broadcast_rows: int = BROADCAST_ROWS,
                      block_rows: int = BLOCK_ROWS, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """Similarity of each query to the whole catalogue, one row per pair.

    The result has |queries| x |catalogue| rows, so this is for a handful of
    queries; `topk_similar` is the form for many. More than `max_pairs` are
    refused.
    """
    pairs = math.prod(df.where(F.col(vector).isNotNull()).count() for df in (queries, catalogue))
    if pairs > max_pairs:
        raise ValueError(f"{pairs} pairs, more than {max_pairs}; topk_similar emits k rows a query")
    scored = _scores(queries, catalogue, None, "cosine", query_key, candidate_key, vector,
                     False, digits, broadcast_rows, block_rows)
    return scored.withColumnRenamed("score", "similarity")


def finite_vectors(df: DataFrame, vector: str = "embedding", score: str | None = None) -> DataFrame:
    """Rows with a score and a vector whose elements are all finite."""
    required = [vector] if score is None else [score, vector]
    return df.dropna(subset=required).where(is_finite(F.col(vector)))


def expand_vector(df: DataFrame, width: int, vector: str = "embedding",
                  prefix: str = "feature_") -> DataFrame:
    """One column per vector element, for exports that need a flat table."""
    rest = [c for c in df.columns if c != vector]
    return df.select(*rest, *[F.get(vector, F.lit(i)).alias(f"{prefix}{i}") for i in range(width)])
