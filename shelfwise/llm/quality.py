"""Document quality by Bradley-Terry pairwise ranking.

Each document has a feature vector made of shares and rates of its whole text.
Labelled documents give preference pairs (one of label 1 over one of label 0);
the utility `w . x` is learned by logistic loss on the pairs' feature
differences. The threshold is the utility's quantile among the labelled
documents at their share of label 0, and a score is the logistic function of
the distance to that threshold, moved so that the threshold scores `CUT`.

Defined results: null and empty texts have the features of a text without
words and are scored like any other; a null or other label than 0 and 1 is not
learned from; labels of one document that differ count as 0; without labels of
both kinds every score is 1. A null doc_id is never learned from and is not
held out. Extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.sampling import hash_sample
from shelfwise.llm.tokens import mix, not_space, row_of, slices, split_words

CUT = 0.3
SAMPLE_ROWS = 20_000
PAIRS = 60_000
RIDGE = 1e-3


def features(texts: pa.Array) -> np.ndarray:
    """A row of features for each text; a null text counts as empty."""
    words = split_words(texts, not_space)
    rows = len(texts)
    row, data = row_of(words.first), words.data
    count = np.maximum(np.diff(words.first), 1).astype(float)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(row, values, rows)

    upper = (data >= 65) & (data <= 90)
    two = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97))
    upper[two] = True  # Latin-1 capitals
    digit = (data >= 48) & (data <= 57)
    lower = ((data >= 97) & (data <= 122)) | (data >= 0xC3)
    lower[two] = False
    symbol = (data > 32) & (data < 127) & ~upper & ~digit & ~lower
    pair = symbol.copy()
    pair[1:] &= symbol[:-1]
    pair[:1] = False

    def each(mask: np.ndarray) -> np.ndarray:
        """How many bytes of each word are in the mask."""
        sums = np.zeros(len(mask) + 1, np.int32)
        np.cumsum(mask, dtype=np.int32, out=sums[1:])
        return sums[words.end] - sums[words.start]

    uppers, lowers, digits, symbols = each(upper), each(lower), each(digit), each(symbol)
    chars = each((data & 0xC0) != 0x80)
    again = np.zeros(len(row), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (row[1:] == row[:-1])
    kinds = _distinct(row, words.hash)
    distinct = np.bincount(kinds, minlength=rows)
    ends = np.isin(data[words.end - 1], [33, 46, 63])
    line = np.searchsorted(np.flatnonzero(data == 10), words.start) + row  # both grow from line to line
    first = np.flatnonzero(np.diff(line, prepend=-1)) if len(line) else np.zeros(0, int)
    inside = np.arange(len(line)) - np.repeat(first, np.diff(np.append(first, len(line))))
    hashes = np.add.reduceat(mix(words.hash + inside.astype(np.uint64)), first) if len(first) else words.hash
    lines = np.maximum(np.bincount(row[first], minlength=rows), 1)
    return np.stack([
        np.sqrt(total((uppers >= 2) & (lowers == 0)) / count),
        np.sqrt(total(symbols) / count),
        np.sqrt(total(each(pair)) / count),
        np.sqrt(total((symbols > 0) & (uppers + lowers + digits == 0)) / count),
        np.sqrt(total(again) / count),
        np.sqrt(total(digits) / count),
        np.sqrt(total(ends) / count),
        np.log1p(distinct) / np.log1p(count),
        distinct / count,
        np.bincount(_distinct(row[first], hashes), minlength=rows) / lines,
        np.log1p(total(chars) / count),
        np.log1p(count),
    ], axis=1)


def _distinct(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The row of each different (row, hash)."""
    key = mix(hashes + mix(row.astype(np.uint64)))
    return row[np.unique(key, return_index=True)[1]]


class Ranking(NamedTuple):
    """Weights on the plain features, and the utility at which a score is `cut`."""

    weights: list[float]
    threshold: float
    cut: float

    def score(self, texts: pa.Array) -> np.ndarray:
        if not self.weights:
            return np.ones(len(texts))
        shift = np.log(self.cut / (1 - self.cut)) - self.threshold
        return 1 / (1 + np.exp(-np.clip(features(texts) @ np.array(self.weights) + shift, -500, 500)))


def preference_pairs(good: int, bad: int, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the preferred and the other document of each pair.

    Every document takes part; partners change from pass to pass.
    """
    at = np.arange(min(pairs, good * bad) if pairs >= max(good, bad) else max(good, bad))
    most, least = max(good, bad), min(good, bad)
    long, short = at % most, (at + at // most) % least
    return (long, short) if good >= bad else (short, long)


def fit_pairs(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, cut: float = CUT) -> Ranking:
    """Newton steps on the logistic loss of feature differences."""
    good, bad = x[label == 1], x[label == 0]
    if not len(good) or not len(bad):
        return Ranking([], 0.0, cut)
    scale = x.std(axis=0)
    scale[scale < 1e-9] = np.inf
    i, j = preference_pairs(len(good), len(bad), pairs)
    diff = (good[i] - bad[j]) / scale
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        slope = diff.T @ (p - 1) / len(diff) + RIDGE * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    w = w / scale
    utility = np.sort(x @ w)
    edge = len(bad)  # the quantile at the share of label 0
    return Ranking([float(v) for v in w], float((utility[edge - 1] + utility[edge]) / 2), cut)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """If a document is in the held-out fold, by the CRC-32 of its id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def fit_ranking(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
                pairs: int = PAIRS, cut: float = CUT) -> Ranking:
    """Learn from at most `sample_rows` labelled documents, those with the smallest hashed ids.

    The labels given are all learned from: leave held-out rows away before.
    """
    sample = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    sample = hash_sample(sample, sample_rows, ["doc_id"])

    def batches(found):
        for batch in found:
            for part in slices(batch, "text"):
                x = pa.array(list(features(part.column("text"))), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), x],
                                                 ["doc_id", "quality", "x"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .select("doc_id", "quality", "text")
            .mapInArrow(batches, "doc_id long, quality int, x array<double>")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample_rows).toArrow())
    if not rows.num_rows:
        return Ranking([], 0.0, cut)
    return fit_pairs(np.array(rows["x"].to_pylist()), rows["quality"].to_numpy(), pairs, cut)


def score_quality(docs: DataFrame, model: Ranking) -> DataFrame:
    """(doc_id, quality_score) of each document, from the text alone."""

    def batches(found):
        for batch in found:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.score(part.column("text")))],
                    ["doc_id", "quality_score"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(batches, f"doc_id {dict(rows.dtypes)['doc_id']}, quality_score double")


def keep_quality(docs: DataFrame, model: Ranking) -> DataFrame:
    """Documents at or above the threshold, with their columns as they were."""

    def batches(found):
        for batch in found:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(model.score(part.column("text")) >= model.cut))

    return docs.mapInArrow(batches, docs.schema)
