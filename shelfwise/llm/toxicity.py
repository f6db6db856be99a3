"""Toxicity by class-conditional Kneser-Ney models of characters.

Two models, of toxic and of ordinary documents, give the likelihood of each
character of a word after the `ORDER - 1` characters before it (words are
padded, so beginnings are contexts too; no context crosses into another word).
The longest order has counts of its own for each class; what it discounts goes
to all orders below, from `LOW_ORDER` down one by one, which both classes share
and which are made of Kneser-Ney continuation counts. A rare expression thus
falls back on the same counts in both models and hardly tells them apart.

A document's evidence is the difference of its log likelihoods, normalised by
the number of words: over the whole text, and over its most toxic words (the
`TOP` ones; a word counts once). A logistic function of these and the logarithm
of the length, fitted on labelled documents that the models have not seen, is
the score.

Words are counted over all labelled documents of the training folds, then
characters over the table of words; both are plain aggregations. The fitted
tables hold each gram and context apart, by 64 bits of hash, and grow with the
number of different grams of the labelled words; they are broadcast whole.

Defined results: a null text is empty; a text without words has no evidence
(all differences 0) and is scored; labels other than 0 and 1 are not learned
from; labels of one document that differ count as 1; without documents of both
classes every score is 0; rows that repeat a doc_id are scored one by one.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.quality import held_out
from shelfwise.llm.sampling import hash_sample
from shelfwise.llm.tokens import Words, mix, row_of, slices, split_words
from shelfwise.session import materialize

ORDER = 8
LOW_ORDER = ORDER - 1
DISCOUNT = 0.75
TOP = (1, 2, 4)  # how many of the most toxic words are averaged
SAMPLE_ROWS = 20_000
PIECE = 1 << 20  # bytes of text scored at once
KNOWN_WORDS = 1 << 22  # words whose differences a task keeps, 16 bytes each
LABEL_ROWS = 1 << 21  # labels are broadcast up to here (16 bytes each), shuffled beyond
_PAD, _END = "\x02", "\x03"
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the `k` characters that end at each position (0 for k = 0)."""
    out = np.zeros(len(codes), np.uint64)
    for j in range(k):
        power = np.uint64(pow(_BASE, j, 1 << 64))
        out[j:] += (codes[:len(codes) - j].astype(np.uint64) + np.uint64(1)) * power
    return mix(out) if k else out


def _codes(grams: list[str]) -> np.ndarray:
    return np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32)


def _places(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each hash is in the ascending `keys`; their number if it is not there."""
    wanted, back = np.unique(hashes, return_inverse=True)
    spot = np.searchsorted(keys, wanted)
    found = spot < len(keys)
    found[found] = keys[spot[found]] == wanted[found]
    return np.where(found, spot, len(keys))[back]


class Table(NamedTuple):
    """Counts of an order: of grams, and of their contexts in all and by different grams.

    `keys` and `heads` are the hashes of grams and contexts, ascending; the counts end with a 0 for any others.
    """

    keys: np.ndarray
    grams: np.ndarray
    heads: np.ndarray
    total: np.ndarray
    kinds: np.ndarray

    def find(self, gram: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _places(self.keys, gram), _places(self.heads, context)

    def smooth(self, gram: np.ndarray, context: np.ndarray, below: np.ndarray) -> np.ndarray:
        """`gram` and `context` are places that `find` tells."""
        total = self.total[context]
        seen = np.maximum(total, 1)
        kept = np.maximum(self.grams[gram] - DISCOUNT, 0) / seen
        rest = np.where(total > 0, DISCOUNT * self.kinds[context] / seen, 1.0)
        return kept + rest * below


class Models(NamedTuple):
    """`shared`: tables of the orders 1 to LOW_ORDER; `toxic` and `ordinary`: of the longest order."""

    shared: list[Table]
    toxic: Table
    ordinary: Table

    def plain(self) -> tuple:
        """Tuples and arrays only, which any worker can load."""
        return [tuple(t) for t in self.shared], tuple(self.toxic), tuple(self.ordinary)

    @staticmethod
    def of(plain: tuple) -> Models:
        return Models([Table(*t) for t in plain[0]], Table(*plain[1]), Table(*plain[2]))

    def differences(self, words: Words, which: np.ndarray) -> np.ndarray:
        """Toxic minus ordinary log likelihood of chosen words."""
        size = words.end[which] - words.start[which]
        whole = size + ORDER
        first = np.cumsum(whole) - whole
        padded = np.full(int(whole.sum()), ord(_PAD), np.uint8)
        padded[first + whole - 1] = ord(_END)
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        padded[np.repeat(first + ORDER - 1, size) + inside] = words.data[np.repeat(words.start[which], size) + inside]
        codes = np.frombuffer(padded.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero(codes != ord(_PAD))
        hashes = [gram_hashes(codes, k) for k in range(ORDER + 1)]
        chance = np.full(len(at), 1e-4)
        for k, table in enumerate(self.shared, 1):
            chance = table.smooth(*table.find(hashes[k][at], hashes[k - 1][at - 1]), chance)
        gram, context = self.toxic.find(hashes[ORDER][at], hashes[ORDER - 1][at - 1])  # both have the same grams
        each = np.log(self.toxic.smooth(gram, context, chance)) - np.log(self.ordinary.smooth(gram, context, chance))
        ends = np.flatnonzero(codes[at] == ord(_END))
        begin = np.concatenate(([0], ends[:-1] + 1))
        return np.add.reduceat(each, begin)


class Known:
    """Differences of the words that a task has met, by their hashes; forgotten when they get too many."""

    def __init__(self, models: Models):
        self.models = models
        self.keys, self.told = np.zeros(0, np.uint64), np.zeros(0)

    def differences(self, words: Words, which: np.ndarray) -> np.ndarray:
        """Of chosen words, all different, by ascending hash."""
        hashes = words.hash[which]
        spot = np.searchsorted(self.keys, hashes)
        held = spot < len(self.keys)
        held[held] = self.keys[spot[held]] == hashes[held]
        out = np.empty(len(which))
        out[held] = self.told[spot[held]]
        new = np.flatnonzero(~held)
        if len(new):
            out[new] = self.models.differences(words, which[new])
            if len(self.keys) + len(new) > KNOWN_WORDS:
                self.keys, self.told, spot = self.keys[:0], self.told[:0], np.zeros_like(spot)
            self.keys = np.insert(self.keys, spot[new], hashes[new])
            self.told = np.insert(self.told, spot[new], out[new])
        return out


def evidence(texts: pa.Array, models: Models | Known) -> np.ndarray:
    """Normalised differences of each text: the whole, the top words; and its log length. Texts are lowered before."""
    words = split_words(texts)
    out = np.zeros((len(texts), len(TOP) + 2))
    if not len(words.hash):
        return out
    _, which, back = np.unique(words.hash, return_index=True, return_inverse=True)
    told, row, count = models.differences(words, which), row_of(words.first), np.diff(words.first)
    full = np.flatnonzero(count)
    out[full, 0] = np.add.reduceat(told[back], words.first[full]) / count[full]
    rank = np.empty(len(which), np.int64)
    rank[np.argsort(-told, kind="stable")] = np.arange(len(which))
    own = np.unique(row * len(which) + rank[back])  # a row's different words, most toxic first
    row, told = own // len(which), np.sort(told)[::-1][own % len(which)]
    first = np.searchsorted(row, full)
    sums, last = np.append(0, np.cumsum(told)), np.append(first[1:], len(row))
    for i, top in enumerate(TOP, 1):
        to = np.minimum(first + top, last)
        out[full, i] = (sums[to] - sums[first]) / (to - first)
    out[full, -1] = np.log1p(count[full])
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, toxic, ordinary): occurrences of each word in documents of both classes."""

    def batches(found):
        for batch in found:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                row, label = row_of(words.first), part.column("toxic").to_numpy()
                _, which, back = np.unique(words.hash, return_index=True, return_inverse=True)
                toxic = np.bincount(back, label[row], len(which)).astype(np.int64)
                count = np.bincount(back, minlength=len(which))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words.text(i) for i in which], pa.string()), pa.array(toxic), pa.array(count - toxic)],
                    ["word", "toxic", "ordinary"])

    rows = docs.select(F.lower("text").alias("text"), F.col("toxic").cast("int").alias("toxic"))
    counts = rows.mapInArrow(batches, "word string, toxic long, ordinary long")
    return counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _hashed(grams: DataFrame, k: int, values: list[str]) -> list[np.ndarray]:
    """The ascending hashes of all `gram` (k characters), and `values` of each with a 0 at the end."""

    def batches(found):
        for batch in found:
            hashes = gram_hashes(_codes(batch.column("gram").to_pylist()), k)[max(k, 1) - 1::max(k, 1)]
            if not k:
                hashes = np.zeros(batch.num_rows, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.astype(np.int64)), *(batch.column(v) for v in values)], ["key", *values])

    kinds = ", ".join(f"{v} long" for v in values)
    rows = grams.select("gram", *values).mapInArrow(batches, f"key long, {kinds}").toArrow()
    keys = rows["key"].to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    pa.default_memory_pool().release_unused()
    return [keys[order], *(np.append(rows[v].to_numpy()[order], 0).astype(np.float32) for v in values)]


def fit_models(docs: DataFrame) -> Models | None:
    """Both models from (text, toxic) rows; None without words of both classes."""
    words = word_counts(docs)
    padded = F.concat(F.lit(_PAD * (ORDER - 1)), "word", F.lit(_END))
    positions = F.sequence(F.lit(1), F.length("word") + 1)
    grams = (words.select("toxic", "ordinary", F.explode(F.transform(
        positions, lambda i: F.substr(padded, i, F.lit(ORDER)))).alias("gram"))
        .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))
    grams = materialize(grams, "grams")
    sums = grams.agg(F.sum("toxic"), F.sum("ordinary")).first()
    if not sums[0] or not sums[1]:
        return None
    keys, *top = _hashed(grams, ORDER, ["toxic", "ordinary"])
    heads = grams.groupBy(F.substring("gram", 1, ORDER - 1).alias("gram")).agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"),
        F.sum((F.col("toxic") > 0).cast("long")).alias("toxic_kinds"),
        F.sum((F.col("ordinary") > 0).cast("long")).alias("ordinary_kinds"))
    contexts, *head = _hashed(heads, ORDER - 1, ["toxic", "ordinary", "toxic_kinds", "ordinary_kinds"])
    shared, lower = [], grams.select("gram")
    for k in range(LOW_ORDER, 0, -1):
        # one row per different longer gram: rows per suffix are its continuation count
        lower = materialize(lower.groupBy(F.right("gram", F.lit(k)).alias("gram")).agg(F.count("*").alias("times")),
                            f"grams{k}")
        heads = lower.groupBy(F.substring("gram", 1, k - 1).alias("gram")).agg(
            F.sum("times").alias("times"), F.count("*").alias("kinds"))
        shared.append(Table(*_hashed(lower, k, ["times"]), *_hashed(heads, k - 1, ["times", "kinds"])))
    return Models(shared[::-1], Table(keys, top[0], contexts, head[0], head[2]),
                  Table(keys, top[1], contexts, head[1], head[3]))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and, last, the constant, by Newton steps with a small ridge."""
    scale = np.maximum(x.std(axis=0), 1e-6)
    x = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(x) + 1e-3 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(x) + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w / np.append(scale, 1)


class Toxicity(NamedTuple):
    """`shared`: the models as a broadcast, if they were sent to workers before."""

    models: Models | Known
    weights: np.ndarray
    shared: Broadcast | None = None

    def score(self, texts: pa.Array) -> np.ndarray:
        z = evidence(texts, self.models) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, unseen: Column, sample_rows: int = SAMPLE_ROWS) -> Toxicity | None:
    """Models from the labelled documents, the logistic function from at most `sample_rows` of the `unseen` ones.

    The labels given are all learned from: leave held-out rows away before.
    """
    labels = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    seen = labels.where(~unseen)
    if seen.limit(LABEL_ROWS + 1).count() <= LABEL_ROWS:
        seen = F.broadcast(seen)
    models = fit_models(texts.join(seen, "doc_id"))
    if models is None:
        return None
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(models.plain())
    sample = hash_sample(labels.where(unseen), sample_rows, ["doc_id"])

    def batches(found):
        models = Known(Models.of(shared.value))
        for batch in found:
            for part in slices(batch, "text", PIECE):
                x = pa.array(list(evidence(part.column("text"), models)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), x], ["doc_id", "toxic", "x"])

    rows = (texts.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", F.lower("text").alias("text"))
            .mapInArrow(batches, "doc_id long, toxic int, x array<double>")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample_rows).toArrow())
    y = rows["toxic"].to_numpy()
    if len(np.unique(y)) < 2:  # too few to fit: any toxic evidence counts
        return Toxicity(models, np.array([1.0] * (len(TOP) + 1) + [0.0, -6.0]), shared)
    return Toxicity(models, fit_logistic(np.array(rows["x"].to_pylist()), y), shared)


def score_toxicity(docs: DataFrame, model: Toxicity | None) -> DataFrame:
    """(doc_id, toxic_score) of each row, from the text alone."""
    rows = docs.select("doc_id", F.lower(F.col("text").cast("string")).alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("toxic_score"))
    shared = model.shared or docs.sparkSession.sparkContext.broadcast(model.models.plain())
    weights = model.weights

    def batches(found):
        model = Toxicity(Known(Models.of(shared.value)), weights)
        for batch in found:
            for part in slices(batch, "text", PIECE):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.score(part.column("text")))], ["doc_id", "toxic_score"])

    return rows.mapInArrow(batches, f"doc_id {dict(rows.dtypes)['doc_id']}, toxic_score double")


def training_model(docs: DataFrame, labels: DataFrame) -> Toxicity | None:
    """Fitted without fold 2 of 4; of the other folds, the last one fits the logistic function."""
    return fit_toxicity(docs, labels.where(~held_out(F.col("doc_id"), 4, 2)), held_out(F.col("doc_id"), 4, 3))
