"""Language of documents by a linear-chain conditional random field over words.

A chain is a line of text, or a part of it of `CHAIN` words. Each word has
features: its first and last characters, its character trigrams, itself, and
the languages whose learned lexicon lists it. Unary weights and transitions are
learned together by the gradient of the chains' likelihood (forward-backward),
from lines of labelled documents; a share of the training chains joins lines of
two languages, so that switching inside a text has a learned price. Words of
code-switched text are labelled by their marginals, and a document's language
is the one with the largest sum of marginals; the score is its share.

The model is fitted on at most `SAMPLE_LINES` lines, chosen by hash and shared
out evenly among the languages. Feature weights live in `BUCKETS` hashed rows,
so what travels to tasks is bounded.

Defined results: `und` with score 0 for texts that are null or without a
letter, and for all texts if there is nothing to learn from; null languages are
not learned from; rows that repeat a doc_id are answered one by one. Extra
columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.tokens import Words, mix, row_of, slices, split_words
from shelfwise.llm.toxicity import gram_hashes
from shelfwise.session import materialize

SAMPLE_LINES = 12_000
CHAIN = 128
TRAIN_WORDS = 64
BUCKETS = 1 << 18
LISTED = 3  # occurrences that put a word into a language's lexicon
MIXED = 4  # every so many training chains joins two languages
STEPS = 40
_FIRST, _LAST = 2, 3


class Features(NamedTuple):
    """Pairs of word number and feature, for `count` words."""

    word: np.ndarray
    feature: np.ndarray
    count: int

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """The sum of the weight rows of each word's features."""
        return np.stack([np.bincount(self.word, w[self.feature], self.count) for w in weights.T], axis=1)

    def back(self, values: np.ndarray, rows: int) -> np.ndarray:
        """The sum of the words' value rows for each feature."""
        return np.stack([np.bincount(self.feature, v[self.word], rows) for v in values.T], axis=1)


def has_letter(words: Words, which: np.ndarray) -> np.ndarray:
    data = words.data
    plain = np.concatenate(([0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122))))
    out = plain[words.end[which]] > plain[words.start[which]]
    wide = np.concatenate(([0], np.cumsum(data >= 128)))
    for i in np.flatnonzero(~out & (wide[words.end[which]] > wide[words.start[which]])):
        out[i] = any(c.isalpha() for c in words.text(which[i]))
    return out


def word_features(words: Words, which: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray]) -> Features:
    """Features of chosen words. `lexicon`: ascending word hashes, and a row of flags per language for each."""
    size = words.end[which] - words.start[which]
    whole = size + 2
    first = np.cumsum(whole) - whole
    marked = np.full(int(whole.sum()), _FIRST, np.uint8)
    marked[first + whole - 1] = _LAST
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    marked[np.repeat(first + 1, size) + inside] = words.data[np.repeat(words.start[which], size) + inside]
    codes = np.frombuffer(marked.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begin, end = np.flatnonzero(codes == _FIRST), np.flatnonzero(codes == _LAST)
    owner = np.cumsum(codes == _FIRST) - 1
    found = []

    def add(word: np.ndarray, kind: int, hashes: np.ndarray) -> None:
        found.append((word, mix(hashes + np.uint64(kind)) & np.uint64(BUCKETS - 1)))

    grams = gram_hashes(codes, 3)
    at = np.flatnonzero(np.arange(len(codes)) >= begin[owner] + 2)
    add(owner[at], 1, grams[at])
    number = np.arange(len(which))
    for k in (2, 4, 5):
        grams = gram_hashes(codes, k)
        long = np.flatnonzero(end - begin >= k)
        add(number[long], 2, grams[begin[long] + k - 1])
        add(number[long], 3, grams[end[long]])
    add(number, 4, words.hash[which])
    word = np.concatenate([w for w, _ in found])
    feature = np.concatenate([f for _, f in found]).astype(np.int64)
    listed, flags = lexicon
    if len(listed):
        spot = np.minimum(np.searchsorted(listed, words.hash[which]), len(listed) - 1)
        hit = listed[spot] == words.hash[which]
        own, lang = np.nonzero(flags[spot] & hit[:, None])
        word, feature = np.concatenate([word, own]), np.concatenate([feature, BUCKETS + lang])
    return Features(word, feature, len(which))


class Chains(NamedTuple):
    """Positions of words in chains, longest chain first: at[t] has the t-th word of the first len(at[t]) chains."""

    at: list[np.ndarray]

    @staticmethod
    def of(begin: np.ndarray, size: np.ndarray) -> Chains:
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        alive = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), "left")
        return Chains([begin[:n] + t for t, n in enumerate(alive)])


def marginals(unary: np.ndarray, move: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray, float]:
    """Label marginals of each position, expected transitions, and the log likelihood's normaliser."""
    top = unary.max(axis=1, keepdims=True)
    local, step = np.exp(unary - top), np.exp(move - move.max())
    ahead, behind = np.zeros_like(local), np.ones_like(local)
    normal = float(top.sum())
    for t, at in enumerate(chains.at):
        now = local[at] if not t else (ahead[chains.at[t - 1][:len(at)]] @ step) * local[at]
        total = now.sum(axis=1, keepdims=True)
        normal += float(np.log(total).sum()) + (move.max() * len(at) if t else 0)
        ahead[at] = now / total
    used = np.zeros_like(move)
    for t in range(len(chains.at) - 1, 0, -1):
        at, before = chains.at[t], chains.at[t - 1][:len(chains.at[t])]
        told = local[at] * behind[at]
        back = told @ step.T
        total = (ahead[before] * back).sum(axis=1, keepdims=True)
        used += (ahead[before] / total).T @ told * step
        behind[before] = back / back.sum(axis=1, keepdims=True)
    out = ahead * behind
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-300), used, normal


class Tagger(NamedTuple):
    langs: list[str]
    lexicon: tuple[np.ndarray, np.ndarray]
    weights: np.ndarray
    move: np.ndarray

    def tag(self, words: Words, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Marginals of each word, over chains that cover all words."""
        _, which, back = np.unique(words.hash, return_index=True, return_inverse=True)
        unary = word_features(words, which, self.lexicon).sums(self.weights)[back]
        return marginals(unary, self.move, Chains.of(begin, size))[0]


def with_letters(words: Words) -> Words:
    """The words that have a letter."""
    _, which, back = np.unique(words.hash, return_index=True, return_inverse=True)
    keep = has_letter(words, which)[back]
    first = np.concatenate(([0], np.cumsum(keep)))[words.first]
    return Words(words.hash[keep], words.start[keep], words.end[keep], first, words.data)


def cut_chains(words: Words, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of each chain: lines of a row, in parts of `most` words."""
    if not len(words.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = np.searchsorted(np.flatnonzero(words.data == 10), words.start) + row_of(words.first)
    begin = np.flatnonzero(np.diff(line, prepend=-1))
    size = np.diff(np.append(begin, len(line)))
    parts = -(-size // most)
    inner = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(begin, parts) + inner * most
    return start, np.minimum(np.repeat(begin + size, parts) - start, most)


def fit_tagger(lines: list[str], labels: list[str]) -> Tagger:
    """Learn from lines of text and their languages, in the order given."""
    langs = sorted(set(labels))
    label = np.array([langs.index(x) for x in labels])
    words = split_words(pa.array(lines, pa.string()))
    gold = label[row_of(words.first)]
    _, which, back = np.unique(words.hash, return_index=True, return_inverse=True)
    count = np.stack([np.bincount(back[gold == i], minlength=len(which)) for i in range(len(langs))], axis=1)
    often = np.flatnonzero(count.max(axis=1) >= LISTED)
    lexicon = (words.hash[which][often], count[often] >= np.maximum(LISTED, 0.5 * count[often].max(axis=1, keepdims=True)))
    features = word_features(words, which, lexicon)
    begin, size = words.first[:-1], np.diff(words.first)
    join = np.arange(len(lines)) % MIXED == 0  # joined to the next line if that has another language
    join[:-1] &= label[:-1] != label[1:]
    join[-1:] = False
    head = np.ones(len(lines), bool)
    head[1:] = ~join[:-1]
    size = np.where(join, size + np.append(size[1:], 0), size)[head]
    chains = Chains.of(begin[head][size > 0], size[size > 0])
    seen = np.zeros((len(langs), len(langs)))
    for t in range(1, len(chains.at)):
        np.add.at(seen, (gold[chains.at[t - 1][:len(chains.at[t])]], gold[chains.at[t]]), 1)
    rows = BUCKETS + len(langs)
    weights, move = np.zeros((rows, len(langs))), np.zeros((len(langs), len(langs)))
    pace, pace_move = np.full_like(weights, 1e-8), np.full_like(move, 1e-8)
    right = np.zeros((len(back), len(langs)))
    right[np.arange(len(back)), gold] = 1
    for _ in range(STEPS):
        found, used, _ = marginals(features.sums(weights)[back], move, chains)
        wrong = np.stack([np.bincount(back, e, len(which)) for e in (found - right).T], axis=1)
        slope = features.back(wrong, rows) / len(back) + 1e-6 * weights
        slope_move = (used - seen) / len(back) + 1e-4 * move
        pace += slope ** 2
        pace_move += slope_move ** 2
        weights -= 0.3 * slope / np.sqrt(pace)
        move -= 0.3 * slope_move / np.sqrt(pace_move)
    return Tagger(langs, lexicon, weights.astype(np.float32), move)


def train_tagger(docs: DataFrame, sample_lines: int = SAMPLE_LINES) -> Tagger | None:
    """Fit on lines of the documents given, which have `doc_id`, `text` and `lang`; None if there are none.

    Leave held-out documents away before. The table of languages, a row each, is
    broadcast.
    """

    def batches(found):
        for batch in found:
            for part in slices(batch, "text"):
                words = with_letters(split_words(part.column("text")))
                begin, size = cut_chains(words, TRAIN_WORDS)
                row = row_of(words.first)[begin]
                lang = part.column("lang").take(pa.array(row))
                lines = [" ".join(words.text(i) for i in range(a, a + n)) for a, n in zip(begin, size)]
                yield pa.RecordBatch.from_arrays([lang, pa.array(lines, pa.string())], ["lang", "line"])

    rows = docs.where("lang is not null").select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    counts = materialize(rows.groupBy("lang").agg(F.count("*").alias("rows")), "langs")
    langs = counts.count()
    if not langs:
        return None
    each = max(1, sample_lines // langs)
    # a threshold for each language leaves about `each` documents of it, whatever their number
    share = F.least(F.lit(1.0), F.lit(2.0 * each) / F.col("rows"))
    chosen = (rows.join(F.broadcast(counts), "lang")
              .where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
              .where("text is not null").select("lang", F.lower("text").alias("text")))
    lines = chosen.mapInArrow(batches, "lang string, line string").where("line <> ''")
    pick = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("line", "lang"), "line"))
    lines = lines.withColumn("order", pick).where(F.col("order") <= each).drop("order")
    kept = lines.orderBy(F.xxhash64("line", "lang"), "line", "lang").limit(sample_lines).toArrow()
    return fit_tagger(kept["line"].to_pylist(), kept["lang"].to_pylist()) if kept.num_rows else None


def tag_batch(texts: pa.Array, tagger: Tagger) -> tuple[list[str], np.ndarray]:
    """The language and score of each text. Texts are lowered before."""
    words = with_letters(split_words(texts))
    langs, score = ["und"] * len(texts), np.zeros(len(texts))
    sums = np.zeros((len(texts), len(tagger.langs)))
    if len(words.hash):
        found = tagger.tag(words, *cut_chains(words, CHAIN))
        row = row_of(words.first)
        sums = np.stack([np.bincount(row, f, len(texts)) for f in found.T], axis=1)
    total = sums.sum(axis=1)
    for i in np.flatnonzero(total == 0):  # letters that are not part of a word
        if any(c.isalpha() for c in texts[i].as_py() or ""):
            sums[i], total[i] = 1, len(tagger.langs)
    best = sums.argmax(axis=1)
    for i in np.flatnonzero(total):
        langs[i], score[i] = tagger.langs[best[i]], sums[i, best[i]] / total[i]
    return langs, np.minimum(score, 1.0)


def predict_language(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """(doc_id, lang_pred, score) of each row, from the text alone."""
    rows = docs.select("doc_id", F.lower(F.col("text").cast("string")).alias("text"))
    if tagger is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(tagger))

    def batches(found):
        tagger = Tagger(*shared.value)
        for batch in found:
            for part in slices(batch, "text"):
                langs, score = tag_batch(part.column("text"), tagger)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score)],
                                                 ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(batches, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")


def tag_words(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """(doc_id, word_no, word, lang, chance): the label of each word with a letter, for code-switched text."""
    rows = docs.select("doc_id", F.lower(F.col("text").cast("string")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(tagger))

    def batches(found):
        tagger = Tagger(*shared.value)
        for batch in found:
            for part in slices(batch, "text"):
                words = with_letters(split_words(part.column("text")))
                if not len(words.hash):
                    continue
                row, chance = row_of(words.first), tagger.tag(words, *cut_chains(words, CHAIN))
                best = chance.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(np.arange(len(row)) - words.first[row]),
                     pa.array([words.text(i) for i in range(len(row))], pa.string()),
                     pa.array([tagger.langs[b] for b in best], pa.string()),
                     pa.array(chance[np.arange(len(row)), best])],
                    ["doc_id", "word_no", "word", "lang", "chance"])

    return rows.mapInArrow(batches, f"doc_id {dict(rows.dtypes)['doc_id']}, word_no long, word string, lang string, "
                                    "chance double")
