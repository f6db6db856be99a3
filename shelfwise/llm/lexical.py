"""Ranked lexical search over bit-sliced Bloom signatures.

The index has a row per block of documents: a bitmap whose columns are the
block's documents and whose rows are the positions of a Bloom filter. A document
sets the positions of each of its terms, once for every level of `levels` that
the term's occurrences reach. The AND of a term's rows thus tells which documents
may hold it so often, and never misses one that does; documents of a like number
of keys share a block, so its height fits all of them.

For an item, the levels' bitmaps weighted by its terms and by what a level adds
to a term's factor in a document of that length sum up to an upper bound of each
document's score. A first pass over the index finds the documents of the highest
bounds, and their exact scores give a score that the k-th hit reaches at least.
A second pass lists every document whose bound reaches it, and only those are
read and scored exactly. So nothing is lost, whatever the bitmaps overestimate.

A document is known by a hash of its id and text. Two of equal hash are scored
both, so that equal rows are ranked one by one. Items are searched in tiles of
bounded number and size. Per tile, the driver holds the items, the number of
documents of each of their terms, and one score per item.

Defined results: terms are maximal runs of ASCII letters, digits and characters
beyond ASCII, of which A-Z are lowered; a null or empty text has none and is no
hit; rows that share an item_id, also a null one, are one item of all their
terms; an item without terms, or whose terms no document holds, has no rows; of
equal scores the smaller doc_id ranks first, a null one last. Empty tables give
no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.tokens import Words, ascii_lower, mix, row_of, slices, split_words
from shelfwise.session import materialize, release

K = 10
SEEDS = 4  # times k documents of the highest bounds are scored first
BITS = 12  # of a signature, per key
HASHES = 6
BLOCK_DOCS = 1024
CELLS = 1 << 24  # of a block's bitmap
PENDING = 1 << 21  # keys gathered before blocks are cut
ITEMS = 20_000  # of a tile
ITEM_BYTES = 32 << 20  # of a tile's texts
CHUNK = 32  # items whose bounds are computed at once
BROADCAST_PAIRS = 1 << 20  # documents to read are broadcast up to here (some 20 bytes each), joined by shuffle beyond
_WORD = np.array([chr(i).isalnum() if i < 128 else True for i in range(256)])


def levels(most: int) -> np.ndarray:
    """1, 2, 3, 4, 6, 8, 12, ... as far as `most`, and the next one."""
    found = [1, 2]
    while found[-1] <= most:
        found += [3 * found[-1] // 2, 2 * found[-1]]
    return np.array(found[:int(np.searchsorted(found, most, "right")) + 1])


def terms_of(texts: pa.Array) -> Words:
    return split_words(ascii_lower(texts), _WORD.__getitem__)


def occurrences(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) of each different pair, ascending."""
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (term[1:] != term[:-1]))[:len(row)])
    return row[new], term[new], np.diff(np.append(new, len(row)))


def positions(term: np.ndarray, level: int | np.ndarray, height: int) -> np.ndarray:
    """`HASHES` rows of a bitmap for each term at a level (its number)."""
    seed = mix(term + mix(np.atleast_1d(level).astype(np.uint64) + np.uint64(1)))
    step = mix(seed) | np.uint64(1)
    return ((seed[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(height)).astype(np.int64)


class Pending:
    """Documents whose blocks are not cut yet."""

    def __init__(self):
        self.keys, self.sizes, self.counts, self.terms, self.steps = [], [], [], [], []
        self.many = 0

    def add(self, key: np.ndarray, words: Words) -> None:
        row, term, times = occurrences(row_of(words.first), words.hash)
        size = np.diff(words.first)
        top = np.searchsorted(levels(int(times.max(initial=1))), times, "right")  # levels that a term reaches
        step = np.arange(int(top.sum())) - np.repeat(np.cumsum(top) - top, top)
        full = size > 0
        self.keys.append(key[full])
        self.sizes.append(size[full])
        self.counts.append(np.bincount(np.repeat(row, top), minlength=len(size))[full])
        self.terms.append(np.repeat(term, top))
        self.steps.append(step)
        self.many += len(step)

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, int, bytes]]:
        """(keys, sizes, height, bitmap) of each block; a bitmap's row has a bit per document, in whole bytes."""
        keys, sizes, counts, terms, steps = (np.concatenate(x) for x in (
            self.keys, self.sizes, self.counts, self.terms, self.steps))
        first = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        at = 0
        while at < len(order):
            height = max(64, BITS * int(counts[order[at]]))
            room = max(1, min(BLOCK_DOCS, CELLS // height))
            alike = int(np.searchsorted(-counts[order], -counts[order[at]] // 2, "right"))
            own = order[at:min(at + room, max(alike, at + 1))]
            at += len(own)
            column = np.repeat(np.arange(len(own)), counts[own])
            spot = np.arange(len(column)) - np.repeat(np.cumsum(counts[own]) - counts[own], counts[own])
            spot += np.repeat(first[own], counts[own])
            cells = np.zeros((height, -(-len(own) // 8) * 8), bool)
            cells[positions(terms[spot], steps[spot], height).ravel(), np.repeat(column, HASHES)] = True
            yield keys[own], sizes[own], height, np.packbits(cells, axis=1, bitorder="little").tobytes()


def keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text) of each row."""
    text = F.col("text").cast("string")
    return docs.select(F.xxhash64("doc_id", text).alias("key"), "doc_id", text.alias("text"))


def build_index(docs: DataFrame) -> DataFrame:
    """(keys, sizes, height, bitmap) of each block of documents that have terms."""

    def batches(found):
        pending = Pending()

        def cut():
            for keys, sizes, height, bitmap in pending.blocks() if pending.keys else ():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                     pa.array([height], pa.int64()), pa.array([bitmap], pa.binary())],
                    ["keys", "sizes", "height", "bitmap"])

        for batch in found:
            for part in slices(batch, "text"):
                pending.add(part.column("key").to_numpy(), terms_of(part.column("text")))
                if pending.many >= PENDING:
                    yield from cut()
                    pending = Pending()
        yield from cut()

    return keyed(docs).select("key", "text").mapInArrow(
        batches, "keys array<long>, sizes array<long>, height long, bitmap binary")


class Corpus(NamedTuple):
    """Documents with terms, and all their terms."""

    docs: int
    words: int

    def norms(self, sizes: np.ndarray) -> np.ndarray:
        """A document's m, by its number of terms."""
        kinds, back = np.unique(sizes, return_inverse=True)
        return np.array([10 + 90 * int(n) * self.docs // self.words for n in kinds], np.int64)[back]


def factors(times: int | np.ndarray, norms: np.ndarray) -> np.ndarray:
    """What each occurrence count multiplies a term's weight by."""
    return 1_000_000_000 * times // (1000 * times + 8 * norms)


class Items(NamedTuple):
    """Item i has the terms `terms[own[first[i]:first[i + 1]]]`; `weights` of the different `terms`, ascending."""

    ids: list
    terms: np.ndarray
    first: np.ndarray
    own: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(ids: list, texts: list) -> Items:
        order = {name: i for i, name in enumerate(dict.fromkeys(ids))}
        words = terms_of(pa.array(texts, pa.large_string()))
        row = np.array([order[name] for name in ids], np.int64)[row_of(words.first)]
        row, term, _ = occurrences(row, words.hash)
        terms, own = np.unique(term, return_inverse=True)
        first = np.searchsorted(row, np.arange(len(order) + 1))
        return Items(list(order), terms, first, own, np.zeros(len(terms), np.int64))

    def weighed(self, held: dict[int, int], corpus: Corpus) -> Items:
        """With weights, given how many documents hold each term (by its place)."""
        weights = [floor(1000 * log((2 * corpus.docs + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(self.terms))]
        return self._replace(weights=np.array(weights, np.int64))

    def known(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place of the term, times) of the terms that any item has."""
        spot = np.minimum(np.searchsorted(self.terms, words.hash), max(len(self.terms) - 1, 0))
        mine = np.flatnonzero(self.terms[spot] == words.hash) if len(self.terms) else np.zeros(0, np.int64)
        return occurrences(row_of(words.first)[mine], spot[mine])

    def chunks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(items, places of their terms, weight of each such term in each item) of `CHUNK` items at a time."""
        for a in range(0, len(self.ids), CHUNK):
            b = min(a + CHUNK, len(self.ids))
            own = self.own[self.first[a]:self.first[b]]
            if not len(own):
                continue
            places, column = np.unique(own, return_inverse=True)
            table = np.zeros((b - a, len(places)))
            table[np.repeat(np.arange(b - a), np.diff(self.first[a:b + 1])), column] = self.weights[own]
            yield slice(a, b), places, table


def bounds(items: Items, corpus: Corpus, sizes: np.ndarray, height: int, bitmap: bytes,
           chunks: list) -> Iterator[tuple[slice, np.ndarray]]:
    """(items, upper bound of each document's score) for the documents of a block."""
    rows = np.frombuffer(bitmap, np.uint8).reshape(height, -1)
    norms, steps = corpus.norms(sizes), levels(int(sizes.max()))
    adds = [factors(int(steps[1]) - 1, norms)]
    for low, high in zip(steps[1:], steps[2:]):
        adds.append(factors(int(high) - 1, norms) - factors(int(low) - 1, norms))
    for own, places, table in chunks:
        total, held = np.zeros((len(table), len(sizes))), None
        for level, add in enumerate(adds):
            found = np.bitwise_and.reduce(rows[positions(items.terms[places], level, height)], axis=1)
            found = found if held is None else found & held
            live = found.any(axis=1)
            places, table, held = places[live], table[:, live], found[live]
            if not len(places):
                break
            bits = np.unpackbits(held, axis=1, count=len(sizes), bitorder="little").astype(np.float64)
            total += (table @ bits) * add  # whole numbers far below 2^53
        yield own, total


def _sent(df: DataFrame, items: Items, corpus: Corpus):
    """Items and corpus as a broadcast of tuples and arrays, which any worker can load."""
    return df.sparkSession.sparkContext.broadcast((tuple(items._replace(ids=[None] * len(items.ids))), tuple(corpus)))


def highest_bounds(index: DataFrame, items: Items, corpus: Corpus, k: int) -> DataFrame:
    """(item, key) of the documents with the k highest bounds of each item."""
    shared = _sent(index, items, corpus)

    def batches(found):
        items, corpus = Items(*shared.value[0]), Corpus(*shared.value[1])
        chunks = list(items.chunks())
        top, names = np.zeros((len(items.ids), k)), np.zeros((len(items.ids), k), np.int64)
        for batch in found:
            for keys, sizes, height, bitmap in zip(*(batch.column(c) for c in ("keys", "sizes", "height", "bitmap"))):
                keys, sizes = keys.values.to_numpy(), sizes.values.to_numpy()
                for own, total in bounds(items, corpus, sizes, height.as_py(), bitmap.as_buffer(), chunks):
                    score = np.concatenate([top[own], total], axis=1)
                    key = np.concatenate([names[own], np.broadcast_to(keys, total.shape)], axis=1)
                    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
                    top[own], names[own] = np.take_along_axis(score, best, 1), np.take_along_axis(key, best, 1)
        item, place = np.nonzero(top)
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(names[item, place]),
                                          pa.array(top[item, place])], ["item", "key", "bound"])

    found = index.mapInArrow(batches, "item int, key long, bound double").distinct()
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "key"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item", "key")


def not_excluded(index: DataFrame, items: Items, corpus: Corpus, least: np.ndarray) -> DataFrame:
    """(item, key) of all documents whose bound reaches `least` of the item."""
    shared, floor_ = _sent(index, items, corpus), index.sparkSession.sparkContext.broadcast(least)

    def batches(found):
        items, corpus = Items(*shared.value[0]), Corpus(*shared.value[1])
        chunks, least = list(items.chunks()), floor_.value
        for batch in found:
            for keys, sizes, height, bitmap in zip(*(batch.column(c) for c in ("keys", "sizes", "height", "bitmap"))):
                keys, sizes = keys.values.to_numpy(), sizes.values.to_numpy()
                for own, total in bounds(items, corpus, sizes, height.as_py(), bitmap.as_buffer(), chunks):
                    item, place = np.nonzero(total >= least[own][:, None])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((item + own.start).astype(np.int32)), pa.array(keys[place])], ["item", "key"])

    return index.mapInArrow(batches, "item int, key long")


def exact_scores(docs: DataFrame, pairs: DataFrame, items: Items, corpus: Corpus) -> DataFrame:
    """(item, doc_id, score) of every row of `docs` (key, doc_id, text) that `pairs` (item, key) names."""
    shared = _sent(docs, items, corpus)

    def batches(found):
        items, corpus = Items(*shared.value[0]), Corpus(*shared.value[1])
        for batch in found:
            for part in slices(batch, "text"):
                words = terms_of(part.column("text"))
                norms = corpus.norms(np.diff(words.first))
                row, place, times = items.known(words)
                value = items.weights[place] * factors(times, norms[row])
                code = np.append(row * len(items.terms) + place, -1)  # a place past the last is never equal
                asked = part.column("items")
                owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(asked).to_numpy())
                item = asked.flatten().to_numpy().astype(np.int64)
                many = np.diff(items.first)[item]
                begin = np.cumsum(many) - many
                term = items.own[np.arange(int(many.sum())) - np.repeat(begin - items.first[item], many)]
                wanted = np.repeat(owner, many) * len(items.terms) + term
                spot = np.searchsorted(code[:-1], wanted)
                each = np.where(code[spot] == wanted, np.append(value, 0)[spot], 0)
                score = np.add.reduceat(each, begin) if len(begin) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item.astype(np.int32)), part.column("doc_id").take(pa.array(owner)),
                     pa.array(score.astype(np.int64))], ["item", "doc_id", "score"])

    many = pairs.count()
    asked = pairs.groupBy("key").agg(F.collect_set("item").alias("items"))
    rows = docs.join(F.broadcast(asked) if many <= BROADCAST_PAIRS else asked, "key")
    return rows.select("doc_id", "text", "items").mapInArrow(
        batches, f"item int, doc_id {dict(docs.dtypes)['doc_id']}, score long").where("score > 0")


def term_holders(docs: DataFrame, items: Items) -> dict[int, int]:
    """How many documents hold each term of the items, by the term's place."""
    shared = _sent(docs, items, Corpus(0, 0))

    def batches(found):
        items = Items(*shared.value[0])
        held = np.zeros(len(items.terms), np.int64)
        for batch in found:
            for part in slices(batch, "text"):
                held += np.bincount(items.known(terms_of(part.column("text")))[1], minlength=len(held))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["place", "held"])

    found = docs.select("text").mapInArrow(batches, "place long, held long").groupBy("place").agg(F.sum("held").alias("held"))
    return dict(zip(*found.toArrow().to_pydict().values()))


def tiles(benchmark: DataFrame, items: int = ITEMS) -> Iterator[Items]:
    """All items, in tiles by hashed id."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    many = max(1, -(-size["rows"] // items), -(-size["bytes"] // ITEM_BYTES))
    for i in range(many):
        part = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(many)) == i).orderBy("item_id", "text").toArrow()
        yield Items.of(part["item_id"].to_pylist(), part["text"].to_pylist())


def search(docs: DataFrame, benchmark: DataFrame, k: int = K, items: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 of each item."""
    spark, rows = docs.sparkSession, keyed(docs)
    kinds = dict(benchmark.dtypes) | {"doc_id": dict(docs.dtypes)["doc_id"]}
    schema = f"item_id {kinds['item_id']}, rank int, doc_id {kinds['doc_id']}, score long"
    index = materialize(build_index(docs), "signatures")
    total = index.agg(F.sum(F.size("sizes")).alias("docs"),
                      F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)).alias("words")).first()
    corpus, answers = Corpus(total["docs"] or 0, total["words"] or 0), spark.createDataFrame([], schema)
    for asked in tiles(benchmark, items) if corpus.docs else ():
        asked = asked.weighed(term_holders(rows, asked), corpus)
        first = materialize(highest_bounds(index, asked, corpus, SEEDS * k), "seeds")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        reached = (exact_scores(rows, first, asked, corpus).withColumn("rank", rank).where(F.col("rank") == k)
                   .select("item", "score").toArrow().to_pydict())
        least = np.ones(len(asked.ids))
        least[reached["item"]] = reached["score"]
        pairs = materialize(not_excluded(index, asked, corpus, least), "pairs")
        release(first)
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        ranked = (exact_scores(rows, pairs, asked, corpus).withColumn("rank", place).where(F.col("rank") <= k))
        names = spark.createDataFrame(list(enumerate(asked.ids)), f"item int, item_id {kinds['item_id']}")
        answers = answers.unionByName(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    release(index)
    return answers
