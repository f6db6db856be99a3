"""Benchmark passages in documents, by SimHash of item-sized windows.

Every document is read through windows as long as the benchmark's items, in
words. A window and an item have 64-bit SimHash fingerprints of their words,
which weigh `LONG` or 1 by length. An index over `BLOCKS` blocks of the items'
fingerprints lists, for every block value, the items within `RADIUS // BLOCKS`
bits of it: two fingerprints within `RADIUS` agree that closely in one block at
least, so the lists hold all of them, and a window is compared with a twentieth
of the items of its size. Candidates are verified exactly: the
similarity is the weight of the runs of `GRAM` words that window and item
share (with multiplicity), over the weight of the item's or the window's,
whichever is larger; from `SIMILAR` on a document holds the item.

Windows of long items start every `size // 13` words, and items whose lengths
differ by less share windows; verification tries every start in between. Items
are taken in blocks of about `ITEMS`, so what is broadcast is bounded; more
items mean more passes. Fingerprints are broadcast; a task makes the lists from
them, some 6 KB an item and 2 MB a window size.

A window at the verifier's own threshold may lie beyond the radius: of 100-word
items with 15 consecutive words replaced (similarity 0.8 and more) a test finds
over 0.9, of those without their last 16 words over 0.95.

Defined results: words are compared without case and punctuation; items and
documents without words match nothing; an item of fewer words than `GRAM` is
one run; rows that repeat a doc_id are answered one by one; rows that repeat an
item_id are one item's variants; null ids are kept as null. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tokens import Words, grams, mix, row_of, slices, split_words

GRAM = 5
SIMILAR = 0.8
RADIUS = 15
BLOCKS = 4
LONG = 2
ITEMS = 10_000
PIECE = 1 << 18
_BITS = 64 // BLOCKS
_ROWS = 512
_COMPARED = 1 << 21
_FEW = 32  # up to so many items are compared faster than their lists are read


def weights_of(words: Words) -> np.ndarray:
    return np.where(words.end - words.start > 3, LONG, 1).astype(np.int16)


def sign_sums(words: Words, most: int) -> np.ndarray:
    """Running sums of each bit's signed weights; a window's sum is a difference of two rows."""
    reach = most * LONG  # sums may wrap, differences of windows do not
    kind = np.int8 if reach < 1 << 7 else np.int16 if reach < 1 << 15 else np.int32
    rows = -(-(len(words.hash) + 1) // _ROWS)  # summed in blocks that fit the cache
    signed = np.zeros((rows * _ROWS, 64), kind)
    bits = np.unpackbits(words.hash.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.int8)
    bits += bits
    bits -= 1
    np.multiply(bits, weights_of(words).astype(np.int8)[:, None], out=signed[1:len(bits) + 1])
    sums = np.cumsum(signed.reshape(rows, _ROWS, 64), axis=1, dtype=kind)
    sums[1:] += np.cumsum(sums[:-1, -1], axis=0, dtype=kind)[:, None]
    return sums.reshape(-1, 64)[:len(bits) + 1]


def packed(sums: np.ndarray) -> np.ndarray:
    """The signs of rows of 64 sums as the bits of a number."""
    return np.packbits((sums > 0).ravel(), bitorder="little").view("<u8")


def fingerprints(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of the words start .. end - 1."""
    return packed(np.take(sums, end, axis=0) - np.take(sums, start, axis=0))


def window_size(words: int) -> int:
    """Lengths that differ by less than a stride share a window."""
    return words - words % stride(words)


def stride(size: int) -> int:
    return max(1, size // 13)


class Lists(NamedTuple):
    """For each block, whether items lie near a value, how many, where their list begins, and the lists."""

    listed: np.ndarray
    count: np.ndarray
    begin: np.ndarray
    items: list[np.ndarray]

    @staticmethod
    def of(prints: np.ndarray) -> Lists:
        near = np.array([0] + [sum(1 << b for b in bits) for n in range(1, RADIUS // BLOCKS + 1)
                               for bits in combinations(range(_BITS), n)], np.uint16)
        kind = np.uint16 if len(prints) <= 1 << 16 else np.uint32
        count, items = np.zeros((BLOCKS, 1 << _BITS), np.int32), []
        for i, own in enumerate(prints.astype("<u8").view("<u2").reshape(-1, BLOCKS).T):
            values = (own[:, None] ^ near).ravel()
            count[i] = np.bincount(values, minlength=1 << _BITS)
            items.append((np.argsort(values, kind="stable") // len(near)).astype(kind))
        return Lists(count > 0, count, np.cumsum(count, axis=1) - count, items)

    def within(self, found: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(window, item, distance) of all fingerprints in `found` and `prints` within the radius, each pair
        once, by window; windows are taken so many at a time that memory is bounded whatever the lists hold."""
        step = 1 + _COMPARED // len(prints)
        for first in range(0, len(found), step):
            part = found[first:first + step]
            if len(prints) <= _FEW:
                hit = np.zeros(len(part), bool)
                for i, value in enumerate(part.view("<u2").reshape(-1, BLOCKS).T):
                    hit |= self.listed[i][value]
                hit = np.flatnonzero(hit)
                distance = np.bitwise_count(part[hit][:, None] ^ prints).ravel()
                near = np.flatnonzero(distance <= RADIUS)
                yield first + hit[near // len(prints)], near % len(prints), distance[near]
                continue
            pairs = []
            for i, value in enumerate(part.view("<u2").reshape(-1, BLOCKS).T):
                window = np.flatnonzero(self.listed[i][value])
                value = value[window]
                many = self.count[i][value]
                upto = np.cumsum(many)
                owner = np.repeat(window, many)
                item = self.items[i][np.arange(len(owner)) + np.repeat(self.begin[i][value] + many - upto, many)]
                near = np.flatnonzero(np.bitwise_count(part[owner] ^ prints[item]) <= RADIUS)
                pairs.append(owner[near] * len(prints) + item[near])
            window, item = np.divmod(np.unique(np.concatenate(pairs)), len(prints))
            yield first + window, item, np.bitwise_count(part[window] ^ prints[item])


class Index(NamedTuple):
    """Items of one block: for each window size, its items and their fingerprints; and each item's runs,
    weights of runs, and number of words. `listed` adds the lists of each size."""

    ids: pa.Array
    sizes: list[tuple[int, np.ndarray, np.ndarray]]
    runs: list[np.ndarray]
    run_weights: list[np.ndarray]
    words: np.ndarray
    member: np.ndarray
    lists: list[Lists] | None = None

    def listed(self) -> Index:
        return self._replace(lists=[Lists.of(prints) for _, _, prints in self.sizes])

    @staticmethod
    def of(ids: pa.Array, texts: list) -> Index:
        words = split_words(pa.array([(t or "").lower() for t in texts], pa.large_string()))
        count = np.diff(words.first)
        sums = sign_sums(words, int(count.max(initial=0)))
        runs, first = grams(words.hash, words.first, GRAM)
        weight = run_weights(words, first)
        sizes = {}
        for i in np.flatnonzero(count):
            sizes.setdefault(window_size(int(count[i])), []).append(i)
        parts = []
        for size, own in sorted(sizes.items()):
            own = np.array(own)
            parts.append((size, own, fingerprints(sums, words.first[own], words.first[own] + size)))
        cut = [slice(a, b) for a, b in zip(first, first[1:])]
        member = [mix(runs[c] ^ mix(np.full(1, i, np.uint64))) for i, c in enumerate(cut)]
        return Index(ids, parts, [runs[c] for c in cut], [weight[c] for c in cut], count,
                     np.unique(np.concatenate(member)) if member else np.zeros(0, np.uint64))


def run_weights(words: Words, first: np.ndarray, k: int = GRAM) -> np.ndarray:
    """The weight of each run: of its words together."""
    total = np.concatenate(([0], np.cumsum(weights_of(words), dtype=np.int64)))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(first[-1]) - first[row] + words.first[row]
    return total[np.minimum(at + k, words.first[row + 1])] - total[at]


def shared_weight(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weight of the runs in common over the larger weight. Equal runs weigh the same."""
    left, i, n = np.unique(a, return_index=True, return_counts=True)
    right, m = np.unique(b, return_counts=True)
    _, x, y = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    return float((np.minimum(n[x], m[y]) * wa[i[x]]).sum() / max(wa.sum(), wb.sum()))


def grid(words: int, size: int) -> np.ndarray:
    """Starts of the windows that a slice of so many words has every stride, rows left aside."""
    return np.arange(0, words - size + 1, stride(size))


def outer_windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the first and the last window of each row, where the grid has none.

    A row that is a little shorter than the window is a window itself.
    """
    count, step = np.diff(first), stride(size)
    whole = np.flatnonzero(count >= size)
    ends = np.concatenate([first[whole], first[whole + 1] - size])
    ends = np.unique(ends[ends % step > 0])
    near = np.flatnonzero((count < size) & (count >= size * SIMILAR) & (count > 0))
    return np.concatenate([ends, first[near]]), np.concatenate([ends + size, first[near + 1]])


def candidates(words: Words, index: Index) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window start, item, Hamming distance) of all fingerprints within the radius, for one size after another."""
    if not len(words.hash) or not index.sizes:
        return
    sums, row = sign_sums(words, int(index.words.max())), row_of(words.first)
    left = words.first[1:][row] - np.arange(len(row))  # words of the row from each word on
    room_signs = np.empty(sums.shape, bool)  # used again for each size
    narrow = sums.astype(np.int8)  # enough for the differences of short windows
    rooms = {s.dtype: np.empty_like(s) for s in (narrow, sums)}
    for (size, own, prints), lists in zip(index.sizes, index.lists):
        start = grid(len(row), size)
        kept = narrow if size * LONG < 1 << 7 else sums
        space, signs = rooms[kept.dtype][:len(start)], room_signs[:len(start)]
        np.subtract(kept[size::stride(size)][:len(start)], kept[:max(len(row) - size + 1, 0):stride(size)], out=space)
        found = np.packbits(np.greater(space, 0, out=signs).ravel(), bitorder="little").view("<u8")
        inside = left[:max(len(row) - size + 1, 0):stride(size)] >= size
        more, end = outer_windows(words.first, size)
        start, found = np.concatenate([start[inside], more]), np.concatenate([found[inside], fingerprints(sums, more, end)])
        for window, item, distance in lists.within(found, prints):
            yield start[window], own[item], distance


class Hit(NamedTuple):
    row: int
    item: int
    start: int
    end: int
    similarity: float
    distance: int


def find_items(texts: pa.Array, index: Index) -> list[Hit]:
    """The best window of each item that a text holds. Texts are lowered before, items listed."""
    words = split_words(texts)
    of_size: dict[int, tuple] = {}
    best: dict[tuple[int, int], Hit] = {}
    for start, item, distance in candidates(words, index):
        row = np.searchsorted(words.first, start, "right") - 1
        k = int(index.words[item[:1]].min(initial=GRAM))  # items below GRAM words come alone in their size
        if k not in of_size:
            runs, first = grams(words.hash, words.first, k)
            of_size[k] = runs, first, run_weights(words, first, k)
        runs, first, weight = of_size[k]
        # runs of the window that the item has too: most candidates have none and end here
        begin = first[row] + start - words.first[row]
        many = np.minimum(np.maximum(index.words[item] - GRAM + 1, 1), first[row + 1] - begin)
        owner = np.repeat(np.arange(len(row)), many)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + begin[owner]
        key = mix(runs[at] ^ mix(item[owner].astype(np.uint64)))
        spot = np.minimum(np.searchsorted(index.member, key), len(index.member) - 1)
        common = np.bincount(owner, index.member[spot] == key, len(row))
        for c in np.flatnonzero(common >= 0.5 * many):
            r, i = int(row[c]), int(item[c])
            if (r, i) in best and best[r, i].similarity == 1:
                continue
            size, count = int(index.words[i]), int(words.first[r + 1] - words.first[r])
            slack = stride(size)
            offset = int(start[c] - words.first[r])
            for o in range(max(0, offset - slack), min(offset + slack, max(0, count - size)) + 1):
                a, b = first[r] + o, min(first[r] + o + max(size - GRAM + 1, 1), first[r + 1])
                alike = shared_weight(index.runs[i], index.run_weights[i], runs[a:b], weight[a:b])
                old = best.get((r, i))
                if alike >= SIMILAR - 1e-12 and (old is None or (alike, -o) > (old.similarity, -old.start)):
                    best[r, i] = Hit(r, i, o, min(o + size, count), alike, int(distance[c]))
    return [best[k] for k in sorted(best)]


def indexes(benchmark: DataFrame, items: int = ITEMS) -> Iterator[Index]:
    """Indexes of all items, in blocks of about `items` by hashed id."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    blocks = max(1, -(-rows.count() // items))
    for i in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).orderBy("item_id", "text").toArrow()
        yield Index.of(part["item_id"].combine_chunks(), part["text"].to_pylist())


def find_contamination(docs: DataFrame, benchmark: DataFrame, items: int = ITEMS) -> DataFrame:
    """(doc_id, item_id, start_word, end_word, similarity, distance): items that documents hold."""
    rows = docs.select("doc_id", F.lower(F.col("text").cast("string")).alias("text"))
    kinds = dict(rows.dtypes) | {"item_id": dict(benchmark.dtypes)["item_id"]}
    schema = (f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, start_word long, end_word long, "
              "similarity double, distance int")

    def search(index):
        shared = docs.sparkSession.sparkContext.broadcast(tuple(index))

        def batches(found):
            index = Index(*shared.value).listed()
            for batch in found:
                for part in slices(batch, "text", PIECE):
                    ids, hits = part.column("doc_id").to_pylist(), find_items(part.column("text"), index)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[h.row] for h in hits], part.schema.field("doc_id").type),
                         index.ids.take(pa.array([h.item for h in hits], pa.int64())),
                         pa.array([h.start for h in hits], pa.int64()), pa.array([h.end for h in hits], pa.int64()),
                         pa.array([h.similarity for h in hits], pa.float64()),
                         pa.array([h.distance for h in hits], pa.int32())],
                        ["doc_id", "item_id", "start_word", "end_word", "similarity", "distance"])

        return rows.mapInArrow(batches, schema)

    found = None
    for index in indexes(benchmark, items):
        found = search(index) if found is None else found.unionByName(search(index))
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, items: int = ITEMS) -> DataFrame:
    """Documents that hold no item, with their columns."""
    spark = docs.sparkSession
    lowered = "lowered"
    while lowered in docs.columns:
        lowered = f"_{lowered}"

    def clean(docs, index):
        shared = spark.sparkContext.broadcast(tuple(index))

        def batches(found):
            index = Index(*shared.value).listed()
            for batch in found:
                for part in slices(batch, lowered, PIECE):
                    keep = np.ones(part.num_rows, bool)
                    keep[[h.row for h in find_items(part.column(lowered), index)]] = False
                    yield part.drop_columns([lowered]).filter(pa.array(keep))

        return docs.withColumn(lowered, F.lower(F.col("text").cast("string"))).mapInArrow(batches, docs.schema)

    for index in indexes(benchmark, items):
        docs = clean(docs, index)
    return docs
