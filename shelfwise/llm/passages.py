"""Passages that repeat across documents, by a sparse suffix array.

Words are the characters of the suffixes. Of each document only the suffixes at
minimiser positions are kept: the smallest hashed run of `GRAM` words in every
window, chosen so that any passage of `LEAST` words holds one, at the same
place in every copy. Suffixes whose first run occurs in no other document end
there. The others are sorted with the words that follow and precede, and each is
compared with its neighbours of other documents on both sides. Suffixes that
agree in all words that a passage through their first run could have are
compared with the first of them only, so a group of copies makes a star.
Neighbours that could reach `LEAST` words together are extended left and right
over the texts of both documents.

Suffixes that agree only in part need not be neighbours. So where the suffixes
of a run do not all agree, the first document of each group of equal ones tells
the hash of every passage of `LEAST` words through the run, and each of these is
compared with the first document that has it, too. Nothing depends on what a
sort places side by side.

Sorting goes by ranges of the whole key, document and position included, so a
passage that very many documents share is spread over as many tasks as it
fills, and pairs grow with the suffixes, not with their square. Where ranges
meet, the outermost suffixes are compared apart.

Defined results: words are compared without case and punctuation; null, empty
and shorter texts have no passages; repeats inside one document do not count;
rows that share a doc_id are one document and have the spans of each of their
texts; rows of null doc_id take no part. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.tokens import grams, mix, row_of, slices, split_words
from shelfwise.session import materialize, shuffle_partitions

LEAST = 50
GRAM = 16
_WINDOW = LEAST - GRAM + 1


def minimisers(hashes: np.ndarray, first: np.ndarray, window: int = _WINDOW) -> np.ndarray:
    """Positions of the smallest hash in each window of a row, the last one of equals.

    If these reach the end of the window, the first one of that stretch stands for it, and in longer stretches every
    `window`-th; so what a window chooses depends on the window only, unless all of it is equal.
    """
    count = np.diff(first)
    windows = np.maximum(count - window + 1, 0)
    row = np.repeat(np.arange(len(count)), windows)
    start = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows) + first[row]
    if not len(start):
        return start
    # smallest of each window by doubling: every step covers twice the width
    spot = np.arange(len(hashes))
    width = 1

    def smaller(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(hashes[b] <= hashes[a], b, a)  # b stands to the right

    while width * 2 <= window:
        shifted = np.append(spot[width:], np.full(min(width, len(spot)), len(hashes) - 1))[:len(spot)]
        spot = smaller(spot, shifted)  # sound for windows that stay inside their row, and only those are read
        width *= 2
    chosen = smaller(spot[start], spot[start + window - width])
    equal = np.zeros(len(hashes), bool)
    equal[1:] = hashes[1:] == hashes[:-1]
    equal[first[:-1][count > 0]] = False
    at = np.arange(len(hashes))
    run = np.maximum.accumulate(np.where(equal, 0, at))[chosen]
    early = np.where(run >= start, run, start + (run - start) % window)
    return np.unique(np.where(chosen == start + window - 1, early, chosen))


def anchors(docs: DataFrame) -> DataFrame:
    """(anchor, doc_id, pos): the suffixes that are kept, with the hash of their first run."""

    def batches(found):
        for batch in found:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                runs, first = grams(words.hash, words.first, GRAM)
                at = minimisers(runs, first)
                row = row_of(first)[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(runs[at].astype(np.int64)), part.column("doc_id").take(pa.array(row)),
                     pa.array((at - first[row]).astype(np.int32))], ["anchor", "doc_id", "pos"])

    return _texts(docs).mapInArrow(batches, "anchor long, doc_id long, pos int")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))


def block_hashes(hashes: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, size: int,
                 step: int) -> np.ndarray:
    """Hash of the `size` words from each place on (step 1) or before it, going back (step -1).

    Where the row, low to high, ends before, the hash is of the words that are left and differs from whole blocks'.
    """
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        spot = at + j if step > 0 else at - 1 - j
        inside = (spot >= low) & (spot < high)
        out[inside] = mix(out[inside] + hashes[spot[inside]])
    return out


def contexts(kept: DataFrame) -> DataFrame:
    """(anchor, after1, after2, before1, before2, doc_id, pos) of the positions `at` of each text."""

    def batches(found):
        names = ["anchor", "after1", "after2", "before1", "before2", "doc_id", "pos"]
        for batch in found:
            for part in slices(batch, "text"):
                words, spots = split_words(part.column("text")), part.column("at")
                row = np.repeat(np.arange(len(spots)), spots.value_lengths().to_numpy())
                pos = spots.flatten().to_numpy()
                low, high = words.first[row], words.first[row + 1]
                kept = low + pos + GRAM <= high  # another row of this id may be longer
                row, pos, low, high = row[kept], pos[kept], low[kept], high[kept]
                columns = [block_hashes(words.hash, low + pos + d, low, high, n, s) for d, n, s in (
                    (0, GRAM, 1), (GRAM, GRAM, 1), (2 * GRAM, LEAST - 2 * GRAM, 1),
                    (0, GRAM, -1), (-GRAM, _WINDOW - 1 - GRAM, -1))]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c.astype(np.int64)) for c in columns), part.column("doc_id").take(pa.array(row)),
                     pa.array(pos.astype(np.int32))], names)

    return kept.select("doc_id", "text", "at").mapInArrow(
        batches, "anchor long, after1 long, after2 long, before1 long, before2 long, doc_id long, pos int")


def _pairs(rows: dict[str, np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Neighbours in other documents that can reach `LEAST` words, the rows that lack one at an end, and the
    rows of first documents of a group of copies that is not known to be all of its anchor.

    `rows` are columns in sorted order.
    """
    anchor, doc = rows["anchor"], rows["doc_id"]
    n, at = len(anchor), np.arange(len(anchor))

    def stretches(*columns: str) -> tuple[np.ndarray, np.ndarray]:
        """First row and end of the stretch of equal values that each row is in."""
        new = np.zeros(n, bool)
        new[:1] = True
        for c in columns:
            new[1:] |= rows[c][1:] != rows[c][:-1]
        starts = np.flatnonzero(new)
        return np.maximum.accumulate(np.where(new, at, 0)), np.append(starts[1:], n)[np.cumsum(new) - 1]

    begin, end = stretches("anchor", "doc_id")
    before, after = begin - 1, end
    head, tail = stretches(*_KEY)
    several = doc[head] != doc[tail - 1]  # copies in several documents: sorted by document, the first one leads
    follow = np.flatnonzero(several & (doc != doc[head]))
    own = np.flatnonzero(several & (doc == doc[head]))
    left = (before >= 0) & (anchor[before] == anchor) & ~several
    right = (after < n) & (anchor[np.minimum(after, n - 1)] == anchor) & ~several
    a = np.concatenate([at[left], at[right], follow, own])
    b = np.concatenate([before[left], after[right], head[follow], np.minimum(end[own], n - 1)])
    one, two = rows["after1"][a] == rows["after1"][b], rows["after2"][a] == rows["after2"][b]
    back, far = rows["before1"][a] == rows["before1"][b], rows["before2"][a] == rows["before2"][b]
    endless = np.int64(1 << 40)
    reach = (np.where(one, np.where(two, endless, LEAST - 1), 2 * GRAM - 1)
             + np.where(back, np.where(far, endless, _WINDOW - 2), GRAM - 1))
    a, b = a[reach >= LEAST], b[reach >= LEAST]
    swap = doc[a] > doc[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    outer = (before < 0) | (after >= n)  # the first and the last run
    low, high = stretches("anchor")
    whole = (head == low) & (tail == high) & (low > 0) & (high < n)
    unlike = ~whole & (doc == doc[head])
    return [doc[a], rows["pos"][a], doc[b], rows["pos"][b]], np.flatnonzero(outer), np.flatnonzero(unlike)


_KEY = ["anchor", "after1", "after2", "before1", "before2"]
_COLUMNS = ["anchor", "after1", "after2", "before1", "before2", "doc_id", "pos"]
_PAIR = ["a", "a_pos", "b", "b_pos"]


def _compared(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbour pairs of a sorted stream, rows that differ from others of their anchor (null b), then its outermost
    rows (with null pairs).

    The last runs of a batch are carried over to the next, with the first document of the last group of copies;
    the stream is never held.
    """
    names = [*_PAIR, *_COLUMNS]
    carry, first = None, True

    def told(pairs: list[np.ndarray], rows: dict[str, np.ndarray], outer: np.ndarray,
             unlike: np.ndarray) -> pa.RecordBatch:
        none = np.full(len(outer), None)
        pad = np.full(len(pairs[0]) + len(unlike), None)
        own = [rows["doc_id"][unlike].tolist(), rows["pos"][unlike].tolist(), *[[None] * len(unlike)] * 2]
        return pa.RecordBatch.from_arrays(
            [*(pa.array([*p.tolist(), *o, *none], pa.int64()) for p, o in zip(pairs, own)),
             *(pa.array([*pad, *rows[c][outer].tolist()], pa.int64()) for c in _COLUMNS)], names)

    for batch in found:
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _COLUMNS}
        if not len(rows["pos"]):
            continue
        if carry is not None:
            rows = {c: np.concatenate([carry[c], rows[c]]) for c in _COLUMNS}
        pairs, outer, unlike = _pairs(rows)
        n = len(rows["pos"])
        tail = outer[-1:] if len(outer) else np.array([n - 1])
        # keep the last two runs: the last may go on, the one before is its neighbour
        last = rows["anchor"][tail[0]], rows["doc_id"][tail[0]]
        own = (rows["anchor"] == last[0]) & (rows["doc_id"] == last[1])
        begin = int(np.flatnonzero(own)[0])
        if begin:
            same = (rows["anchor"] == rows["anchor"][begin - 1]) & (rows["doc_id"] == rows["doc_id"][begin - 1])
            begin = int(np.flatnonzero(same)[0])
        keep = np.arange(n) >= begin
        group = np.ones(n, bool)
        for c in _KEY:
            group &= rows[c] == rows[c][-1]
        lead = int(np.flatnonzero(group)[0])
        keep |= group & (rows["doc_id"] == rows["doc_id"][lead])
        carry = {c: v[keep] for c, v in rows.items()}
        head = outer[outer < _first_run(rows)] if first else outer[:0]
        first = False
        yield told(pairs, rows, head, unlike)
    if carry is not None:
        _, outer, _ = _pairs(carry)
        last = outer[outer >= len(carry["pos"]) - _last_run(carry)]
        yield told([np.zeros(0, np.int64)] * 4, carry, last, last[:0])


def _first_run(rows: dict[str, np.ndarray]) -> int:
    same = (rows["anchor"] == rows["anchor"][0]) & (rows["doc_id"] == rows["doc_id"][0])
    return int(np.argmin(same)) if not same.all() else len(same)


def _last_run(rows: dict[str, np.ndarray]) -> int:
    return _first_run({c: v[::-1] for c, v in rows.items()})


def neighbours(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, a_pos, b, b_pos) of neighbours when `rows` are sorted, and (doc_id, pos) of those that stand for a group
    of copies while others of their anchor differ."""
    order = [*_KEY, "doc_id", "pos"]
    schema = ", ".join(f"{c} long" for c in [*_PAIR, *_COLUMNS])
    parts = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    told = materialize(parts.mapInArrow(_compared, schema), "neighbours")
    edges = told.where("a is null").select(_COLUMNS)  # two runs for each partition
    met = edges.repartition(1).sortWithinPartitions(*order).mapInArrow(_compared, schema)
    unlike = told.where("a is not null and b is null").select(F.col("a").alias("doc_id"), F.col("a_pos").alias("pos"))
    pairs = told.where("b is not null").select(_PAIR).unionByName(met.where("b is not null").select(_PAIR))
    return pairs, unlike


def windows(kept: DataFrame) -> DataFrame:
    """(window, doc_id, start): the hash of each `LEAST` words through the runs at the positions `at` of each text."""

    def batches(found):
        for batch in found:
            for part in slices(batch, "text"):
                words, spots = split_words(part.column("text")), part.column("at")
                hashes, first = grams(words.hash, words.first, LEAST)
                count = np.diff(words.first) - LEAST + 1
                row = np.repeat(np.arange(len(spots)), spots.value_lengths().to_numpy())
                pos = spots.flatten().to_numpy()
                low, high = np.maximum(pos - _WINDOW + 1, 0), np.minimum(pos + 1, count[row])
                row, low, high = (x[low < high] for x in (row, low, high))
                edges = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(edges, first[row] + low, 1)
                np.add.at(edges, first[row] + high, -1)
                at = np.flatnonzero(np.cumsum(edges)[:-1])
                row = row_of(first)[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[at].astype(np.int64)), part.column("doc_id").take(pa.array(row)),
                     pa.array((at - first[row]).astype(np.int32))], ["window", "doc_id", "start"])

    return kept.select("doc_id", "text", "at").mapInArrow(batches, "window long, doc_id long, start int")


def equal_windows(rows: DataFrame) -> DataFrame:
    """(a, a_pos, b, b_pos): each window with the first document that has it, those of the first with the last."""
    place = F.struct("doc_id", "start")
    ends = rows.groupBy("window").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    ends = materialize(ends.where("low.doc_id <> high.doc_id"), "equal")
    own = F.col("doc_id") == F.col("low.doc_id")
    pairs = rows.join(ends, "window").select(
        F.col("low.doc_id").alias("a"), F.when(own, F.col("start")).otherwise(F.col("low.start")).cast("long").alias("a_pos"),
        F.when(own, F.col("high.doc_id")).otherwise(F.col("doc_id")).alias("b"),
        F.when(own, F.col("high.start")).otherwise(F.col("start")).cast("long").alias("b_pos"))
    # overlapping windows on one diagonal are one match: a seed of them is enough
    seeds = pairs.groupBy("a", "b", (F.col("b_pos") - F.col("a_pos")).alias("shift"),
                          F.floor(F.col("a_pos") / _WINDOW).alias("near")).agg(F.min("a_pos").alias("a_pos"))
    return seeds.select("a", "a_pos", "b", (F.col("a_pos") + F.col("shift")).alias("b_pos"))


def repeated_spans(a: np.ndarray, b: np.ndarray, seeds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which words of `a` and of `b` lie in matches of at least `LEAST` words through the seeds.

    Seeds that could add no words to the matches found already are left out.
    """
    done_a, done_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for i, j in sorted(set(seeds)):
        if i >= len(a) or j >= len(b) or a[i] != b[j]:
            continue
        back, ahead = min(i, j), min(len(a) - i, len(b) - j)
        if done_a[i - back:i + ahead].all() and done_b[j - back:j + ahead].all():
            continue
        differ = np.flatnonzero(a[i - back:i] != b[j - back:j])
        left = back - 1 - int(differ[-1]) if len(differ) else back
        differ = np.flatnonzero(a[i:i + ahead] != b[j:j + ahead])
        right = int(differ[0]) if len(differ) else ahead
        if left + right >= LEAST:
            done_a[i - left:i + right] = True
            done_b[j - left:j + right] = True
    return done_a, done_b


def stretches_of(marks: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of each stretch of marked words."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0]))))
    return zip(edges[::2].tolist(), edges[1::2].tolist())


def extended(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, start_word, end_word, other): matches of each document of the pairs."""

    def hashes(text) -> np.ndarray:
        return split_words(pa.array([text.as_py()], pa.large_string())).hash

    def batches(found):
        names = ["doc_id", "start_word", "end_word", "other"]
        known, own = None, None
        for batch in found:
            out = []
            columns = (batch.column(c) for c in ("a", "b", "left", "right", "seeds"))
            for a, b, left, right, seeds in zip(*columns):
                if left.as_py() != known:
                    known, own = left.as_py(), hashes(left)
                spots = [(s["a_pos"], s["b_pos"]) for s in seeds.as_py()]
                done_a, done_b = repeated_spans(own, hashes(right), spots)
                out += [(a.as_py(), i, j, b.as_py()) for i, j in stretches_of(done_a)]
                out += [(b.as_py(), i, j, a.as_py()) for i, j in stretches_of(done_b)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in (zip(*out) if out else [[]] * 4)], names)

    seeds = pairs.groupBy("a", "b").agg(F.collect_set(F.struct("a_pos", "b_pos")).alias("seeds"))
    rows = (seeds.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right")), "b")
            .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left")), "a"))
    return rows.mapInArrow(batches, "doc_id long, start_word long, end_word long, other long")


def merged(spans: DataFrame) -> DataFrame:
    """Spans of a document that overlap as one, with the smallest other document.

    A document with any number of partners has a row for each of its different spans only.
    """
    whole = spans.groupBy("doc_id", "start_word", "end_word").agg(F.min("other").alias("other"))
    order = Window.partitionBy("doc_id").orderBy("start_word", "end_word")
    reach = F.max("end_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = whole.withColumn("apart", F.coalesce(F.col("start_word") >= reach, F.lit(True)).cast("int"))
    placed = apart.withColumn("stretch", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return placed.groupBy("doc_id", "stretch").agg(
        F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word"),
        F.min("other").alias("other")).drop("stretch")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, start_word, end_word, other): passages of `LEAST` words or more that other documents hold too.

    `other` is one such document, words are numbered from 0, ends are exclusive.
    """
    kept = materialize(anchors(docs), "anchors")
    shared = (kept.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
              .where("low <> high").select("anchor"))
    wanted = (kept.join(materialize(shared, "shared"), "anchor").groupBy("doc_id")
              .agg(F.collect_set("pos").alias("at")))
    texts = materialize(_texts(docs).join(wanted, "doc_id"), "texts")
    rows = materialize(contexts(texts), "suffixes")
    pairs, unlike = neighbours(rows)
    unlike = unlike.groupBy("doc_id").agg(F.collect_set("pos").alias("at"))
    equal = equal_windows(materialize(windows(texts.select("doc_id", "text").join(unlike, "doc_id")), "windows"))
    return merged(extended(pairs.unionByName(equal).distinct(), texts))
