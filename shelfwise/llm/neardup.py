"""Near-duplicate documents by Order MinHash and banded alignment.

A document is the sequence of its runs of `GRAM` words. Two documents are
linked if the edit distance of their sequences is at most 1 - `SIMILAR` of the
longer one. Candidates come from Order MinHash: each of `HASHES` functions
picks a few of the smallest of a document's occurrence-labelled runs and keeps
them in text order, so equal picks speak for equal order too. Linked documents
have at least two thirds of their runs in common, in order. Their lengths differ
by a quarter at most; buckets hold documents of a class of lengths, and a
document is in the class of a quarter more, too. Short classes pick fewer runs,
so that linked documents of any length share a pick with a probability over
0.98, over 0.99 on average (`tests/llm` measures it by length).

Equal word sequences are one representative from the start. In a bucket of
equal picks not all pairs are made: everyone is compared with one leader. Where
some are not linked to it, documents that share a common passage, but little
else, may have met; so those documents are dealt anew by their rarest runs. A
linked pair has 0.8 of the longer one's runs in common, so in any common order of
runs it shares one among the first fifth of each; ordered by how many documents
hold a run, a common passage comes last and brings nobody together, and a run that
one document holds makes no bucket. A document linked to a leader goes on, too,
unless the triangle inequality settles that it is not linked to any of the others.
In the new buckets, the first few documents of each class that links have made
already meet the first few of other classes, then more of them, then, in buckets
of several classes still, all. Nobody is compared within a class, and a pair is made
in one of the buckets it shares. So no link between documents of different classes
that share a bucket is lost, and the largest class of a bucket, near copies say, is
compared with the few others, not with itself. Classes are the connected components.

Defined results: words are compared without case and punctuation; a text
without words (null, empty) is in a class of its own; a text of fewer words
than `GRAM` is one run; rows that share a doc_id are one document, in the class
of all its texts; a null doc_id has a null class. `keep_first` decides row by row
instead: a row goes only if a row with a text of the same class stays, whatever
their ids. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.graph import components
from shelfwise.llm.tokens import grams, mix, row_of, slices, split_words
from shelfwise.session import materialize, release

GRAM = 5
SIMILAR = 0.8
HASHES = 24
CLASS = 1.5  # lengths of a class differ by this factor at most
PICKED = {2: 6, 3: 9, 4: 99}  # runs that a function picks: the last class of lengths it does so for
FEW = (8, 64)  # documents of each class and leaders of each bucket that are compared before all are
KEYS = 128  # a document of at most so many buckets brings their names along, so that a pair is made in one of them
WANTED_ROWS = 1 << 20  # rows whose texts are fetched for comparison are named by broadcast up to here (16 bytes each)
_OFTEN = 16


def labelled_runs(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each run together with the number of equal runs before it in its row."""
    key = mix(hashes + mix(row_of(first).astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[:len(key)]
    at = np.arange(len(key))
    times = np.empty(len(key), np.uint64)
    times[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix(hashes + mix(times))


def order_minhash(hashes: np.ndarray, first: np.ndarray, functions: int = HASHES,
                  picked: tuple = tuple(PICKED)) -> dict[int, np.ndarray]:
    """For each number of picked runs, a row of `functions` picks for each row that has runs."""
    count = np.diff(first)
    count = count[count > 0]
    begin = np.cumsum(count) - count
    labelled = labelled_runs(hashes, first)
    owner = np.repeat(np.arange(len(count)), count)
    most, padded = np.uint64(2 ** 64 - 1), np.append(labelled, np.uint64(0))
    out = {k: np.zeros((len(count), functions), np.uint64) for k in picked}
    for j in range(functions):
        factor = mix(np.uint64([2 * j + 1]))[0] | np.uint64(1)
        value = labelled * factor
        spots = np.full((len(count), max(picked)), len(labelled))
        for i in range(max(picked)):
            least = np.minimum.reduceat(value, begin)
            hit = np.flatnonzero(value == least[owner])
            rows, at = np.unique(owner[hit], return_index=True)
            live = count[rows] > i
            spots[rows[live], i] = hit[at][live]
            value[hit[at]] = most
        for k in picked:
            ordered = np.sort(spots[:, :k], axis=1)  # text order
            for i in range(k):
                out[k][:, j] = mix(out[k][:, j] + padded[ordered[:, i]] + np.uint64(j + 1))
    return out


def length_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / np.log(CLASS) + 1e-9).astype(np.int64)


def bucket_keys(n: np.ndarray, picks: dict[int, np.ndarray]) -> np.ndarray:
    """Keys of each row's buckets: one per function in the class of its length `n`, and in that of a quarter more.

    Both halves are equal where the classes are.
    """
    halves = []
    for longer in (n, n / SIMILAR):
        own = length_class(longer)
        picked = np.array(list(picks))[np.searchsorted([PICKED[k] for k in picks], own)]
        chosen = np.zeros_like(next(iter(picks.values())))
        for k in picks:
            chosen[picked == k] = picks[k][picked == k]
        halves.append(mix(chosen + mix(own.astype(np.uint64))[:, None]))
    return np.concatenate(halves, axis=1)


def sequence_digest(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each non-empty row's sequence of words."""
    full = np.flatnonzero(np.diff(first))
    place = (np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))).astype(np.uint64)
    begin = first[:-1][full]
    return (np.add.reduceat(mix(hashes + mix(place)), begin),
            np.add.reduceat(mix(mix(hashes) ^ mix(place + np.uint64(7 << 40))), begin))


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text): `row` is a hash of id and text."""
    text = F.lower(F.col("text").cast("string"))
    name = F.col("doc_id").cast("long")
    return docs.select(name.alias("doc_id"), F.xxhash64(name, text).alias("row"), text.alias("text"))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n, hi, lo, keys) of each row: the number of runs, digest and buckets; n is 0 without words."""

    def batches(found):
        for batch in found:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                runs, first = grams(words.hash, words.first, GRAM)
                full = np.flatnonzero(np.diff(first))
                n = np.diff(first)
                high, low, keys = [0] * len(n), [0] * len(n), [None] * len(n)
                if len(full):
                    a, b = sequence_digest(words.hash, words.first)
                    rows = bucket_keys(n[full], order_minhash(runs, first)).astype(np.int64)
                    same = (rows[:, :HASHES] == rows[:, HASHES:]).all(axis=1)
                    for i, r in enumerate(full):
                        high[r], low[r] = int(a[i].astype(np.int64)), int(b[i].astype(np.int64))
                        keys[r] = rows[i, :HASHES] if same[i] else rows[i]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row"), pa.array(n), pa.array(high, pa.int64()),
                     pa.array(low, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "row", "n", "hi", "lo", "keys"])

    return _keyed(docs).mapInArrow(batches, "doc_id long, row long, n long, hi long, lo long, keys array<long>")


def banded_distance(a: list, b: list, band: int) -> int:
    """Edit distance of `a` and `b` if it is at most `band`, else band + 1.

    The band's cells of a column are the bits of whole numbers; a column is a
    handful of operations on them. Bit k of column j stands for row j - band + k.
    """
    m, n = len(a), len(b)
    if abs(m - n) > band:
        return band + 1
    if band >= min(m, n):  # the band holds every cell: pad both ends with equal items
        pad = [None] * (band - min(m, n) + 1)
        return banded_distance(a + pad, b + pad, band)
    places: dict = {}
    for i, item in enumerate(a):
        places.setdefault(item, []).append(i)
    whole = {item: sum(1 << i for i in spots) for item, spots in places.items() if len(spots) > _OFTEN}
    mask, top = (1 << (2 * band + 1)) - 1, 1 << (2 * band)
    up, down = mask & ~((1 << band) - 1), 0
    distance = band
    for j, item in enumerate(b, 1):
        shift = j - band - 1
        if item in whole:
            equal = (whole[item] >> shift if shift >= 0 else whole[item] << -shift) & mask
        else:
            equal = 0
            for i in places.get(item, ()):
                if 0 <= i - shift <= 2 * band:
                    equal |= 1 << (i - shift)
        flat = (((equal & up) + up) ^ up | equal | down) & mask
        rise, fall = (down | ~(flat | up)) & mask, flat & up
        if j <= m - band:
            distance += not flat & top
        else:
            bit = 1 << (m - j + band)
            distance += bool(rise & bit) - bool(fall & bit)
        up, down = (fall | ~(flat >> 1 | rise)) & mask, flat >> 1 & rise
    return min(distance, band + 1)


class Runs(NamedTuple):
    """The runs of a text in order, and their occurrence-labelled hashes."""

    order: np.ndarray
    labelled: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> list[Runs]:
        words = split_words(texts)
        runs, first = grams(words.hash, words.first, GRAM)
        labelled = labelled_runs(runs, first)
        return [Runs(runs[a:b], labelled[a:b]) for a, b in zip(first, first[1:])]


def compare(a: Runs, ascending: np.ndarray, b: Runs) -> tuple[bool, int]:
    """(linked, distance) of two texts; the distance is a lower bound if they are not linked.

    `ascending` are the labelled runs of `a`, sorted. Runs that are not in common bound the distance from below.
    """
    longer = max(len(a.order), len(b.order))
    most = int(longer * (1 - SIMILAR) + 1e-9)
    least = abs(len(a.order) - len(b.order))
    if least <= most and len(ascending):
        spot = np.minimum(np.searchsorted(ascending, b.labelled), len(ascending) - 1)
        least = longer - int((ascending[spot] == b.labelled).sum())
    if least > most:
        return False, least
    distance = banded_distance(a.order.tolist(), b.order.tolist(), most)
    return distance <= most, distance


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(leader, doc, linked, distance) of each pair."""

    def batches(found):
        known = told = ascending = None
        for batch in found:
            for part in slices(batch, "right"):
                leader, doc = part.column("leader").to_numpy(), part.column("doc").to_numpy()
                new = np.flatnonzero(np.append(known is None or leader[0] != known, leader[1:] != leader[:-1]))
                lefts = iter(Runs.of(part.column("left").take(pa.array(new))))
                linked, distance = np.zeros(len(doc), bool), np.zeros(len(doc), np.int64)
                new = set(new.tolist())
                for i, right in enumerate(Runs.of(part.column("right"))):
                    if i in new:
                        known, told = leader[i], next(lefts)
                        ascending = np.sort(told.labelled)
                    linked[i], distance[i] = compare(told, ascending, right)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leader), pa.array(doc), pa.array(linked), pa.array(distance)],
                    ["leader", "doc", "linked", "distance"])

    rows = (pairs.join(texts.select("doc", F.col("text").alias("right")), "doc")
            .join(texts.select(F.col("doc").alias("leader"), F.col("text").alias("left")), "leader"))
    return (rows.mapInArrow(batches, "leader long, doc long, linked boolean, distance long")
            .groupBy("leader", "doc").agg(F.max("linked").alias("linked"), F.min("distance").alias("distance")))


def _first_leaders(active: DataFrame) -> DataFrame:
    """(key, leader): one leader of each bucket with more than one document."""
    first = active.groupBy("key").agg(F.min("doc").alias("leader"), F.count("*").alias("size")).where("size > 1")
    return first.select("key", "leader")


def _placed(active: DataFrame, links: DataFrame) -> DataFrame:
    """`active` with classes that the new links (a, b) between classes join, without buckets of one class."""
    found = components(links)
    classed = materialize(active.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        "key", "doc", "n", "settled", F.coalesce("component", "class").alias("class")), "classed")
    mixed = classed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    placed = materialize(classed.join(mixed.select("key"), "key", "left_semi"), "active")
    release(found)
    release(classed)
    return placed


def _pairs(active: DataFrame, most: int | None) -> DataFrame:
    """(leader, doc) of different classes that share a bucket and are not both settled, each once.

    The leader is of the smaller class there. With a limit `most`, a bucket's first leaders and first documents of a class.
    """
    own = Window.partitionBy("key", "class")
    keys = active.groupBy("doc").agg(F.when(F.count("*") <= KEYS, F.collect_set("key")).alias("keys"))
    ranked = active.withColumns({"size": F.count("*").over(own), "rank": F.row_number().over(own.orderBy("doc"))})
    ranked = materialize(ranked.withColumn("place", F.row_number().over(
        Window.partitionBy("key").orderBy("size", "class", "doc"))).join(keys, "doc"), "ranked")
    left, right = (ranked.select("key", *[F.col(c).alias(f"{side}_{c}") for c in ("doc", "class", "settled", "rank", "place", "keys")])
                   for side in ("a", "b"))
    if most:
        left, right = left.where(F.col("a_place") <= most), right.where(F.col("b_rank") <= most)
    least = F.array_min(F.array_intersect("a_keys", "b_keys"))
    met = left.join(right, "key").where(
        (F.col("a_place") < F.col("b_place")) & (F.col("a_class") != F.col("b_class"))
        & ((F.col("a_settled") == 0) | (F.col("b_settled") == 0)) & F.coalesce(F.col("key") == least, F.lit(True)))
    pairs = materialize(met.select(F.col("a_doc").alias("leader"), F.col("b_doc").alias("doc")).distinct(), "pairs")
    release(ranked)
    return pairs


def by_rarest_runs(active: DataFrame, texts: DataFrame) -> DataFrame:
    """The documents of `active` in buckets of their rarest runs, as many as linked ones need to share one.

    Runs that one document holds fill places of that prefix, but make no bucket.
    """
    docs = materialize(active.groupBy("doc").agg(F.first("n").alias("n"), F.min("settled").alias("settled")), "rekeyed")

    def batches(found):
        for batch in found:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                runs, first = grams(words.hash, words.first, GRAM)
                doc = part.column("doc").to_numpy()[row_of(first)]
                pairs = np.unique(np.stack([doc, labelled_runs(runs, first).astype(np.int64)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["doc", "run"])

    runs = materialize(texts.join(docs.select("doc"), "doc").select("doc", "text").mapInArrow(
        batches, "doc long, run long"), "runs")
    held = materialize(runs.groupBy("run").agg(F.count("*").alias("held")).where("held > 1"), "held")
    shared = runs.join(held, "run")
    place = F.row_number().over(Window.partitionBy("doc").orderBy("held", "run"))
    many = F.count("*").over(Window.partitionBy("doc"))
    most = F.floor(F.col("n") * (1 - SIMILAR) + 1e-9) + 1 - (F.col("n") - F.col("many"))
    ranked = (shared.withColumns({"place": place, "many": many}).join(docs, "doc").where(F.col("place") <= most))
    length = [F.floor(F.log(CLASS, F.col("n") * f) + 1e-9) for f in (1.0, 1.0 / SIMILAR)]
    dealt = materialize(ranked.select(
        "doc", "n", "settled", "run", F.explode(F.array_distinct(F.array(*length))).alias("length")).select(
        F.xxhash64("run", "length").alias("key"), "doc", "n", "settled", F.col("doc").alias("class")), "dealt")
    for copy in (docs, runs, held):
        release(copy)
    return dealt


def find_links(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b) links that connect the classes of representatives (doc, row, n, keys).

    Leaders are those of smallest `doc`, which should be in no order of the texts.
    """
    active = reps.select(F.explode("keys").alias("key"), "doc", "n", F.lit(0).alias("settled"))
    leaders = materialize(_first_leaders(active), "leaders")
    hits = materialize(active.join(leaders, "key").where("doc <> leader").select("key", "leader", "doc", "n", "settled"), "hits")
    if hits.isEmpty():
        return reps.select(F.col("doc").alias("a"), F.col("doc").alias("b")).limit(0)
    met = hits.select("doc").union(hits.select("leader")).distinct()
    wanted = materialize(reps.select("doc", "row").join(met, "doc"), "wanted")
    few = wanted.count() <= WANTED_ROWS
    texts = materialize(_keyed(docs).join(F.broadcast(wanted) if few else wanted, "row").select("doc", "text"), "texts")
    release(wanted)
    done = materialize(_compared(hits.select("leader", "doc").distinct(), texts), "told")
    status = materialize(hits.join(done, ["leader", "doc"]), "status")
    fails = status.where("not linked")
    if not fails.isEmpty():
        near = fails.groupBy("key").agg(F.min("distance").alias("near"))
        # x unlinked, y linked to the leader: distance(x, y) >= distance(leader, x) - distance(leader, y)
        reach = F.col("n") / SIMILAR - F.col("n")
        others = (status.where("linked").join(near, "key").where(F.col("near") - F.col("distance") <= reach)
                  .withColumn("settled", F.lit(1)))
        names = ("key", "doc", "n", "settled")
        active = by_rarest_runs(fails.select(*names).unionByName(others.select(*names)), texts)
        told, links = None, done.where("linked").select(F.col("leader").alias("a"), F.col("doc").alias("b"))
        for most in (*FEW, None):
            before, active = active, _placed(active, links)
            release(before)
            if told is not None:
                release(told)
            told = None
            if active.isEmpty():
                break
            pairs = _pairs(active, most)
            told = materialize(_compared(pairs.join(done, ["leader", "doc"], "left_anti"), texts), "told")
            classes = active.groupBy("doc").agg(F.first("class").alias("class"))
            links = (told.where("linked").select("leader", "doc")
                     .join(classes.select(F.col("doc").alias("leader"), F.col("class").alias("a")), "leader")
                     .join(classes.select("doc", F.col("class").alias("b")), "doc").select("a", "b"))
            before, done = done, materialize(done.unionByName(told), "done")
            for copy in (before, pairs):
                release(copy)
        if told is not None:
            release(told)
        release(active)
    for copy in (hits, leaders, status, texts):
        release(copy)
    return done.where("linked").select(F.col("leader").alias("a"), F.col("doc").alias("b"))


def text_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, row, n, hi, lo), and for each text (hi, lo) of rows with an id and words its class, its
    smallest (doc_id, row) and that of its class. Texts alone decide."""
    rows = materialize(sketches(docs), "sketches")
    named = rows.where("doc_id is not null and n > 0")
    reps = named.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "row", "n", "keys")).alias("rep"))
    reps = materialize(reps.select(F.xxhash64(F.monotonically_increasing_id()).alias("doc"), "hi", "lo", "rep.*"), "reps")
    links = find_links(reps.select("doc", "row", "n", "keys"), docs)
    found = components(links)
    of = reps.select("hi", "lo", "doc", "doc_id", "row").join(found.withColumnRenamed("node", "doc"), "doc", "left").select(
        "hi", "lo", "doc_id", "row", F.coalesce("component", "doc").alias("class"))
    of = materialize(of, "of")
    first = of.groupBy("class").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    classes = materialize(of.join(first, "class"), "classes")
    for copy in (reps, found, of):
        release(copy)
    return rows.drop("keys"), classes


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) of each row: the smallest doc_id of its class of near-duplicates."""
    rows, classes = text_classes(docs)
    named = rows.where("doc_id is not null and n > 0")
    same = named.groupBy("doc_id").agg(F.min("hi").alias("a"), F.max("hi").alias("b")).where("a <> b").select("doc_id")
    placed = named.select("doc_id", "hi", "lo").join(
        classes.select("hi", "lo", "class", F.col("first.doc_id").alias("class_id")), ["hi", "lo"])
    if not same.isEmpty():  # classes that an id's texts are in are one class
        shared = materialize(placed.join(same, "doc_id").select("doc_id", "class"), "shared")
        least = shared.groupBy("doc_id").agg(F.min("class").alias("a"))
        joined = components(shared.join(least, "doc_id").select("a", F.col("class").alias("b")))
        whole = classes.select("class", F.col("first.doc_id").alias("own")).distinct().join(
            joined.withColumnRenamed("node", "class"), "class")
        whole = whole.join(whole.groupBy("component").agg(F.min("own").alias("least")), "component").select("class", "least")
        placed = placed.join(materialize(whole, "whole"), "class", "left").withColumn(
            "class_id", F.coalesce("least", "class_id"))
    others = rows.where("doc_id is null or n = 0").select("doc_id", F.col("doc_id").alias("class_id"))
    return placed.select("doc_id", "class_id").unionByName(others)


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each class of texts, the one of smallest doc_id, with its columns.

    Rows of null doc_id stay, and of texts without words one row per doc_id and
    text. Of rows that are equal in both, one stays.
    """
    rows, classes = text_classes(docs)
    ids = classes.select(F.col("first.row").alias("row")).distinct().unionByName(
        rows.where("doc_id is not null and n = 0").select("row").distinct())
    again = rows.where("doc_id is not null").groupBy("row").count().where("count > 1")
    name = "kept"
    while name in docs.columns:
        name = f"_{name}"
    text, number = F.lower(F.col("text").cast("string")), F.col("doc_id").cast("long")
    kept = docs.withColumn(name, F.xxhash64(number, text)).join(
        ids.withColumnRenamed("row", name), name, "left_semi").where("doc_id is not null")
    if not again.isEmpty():
        kept = kept.dropDuplicates([name])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where("doc_id is null"))
