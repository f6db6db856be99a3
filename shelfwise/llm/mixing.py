"""Mixing sources to target weights, by blocks of tokens.

The words of each source's documents are packed end to end into blocks of
`block` words. The output is made of shards of `shard_slots` slots; each shard
draws how many slots each source fills from a multinomial distribution, seeded
by the shard's number. A source's slots are numbered through all shards, and a
pseudorandom permutation of the source's whole blocks (one for every pass over
the source) maps slot numbers to blocks; words that do not fill a block come
last in each pass. Blocks and slots meet in a join by index. A last, small set
of shards settles what the draws left open, and a source's last slot takes only
the first words of its block, so that a source gives exactly the words its
target asks for, rounded.

Targets: sources by code point, null last, weigh 3, 1, 2, repeating, and share
150 % of all words; a target stops at twice its source, and the excess is
shared again by weight until none is above. A block is taken twice at most, so
no document exceeds twice its size.

Defined results: a null or empty text has size 0 and is taken 0 words; rows that
repeat a doc_id count each for itself; a null source is a source of its own; an
empty table gives no rows. Extra columns are ignored. Everything depends on the
rows and the seed alone, not on their order or partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.tokens import mix, not_space, slices, text_buffers
from shelfwise.operators.ordinals import group_running_total
from shelfwise.session import materialize, shuffle_partitions

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 64
SHARD_SLOTS = 4096
RUN_DOCS = 4096
MAX_SOURCES = 1_000_000
SEED = 20_240_501


def count_words(texts: pa.Array) -> np.ndarray:
    """Runs of characters other than ASCII white space in each text; 0 for null."""
    data, offsets = text_buffers(texts)
    word = not_space(data)
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    starts[begins] = word[begins]
    return np.diff(np.searchsorted(np.flatnonzero(starts), offsets))


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of each row."""

    def batches(found):
        for batch in found:
            for part in slices(batch, "text", 4 << 20):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"), pa.array(count_words(part.column("text")))],
                    ["doc_id", "source", "size"])

    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(batches, f"doc_id {dict(rows.dtypes)['doc_id']}, source string, size long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: float = MOST, block: int = BLOCK) -> DataFrame:
    """(source, source_no, source_size, target, whole, slots, last), a row for each source.

    `whole` blocks are full; of the `slots` that the source fills the final one
    takes `last` words. The number of sources must not exceed `MAX_SOURCES`: it
    is the size of the table of weights, which is broadcast.
    """
    table = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    count = table.count()
    if count > MAX_SOURCES:
        raise ValueError(f"{count} sources; a table of weights has {MAX_SOURCES} at most")
    table = table.withColumn("source_no", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1)
    pick = F.array(*(F.lit(float(w)) for w in weights))
    table = table.withColumn("weight", F.element_at(pick, (F.col("source_no") % len(weights) + 1).cast("int")))
    rows = table.select("weight", "source_size").limit(MAX_SOURCES).toArrow()
    level = water_level(rows["weight"].to_numpy(), rows["source_size"].to_numpy(), share, most)
    size = F.col("source_size")
    target = F.least(F.col("weight") * F.lit(level), size * float(most))
    table = table.withColumn("target", target).withColumn("words", F.round("target").cast("long"))
    over = F.when(size > 0, F.col("words") % size).otherwise(0)  # words of the pass that is not complete
    final = F.when(over > 0, over).when(F.col("words") > 0, size).otherwise(0)
    slots = F.coalesce(F.floor((F.col("words") - final) / F.nullif(size, F.lit(0))), F.lit(0)) * F.ceil(size / block) \
        + F.ceil(final / block)
    return table.select("source", "source_no", "source_size", "target", F.floor(size / block).alias("whole"),
                        slots.cast("long").alias("slots"),
                        F.when(final > 0, (final - 1) % block + 1).otherwise(0).alias("last"))


def water_level(weight: np.ndarray, size: np.ndarray, share: float, most: float) -> float:
    """What a unit of weight receives when the excess over `most` times a size is shared again."""
    cap, level = size * float(most), 0.0
    while True:
        over = weight * level > cap
        free = float(weight[~over].sum())
        higher = (share * float(size.sum()) - float(cap[over].sum())) / free if free else level
        if higher <= level:
            return level
        level = higher


def place_documents(sizes: DataFrame, targets: DataFrame, run_docs: int = RUN_DOCS) -> DataFrame:
    """`sizes` with `start`, the words of the source before the document.

    Documents are ordered by a hashed run, then by id, so that no task holds a
    source: runs have about `run_docs` documents, and only runs' sums are added
    up along a source.
    """
    runs = max(1, -(-sizes.count() // run_docs))
    placed = sizes.join(F.broadcast(targets), sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    placed = placed.withColumn("run", F.pmod(F.xxhash64("doc_id", "size"), F.lit(runs)))
    ahead = materialize(placed.groupBy("source_no", "run").agg(F.sum("size").alias("words")), "runs")
    ahead = group_running_total(ahead, "words", ["run"], ["source_no"], "ahead").select(
        "source_no", "run", (F.col("ahead") - F.col("words")).alias("ahead"))
    inside = Window.partitionBy("source_no", "run").orderBy("doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = placed.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
    return (placed.join(ahead, ["source_no", "run"])
            .withColumn("start", F.col("ahead") + F.col("inside")).drop("run", "ahead", "inside"))


def pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """The parts of documents that lie in each block: `block`, `at` (words of the block before the
    part), `words` and `first_word` of the document."""
    end = F.col("start") + F.col("size")
    return (placed.where("size > 0")
            .withColumn("block", F.explode(F.sequence(
                F.floor(F.col("start") / block), F.floor((end - 1) / block))))
            .withColumn("at", F.greatest(F.col("start") - F.col("block") * block, F.lit(0)))
            .withColumn("first_word", F.greatest(F.col("block") * block - F.col("start"), F.lit(0)))
            .withColumn("words", F.least(end, (F.col("block") + 1) * block)
                        - F.greatest(F.col("start"), F.col("block") * block)))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a pseudorandom permutation of 0 .. size - 1, chosen by `key`, takes `index`.

    A four-round Feistel network over the next even number of bits; values
    outside go round again until they are inside.
    """
    bits = np.ceil(np.log2(np.maximum(size, 2).astype(float))).astype(np.uint64)
    half = (bits + np.uint64(1)) // np.uint64(2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    size, out = size.astype(np.uint64), index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for turn in range(4):
            left, right = right, left ^ (mix(right + mix(key[todo] + np.uint64(turn))) & mask[todo])
        out[todo] = left << half[todo] | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def slot_plan(targets: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, source_no, slot, block, take): the block that each slot of the output takes, and the
    number of its words, from the first one.

    Ranges of at most `shard_slots` slots are dealt to tasks before they become
    rows, so as many tasks work as there are shuffle partitions.
    """
    spark = targets.sparkSession
    slots = targets.select("source_no", "slots").orderBy("source_no").limit(MAX_SOURCES).toArrow()["slots"].to_numpy()
    total = int(slots.sum())
    shards = -(-total // shard_slots)
    chance = slots / max(total, 1)

    def draws(found):
        for batch in found:
            for shard in batch.column("id").to_pylist():
                size = min(shard_slots, total - shard * shard_slots)
                count = np.random.default_rng([seed, shard]).multinomial(size, chance)
                at = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), shard)), pa.array(at),
                                                  pa.array(count[at])], ["shard", "source_no", "draw"])

    drawn = materialize(spark.range(0, shards).mapInArrow(draws, "shard long, source_no long, draw long"), "draws")
    wanted = F.broadcast(targets.select("source_no", "slots", "source_size", "whole", "last"))
    main = (group_running_total(drawn, "draw", ["shard"], ["source_no"], "to").join(wanted, "source_no")
            .withColumn("from", F.col("to") - F.col("draw")).withColumn("to", F.least("to", "slots")).drop("draw"))
    done = drawn.groupBy("source_no").agg(F.sum("draw").alias("done"))
    step = F.lit(shard_slots).cast("long")
    rest = (targets.select("source_no", "slots", "source_size", "whole", "last").join(done, "source_no", "left")
            .withColumn("done", F.coalesce("done", F.lit(0))).where("done < slots")
            .withColumn("from", F.explode(F.sequence("done", F.col("slots") - 1, step)))
            .withColumn("shard", F.lit(shards) + F.floor((F.col("from") - F.col("done")) / shard_slots))
            .withColumn("to", F.least(F.col("from") + shard_slots, "slots")).drop("done"))
    dealt = main.where(F.col("from") < F.col("to")).unionByName(rest).repartition(
        shuffle_partitions(spark), "source_no", "from")
    each = dealt.withColumn("slot", F.explode(F.sequence("from", F.col("to") - 1))).select(
        "shard", "source_no", "slot", "whole", F.ceil(F.col("source_size") / block).alias("blocks"),
        F.when(F.col("slot") == F.col("slots") - 1, F.col("last")).otherwise(F.lit(block)).cast("long").alias("take"))

    def batches(found):
        for batch in found:
            source, blocks, whole, slot = (batch.column(c).to_numpy() for c in ("source_no", "blocks", "whole", "slot"))
            turn = slot // blocks
            taken = slot - turn * blocks
            inner = np.flatnonzero(taken < whole)  # the others take what does not fill a block
            key = mix(mix(source.astype(np.uint64) + np.uint64(seed)) + turn.astype(np.uint64))
            taken[inner] = permuted(taken[inner], whole[inner], key[inner])
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("source_no"), batch.column("slot"), pa.array(taken),
                 batch.column("take")], ["shard", "source_no", "slot", "block", "take"])

    return each.mapInArrow(batches, "shard long, source_no long, slot long, block long, take long")


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
                block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each row."""
    sizes = materialize(document_sizes(docs), "sizes")
    targets = materialize(source_targets(sizes, weights, share, most, block), "targets")
    placed = materialize(place_documents(sizes, targets), "placed")
    part = F.col("take") < block
    times = slot_plan(targets, block, shard_slots, seed).groupBy("source_no", "block").agg(
        F.count_if(~part).alias("times"), F.coalesce(F.sum(F.when(part, F.col("take"))), F.lit(0)).alias("more"))
    whole = F.col("words") * F.coalesce("times", F.lit(0))
    first = F.greatest(F.least("words", F.coalesce("more", F.lit(0)) - F.col("at")), F.lit(0))
    taken = (pieces(placed, block).join(times, ["source_no", "block"], "left")
             .groupBy("doc_id", "source_no", "start", "size", "source_size", "target")
             .agg(F.sum(whole + first).alias("taken")))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    empty = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return taken.select(columns).unionByName(empty.select(columns))


def mixed_texts(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
                block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, source_no, slot, block, first_word, doc_id, text): the mix itself, a row for each piece
    of a document in each slot. Documents need ids of their own here."""
    sizes = materialize(document_sizes(docs), "sizes")
    targets = materialize(source_targets(sizes, weights, share, most, block), "targets")
    parts = pieces(place_documents(sizes, targets), block).select(
        "doc_id", "source_no", "block", "at", "first_word", "words")
    found = slot_plan(targets, block, shard_slots, seed).join(parts, ["source_no", "block"]).where("at < take")
    found = found.withColumn("words", F.least("words", F.col("take") - F.col("at")))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    return found.join(docs.select("doc_id", "text"), "doc_id").select(
        "shard", "source_no", "slot", "block", "first_word", "doc_id",
        F.array_join(F.slice(words, (F.col("first_word") + 1).cast("int"), F.col("words").cast("int")), " ").alias("text"))
