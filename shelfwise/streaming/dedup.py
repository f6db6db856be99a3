"""Keep-first dedup of a stream of harvested records."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfwise.operators.clean import PRODUCT_KEYS, first_per_key
from shelfwise.session import materialize, release

BUCKETS = 32


def stream_dedup(records: DataFrame, out: str, checkpoint: str, keys=PRODUCT_KEYS,
                 order=("product_id",), buckets: int = BUCKETS) -> StreamingQuery:
    """Write the first record of every key over the whole life of `out`.

    Each micro-batch keeps the first row per key and drops keys that `out` holds
    already, from earlier batches or from earlier streams with a checkpoint of
    their own. Output lies in folders by hashed key, so a batch reads the key
    columns of its own buckets only, and by stream and batch, so a repeated
    batch overwrites its own rows and nobody else's.
    """
    spark = records.sparkSession

    def matching(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        other = right.select(*[F.col(k).alias(f"__w_{k}") for k in keys])
        return left.join(other, [F.col(k).eqNullSafe(F.col(f"__w_{k}")) for k in keys], how)

    def accept(batch: DataFrame, batch_id: int) -> None:
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        first = first_per_key(batch, keys, order)
        placed = materialize(first.withColumns({
            "bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"),
            "stream": F.lit(stream), "batch_id": F.lit(batch_id)}), "stream-batch")
        fresh, written = placed, _written(spark, out, placed)
        if written is not None:
            own = [r["bucket"] for r in placed.select("bucket").distinct().collect()]  # at most `buckets`
            known = written.where(F.col("bucket").isin(own) & ~(
                (F.col("stream") == stream) & (F.col("batch_id") >= batch_id))).select(*keys)
            fresh = matching(placed, known, "left_anti")
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("bucket", "stream", "batch_id").parquet(out)
        release(placed)

    return (records.writeStream.foreachBatch(accept)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _written(spark: SparkSession, out: str, like: DataFrame) -> DataFrame | None:
    """What `out` holds, None before the first batch."""
    try:
        return spark.read.schema(like.schema).parquet(out)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stream_dedup_within(records: DataFrame, keys, event_time: str, horizon: str) -> DataFrame:
    """First record per key within a time horizon, with state bounded by it."""
    return records.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(keys))


ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Of `first_after_gap`. Its checkpoints hold a state for each, so one made with another number cannot be resumed.
KEY_BUCKETS = 1024
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_NESTED = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _to_pandas(name: str, kind: str) -> Column:
    """The column in a form that pandas neither rounds nor merges; whole numbers must not be null there."""
    if kind in _WHOLE:
        return F.coalesce(F.col(name).cast("bigint"), F.lit(0))
    if kind == "timestamp":
        return F.coalesce(F.unix_micros(name), F.lit(0))
    return F.to_json(F.struct(F.col(name).alias("x")), _NESTED) if kind.startswith(("array", "struct")) else F.col(name)


def _from_pandas(name: str, kind: str, null: Column) -> Column:
    value = F.col(name).cast(kind) if kind in _WHOLE else F.timestamp_micros(name) if kind == "timestamp" else F.col(name)
    if kind.startswith(("array", "struct")):
        value = F.from_json(name, f"x {kind}", _NESTED)["x"]
    return F.when(~null, value)


def _pack(seen: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(seen, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(state: bytes) -> pd.DataFrame:
    """What `first_after_gap` holds of a bucket: a row per key, with the time it was last seen."""
    return pa.ipc.open_stream(state).read_all().to_pandas()


def first_after_gap(records: DataFrame, keys, event_time: str, order: str, gap_seconds: int,
                    delay: str = "0 seconds") -> DataFrame:
    """(keys, event_time, order) of records whose key was not seen for longer than the gap before them.

    A key's state is the time it was last seen, kept until the watermark, the
    newest event time less `delay`, has passed it by the gap. So the state is
    bounded by the keys of one gap, and not by the keys of the stream. Inside a
    batch records go by (event_time, order), whole numbers. A record behind the
    watermark is late and dropped; one that is not late, but older than the
    newest of its key, starts nothing. Null keys are keys; null times are dropped.

    A call of Python takes a bucket of keys, not a key, and the state of a bucket
    is one table of its keys, since a call and a state cost far more than a row.
    """
    gap, kinds = round(gap_seconds * 1_000_000), dict(records.dtypes)
    names = [f"k{i}" for i in range(len(keys))]
    by = [*names, "nulls"]
    nulls = sum((F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)), F.lit(0))
    rows = records.where(F.col(event_time).isNotNull()).select(
        F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int").alias("bucket"),
        F.col(event_time).alias("t"), F.unix_micros(event_time).alias("us"),
        _to_pandas(order, kinds[order]).alias("o"), F.col(order).isNull().alias("last"), nulls.cast("bigint").alias("nulls"),
        *[_to_pandas(k, kinds[k]).alias(n) for k, n in zip(keys, names, strict=True)])

    def first(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(batches), ignore_index=True)
        held = unpack(state.get[0]) if state.exists else found[:0]
        old = len(held)
        at = pd.concat([x[[*by, "us"]] for x in (held, found) if len(x)], ignore_index=True)
        key, us = at.groupby(by, dropna=False, sort=False).ngroup().to_numpy(), at["us"].to_numpy("int64")
        o = pd.factorize(found["o"], sort=True)[0] if found["o"].dtype == object else found["o"].to_numpy()
        # by key, what is held before what is found; then by time and order, nulls last
        place = np.lexsort((np.r_[np.zeros(old, o.dtype), o], np.r_[np.zeros(old, bool), found["last"].to_numpy(bool)],
                            us, np.arange(len(at)) >= old, key))
        key, us = key[place], us[place]
        head = np.r_[True, key[1:] != key[:-1]]
        newest = pd.Series(us).groupby(key).cummax().to_numpy()
        starts = place[(place >= old) & (head | (us - np.roll(newest, 1) > gap))] - old
        tail, mark = np.roll(head, -1), state.getCurrentWatermarkMs()
        seen = at.take(place[tail]).assign(us=newest[tail])
        seen = seen[seen["us"] + gap >= mark * 1000]
        if len(seen):
            state.update((_pack(seen),))
            state.setTimeoutTimestamp(max((int(seen["us"].min()) + gap) // 1000, mark) + 1)
        elif state.exists:
            state.remove()
        if len(starts):
            out = found.take(starts)[[*by, "us", "o", "last"]]
            yield out.astype({c: "Int64" for c in out.columns[out.dtypes == "int64"]})  # Spark pads with nulls

    carried = dict(rows.dtypes)
    schema = ", ".join(f"{c} {carried[c]}" for c in [*by, "us", "o", "last"])
    return (rows.withWatermark("t", delay).groupBy("bucket").applyInPandasWithState(
        first, schema, "seen binary", "append", GroupStateTimeout.EventTimeTimeout)
        .select(*[_from_pandas(n, kinds[k], F.col("nulls").bitwiseAND(F.lit(1 << i)) != 0).alias(k)
                  for i, (k, n) in enumerate(zip(keys, names, strict=True))],
                F.timestamp_micros("us").alias(event_time), _from_pandas("o", kinds[order], F.col("last")).alias(order)))


def stream_first_after_gap(records: DataFrame, out: str, checkpoint: str, keys, event_time: str, order: str,
                           gap_seconds: int, delay: str = "0 seconds") -> StreamingQuery:
    """`first_after_gap` into the folder `out`, with its state in RocksDB beside the checkpoint.

    A restart goes on where the checkpoint ends, with the same state and watermark.
    """
    conf = records.sparkSession.conf
    before = conf.get("spark.sql.streaming.stateStore.providerClass")
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    try:
        return (first_after_gap(records, keys, event_time, order, gap_seconds, delay).writeStream
                .format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start(out))
    finally:
        conf.set("spark.sql.streaming.stateStore.providerClass", before)
