"""Linear encoders learned from images or wide vectors, by block power iteration.

The best linear autoencoder spans the principal subspace of its inputs. An
image of 320 x 192 has 184,320 values, so no matrix of that width squared is ever
made: a thin matrix, `width` x a few columns, is multiplied with the covariance
by one pass over the rows, made orthogonal, and multiplied again, until the
variances it captures no longer change. Every task multiplies its own rows and
sends sums of the thin matrix's shape; those are added up by Spark, block by
block, and the driver receives them once per pass.

The result is a callable that `embed_images` takes as its encoder, and that can
be written as a table and read back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.vectors import is_finite
from shelfwise.operators.imaging import pixels, readable, resize

# Rows a task holds at once, in bytes of double precision.
BLOCK_BYTES = 64 << 20
# Input elements whose sums travel together.
BLOCK_WIDTH = 4096
# Further columns iterated beside the wanted ones, which speeds up the last of them.
SPARE = 8

Rows = Callable[[pd.DataFrame], np.ndarray]


class LinearEncoder(NamedTuple):
    """`components`: a column per encoded element, by falling `variances`; inputs are centred by `mean`.

    Called with a batch of any shape (n, ...) it flattens and encodes each item.
    """

    mean: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    passes: int

    def __call__(self, batch: np.ndarray) -> np.ndarray:
        return (batch.reshape(len(batch), -1) - self.mean) @ self.components

    def decode(self, encoded: np.ndarray) -> np.ndarray:
        return encoded @ self.components.T + self.mean

    def errors(self, batch: np.ndarray) -> np.ndarray:
        """Mean squared error of encoding and decoding each item."""
        flat = batch.reshape(len(batch), -1)
        gap = flat - self.decode(self(flat))
        return (gap * gap).mean(axis=1)


def _summed(rows: DataFrame, prepared: Rows, width: int, columns: int,
            each: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of `each` (width x columns) over blocks of rows of all tasks."""
    step = max(1, BLOCK_BYTES // (8 * width))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        total = np.zeros((width, columns))
        seen = False
        for batch in batches:
            for at in range(0, len(batch), step):
                total += each(prepared(batch.iloc[at:at + step]))
                seen = True
        if seen:
            for block in range(0, width, BLOCK_WIDTH):
                part = total[block:block + BLOCK_WIDTH]
                yield pd.DataFrame({"block": [block], "part": [TaskContext.get().partitionId()],
                                    "sums": [part.tobytes()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = None  # always in the order of the parts, so that runs agree
        for sums in group.sort_values("part")["sums"]:
            one = np.frombuffer(sums)
            total = one.copy() if total is None else total + one
        return pd.DataFrame({"block": group["block"].iloc[:1], "sums": [total.tobytes()]})

    parts = rows.mapInPandas(partial, "block int, part int, sums binary")
    found = parts.groupBy("block").applyInPandas(add, "block int, sums binary").toArrow().to_pydict()
    whole = np.zeros((width, columns))
    for block, sums in zip(found["block"], found["sums"]):
        whole[block:block + BLOCK_WIDTH] = np.frombuffer(sums).reshape(-1, columns)
    return whole


def _fit(rows: DataFrame, prepared: Rows, width: int, k: int, passes: int, tolerance: float) -> LinearEncoder:
    n = rows.count()
    if not n:
        raise ValueError("an encoder needs rows to learn from")
    shared = rows.sparkSession.sparkContext.broadcast
    mean = _summed(rows, prepared, width, 1, lambda x: x.sum(axis=0)[:, None])[:, 0] / n
    columns = min(k + SPARE, width)
    thin = np.linalg.qr(np.random.default_rng(7).normal(size=(width, columns)))[0]
    before, turn = None, 0
    while True:
        held = shared((mean, thin))

        def multiplied(x: np.ndarray) -> np.ndarray:
            middle, basis = held.value
            away = x - middle
            return away.T @ (away @ basis)

        product = _summed(rows, prepared, width, columns, multiplied) / n
        held.unpersist()
        small = thin.T @ product  # the covariance inside the subspace
        variances, turned = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-variances)
        variances, ritz = np.maximum(variances[order], 0), thin @ turned[:, order]
        turn += 1
        top = variances[:k]
        if turn >= passes or before is not None and np.abs(top - before).max() <= tolerance * max(top[0], 1e-300):
            break
        before, thin = top, np.linalg.qr(product)[0]
    kept = np.flatnonzero(top > 1e-12 * max(top[0], 1e-300))
    components = ritz[:, kept]
    largest = np.abs(components).argmax(axis=0)
    components = components * np.sign(components[largest, np.arange(len(kept))])
    return LinearEncoder(mean.astype(np.float32), components.astype(np.float32), top[kept], turn)


def fit_image_encoder(images: DataFrame, k: int, height: int = 320, width: int = 192, passes: int = 30,
                      tolerance: float = 1e-9) -> LinearEncoder:
    """Learn `k` elements per image from all readable images, resized to height x width.

    Pixels are resized anew in each pass: written at that width they would take
    many times the room of the images. Fewer elements come out if the images
    vary in fewer directions.
    """

    def prepared(batch: pd.DataFrame) -> np.ndarray:
        return np.stack([resize(pixels(r.data, r.height, r.width, r.nChannels), height, width).ravel()
                         for r in batch.itertuples(index=False)]).astype(np.float64)

    rows = readable(images).select("height", "width", "nChannels", "data")
    return _fit(rows, prepared, height * width * 3, k, passes, tolerance)


def fit_vector_encoder(df: DataFrame, k: int, vector: str = "embedding", passes: int = 30,
                       tolerance: float = 1e-9) -> LinearEncoder:
    """Learn `k` elements per row from finite vectors of one width."""
    rows = df.where(is_finite(F.col(vector))).select(F.col(vector).cast("array<double>").alias("v"))
    sizes = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if sizes[0] != sizes[1]:
        raise ValueError("vectors differ in width")
    if not sizes[0]:
        raise ValueError("an encoder needs rows to learn from")
    return _fit(rows, lambda batch: np.stack(batch["v"].to_numpy()), sizes[0], k, passes, tolerance)


def encode_vectors(df: DataFrame, encoder: LinearEncoder, key: str, vector: str = "embedding") -> DataFrame:
    """(key, encoded) of every row with a finite vector."""
    shared = df.sparkSession.sparkContext.broadcast(tuple(encoder))

    def batches(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = LinearEncoder(*shared.value)
        for batch in found:
            if len(batch):
                out = encode(np.stack(batch["v"].to_numpy()))
                yield pd.DataFrame({"k": batch["k"], "encoded": list(out.astype(np.float32))})

    rows = df.where(is_finite(F.col(vector))).select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInPandas(batches, f"k {dict(rows.dtypes)['k']}, encoded array<float>").withColumnRenamed("k", key)


def image_errors(images: DataFrame, encoder: LinearEncoder, height: int = 320, width: int = 192) -> DataFrame:
    """(image_id, mse): how well each readable image is restored from its encoding."""
    shared = images.sparkSession.sparkContext.broadcast(tuple(encoder))

    def batches(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        told = LinearEncoder(*shared.value)
        for batch in found:
            errors = [told.errors(resize(pixels(r.data, r.height, r.width, r.nChannels), height, width)[None])[0]
                      for r in batch.itertuples(index=False)]
            yield pd.DataFrame({"image_id": batch["image_id"], "mse": np.array(errors, np.float64)})

    rows = readable(images).select("image_id", "height", "width", "nChannels", "data")
    return rows.mapInPandas(batches, "image_id bigint, mse double")


def save_encoder(spark: SparkSession, encoder: LinearEncoder, path: str) -> None:
    """A row per component, and one of the mean: (component, variance, passes, weights)."""
    rows = [(-1, 0.0, encoder.passes, encoder.mean.tolist())]
    rows += [(i, float(v), encoder.passes, encoder.components[:, i].tolist()) for i, v in enumerate(encoder.variances)]
    spark.createDataFrame(rows, "component int, variance double, passes int, weights array<float>").write.parquet(path)


def load_encoder(spark: SparkSession, path: str) -> LinearEncoder:
    rows = spark.read.parquet(path).orderBy("component").toArrow().to_pydict()
    weights = [np.array(w, np.float32) for w in rows["weights"]]
    components = np.stack(weights[1:], axis=1) if len(weights) > 1 else np.zeros((len(weights[0]), 0), np.float32)
    return LinearEncoder(weights[0], components, np.array(rows["variance"][1:]), rows["passes"][0])
