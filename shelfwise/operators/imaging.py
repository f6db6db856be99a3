"""Pixel work on image rows: statistics, crops and embeddings.

Images are rows of Spark's image layout: height, width, nChannels and BGR
bytes. Batches of rows go through numpy inside the tasks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATS_SCHEMA = ("image_id bigint, width int, height int, aspect_ratio double, area bigint, "
                "mean_blue double, mean_green double, mean_red double, brightness double")

# Luma weights of blue, green and red, in thousandths.
LUMA = np.array([114, 587, 299])


def pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Bytes to a height x width x 3 array; grey is repeated, alpha dropped."""
    grid = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(grid, 3, axis=2) if channels == 1 else grid[:, :, :3]


def readable(images: DataFrame) -> DataFrame:
    return images.where(F.col("data").isNotNull() & (F.col("height") > 0))


def image_stats(images: DataFrame) -> DataFrame:
    """Size, shape, mean colour and brightness of every readable image."""

    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                grid = pixels(row.data, row.height, row.width, row.nChannels)
                mean = grid.reshape(-1, 3).mean(axis=0)
                # Grey levels are whole numbers, as an 8-bit conversion gives.
                grey = (grid @ LUMA + 500) // 1000
                rows.append((row.image_id, row.width, row.height, row.width / row.height,
                             row.width * row.height, *mean, grey.mean()))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in STATS_SCHEMA.split(", ")])

    return readable(images).select("image_id", "height", "width", "nChannels", "data") \
        .mapInPandas(stats, STATS_SCHEMA)


# Pixel bytes a task gathers before it hands crops on.
OUTPUT_BYTES = 32 << 20

CROP_SCHEMA = ("image_id bigint, crop_ordinal bigint, x1 int, y1 int, x2 int, y2 int, "
               "height int, width int, nChannels int, data binary")


def boxes_of(crops: DataFrame, chunk_size: int = 1000) -> DataFrame:
    """(image_id, boxes): numbered boxes (image_id, crop_ordinal, box) in lists of at most `chunk_size`."""
    item = F.struct("crop_ordinal", "box.x1", "box.y1", "box.x2", "box.y2")
    return (crops.groupBy("image_id", F.floor(F.col("crop_ordinal") / chunk_size).alias("chunk"))
            .agg(F.collect_list(item).alias("boxes")).select("image_id", "boxes"))


def cut_boxes(joined: DataFrame) -> DataFrame:
    """The pixels of every box of image rows with a list of `boxes`."""
    names = [c.split()[0] for c in CROP_SCHEMA.split(", ")]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                grid = np.frombuffer(row.data, dtype=np.uint8).reshape(
                    row.height, row.width, row.nChannels)
                for box in row.boxes:
                    x1, y1, x2, y2 = box["x1"], box["y1"], box["x2"], box["y2"]
                    piece = grid[y1:y2, x1:x2]
                    rows.append((row.image_id, box["crop_ordinal"], x1, y1, x2, y2,
                                 piece.shape[0], piece.shape[1], row.nChannels, piece.tobytes()))
                    size += piece.size
                    if size > OUTPUT_BYTES:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    return joined.select("image_id", "height", "width", "nChannels", "data", "boxes").mapInPandas(cut, CROP_SCHEMA)


def crop_images(images: DataFrame, crops: DataFrame, chunk_size: int = 1000) -> DataFrame:
    """Cut numbered boxes (image_id, crop_ordinal, box) out of their images.

    Boxes travel to the pixels as lists of at most `chunk_size`, so an image is
    copied once per list instead of once per box, and no list is unbounded.
    """
    return cut_boxes(readable(images).join(boxes_of(crops, chunk_size), "image_id"))


def png(grid: np.ndarray) -> bytes:
    """A height x width x 3 array in BGR order as a PNG file."""
    height, width, _ = grid.shape
    lines = np.zeros((height, 1 + 3 * width), np.uint8)  # each line begins with its filter, none
    lines[:, 1:] = grid[:, :, ::-1].reshape(height, -1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(
        b"IEND", b"")


def encode_png(images: DataFrame, name: str = "file_name") -> DataFrame:
    """(file_name, content): every readable image as the bytes of a PNG file."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"file_name": batch["file_name"], "content": [
                png(pixels(r.data, r.height, r.width, r.nChannels)) for r in batch.itertuples(index=False)]})

    rows = readable(images).select(F.col(name).alias("file_name"), "height", "width", "nChannels", "data")
    return rows.mapInPandas(encode, "file_name string, content binary")


def resize(grid: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize to height x width, values scaled from bytes to [0, 1]."""
    def taps(size, target):
        at = np.clip((np.arange(target) + 0.5) * size / target - 0.5, 0, size - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, size - 1), (at - low).astype(np.float32)

    y0, y1, wy = taps(grid.shape[0], height)
    x0, x1, wx = taps(grid.shape[1], width)
    wy, wx = wy[:, None, None], wx[None, :, None]
    # Only the rows that are needed are widened, before the columns are picked.
    rows = grid[y0] * (1 - wy) + grid[y1] * wy
    return (rows[:, x0] * (1 - wx) + rows[:, x1] * wx) / np.float32(255)


def grid_encoder(rows: int = 20, cols: int = 12) -> Callable[[np.ndarray], np.ndarray]:
    """A fixed encoder: eight statistics per cell of a rows x cols grid.

    Means and deviations of the three colours and of luma. The default grid on
    320 x 192 images gives vectors of 1920 elements.
    """

    def encode(batch: np.ndarray) -> np.ndarray:
        n, height, width, _ = batch.shape
        if height % rows or width % cols:
            raise ValueError("image size is not a multiple of the grid")
        down = np.kron(np.eye(rows, dtype=np.float32),
                       np.full(height // rows, rows / height, dtype=np.float32))
        across = np.kron(np.eye(cols, dtype=np.float32),
                         np.full(width // cols, cols / width, dtype=np.float32))

        def cell_means(values):
            depth = values.shape[3]
            banded = (down @ values.reshape(n, height, width * depth)).reshape(
                n, rows, width, depth)
            return across @ banded

        full = np.concatenate([batch, (batch @ (LUMA / 1000).astype(batch.dtype))[..., None]], axis=3)
        mean = cell_means(full)
        spread = np.sqrt(np.maximum(cell_means(full * full) - mean * mean, 0))
        return np.concatenate([mean, spread], axis=3).reshape(n, -1)

    return encode


def flat_encoder(batch: np.ndarray) -> np.ndarray:
    """The resized pixels themselves."""
    return batch.reshape(len(batch), -1)


def encoded(part: pd.DataFrame, encode: Callable[[np.ndarray], np.ndarray], height: int, width: int) -> list:
    """The vector of each image of `part`, all readable."""
    stack = np.stack([resize(pixels(r.data, r.height, r.width, r.nChannels), height, width)
                      for r in part.itertuples(index=False)])
    return list(encode(stack).astype(np.float32))


def embed_images(images: DataFrame, encoder: Callable[[np.ndarray], np.ndarray] | None = None,
                 height: int = 320, width: int = 192, batch_size: int = 32,
                 partitions: int | None = None) -> DataFrame:
    """A vector for every readable image: (image_id, embedding).

    `encoder` maps a batch (n, height, width, 3) with values in [0, 1] to
    (n, d). It is shipped to the tasks with the job. Set `partitions` to spread
    pictures that are small in bytes, and so few partitions, over more tasks.
    """
    encode = encoder or grid_encoder()

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), batch_size):
                part = batch.iloc[start:start + batch_size]
                yield pd.DataFrame({"image_id": part["image_id"].to_numpy(),
                                    "embedding": encoded(part, encode, height, width)})

    rows = readable(images).select("image_id", "height", "width", "nChannels", "data")
    if partitions:
        rows = rows.repartition(partitions)
    return rows.mapInPandas(embed, "image_id bigint, embedding array<float>")
