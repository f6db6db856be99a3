"""Bounded samples to fit models on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPAN = 1 << 30


def hash_sample(df: DataFrame, rows: int, keys: list[str], wide: float = 2.0, count: int | None = None) -> DataFrame:
    """At most `rows` rows of `df`, those with the smallest hash of `keys`.

    A threshold on the hash leaves about `wide` times as many rows before they
    are ordered, so that no task or driver receives more, whatever the size.
    `count`: the rows of `df`, or of what it was filtered from.
    """
    count = df.count() if count is None else count
    share = min(1.0, wide * rows / max(count, 1))
    hashed = F.xxhash64(*keys)
    return df.where(F.pmod(hashed, F.lit(_SPAN)) < int(share * _SPAN)).orderBy(hashed, *keys).limit(rows)
