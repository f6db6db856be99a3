"""Exact positions and running totals without a single-task window.

A window over the whole table, or over a group that holds a large share of it,
is the work of one task. Here the order is cut into pieces first: every piece
is numbered on its own, and what lies before it is added from the totals of the
earlier pieces, which are few enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.session import materialize, shuffle_partitions

_PIECE, _POS, _BEFORE = "__piece", "__pos", "__before"

# A group of up to this many rows is left to one task.
HEAVY_ROWS = 1_000_000
_EARLIER = (W.unboundedPreceding, -1)
_SO_FAR = (W.unboundedPreceding, W.currentRow)


# --- the whole table -------------------------------------------------------

def _ranged(df: DataFrame, order, partitions: int | None) -> DataFrame:
    """Range-partitioned rows, written once with their partition and place.

    The totals and the rows then see the same partitions, whatever is lost and
    computed again in between.
    """
    n = partitions or shuffle_partitions(df.sparkSession)
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn(_PIECE, F.spark_partition_id()).withColumn(_POS, in_partition),
        "ranged")


def _add_earlier(ranged: DataFrame, total: Column) -> DataFrame:
    """The total of all earlier partitions; one row per partition is broadcast."""
    earlier = F.sum("__t").over(W.orderBy(_PIECE).rowsBetween(*_EARLIER))
    before = ranged.groupBy(_PIECE).agg(total.alias("__t")).select(
        _PIECE, F.coalesce(earlier, F.lit(0)).alias(_BEFORE))
    return ranged.join(F.broadcast(before), _PIECE)


def row_ordinal(df: DataFrame, order, name: str = "ordinal",
                partitions: int | None = None) -> DataFrame:
    """Dense 0..n-1 position in the order of unique key `order`."""
    placed = _add_earlier(_ranged(df, order, partitions), F.count(F.lit(1)))
    return placed.withColumn(name, F.col(_BEFORE) + F.col(_POS)).drop(_PIECE, _POS, _BEFORE)


def running_total(df: DataFrame, value: str, order, name: str = "running_total",
                  partitions: int | None = None) -> DataFrame:
    """Sum of `value` over this row and all rows before it."""
    placed = _add_earlier(_ranged(df, order, partitions), F.sum(value))
    local = F.sum(value).over(W.partitionBy(_PIECE).orderBy(_POS).rowsBetween(*_SO_FAR))
    return placed.withColumn(name, F.col(_BEFORE) + local).drop(_PIECE, _POS, _BEFORE)


# --- groups ----------------------------------------------------------------

def _match(df: DataFrame, few: DataFrame, keys, how: str) -> DataFrame:
    """Join a broadcast table on keys that may be NULL."""
    renamed = few.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]
    return df.join(F.broadcast(renamed), same, how).drop(*[f"__of_{k}" for k in keys])


def has_heavy_group(df: DataFrame, by, heavy_rows: int) -> bool:
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    return not counts.where(F.col("__n") > heavy_rows).isEmpty()


def _over_groups(df: DataFrame, order, by, total: Column, local, pieces: int | None,
                 heavy_rows: int | None) -> DataFrame:
    """Attach `__local`, the window inside the piece, and the total before it.

    With a heavy group the rows are range-partitioned by group and order, so
    that pieces are equally large whatever the order's values, and any order
    that rows can be sorted by will do. A group goes on in the next piece only
    where a partition ends inside it, so there are fewer totals to broadcast
    than pieces.
    """
    if heavy_rows is None or not has_heavy_group(df, by, heavy_rows):
        whole = W.partitionBy(*by).orderBy(*order)
        return df.withColumn("__local", local(whole)).withColumns(
            {_PIECE: F.lit(None), _BEFORE: F.lit(0)})
    ranged = _ranged(df, [*by, *order], pieces)
    earlier = F.sum("__t").over(W.partitionBy(*by).orderBy(_PIECE).rowsBetween(*_EARLIER))
    before = (ranged.groupBy(*by, _PIECE).agg(total.alias("__t"))
              .select(*by, _PIECE, earlier.alias(_BEFORE)).where(F.col(_BEFORE).isNotNull()))
    window = W.partitionBy(*by, _PIECE).orderBy(_POS)
    placed = ranged.withColumn("__local", local(window)).drop(_POS)
    return _match(placed, before, [*by, _PIECE], "left")


def group_running_total(df: DataFrame, value: str, order, by, name: str = "running_total",
                        pieces: int | None = None, heavy_rows: int | None = HEAVY_ROWS) -> DataFrame:
    """Sum of `value` over this row and all rows before it in its group.

    `order` is a list of columns or sort expressions. With a group of more than
    `heavy_rows` rows the table is cut along group and order, so that no task
    holds a group; None says that there is none and saves the count.
    """
    summed = _over_groups(df, order, by, F.sum(value),
                          lambda w: F.sum(value).over(w.rowsBetween(*_SO_FAR)), pieces, heavy_rows)
    return summed.withColumn(name, F.col("__local") + F.coalesce(_BEFORE, F.lit(0))) \
        .drop("__local", _PIECE, _BEFORE)


def group_ordinal(df: DataFrame, by, order, name: str = "ordinal", pieces: int | None = None,
                  heavy_rows: int | None = HEAVY_ROWS) -> DataFrame:
    """0-based position of each row inside its group, ordered as in `group_running_total`."""
    ranked = _over_groups(df, order, by, F.count(F.lit(1)),
                          lambda w: F.row_number().over(w), pieces, heavy_rows)
    position = F.col("__local").cast("bigint") - 1 + F.coalesce(_BEFORE, F.lit(0))
    return ranked.withColumn(name, position).drop("__local", _PIECE, _BEFORE)
