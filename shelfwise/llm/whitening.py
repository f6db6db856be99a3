"""Whitening of embeddings by shifted CholeskyQR.

The centred rows are a tall matrix A that no task holds whole. Each pass sends
every task's rows through the triangular factors found so far and adds up their
Gram matrix, of the vectors' width; its Cholesky factor is the next triangle. The
first factor is of the Gram matrix plus a shift that rounding cannot undo, so
that it exists for any condition; the passes after it bring the columns to
orthogonality. A = Q R with R the product of the factors, so the singular values
and right vectors of R are those of A: they give the components without ever
squaring the condition of A.

Entries are whole numbers, and n x - S is exact, so centring loses nothing.
What reaches the driver is one row per dimension of a Gram matrix, whatever the
number of rows.

Defined results: a null vector and one with null entries take no part; a null
key stays, and rows that repeat a key or a vector are whitened one by one, while
the fit has each different vector once; vectors of another length than the most
frequent one (of equal ones the longer) take no part, nor does an empty one;
a component whose variance is below the rounding of the largest gives no rows,
so n equal vectors give none at all; a deviation beyond a long is null. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize

COMPONENTS = 4
PASSES = 3
BLOCK_BYTES = 8 << 20  # of rows in double precision, multiplied at once
_UNIT = 2.0 ** -53


def matrices(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The rows of a batch of vectors of one width, in blocks of bounded size."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    rows = values.reshape(len(column), width)
    step = max(1, BLOCK_BYTES // (8 * width))
    for at in range(0, len(rows), step):
        yield rows[at:at + step]


class Centre(NamedTuple):
    """Number of fitted vectors and their sum in each dimension."""

    n: int
    sums: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once."""
        return self._scaled(x) / self.n

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        """n x - S, in whole numbers of any size where 64 bits might not do."""
        bound = (int(np.abs(x).max(initial=0)) + 1) * self.n + int(np.abs(self.sums).max(initial=0))
        if bound < 2 ** 62:
            return x.astype(np.int64) * self.n - self.sums
        return (x.astype(object) * self.n - self.sums.astype(object)).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        bound = (int(np.abs(x).max(initial=0)) + 1) * self.n + int(np.abs(self.sums).max(initial=0))
        if bound ** 2 * x.shape[1] < 2 ** 63:
            away = self._scaled(x)
            return (away * away).sum(axis=1).tolist()
        away = x.astype(object) * self.n - self.sums.astype(object)
        return [d if d < 2 ** 63 else None for d in (away * away).sum(axis=1).tolist()]


def triangular_solve(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """`rows` times the inverse of each upper triangle in turn, by substitution over columns."""
    for upper in factors:
        out = np.empty_like(rows)
        for j in range(upper.shape[0]):
            out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
        rows = out
    return rows


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """The sum of the `row` of all parts for each `i`."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(group.sort_values("part")["row"].to_numpy()), axis=0)
        return pd.DataFrame({"i": group["i"].iloc[:1], "row": [total]})

    kind = dict(parts.dtypes)["row"]
    rows = parts.groupBy("i").applyInPandas(add, f"i int, row {kind}").toArrow()
    return {i: np.array(row) for i, row in zip(rows["i"].to_pylist(), rows["row"].to_pylist())}


def _parts(rows: DataFrame, width: int, start, add, finish, kind: str) -> DataFrame:
    """(part, i, row): what each task makes of all its vectors, one row for each i."""

    def batches(found):
        from pyspark import TaskContext
        state, seen = start(), False
        for batch in found:
            for x in matrices(batch.column("v"), width):
                state, seen = add(state, x), True
        if seen:
            out = finish(state)
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()] * len(out), pa.int32()),
                 pa.array(range(len(out)), pa.int32()), pa.array(list(out), pa.list_(kinds[kind]))], ["part", "i", "row"])

    kinds = {"long": pa.int64(), "double": pa.float64()}
    return rows.select("v").mapInArrow(batches, f"part int, i int, row array<{kind}>")


def centre(rows: DataFrame, width: int) -> Centre:
    """Of all rows (v)."""
    parts = _parts(rows, width, lambda: np.zeros(width, np.int64), lambda s, x: s + x.sum(axis=0, dtype=np.int64),
                   lambda s: s[None, :], "long")
    return Centre(rows.count(), _summed(parts)[0])


def gram(rows: DataFrame, width: int, prepared, columns: int) -> np.ndarray:
    """Q^T Q of the rows that `prepared` makes of a block of vectors, `columns` wide."""

    def add(state, x):
        q = prepared(x)
        return state + q.T @ q

    parts = _parts(rows, width, lambda: np.zeros((columns, columns)), add, lambda s: s, "double")
    found = _summed(parts)
    whole = np.stack([found[i] for i in range(columns)])
    return (whole + whole.T) / 2


def factor(whole: np.ndarray, n: int, shifted: bool) -> np.ndarray | None:
    """The upper Cholesky factor of a Gram matrix of n rows, shifted if asked; None if it has none."""
    width = whole.shape[0]
    shift = 11 * (n * width + width * (width + 1)) * _UNIT * np.linalg.norm(whole, 2) if shifted else 0
    try:
        return np.linalg.cholesky(whole + shift * np.eye(width)).T
    except np.linalg.LinAlgError:
        return None


class Whitening(NamedTuple):
    """`vectors`: unit components as columns, by falling `values` (their variances); `trace`: of the covariance."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centre.of(x) @ self.vectors) / np.sqrt(self.values)


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, int]:
    """Each different v of the most frequent length, written once; and that length (0 without rows)."""
    widths = rows.where("size(v) > 0").groupBy(F.size("v").alias("width")).count()
    most = widths.orderBy(F.desc("count"), F.desc("width")).first()
    width = most["width"] if most else 0
    return materialize(rows.where(F.size("v") == width).select("v").distinct(), "vectors"), width


def fit_whitening(rows: DataFrame, width: int, components: int = COMPONENTS, passes: int = PASSES) -> Whitening:
    """Components of the different vectors `rows` (v array<long>), all of one `width`."""
    if passes < 2:
        raise ValueError("a pass after the shifted one is needed")
    middle = centre(rows, width)
    factors: list[np.ndarray] = []
    for turn in range(passes):
        held = tuple(factors)
        whole = gram(rows, width, lambda x: triangular_solve(middle.of(x), held), width)
        if not whole.any():
            return Whitening(middle, np.zeros((width, 0)), np.zeros(0), 0.0)
        upper = factor(whole, middle.n, shifted=not turn)
        if upper is None:  # columns without variance: the symmetric root takes the place of the last triangle
            values, vectors = np.linalg.eigh(whole)
            factors.append(np.sqrt(np.maximum(values, 0))[:, None] * vectors.T)
            break
        factors.append(upper)
    product = np.eye(width)
    for upper in factors:
        product = upper @ product
    _, sigma, right = np.linalg.svd(product)
    values = sigma ** 2 / middle.n
    kept = np.flatnonzero(sigma > sigma[0] * 1e-9)[:components]
    return Whitening(middle, right[kept].T, values[kept], float(values.sum()))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the fitted vectors' whitened covariance minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    found = gram(rows, len(model.centre.sums), model.whitened, k) / model.centre.n
    return float(np.abs(found - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of each row (key, v array<long>)."""
    rows = rows.where("v is not null and forall(v, x -> x is not null)").select("key", "v")
    key = dict(rows.dtypes)["key"]
    schema = (f"key {key}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    fitted, width = distinct_vectors(rows)
    if not width:
        return rows.sparkSession.createDataFrame([], schema)
    model = fit_whitening(fitted, width, components)
    error, k = identity_error(fitted, model), len(model.values)
    share = model.values / model.trace if k else model.values

    def batches(found):
        for batch in found:
            at = 0
            for x in matrices(batch.column("v"), width):
                keys = batch.column("key").slice(at, len(x))
                at += len(x)
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(each), model.centre.n)),
                     pa.array(model.centre.deviations(x), pa.int64()).take(pa.array(each)),
                     pa.array(model.whitened(x).ravel()), pa.array(np.tile(share, len(x))),
                     pa.array(np.full(len(each), error))],
                    ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("v") == width).mapInArrow(batches, schema)
