"""Whitening components of embeddings by shifted CholeskyQR.

The rows ``A`` of the centred fit list are never written down. A pass over the list computes the
Gram matrix of ``A R^-1``: every task centres its rows, solves against the upper triangle ``R`` so
far and adds up one small matrix, and these are added by row of the matrix. The Cholesky factor of
the Gram matrix, composed with ``R``, is the next ``R``. The first Gram matrix is shifted by a
multiple of the rounding error, so that its factor exists whatever the condition of the data; the
passes after it bring ``A R^-1`` to orthogonal columns. The Gram matrix of the last pass is folded
into ``R`` (its square root), so nothing that the shifts left over stays in the result:
``R^T R = A^T A`` to double precision. The singular vectors of ``R`` are the components.

Vectors count as integers, so means and deviations are exact; rows are centred as
``(n * x - sum) / n`` with an exact numerator.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.vectors import finite_rows
from clickloom.workspace import materialize

# Entries of x up to here are whole numbers in double precision too.
LARGEST = 1 << 52
_SAFE = 2.0**62
_LOW = 26


@dataclass(frozen=True)
class Centre:
    """Number of rows of the fit list and exact sum of each of their dimensions."""

    n: int
    sums: tuple[int, ...]

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sum``, exact: longs if they fit, else Python integers."""
        middle = [round(s / self.n) for s in self.sums]
        rest = [s - self.n * m for s, m in zip(self.sums, middle)]
        away = x - np.array(middle, np.int64)
        if float(np.abs(away).max(initial=0)) * self.n + max(map(abs, rest)) < _SAFE:
            return away * self.n - np.array(rest, np.int64)
        return away.astype(object) * self.n - np.array(rest, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows."""
        return (self.numerators(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sum over the dimensions of the squared numerators."""
        d = self.numerators(x)
        if d.dtype == np.int64 and float(np.abs(d).max(initial=0)) ** 2 * x.shape[1] < _SAFE:
            return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
        exact = (d.astype(object) ** 2).sum(axis=1)
        return pa.array([Decimal(v) for v in exact.tolist()], pa.decimal128(38, 0))


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``directions`` (dimensions, components) are unit eigenvectors by falling
    ``eigenvalues`` of the covariance of the fit list, whose trace is ``trace``."""

    centre: Centre
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Projections of rows, each with variance 1 over the fit list."""
        return self.centre.rows(x) @ self.directions / np.sqrt(self.eigenvalues)


def integer_rows(
    vectors: DataFrame, width: int, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64,
    offset: int = 1_000_000,
) -> DataFrame:
    """``id, x``: the vectors of ``width`` finite entries ``c`` as longs ``floor(scale * c) + offset``."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("x", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = finite_rows(batch.column("vector"), width)
            x = np.floor(values * scale) + offset
            if np.abs(x).max(initial=0) > LARGEST:
                raise ValueError(f"an entry times {scale} is beyond {LARGEST}")
            yield pa.record_batch([batch.column("id").take(pa.array(at)), _lists(x.astype(np.int64))], ["id", "x"])

    return rows.mapInArrow(run, schema)


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def most_common_width(vectors: DataFrame, vector: str = "embedding") -> int:
    """The number of entries that most vectors without NULL or non-finite entries have; the larger one on ties."""
    value = F.col(f"`{vector}`").cast("array<double>")
    usable = F.forall(value, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    counts = vectors.where(usable).groupBy(F.size(value).alias("width")).count()
    found = counts.orderBy(F.desc("count"), F.desc("width")).first()
    return found["width"] if found else 0


def centre_of(fit: DataFrame, width: int) -> Centre:
    """Exact count and sums; tasks add halves of the integers, so no partial sum can overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            n += len(x)
            low += (x & ((1 << _LOW) - 1)).sum(axis=0)
            high += (x >> _LOW).sum(axis=0)
        yield pa.record_batch(
            [pa.array(np.arange(width)), pa.array(np.full(width, n)), pa.array(low), pa.array(high)],
            ["i", "n", "low", "high"],
        )

    def total(name: str) -> Column:
        return F.sum(F.col(name).cast("decimal(38,0)")).alias(name)

    parts = fit.mapInArrow(run, "i long, n long, low long, high long")
    rows = parts.groupBy("i").agg(total("n"), total("low"), total("high")).orderBy("i").collect()
    n = int(rows[0]["n"]) if rows else 0
    return Centre(n, tuple(int(r["low"]) + (int(r["high"]) << _LOW) for r in rows))


def solve_upper(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``rows R^-1`` for upper triangular ``R``, column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def gram(fit: DataFrame, width: int, size: int, project) -> np.ndarray:
    """``Q^T Q`` (``size`` squared) for ``Q = project(x)`` over all rows of the fit list.

    Each task hands on its sum as ``size`` rows; equal rows of the matrix then meet in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((size, size)), False
        for batch in batches:
            q = project(_matrix(batch.column("x"), width))
            total += q.T @ q
            any_rows |= len(q) > 0
        if any_rows:
            yield pa.record_batch([pa.array(np.arange(size)), _lists(total)], ["i", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), _matrix(batch.column("row"), size)):
                sums[i] = sums.get(i, 0) + row
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int64()), _lists(np.array(list(sums.values())))], ["i", "row"])

    schema = "i long, row array<double>"
    parts = fit.mapInArrow(run, schema).repartition("i").mapInArrow(add, schema).collect()
    out = np.zeros((size, size))
    for part in parts:
        out[part["i"]] = part["row"]
    return (out + out.T) / 2


def _factor(g: np.ndarray, n: int, shift: bool) -> np.ndarray:
    """Upper triangular Cholesky factor; with the shift if asked for or needed."""
    d = len(g)
    unit = np.finfo(float).eps / 2
    size = float(np.linalg.eigvalsh(g)[-1])
    by = 11 * (float(n) * d + d * (d + 1)) * unit * size
    if not shift:
        try:
            return np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            pass
    while True:
        try:
            return np.linalg.cholesky(g + np.eye(d) * by).T
        except np.linalg.LinAlgError:
            by *= 4


def _orthogonal(g: np.ndarray) -> bool:
    return float(np.abs(g - np.eye(len(g))).max()) < 1e-10


def fit_whitening(fit: DataFrame, width: int, components: int = 16, passes: int = 4) -> Whitening | None:
    """Fit on a list of integer rows ``x``; None where no dimension varies.

    At most ``components`` components, fewer where the rows span fewer dimensions: directions
    without variance cannot be whitened. The matrices are ``width`` squared, here and in tasks.
    """
    centre = centre_of(fit, width)
    if centre.n < 2:
        return None
    g = gram(fit, width, width, centre.rows)
    if not np.trace(g) > 0:
        return None
    r = _factor(g, centre.n, shift=True)
    for done in range(1, passes + 1):
        upper = r
        g = gram(fit, width, width, lambda x: solve_upper(centre.rows(x), upper))
        if _orthogonal(g) or done == passes:
            break
        r = _factor(g, centre.n, shift=False) @ r
    values, turn = np.linalg.eigh(g)
    whole = (np.sqrt(np.maximum(values, 0))[:, None] * turn.T) @ r
    _, sigma, directions = np.linalg.svd(whole)
    rank = int((sigma > sigma[0] * 1e-12).sum())
    k = min(components, rank)
    v = directions[:k].T
    v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(k)] < 0, -1, 1)
    found = Whitening(centre, v, sigma[:k] ** 2 / centre.n, float((sigma**2).sum() / centre.n), 0.0)
    error = np.abs(gram(fit, width, k, found.whiten) / centre.n - np.eye(k)).max()
    return Whitening(found.centre, found.directions, found.eigenvalues, found.trace, float(error))


def whitened_rows(rows: DataFrame, model: Whitening, width: int, vec_id: str = "vec_id") -> DataFrame:
    """One row per vector of :func:`integer_rows` and component."""
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ])
    k = len(model.eigenvalues)
    explained = model.eigenvalues / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.record_batch(
                [batch.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.centre.n)), model.centre.deviations(x).take(each),
                 pa.array(model.whiten(x).reshape(-1)), pa.array(np.tile(explained, m)),
                 pa.array(np.full(m * k, model.identity_error))],
                schema.names,
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", vec_id)


def whiten(
    vectors: DataFrame, components: int = 16, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64,
    offset: int = 1_000_000, width: int | None = None,
) -> DataFrame:
    """Whitened components of all vectors: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is NULL or has NULL, NaN or infinite entries are left out, and so are vectors
    of another length than ``width`` (by default the length that most have). An entry beyond 2**52
    after scaling is an error. Every different integer vector counts once in the fit, however often it
    is there; every row, repeated or with a NULL id, has its components in the result. A table
    without two different vectors has no components, so the result is empty. Other columns are not read.
    """
    if width is None:
        width = most_common_width(vectors, vector)
    rows = integer_rows(vectors, width, vec_id, vector, scale, offset)
    model = None
    if width:
        # Copies merge within each task first, so a vector held by a third of the rows is sent once a task.
        model = fit_whitening(materialize(rows.select("x").distinct(), "fit-list"), width, components)
    if model is None:
        none = Whitening(Centre(0, ()), np.zeros((width, 0)), np.zeros(0), 1.0, 0.0)
        return whitened_rows(rows.limit(0), none, width, vec_id)
    return whitened_rows(rows, model, width, vec_id)
