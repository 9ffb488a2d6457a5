"""Whitening of embeddings: distributed covariance, own eigenvectors of it, broadcast projection."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.tables import stored

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE = 64
OFFSET = 1_000_000
#: Rows worked on at a time.
ROWS = 8192
#: Eigenvalues closer than this part of the matrix' norm get vectors that are made orthogonal to each other.
CLUSTER = 1e-3
#: Components with less than this part of the greatest eigenvalue hold rounding errors only.
FLAT = 1e-12


def householder(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tridiagonal form of a symmetric matrix: (diagonal, off-diagonal, Q) with matrix = Q T Q'."""
    a = np.array(matrix, float)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if length == 0:
            continue
        v = x.copy()
        v[0] += np.copysign(length, x[0])
        v /= np.linalg.norm(v)
        # Both sides of H A H at once: a rank-two change of the rest.
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = -np.copysign(length, x[0])
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix are smaller than each of ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - at
    count = (pivot < 0).astype(np.int64)
    for d, e in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - at - e * e / pivot
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` greatest eigenvalues, falling, each bisected down to neighbouring doubles."""
    reach = np.abs(np.concatenate(([0.0], off))) + np.abs(np.concatenate((off, [0.0])))
    margin = 1e-12 * max(np.abs(diagonal).max() + reach.max(), np.finfo(float).tiny)
    low = np.full(k, (diagonal - reach).min() - margin)
    high = np.full(k, (diagonal + reach).max() + margin)
    wanted = len(diagonal) - 1 - np.arange(k)
    while True:
        middle = low + (high - low) / 2
        open_ = (low < middle) & (middle < high)
        if not open_.any():
            return low
        under = below(diagonal, off, middle) <= wanted
        low = np.where(open_ & under, middle, low)
        high = np.where(open_ & ~under, middle, high)


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float, least: float):
    """Solves (T - value) z = b by elimination with row exchanges; a pivot of zero becomes ``least``."""
    n = len(diagonal)
    main, upper, second = diagonal - value, np.append(off, 0.0), np.zeros(n)
    factor, exchanged = np.zeros(n), np.zeros(n, bool)
    for i in range(n - 1):
        under = off[i]
        if abs(under) > abs(main[i]):
            exchanged[i] = True
            main[i], under = under, main[i]
            upper[i], main[i + 1] = main[i + 1], upper[i]
            second[i], upper[i + 1] = upper[i + 1], 0.0
        if abs(main[i]) < least:
            main[i] = least
        factor[i] = under / main[i]
        main[i + 1] -= factor[i] * upper[i]
        upper[i + 1] -= factor[i] * second[i]
    if abs(main[-1]) < least:
        main[-1] = least

    def solve(b: np.ndarray) -> np.ndarray:
        z = b.copy()
        for i in range(n - 1):
            if exchanged[i]:
                z[i], z[i + 1] = z[i + 1], z[i]
            z[i + 1] -= factor[i] * z[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                z[i] -= upper[i] * z[i + 1]
            if i + 2 < n:
                z[i] -= second[i] * z[i + 2]
            z[i] /= main[i]
        return z

    return solve


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix as columns, by inverse iteration.

    Vectors of one cluster of eigenvalues are made orthogonal to the earlier
    ones of it in every step; equal eigenvalues are moved apart by a few units
    of rounding, so that the steps differ.
    """
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), 1e-100)
    unit = np.finfo(float).eps * norm
    rng = np.random.default_rng(0)
    out = np.zeros((n, len(values)))
    first, shifted = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        shifted = min(value, shifted - 10 * unit) if j > first else value
        solve = _solver(diagonal, off, shifted, unit)
        z = rng.normal(size=n)
        for _ in range(5):
            z = solve(z / np.abs(z).max())
            z /= np.linalg.norm(z)
            for _ in range(2):
                z -= out[:, first:j] @ (out[:, first:j].T @ z)
                length = np.linalg.norm(z)
                z = z / length if length > 0 else rng.normal(size=n)
        out[:, j] = z
    return out


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    The sign of a vector is fixed: its entry of greatest size, the first of equal ones, is positive.
    """
    if len(matrix) == 0 or k == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    scale = np.abs(matrix).max() or 1.0
    diagonal, off, q = householder(matrix / scale)
    values = leading_values(diagonal, off, min(k, len(matrix)))
    vectors = q @ leading_vectors(diagonal, off, values)
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = np.abs(vectors).argmax(axis=0)
    vectors *= np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return values * scale, vectors


@dataclass
class Whitening:
    """What is known of all vectors of one length."""

    n: int
    sums: np.ndarray  # of x, exact
    components: np.ndarray  # unit vectors as columns
    values: np.ndarray  # their eigenvalues
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of x-vectors."""
        return (x - self.sums / self.n) @ self.components / np.sqrt(self.values)


def complete(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def _whole(vectors: pa.Array, length: int) -> np.ndarray:
    return pc.list_flatten(vectors).to_numpy(zero_copy_only=False).reshape(-1, length)


def _summed(frame: DataFrame, length: int, mean: np.ndarray, project) -> tuple[np.ndarray, np.ndarray]:
    """(sums of y, sums of y y') over all rows, with y = project(x) - mean: added up in each task, then cell by cell."""
    width = len(mean)

    def products(batches):
        total, square = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                y = project(_whole(batch.column(0).slice(start, ROWS), length)) - mean
                total += y.sum(axis=0)
                square += y.T @ y
        rows = pa.array(list(range(width + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays([rows, pa.array([*square.tolist(), total.tolist()], pa.list_(pa.float64()))], ["i", "cells"])

    cells = frame.mapInArrow(products, "i int, cells array<double>").select("i", F.posexplode("cells").alias("j", "v"))
    total, square = np.zeros(width), np.zeros((width, width))
    for row in cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # one row per cell, (width + 1) * width
        if row.i == width:
            total[row.j] = row.v
        else:
            square[row.i, row.j] = row.v
    return total, square


def covariance(frame: DataFrame, length: int, n: int, mean: np.ndarray, project) -> np.ndarray:
    """Covariance, divisor ``n``, of project(x) over all rows of a frame with one column of vectors, centred before multiplying.

    What rounding leaves of the mean is taken off at the end.
    """
    total, square = _summed(frame, length, mean, project)
    return square / n - np.outer(total / n, total / n)


def fit(x: DataFrame, length: int, n: int, components: int) -> Whitening:
    """Learns the whitening from all rows of ``x``, a frame with one column of vectors of ``length`` whole numbers."""
    sums = np.zeros(length, np.int64)
    for row in x.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.sum("v").alias("v")).collect():  # a row per dimension
        sums[row.j] = row.v
    matrix = covariance(x, length, n, sums / n, lambda v: v)
    values, vectors = leading_components((matrix + matrix.T) / 2, components)
    # Along a component without variance there is nothing to scale to 1.
    kept = values > FLAT * max(values.max(initial=0.0), 0.0) if len(values) else np.zeros(0, bool)
    kept &= values > 0
    return Whitening(n, sums, vectors[:, kept], values[kept], values[kept] / np.trace(matrix) if kept.any() else values[kept])


def whiten(vectors: DataFrame, components: int = 32, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Whitened coordinates: rows (key, component, n, deviation, whitened, explained, identity_error).

    Rows whose vector is null or holds a null or non-finite entry are left out.
    An entry c becomes x = floor(SCALE * c) + OFFSET. Sums of x per dimension
    and n are exact; the covariance is added up in each task from centred
    products and merged cell by cell, so that the driver sees a matrix of
    length times length and nothing that grows with the rows. Its leading
    components come from Householder tridiagonalisation, bisection by Sturm
    counts and inverse iteration; they go to all tasks for the projection.
    ``deviation`` is the exact sum over dimensions of (n x - S)**2, a
    decimal(38, 0); ``identity_error`` the largest entry of the covariance of
    all whitened rows, measured by one more pass, minus the identity.

    Vectors of another length are fitted by themselves, a length at a time.
    Components without variance (constant or dependent dimensions, a single
    vector, vectors without entries) have no rows; equal eigenvalues keep an
    orthonormal choice of vectors, the same for all rows and in reruns. Rows
    that repeat are rows of their own, also with a null key. An empty table
    gives an empty table. Other columns are ignored. Entries beyond 2**50 in
    size are not exact.
    """
    spark = vectors.sparkSession
    name = vectors.schema[key].dataType.simpleString()
    whole = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)
    held = stored(vectors.filter(complete(F.col(vector))).select(F.col(key).alias("key"), whole.alias("x")), "vectors")
    out = spark.createDataFrame([], f"key {name}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    for row in held.groupBy(F.size("x").alias("length")).count().filter("length > 0").orderBy("length").collect():  # a row per length
        of_length = held.filter(F.size("x") == row.length)
        model = fit(of_length.select("x"), row.length, row["count"], components)
        width = len(model.values)
        if not width:
            continue
        spread = covariance(of_length.select("x"), row.length, model.n, np.zeros(width), model.project)
        error = float(np.abs(spread - np.eye(width)).max())
        out = out.union(_projected(of_length, model, row.length, error, name))
    return out.withColumnRenamed("key", key)


def _projected(frame: DataFrame, model: Whitening, length: int, error: float, name: str) -> DataFrame:
    """A row per vector and component."""
    width = len(model.values)

    def rows(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                whitened = model.project(_whole(part.column(2), length))
                vector = pa.array(np.repeat(np.arange(len(part)), width))
                component = pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(part)))
                explained = pa.array(np.tile(model.explained, len(part)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(vector), component, part.column(1).take(vector), pa.array(whitened.ravel()), explained], ["key", "component", "deviation", "whitened", "explained"])

    centre = F.array(*[F.lit(int(s)) for s in model.sums])
    apart = F.zip_with("x", centre, lambda x, s: (F.lit(model.n).cast("decimal(12,0)") * x.cast("decimal(19,0)") - s).cast("decimal(19,0)"))
    deviation = F.aggregate(apart, F.lit(0).cast("decimal(38,0)"), lambda total, y: (total + y * y).cast("decimal(38,0)"))
    found = frame.select("key", deviation.alias("deviation"), "x").mapInArrow(rows, f"key {name}, component int, deviation decimal(38,0), whitened double, explained double")
    return found.select("key", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))
