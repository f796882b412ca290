"""Whitening of vectors: leading principal components, each scaled to variance one.

Tasks add up centred products into covariances of the dimensions; their sum, dims x dims numbers,
is all that reaches the driver.  There the matrix is brought to tridiagonal form by Householder
reflections, the leading eigenvalues are found by bisection on Sturm counts, and their vectors by
inverse iteration, kept orthogonal within clusters of close eigenvalues.  The components
(dims x count) go back to the tasks, which project every vector.

The fit works on whole numbers, x = floor(1024 * c) + 100000: sums and deviations are exact and do not
depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.common import stage

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
# Products of whole numbers below this stay exact in 64 bits.
SAFE = 1 << 62
EPS = float(np.finfo(float).eps)


# ------------------------------------------------------------------ eigenvectors of a symmetric matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit vectors of the reflections (from the first column on)."""
    a = np.array(matrix, dtype=float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        v = x
        v[0] += size if x[0] >= 0 else -size
        length = np.linalg.norm(v)
        if not length or not np.any(a[k + 2 :, k]):
            reflections.append(np.zeros(n - k - 1))
            continue
        v = v / length
        reflections.append(v)
        inner = a[k + 1 :, k + 1 :]
        p = inner @ v
        w = p - (v @ p) * v
        a[k + 1 :, k + 1 :] = inner - 2 * (np.outer(v, w) + np.outer(w, v))
        column = a[k + 1 :, k] - 2 * (v @ a[k + 1 :, k]) * v
        a[k + 1 :, k] = a[k, k + 1 :] = column
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def reflected(vectors: np.ndarray, reflections: list[np.ndarray]) -> np.ndarray:
    """Vectors of the tridiagonal matrix as vectors of the original one."""
    out = vectors.copy()
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        out[k + 1 :] -= 2 * np.outer(v, v @ out[k + 1 :])
    return out


def count_above(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each point: the positive pivots of T - point (Sturm)."""
    tiny = np.finfo(float).tiny / EPS
    pivot = diagonal[0] - points
    count = (pivot > 0).astype(int)
    for d, e in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - points - e * e / pivot
        count += pivot > 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection of all of them at once."""
    reach = np.abs(np.r_[off, 0]) + np.abs(np.r_[0, off])
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    wanted = np.arange(1, count + 1)
    slack = 2 * EPS * max(abs(low[0]), abs(high[0]))
    low, high = low - slack, high + slack
    for _ in range(200):
        middle = (low + high) / 2
        above = count_above(diagonal, off, middle) >= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)
        if np.all(high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))):
            break
    return (low + high) / 2


def solved(diagonal: np.ndarray, off: np.ndarray, value: float, right: np.ndarray, least: float) -> np.ndarray:
    """x with (T - value) x = right, by elimination with row exchanges; pivots are at least ``least``."""
    n = len(diagonal)
    main, upper, second, b = diagonal - value, np.r_[off, 0.0], np.zeros(n), right.astype(float).copy()
    for i in range(n - 1):
        below = off[i]
        if abs(below) > abs(main[i]):
            main[i], below = below, main[i]
            upper[i], main[i + 1] = main[i + 1], upper[i]
            second[i], upper[i + 1] = upper[i + 1], 0.0
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(main[i]) < least:
            main[i] = least
        share = below / main[i]
        main[i + 1] -= share * upper[i]
        upper[i + 1] -= share * second[i]
        b[i + 1] -= share * b[i]
    if abs(main[-1]) < least:
        main[-1] = least
    x = np.zeros(n)
    for i in range(n - 1, -1, -1):
        rest = b[i]
        if i + 1 < n:
            rest -= upper[i] * x[i + 1]
        if i + 2 < n:
            rest -= second[i] * x[i + 2]
        x[i] = rest / main[i]
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors by inverse iteration; those of close values are made orthogonal in every round."""
    n = len(diagonal)
    size = max(np.abs(diagonal).max(), np.abs(off).max(initial=0)) or 1.0
    close, least = 1e-3 * size, EPS * size
    chance = np.random.default_rng(0)
    found = np.zeros((n, len(values)))
    cluster = 0  # where the cluster of close values begins
    for j, value in enumerate(values):
        if j and values[j - 1] - value > close:
            cluster = j
        # equal values of one cluster are moved apart by a few roundings, else they give one vector
        shifted = value - (j - cluster) * 2 * least
        x = chance.normal(size=n)
        for _ in range(5):
            mates = found[:, cluster:j]
            x = x - mates @ (mates.T @ x)
            x = solved(diagonal, off, shifted, x / np.linalg.norm(x), least)
            x = x / np.linalg.norm(x)
        mates = found[:, cluster:j]
        for _ in range(2):
            x = x - mates @ (mates.T @ x)
            x = x / np.linalg.norm(x)
        found[:, j] = x
    return found


def leading_eigen(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues (falling) of a symmetric matrix and their unit vectors, as columns.

    The matrix is scaled by a power of two first, so that its squares neither vanish nor overflow.
    """
    largest = np.abs(matrix).max() if matrix.size else 0.0
    unit = 2.0 ** np.floor(np.log2(largest)) if largest else 1.0
    diagonal, off, reflections = tridiagonal(matrix / unit)
    values = leading_values(diagonal, off, min(count, len(diagonal)))
    return values * unit, reflected(leading_vectors(diagonal, off, values), reflections)


# ------------------------------------------------------------------ whole numbers of the vectors


def whole(vectors: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """x of every entry, (rows, dims); shorter vectors count as filled up with zeros.

    ``int64`` if that is exact, else Python's whole numbers.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.diff(vectors.offsets.to_numpy())
    if len(sizes) * dims == len(flat):
        entries = flat.reshape(len(sizes), dims)
    else:
        entries = np.zeros((len(sizes), dims))
        entries[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    if not len(entries) or np.abs(entries).max() < 2**40:
        return np.floor(SCALE * entries).astype(np.int64) + SHIFT
    exact = [[SCALE * int(c) + int(np.floor(SCALE * (c - int(c)))) + SHIFT for c in row] for row in entries.tolist()]
    return np.array(exact, dtype=object).reshape(entries.shape)


def off_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S: whole numbers, n times the distance from the mean."""
    if x.dtype != object and n * max(int(np.abs(x).max(initial=0)), 1) < SAFE and max(map(abs, sums)) < SAFE:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def deviations(off: np.ndarray) -> list[int | None]:
    """Sum of squares of whole numbers; null where it does not fit 64 bits."""
    most = int(np.abs(off).max(initial=0))
    if off.dtype != object and off.shape[1] * most * most < SAFE:
        return (off * off).sum(axis=1).tolist()
    found = [sum(int(v) ** 2 for v in row) for row in off]
    return [v if v < 1 << 63 else None for v in found]


def fit_rows(vector: Column) -> Column:
    """Neither null nor with null or non-finite entries."""
    bad = F.exists(vector.cast("array<double>"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~bad


def batches(parts: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in parts:
        if batch.num_rows:
            yield batch, whole(batch.column("embedding"), dims)


def column_sums(rows: DataFrame, dims: int) -> list[int]:
    """S of every dimension, exact: each task adds up its rows, Spark adds up the tasks."""

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, dtype=object)
        for _, x in batches(parts, dims):
            total = total + np.array([int(s) for s in x.sum(axis=0)], dtype=object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int32()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], ["dim", "total"]
        )

    found = rows.mapInArrow(sums, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total")).collect()
    by_dim = {r["dim"]: int(r["total"]) for r in found}
    return [by_dim.get(d, 0) for d in range(dims)]


def covariance(rows: DataFrame, dims: int, n: int, sums: list[int]) -> np.ndarray:
    """Covariance with divisor n, from centred values; one row of the matrix per task and dimension."""

    def products(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((dims, dims)), False
        for _, x in batches(parts, dims):
            y = off_mean(x, n, sums).astype(float) / n
            total += y.T @ y
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    partial = rows.mapInArrow(products, "i int, row array<double>")
    cells = partial.select("i", F.posexplode("row").alias("j", "v")).where("j <= i").groupBy("i", "j").agg(F.sum("v").alias("v"))
    matrix = np.zeros((dims, dims))
    for i, j, v in cells.collect():  # dims * (dims + 1) / 2 numbers
        matrix[i, j] = matrix[j, i] = v / n
    return matrix


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of rows (vec_id, embedding).

    Rows whose vector is null or has null or non-finite entries are dropped, from the fit and from the
    result.  Shorter vectors count as filled up with zeros, the empty one included; the matrix of the
    driver has the square of the longest vector.  A component without variance (equal vectors, fewer
    vectors than dimensions) cannot be scaled and has no rows.  Repeated rows and null ids count like
    others, each with rows of its own.  Equal eigenvalues give any basis of their space, the same for
    all rows.  A ``deviation`` beyond 64 bits is null.  An empty table gives an empty result.  Other
    columns are not looked at.
    """
    spark = rows.sparkSession
    kept = stage(rows.where(fit_rows(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), "vectors")
    n, dims = kept.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n or not dims:
        return spark.createDataFrame([], empty)
    sums = column_sums(kept, dims)
    matrix = covariance(kept, dims, n, sums)
    values, vectors = leading_eigen(matrix, components)
    trace = float(np.trace(matrix))
    # below this an eigenvalue is rounding
    used = int((values > trace * dims * EPS * 16).sum())
    if not used:
        return spark.createDataFrame([], empty)
    scaled = vectors[:, :used] / np.sqrt(values[:used])

    def project(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in batches(parts, dims):
            off = off_mean(x, n, sums)
            w = (off.astype(float) / n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviations(off), pa.int64()), *[pa.array(w[:, k]) for k in range(used)]],
                ["vec_id", "deviation", *names],
            )

    names = [f"w{k}" for k in range(used)]
    projected = stage(kept.mapInArrow(project, ", ".join(["vec_id long", "deviation long", *[f"{c} double" for c in names]])), "whitened")
    pairs = [(a, b) for i, a in enumerate(names) for b in names[: i + 1]]
    found = projected.agg(*[F.covar_pop(a, b).alias(f"{a}_{b}") for a, b in pairs]).first()
    error = max(abs(found[f"{a}_{b}"] - (a == b)) for a, b in pairs)
    entry = F.posexplode(F.array(*names)).alias("k", "whitened")
    explained = F.array(*[F.lit(float(v / trace)) for v in values[:used]])
    return projected.select("vec_id", "deviation", entry).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("k")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
