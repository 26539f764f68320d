"""Embedding whitening: centred covariance on the cluster, its leading eigenvectors by classical steps, projection by broadcast.

1. Tasks add up each dimension of their vectors in exact integers; the sums S
   over all n vectors follow by one aggregation.
2. Tasks centre every vector exactly ((n x - S) / n, the numerator an integer)
   before they multiply; their partial products are summed by (row, column).
   What reaches the driver is one number for each pair of dimensions.
3. The covariance is reduced to tridiagonal form by Householder reflections;
   Sturm counts bisect its leading eigenvalues; inverse iteration finds their
   vectors, those of eigenvalues that lie close together made orthogonal to
   one another again, as a cluster; the reflections carry them back.
4. Components and eigenvalues (at most dimension x components numbers) go to
   the tasks, which project and scale every vector.  The covariance of the result is
   measured by the same distributed sums.

The driver holds dimension^2 numbers, whatever the number of rows;
`MAX_DIMENSION` bounds them.

Defined results.  A row takes no part if its vector is null or holds a null,
non-finite or (beyond +-2^40, where floor(64 c) leaves the exact range)
oversized entry.  Vectors shorter than the longest are filled up with zeros.
Null and repeated ids are kept, each row counting.  Components whose eigenvalue is zero
within rounding (dimension * 2^-52 of the largest) cannot be scaled and are
left out, so equal vectors, a single row and empty tables give no rows.
`deviation` is null where it does not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

COMPONENTS = 32
MAX_DIMENSION = 4096
SCALE, OFFSET = 64, 1_000_000
_EDGE = float(1 << 40)
_ROWS = 4096  # vectors taken together in a task
_EPS = float(np.finfo(float).eps)


# ---------------------------------------------------------------------------
# Vectors of a batch
# ---------------------------------------------------------------------------
def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector array<double>) of the rows that take part."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda c: F.coalesce((F.abs(c) <= F.lit(_EDGE)) & ~F.isnan(c), F.lit(False)))
    return df.select(F.col(id_col).alias("id"), vector.alias("vector")).filter(F.col("vector").isNotNull() & fine)


def _vectors(batch: pa.RecordBatch, dimension: int | None = None) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, long x-vectors filled up to `dimension`, lengths) for at most _ROWS rows at a time."""
    for at in range(0, batch.num_rows, _ROWS):
        part = batch.slice(at, _ROWS)
        lists = part.column(1)
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        width = int(lengths.max(initial=0)) if dimension is None else dimension
        x = np.full((part.num_rows, width), OFFSET, np.int64)
        flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * SCALE).astype(np.int64) + OFFSET
        rows = np.repeat(np.arange(part.num_rows), lengths)
        x[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
        yield part.column(0), x, lengths


def column_sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """n and the exact sums S, by dimension, of all x-vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held, sums = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for _, x, lengths in _vectors(batch):
                if x.shape[1] > len(sums):
                    more = x.shape[1] - len(sums)
                    held, sums = np.pad(held, (0, more)), np.pad(sums, (0, more))
                n += len(x)
                # Sums of the entries that are there; what fills up is added once n is known.
                present = lengths[:, None] > np.arange(x.shape[1])
                held[: x.shape[1]] += present.sum(0)
                sums[: x.shape[1]] += np.where(present, x, 0).sum(0)
        places = np.arange(-1, len(sums))
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(n, held)), pa.array(np.append(0, sums))], ["place", "held", "total"])

    totals = rows.mapInArrow(run, "place long, held long, total long").groupBy("place").agg(F.sum("held").alias("held"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r["place"]: r for r in totals.filter(F.col("place") <= MAX_DIMENSION).collect()}
    n, dimension = int(found.pop(-1, Row(held=0))["held"]), len(found)
    if dimension > MAX_DIMENSION:
        raise ValueError(f"vectors of more than {MAX_DIMENSION} dimensions")
    sums = [int(found[i]["total"]) + (n - int(found[i]["held"])) * OFFSET for i in range(dimension)]
    return n, np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n x - S, exact (long where it fits, else unbounded integers), and the same over n as doubles."""
    whole, rest = np.array([s // n for s in sums], np.int64), [s % n for s in sums]
    moved = x - whole  # small: x and the mean are at most 2^46 apart
    fits = n * (int(np.abs(moved).max(initial=0)) + 1) < 1 << 62
    exact = moved * n - np.array(rest, np.int64) if fits else moved.astype(object) * n - np.array(rest, object)
    return exact, (exact / n).astype(float)


def _product_sums(frames: DataFrame, part, width: int) -> np.ndarray:
    """Sum over all rows of v v^T for the rows v that `part(batch)` gives, a number for each pair of dimensions."""
    above = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for v in part(batch):
                total += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(above[0]), pa.array(above[1]), pa.array(total[above])], ["i", "j", "total"])

    out = np.zeros((width, width))
    for i, j, total in frames.mapInArrow(run, "i long, j long, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[i, j] = out[j, i] = total
    return out


def covariance(rows: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Covariance of the x-vectors, divisor n, every vector centred before it is multiplied."""
    width = len(sums)
    return _product_sums(rows, lambda batch: (_centred(x, n, sums)[1] for _, x, _ in _vectors(batch, width)), width) / n


# ---------------------------------------------------------------------------
# Leading eigenpairs of a symmetric matrix
# ---------------------------------------------------------------------------
def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit reflection vectors of Householder's reduction."""
    a, n, reflections = matrix.copy(), len(matrix), []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if size and np.abs(v[1:]).max() > 0:
            v[0] += np.copysign(size, v[0])
            v /= np.linalg.norm(v)
            block = a[k + 1 :, k + 1 :]
            p = block @ v
            w = p - (v @ p) * v
            block -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        else:
            v = np.zeros(n - k - 1)
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(diagonal: np.ndarray, squares: np.ndarray, at: np.ndarray, floor: float) -> np.ndarray:
    """Sturm count: how many eigenvalues lie below each value of `at`."""
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for d, s in zip(diagonal[1:], squares):
        q = np.where(np.abs(q) < floor, -floor, q)
        q = d - at - s / q
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues of the tridiagonal matrix, falling, by bisection down to neighbouring doubles."""
    n, squares = len(diagonal), off * off
    around = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    size = max(np.abs(diagonal).max() + around.max(), np.finfo(float).tiny)
    floor = max(_EPS * _EPS * size, np.finfo(float).tiny)
    low, high = np.full(k, (diagonal - around).min() - _EPS * size), np.full(k, (diagonal + around).max() + _EPS * size)
    wanted = n - np.arange(k)  # the j-th largest has n - j eigenvalues below it, so more than that below anything above it
    for _ in range(128):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        over = below(diagonal, squares, middle, floor) >= wanted
        high, low = np.where(over, middle, high), np.where(over, low, middle)
    return np.maximum.accumulate((low + (high - low) / 2)[::-1])[::-1]


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, floor: float) -> np.ndarray:
    """Solve (T - shift) y = right by elimination with row exchanges; pivots below `floor` are lifted to it."""
    n = len(diagonal)
    d, u, uu, y = diagonal - shift, np.append(off, 0.0), np.zeros(n), right.astype(float).copy()
    for i in range(n - 1):
        lower = off[i]
        if abs(d[i]) >= abs(lower):
            if abs(d[i]) < floor:
                d[i] = floor
            f = lower / d[i]
            d[i + 1] -= f * u[i]
            y[i + 1] -= f * y[i]
        else:
            f = d[i] / lower
            d[i], u[i], uu[i], d[i + 1], u[i + 1] = lower, d[i + 1], u[i + 1], u[i] - f * d[i + 1], -f * u[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
    if abs(d[-1]) < floor:
        d[-1] = floor
    y[-1] /= d[-1]
    for i in range(n - 2, -1, -1):
        y[i] = (y[i] - u[i] * y[i + 1] - (uu[i] * y[i + 2] if i + 2 < n else 0.0)) / d[i]
    return y


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration; vectors of a cluster of close values are orthogonalised again in every step."""
    n = len(diagonal)
    size = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0), np.finfo(float).tiny)
    floor, close = _EPS * size, 1e-3 * size
    rng = np.random.default_rng(0)
    out = np.zeros((n, len(values)))
    first = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > close:
            first = k
        shift = value - 2 * floor * sum(1 for j in range(first, k) if abs(values[j] - value) <= 2 * floor)
        y = rng.standard_normal(n)
        for _ in range(6):
            for _ in range(2):
                y -= out[:, first:k] @ (out[:, first:k].T @ y)
            y = _solve_shifted(diagonal, off, shift, y / np.linalg.norm(y), floor)
            y /= np.linalg.norm(y)
        for _ in range(2):
            y -= out[:, first:k] @ (out[:, first:k].T @ y)
            y /= np.linalg.norm(y)
        out[:, k] = y
    return out


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix and their unit eigenvectors (columns)."""
    size = np.abs(matrix).max(initial=0)
    if not size or k <= 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, off, reflections = tridiagonal(matrix / size)
    values = leading_values(diagonal, off, min(k, len(matrix)))
    vectors = leading_vectors(diagonal, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    return values * size, vectors / np.linalg.norm(vectors, axis=0)


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------
def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, n, deviation, whitened array<double>, explained array<double>, identity_error): one row per vector that takes part.

    The statistics run when this is called; the result is lazy.
    """
    rows = usable(df, id_col, vector_col)
    n, sums = column_sums(rows)
    width = len(sums)
    spread = covariance(rows, n, sums) if n and width else np.zeros((0, 0))
    values, vectors = leading(spread, components)
    fine = values > width * _EPS * values.max(initial=0)
    values, vectors = values[fine], vectors[:, fine]
    k = len(values)
    scaled = vectors / np.sqrt(values)
    explained = pa.array(values / np.trace(spread)) if k else pa.array([], pa.float64())
    error = 0.0
    if k:
        got = _product_sums(rows, lambda batch: (_centred(x, n, sums)[1] @ scaled for _, x, _ in _vectors(batch, width)), k) / n
        error = float(np.abs(got - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k:
                break
            for ids, x, _ in _vectors(batch, width):
                exact, centred = _centred(x, n, sums)
                white = centred @ scaled
                offsets = pa.array(np.arange(0, k * len(x) + 1, k, dtype=np.int32))
                shares = pa.chunked_array([explained] * len(x)).combine_chunks() if len(x) else explained
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.full(len(x), n, np.int64)), _deviation(exact),
                        pa.ListArray.from_arrays(offsets, pa.array(white.ravel())), pa.ListArray.from_arrays(offsets, shares),
                        pa.array(np.full(len(x), error)),
                    ],
                    ["id", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")


def _deviation(exact: np.ndarray) -> pa.Array:
    """Sum over dimensions of the squared integers; null beyond a long."""
    width = max(exact.shape[1], 1)
    largest = max((abs(int(exact.max(initial=0))), abs(int(exact.min(initial=0))))) if exact.size else 0
    if largest * largest * width < 1 << 62:
        whole = exact.astype(np.int64)
        return pa.array((whole * whole).sum(1))
    sums = [sum(int(c) * int(c) for c in row) for row in exact]
    return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())
