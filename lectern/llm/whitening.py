"""Whitening of embeddings by mixed-precision eigenvectors of their covariance.

The covariance is summed up where the rows are. Its eigenvectors come from a
solver in single precision and are corrected by matrix products in extended
precision (Ogita and Aishima's refinement); vectors of eigenvalues that lie too
close together for a step are turned among themselves by a small solve of
their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.arrow import batches

# Whole numbers are formed as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
# Leading components that are returned.
COMPONENTS = 8
# Refinement steps at most, and steps without gain after which it ends.
STEPS, PATIENCE = 30, 3
WIDE = np.longdouble
LARGEST = (1 << 63) - 1


def clean_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, v``: rows whose vector is there and holds finite numbers alone."""
    values = F.col(vector).cast("array<double>")
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("v")).where(F.col("v").isNotNull() & ~odd)


def whole_numbers(column: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * c) + SHIFT of a list column, one row for each vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    scaled = np.floor(flat * SCALE)
    if len(scaled) and np.abs(scaled).max() >= 2.0**62:
        raise ValueError("components are too large for whole numbers of 64 bits")
    return scaled.astype(np.int64).reshape(-1, dims) + SHIFT


def common_size(vectors: DataFrame) -> int:
    """The length that most vectors have (the larger of equals); 0 without vectors."""
    sizes = vectors.where(F.size("v") > 0).groupBy(F.size("v").alias("s")).count()
    found = sizes.orderBy(F.col("count").desc(), F.col("s").desc()).first()
    return found["s"] if found else 0


def moments(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in it:
            x = whole_numbers(batch.column(0), dims)
            n += len(x)
            # In two halves, so that no sum of a batch leaves 64 bits.
            high, low = (x >> 31).sum(axis=0), (x & 0x7FFFFFFF).sum(axis=0)
            total = [t + (int(h) << 31) + int(w) for t, h, w in zip(total, high, low)]
        if n:
            schema = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("s", pa.decimal128(38, 0))])
            yield batches({"i": np.arange(dims, dtype=np.int32), "n": np.full(dims, n), "s": pa.array(total, pa.decimal128(38, 0))}, schema)

    parts = vectors.select("v").mapInArrow(work, "i int, n long, s decimal(38, 0)")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    return (rows[0]["n"], [int(r["s"]) for r in rows]) if rows else (0, [])


def products(vectors: DataFrame, dims: int, size: int, rows_of) -> np.ndarray:
    """The sum of the outer products of what ``rows_of`` makes of each vector, as doubles."""

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in it:
            y = rows_of(whole_numbers(batch.column(0), dims))
            total += y.T @ y
        i, j = np.triu_indices(size)
        schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.float64())])
        yield batches({"i": i.astype(np.int32), "j": j.astype(np.int32), "s": total[i, j]}, schema)

    sums = vectors.select("v").mapInArrow(work, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros((size, size))
    out[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["s"].to_numpy()
    return out + np.triu(out, 1).T


def clusters(values: np.ndarray, gap: float) -> Iterator[np.ndarray]:
    """Groups of two and more neighbours, in the order of size, that lie within ``gap`` of each other."""
    order = np.argsort(-values)
    cut = np.flatnonzero(np.diff(values[order]) < -gap) + 1
    return (part for part in np.split(order, cut) if len(part) > 1)


def sub_solves(v: np.ndarray, x: np.ndarray, values: np.ndarray, gap: float) -> np.ndarray:
    """Turn the vectors of each cluster among themselves, by the eigenvectors of what is left once its centre is taken off."""
    for part in clusters(values, gap):
        own = x[:, part]
        centre = values[part].mean()
        small = own.T @ (v @ own - centre * own)
        small = ((small + small.T) / 2).astype(np.float64)
        x[:, part] = own @ np.linalg.eigh(small)[1][:, ::-1].astype(WIDE)
    return x


def refined(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    The start is the single-precision solver's. A step takes the matrix R = I - X'X of
    lost orthogonality and S = X'VX, corrects each pair of vectors whose values are
    far enough apart by (s_ij + l_j r_ij) / (l_j - l_i), all others by r_ij / 2, and
    turns the latter by sub-solves. It ends when the largest residual no longer falls.
    """
    n = len(v)
    size = float(np.abs(v).max(initial=0))
    if size == 0 or not np.isfinite(size):
        return np.zeros(n), np.eye(n)
    wide = (v / size).astype(WIDE)
    x = np.linalg.eigh((v / size).astype(np.float32))[1].astype(WIDE)
    eye = np.eye(n, dtype=WIDE)
    best, waited = (np.inf, None, None), 0
    for _ in range(STEPS):
        image = wide @ x
        r, s = eye - x.T @ x, x.T @ image
        # Exactly symmetric, so that what rounding leaves turns the vectors and does not bend them.
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        residual = float(np.abs(image - x * values).max() + np.abs(r).max())
        if residual < best[0] / 2:
            waited = 0
        else:
            waited += 1
        if residual < best[0]:
            best = (residual, values.copy(), x.copy())
        if waited >= PATIENCE:
            break
        off = s - np.diag(np.diag(s))
        # Norms by rows bound the spectral norms that the step's error grows with.
        gap = float(2 * (np.abs(off).sum(axis=1).max() + np.abs(wide).sum(axis=1).max() * np.abs(r).sum(axis=1).max()))
        gap = max(gap, 1e-15)
        difference = values[None, :] - values[:, None]
        far = np.abs(difference) > gap
        step = np.where(far, (s + values[None, :] * r) / np.where(far, difference, 1), r / 2)
        x = x + x @ step
        if not far.sum() == n * (n - 1):
            # Orthogonal again before the clusters are turned.
            x = x + x @ (eye - x.T @ x) / 2
            x = sub_solves(wide, x, values, gap)
            x = x + x @ (eye - x.T @ x) / 2
    order = np.argsort(-best[1])
    vectors = best[2][:, order]
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    return (best[1][order] * size).astype(np.float64), vectors.astype(np.float64)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each vector and leading component.

    All vectors are the fit list: x = floor(1024 c) + 100000, n vectors with sums
    S, covariance V of x (divisor n, x - S/n before multiplying). A component is a
    unit eigenvector of V by falling eigenvalue e, with the sign that makes its
    largest entry positive; whitened is x - S/n along it over sqrt(e), explained
    e / trace(V), identity_error the largest entry of the whitened rows' covariance
    less the identity, measured on the rows. deviation is the exact sum of
    (n x - S)^2, null where 64 bits do not hold it.

    Vectors that are null, empty or hold null or non-finite entries take no part,
    nor do those of another length than most. Components without variance
    (eigenvalues of rounding alone) have null whitened values and do not count in
    identity_error, which is null without any other. Repeated rows count each;
    rows without id keep a null; a table without vectors gives no rows; other
    columns are not read. The sums are d x d for d dimensions, whatever the rows.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    clean = clean_vectors(vectors, vec_id, vector)
    dims = common_size(clean)
    if not dims:
        return vectors.sparkSession.createDataFrame([], schema)
    clean = clean.where(F.size("v") == dims)
    n, sums = moments(clean, dims)
    # S/n as a whole number and a fraction, so that large n costs no digits.
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - whole) - rest

    v = products(clean, dims, dims, centred) / n
    values, basis = refined(v)
    basis = basis * np.where(np.take_along_axis(basis, np.abs(basis).argmax(axis=0)[None, :], axis=0)[0] < 0, -1.0, 1.0)
    trace = float(np.trace(v))
    k = min(components, dims)
    real = values[:k] > max(trace, 0) * dims * np.finfo(np.float64).eps
    turn = basis[:, :k] / np.sqrt(np.where(real, values[:k], 1))

    def projected(x: np.ndarray) -> np.ndarray:
        return centred(x) @ turn

    spread = products(clean, dims, k, projected) / n - np.eye(k)
    error = float(np.abs(spread[np.ix_(real, real)]).max()) if real.any() else None
    explained = (values[:k] / trace if trace > 0 else np.zeros(k)).tolist()
    whole_sums = np.array([s - int(w) * n for s, w in zip(sums, whole)], object)
    out = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64())])

    def deviations(x: np.ndarray) -> list[int | None]:
        """n x - S = n (x - whole) - (S - n whole), squared and summed up; in Python's integers where 64 bits may not do."""
        y = x - whole
        if n * (int(np.abs(y).max(initial=0)) + 1) < int((LARGEST // dims) ** 0.5):
            return (((y * n - whole_sums.astype(np.int64)) ** 2).sum(axis=1)).tolist()
        found = ((y.astype(object) * n - whole_sums) ** 2).sum(axis=1)
        return [d if d <= LARGEST else None for d in found]

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = whole_numbers(batch.column(1), dims)
            y = projected(x)
            spot = np.where(real, y, np.nan).ravel()
            yield batches(
                {
                    "vec_id": batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                    "deviation": pa.array(deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    "whitened": pa.array(spot, pa.float64(), from_pandas=True),
                    "explained": np.tile(explained, len(x)),
                },
                out,
            )

    rows = clean.select("vec_id", "v").mapInArrow(work, "vec_id long, component int, deviation long, whitened double, explained double")
    return rows.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).cast("double").alias("identity_error"))
