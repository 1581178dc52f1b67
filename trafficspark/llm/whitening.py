"""Embedding whitening: principal components of distinct vectors, to double precision.

The tasks add up exact sums and then the scatter of centred vectors; only these (one entry and one square a dimension)
reach the driver. There the scatter is factored by pivoted Cholesky and one-sided Jacobi rotates the columns of the
triangular factor until they are orthogonal: their squared norms are the eigenvalues, the columns themselves the
components. The covariance matrix is never multiplied out again, so small eigenvalues keep their relative accuracy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficspark.llm import common

#: Rows of vectors that are worked on at a time.
ROWS = 4096


@dataclass
class Whitening:
    """What `fit` learns: number and sums of the distinct vectors, trace of their covariance, components in columns."""

    n: int
    sums: np.ndarray
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums.tolist()]) if self.n else self.sums.astype(float)


def pivoted_cholesky(a: np.ndarray, tolerance: float = 1e-14) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pivots and the lower trapezoid l with a[order][:, order] = l @ l.T; it ends where no pivot above
    tolerance times the first is left, so its columns are the rank."""
    a, d = a.astype(float).copy(), len(a)
    order, l, first = np.arange(d), np.zeros((d, d)), max(0.0, a.diagonal().max(initial=0.0))
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= max(tolerance * first, 0.0):
            return order, l[:, :k]
        for x in (a, l, order):
            x[[k, p]] = x[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        l[k, k] = np.sqrt(a[k, k])
        l[k + 1 :, k] = a[k + 1 :, k] / l[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(l[k + 1 :, k], l[k + 1 :, k])
    return order, l


def rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Disjoint pairs of 0 to n - 1 in n - 1 rounds (n rounds for an odd n), all pairs once: a round-robin."""
    seats = list(range(n + n % 2))
    for _ in range(len(seats) - 1):
        pairs = [(a, b) for a, b in zip(seats[: len(seats) // 2], reversed(seats[len(seats) // 2 :]), strict=True) if max(a, b) < n]
        if pairs:
            yield np.array([min(p) for p in pairs]), np.array([max(p) for p in pairs])
        seats = [seats[0], seats[-1], *seats[1:-1]]


def one_sided_jacobi(l: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms, falling, and unit columns of l after rotations that make its columns orthogonal.

    Each round rotates disjoint pairs of columns at once; sweeps go on until no pair has a cosine above rounding.
    """
    u = l.copy()
    close = np.finfo(float).eps * np.sqrt(max(1, len(u)))
    for _ in range(sweeps):
        turned = False
        for p, q in rounds(u.shape[1]):
            x, y = u[:, p], u[:, q]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(gamma) > close * np.sqrt(alpha * beta)
            if not turn.any():
                continue
            turned = True
            zeta = (beta - alpha) / (2 * np.where(turn, gamma, 1))
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            t = np.where(turn, t, 0)
            c = 1 / np.hypot(1, t)
            u[:, p], u[:, q] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    norms = np.linalg.norm(u, axis=0)
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, u[:, order] / np.where(norms[order] > 0, norms[order], 1)


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column as a matrix; an error where their lengths differ."""
    lengths = np.diff(column.offsets.to_numpy())
    width = width if width is not None else int(lengths[0]) if len(lengths) else 0
    if (lengths != width).any():
        raise ValueError(f"vectors of {sorted(set(lengths.tolist()))} entries, {width} expected")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def usable(vector: Column) -> Column:
    """Whether the vector is there and all of its entries are finite."""
    return vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))


def quantised(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """vec_id, x (array of long): floor(scale * c) + offset of each entry c, as double; rows without a usable vector go.

    An entry too large for a long is an error.
    """
    vector = F.col(vector_col).cast("array<double>")
    x = F.transform(vector, lambda v: F.floor(v * F.lit(scale)).cast("long") + F.lit(offset).cast("long"))
    return vectors.where(usable(vector)).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def added(rows: DataFrame, width: int, make) -> np.ndarray:
    """Sum over the tasks of the square of doubles that `make` adds up from blocks of x: a row of it at a time reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                part = make(matrix(batch.column(0).slice(a, ROWS), width))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    parts = rows.mapInArrow(run, "i int, row array<double>").selectExpr("i", "posexplode(row) as (j, v)")
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()  # a square of known size
    out = np.zeros((found["i"].max() + 1, found["j"].max() + 1)) if len(found) else np.zeros((0, 0))
    out[found["i"], found["j"]] = found["v"]
    return out


def fit(distinct: DataFrame, *, components: int = 16) -> Whitening | None:
    """Sums, eigenvalues and components of distinct x vectors; None of an empty table.

    Directions without spread have no component, so there may be fewer than asked for.
    """
    sums = distinct.selectExpr("posexplode(x) as (j, v)").groupBy("j").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    rows = sums.orderBy("j").collect()  # a row a dimension
    if not rows:
        return None
    counts = {r["n"] for r in rows}
    if len(counts) > 1:
        raise ValueError("vectors of differing lengths")
    n, total = counts.pop(), np.array([int(r["s"]) for r in rows], dtype=object)
    mean = np.array([s / n for s in total])

    def scatter(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ centred

    v = added(distinct, len(mean), scatter) / n
    order, l = pivoted_cholesky((v + v.T) / 2)
    eigenvalues, found = one_sided_jacobi(l)
    unit = np.zeros_like(found)
    unit[order] = found
    keep = min(components, len(eigenvalues))
    return Whitening(n, total, float(np.trace(v)), eigenvalues[:keep], unit[:, :keep])


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened distinct vectors' covariance minus the identity, from the vectors themselves."""
    k, mean, turn = len(model.eigenvalues), model.mean, model.components / np.sqrt(model.eigenvalues)
    if not k:
        return 0.0

    def moments(x: np.ndarray) -> np.ndarray:
        z = np.hstack([(x - mean) @ turn, np.ones((len(x), 1))])
        return z.T @ z

    m = added(distinct, len(mean), moments) / model.n
    return float(np.abs(m[:k, :k] - np.outer(m[:k, k], m[:k, k]) - np.eye(k)).max())


def whitened(rows: DataFrame, model: Whitening | None, error: float) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of each row of vec_id, x. No shuffle."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    base = np.array([s // model.n for s in model.sums])
    n, k, mean, turn = model.n, len(model.eigenvalues), model.mean, model.components / np.sqrt(model.eigenvalues)
    base, rest = base.astype(np.int64), np.array([int(s) - model.n * int(b) for s, b in zip(model.sums, base, strict=True)], np.int64)
    explained = model.eigenvalues / model.trace if k else model.eigenvalues

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                x = matrix(batch.column(1).slice(a, ROWS), len(mean))
                z = (x - mean) @ turn
                # n * x - S from the distance to a whole number near the mean, which keeps the products small.
                far = x - base
                if n * float(np.abs(far).max(initial=0)) >= 2**52 or ((n * far.astype(float) - rest) ** 2).sum(axis=1).max(initial=0) >= 2**62:
                    deviation = [sum((n * int(f) - int(r)) ** 2 for f, r in zip(row, rest, strict=True)) for row in far]
                else:
                    deviation = ((n * far - rest) ** 2).sum(axis=1)
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, ROWS).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                        pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select("vec_id", "x").mapInArrow(run, schema)


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16, scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """Each vector's place along the first components, in standard deviations, with how far it lies from the mean.

    vec_id, component (from 1 by falling eigenvalue), n (distinct vectors), deviation (exact sum over the dimensions of
    (n * x - S) squared, S the distinct vectors' sums), whitened, explained (share of the trace), identity_error.
    Vectors that are null or hold null or non-finite entries have no rows; repeated ids and vectors have theirs each,
    but a vector counts once in the fit; null ids stay null; other columns are ignored. Ties between eigenvalues fall
    as the rotations leave them. Of an empty table, and of one distinct vector (no spread), the result is empty.
    Vectors of differing lengths, and deviations beyond a long, are errors.
    """
    rows = common.stored(quantised(vectors, id_col=id_col, vector_col=vector_col, scale=scale, offset=offset), "vectors")
    distinct = common.stored(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "distinct")
    model = fit(distinct, components=components)
    return whitened(rows, model, identity_error(distinct, model) if model else 0.0)
