"""Embedding whitening: covariance on Spark, eigenvectors by bisection and inverse iteration.

Entries become integers x = floor(64 * c) + 1,000,000.  One scan adds n and the
per-dimension sums S exactly; a second adds the products of x - S/n, centred
before multiplying (each task sends one dims x dims matrix, by rows).  The
driver holds that one matrix (dims is bounded by ``MAX_DIMS``) and finds the
leading eigenpairs: Householder reflections make it tridiagonal, Sturm counts
bisect for the eigenvalues, inverse iteration gives the vectors, and vectors of
clustered eigenvalues are orthogonalised against each other in every step.
The projection (dims x 32 numbers) goes to all tasks with the Arrow function;
a third scan measures the covariance of what it gives.

Defined cases: rows whose vector is null or holds nulls, NaN or infinities are
dropped; where the rest differ in length, the commonest length counts (ties:
the longest) and other rows are dropped.  Components with an eigenvalue that is
zero to double precision do not exist (they cannot be scaled to variance 1), so
a table of equal vectors, or an empty one, gives an empty result.  Repeated rows
count as often as they stand.  64 * c is held within +-10^12.  ``deviation`` is
null where its exact value does not fit a long.  Extra columns stay; the new
columns get underscores in front where the table has such columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import ship_package

from .common import fresh
from .vectors import codes, is_finite, list_column, matrix

OFFSET = 1_000_000
COMPONENTS = 32
MAX_DIMS = 2048      # the driver holds one dims x dims matrix: 32 MB
_BOUND = 1e12
_PARTIALS = 4096     # at most so many tasks send a matrix
_EPS = np.finfo(float).eps


# ------------------------------------------------------------------ symmetric eigenproblem

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with a = q T q', by Householder reflections."""
    a, n = np.array(a, dtype=float), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        norm = np.linalg.norm(v)
        if norm == 0.0 or not np.any(v[1:]):
            continue
        v[0] += np.copysign(norm, v[0])
        v /= np.linalg.norm(v)
        p = 2.0 * (a[k + 1:, k + 1:] @ v)
        w = p - (v @ p) * v
        a[k + 1:, k + 1:] -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, a[k + 1, k])
        a[k + 2:, k] = a[k, k + 2:] = 0.0
        q[:, k + 1:] -= 2.0 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each of ``at``: negative pivots of T - at."""
    tiny = np.finfo(float).tiny / _EPS
    below, pivot = np.zeros(len(at), dtype=np.int64), np.ones(len(at))
    for i in range(len(diagonal)):
        pivot = diagonal[i] - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected to double precision of the matrix."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = (diagonal - reach).min(), (diagonal + reach).max()  # Gershgorin
    size = max(abs(low), abs(high))
    room = 2 * _EPS * size + np.finfo(float).tiny
    lo, hi = np.full(k, low - room), np.full(k, high + room)
    rank = n - 1 - np.arange(k)   # eigenvalues below the wanted one, counted from the smallest
    while True:
        mid = lo + (hi - lo) / 2
        moving = (mid > lo) & (mid < hi) & (hi - lo > _EPS * size / 8)
        if not moving.any():
            return hi
        above = sturm_count(diagonal, off, mid) > rank
        hi = np.where(moving & above, mid, hi)
        lo = np.where(moving & ~above, mid, lo)


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """x of (T - shift) x = b by elimination with row exchanges; pivots below ``least`` are raised to it."""
    n = len(diagonal)
    d, u1, u2, x = diagonal - shift, np.append(off, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        low = off[i]
        if abs(low) > abs(d[i]):   # take the next row as pivot row
            m = d[i] / low
            d[i], u1[i], d[i + 1], u2[i], u1[i + 1] = low, d[i + 1], u1[i] - m * d[i + 1], u1[i + 1], -m * u1[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - m * x[i + 1]
        else:
            if abs(d[i]) < least:
                d[i] = np.copysign(least, d[i])
            m = low / d[i]
            d[i + 1] -= m * u1[i]
            x[i + 1] -= m * x[i]
    for i in range(n - 1, -1, -1):
        rest = x[i] - (u1[i] * x[i + 1] if i + 1 < n else 0.0) - (u2[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = rest / (d[i] if abs(d[i]) >= least else np.copysign(least, d[i]))
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the falling ``values``; near ones are orthogonalised in every step."""
    n, k = len(diagonal), len(values)
    size = max(np.abs(diagonal).max(), np.abs(off).max() if n > 1 else 0.0, np.finfo(float).tiny)
    vectors, rng, first, shift = np.zeros((n, k)), np.random.default_rng(7), 0, np.inf
    for j in range(k):
        if j and values[j - 1] - values[j] > 1e-3 * size:
            first = j                                   # a cluster of near eigenvalues begins here
        shift = min(values[j], shift - 10 * _EPS * size) if j > first else values[j]
        x = rng.uniform(-1.0, 1.0, n)
        for _ in range(6):
            x = _solve_shifted(diagonal, off, shift, x / np.linalg.norm(x), _EPS * size)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= vectors[:, first:j] @ (vectors[:, first:j].T @ x)
        vectors[:, j] = x / np.linalg.norm(x)
    return vectors


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors as columns) of the k largest eigenvalues of a symmetric matrix, falling."""
    k = min(k, len(a))
    if k == 0:
        return np.zeros(0), np.zeros((len(a), 0))
    diagonal, off, q = tridiagonal(a)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = q @ inverse_iteration(diagonal, off, values)
    return values, vectors / np.linalg.norm(vectors, axis=0)


# ------------------------------------------------------------------ statistics on Spark

def common_length(df: DataFrame, vector: str) -> int:
    """The commonest length of the finite vectors (ties: the longest); 0 when there is none."""
    v = F.col(vector)
    top = (df.filter(is_finite(v)).groupBy(F.size(v).alias("d")).count()
           .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    return top[0]["d"] if top else 0


def totals(rows: DataFrame, x: str, dims: int) -> tuple[int, list[int]]:
    """n and the exact sum of every dimension."""
    r = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(x)[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(dims)]).first()
    return r["n"], [int(r[f"s{i}"] or 0) for i in range(dims)]


def product_sums(rows: DataFrame, dims: int, column: str, to_matrix) -> tuple[np.ndarray, np.ndarray]:
    """(sums, products) of the rows that ``to_matrix`` makes of an Arrow batch: dims and dims x dims doubles."""
    def partial(batches):
        sums, products, seen = np.zeros(dims), np.zeros((dims, dims)), False
        for batch in batches:
            z = to_matrix(batch.column(0))
            sums, products, seen = sums + z.sum(axis=0), products + z.T @ z, True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1), pa.int32()), list_column(np.vstack([products, sums]))], ["i", "v"])

    parts = rows.select(column).coalesce(_PARTIALS).mapInArrow(partial, "i int, v array<double>")
    added = parts.groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(dims)]).collect()  # dims + 1 rows
    out = np.zeros((dims + 1, dims))
    for r in added:
        out[r["i"]] = [r[f"v{j}"] for j in range(dims)]
    return out[dims], out[:dims]


@dataclass(frozen=True)
class Whitening:
    """Fitted state: a few dims x components numbers."""

    dims: int
    n: int
    sums: tuple               # exact sums S of the dimensions
    values: np.ndarray        # eigenvalues, falling
    vectors: np.ndarray       # (dims, components)
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.values]

    def centre(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of S/n goes off as integers, so that only small numbers are rounded."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(float) - part

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list:
        """sum of (n x - S)^2, exact; None beyond a long."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        part = np.array([s % self.n for s in self.sums], dtype=np.int64)
        near = x - whole
        if len(x) == 0:
            return []
        if (float(np.abs(near).max()) + 1) * self.n < (2.0 ** 62 / max(1, self.dims)) ** 0.5:
            y = near * self.n - part
            return (y * y).sum(axis=1).tolist()
        exact = [sum((int(a) * self.n - int(b)) ** 2 for a, b in zip(row, part)) for row in near]
        return [d if d < 2 ** 63 else None for d in exact]


def fit(rows: DataFrame, x: str, dims: int, components: int = COMPONENTS) -> Whitening:
    """The leading components of the codes in column ``x``."""
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of more than {MAX_DIMS} dimensions")
    ship_package(rows.sparkSession)
    n, sums = totals(rows, x, dims)
    none = Whitening(dims, n, tuple(sums), np.zeros(0), np.zeros((dims, 0)), 0.0)
    if n == 0 or dims == 0:
        return none
    _, products = product_sums(rows, dims, x, lambda v: none.centre(matrix(v, dims)))
    cov = (products + products.T) / (2 * n)
    if not np.trace(cov) > 0:
        return none
    values, vectors = leading_eigenpairs(cov, components)
    there = values > dims * _EPS * float(np.trace(cov))
    return Whitening(dims, n, tuple(sums), values[there], vectors[:, there], float(np.trace(cov)))


def identity_error(rows: DataFrame, x: str, model: Whitening) -> float:
    """Largest entry of |covariance of the whitened rows - identity|, measured over all rows."""
    k = len(model.values)
    sums, products = product_sums(rows, k, x, lambda v: model.project(matrix(v, model.dims)))
    mean = sums / model.n
    return float(np.abs(products / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _whitener(model: Whitening):
    """Arrow function: codes -> struct(deviation, whitened)."""
    def whiten(v: pa.Array) -> pa.Array:
        x = matrix(v, model.dims)
        return pa.StructArray.from_arrays([pa.array(model.deviation(x), pa.int64()), list_column(model.project(x))],
                                          ["deviation", "whitened"])

    whiten.__annotations__ = {"v": pa.Array, "return": pa.Array}
    return F.arrow_udf(whiten, "struct<deviation:bigint,whitened:array<double>>")


def coded(df: DataFrame, vector: str, dims: int, name: str) -> DataFrame:
    v = F.col(vector)
    return df.filter((F.size(v) == dims) & is_finite(v)).withColumn(name, codes(v, _BOUND, OFFSET))


def whitened(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening, tuple[str, str]]:
    """The remaining rows of ``df`` with ``deviation`` and ``whitened`` (array<double>), the model, the two columns' names."""
    dims = common_length(df, vector)
    x, out = fresh(df, "_codes"), (fresh(df, "deviation"), fresh(df, "whitened"))
    rows = coded(df, vector, dims, x)
    model = fit(rows, x, dims, components)
    if not len(model.values):
        empty = F.array().cast("array<double>")
        return rows.drop(x).withColumns({out[0]: F.lit(0).cast("long"), out[1]: empty}), model, out  # all vectors equal
    got = fresh(rows, "_got")
    found = rows.withColumn(got, _whitener(model)(x))
    return found.withColumns({out[0]: F.col(f"{got}.deviation"), out[1]: F.col(f"{got}.whitened")}).drop(x, got), model, out


def whitening_report(vectors: DataFrame) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every remaining row and component."""
    narrow = vectors.select("vec_id", "embedding")
    found, model, (deviation, values) = whitened(narrow)
    error = 0.0
    if len(model.values):
        error = identity_error(coded(narrow, "embedding", model.dims, "_codes"), "_codes", model)
    long = found.select("vec_id", F.col(deviation).alias("deviation"), F.posexplode(F.col(values)).alias("at", "whitened"))
    explained = F.element_at(F.array(*[F.lit(e) for e in model.explained or [0.0]]), F.col("at") + 1)
    return long.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                       "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))
