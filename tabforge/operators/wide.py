"""Linear regression on sparse feature vectors, without a p x p matrix.

``WideRidge`` solves the normal equations by preconditioned conjugate gradients
and ``WideLasso`` goes by Spark's own orthant-wise quasi-Newton solver; both
have the objectives of ``Ridge`` and ``Lasso``.  A gradient step is one scan:
every task multiplies its sparse rows with the direction and sends one p-vector
in blocks, which one aggregation adds up.  The driver holds a few p-vectors
(p is bounded by ``MAX_FEATURES``: 128 MB each) and sends one to the tasks.  The
rows are centred in the products, never in the data, so they stay sparse.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.operators.base import ColumnEstimator, ColumnModel
from tabforge.operators.dispatch import feature_names, level_table
from tabforge.session import ship_package

MAX_FEATURES = 1 << 24
_BLOCK = 256        # features of one aggregated row
_PARTIALS = 4096    # at most so many tasks send a p-vector


def entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all stored entries of an Arrow batch of ML vectors, sparse and dense ones mixed."""
    lists = vectors.field("values")
    length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(length)), length)
    value = lists.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(length) - length
    feature = np.arange(len(row)) - first[row]          # of dense rows; sparse rows name theirs
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    if sparse.any():
        feature[sparse[row]] = vectors.field("indices").filter(pa.array(sparse)).flatten().to_numpy(zero_copy_only=False)
    return row, feature, value


def summed(rows: DataFrame, p: int, k: int, partial: Callable) -> np.ndarray:
    """Sum over the batches of ``partial(row, feature, value, label)``, each a (k, p) matrix: one scan."""
    blocks = -(-p // _BLOCK)

    def send(batches):
        total = None
        for batch in batches:
            got = partial(*entries(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False))
            total = got if total is None else total + got
        if total is not None:
            padded = np.zeros((k, blocks * _BLOCK))
            padded[:, :p] = total
            flat = padded.reshape(k * blocks, _BLOCK)
            offsets = np.arange(len(flat) + 1, dtype=np.int32) * _BLOCK
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()),
                                              pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))], ["block", "v"])

    parts = rows.coalesce(_PARTIALS).mapInArrow(send, "block int, v array<double>")
    sums = parts.groupBy("block").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(_BLOCK)]).alias("v")).toArrow()  # k * blocks rows
    out = np.zeros((k * blocks, _BLOCK))
    if sums.num_rows:
        flat = sums.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        out[sums.column("block").to_numpy()] = flat.reshape(-1, _BLOCK)
    return out.reshape(k, blocks * _BLOCK)[:, :p]


class LinearVectorModel(ColumnModel):
    """Prediction from a vector column; names of the features as read from its metadata."""

    def __init__(self, features_col: str, prediction_col: str, intercept: float, coef: np.ndarray, names: list[str], iterations: int,
                 name_table: DataFrame | None = None):
        super().__init__()
        self.name_table = name_table   # instead of ``names`` where the levels are in a table
        self.features_col, self.prediction_col = features_col, prediction_col
        self.intercept, self.coef, self.names, self.iterations = float(intercept), np.asarray(coef, dtype=float), names, iterations

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        coef, intercept = self.coef, self.intercept

        def dot(v: pa.Array) -> pa.Array:
            row, feature, value = entries(v)
            return pa.array(intercept + np.bincount(row, weights=value * coef[feature], minlength=len(v)))

        dot.__annotations__ = {"v": pa.Array, "return": pa.Array}
        return dataset.withColumn(self.prediction_col, F.arrow_udf(dot, "double")(self.features_col))

    def coefficients(self, spark: SparkSession) -> DataFrame:
        if self.name_table is not None:
            coef = self.coef

            def of(code: pa.Array) -> pa.Array:
                return pa.array(coef[code.to_numpy(zero_copy_only=False)])

            of.__annotations__ = {"code": pa.Array, "return": pa.Array}
            return self.name_table.select("feature", F.arrow_udf(of, "double")("code").alias("coef"))
        names = self.names or [str(i) for i in range(len(self.coef))]
        return spark.createDataFrame(list(zip(names, self.coef.tolist())), "feature string, coef double")


class WideRidge(ColumnEstimator):
    """Ridge on a vector column: sum (y - b0 - x beta)^2 + alpha |beta|^2, intercept not penalised.

    Stops when the residual of the normal equations is below ``tol`` times the
    right-hand side; raises when that takes more than ``max_iter`` scans.  Rows
    with a null vector or label are left out; a NaN entry is an error.
    """

    def __init__(self, label: str = "label", alpha: float = 1.0, features_col: str = "features", prediction_col: str = "prediction",
                 tol: float = 1e-12, max_iter: int = 500):
        super().__init__()
        self.label, self.alpha, self.features_col, self.prediction_col = label, alpha, features_col, prediction_col
        self.tol, self.max_iter = tol, max_iter

    def _fit(self, dataset: DataFrame) -> LinearVectorModel:
        ship_package(dataset.sparkSession)
        rows = dataset.select(self.features_col, F.col(self.label).cast("double").alias("_y")).dropna()
        names, p = feature_names(dataset, self.features_col), _size(rows, self.features_col)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)   # read once a step; lost blocks are computed again
        try:
            intercept, coef, steps = self._solve(rows, p)
        finally:
            rows.unpersist()
        return LinearVectorModel(self.features_col, self.prediction_col, intercept, coef, names, steps,
                                 level_table(dataset, self.features_col))

    def _solve(self, rows: DataFrame, p: int) -> tuple[float, np.ndarray, int]:
        n, mean_y = rows.agg(F.count(F.lit(1)), F.avg("_y")).first()
        if not n or not p:
            return float(mean_y or 0.0), np.zeros(p), 0

        def moments(row, feature, value, y):
            w = (y - mean_y)[row]
            return np.stack([np.bincount(feature, weights=x, minlength=p) for x in (value, value * value, value * w)])

        sums, squares, b = summed(rows, p, 3, moments)
        if np.isnan(sums).any():
            raise ValueError("the feature vectors hold NaN")
        mean = sums / n
        diagonal = np.maximum(squares - n * mean * mean, 0.0) + self.alpha
        diagonal[diagonal == 0.0] = 1.0     # constant feature, alpha 0: its residual stays 0

        def times(v: np.ndarray) -> np.ndarray:
            """(Xc'Xc + alpha) v: the residuals Xv - mean v sum to 0, so that no row is centred."""
            at_mean = float(mean @ v)

            def partial(row, feature, value, y):
                u = np.bincount(row, weights=value * v[feature], minlength=len(y)) - at_mean
                return np.bincount(feature, weights=value * u[row], minlength=p)[None]

            return summed(rows, p, 1, partial)[0] + self.alpha * v

        beta, r = np.zeros(p), b.copy()
        z = r / diagonal
        direction, rz, goal = z.copy(), float(r @ z), self.tol * float(np.linalg.norm(b))
        for step in range(self.max_iter):
            if float(np.linalg.norm(r)) <= goal:
                return float(mean_y - mean @ beta), beta, step
            turned = times(direction)
            length = rz / float(direction @ turned)
            beta, r = beta + length * direction, r - length * turned
            z = r / diagonal
            rz, before = float(r @ z), rz
            direction = z + rz / before * direction
        raise RuntimeError(f"conjugate gradients did not converge in {self.max_iter} steps")


class WideLasso(ColumnEstimator):
    """Lasso on a vector column: 1/(2n) sum (y - b0 - x beta)^2 + alpha |beta|_1, by Spark's OWL-QN solver (tree-aggregated gradients)."""

    def __init__(self, label: str = "label", alpha: float = 0.0005, features_col: str = "features", prediction_col: str = "prediction",
                 tol: float = 1e-10, max_iter: int = 1000):
        super().__init__()
        self.label, self.alpha, self.features_col, self.prediction_col = label, alpha, features_col, prediction_col
        self.tol, self.max_iter = tol, max_iter

    def _fit(self, dataset: DataFrame) -> LinearVectorModel:
        rows = dataset.select(self.features_col, F.col(self.label).cast("double").alias("_y")).dropna()
        _size(rows, self.features_col)
        if "level_table" in rows.schema[self.features_col].metadata:   # Spark's solver reads vectors only
            vector = F.udf(lambda v: SparseVector(v["size"], v["indices"], v["values"]), VectorUDT())
            rows = rows.select(vector(self.features_col).alias(self.features_col), "_y")
        solver = LinearRegression(featuresCol=self.features_col, labelCol="_y", regParam=self.alpha, elasticNetParam=1.0, standardization=False,
                                  solver="l-bfgs", tol=self.tol, maxIter=self.max_iter, aggregationDepth=2)
        model = solver.fit(rows)
        return LinearVectorModel(self.features_col, self.prediction_col, model.intercept, model.coefficients.toArray(),
                                 feature_names(dataset, self.features_col), model.summary.totalIterations,
                                 level_table(dataset, self.features_col))


def _size(rows: DataFrame, features_col: str) -> int:
    meta = rows.schema[features_col].metadata.get("ml_attr", {})
    p = meta.get("num_attrs")
    if p is None:
        first = rows.select(features_col).first()
        p = first[0].size if first else 0
    if p > MAX_FEATURES:
        raise ValueError(f"{p} features; at most {MAX_FEATURES}")
    return int(p)
