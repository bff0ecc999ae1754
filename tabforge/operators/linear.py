"""Linear regression (ridge, lasso, ridge with leave-one-out alpha) from Gram sums.

One scan computes, per group (e.g. per fold), the cross products of the
augmented rows [1, x_1..x_p, y]: each task multiplies its Arrow batches with
numpy (X^T X, vectorised) and emits the upper triangle as long rows, which a
``groupBy(g, i, j).sum`` adds up.  The driver only sees (p+2)^2/2 numbers per
group, whatever the row count, and solves the p x p systems:

* ridge   beta = (Xc'Xc + alpha I)^-1 Xc'yc, intercept unpenalised (centred)
* lasso   coordinate descent on the centred Gram (objective 1/(2n)||r||^2 + alpha|beta|_1)
* leave-fold-out models are total - fold sums, so K folds cost one scan.

Columns are shifted by their means (one cheap aggregate) before the products
to keep the centred sums accurate at large row counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.base import ColumnEstimator, ColumnModel
from tabforge.session import ship_package


@dataclass
class Gram:
    """Sufficient statistics of one row group, in shifted coordinates."""

    n: float
    sx: np.ndarray      # sum x          (p)
    sy: float           # sum y
    sxx: np.ndarray     # sum x x'       (p, p)
    sxy: np.ndarray     # sum x y        (p)
    syy: float
    shift_x: np.ndarray
    shift_y: float

    def __sub__(self, o: Gram) -> Gram:
        return Gram(self.n - o.n, self.sx - o.sx, self.sy - o.sy, self.sxx - o.sxx, self.sxy - o.sxy,
                    self.syy - o.syy, self.shift_x, self.shift_y)

    def __add__(self, o: Gram) -> Gram:
        return Gram(self.n + o.n, self.sx + o.sx, self.sy + o.sy, self.sxx + o.sxx, self.sxy + o.sxy,
                    self.syy + o.syy, self.shift_x, self.shift_y)

    def take(self, idx: Sequence[int]) -> Gram:
        """The statistics of some of the features: a model on them needs no scan of its own."""
        i = list(idx)
        return Gram(self.n, self.sx[i], self.sy, self.sxx[np.ix_(i, i)], self.sxy[i], self.syy, self.shift_x[i], self.shift_y)

    def centred(self):
        xbar, ybar = self.sx / self.n, self.sy / self.n
        cxx = self.sxx - self.n * np.outer(xbar, xbar)
        cxy = self.sxy - self.n * xbar * ybar
        return xbar, ybar, cxx, cxy


def gram_sums(df: DataFrame, features: Sequence[str], label: str, group_col: str | None = None) -> dict:
    """{group: Gram} over rows with no null feature or label (group None when ungrouped)."""
    features = list(features)
    p = len(features)
    cols = features + [label]
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    clean = df.where(complete)
    means = clean.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    shift = np.array([means[c] if means[c] is not None else 0.0 for c in cols], dtype=float)
    g_expr = F.col(group_col).cast("long") if group_col else F.lit(0).cast("long")
    ship_package(df.sparkSession)
    proj = clean.select(g_expr.alias("_g"), *[(F.col(c).cast("double") - F.lit(float(s))).alias(f"_c{k}")
                                               for k, (c, s) in enumerate(zip(cols, shift))])
    m = p + 2
    iu, ju = np.triu_indices(m)

    def partial(batches):
        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            a = np.empty((len(pdf), m))
            a[:, 0] = 1.0
            a[:, 1:] = pdf[[f"_c{k}" for k in range(p + 1)]].to_numpy(dtype=float)
            gs = pdf["_g"].to_numpy()
            for g in np.unique(gs):
                sub = a[gs == g]
                acc[int(g)] = acc.get(int(g), 0.0) + sub.T @ sub
        for g, mat in acc.items():
            yield pd.DataFrame({"g": g, "i": iu, "j": ju, "v": mat[iu, ju]})

    sums = (proj.mapInPandas(partial, "g long, i int, j int, v double")
            .groupBy("g", "i", "j").agg(F.sum("v").alias("v")).collect())
    full: dict[int, np.ndarray] = {}
    for r in sums:
        mat = full.setdefault(r["g"], np.zeros((m, m)))
        mat[r["i"], r["j"]] = mat[r["j"], r["i"]] = r["v"]
    out = {}
    for g, a in full.items():
        out[g if group_col else None] = Gram(n=a[0, 0], sx=a[0, 1:p + 1].copy(), sy=a[0, p + 1],
                                             sxx=a[1:p + 1, 1:p + 1].copy(), sxy=a[1:p + 1, p + 1].copy(),
                                             syy=a[p + 1, p + 1], shift_x=shift[:p], shift_y=shift[p])
    return out


# ------------------------------------------------------------------ solvers

def solve_ridge(g: Gram, alpha: float) -> tuple[float, np.ndarray]:
    """(intercept, coef) in original coordinates; sklearn ``Ridge(alpha)`` objective."""
    xbar, ybar, cxx, cxy = g.centred()
    p = len(xbar)
    beta = np.linalg.solve(cxx + alpha * np.eye(p), cxy) if p else np.zeros(0)
    return _unshift(g, ybar - xbar @ beta, beta)


def solve_lasso(g: Gram, alpha: float, max_iter: int = 100_000, tol: float = 1e-12) -> tuple[float, np.ndarray]:
    """Coordinate descent on the centred Gram; sklearn ``Lasso(alpha)`` objective."""
    xbar, ybar, cxx, cxy = g.centred()
    n, p = g.n, len(xbar)
    G, c = cxx / n, cxy / n
    beta = np.zeros(p)
    for _ in range(max_iter):
        delta = 0.0
        for j in range(p):
            if G[j, j] <= 0:
                continue
            rho = c[j] - G[j] @ beta + G[j, j] * beta[j]
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / G[j, j]
            delta = max(delta, abs(new - beta[j]))
            beta[j] = new
        if delta <= tol * max(1.0, np.max(np.abs(beta)) if p else 1.0):
            break
    else:
        raise RuntimeError(f"lasso did not converge in {max_iter} rounds")
    return _unshift(g, ybar - xbar @ beta, beta)


def _unshift(g: Gram, b0: float, beta: np.ndarray) -> tuple[float, np.ndarray]:
    # model was fitted on (x - sx, y - sy): y = sy + b0 + beta (x - sx)
    return float(g.shift_y + b0 - beta @ g.shift_x), beta


def balanced_sum(terms: Sequence[Column]) -> Column:
    """Sum as a balanced tree: its depth is the logarithm of the number of terms."""
    terms = list(terms)
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def linear_expr(features: Sequence[str], intercept: float, coef: Sequence[float]) -> Column:
    return balanced_sum([F.lit(float(intercept))] + [F.col(c).cast("double") * F.lit(float(b))
                                                     for c, b in zip(features, coef) if b != 0.0])


def ridge_loo_mse(df: DataFrame, g: Gram, features: Sequence[str], label: str, alphas: Sequence[float]) -> dict:
    """Mean squared leave-one-out residual per alpha: e_i / (1 - h_i), one scan for all alphas and any number of features.

    h_i = 1/n + xc_i' (Xc'Xc + alpha I)^-1 xc_i on centred x (intercept not
    penalised).  The matrices are factored once on the driver; a task works on
    its Arrow batches, h of a batch being the column sums of (L^-1 xc)^2, and
    sends one sum per alpha.
    """
    xbar_s, _, cxx, _ = g.centred()
    xbar = xbar_s + g.shift_x
    p, n = len(features), g.n
    solved = [(*solve_ridge(g, a), np.linalg.inv(np.linalg.cholesky(cxx + a * np.eye(p))) if p else np.zeros((0, 0))) for a in alphas]
    ship_package(df.sparkSession)
    cols = [*features, label]
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    rows = df.where(complete).select(*[F.col(c).cast("double").alias(f"_c{k}") for k, c in enumerate(cols)])

    def partial(batches):
        sums, count = np.zeros(len(solved)), 0
        for pdf in batches:
            x, y = pdf.iloc[:, :p].to_numpy(dtype=float), pdf.iloc[:, p].to_numpy(dtype=float)
            xc = x - xbar
            for k, (b0, beta, root) in enumerate(solved):
                h = 1.0 / n + ((root @ xc.T) ** 2).sum(axis=0)
                sums[k] += (((y - b0 - x @ beta) / (1.0 - h)) ** 2).sum()
            count += len(pdf)
        yield pd.DataFrame({"k": np.arange(len(solved)), "s": sums, "n": count})

    total = rows.mapInPandas(partial, "k int, s double, n long").groupBy("k").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    return {alphas[r["k"]]: r["s"] / r["n"] if r["n"] else None for r in sorted(total, key=lambda r: r["k"])}


# ------------------------------------------------------------------ estimators

class LinearRegressionModel(ColumnModel):
    def __init__(self, features, intercept, coef, prediction_col="prediction", alpha=None):
        super().__init__()
        self.features, self.intercept = list(features), float(intercept)
        self.coef, self.prediction_col, self.alpha = np.asarray(coef, dtype=float), prediction_col, alpha

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.prediction_col, linear_expr(self.features, self.intercept, self.coef))

    def coefficients(self, spark) -> DataFrame:
        rows = [(f, float(b)) for f, b in zip(self.features, self.coef)]
        return spark.createDataFrame(rows, "feature string, coef double")


class Ridge(ColumnEstimator):
    kind = "ridge"

    def __init__(self, features: Sequence[str], label: str = "label", alpha: float = 1.0,
                 prediction_col: str = "prediction"):
        super().__init__()
        self.features, self.label, self.alpha, self.prediction_col = list(features), label, alpha, prediction_col

    def solve(self, g: Gram) -> tuple[float, np.ndarray]:
        return solve_ridge(g, self.alpha)

    def fit_gram(self, g: Gram) -> LinearRegressionModel:
        b0, beta = self.solve(g)
        return LinearRegressionModel(self.features, b0, beta, self.prediction_col, self.alpha)

    def _fit(self, dataset: DataFrame) -> LinearRegressionModel:
        return self.fit_gram(gram_sums(dataset, self.features, self.label)[None])

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        """One Gram scan serves every param map that changes neither features nor label (a ``CrossValidator`` grid)."""
        each = [self.copy(m) for m in paramMaps]
        shared = type(self)._fit is Ridge._fit and all((e.features, e.label) == (self.features, self.label) for e in each)
        if not shared:
            return super().fitMultiple(dataset, paramMaps)
        g = gram_sums(dataset, self.features, self.label)[None]
        return iter([(i, e.fit_gram(g)) for i, e in enumerate(each)])


class Lasso(Ridge):
    kind = "lasso"

    def solve(self, g: Gram) -> tuple[float, np.ndarray]:
        return solve_lasso(g, self.alpha)


class RidgeCV(Ridge):
    """Ridge whose alpha minimises the leave-one-out squared error (efficient LOO)."""

    kind = "ridge_cv"

    def __init__(self, features, label="label", alphas=(0.1, 1.0, 10.0, 100.0), prediction_col="prediction"):
        super().__init__(features, label, alphas[0], prediction_col)
        self.alphas = list(alphas)
        self.loo_mse_: dict = {}

    def _fit(self, dataset: DataFrame) -> LinearRegressionModel:
        g = gram_sums(dataset, self.features, self.label)[None]
        self.loo_mse_ = ridge_loo_mse(dataset, g, self.features, self.label, self.alphas)
        best = min(self.alphas, key=lambda a: (self.loo_mse_[a], a))
        b0, beta = solve_ridge(g, best)
        return LinearRegressionModel(self.features, b0, beta, self.prediction_col, best)


class L1Selector(ColumnEstimator):
    """Keep features whose lasso coefficient has |coef| >= threshold (fit on training rows only)."""

    def __init__(self, features: Sequence[str], label: str = "label", alpha: float = 0.0005, threshold: float = 1e-5):
        super().__init__()
        self.features, self.label, self.alpha, self.threshold = list(features), label, alpha, threshold

    def _fit(self, dataset: DataFrame) -> L1SelectorModel:
        self.gram_ = gram_sums(dataset, self.features, self.label)[None]
        _, beta = solve_lasso(self.gram_, self.alpha)
        kept = [f for f, b in zip(self.features, beta) if abs(b) >= self.threshold]
        if not kept:
            raise ValueError("L1 selection kept no feature; lower alpha")
        return L1SelectorModel(kept, [f for f in self.features if f not in kept], dict(zip(self.features, beta)))


class L1SelectorModel(ColumnModel):
    def __init__(self, kept, dropped, coef):
        super().__init__()
        self.kept, self.dropped, self.coef = kept, dropped, coef

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*[c for c in self.dropped if c in dataset.columns])
