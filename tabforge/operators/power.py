"""Yeo-Johnson power transform with a per-column maximum-likelihood lambda.

log-likelihood(lambda) = -n/2 * ln(var_pop(yj_lambda(x))) + (lambda - 1) * sum(sign(x) ln(1 + |x|))

The lambda search is a grid: a coarse pass over [lo, hi], then a fine pass
around the best coarse value.  Each pass is ONE scan: every task transforms
its Arrow batches for all grid lambdas with numpy and emits per-lambda
partial moments (n, mean, M2), which are merged per (column, lambda).  The
data is never multiplied by the grid and only grid-size rows are shuffled.
Grid points are integer / denominator so the oracle can rebuild them exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.exprs import yeo_johnson
from tabforge.operators.audit import skew_split
from tabforge.operators.base import ColumnEstimator, ColumnModel
from tabforge.operators.encode import RobustScaler, RobustScalerModel
from tabforge.session import ship_package


def _yj_numpy(x: np.ndarray, lam: float) -> np.ndarray:
    out = np.empty_like(x)
    pos = x >= 0
    if abs(lam) < 1e-12:
        out[pos] = np.log1p(x[pos])
    else:
        out[pos] = (np.power(x[pos] + 1.0, lam) - 1.0) / lam
    if abs(lam - 2.0) < 1e-12:
        out[~pos] = -np.log1p(-x[~pos])
    else:
        out[~pos] = -(np.power(1.0 - x[~pos], 2.0 - lam) - 1.0) / (2.0 - lam)
    return out


def _is_spread(var: float | None, mean: float | None) -> bool:
    """True for a real variance; round-off dust of a constant column counts as zero."""
    if var is None or math.isnan(var) or math.isinf(var):
        return False
    return var > (1e-12 * max(abs(mean or 0.0), 1e-150)) ** 2


def _means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: float(row[c]) if row[c] is not None else 0.0 for c in cols}


def _best_lambda(df: DataFrame, cols: Sequence[str], grids: dict[str, list[float]], refs: dict[str, float] | None = None) -> dict[str, float]:
    """One scan: each task emits (column, lambda, n, mean, M2) of its transformed rows.

    Within a task batches merge with Chan's update (exact); across tasks the
    partials are added up in one small aggregate, the between-task term being
    sum(n mean^2) - n mu^2 of the task means, taken around yj(column mean).
    """
    cols = list(cols)
    # values are transformed relative to yj(ref) (variance is shift-free); with the shift the
    # between-task term below only cancels at the scale of the spread, not of the values
    refs = _means(df, cols) if refs is None else refs

    def partial(batches):
        acc = {}
        for pdf in batches:
            for c in cols:
                x = pdf[c].to_numpy(dtype=float)
                x = x[~np.isnan(x)]
                if x.size == 0:
                    continue
                s_term = float(np.sum(np.sign(x) * np.log1p(np.abs(x))))
                for li, lam in enumerate(grids[c]):
                    t = _yj_numpy(x, lam) - _yj_numpy(np.array([refs[c]]), lam)[0]
                    key = (c, li)
                    n0, m0, q0, s0 = acc.get(key, (0, 0.0, 0.0, 0.0))
                    n1, m1 = t.size, float(t.mean())
                    q1 = float(((t - m1) ** 2).sum())
                    n = n0 + n1
                    delta = m1 - m0
                    acc[key] = (n, m0 + delta * n1 / n, q0 + q1 + delta * delta * n0 * n1 / n,
                                s0 + (s_term if li == 0 else 0.0))
        if acc:
            keys = list(acc)
            yield pd.DataFrame({"column": [k[0] for k in keys], "li": [k[1] for k in keys],
                                "n": [acc[k][0] for k in keys], "mean": [acc[k][1] for k in keys],
                                "m2": [acc[k][2] for k in keys], "s": [acc[k][3] for k in keys]})

    ship_package(df.sparkSession)
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInPandas(
        partial, "column string, li int, n long, mean double, m2 double, s double")
    # one small aggregate of additive terms (tasks x grid rows in, columns x grid rows out)
    sums = parts.groupBy("column", "li").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("mean")).alias("s1"),
        F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("s2"), F.sum("m2").alias("m2"),
        F.sum("s").alias("s")).collect()
    stats = {}
    for r in sums:
        n = r["n"]
        if r["s1"] is None or r["s2"] is None or r["m2"] is None:
            if r["li"] == 0:
                stats[(r["column"], 0)] = {"n": 0, "m2": 0.0, "mu": 0.0, "s": r["s"]}
            continue   # the transform overflows at this lambda: it is no candidate
        mu = r["s1"] / n if n else 0.0
        # pooled M2 = sum of within-task M2 (exact per task) + between-task spread of the means
        between = max(r["s2"] - r["s1"] * mu, 0.0)
        stats[(r["column"], r["li"])] = {"n": n, "m2": r["m2"] + between, "mu": mu, "s": r["s"]}
    s_of = {c: (stats[(c, 0)]["s"] or 0.0) if (c, 0) in stats else 0.0 for c in cols}
    best = {}
    for c in cols:
        top, top_ll = 1.0, -math.inf
        for li, lam in enumerate(grids[c]):
            r = stats.get((c, li))
            if r is None or not r["n"]:
                continue
            v = r["m2"] / r["n"]
            if not _is_spread(v, r["mu"]):
                continue
            ll = -r["n"] / 2.0 * math.log(v) + (lam - 1.0) * s_of[c]
            if ll > top_ll:
                top, top_ll = lam, ll
        best[c] = top
    return best


class YeoJohnson(ColumnEstimator):
    """Fit lambda per column by grid MLE, then (optionally) standardise (population std).

    ``lo`` and ``hi`` only start the search: while a column's best lambda is at
    an end of its grid, the grid goes on beyond it in steps twice as wide, then
    finer grids close in on the best point to 1 / ``fine_den``.
    """

    def __init__(self, cols: Sequence[str], standardize: bool = True, lo: float = -5.0, hi: float = 5.0,
                 coarse_den: int = 10, fine_den: int = 1000, fine_half: int = 100):
        super().__init__()
        self.cols, self.standardize = list(cols), standardize
        self.lo, self.hi, self.coarse_den, self.fine_den, self.fine_half = lo, hi, coarse_den, fine_den, fine_half

    def coarse_grid(self) -> list[float]:
        a, b = round(self.lo * self.coarse_den), round(self.hi * self.coarse_den)
        return [float(k) / self.coarse_den for k in range(a, b + 1)]

    def fine_grid(self, center: float, half: float | None = None) -> list[float]:
        """From ``center - half`` to ``center + half``; by default ``fine_half`` steps of 1 / ``fine_den`` to each side."""
        den = self.fine_half / half if half else self.fine_den
        return [center + float(j - self.fine_half) / den for j in range(2 * self.fine_half + 1)]

    def _bracketed(self, dataset: DataFrame, refs: dict[str, float]) -> tuple[dict[str, float], dict[str, float]]:
        """(best grid point, spacing around it) per column, the point inside its grid."""
        best = _best_lambda(dataset, self.cols, {c: self.coarse_grid() for c in self.cols}, refs)
        step = {c: 1.0 / self.coarse_den for c in self.cols}
        n = len(self.coarse_grid()) - 1
        ends = {c: (self.coarse_grid()[0], self.coarse_grid()[-1]) for c in self.cols}
        while beyond := [c for c in self.cols if best[c] in ends[c]]:
            grids = {}
            for c in beyond:
                step[c] *= 2
                way = -step[c] if best[c] == ends[c][0] else step[c]
                grids[c] = [best[c] + k * way for k in range(n + 1)]
                ends[c] = (grids[c][-1], math.inf) if way < 0 else (-math.inf, grids[c][-1])
            best |= _best_lambda(dataset, beyond, grids, refs)
        return best, step

    def _fit(self, dataset: DataFrame) -> YeoJohnsonModel:
        if not self.cols:
            return YeoJohnsonModel({}, {}, {})
        refs = _means(dataset, self.cols)
        coarse, step = self._bracketed(dataset, refs)
        lams = _best_lambda(dataset, self.cols, {c: self.fine_grid(coarse[c], step[c]) for c in self.cols}, refs)
        step = {c: x / self.fine_half for c, x in step.items()}
        while wide := [c for c in self.cols if step[c] > 1.0 / self.fine_den + 1e-12]:
            lams |= _best_lambda(dataset, wide, {c: self.fine_grid(lams[c], step[c]) for c in wide}, refs)
            step |= {c: step[c] / self.fine_half for c in wide}
        mean, scale = {}, {}
        if self.standardize:
            st = dataset.agg(*[F.avg(yeo_johnson(c, lams[c])).alias(f"m_{i}") for i, c in enumerate(self.cols)],
                             *[F.stddev_pop(yeo_johnson(c, lams[c])).alias(f"s_{i}") for i, c in enumerate(self.cols)]).first()
            for i, c in enumerate(self.cols):
                mean[c] = st[f"m_{i}"] or 0.0
                s = st[f"s_{i}"]
                scale[c] = s if s is not None and _is_spread(s * s, mean[c]) else 1.0
        return YeoJohnsonModel(lams, mean, scale)


class YeoJohnsonModel(ColumnModel):
    def __init__(self, lambdas: dict, mean: dict, scale: dict):
        super().__init__()
        self.lambdas, self.mean, self.scale = lambdas, mean, scale

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = {}
        for c, lam in self.lambdas.items():
            if c not in dataset.columns:
                continue
            e = yeo_johnson(c, lam)
            if c in self.mean:
                e = (e - F.lit(self.mean[c])) / F.lit(self.scale[c])
            cols[c] = e
        return dataset.withColumns(cols) if cols else dataset


class SkewRouter(ColumnEstimator):
    """|population skew| > threshold -> Yeo-Johnson then robust scaling; others robust scaling only."""

    def __init__(self, cols: Sequence[str], threshold: float = 0.75):
        super().__init__()
        self.cols, self.threshold = list(cols), threshold

    def _fit(self, dataset: DataFrame) -> SkewRouterModel:
        skewed, normal = skew_split(dataset, self.cols, self.threshold)
        power = YeoJohnson(skewed).fit(dataset)
        both = RobustScaler(normal + skewed).fit(power.transform(dataset))  # the transform leaves the other columns as they are

        def part(cols):
            return RobustScalerModel({c: both.center[c] for c in cols}, {c: both.scale[c] for c in cols})

        return SkewRouterModel(skewed, normal, power, part(normal), part(skewed))


class SkewRouterModel(ColumnModel):
    def __init__(self, skewed, normal, power, scaler_n, scaler_s):
        super().__init__()
        self.skewed, self.normal = skewed, normal
        self.power, self.scaler_n, self.scaler_s = power, scaler_n, scaler_s

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.scaler_s.transform(self.scaler_n.transform(self.power.transform(dataset)))
