"""Blends and stacking over per-model prediction columns.

Prediction columns sit side by side in one DataFrame (each model's
``transform`` adds one column), so row alignment is by construction and the
blend is a column expression.  Fitting simplex weights needs only the OOF
cross products sum(p_i p_j), sum(p_i y), sum(y^2): one aggregate row; the
k x k constrained least squares is then solved exactly on the driver (k is the
number of models): by trying all supports up to ``MAX_BLEND`` models, by a
primal active-set method beyond.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.base import ColumnEstimator, ColumnModel
from tabforge.operators.linear import LinearRegressionModel, gram_sums
from tabforge.operators.validate import fit_linear_cvs, run_parallel


MAX_BLEND = 14   # models whose supports are all tried


def average_expr(cols: Sequence[str]) -> Column:
    e = F.col(cols[0])
    for c in cols[1:]:
        e = e + F.col(c)
    return e / F.lit(float(len(cols)))


def weighted_expr(cols: Sequence[str], weights: Sequence[float]) -> Column:
    e = F.lit(0.0)
    for c, w in zip(cols, weights):
        e = e + F.col(c) * F.lit(float(w))
    return e


def oof_cross_products(oof: DataFrame, pred_cols: Sequence[str], label: str) -> tuple[np.ndarray, np.ndarray, float, int]:
    """(P'P, P'y, y'y, n) from one aggregate row; beyond ``MAX_BLEND`` models from the Gram scan of ``linear``."""
    k = len(pred_cols)
    if k > MAX_BLEND:
        g = gram_sums(oof, pred_cols, label)[None]
        s, n = g.shift_x, g.n
        ptp = g.sxx + np.outer(s, g.sx) + np.outer(g.sx, s) + n * np.outer(s, s)
        pty = g.sxy + s * g.sy + g.sx * g.shift_y + n * s * g.shift_y
        return ptp, pty, float(g.syy + 2 * g.shift_y * g.sy + n * g.shift_y ** 2), int(n)
    aggs = [F.sum(F.col(a) * F.col(b)).alias(f"pp_{i}_{j}") for i, a in enumerate(pred_cols)
            for j, b in enumerate(pred_cols) if j >= i]
    aggs += [F.sum(F.col(a) * F.col(label)).alias(f"py_{i}") for i, a in enumerate(pred_cols)]
    aggs += [F.sum(F.col(label) * F.col(label)).alias("yy"), F.count(F.lit(1)).alias("n")]
    r = oof.agg(*aggs).first()
    ptp = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            ptp[i, j] = ptp[j, i] = r[f"pp_{i}_{j}"]
    pty = np.array([r[f"py_{i}"] for i in range(k)])
    return ptp, pty, float(r["yy"]), int(r["n"])


def simplex_least_squares(ptp: np.ndarray, pty: np.ndarray, yy: float) -> np.ndarray:
    """argmin ||y - P w||^2 subject to w >= 0, sum w = 1, exact.

    The problem is convex, so the best KKT point over all supports is the optimum.
    """
    k = len(pty)
    if k > MAX_BLEND:
        return simplex_by_active_set(ptp, pty)
    best_w, best_obj = None, np.inf
    for size in range(1, k + 1):
        for support in itertools.combinations(range(k), size):
            s = list(support)
            a = ptp[np.ix_(s, s)]
            # [2A 1; 1' 0] [w; mu] = [2b; 1]
            kkt = np.zeros((size + 1, size + 1))
            kkt[:size, :size] = 2 * a
            kkt[:size, size] = 1.0
            kkt[size, :size] = 1.0
            rhs = np.concatenate([2 * pty[s], [1.0]])
            try:
                sol = np.linalg.lstsq(kkt, rhs, rcond=None)[0]
            except np.linalg.LinAlgError:
                continue
            w_s = sol[:size]
            if np.any(w_s < -1e-12):
                continue
            w = np.zeros(k)
            w[s] = np.clip(w_s, 0.0, None)
            w /= w.sum()
            obj = yy - 2 * w @ pty + w @ ptp @ w
            if obj < best_obj - 1e-15:
                best_w, best_obj = w, obj
    return best_w


def simplex_by_active_set(ptp: np.ndarray, pty: np.ndarray) -> np.ndarray:
    """The same minimum for any number of models: a support grows by the model that lowers the error fastest.

    In every step the error is minimised on the support with sum 1; where that
    would make a weight negative, the step ends at the first weight that
    reaches 0 and that model leaves the support.  At the end no model outside
    has a smaller gradient than those inside (the KKT conditions).
    """
    k = len(pty)
    start = int(np.argmin(np.diag(ptp) - 2 * pty))
    w, support = np.zeros(k), [start]
    w[start] = 1.0
    size = max(float(np.abs(ptp).max()), float(np.abs(pty).max()), 1e-300)
    for _ in range(100 * k):
        while True:
            m = len(support)
            kkt = np.ones((m + 1, m + 1))
            kkt[:m, :m], kkt[m, m] = 2 * ptp[np.ix_(support, support)] / size, 0.0
            goal = np.linalg.lstsq(kkt, np.concatenate([2 * pty[support] / size, [1.0]]), rcond=None)[0][:m]
            if (goal >= 0).all():
                w[support] = goal
                break
            now = w[support]
            falling = goal < 0
            share = np.min(now[falling] / (now[falling] - goal[falling]))
            w[support] = now + share * (goal - now)
            gone = {i for i, v, f in zip(support, w[support], falling) if f and v <= 1e-14}
            for i in gone:
                w[i] = 0.0
            support = [i for i in support if i not in gone]
        slope = (ptp @ w - pty) / size
        inside = slope[support].mean()
        out = [i for i in range(k) if i not in set(support)]
        if not out or slope[out].min() >= inside - 1e-12:
            break
        support.append(out[int(np.argmin(slope[out]))])
    w = np.clip(w, 0.0, None)
    return w / w.sum()


class FixedBlendModel(ColumnModel):
    """Weighted (or equal-weight) blend of prediction columns already on the table."""

    def __init__(self, pred_cols: Sequence[str], weights: Sequence[float] | None = None, output_col: str = "prediction"):
        super().__init__()
        self.pred_cols, self.output_col = list(pred_cols), output_col
        self.weights = list(weights) if weights is not None else [1.0 / len(pred_cols)] * len(pred_cols)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.output_col, weighted_expr(self.pred_cols, self.weights))


class SimplexBlend(ColumnEstimator):
    """Fit blend weights on OOF prediction columns (w >= 0, sum w = 1, min squared error)."""

    def __init__(self, pred_cols: Sequence[str], label: str = "label", output_col: str = "prediction"):
        super().__init__()
        self.pred_cols, self.label, self.output_col = list(pred_cols), label, output_col

    def _fit(self, dataset: DataFrame) -> FixedBlendModel:
        ptp, pty, yy, _ = oof_cross_products(dataset, self.pred_cols, self.label)
        return FixedBlendModel(self.pred_cols, simplex_least_squares(ptp, pty, yy).tolist(), self.output_col)


class ModelEnsemble(ColumnEstimator):
    """Fit fresh copies of several estimators; each adds its own prediction column.

    ``combine`` is 'mean' (averaging blend), a weight list (fixed blend) or None
    (keep only the per-model columns, e.g. as stacking meta-features).
    """

    def __init__(self, makers: dict[str, Callable[[], object]], combine="mean", output_col: str = "prediction"):
        super().__init__()
        self.makers, self.combine, self.output_col = dict(makers), combine, output_col

    def _fit(self, dataset: DataFrame) -> ModelEnsembleModel:
        models = run_parallel(lambda mk: mk().fit(dataset), list(self.makers.values()))
        return ModelEnsembleModel(dict(zip(self.makers, models)), self.combine, self.output_col)


class ModelEnsembleModel(ColumnModel):
    def __init__(self, models: dict, combine, output_col):
        super().__init__()
        self.models, self.combine, self.output_col = models, combine, output_col

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for name, m in self.models.items():
            out = m.transform(out)
            out = out.withColumnRenamed(getattr(m, "prediction_col", "prediction"), f"p_{name}")
        cols = [f"p_{n}" for n in self.models]
        if self.combine is None:
            return out
        weights = [1.0 / len(cols)] * len(cols) if self.combine == "mean" else list(self.combine)
        return out.withColumn(self.output_col, weighted_expr(cols, weights))


class Stacking(ColumnEstimator):
    """Stacked regression: OOF predictions of the base models feed a meta model.

    ``oof_fn(df, name, maker) -> df + p_name`` adds the out-of-fold column of one
    base model to the frame it is given (same rows), so the OOF table is built
    by chaining columns, without joins.  Base models are then refitted on all
    rows, and the meta model (e.g. RidgeCV over the p_* columns) is fitted on
    the OOF table (no passthrough of the original features).  Without
    ``oof_fn`` the base models must be linear.
    """

    def __init__(self, makers: dict[str, Callable[[], object]], meta_maker: Callable[[list[str]], object],
                 oof_fn: Callable | None, id_col: str, output_col: str = "prediction", fold_col: str = "fold"):
        super().__init__()
        self.makers, self.meta_maker, self.oof_fn = dict(makers), meta_maker, oof_fn
        self.id_col, self.output_col, self.fold_col = id_col, output_col, fold_col

    def _fit(self, dataset: DataFrame) -> StackingModel:
        if self.oof_fn is None:
            return self._fit_linear(dataset)
        oof = dataset
        for name, mk in self.makers.items():
            oof = self.oof_fn(oof, name, mk)
        cols = [f"p_{n}" for n in self.makers]
        meta = self.meta_maker(cols).fit(oof)
        base = ModelEnsemble(self.makers, combine=None).fit(dataset)
        self.oof_ = oof
        return StackingModel(base, meta, self.output_col)

    def _fit_linear(self, dataset: DataFrame) -> StackingModel:
        """All base models are linear: fold models and refits come from one Gram scan."""
        cvs = fit_linear_cvs(dataset, {n: mk() for n, mk in self.makers.items()}, self.fold_col)
        oof = dataset.withColumns({f"p_{n}": cv.oof_expr() for n, cv in cvs.items()})
        meta = self.meta_maker([f"p_{n}" for n in cvs]).fit(oof)
        models = {n: LinearRegressionModel(cv.estimator.features, *cv.full_model) for n, cv in cvs.items()}
        self.oof_ = oof
        return StackingModel(ModelEnsembleModel(models, None, self.output_col), meta, self.output_col)


class StackingModel(ColumnModel):
    def __init__(self, base, meta, output_col):
        super().__init__()
        self.base, self.meta, self.output_col = base, meta, output_col

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.meta.transform(self.base.transform(dataset))
        pc = getattr(self.meta, "prediction_col", "prediction")
        return out.withColumnRenamed(pc, self.output_col) if pc != self.output_col else out


def fold_cross_products(oof: DataFrame, pred_cols: Sequence[str], label: str, fold_col: str = "fold") -> dict:
    """{fold: (P'P, P'y, y'y, n)} from one grouped aggregate (k folds, k x p^2 numbers)."""
    k = len(pred_cols)
    aggs = [F.sum(F.col(a) * F.col(b)).alias(f"pp_{i}_{j}") for i, a in enumerate(pred_cols)
            for j, b in enumerate(pred_cols) if j >= i]
    aggs += [F.sum(F.col(a) * F.col(label)).alias(f"py_{i}") for i, a in enumerate(pred_cols)]
    aggs += [F.sum(F.col(label) * F.col(label)).alias("yy"), F.count(F.lit(1)).alias("n")]
    out = {}
    for r in oof.groupBy(fold_col).agg(*aggs).collect():
        ptp = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                ptp[i, j] = ptp[j, i] = r[f"pp_{i}_{j}"]
        out[r[fold_col]] = (ptp, np.array([r[f"py_{i}"] for i in range(k)]), float(r["yy"]), int(r["n"]))
    return out


def nested_blend(oof: DataFrame, pred_cols: Sequence[str], label: str, fold_col: str = "fold",
                 output_col: str = "blend") -> tuple[DataFrame, dict]:
    """Blend whose weights for fold k are fitted on the other folds' OOF rows only.

    Scoring the weights on rows they were not fitted on gives an honest blend
    score (the weights fitted on all OOF rows score those same rows).  Returns
    the table with the blend column and {fold: weights}.
    """
    per = fold_cross_products(oof, pred_cols, label, fold_col)
    tot_ptp = sum(v[0] for v in per.values())
    tot_pty = sum(v[1] for v in per.values())
    tot_yy = sum(v[2] for v in per.values())
    weights = {f: simplex_least_squares(tot_ptp - v[0], tot_pty - v[1], tot_yy - v[2]) for f, v in per.items()}
    expr = None
    for f, w in sorted(weights.items()):
        term = weighted_expr(pred_cols, w)
        expr = F.when(F.col(fold_col) == f, term) if expr is None else expr.when(F.col(fold_col) == f, term)
    return oof.withColumn(output_col, expr), weights
