"""Folds, cross-validation, out-of-fold predictions and score tables.

Linear models take the Gram route: one scan gives per-fold sums, every
leave-fold-out model is (total - fold), and all out-of-fold predictions are
one ``CASE fold`` column expression.  Any other estimator (trees, pipelines
with encoders fitted inside the fold) goes through a fold loop: fit on
``fold != k``, transform ``fold == k``, union.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.exprs import modmul_hash
from tabforge.operators.linear import Gram, Ridge, gram_sums, linear_expr
from tabforge.session import checkpoint_once


def assign_folds(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, method: str = "modmul",
                 fold_col: str = "fold") -> DataFrame:
    """Shuffled k-fold assignment as a pure function of the row id (no global order).

    ``modmul`` is reproducible in any SQL engine; ``xxhash`` uses Spark's xxhash64.
    """
    if method == "xxhash":
        f = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(k))
    else:
        f = F.pmod(modmul_hash(id_col, seed), F.lit(k))
    return df.withColumn(fold_col, f.cast("int"))


def fold_scores(oof: DataFrame, label: str, pred: str, fold_col: str = "fold", model: str = "model") -> DataFrame:
    """(model, fold, n, rmse) per fold."""
    return oof.groupBy(fold_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(F.pow(F.col(label) - F.col(pred), 2))).alias("rmse")).select(
        F.lit(model).alias("model"), F.col(fold_col).alias("fold"), "n", "rmse")


def score_summary(scores: DataFrame) -> DataFrame:
    """(model, mean_rmse, std_rmse): folds weighted equally, population std (numpy ``std``)."""
    return scores.groupBy("model").agg(F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse"),
                                       F.count(F.lit(1)).alias("n_folds"))


def pooled_rmse(oof: DataFrame, label: str, pred: Column | str) -> float:
    p = F.col(pred) if isinstance(pred, str) else pred
    return oof.agg(F.sqrt(F.avg(F.pow(F.col(label) - p, 2)))).first()[0]


class LinearCV:
    """K-fold CV of a linear estimator (Ridge / Lasso / subclasses) from one Gram scan."""

    def __init__(self, estimator: Ridge, fold_col: str = "fold"):
        self.estimator, self.fold_col = estimator, fold_col
        self.fold_models: dict[int, tuple[float, list]] = {}

    def fit(self, df: DataFrame) -> LinearCV:
        return self.fit_grams(gram_sums(df, self.estimator.features, self.estimator.label, self.fold_col))

    def fit_grams(self, grams: dict[int, Gram]) -> LinearCV:
        est = self.estimator
        tot = None
        for g in grams.values():
            tot = g if tot is None else tot + g
        self.fold_models = {k: est.solve(tot - g) for k, g in grams.items()}
        self.full_model = est.solve(tot)
        return self

    def oof_expr(self) -> Column:
        e = None
        for k, (b0, beta) in sorted(self.fold_models.items()):
            term = linear_expr(self.estimator.features, b0, beta)
            e = F.when(F.col(self.fold_col) == k, term) if e is None else e.when(F.col(self.fold_col) == k, term)
        return e

    def oof(self, df: DataFrame, pred_col: str = "oof") -> DataFrame:
        return df.withColumn(pred_col, self.oof_expr())


def fit_linear_cvs(df: DataFrame, estimators: dict[str, Ridge], fold_col: str = "fold") -> dict[str, LinearCV]:
    """{name: LinearCV} for several linear models of one label from one Gram scan over the union of their features.

    Each model's sums are a cut of the union's.  A row that lacks one feature
    would drop out of every model, so models are scanned on their own when a
    feature of theirs has nulls (counted first, in the same pass as the label).
    """
    label = next(iter(estimators.values())).label
    union = list(dict.fromkeys(f for e in estimators.values() for f in e.features))
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{k}") for k, c in enumerate(union)]).first()
    if any(nulls):
        return {n: LinearCV(e, fold_col).fit(df) for n, e in estimators.items()}
    grams = gram_sums(df, union, label, fold_col)
    return {n: LinearCV(e, fold_col).fit_grams({k: g.take([union.index(f) for f in e.features]) for k, g in grams.items()})
            for n, e in estimators.items()}


def with_oofs(df: DataFrame, estimators: dict[str, Ridge], fold_col: str = "fold") -> DataFrame:
    """``df`` with one out-of-fold column per model, named as its key."""
    return df.withColumns({n: cv.oof_expr() for n, cv in fit_linear_cvs(df, estimators, fold_col).items()})


def oof_by_loop(df: DataFrame, make_estimator: Callable[[], object], fold_col: str = "fold",
                pred_col: str = "prediction", out_col: str = "oof", folds: Sequence[int] | None = None,
                parallelism: int = 5, persist: bool = True) -> DataFrame:
    """Out-of-fold predictions for any estimator: a fresh copy is fitted per fold.

    The input is persisted once for the k fits (each reads it several times);
    callers that run several loops over one table side by side persist it
    themselves (``kept``) and pass ``persist=False``.  Fold fits are submitted from ``parallelism`` driver threads (Spark runs the
    jobs concurrently, like ``CrossValidator(parallelism=...)``), and the OOF
    table is checkpointed once so the persisted input can be released.
    """
    data = df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df
    try:
        if folds is None:
            folds = sorted(r[0] for r in data.select(fold_col).distinct().collect())

        def one(k):
            model = make_estimator().fit(data.where(F.col(fold_col) != k))
            return model.transform(data.where(F.col(fold_col) == k)).withColumnRenamed(pred_col, out_col)

        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(folds)))) as pool:
            parts = list(pool.map(one, folds))
        # fold models may add or drop different feature columns; keep the ones every fold has
        common = [c for c in parts[0].columns if all(c in p.columns for p in parts[1:])]
        out = parts[0].select(*common)
        for p in parts[1:]:
            out = out.unionByName(p.select(*common))
        return checkpoint_once(out)
    finally:
        if persist:
            data.unpersist()


@contextmanager
def kept(df: DataFrame):
    """``df`` persisted for the length of a ``with`` block."""
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist()


def oofs_by_loop(df: DataFrame, makers: dict[str, Callable[[], object]], fold_col: str = "fold", pred_col: str = "prediction",
                 parallelism: int = 10, fit_all: Callable[[dict, DataFrame], dict] | None = None) -> DataFrame:
    """``df`` with an out-of-fold column ``p_<name>`` per model; every (model, fold) fit runs side by side.

    Models must give back their input columns and one prediction column.
    ``fit_all(makers, training rows)`` fits all models of a fold together, so that they can share work.
    """
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        folds = sorted(r[0] for r in data.select(fold_col).distinct().collect())
        if fit_all is not None:
            fitted = run_parallel(lambda k: fit_all(makers, data.where(F.col(fold_col) != k)), folds, parallelism)
            models = {(n, k): m for k, per_fold in zip(folds, fitted) for n, m in per_fold.items()}
        else:
            tasks = [(n, k) for k in folds for n in makers]
            models = dict(zip(tasks, run_parallel(lambda t: makers[t[0]]().fit(data.where(F.col(fold_col) != t[1])), tasks, parallelism)))
        out = None
        for k in folds:
            part = data.where(F.col(fold_col) == k)
            for n in makers:
                part = models[n, k].transform(part).withColumnRenamed(pred_col, f"p_{n}")
            out = part if out is None else out.unionByName(part)
        return checkpoint_once(out)
    finally:
        data.unpersist()


def run_parallel(fn: Callable, items: Sequence, parallelism: int = 4) -> list:
    """Evaluate independent configurations concurrently (each submits its own Spark jobs)."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(items)))) as pool:
        return list(pool.map(fn, items))
