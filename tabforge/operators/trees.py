"""Gradient-boosted trees on Spark ML, configured from boosting-library style parameters.

Parameter map: n_estimators -> maxIter, learning_rate -> stepSize, max_depth ->
maxDepth, num_leaves -> maxDepth (the depth of a tree with so many leaves),
min_child_weight / min_child_samples -> minInstancesPerNode, subsample ->
subsamplingRate, colsample_bytree -> featureSubsetStrategy (per node in Spark).
L1/L2 leaf penalties have no Spark counterpart: they warn.  Any other name is
an error, so two configurations that differ are never silently one model.

Rows are repartitioned by id before fitting, into a number of partitions that
follows from the row count alone, so a model depends on the data and not on
the cluster.  With ``choose_trees`` the tree count is chosen from the data: a
tenth of the rows, by a hash of the id, is held out; fits of 64, 128, 256 ...
trees (up to the count of the parameters) are scored on it tree by tree, until
the best count lies in the first three quarters of a fit; then all rows are
fitted with the best count.  A fit is a prefix of a longer one, so this costs
less than two fits of the longest.  With ``early_stopping`` a tenth of the rows, chosen by a hash of
the id, is held out and ends the run at the first tree that does not lower its
error by ``tolerance``; the tree count of the parameters is then an upper
limit.  Spark has no patience: with row subsampling and a low rate that is
often after a few trees, so it is off by default.
"""

from __future__ import annotations

import math
import random
import threading
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.operators import cells
from tabforge.operators.base import ColumnEstimator, ColumnModel
from tabforge.operators.validate import run_parallel

# The published boosting configurations, in the order of the work.
XGB_BASELINE = {"n_estimators": 1000, "learning_rate": 0.05, "max_depth": 3, "subsample": 0.8, "colsample_bytree": 0.8}
LGBM_BASELINE = {"n_estimators": 100, "learning_rate": 0.1, "num_leaves": 31, "min_child_samples": 20}
XGB_TUNED = {"n_estimators": 1265, "learning_rate": 0.012224530398883712, "max_depth": 4, "min_child_weight": 2,
             "subsample": 0.5126036971322886, "colsample_bytree": 0.6504339622089299,
             "reg_alpha": 0.0007209346542902345, "reg_lambda": 1.3179752639844382}
LGBM_TUNED = {"n_estimators": 627, "learning_rate": 0.030249869382265312, "num_leaves": 62, "max_depth": 4,
              "min_child_samples": 13, "subsample": 0.8995420401385048, "colsample_bytree": 0.508509313237107,
              "reg_alpha": 2.0828413754238578e-05, "reg_lambda": 0.3670500310606078}
XGB_REGULARISED = {"n_estimators": 1000, "learning_rate": 0.015, "max_depth": 3, "min_child_weight": 10, "subsample": 0.6,
                   "colsample_bytree": 0.6, "reg_lambda": 10.0}
LGBM_REGULARISED = {"n_estimators": 1000, "learning_rate": 0.015, "max_depth": 3, "min_child_samples": 30, "subsample": 0.6,
                    "colsample_bytree": 0.6, "reg_lambda": 10.0}
CONFIGURATIONS = {"xgb_baseline": XGB_BASELINE, "lgbm_baseline": LGBM_BASELINE, "xgb_tuned": XGB_TUNED,
                  "lgbm_tuned": LGBM_TUNED, "xgb_regularised": XGB_REGULARISED, "lgbm_regularised": LGBM_REGULARISED}

_UNMAPPED = ("reg_alpha", "reg_lambda")
_KNOWN = ("n_estimators", "learning_rate", "max_depth", "num_leaves", "min_child_weight", "min_child_samples",
          "subsample", "colsample_bytree", *_UNMAPPED)
# A tree is a job per level, and every task of it costs a fixed time and a result on the driver: few, larger tasks.
ROWS_PER_PARTITION = 200_000
# From so many trees on, fits may go by coded rows (``cells``): coding costs some ten jobs, Spark's own fit a job per level of a tree.
CODED_FROM = 64


def gbt_params(params: dict) -> dict:
    """Spark ML parameters of a configuration."""
    unknown = sorted(set(params) - set(_KNOWN))
    if unknown:
        raise ValueError(f"no counterpart for the parameters {unknown}")
    lost = [p for p in _UNMAPPED if params.get(p)]
    if lost:
        warnings.warn(f"Spark's trees have no leaf penalties: {lost} change nothing", stacklevel=2)
    out = {}
    if "n_estimators" in params:
        out["maxIter"] = int(params["n_estimators"])
    if "learning_rate" in params:
        out["stepSize"] = float(params["learning_rate"])
    depths = [int(params["max_depth"])] if "max_depth" in params else []
    if "num_leaves" in params:
        depths.append(max(1, math.ceil(math.log2(params["num_leaves"]))))
    if depths:
        out["maxDepth"] = min(depths)
    mcw = params.get("min_child_weight", params.get("min_child_samples"))
    if mcw is not None:
        out["minInstancesPerNode"] = max(1, int(round(mcw)))
    if "subsample" in params:
        out["subsamplingRate"] = float(params["subsample"])
    if "colsample_bytree" in params:
        out["featureSubsetStrategy"] = str(float(params["colsample_bytree"]))
    return out


class GBT(ColumnEstimator):
    also_params = ("gbt_params",)  # the constructor's ``params``; ``n_estimators`` goes before its entry

    def __init__(self, features: Sequence[str], label: str = "label", params: dict | None = None,
                 n_estimators: int | None = None, id_col: str | None = None, num_partitions: int | None = None,
                 prediction_col: str = "prediction", seed: int = 42, early_stopping: bool = False, tolerance: float = 0.01,
                 choose_trees: bool = False, first_trees: int = 64, coded: bool | None = None):
        super().__init__()
        self.features, self.label, self.id_col = list(features), label, id_col
        self.gbt_params, self.n_estimators = dict(params or {}), n_estimators
        self.num_partitions, self.prediction_col, self.seed = num_partitions, prediction_col, seed
        self.early_stopping, self.tolerance = early_stopping, tolerance
        self.choose_trees, self.first_trees = choose_trees, first_trees
        self.coded = coded   # fit by coded rows (``cells``); by default over more than one partition
        if (early_stopping or choose_trees) and not id_col:
            raise ValueError("early stopping and the choice of a tree count split rows by a hash of id_col")

    def booster(self, n_trees: int | None = None, **extra) -> GBTRegressor:
        """Spark's estimator for the column ``_features``.

        Without node ids kept between levels: for trees so shallow, walking down from the root costs less than a stored table a level.
        """
        n_trees = self.n_estimators if n_trees is None else n_trees
        chosen = self.gbt_params | ({} if n_trees is None else {"n_estimators": n_trees})
        return GBTRegressor(featuresCol="_features", labelCol=self.label, predictionCol=self.prediction_col, seed=self.seed, maxBins=64,
                            cacheNodeIds=False, checkpointInterval=10, **gbt_params(chosen), **extra)

    def _held(self):
        return F.pmod(F.xxhash64(F.col(self.id_col), F.lit(self.seed)), F.lit(10)) == 0

    def _limit(self) -> int:
        return self.n_estimators or int(self.gbt_params.get("n_estimators", 20))

    def _fit(self, dataset: DataFrame) -> GBTModelWrapper:
        asm, data, n = prepared(dataset, self.features, [self.label], self.id_col, self.num_partitions)
        if self.id_col and not self.early_stopping and self._limit() >= CODED_FROM and (n > 1 if self.coded is None else self.coded):
            data = data.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                fitted = self._coded_fit(data)
                if fitted is not None:
                    return GBTModelWrapper(asm, None, self.prediction_col, self.features, n, fitted[1], fitted[0])
            finally:
                data.unpersist()
        extra, errors, n_trees = {}, [], None
        if self.early_stopping:
            data = data.withColumn("_held", self._held())
            extra = {"validationIndicatorCol": "_held", "validationTol": self.tolerance}
        if self.choose_trees:
            data = data.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self.choose_trees:
                errors = self._staged(data)
                n_trees = 1 + min(range(len(errors)), key=lambda i: (errors[i], i)) if errors else None
            return GBTModelWrapper(asm, self.booster(n_trees, **extra).fit(data), self.prediction_col, self.features, n, errors)
        finally:
            if self.choose_trees:
                data.unpersist()

    def _coded_fit(self, data: DataFrame) -> tuple | None:
        """(trees, errors on the held rows) from coded rows (``cells``); None where they do not apply."""
        spark, errors, n_trees = data.sparkSession, [], None
        if self.choose_trees:
            held, rest = data.where(self._held()), data.where(~self._held())
            if not (held.isEmpty() or rest.isEmpty()):
                rows = cells.coded(data, self.features, self.label, self.booster(), ~self._held())
                if rows is None:
                    return None
                how = cells.settings(self.booster(), len(self.features)) | {"trees": self._limit(), "first": min(self._limit(), self.first_trees)}
                errors = cells.run_fits(spark, [(rows, how)], cells.staged_errors)[0]
                rows.unpersist()
                n_trees = 1 + errors.index(min(errors))
        booster = self.booster(n_trees)
        rows = cells.coded(data, self.features, self.label, booster)
        if rows is None:
            return None
        grown = cells.run_fits(spark, [(rows, cells.settings(booster, len(self.features)))], cells.trees)[0]
        rows.unpersist()
        return cells.CodedTrees(grown, rows.thresholds, self.features, booster), errors

    def _staged(self, data: DataFrame) -> list[float]:
        """Mean squared error on the held rows after every tree of the longest fit; empty when either part has no row."""
        held, rest = data.where(self._held()), data.where(~self._held())
        if held.isEmpty() or rest.isEmpty():
            return []
        limit = self._limit()
        n = min(limit, self.first_trees)
        while True:
            errors = self.booster(n).fit(rest).evaluateEachIteration(held, "squared")
            if n == limit or errors.index(min(errors)) + 1 <= 0.75 * n:
                return list(errors)
            n = min(limit, 2 * n)


def prepared(dataset: DataFrame, features: Sequence[str], others: Sequence[str], id_col: str | None,
             num_partitions: int | None = None) -> tuple[VectorAssembler, DataFrame, int | None]:
    """(assembler, rows with ``_features``, partitions): spread and sorted by id, so that fits depend on the data alone."""
    asm = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    data = asm.transform(dataset.select(*([id_col] if id_col else []), *features, *others))
    if not id_col:
        return asm, data, None
    n = num_partitions or max(1, -(-dataset.count() // ROWS_PER_PARTITION))
    return asm, data.repartition(n, id_col).sortWithinPartitions(id_col), n


class FoldTrainer:
    """Tree models of many configurations on the same folds: rows are assembled, spread and sorted once, and kept.

    A fold's training rows are a filter of the kept table, so no fit shuffles.
    Use it in a ``with`` block; the table is released at its end.
    """

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, id_col: str, fold_col: str = "fold"):
        self.features, self.label, self.id_col, self.fold_col = list(features), label, id_col, fold_col
        _, data, self.num_partitions = prepared(df, self.features, [label, fold_col], id_col)
        self.data = data.persist(StorageLevel.MEMORY_AND_DISK)
        self.folds = sorted(r[0] for r in self.data.select(fold_col).distinct().collect())
        self._rows: dict | None = None
        self._lock = threading.Lock()

    def __enter__(self) -> FoldTrainer:
        return self

    def __exit__(self, *exc) -> None:
        self.data.unpersist()
        for rows in (self._rows or {}).values():
            if rows is not None:
                rows.unpersist()

    def _coded(self) -> dict:
        """{fold: the rows coded for the fits without it, or None where coding does not apply}: once for all fits."""
        with self._lock:
            if self._rows is None:
                booster = GBT(self.features, self.label, {}, id_col=self.id_col).booster()
                self._rows = {k: cells.coded(self.data, self.features, self.label, booster, F.col(self.fold_col) != k) for k in self.folds}
        return self._rows

    def fit(self, params: dict, fold: int, n_trees: int | None = None):
        """(model, its test rows) with ``fold`` left out."""
        gbt = GBT(self.features, self.label, params, n_trees, self.id_col)
        return gbt.booster().fit(self.data.where(F.col(self.fold_col) != fold)), self.data.where(F.col(self.fold_col) == fold)

    def scores(self, params: dict, n_trees: int | None = None) -> list[float]:
        """RMSE on every fold."""
        params = dict(params) if n_trees is None else params | {"n_estimators": n_trees}
        if int(params.get("n_estimators", 20)) >= CODED_FROM:
            rows = self._coded()
            if all(r is not None for r in rows.values()):
                how = cells.settings(GBT(self.features, self.label, params, id_col=self.id_col).booster(), len(self.features))
                return cells.run_fits(self.data.sparkSession, [(rows[k], how) for k in self.folds], cells.held_rmse)

        def rmse(fold: int) -> float:
            model, test = self.fit(params, fold, n_trees)
            return model.transform(test).agg(F.sqrt(F.avg(F.pow(F.col(self.label) - F.col("prediction"), 2)))).first()[0]
        return [rmse(k) for k in self.folds]


class GBTModelWrapper(ColumnModel):
    def __init__(self, asm, model, prediction_col, features, num_partitions=None, errors=(), coded=None):
        super().__init__()
        self.errors = list(errors)   # of choose_trees: on the held rows, after every tree
        self.asm, self.prediction_col, self.features = asm, prediction_col, features
        self.num_partitions = num_partitions
        self._model, self.coded = model, coded   # one of the two; the other way round Spark's model is built when asked for

    @property
    def model(self):
        if self._model is None:
            self._model = self.coded.model(SparkSession.active())
        return self._model

    @model.setter
    def model(self, model) -> None:   # models saved under this name
        self._model = model

    @property
    def n_trees(self) -> int:
        coded = vars(self).get("coded")
        return len(coded.trees) if coded else self.model.getNumTrees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        coded = vars(self).get("coded")
        if coded:
            return dataset.withColumn(self.prediction_col, coded.predicted(dataset.sparkSession))
        return self.model.transform(self.asm.transform(dataset)).drop("_features")

    def importances(self, spark) -> DataFrame:
        imp = self.model.featureImportances.toArray().tolist()
        return spark.createDataFrame(list(zip(self.features, imp)), "feature string, importance double")


def sample_space(space: dict, n_trials: int, seed: int = 42) -> list[dict]:
    """Seeded random draws from {name: (low, high, kind)}; kind in int, float, log."""
    rng = random.Random(seed)
    trials = []
    for _ in range(n_trials):
        t = {}
        for name, (lo, hi, kind) in space.items():
            if kind == "int":
                t[name] = rng.randint(int(lo), int(hi))
            elif kind == "log":
                t[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                t[name] = rng.uniform(lo, hi)
        trials.append(t)
    return trials


# The published search space, (low, high, kind).
XGB_SPACE = {"n_estimators": (100, 2000, "int"), "learning_rate": (0.01, 0.2, "log"), "max_depth": (2, 8, "int"),
             "min_child_weight": (1, 10, "int"), "subsample": (0.5, 1.0, "float"), "colsample_bytree": (0.5, 1.0, "float"),
             "reg_alpha": (1e-8, 1.0, "log"), "reg_lambda": (1e-8, 10.0, "log")}


@dataclass
class RandomSearch:
    """Seeded random search: ``n_trials`` draws from ``space``, each scored by ``objective(params) -> float`` (lower is better).

    Trials run from ``parallelism`` driver threads and submit their own Spark
    jobs.  ``run`` returns the trial table (trial, the parameters, score, best);
    ``best_params`` and ``best_score`` are set.  The first of equal scores wins.
    """

    space: dict
    objective: Callable[[dict], float]
    n_trials: int = 20
    seed: int = 42
    parallelism: int = 4
    best_params: dict | None = None
    best_score: float | None = None

    def run(self, spark: SparkSession) -> DataFrame:
        trials = sample_space(self.space, self.n_trials, self.seed)
        scores = [float(x) for x in run_parallel(self.objective, trials, self.parallelism)]
        best = min(range(len(trials)), key=lambda i: (scores[i], i))
        self.best_params, self.best_score = trials[best], scores[best]
        kinds = ", ".join(f"{n} {'int' if kind == 'int' else 'double'}" for n, (_, _, kind) in self.space.items())
        rows = [(i, *t.values(), s, i == best) for i, (t, s) in enumerate(zip(trials, scores))]
        return spark.createDataFrame(rows, f"trial int, {kinds}, score double, best boolean")
