"""Whole regression pipelines as one estimator, so that every stage is refitted inside each fold.

Stages in order: skew routing (or plain scaling) of the numeric columns, smoothed target means,
one-hot columns, L1 selection, then any estimator over the kept features.  The
stages work on copies of the input columns, so ``transform`` gives back the
input with one prediction column and several pipelines can stand side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators.base import ColumnEstimator, ColumnModel
from tabforge.operators.encode import OneHotEncoder, RobustScaler, TargetEncoder
from tabforge.operators.ensemble import ModelEnsembleModel, Stacking, StackingModel
from tabforge.operators.linear import Gram, L1Selector, Ridge
from tabforge.operators.power import SkewRouter
from tabforge.operators.validate import assign_folds, fold_scores, oof_by_loop, oofs_by_loop, run_parallel


def _work(col: str) -> str:
    return f"_w_{col}"


class RegressionPipeline(ColumnEstimator):
    """``make(features)`` builds the estimator over the features that the stages leave.

    ``route_skew`` sends skewed numbers through Yeo-Johnson before they are scaled, ``scale`` only scales them.
    """

    def __init__(self, make: Callable[[list[str]], object], label: str, numeric: Sequence[str], target_encoded: Sequence[str] = (),
                 one_hot: Sequence[str] = (), route_skew: bool = True, l1_alpha: float | None = None, prediction_col: str = "prediction",
                 scale: bool = False):
        super().__init__()
        self.scale = scale
        self.make, self.label, self.prediction_col = make, label, prediction_col
        self.numeric, self.target_encoded, self.one_hot = list(numeric), list(target_encoded), list(one_hot)
        self.route_skew, self.l1_alpha = route_skew, l1_alpha

    def front_key(self) -> tuple:
        """Pipelines with equal keys have the same stages before their estimators."""
        return (self.label, tuple(self.numeric), tuple(self.target_encoded), tuple(self.one_hot), self.route_skew, self.l1_alpha, self.scale)

    def fit_front(self, dataset: DataFrame) -> tuple[list, list[str], Gram | None]:
        """(fitted stages, features they leave, sums of these features when the selection scanned every row for them)."""
        data = dataset.withColumns({_work(c): F.col(c) for c in self.numeric + self.target_encoded + self.one_hot})
        stages = []

        def add(estimator):
            nonlocal data
            model = estimator.fit(data)
            data = model.transform(data)
            stages.append(model)
            return model

        features = [_work(c) for c in self.numeric + self.target_encoded]
        if self.route_skew and self.numeric:
            add(SkewRouter([_work(c) for c in self.numeric]))
        elif self.scale and self.numeric:
            add(RobustScaler([_work(c) for c in self.numeric]))
        if self.target_encoded:
            add(TargetEncoder([_work(c) for c in self.target_encoded], self.label))
        if self.one_hot:
            features += add(OneHotEncoder([_work(c) for c in self.one_hot])).output_cols
        gram = None
        if self.l1_alpha is not None:
            selector = L1Selector(features, self.label, self.l1_alpha)
            kept = selector._fit(data).kept
            if selector.gram_.n == dataset.count():   # a row with a null counts again once the feature that lacks it is gone
                gram = selector.gram_.take([features.index(f) for f in kept])
            features = kept
        return stages, features, gram

    def fit_behind(self, dataset: DataFrame, front: tuple[list, list[str], Gram | None]) -> RegressionPipelineModel:
        """The estimator fitted behind the stages of ``fit_front``; a linear one from the sums of the selection's scan."""
        stages, features, gram = front
        inputs = self.numeric + self.target_encoded + self.one_hot
        data = dataset.withColumns({_work(c): F.col(c) for c in inputs})
        for stage in stages:
            data = stage.transform(data)
        estimator = self.make(features)
        if gram is not None and isinstance(estimator, Ridge) and type(estimator)._fit is Ridge._fit and (
                list(estimator.features), estimator.label) == (features, self.label):
            model = estimator.fit_gram(gram)
        else:
            model = estimator.fit(data)
        return RegressionPipelineModel(inputs, stages, model, getattr(estimator, "prediction_col", "prediction"),
                                       self.prediction_col)

    def _fit(self, dataset: DataFrame) -> RegressionPipelineModel:
        return self.fit_behind(dataset, self.fit_front(dataset))


class RegressionPipelineModel(ColumnModel):
    def __init__(self, inputs, stages, model, model_col, prediction_col):
        super().__init__()
        self.inputs, self.stages, self.model = inputs, stages, model
        self.model_col, self.prediction_col = model_col, prediction_col

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset.withColumns({_work(c): F.col(c) for c in self.inputs})
        for stage in self.stages:
            out = stage.transform(out)
        return self.model.transform(out).select(*dataset.columns, F.col(self.model_col).alias(self.prediction_col))


def fit_pipelines(makers: dict[str, Callable[[], object]], dataset: DataFrame, parallelism: int = 4) -> dict[str, object]:
    """Fitted models by name; stages that several pipelines have in common are fitted once."""
    estimators = {name: make() for name, make in makers.items()}
    fronts = {e.front_key(): e for e in estimators.values() if isinstance(e, RegressionPipeline)}
    fitted = dict(zip(fronts, run_parallel(lambda e: e.fit_front(dataset), list(fronts.values()), parallelism)))

    def fit(e):
        return e.fit_behind(dataset, fitted[e.front_key()]) if isinstance(e, RegressionPipeline) else e.fit(dataset)

    return dict(zip(estimators, run_parallel(fit, list(estimators.values()), parallelism)))


class PipelineStacking(Stacking):
    """Stacking whose out-of-fold columns refit each whole pipeline per fold."""

    def __init__(self, makers: dict[str, Callable[[], object]], meta_maker, id_col: str, fold_col: str = "fold",
                 output_col: str = "prediction"):
        super().__init__(makers, meta_maker, None, id_col, output_col, fold_col)

    def _fit(self, dataset: DataFrame) -> StackingModel:
        self.oof_ = oofs_by_loop(dataset, self.makers, self.fold_col, fit_all=fit_pipelines)
        meta = self.meta_maker([f"p_{n}" for n in self.makers]).fit(self.oof_)
        return StackingModel(ModelEnsembleModel(fit_pipelines(self.makers, dataset), None, "prediction"), meta, self.output_col)


def nested_stack_scores(df: DataFrame, makers: dict[str, Callable[[], object]], meta_maker, id_col: str, label: str,
                        fold_col: str = "fold", k: int = 5, seed: int = 43, model: str = "stack") -> DataFrame:
    """(model, fold, n, rmse) of the whole stack: per outer fold it is fitted anew, with ``k`` inner folds, on the other rows."""
    inner = "_inner"

    def make():
        return PipelineStacking(makers, meta_maker, id_col, inner)

    # another hash than the outer folds': the same one with another seed would only shift them
    folded = assign_folds(df, id_col, k=k, seed=seed, method="xxhash", fold_col=inner)
    return fold_scores(oof_by_loop(folded, make, fold_col=fold_col, parallelism=2), label, "oof", fold_col, model)


def switch_ablation(df: DataFrame, switches: dict[str, Callable], make: Callable[[dict], object], label: str, fold_col: str = "fold",
                    arms: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """(model, fold, n, rmse) of one pipeline under several settings of its switches.

    ``switches``: {name: change} where a change is a function of the rows that
    is applied before the folds are fitted (a row filter, an imputation), or
    None for a switch that only ``make`` reads; ``make({name: on})`` builds the
    estimator.  By default every switch is tried alone, none and all of them.
    """
    arms = arms if arms is not None else {"base": [], **{s: [s] for s in switches}, "all": list(switches)}
    out = None
    for arm, on in arms.items():
        rows = df
        for name, change in switches.items():
            if name in on and change is not None:
                rows = change(rows)
        state = {name: name in on for name in switches}
        oof = oof_by_loop(rows, lambda state=state: make(state), fold_col=fold_col, out_col="oof")
        part = fold_scores(oof, label, "oof", fold_col, arm)
        out = part if out is None else out.unionByName(part)
    return out
