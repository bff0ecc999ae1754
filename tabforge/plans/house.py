"""House-price preset: the reference workload's column roles and pipelines.

Two preprocessing variants:

* ``baseline``  group-median fill of LotFrontage by Neighborhood, derived
  columns, semantic/genuine(mode)/fallback null filling, ordinal codes,
  MSSubClass as a nominal code; then robust scaling + one-hot.
* ``final``     derived columns without the fill, semantic fills only, KNN
  imputation of the genuine columns, fallback fill, ordinal codes; then
  skew routing (Yeo-Johnson + robust / robust), target encoding of the
  high-cardinality nominals, one-hot of the rest, L1 feature selection.

The three switches of the published ablation (only normal sales, KNN
imputation, Yeo-Johnson) can be set one by one (``switch_scores``); the final
model is a RidgeCV stack of ridge, lasso and two boosted-tree pipelines
(``fit_stack``, scored by nested folds in ``stack_scores``).  As published, the
stack's preprocessor is fitted once on all its rows; everything else is fitted
on the training rows it is given (inside a CV fold when
called from ``cv_scores``), and every column list is presence-guarded.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tabforge.operators.clean import RoleImputer, drop_where, fallback_fill
from tabforge.operators.encode import OneHotEncoder, RobustScaler, TargetEncoder
from tabforge.operators.features import CastColumns, DerivedSpec, FeatureEngineer, OrdinalMapper
from tabforge.operators.knn import KNNImputer
from tabforge.operators.linear import L1Selector, Lasso, Ridge, RidgeCV
from tabforge.operators.pipelines import PipelineStacking, RegressionPipeline, nested_stack_scores
from tabforge.operators.power import SkewRouter
from tabforge.operators.trees import GBT, LGBM_REGULARISED, XGB_REGULARISED
from tabforge.operators.validate import assign_folds, fold_scores, oof_by_loop, score_summary
from tabforge.session import checkpoint_once

# ---------------------------------------------------------------- fixed values (column roles and code maps)

SEMANTIC_CAT = ["PoolQC", "MiscFeature", "Alley", "Fence", "FireplaceQu", "GarageType",
                "GarageFinish", "GarageQual", "GarageCond", "BsmtQual", "BsmtCond",
                "BsmtExposure", "BsmtFinType1", "BsmtFinType2", "MasVnrType"]
SEMANTIC_NUM = ["GarageArea", "GarageCars", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF",
                "TotalBsmtSF", "BsmtFullBath", "BsmtHalfBath", "MasVnrArea"]
GENUINE_CAT = ["MSZoning", "Electrical", "Exterior1st", "Exterior2nd", "KitchenQual", "Functional", "SaleType"]
GENUINE_NUM = ["LotFrontage"]
HIGH_CARD = ["Neighborhood", "Exterior1st", "Exterior2nd"]
DROPPED = ["Utilities"]

QUALITY_MAP = {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1, "None": 0}
EXPOSURE_MAP = {"Gd": 4, "Av": 3, "Mn": 2, "No": 1, "None": 0}
BSMT_FIN_MAP = {"GLQ": 6, "ALQ": 5, "BLQ": 4, "Rec": 3, "LwQ": 2, "Unf": 1, "None": 0}
SHAPE_MAP = {"Reg": 4, "IR1": 3, "IR2": 2, "IR3": 1}
SLOPE_MAP = {"Gtl": 3, "Mod": 2, "Sev": 1}
QUALITY_COLS = ["ExterQual", "ExterCond", "BsmtQual", "BsmtCond", "HeatingQC",
                "KitchenQual", "FireplaceQu", "GarageQual", "GarageCond", "PoolQC"]

ORDINAL_MAPS = {**{c: QUALITY_MAP for c in QUALITY_COLS},
                "BsmtExposure": EXPOSURE_MAP, "BsmtFinType1": BSMT_FIN_MAP, "BsmtFinType2": BSMT_FIN_MAP,
                "LotShape": SHAPE_MAP, "LandSlope": SLOPE_MAP}

HOUSE_DERIVED = DerivedSpec(
    sums={"TotalSF": [("TotalBsmtSF", 1.0), ("1stFlrSF", 1.0), ("2ndFlrSF", 1.0)],
          "TotalBathrooms": [("FullBath", 1.0), ("HalfBath", 0.5), ("BsmtFullBath", 1.0), ("BsmtHalfBath", 0.5)]},
    diffs={"HouseAge": ("YrSold", "YearBuilt"), "RemodAge": ("YrSold", "YearRemodAdd")},
    flags={"HasPool": "PoolArea", "Has2ndFloor": "2ndFlrSF", "HasGarage": "GarageArea",
           "HasBsmt": "TotalBsmtSF", "HasFireplace": "Fireplaces"},
)

OUTLIER_AREA, OUTLIER_PRICE = 4000, 300000


def outlier_rule(label: str = "SalePrice"):
    """Very large living area sold cheaply (rows with a null operand are kept by ``drop_where``)."""
    return (F.col("GrLivArea") > OUTLIER_AREA) & (F.col(label) < OUTLIER_PRICE)


@dataclass
class HouseConfig:
    variant: str = "final"            # "baseline" or "final"
    id_col: str = "Id"
    label: str = "SalePrice"
    knn_k: int = 5
    l1_alpha: float = 0.0005
    skew_threshold: float = 0.75
    # the three switches of the ablation; None: as the variant has it
    normal_only: bool = False         # only sales with SaleCondition "Normal"
    knn: bool | None = None           # KNN imputation of the genuine gaps, else the neighbourhood's median and modes
    yeo_johnson: bool | None = None   # skewed numbers through Yeo-Johnson, else plain robust scaling
    high_card: list[str] = field(default_factory=lambda: list(HIGH_CARD))


def prepare_labelled(train: DataFrame, cfg: HouseConfig) -> DataFrame:
    """Outlier rule (null operands kept), dropped columns, log1p label in ``label``."""
    out = drop_where(train, outlier_rule(cfg.label)) if {"GrLivArea", cfg.label} <= set(train.columns) else train
    if cfg.normal_only:
        out = out.where(F.col("SaleCondition") == "Normal")
    out = out.drop(*[c for c in DROPPED if c in out.columns])
    return out.withColumn("label", F.log1p(F.col(cfg.label).cast("double"))).drop(cfg.label)


class HousePreprocessor:
    """Cleaning + features + ordinal codes, fitted on training rows."""

    def __init__(self, cfg: HouseConfig):
        self.cfg = cfg

    def fit(self, df: DataFrame):
        cfg = self.cfg
        if not (cfg.variant != "baseline" if cfg.knn is None else cfg.knn):
            eng = FeatureEngineer(HOUSE_DERIVED, fill=("LotFrontage", "Neighborhood")).fit(df)
            x = eng.transform(df)
            imp = RoleImputer(SEMANTIC_CAT, SEMANTIC_NUM, GENUINE_CAT, fallback=True).fit(x)
            return _Fitted([eng, imp, OrdinalMapper(ORDINAL_MAPS), CastColumns(["MSSubClass"], "string")])
        eng = FeatureEngineer(HOUSE_DERIVED, fill=None).fit(df)
        x = eng.transform(df)
        sem = RoleImputer(SEMANTIC_CAT, SEMANTIC_NUM, fallback=False).fit(x)
        x = sem.transform(x)
        feats = [c for c in x.columns if c not in (cfg.id_col, "label", "fold")]
        targets = [c for c in GENUINE_CAT + GENUINE_NUM if c in x.columns]
        knn = KNNImputer(targets, feats, cfg.id_col, k=cfg.knn_k).fit(x) if targets else None
        stages = [eng, sem] + ([knn] if knn else []) + [_Fallback([cfg.id_col, "label", "fold"]),
                                                        OrdinalMapper(ORDINAL_MAPS), CastColumns(["MSSubClass"], "string")]
        return _Fitted(stages)


class _Fallback:
    def __init__(self, exclude):
        self.exclude = exclude

    def transform(self, df):
        return fallback_fill(df, exclude=self.exclude)


class _Fitted:
    def __init__(self, stages):
        self.stages = stages

    def transform(self, df: DataFrame) -> DataFrame:
        for s in self.stages:
            df = s.transform(df)
        return df


def split_roles(df: DataFrame, exclude: Sequence[str]) -> tuple[list[str], list[str]]:
    """(nominal, numeric) by type, as after preprocessing."""
    nom = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]
    return nom, num


class HouseModel:
    """Encoding + scaling (+ selection) + a linear regressor, fitted on preprocessed training rows."""

    def __init__(self, cfg: HouseConfig, regressor: str = "ridge", alpha: float | None = None):
        self.cfg, self.regressor, self.alpha = cfg, regressor, alpha

    def fit(self, df: DataFrame):
        cfg = self.cfg
        exclude = [cfg.id_col, "label", "fold"]
        nom, num = split_roles(df, exclude)
        stages = []
        x = df
        if cfg.variant == "baseline":
            sc = RobustScaler(num).fit(x)
            x = sc.transform(x)
            oh = OneHotEncoder(nom).fit(x)
            x = oh.transform(x)
            stages, feats = [sc, oh], num + oh.output_cols
        else:
            hi = [c for c in cfg.high_card if c in nom]
            lo = [c for c in nom if c not in hi]
            plain = cfg.yeo_johnson is False
            router = (RobustScaler(num) if plain else SkewRouter(num, cfg.skew_threshold)).fit(x)
            x = router.transform(x)
            te = TargetEncoder(hi, "label").fit(x)
            x = te.transform(x)
            oh = OneHotEncoder(lo).fit(x)
            x = oh.transform(x)
            feats = num + hi + oh.output_cols
            sel = L1Selector(feats, "label", cfg.l1_alpha).fit(x)
            stages, feats = [router, te, oh, sel], sel.kept
        if self.regressor == "lasso":
            est = Lasso(feats, "label", self.alpha if self.alpha is not None else 0.0005)
        else:
            est = Ridge(feats, "label", self.alpha if self.alpha is not None else 10.0)
        return _Fitted(stages + [est.fit(x)])


class HousePipeline:
    """Preprocessor + model as one estimator (fit on training rows only)."""

    def __init__(self, cfg: HouseConfig, regressor: str = "ridge", alpha: float | None = None):
        self.cfg, self.regressor, self.alpha = cfg, regressor, alpha

    def fit(self, df: DataFrame):
        pre = HousePreprocessor(self.cfg).fit(df)
        model = HouseModel(self.cfg, self.regressor, self.alpha).fit(pre.transform(df))
        return _Fitted([pre, model])


def cv_scores(train: DataFrame, cfg: HouseConfig, regressor: str = "ridge", k: int = 5, seed: int = 42) -> DataFrame:
    """Per-fold RMSE of the whole pipeline, every stage fitted inside the training fold."""
    data = assign_folds(prepare_labelled(train, cfg), cfg.id_col, k=k, seed=seed)
    oof = oof_by_loop(data, lambda: HousePipeline(cfg, regressor), out_col="oof")
    return fold_scores(oof, "label", "oof", model=f"{cfg.variant}_{regressor}")


def ablation(train: DataFrame, regressor: str = "ridge") -> DataFrame:
    """Score table of the baseline and final variants on the same rows."""
    a = cv_scores(train, HouseConfig(variant="baseline"), regressor)
    b = cv_scores(train, HouseConfig(variant="final"), regressor)
    return score_summary(a.unionByName(b))


def refit_and_score(train: DataFrame, test: DataFrame, cfg: HouseConfig, regressor: str = "ridge") -> DataFrame:
    """Fit on all labelled rows, score the unlabelled table, back-transform: (Id, SalePrice)."""
    model = HousePipeline(cfg, regressor).fit(prepare_labelled(train, cfg))
    scored = model.transform(test.drop(*[c for c in DROPPED if c in test.columns]))
    return scored.select(cfg.id_col, F.expm1("prediction").alias(cfg.label))


# ------------------------------------------------------------------ switches and the final stack

SWITCHES = ("normal_only", "knn", "yeo_johnson")


def switch_scores(train: DataFrame, regressor: str = "ridge", k: int = 5, switches: Sequence[str] = SWITCHES) -> DataFrame:
    """(model, fold, n, rmse) of the target-encoded pipeline with none of the three switches, each alone, and all."""
    arms = {"base": (), **{s: (s,) for s in switches}, "all": tuple(switches)}
    out = None
    for arm, on in arms.items():
        cfg = HouseConfig(variant="final", **{s: s in on for s in SWITCHES})
        scores = cv_scores(train, cfg, regressor, k).withColumn("model", F.lit(arm))
        out = scores if out is None else out.unionByName(scores)
    return out


def stack_makers(x: DataFrame, cfg: HouseConfig, trees: dict[str, dict] | None = None) -> dict:
    """Ridge, lasso and boosted-tree pipelines over a preprocessed table (the published regularised trees by default)."""
    nom, num = split_roles(x, [cfg.id_col, "label", "fold", "_inner"])
    hi = [c for c in cfg.high_card if c in nom]
    lo = [c for c in nom if c not in hi]
    trees = {"xgb": XGB_REGULARISED, "lgbm": LGBM_REGULARISED} if trees is None else trees
    skewed = cfg.yeo_johnson is not False

    def pipeline(make):
        return lambda: RegressionPipeline(make, "label", num, hi, lo, route_skew=skewed, l1_alpha=cfg.l1_alpha, scale=not skewed)

    makers = {"ridge": pipeline(lambda f: Ridge(f, "label", 10.0)), "lasso": pipeline(lambda f: Lasso(f, "label", 0.0005))}
    return makers | {n: pipeline(lambda f, p=p: GBT(f, "label", p, id_col=cfg.id_col)) for n, p in trees.items()}


def _meta(cols: list[str]) -> RidgeCV:
    return RidgeCV(cols, "label", [0.1, 1.0, 10.0, 100.0])


def preprocessed(train: DataFrame, cfg: HouseConfig, k: int = 5) -> tuple[DataFrame, object]:
    """(labelled rows after the preprocessor fitted on all of them, with folds; the fitted preprocessor)."""
    rows = prepare_labelled(train, cfg)
    pre = HousePreprocessor(cfg).fit(rows)
    return checkpoint_once(assign_folds(pre.transform(rows), cfg.id_col, k=k)), pre


def fit_stack(train: DataFrame, cfg: HouseConfig, trees: dict[str, dict] | None = None, k: int = 5):
    """The final model: RidgeCV over the out-of-fold predictions of the pipelines, each refitted on all rows."""
    x, pre = preprocessed(train, cfg, k)
    return _Fitted([pre, PipelineStacking(stack_makers(x, cfg, trees), _meta, cfg.id_col).fit(x)])


def stack_scores(train: DataFrame, cfg: HouseConfig, trees: dict[str, dict] | None = None, k: int = 5) -> DataFrame:
    """(model, fold, n, rmse) of the whole stack, k x (k + 1) fits of every pipeline."""
    x, _ = preprocessed(train, cfg, k)
    return nested_stack_scores(x, stack_makers(x, cfg, trees), _meta, cfg.id_col, "label", k=k)
