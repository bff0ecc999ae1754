"""Query catalogue: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the given tables (through the standard frames of
``tabforge.sources.frames``) and runs over them whole.  Floats are rounded in
the output only, so that the DuckDB oracle can be compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.exprs import log1p, round_half_even
from tabforge.functions.quantiles import exact_quantiles
from tabforge.operators import audit
from tabforge.operators.clean import GroupMedianImputer, ModeImputer, RoleImputer, drop_where
from tabforge.operators.features import CastColumns, DerivedColumns, DerivedSpec, OrdinalMapper
from tabforge.session import checkpoint_once, scratch_dir
from tabforge.sources import io
from tabforge.sources.frames import L_NUMERIC, frame_c, frame_l, frame_p, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(c if not isinstance(c, str) else F.col(c), 6)


# ---------------------------------------------------------------- scans and sinks

P_SCHEMA = "id BIGINT, nbhd STRING, front DOUBLE, semcat STRING, gencat STRING, size INT, y DOUBLE"


@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    io.write_csv_table(frame_p(spark, sf_dir), path)
    return io.read_csv_table(spark, path, schema=P_SCHEMA)


@query("json_report")
def json_report(spark, sf_dir):
    p = frame_p(spark, sf_dir)
    path = scratch_dir(spark, "json")
    io.write_json_report(audit.missing_report(p, only_missing=False), path)
    return io.read_json_report(spark, path, "column STRING, pct_missing DOUBLE").select("column", r6("pct_missing").alias("pct_missing"))


@query("preview_head")
def preview_head(spark, sf_dir):
    return io.preview(frame_p(spark, sf_dir), "id", 5)


@query("shape_report")
def shape_report(spark, sf_dir):
    return io.shape_report(frame_p(spark, sf_dir), "P")


# ---------------------------------------------------------------- filters and projections

@query("outlier_filter")
def outlier_filter(spark, sf_dir):
    p = frame_p(spark, sf_dir)
    return drop_where(p, (F.col("front") > 45) & (F.col("y") < 950)).select("id", "front", "y")


@query("predicate_count")
def predicate_count(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return audit.predicate_count(li, (F.col("l_quantity") > 40) & (F.col("l_discount") < 0.03), "n_rows")


@query("eq_filter_drop")
def eq_filter_drop(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderstatus") == "F").drop("o_orderdate", "o_orderpriority")


@query("select_by_type")
def select_by_type(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    high_card = ["p_name"]
    nominal = [c for c in audit.string_columns(part) if c not in high_card]
    return part.select("p_partkey", *nominal)


@query("cast_code")
def cast_code(spark, sf_dir):
    p = frame_p(spark, sf_dir).select("id", F.col("size").alias("size_code"))
    return CastColumns(["size_code", "absent_column"], "string").transform(p)


# ---------------------------------------------------------------- cleaning

@query("group_median_fill")
def group_median_fill(spark, sf_dir):
    p = frame_p(spark, sf_dir)
    model = GroupMedianImputer("front", "nbhd").fit(p)
    return model.transform(p).select("id", "nbhd", r6("front").alias("front"))


@query("mode_fill")
def mode_fill(spark, sf_dir):
    p = frame_p(spark, sf_dir)
    return ModeImputer(["gencat", "front"]).fit(p).transform(p).select("id", "gencat", "front")


@query("role_impute")
def role_impute(spark, sf_dir):
    p = frame_p(spark, sf_dir).select("id", "nbhd", "semcat", "gencat", "front", "y")
    imp = RoleImputer(semantic_cat=["semcat"], genuine_cat=["gencat"], fallback=True)
    return imp.fit(p).transform(p)


ORDINAL_TYPE_MAP = {"ECONOMY": 1, "STANDARD": 2, "MEDIUM": 3, "LARGE": 4, "PROMO": 5}  # SMALL left unmapped


@query("ordinal_map")
def ordinal_map(spark, sf_dir):
    p = frame_p(spark, sf_dir).select("id", F.col("gencat").alias("type_code"))
    return OrdinalMapper({"type_code": ORDINAL_TYPE_MAP, "absent_column": {"x": 1}}, default=0).transform(p)


L_DERIVED = DerivedSpec(
    sums={"total": [("q", 1.0), ("t", 1.0), ("l_discount", 1.0)],
          "weighted": [("q", 1.0), ("t", 0.5), ("l_discount", 0.5)]},
    diffs={"line_gap": ("l_linenumber", "q")},
    flags={"has_q": "q", "has_t": "t", "has_disc": "l_discount"},
)


@query("derived_features")
def derived_features(spark, sf_dir):
    li = frame_l(spark, sf_dir)
    out = DerivedColumns(L_DERIVED).transform(li)
    return out.select("l_orderkey", "l_linenumber", r6("total").alias("total"), r6("weighted").alias("weighted"),
                      r6("line_gap").alias("line_gap"), "has_q", "has_t", "has_disc")


@query("label_log1p_expm1")
def label_log1p_expm1(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    lab = o.select("o_orderkey", log1p("o_totalprice").alias("label"))
    return lab.select("o_orderkey", r6("label").alias("label"), F.round(F.expm1("label"), 2).alias("price_back"))


@query("scalar_math")
def scalar_math(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    d = F.col("l_extendedprice") - F.lit(50000.0)
    return li.select("l_orderkey", "l_linenumber",
                     r6(F.sqrt("l_extendedprice")).alias("sqrt_price"),
                     r6(F.pow(F.col("l_quantity"), 2)).alias("qty_sq"),
                     r6(F.abs(d)).alias("abs_dev"),
                     ((F.col("l_quantity") > 25) & (F.abs(d) < 20000)).alias("flag"))


@query("bround_codes")
def bround_codes(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", round_half_even(F.col("l_quantity") / 2.0).alias("half_code"))


# ---------------------------------------------------------------- audit

@query("target_summary")
def target_summary(spark, sf_dir):
    s = audit.target_summary(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return s.select("column", "n", r6("skew").alias("skew"), r6("min").alias("min"), r6("max").alias("max"),
                    r6("mean").alias("mean"), r6("median").alias("median"))


@query("skew_all")
def skew_all(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rep = audit.skewness_report(li, list(L_NUMERIC) + ["l_linenumber"], 0.75)
    return rep.select("column", r6("skew").alias("skew"), "is_skewed")


@query("missing_report")
def missing_report(spark, sf_dir):
    p = frame_p(spark, sf_dir)
    train = p.where(F.col("size") <= 25)
    test = p.where(F.col("size") > 25).drop("y")
    return audit.missing_report(train, test, label="y").select("column", r6("pct_missing").alias("pct_missing"))


@query("corr_target")
def corr_target(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rep = audit.corr_with_target(li, ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "l_extendedprice")
    return rep.select("column", r6("corr").alias("corr"))


def _l_with_copy(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    # a noisy copy of quantity so that one pair is collinear
    return li.withColumn("qty_copy", F.col("l_quantity") + (F.col("l_linenumber") - 4) * 2.0)


PAIR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "qty_copy"]


@query("corr_pairs")
def corr_pairs(spark, sf_dir):
    rep = audit.high_corr_pairs(_l_with_copy(spark, sf_dir), PAIR_COLS, 0.8)
    return rep.select("col_a", "col_b", r6("abs_corr").alias("abs_corr"))


@query("collinear_columns")
def collinear_columns(spark, sf_dir):
    rep = audit.collinear_columns(_l_with_copy(spark, sf_dir), PAIR_COLS, 0.8)
    return rep.select("column", "n_pairs", r6("max_abs_corr").alias("max_abs_corr"))


@query("heatmap_data")
def heatmap_data(spark, sf_dir):
    rep = audit.corr_pairs(_l_with_copy(spark, sf_dir), PAIR_COLS)
    return rep.select("col_a", "col_b", r6("abs_corr").alias("abs_corr"))


@query("top5_corr")
def top5_corr(spark, sf_dir):
    li = _l_with_copy(spark, sf_dir)
    rep = audit.top_correlated(li, PAIR_COLS + ["l_linenumber"], "l_extendedprice", 5)
    return rep.select("column", r6("corr").alias("corr"))


@query("z_outliers")
def z_outliers(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return audit.z_outliers(li, list(L_NUMERIC), 1.5)


@query("quartiles")
def quartiles(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = exact_quantiles(li, list(L_NUMERIC), [0.25, 0.5, 0.75])
    return q.select("column", "prob", r6("value").alias("value"))


AUDIT_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "qty_copy"]


@query("audit_report")
def audit_report(spark, sf_dir):
    """All audit sections of one table in one long frame."""
    li = _l_with_copy(spark, sf_dir).withColumn("l_tax", F.when(F.col("l_orderkey") % 13 == 0, F.lit(None)).otherwise(F.col("l_tax")))
    rep = audit.audit_report(li.select(*AUDIT_COLS, "l_extendedprice", "l_returnflag"), "l_extendedprice", z_threshold=1.5)
    return rep.select("section", "column", "other", "metric", r6("value").alias("value"))


@query("audit_json")
def audit_json(spark, sf_dir):
    """The whole audit written as one JSON report and read back."""
    path = scratch_dir(spark, "audit-json")
    io.write_json_report(QUERIES["audit_report"](spark, sf_dir), path)
    return io.read_json_report(spark, path, "section STRING, column STRING, other STRING, metric STRING, value DOUBLE")


@query("low_variance")
def low_variance(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rep = audit.low_variance(li, ["l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_linenumber"])
    return rep.select("column", "n_distinct", r6("top_share").alias("top_share"))


@query("low_variance_wide")
def low_variance_wide(spark, sf_dir):
    """Continuous and key columns too: those are sketched, not counted, and only said to be long."""
    li = table(spark, sf_dir, "lineitem").withColumn("half", F.when(F.col("l_linenumber") <= 3, 0.0).otherwise(F.col("l_extendedprice")))
    rep = audit.low_variance(li, ["l_returnflag", "l_quantity", "l_discount", "l_extendedprice", "l_orderkey", "half"], max_counted=1000)
    return rep.select("column", "exact", F.when(F.col("exact"), F.col("n_distinct")).alias("n_distinct"),
                      F.when(F.col("exact") | (F.col("top_share") > 0.01), r6("top_share")).alias("top_share"))


@query("hist_target")
def hist_target(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_totalprice", log1p("o_totalprice").alias("log_price"))
    h = audit.histogram(o, "o_totalprice", 50).unionByName(audit.histogram(o, "log_price", 50))
    return h.select("series", "bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


@query("kde_grid")
def kde_grid(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(log1p("o_totalprice").alias("log_price"))
    k = audit.kde_grid(o, "log_price", 200, 3.0)
    return k.select("grid_idx", r6("x").alias("x"), F.round("density", 8).alias("density"))


@query("scatter_extract")
def scatter_extract(spark, sf_dir):
    """Price and customer of every order, as the plot draws them."""
    return audit.scatter_points(table(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice", "o_custkey")


@query("scatter_bins")
def scatter_bins(spark, sf_dir):
    return audit.scatter_bins(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", 50)


@query("hist_gaps")
def hist_gaps(spark, sf_dir):
    """A histogram with empty bins: whole quantities over more bins than values."""
    h = audit.histogram(table(spark, sf_dir, "lineitem"), "l_quantity", 120)
    return h.select("series", "bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


# ---------------------------------------------------------------- encoders

from tabforge.operators.encode import (  # noqa: E402
    OneHotEncoder, RobustScaler, TargetEncoder, first_appearance_codes)
from tabforge.operators.knn import KNNImputer  # noqa: E402
from tabforge.operators.power import YeoJohnson  # noqa: E402


@query("category_codes")
def category_codes(spark, sf_dir):
    return first_appearance_codes(frame_p(spark, sf_dir), "gencat", "id").select("value", F.col("code").cast("int").alias("code"))


@query("robust_scale")
def robust_scale(spark, sf_dir):
    p = frame_p(spark, sf_dir).withColumn("z", F.when(F.col("size") > 45, F.col("size")).otherwise(0).cast("double"))
    cols = ["y", "front", "z"]
    out = RobustScaler(cols).fit(p).transform(p)
    return out.select("id", *[r6(c).alias(f"{c}_s") for c in cols])


@query("one_hot")
def one_hot(spark, sf_dir):
    c = frame_c(spark, sf_dir)
    model = OneHotEncoder(["seg"]).fit(c.where(F.col("seg") != "MACHINERY"))
    return model.transform(c).select("id", *model.output_cols)


@query("one_hot_clash")
def one_hot_clash(spark, sf_dir):
    """Levels that a plain name cannot tell apart ("1-URGENT" and "1 URGENT") keep columns of their own."""
    o = table(spark, sf_dir, "orders")
    level = F.when(F.col("o_orderkey") % 2 == 0, F.translate("o_orderpriority", "-", " ")).otherwise(F.col("o_orderpriority"))
    o = o.select("o_orderkey", F.when(F.col("o_orderpriority").startswith("1"), level).otherwise("other").alias("prio"))
    model = OneHotEncoder(["prio"]).fit(o)
    return model.transform(o).select("o_orderkey", *[F.col(c).alias(f"level_{i}") for i, c in enumerate(model.output_cols)])


@query("target_encode")
def target_encode(spark, sf_dir):
    c = frame_c(spark, sf_dir).withColumn("nat", F.col("nat").cast("string"))
    model = TargetEncoder(["nat"], "y").fit(c)
    return model.transform(c).select("id", r6("nat").alias("nat_te"))


@query("yeo_johnson")
def yeo_johnson_q(spark, sf_dir):
    c = frame_c(spark, sf_dir).withColumn("xb", F.col("x2") / 1000.0)
    model = YeoJohnson(["xb"]).fit(c)
    return model.transform(c).select("id", r6("xb").alias("xb_yj"), F.lit(model.lambdas["xb"]).alias("lam")).withColumn(
        "lam", r6("lam"))


@query("knn_impute")
def knn_impute(spark, sf_dir):
    p = frame_p(spark, sf_dir).select("id", "nbhd", "gencat", "front", "y")
    model = KNNImputer(["gencat", "front"], ["nbhd", "gencat", "front", "y"], "id", k=5).fit(p)
    return model.transform(p).select("id", "gencat", r6("front").alias("front"))


@query("knn_wide")
def knn_wide(spark, sf_dir):
    """Mixed-type imputation over 15 distance columns: exact search by the cell index over the 13 complete ones."""
    from tabforge.sources.frames import K_COMPLETE, frame_k
    k = checkpoint_once(frame_k(spark, sf_dir))
    model = KNNImputer(["seg", "acct"], [*K_COMPLETE, "acct", "seg"], "id", k=5).fit(k)
    return model.transform(k).select("id", "seg", r6("acct").alias("acct"))


# ---------------------------------------------------------------- models, validation, ensembles

from tabforge.operators.ensemble import SimplexBlend, Stacking, weighted_expr  # noqa: E402
from tabforge.operators.linear import L1Selector, Lasso, Ridge, RidgeCV, gram_sums  # noqa: E402
from tabforge.operators.trees import (  # noqa: E402
    GBT, LGBM_REGULARISED, XGB_BASELINE, XGB_REGULARISED, XGB_SPACE, FoldTrainer, RandomSearch)
from tabforge.operators.validate import (  # noqa: E402
    LinearCV, assign_folds, fold_scores, kept, oof_by_loop, run_parallel, score_summary, with_oofs)

RIDGE_ALPHA = 10.0


def c_folds(spark, sf_dir) -> DataFrame:
    """Frame C with folds, written once: every model reads the rows, none repeats the join."""
    return checkpoint_once(assign_folds(frame_c(spark, sf_dir), "id", k=5, seed=42))


def labelled_c(spark, sf_dir) -> DataFrame:
    """Frame C with the null-safe outlier filter (many orders but low spend)."""
    return drop_where(frame_c(spark, sf_dir), (F.col("x1") > 20) & (F.col("y") < 14.0))


def flagship(spark, sf_dir):
    """customer x orders -> spend -> filter -> log1p label -> folds -> ridge(x1, x2) -> OOF -> expm1."""
    c = assign_folds(labelled_c(spark, sf_dir), "id", k=5, seed=42)
    cv = LinearCV(Ridge(["x1", "x2"], "y", RIDGE_ALPHA)).fit(c)
    oof = cv.oof(c, "oof")
    return oof.select("id", "fold", r6("oof").alias("pred_log"), F.round(F.expm1("oof"), 0).alias("predicted_spend"))


QUERIES["flagship_oof"] = flagship


@query("fold_assign")
def fold_assign(spark, sf_dir):
    return c_folds(spark, sf_dir).select("id", "fold")


@query("ridge_fit")
def ridge_fit(spark, sf_dir):
    c = frame_c(spark, sf_dir)
    m = Ridge(["x1", "x2"], "y", RIDGE_ALPHA).fit(c)
    rows = [("(intercept)", m.intercept)] + [(f, float(b)) for f, b in zip(m.features, m.coef)]
    rep = spark.createDataFrame(rows, "feature string, coef double")
    return rep.select("feature", r6("coef").alias("coef"))


@query("lasso_fit")
def lasso_fit(spark, sf_dir):
    c = frame_c(spark, sf_dir)
    m = Lasso(["x1"], "y", 0.01).fit(c)
    rows = [("(intercept)", m.intercept)] + [(f, float(b)) for f, b in zip(m.features, m.coef)]
    return spark.createDataFrame(rows, "feature string, coef double").select("feature", r6("coef").alias("coef"))


@query("l1_select")
def l1_select(spark, sf_dir):
    c = frame_c(spark, sf_dir).withColumn("natd", F.col("nat").cast("double"))
    sel = L1Selector(["x1", "x2", "natd"], "y", alpha=0.0005).fit(c)
    rows = [(f, float(b), f in sel.kept) for f, b in sel.coef.items()]
    return (spark.createDataFrame(rows, "feature string, coef double, kept boolean")
            .select("feature", (F.round("coef", 9) + 0.0).alias("coef"), "kept"))


def _ridge_oof(c: DataFrame, feats: list[str], col: str) -> DataFrame:
    return LinearCV(Ridge(feats, "y", RIDGE_ALPHA)).fit(c).oof(c, col)


@query("cv_scores")
def cv_scores(spark, sf_dir):
    c = c_folds(spark, sf_dir)
    sc = fold_scores(_ridge_oof(c, ["x1"], "oof"), "y", "oof", model="ridge_x1")
    return sc.select("model", "fold", "n", r6("rmse").alias("rmse"))


@query("oof_predictions")
def oof_predictions(spark, sf_dir):
    oof = _ridge_oof(c_folds(spark, sf_dir), ["x1"], "oof")
    return oof.select("id", "fold", r6("y").alias("y"), r6("oof").alias("oof"))


def _two_model_oof(spark, sf_dir) -> DataFrame:
    return with_oofs(c_folds(spark, sf_dir), {"p_a": Ridge(["x1"], "y", RIDGE_ALPHA), "p_b": Ridge(["x2"], "y", RIDGE_ALPHA)})


@query("average_blend")
def average_blend(spark, sf_dir):
    oof = _two_model_oof(spark, sf_dir)
    return oof.select("id", r6("p_a").alias("p_a"), r6("p_b").alias("p_b"),
                      r6(weighted_expr(["p_a", "p_b"], [0.5, 0.5])).alias("blend"))


@query("weighted_blend")
def weighted_blend(spark, sf_dir):
    oof = _two_model_oof(spark, sf_dir)
    return oof.select("id", r6(weighted_expr(["p_a", "p_b"], [0.7, 0.3])).alias("blend"))


@query("blend_weights")
def blend_weights(spark, sf_dir):
    oof = _two_model_oof(spark, sf_dir)
    blend = SimplexBlend(["p_a", "p_b"], "y", "blend").fit(oof)
    rmse = blend.transform(oof).agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("blend"), 2)))).first()[0]
    rows = [("ridge_x1", float(blend.weights[0]), rmse), ("ridge_x2", float(blend.weights[1]), rmse)]
    return spark.createDataFrame(rows, "model string, weight double, pooled_rmse double").select(
        "model", r6("weight").alias("weight"), r6("pooled_rmse").alias("pooled_rmse"))


RIDGE_CV_ALPHAS = [0.1, 1.0, 10.0, 100.0]


@query("ridge_cv_loo")
def ridge_cv_loo(spark, sf_dir):
    c = frame_c(spark, sf_dir)
    est = RidgeCV(["x1"], "y", RIDGE_CV_ALPHAS)
    m = est.fit(c)
    rows = [(a, float(est.loo_mse_[a]), a == m.alpha) for a in RIDGE_CV_ALPHAS]
    return spark.createDataFrame(rows, "alpha double, loo_mse double, chosen boolean").select(
        "alpha", F.round("loo_mse", 8).alias("loo_mse"), "chosen")


def _score_table(spark, sf_dir) -> DataFrame:
    models = {"ridge_x1": ["x1"], "ridge_x2": ["x2"], "ridge_x1x2": ["x1", "x2"]}
    oof = with_oofs(c_folds(spark, sf_dir), {n: Ridge(f, "y", RIDGE_ALPHA) for n, f in models.items()})
    long = oof.unpivot(["fold", "y"], list(models), "model", "pred")
    return long.groupBy("model", "fold").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.pow(F.col("y") - F.col("pred"), 2))).alias("rmse"))


@query("model_compare")
def model_compare(spark, sf_dir):
    s = score_summary(_score_table(spark, sf_dir))
    return s.select("model", r6("mean_rmse").alias("mean_rmse"), r6("std_rmse").alias("std_rmse"), "n_folds")


@query("keep_if_better")
def keep_if_better(spark, sf_dir):
    s = score_summary(_score_table(spark, sf_dir))
    return s.agg(F.min_by("model", "mean_rmse").alias("best_model"), r6(F.min("mean_rmse")).alias("best_rmse"))


@query("refit_and_score")
def refit_and_score(spark, sf_dir):
    from tabforge.sources.frames import frame_c_unlabelled
    model = Ridge(["x1", "x2"], "y", RIDGE_ALPHA).fit(labelled_c(spark, sf_dir))
    scored = model.transform(frame_c_unlabelled(spark, sf_dir))
    return io.scored_table(scored, "id", "prediction", "predicted_spend").select(
        "id", F.round("predicted_spend", 0).alias("predicted_spend"))


@query("stack_ridge")
def stack_ridge(spark, sf_dir):
    c = c_folds(spark, sf_dir)
    makers = {"ridge_x1": lambda: Ridge(["x1"], "y", RIDGE_ALPHA), "ridge_x2": lambda: Ridge(["x2"], "y", RIDGE_ALPHA),
              "lasso_x1x2": lambda: Lasso(["x1", "x2"], "y", 0.0005)}

    stack = Stacking(makers, lambda cols: RidgeCV(cols, "y", RIDGE_CV_ALPHAS), None, "id").fit(c)
    return stack.transform(c).select("id", r6("prediction").alias("prediction"))


def _gbt_features(spark, sf_dir) -> DataFrame:
    c = c_folds(spark, sf_dir)
    return OneHotEncoder(["seg"]).fit(c).transform(c)


def _tree_features(c: DataFrame) -> list[str]:
    return ["x1", "x2"] + [x for x in c.columns if x.startswith("seg_")]


# Trees per model in ``gbt_importance`` and ``stack_final``; the other queries fit the published counts (README, "Trees").
QUERY_TREES = 20


@query("gbt_cv")
def gbt_cv(spark, sf_dir):
    with kept(_gbt_features(spark, sf_dir)) as c:
        def score(item):
            name, params = item
            oof = oof_by_loop(c, lambda: GBT(_tree_features(c), "y", params, id_col="id", coded=True), out_col="oof", persist=False)
            return fold_scores(oof, "y", "oof", model=name)

        tables = run_parallel(score, [("gbt_xgb_style", XGB_REGULARISED), ("gbt_lgbm_style", LGBM_REGULARISED)])
    return tables[0].unionByName(tables[1])


@query("search_trials")
def search_trials(spark, sf_dir):
    """Random search, 20 trials over the published space (100 to 2,000 trees, as drawn), each scored on all five folds."""
    c = checkpoint_once(_gbt_features(spark, sf_dir))
    with FoldTrainer(c, _tree_features(c), "y", "id") as folds:
        return RandomSearch(XGB_SPACE, lambda params: float(np.mean(folds.scores(params))), 20, parallelism=8).run(spark)


@query("gbt_published")
def gbt_published(spark, sf_dir):
    """The published 1,000 trees, fitted without fold 0; error on fold 0 after every tree, the best count marked."""
    c = checkpoint_once(_gbt_features(spark, sf_dir))
    with FoldTrainer(c, _tree_features(c), "y", "id") as folds:
        model, test = folds.fit(XGB_REGULARISED, 0)
        errors = model.evaluateEachIteration(test, "squared")
        n = test.count()
    best = errors.index(min(errors))
    rows = [(i + 1, n, float(e) ** 0.5, i == best) for i, e in enumerate(errors)]
    return spark.createDataFrame(rows, "trees int, n bigint, rmse double, best boolean")


@query("gbt_chosen")
def gbt_chosen(spark, sf_dir):
    """The published baseline with its tree count chosen on a held tenth, fitted on all rows with that count."""
    c = checkpoint_once(_gbt_features(spark, sf_dir))
    model = GBT(_tree_features(c), "y", XGB_BASELINE, id_col="id", choose_trees=True).fit(c)
    rmse = F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)))
    return model.transform(c).agg(F.count(F.lit(1)).alias("n"), rmse.alias("rmse")).select(
        "n", "rmse", F.lit(model.n_trees).alias("trees"), F.lit(len(model.errors)).alias("trees_scored"), F.lit(min(model.errors) ** 0.5).alias("held_rmse"))


@query("search_ridge")
def search_ridge(spark, sf_dir):
    """The search operator with an objective that SQL can repeat: ridge alphas by mean fold RMSE."""
    c = c_folds(spark, sf_dir)
    grams = gram_sums(c, ["x1"], "y", "fold")

    def objective(params):
        cv = LinearCV(Ridge(["x1"], "y", params["alpha"])).fit_grams(grams)
        return score_summary(fold_scores(cv.oof(c), "y", "oof")).first()["mean_rmse"]

    trials = RandomSearch({"alpha": (1e-2, 1e4, "log")}, objective, 20).run(spark)
    return trials.select("trial", r6("alpha").alias("alpha"), r6("score").alias("score"), "best")


CV_ALPHAS = [0.1, 1.0, 10.0, 100.0, 1000.0]


@query("cv_grid")
def cv_grid(spark, sf_dir):
    """Spark's CrossValidator over a grid of ridge alphas, on the fold column and with Spark's RMSE evaluator."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    ridge = Ridge(["x1"], "y", RIDGE_ALPHA)
    grid = ParamGridBuilder().addGrid(ridge.getParam("alpha"), CV_ALPHAS).build()
    cv = CrossValidator(estimator=ridge, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y", metricName="rmse"),
                        numFolds=5, foldCol="fold", parallelism=5).fit(c_folds(spark, sf_dir))
    rows = [(a, float(m), float(s), a == cv.bestModel.alpha) for a, m, s in zip(CV_ALPHAS, cv.avgMetrics, cv.stdMetrics)]
    out = spark.createDataFrame(rows, "alpha double, mean_rmse double, std_rmse double, best boolean")
    return out.select("alpha", r6("mean_rmse").alias("mean_rmse"), r6("std_rmse").alias("std_rmse"), "best")


@query("wide_ridge")
def wide_ridge(spark, sf_dir):
    """Ridge on one sparse one-hot feature per part (as many as the table has), names from the vector's metadata."""
    from tabforge.operators.dispatch import ColumnDispatcher
    from tabforge.operators.wide import WideRidge
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("part"), F.log1p("l_extendedprice").alias("y"))
    data = ColumnDispatcher([("nom", "one_hot", ["part"])]).fit(li).transform(li)
    model = WideRidge("y", RIDGE_ALPHA).fit(data)
    return model.coefficients(spark).select("feature", r6("coef").alias("coef"), F.lit(round(model.intercept, 6)).alias("intercept"))


@query("ablation")
def ablation(spark, sf_dir):
    """Same linear pipeline with and without the target-encoded nation and one-hot segment."""
    with kept(c_folds(spark, sf_dir).withColumn("nat", F.col("nat").cast("string"))) as c:
        def variant(item):
            name, improved = item
            oof = oof_by_loop(c, lambda: _AblationPipeline(improved), out_col="oof", persist=False)
            return fold_scores(oof, "y", "oof", model=name)

        tables = run_parallel(variant, [("base", False), ("improved", True)])
    summary = score_summary(tables[0].unionByName(tables[1]))
    return summary.select("model", r6("mean_rmse").alias("mean_rmse"), r6("std_rmse").alias("std_rmse"), "n_folds")


class _AblationPipeline:
    """Encoders fitted inside the training fold, then ridge."""

    def __init__(self, improved: bool):
        self.improved = improved

    def fit(self, df):
        stages = []
        feats = ["x1", "x2"]
        data = df
        if self.improved:
            oh = OneHotEncoder(["seg"]).fit(data)
            te = TargetEncoder(["nat"], "y").fit(data)
            data = te.transform(oh.transform(data)).withColumnRenamed("nat", "nat_te")
            stages = [oh, te]
            feats = feats + oh.output_cols + ["nat_te"]
        sc = RobustScaler(feats).fit(data)
        model = Ridge(feats, "y", RIDGE_ALPHA).fit(sc.transform(data))
        return _Fitted(stages, sc, model)


class _Fitted:
    def __init__(self, stages, scaler, model):
        self.stages, self.scaler, self.model = stages, scaler, model

    def transform(self, df):
        for s in self.stages:
            df = s.transform(df)
        if self.stages:
            df = df.withColumnRenamed("nat", "nat_te")
        return self.model.transform(self.scaler.transform(df))


# ---------------------------------------------------------------- reports over fitted models

from tabforge.operators.ensemble import ModelEnsemble  # noqa: E402
from tabforge.operators.power import SkewRouter  # noqa: E402


def coefficient_report(spark, features, coef, k: int = 5) -> DataFrame:
    """Top-k positive and top-k negative coefficients: (direction, rank, feature, coef)."""
    rep = spark.createDataFrame([(f, float(b)) for f, b in zip(features, coef)], "feature string, coef double")
    pos = rep.where(F.col("coef") > 0).orderBy(F.desc("coef"), "feature").limit(k)
    neg = rep.where(F.col("coef") < 0).orderBy(F.asc("coef"), "feature").limit(k)
    from pyspark.sql import Window as W
    return (pos.withColumn("direction", F.lit("positive")).withColumn("rank", F.row_number().over(W.orderBy(F.desc("coef"), "feature")))
            .unionByName(neg.withColumn("direction", F.lit("negative"))
                         .withColumn("rank", F.row_number().over(W.orderBy(F.asc("coef"), "feature")))))


@query("coef_top5")
def coef_top5(spark, sf_dir):
    c = OneHotEncoder(["seg"]).fit(frame_c(spark, sf_dir))
    data = c.transform(frame_c(spark, sf_dir))
    feats = ["x1", "x2"] + c.output_cols
    m = Ridge(feats, "y", RIDGE_ALPHA).fit(data)
    rep = coefficient_report(spark, feats, m.coef, 5)
    return rep.select("direction", F.col("rank").cast("int").alias("rank"), "feature", F.round("coef", 6).alias("coef"))


@query("average_models")
def average_models(spark, sf_dir):
    """Averaging ensemble: fresh copies fitted on all rows, predictions averaged."""
    c = frame_c(spark, sf_dir)
    ens = ModelEnsemble({"a": lambda: Ridge(["x1"], "y", RIDGE_ALPHA), "b": lambda: Ridge(["x2"], "y", RIDGE_ALPHA)},
                        combine="mean").fit(c)
    return ens.transform(c).select("id", r6("p_a").alias("p_a"), r6("p_b").alias("p_b"), r6("prediction").alias("blend"))


@query("skew_route")
def skew_route(spark, sf_dir):
    """|skew| > 0.75 -> Yeo-Johnson + robust scaling, else robust scaling (one skewed, two plain columns)."""
    c = frame_c(spark, sf_dir).withColumn("x3", F.exp(F.col("x1") / 5.0))
    model = SkewRouter(["x1", "x2", "x3"], 0.75).fit(c)
    out = model.transform(c)
    return out.select("id", *[r6(x).alias(x) for x in ("x1", "x2", "x3")],
                      F.lit(",".join(model.skewed)).alias("skewed_cols"))


@query("gbt_importance")
def gbt_importance(spark, sf_dir):
    c = _gbt_features(spark, sf_dir)
    model = GBT(_tree_features(c), "y", XGB_REGULARISED, QUERY_TREES, "id").fit(c)
    return model.importances(spark)


@query("scored_parquet")
def scored_parquet(spark, sf_dir):
    """Scored table written as Parquet (partitioned by market segment) and read back."""
    from tabforge.sources.frames import frame_c_unlabelled
    model = Ridge(["x1", "x2"], "y", RIDGE_ALPHA).fit(labelled_c(spark, sf_dir))
    scored = io.scored_table(model.transform(frame_c_unlabelled(spark, sf_dir)).withColumnRenamed("id", "Id"),
                             "Id", "prediction", "predicted_spend")
    seg = frame_c_unlabelled(spark, sf_dir).select(F.col("id").alias("Id"), "seg")
    path = scratch_dir(spark, "scored")
    io.write_parquet(scored.join(seg, "Id"), path, partition_by=["seg"])
    back = spark.read.parquet(path)
    return back.select(F.col("Id").alias("id"), "seg", F.round("predicted_spend", 0).alias("predicted_spend"))



@query("nested_blend_rmse")
def nested_blend_rmse(spark, sf_dir):
    """Per-fold RMSE of a blend whose weights were fitted without the scored fold, plus the pooled RMSE."""
    from tabforge.operators.ensemble import nested_blend
    oof, weights = nested_blend(_two_model_oof(spark, sf_dir), ["p_a", "p_b"], "y")
    per = fold_scores(oof, "y", "blend", model="nested_blend")
    pooled = oof.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("blend"), 2)))).first()[0]
    wa = {f: float(w[0]) for f, w in weights.items()}
    wmap = F.create_map(*[x for f, w in sorted(wa.items()) for x in (F.lit(f), F.lit(w))])
    return per.select("fold", "n", r6("rmse").alias("rmse"), r6(wmap[F.col("fold")]).alias("weight_a"),
                      F.lit(round(pooled, 6)).alias("pooled_rmse"))


@query("blend_gate")
def blend_gate(spark, sf_dir):
    """Keep a candidate model only if adding it to the averaging blend lowers the pooled OOF RMSE."""
    from tabforge.operators.ensemble import average_expr
    c = c_folds(spark, sf_dir)
    c = with_oofs(c, {"p_a": Ridge(["x1"], "y", RIDGE_ALPHA), "p_b": Ridge(["x2"], "y", RIDGE_ALPHA),
                      "p_c": Ridge(["x1", "x2"], "y", RIDGE_ALPHA)})
    err = lambda cols: F.sqrt(F.avg(F.pow(F.col("y") - average_expr(cols), 2)))
    return c.agg(err(["p_a", "p_b"]).alias("rmse_without"), err(["p_a", "p_b", "p_c"]).alias("rmse_with")).select(
        F.lit("ridge_x1x2").alias("candidate"), r6("rmse_without").alias("rmse_without"),
        r6("rmse_with").alias("rmse_with"), (F.col("rmse_with") < F.col("rmse_without")).alias("kept"))


# ---------------------------------------------------------------- the final stack

from tabforge.operators.pipelines import PipelineStacking, RegressionPipeline, nested_stack_scores, switch_ablation  # noqa: E402


def _pipeline(make):
    return lambda: RegressionPipeline(make, "y", ["x1", "x2"], ["nat"], ["seg"], l1_alpha=0.0005)


def _trees(params):
    return _pipeline(lambda feats: GBT(feats, "y", params, QUERY_TREES, "id"))


LINEAR_PIPELINES = {"ridge": _pipeline(lambda feats: Ridge(feats, "y", RIDGE_ALPHA)),
                    "lasso": _pipeline(lambda feats: Lasso(feats, "y", 0.0005))}
FINAL_PIPELINES = {**LINEAR_PIPELINES, "xgb": _trees(XGB_REGULARISED), "lgbm": _trees(LGBM_REGULARISED)}


def _meta(cols):
    return RidgeCV(cols, "y", RIDGE_CV_ALPHAS)


@query("stack_final")
def stack_final(spark, sf_dir):
    """RidgeCV over four pipelines (ridge, lasso, two boosted-tree configurations), refitted on all rows."""
    c = c_folds(spark, sf_dir).withColumn("nat", F.col("nat").cast("string"))
    out = PipelineStacking(FINAL_PIPELINES, _meta, "id").fit(c).transform(c)
    return out.select("id", *[r6(f"p_{n}").alias(f"p_{n}") for n in FINAL_PIPELINES], r6("prediction").alias("prediction"))


@query("nested_stack")
def nested_stack(spark, sf_dir):
    """Score of the whole stack of the two linear pipelines: per outer fold, 5 inner folds and refits on the other rows."""
    c = c_folds(spark, sf_dir).withColumn("nat", F.col("nat").cast("string"))
    scores = nested_stack_scores(c, LINEAR_PIPELINES, _meta, "id", "y")
    return scores.select("model", "fold", "n", r6("rmse").alias("rmse"))


@query("switches")
def switches(spark, sf_dir):
    """The three switches of the published ablation, each alone, none and all: row filter, KNN imputation, Yeo-Johnson."""
    from tabforge.sources.frames import K_COMPLETE, frame_k
    numbers = [*K_COMPLETE[:-1], "acct"]
    k = frame_k(spark, sf_dir).join(frame_c(spark, sf_dir).select("id", "y"), "id")
    k = checkpoint_once(assign_folds(k, "id", k=5, seed=42))

    def plain(df):
        return df.withColumns({"acct": F.coalesce("acct", F.lit(0.0)), "seg": F.coalesce("seg", F.lit("None")), "nat": F.col("nat").cast("string")})

    def near(df):
        return checkpoint_once(KNNImputer(["seg", "acct"], [*K_COMPLETE, "acct", "seg"], "id", k=5).fit(df).transform(df))

    def make(on):
        pipe = RegressionPipeline(lambda f: Ridge(f, "y", RIDGE_ALPHA), "y", numbers, ["nat"], ["seg"], route_skew=on["yeo_johnson"], l1_alpha=0.0005, scale=True)
        return _Prefilled(plain, pipe)

    scores = switch_ablation(k, {"rows": lambda df: df.where(F.col("n_orders") >= 4), "knn": near, "yeo_johnson": None}, make, "y")
    return scores.select("model", "fold", "n", r6("rmse").alias("rmse"))


class _Prefilled:
    """A pipeline behind fixed fills of what is still null."""

    def __init__(self, fill, pipe):
        self.fill, self.pipe = fill, pipe

    def fit(self, df):
        return _Fitted([], _Step(self.fill), self.pipe.fit(self.fill(df)))


class _Step:
    def __init__(self, fn):
        self.transform = fn
