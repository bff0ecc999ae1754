"""Inputs that the test tables do not hold: clashing names, large integers, gaps, constants, null anchors."""

import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import audit
from tabforge.operators.clean import GroupMedianImputer
from tabforge.operators.encode import OneHotEncoder, first_appearance_codes
from tabforge.operators.ensemble import MAX_BLEND, simplex_least_squares
from tabforge.operators.knn import KNNImputer
from tabforge.operators.linear import Gram, Lasso, Ridge, gram_sums, linear_expr, solve_lasso
from tabforge.operators.persist import load_model, save_model
from tabforge.operators.pipelines import PipelineStacking, RegressionPipeline, fit_pipelines, nested_stack_scores
from tabforge.operators.trees import GBT, RandomSearch, gbt_params
from tabforge.operators.validate import LinearCV, assign_folds, fit_linear_cvs
from tabforge.session import shuffle_partitions_for


def test_one_hot_levels_that_look_alike(spark):
    df = spark.createDataFrame([(1, "A B"), (2, "A-B"), (3, "A_B"), (4, "a_b"), (5, None)], "id int, c string")
    model = OneHotEncoder(["c"]).fit(df)
    assert len(set(x.lower() for x in model.output_cols)) == 4
    rows = model.transform(df).orderBy("id").collect()
    assert [sum(r[x] for x in model.output_cols) for r in rows] == [1, 1, 1, 1, 0]
    with pytest.raises(ValueError):
        OneHotEncoder(["c"]).fit(df.where("id = 1")).transform(df.withColumn("c_A_B", F.lit(0)))


def test_one_hot_refuses_wide_columns_before_collecting(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="max_levels"):
        OneHotEncoder(["c"], max_levels=20).fit(df)


def test_modes_of_large_integers(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(x,) for x in [5] * 4 + [big + 1] * 3 + [big] * 2], "x long")
    assert audit.typed_modes(df, ["x"]) == {"x": 5}


def test_histogram_keeps_empty_bins_and_takes_null_columns(spark):
    df = spark.createDataFrame([(0.0, None), (1.0, None), (2.0, None), (100.0, None)], "x double, y double")
    rows = audit.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [3, 0, 0, 0, 0, 0, 0, 0, 0, 1]
    assert audit.histogram(df, "y", 10).count() == 0


def test_density_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None)], "x double, y double")
    assert audit.kde_grid(df, "x").count() == 0 and audit.kde_grid(df, "y").count() == 0


def test_correlations_with_pairwise_nulls_equal_pandas(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 1, (400, 12))
    x[:, 3] = x[:, 1] * 2 + rng.normal(0, 0.1, 400)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 11] = 7.0
    import pandas as pd
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(12)])
    expected = pdf.corr().abs()
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in pdf)).repartition(5)
    got = {(r["col_a"], r["col_b"]): r["abs_corr"] for r in audit.corr_pairs(df, list(pdf)).collect()}
    assert len(got) == 66
    for (a, b), v in got.items():
        assert (v is None) == ("c11" in (a, b))
        assert v is None or abs(v - expected.loc[a, b]) < 1e-9


def test_scatter_bins_count_every_row(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("x"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("y"))
    assert audit.scatter_bins(df, "x", "y", 5).agg(F.sum("n")).first()[0] == 900


def test_scatter_extract_draws_every_order(spark, tmp_path):
    from tabforge.plans.catalogue import QUERIES
    orders = [(k, k % 3, float(k) * 1.5) for k in range(40)] + [(5, 2, None), (5, 2, None)]
    schema = "o_orderkey long, o_custkey long, o_totalprice double"
    spark.createDataFrame(orders, schema).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 2, 3.0)], "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    got = QUERIES["scatter_extract"](spark, str(tmp_path))
    assert got.columns == ["o_orderkey", "o_totalprice", "o_custkey"]
    assert sorted(map(str, ((r[0], r[2], r[1]) for r in got.collect()))) == sorted(map(str, orders))


def test_group_median_keeps_column_order_on_both_paths(spark):
    rows = [(i, f"g{i % 200}", float(i) if i % 3 else None) for i in range(1200)]
    df = spark.createDataFrame(rows, "id int, g string, x double")
    few = df.where("id % 200 < 5")
    for frame in (df, few):  # 200 groups are joined, 5 are a literal map
        out = GroupMedianImputer("x", "g").fit(frame).transform(frame)
        assert out.columns == ["id", "g", "x"] and out.where("x is null").count() == 0


def _knn_rows():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        a, b = float(rng.normal()), float(rng.normal())
        rows.append((i, a, b, None if i % 6 == 0 else a + b, None))
    return rows


def test_knn_takes_null_anchors_and_empty_columns(spark):
    schema = "id long, a double, b double, t double, e string"
    df = spark.createDataFrame(_knn_rows(), schema)
    model = KNNImputer(["t"], ["a", "b", "t", "e"], "id", k=3).fit(df)
    new = spark.createDataFrame([(100, None, 0.3, None, None), (101, 0.2, None, None, None), (102, None, None, None, None),
                                 (103, 0.1, 0.1, None, "x")], schema)
    got = {r["id"]: r["t"] for r in model.transform(new).collect()}
    donors = [r for r in _knn_rows() if r[3] is not None]

    def mean(a, b):
        def d(r):
            both = [(x - y) ** 2 for x, y in ((a, r[1]), (b, r[2])) if x is not None]
            return sum(both) / len(both)
        return np.mean([r[3] for r in sorted(donors, key=lambda r: (d(r), r[0]))[:3]])

    assert abs(got[100] - mean(None, 0.3)) < 1e-9 and abs(got[101] - mean(0.2, None)) < 1e-9
    assert abs(got[103] - mean(0.1, 0.1)) < 1e-9
    assert abs(got[102] - np.mean([r[3] for r in donors])) < 1e-9  # no distance at all: the donor mean


def test_coded_levels_are_bounded(spark):
    df = spark.range(50).select("id", F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="levels"):
        first_appearance_codes(df, "c", "id", max_levels=10)


def test_linear_expression_of_thousands_of_terms(spark):
    df = spark.createDataFrame([(2.0,)], "x double")
    assert df.select(linear_expr(["x"] * 3000, 1.0, [0.5] * 3000).alias("y")).first()["y"] == 3001.0


def test_lasso_says_when_it_does_not_converge():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 5)) @ rng.normal(size=(5, 5))
    y = x.sum(axis=1)
    g = Gram(50, x.sum(0), y.sum(), x.T @ x, x.T @ y, y @ y, np.zeros(5), 0.0)
    with pytest.raises(RuntimeError):
        solve_lasso(g, 1e-6, max_iter=2)


def _linear_frame(spark, n=400):
    rng = np.random.default_rng(4)
    rows = [(i, float(a), float(b), "uvw"[i % 3], float(2 * a - b + (i % 3) + e)) for i, (a, b, e) in enumerate(rng.normal(size=(n, 3)))]
    return assign_folds(spark.createDataFrame(rows, "id long, a double, b double, s string, y double"), "id")


def test_models_cut_from_one_gram_equal_their_own(spark):
    df = _linear_frame(spark)
    many = {"one": Ridge(["b"], "y", 3.0), "two": Lasso(["b", "a"], "y", 0.01)}
    for name, cv in fit_linear_cvs(df, many).items():
        alone = LinearCV(many[name]).fit(df)
        for k in cv.fold_models:
            assert np.allclose(cv.fold_models[k][1], alone.fold_models[k][1]) and abs(cv.fold_models[k][0] - alone.fold_models[k][0]) < 1e-9
    holes = df.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    cv = fit_linear_cvs(holes, many)["one"]  # rows without a still count for the model that does not use it
    assert abs(cv.full_model[1][0] - Ridge(["b"], "y", 3.0).solve(gram_sums(holes, ["b"], "y")[None])[1][0]) < 1e-9


def test_blend_beyond_the_tried_supports():
    n = MAX_BLEND + 1
    assert np.allclose(simplex_least_squares(np.eye(n), np.ones(n), 1.0), 1.0 / n)


def test_tree_parameters_map_warn_or_fail():
    assert gbt_params({"num_leaves": 31, "max_depth": 8, "min_child_samples": 7})["maxDepth"] == 5
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        gbt_params({"reg_lambda": 2.0})
    assert len(caught) == 1
    with pytest.raises(ValueError):
        gbt_params({"gamma": 1.0})


def test_trees_follow_from_the_data_and_can_be_saved(spark, tmp_path):
    df = _linear_frame(spark)
    one = GBT(["a", "b"], "y", {"n_estimators": 4, "subsample": 0.7}, id_col="id").fit(df)
    two = GBT(["a", "b"], "y", {"n_estimators": 4, "subsample": 0.7}, id_col="id").fit(df.repartition(7))
    assert one.num_partitions == two.num_partitions == 1  # 400 rows, however many cores
    p1 = [r["prediction"] for r in one.transform(df).orderBy("id").collect()]
    assert p1 == [r["prediction"] for r in two.transform(df).orderBy("id").collect()]
    save_model(one, str(tmp_path / "m"), spark)
    back = load_model(str(tmp_path / "m"), spark)
    assert p1 == [r["prediction"] for r in back.transform(df).orderBy("id").collect()]
    stopped = GBT(["a", "b"], "y", {"n_estimators": 30}, id_col="id", early_stopping=True, tolerance=0.5).fit(df)
    assert stopped.n_trees < 30


def test_random_search(spark):
    search = RandomSearch({"x": (-2.0, 2.0, "float"), "n": (1, 3, "int")}, lambda p: (p["x"] - 1) ** 2 + p["n"], 30)
    rows = search.run(spark).collect()
    best = min(rows, key=lambda r: r["score"])
    assert best["best"] and sum(r["best"] for r in rows) == 1 and search.best_params == {"x": best["x"], "n": best["n"]}


def test_pipeline_stack_equals_an_explicit_fold_loop(spark):
    df = _linear_frame(spark).persist()
    makers = {"r": lambda: RegressionPipeline(lambda f: Ridge(f, "y", 1.0), "y", ["a", "b"], [], ["s"], route_skew=False),
              "t": lambda: RegressionPipeline(lambda f: GBT(f, "y", {"n_estimators": 3}, id_col="id"), "y", ["a", "b"], ["s"])}
    stack = PipelineStacking(makers, lambda cols: Ridge(cols, "y", 0.1), "id")
    out = stack.fit(df).transform(df)
    assert out.columns == [*df.columns, "p_r", "p_t", "prediction"]
    oof = {r["id"]: (r["p_r"], r["p_t"]) for r in stack.oof_.collect()}
    for k in range(5):
        for j, n in enumerate(("r", "t")):
            model = makers[n]().fit(df.where(F.col("fold") != k))
            for r in model.transform(df.where(F.col("fold") == k)).collect():
                assert abs(oof[r["id"]][j] - r["prediction"]) < 1e-9
    df.unpersist()


def test_nested_scores_have_every_fold(spark):
    df = _linear_frame(spark, 120)
    makers = {"r": lambda: RegressionPipeline(lambda f: Ridge(f, "y", 1.0), "y", ["a", "b"], route_skew=False)}
    rows = nested_stack_scores(df, makers, lambda cols: Ridge(cols, "y", 0.1), "id", "y", k=2).collect()
    assert sorted(r["fold"] for r in rows) == [0, 1, 2, 3, 4] and sum(r["n"] for r in rows) == 120
    assert all(r["rmse"] < 2.5 for r in rows)


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions_for(100 * 10 ** 12) > 350_000 and shuffle_partitions_for(1) == 8


def test_shared_front_stages_give_the_models_of_separate_fits(spark):
    rows = [(i, float(i % 17), float(np.exp((i * 7) % 11 / 2)), "abc"[i % 3], float(i % 17) + (i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, s string, y double")
    makers = {"r": lambda: RegressionPipeline(lambda f: Ridge(f, "y", 1.0), "y", ["a", "b"], [], ["s"]),
              "q": lambda: RegressionPipeline(lambda f: Ridge(f, "y", 5.0), "y", ["a", "b"], [], ["s"]),
              "t": lambda: RegressionPipeline(lambda f: Ridge(f, "y", 1.0), "y", ["a", "b"], ["s"])}
    together = fit_pipelines(makers, df)
    assert together["r"].stages is together["q"].stages
    assert together["r"].stages is not together["t"].stages
    for name, make in makers.items():
        assert np.allclose(together[name].model.coef, make().fit(df).model.coef)


def test_linear_models_behind_a_selection_share_its_scan(spark, monkeypatch):
    from tabforge.operators import linear
    from tabforge.operators.linear import Lasso
    scans, whole = [], linear.gram_sums
    monkeypatch.setattr(linear, "gram_sums", lambda *a, **b: scans.append(1) or whole(*a, **b))
    makers = {"r": lambda: RegressionPipeline(lambda f: Ridge(f, "y", 1.0), "y", ["a", "b"], route_skew=False, l1_alpha=0.0005),
              "l": lambda: RegressionPipeline(lambda f: Lasso(f, "y", 0.0005), "y", ["a", "b"], route_skew=False, l1_alpha=0.0005)}
    rows = [(i, float(i % 17), float((i * 7) % 11), float(i % 17) + (i * 7) % 11) for i in range(200)]
    for nulls in (False, True):
        df = spark.createDataFrame([(i, a, None if nulls and i % 9 == 0 else b, y) for i, a, b, y in rows], "id long, a double, b double, y double")
        scans.clear()
        together = fit_pipelines(makers, df)
        assert len(scans) == (3 if nulls else 1)   # rows left out for a null may count for the features that are kept
        for n, estimator in (("r", Ridge(["a", "b"], "y", 1.0)), ("l", Lasso(["a", "b"], "y", 0.0005))):
            assert np.allclose(together[n].model.coef, estimator.fit(df).coef)
