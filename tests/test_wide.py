"""Column dispatcher with sparse one-hot features, and linear models on them."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from tabforge.operators.dispatch import ColumnDispatcher, feature_names
from tabforge.operators.encode import OneHotEncoder, RobustScaler, TargetEncoder
from tabforge.operators.linear import Lasso, Ridge
from tabforge.operators.wide import WideLasso, WideRidge


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, float(i % 17), float((i * 7) % 23) / 3, "abcd"[(i // 3) % 4], None if i % 9 == 0 else f"l {i % 6}",
             1.5 * (i % 17) - (i % 4) + ((i * 13) % 10) / 10) for i in range(300)]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, seg string, lev string, y double").repartition(4, "id").cache()


GROUPS = [("num", "passthrough", ["x1", "x2"]), ("nom", "one_hot", ["seg", "lev"])]


def test_names_and_values(data):
    out = ColumnDispatcher(GROUPS).fit(data).transform(data)
    assert out.columns == data.columns + ["features"]
    want = ["num__x1", "num__x2", *[f"nom__seg_{v}" for v in "abcd"], *[f"nom__lev_l {k}" for k in range(6)]]
    assert feature_names(out) == want
    for r in out.withColumn("v", vector_to_array("features")).collect():
        assert r["v"] == [r["x1"], r["x2"], *[float(r["seg"] == v) for v in "abcd"], *[float(r["lev"] == f"l {k}") for k in range(6)]]


def test_unseen_and_null_levels_are_all_zeros_and_empty_columns_are_left_out(spark, data):
    none = data.withColumn("void", F.lit(None).cast("string"))
    model = ColumnDispatcher([("nom", "one_hot", ["seg", "void"])]).fit(none.where("seg != 'b'"))
    out = model.transform(none)
    assert feature_names(out) == ["nom__seg_a", "nom__seg_c", "nom__seg_d"]
    assert {(r["seg"], tuple(r["features"].toArray())) for r in out.collect()} == {
        ("a", (1.0, 0.0, 0.0)), ("b", (0.0, 0.0, 0.0)), ("c", (0.0, 1.0, 0.0)), ("d", (0.0, 0.0, 1.0))} & {
        (r["seg"], tuple(r["features"].toArray())) for r in out.collect()}


def test_estimators_as_groups_and_a_column_in_two_groups(data):
    groups = [("scaled", RobustScaler([]), ["x1", "x2"]), ("mean", TargetEncoder([], "y"), ["seg"]), ("nom", "one_hot", ["seg"])]
    out = ColumnDispatcher(groups).fit(data).transform(data)
    assert feature_names(out)[:3] == ["scaled__x1", "scaled__x2", "mean__seg"]
    te, sc = TargetEncoder(["seg"], "y").fit(data).transform(data), RobustScaler(["x1", "x2"]).fit(data).transform(data)
    want = {r["id"]: [r["x1"], r["x2"]] for r in sc.collect()}
    means = {r["id"]: r["seg"] for r in te.collect()}
    for r in out.collect():
        assert r["features"].toArray()[:3].tolist() == [*want[r["id"]], means[r["id"]]]


def test_pipeline_of_dispatcher_and_ridge_saved(data, tmp_path):
    model = Pipeline(stages=[ColumnDispatcher(GROUPS), WideRidge("y", 2.0)]).fit(data)
    model.save(f"file://{tmp_path}/m")
    back = PipelineModel.load(f"file://{tmp_path}/m")
    want = {r["id"]: r["prediction"] for r in model.transform(data).collect()}
    assert {r["id"]: r["prediction"] for r in back.transform(data).collect()} == want
    assert back.stages[1].names == feature_names(model.stages[0].transform(data))


def dense(data):
    """The same features as plain columns."""
    model = OneHotEncoder(["seg", "lev"]).fit(data)
    return model.transform(data), ["x1", "x2", *model.output_cols]


@pytest.mark.parametrize("alpha", [0.5, 10.0])
def test_ridge_equals_the_gram_route(data, alpha):
    columns, names = dense(data)
    want = Ridge(names, "y", alpha).fit(columns)
    got = WideRidge("y", alpha).fit(ColumnDispatcher(GROUPS).fit(data).transform(data))
    assert np.abs(got.coef - want.coef).max() < 1e-9 and abs(got.intercept - want.intercept) < 1e-9
    a = {r["id"]: r["prediction"] for r in want.transform(columns).collect()}
    b = {r["id"]: r["prediction"] for r in got.transform(ColumnDispatcher(GROUPS).fit(data).transform(data)).collect()}
    assert max(abs(a[i] - b[i]) for i in a) < 1e-8


def test_lasso_equals_the_gram_route(data):
    columns, names = dense(data)
    want = Lasso(names, "y", 0.02).fit(columns)
    got = WideLasso("y", 0.02).fit(ColumnDispatcher(GROUPS).fit(data).transform(data))
    a = np.array([r["prediction"] for r in want.transform(columns).orderBy("id").collect()])
    out = got.transform(ColumnDispatcher(GROUPS).fit(data).transform(data))
    b = np.array([r["prediction"] for r in out.orderBy("id").collect()])
    assert np.abs(a - b).max() < 1e-4
    assert np.abs(got.coef - want.coef).max() < 1e-3 and ((got.coef == 0) == (np.abs(want.coef) < 1e-6)).all()


def test_sparse_and_dense_rows_mixed_null_and_constant_features(spark):
    rng = np.random.default_rng(2)
    x = np.where(rng.random((80, 6)) < 0.4, 0.0, rng.normal(size=(80, 6)))
    x[:, 5] = 3.0
    y = x @ np.arange(6.0) + 7 + rng.normal(size=80)
    rows = [(SparseVector(6, {j: float(v) for j, v in enumerate(r) if v}) if i % 2 else Vectors.dense(r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame([*rows, (None, 1.0), (Vectors.dense([0.0] * 6), None)], ["features", "y"]).repartition(3)
    got = WideRidge("y", 0.3).fit(df)
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 0.3 * np.eye(6), xc.T @ yc)
    assert np.abs(got.coef - want).max() < 1e-9 and abs(got.intercept - (y.mean() - x.mean(axis=0) @ want)) < 1e-9


def test_fifty_thousand_levels(spark):
    """One-hot ridge has a closed form: beta = n (mean - b0) / (n + alpha), b0 the mean of the level means weighted n / (n + alpha)."""
    levels = 50_000
    df = spark.range(2 * levels).select(F.concat(F.lit("level "), (F.col("id") % levels).cast("string")).alias("c"),
                                        (F.pmod(F.col("id") * 7919, F.lit(1009)) / 100.0).alias("y"))
    out = ColumnDispatcher([("nom", "one_hot", ["c"])]).fit(df).transform(df)
    assert len(feature_names(out)) == levels and isinstance(out.first()["features"], SparseVector)
    model = WideRidge("y", 10.0).fit(out)
    stats = df.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("m")).toPandas()
    w = stats.n / (stats.n + 10.0)
    b0 = (w * stats.m).sum() / w.sum()
    want = dict(zip("nom__c_" + stats.c, w * (stats.m - b0)))
    assert abs(model.intercept - b0) < 1e-9
    assert max(abs(want[n] - c) for n, c in zip(model.names, model.coef)) < 1e-9


def test_levels_beyond_the_bound_go_by_a_table(spark, monkeypatch, tmp_path):
    """1.2 million levels were an error: the schema and the driver held every one of them."""
    from tabforge.operators import dispatch
    monkeypatch.setattr(dispatch, "TABLE_LEVELS", 30)
    df = spark.range(0, 400, 1, 1).select("id", F.when(F.col("id") % 50 > 0, F.concat(F.lit("v"), (F.col("id") * 7 % 41).cast("string"))).alias("c"),
                                 (F.pmod(F.col("id") * 7919, F.lit(101)) / 10.0).alias("y"))
    fitted = ColumnDispatcher([("nom", "one_hot", ["c"])], max_levels=20).fit(df)
    out = fitted.transform(df)
    assert out.columns == [*df.columns, "features"] and feature_names(out) == []
    monkeypatch.setattr(dispatch, "TABLE_LEVELS", 100)
    vectors = ColumnDispatcher([("nom", "one_hot", ["c"])]).fit(df).transform(df)
    names = feature_names(vectors)
    assert [r["feature"] for r in fitted.levels.orderBy("code").collect()] == names
    a = {r["id"]: (r["features"]["size"], list(r["features"]["indices"]), list(r["features"]["values"])) for r in out.collect()}
    assert a == {r["id"]: (41, r["features"].indices.tolist(), r["features"].values.tolist()) for r in vectors.collect()}
    for estimator in (WideRidge("y", 10.0), WideLasso("y", 0.01)):
        got, want = estimator.fit(out), estimator.fit(vectors)
        assert abs(got.intercept - want.intercept) < 1e-9
        coefs = {r["feature"]: r["coef"] for r in got.coefficients(spark).collect()}
        assert coefs.keys() == set(names) and max(abs(coefs[n] - c) for n, c in zip(names, want.coef)) < 1e-9
        p = {r["id"]: r["prediction"] for r in got.transform(out).collect()}
        assert max(abs(p[r["id"]] - r["prediction"]) for r in want.transform(vectors).collect()) < 1e-9
    fitted.write().save(f"file://{tmp_path}/levels")
    back = dispatch.LevelTableModel.load(f"file://{tmp_path}/levels").transform(df)
    assert {r["id"]: list(r["features"]["indices"]) for r in back.collect()} == {k: v[1] for k, v in a.items()}
