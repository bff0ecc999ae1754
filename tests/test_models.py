import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators.ensemble import SimplexBlend, oof_cross_products, simplex_by_active_set, simplex_least_squares
from tabforge.operators.linear import L1Selector, Lasso, Ridge, RidgeCV, gram_sums, ridge_loo_mse, solve_ridge
from tabforge.operators.validate import LinearCV, assign_folds, oof_by_loop


def _linear_df(spark, n=200, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 10.0, 0.1] + [5.0, 1000.0, 0.0]
    y = 2.0 + x @ [0.5, -0.02, 0.0] + rng.normal(scale=0.3, size=n)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, x3 double, y double"), x, y


def _ridge_np(x, y, alpha):
    xm, ym = x.mean(0), y.mean()
    xc, yc = x - xm, y - ym
    b = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return ym - xm @ b, b


def test_ridge_matches_normal_equations(spark):
    df, x, y = _linear_df(spark)
    m = Ridge(["x1", "x2", "x3"], "y", 10.0).fit(df)
    b0, b = _ridge_np(x, y, 10.0)
    assert np.allclose(m.coef, b, atol=1e-9) and abs(m.intercept - b0) < 1e-8


def test_lasso_matches_ista(spark):
    df, x, y = _linear_df(spark)
    alpha = 0.05
    m = Lasso(["x1", "x2", "x3"], "y", alpha).fit(df)
    xc, yc = x - x.mean(0), y - y.mean()
    n = len(y)
    b = np.zeros(3)
    step = n / np.linalg.eigvalsh(xc.T @ xc).max()
    for _ in range(200000):
        z = b - step * (xc.T @ (xc @ b - yc)) / n
        b = np.sign(z) * np.maximum(np.abs(z) - step * alpha, 0)
    assert np.allclose(m.coef, b, atol=1e-6)
    assert m.coef[2] == 0.0  # the noise feature is dropped
    sel = L1Selector(["x1", "x2", "x3"], "y", alpha).fit(df)
    assert sel.kept == ["x1", "x2"]


def test_loo_identity_equals_explicit_refits(spark):
    df, x, y = _linear_df(spark, n=40)
    g = gram_sums(df, ["x1", "x2"], "y")[None]
    got = ridge_loo_mse(df, g, ["x1", "x2"], "y", [0.1, 10.0])
    for a in (0.1, 10.0):
        errs = []
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            b0, b = _ridge_np(x[keep][:, :2], y[keep], a)
            errs.append(y[i] - b0 - x[i, :2] @ b)
        assert abs(got[a] - np.mean(np.square(errs))) < 1e-10
    m = RidgeCV(["x1", "x2"], "y", [0.1, 10.0]).fit(df)
    assert m.alpha == min((0.1, 10.0), key=lambda a: got[a])


def test_fold_models_equal_explicit_refits(spark):
    df, x, y = _linear_df(spark)
    df = assign_folds(df, "id", 5, 42)
    cv = LinearCV(Ridge(["x1", "x2"], "y", 1.0)).fit(df)
    folds = np.array([r.fold for r in df.orderBy("id").collect()])
    for k, (b0, b) in cv.fold_models.items():
        e0, e = _ridge_np(x[folds != k][:, :2], y[folds != k], 1.0)
        assert np.allclose(b, e, atol=1e-9) and abs(b0 - e0) < 1e-8
    oof = cv.oof(df, "p")
    assert oof.count() == df.count()
    loop = oof_by_loop(df, lambda: Ridge(["x1", "x2"], "y", 1.0), out_col="q")
    both = oof.join(loop.select("id", "q"), "id")
    assert both.where(F.abs(F.col("p") - F.col("q")) > 1e-9).count() == 0


def test_folds_partition_ids(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    f = assign_folds(df, "k", 5, 42)
    assert f.select("k").distinct().count() == 1000
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 150


def test_simplex_weights(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(size=300)
    a = y + rng.normal(scale=0.5, size=300)
    b = y + rng.normal(scale=0.5, size=300)
    bad = rng.normal(size=300)
    rows = [(i, float(y[i]), float(a[i]), float(b[i]), float(bad[i]), float(a[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, y double, a double, b double, bad double, a2 double")
    w = SimplexBlend(["a", "b", "bad"], "y").fit(df).weights
    assert abs(sum(w) - 1) < 1e-12 and min(w) >= 0
    ptp, pty, yy, n = oof_cross_products(df, ["a", "b", "bad"], "y")
    obj = lambda ww: yy - 2 * np.dot(ww, pty) + ww @ ptp @ ww
    grid = [np.array([i, j, 200 - i - j]) / 200.0 for i in range(201) for j in range(201 - i)]
    assert obj(np.array(w)) <= min(obj(g) for g in grid) + 1e-9
    assert 0.3 < w[0] < 0.7 and 0.3 < w[1] < 0.7
    # identical models: any split is optimal, weights still valid
    w2 = simplex_least_squares(*oof_cross_products(df, ["a", "a2"], "y")[:3])
    assert abs(sum(w2) - 1) < 1e-12 and min(w2) >= 0


@pytest.mark.parametrize("seed", range(8))
def test_active_set_equals_all_supports(seed):
    rng = np.random.default_rng(seed)
    y = rng.normal(size=200)
    p = np.stack([y * rng.uniform(0.2, 1.3) + rng.normal(scale=rng.uniform(0.2, 1.5), size=200) for _ in range(6)], axis=1)
    if seed % 2:
        p[:, 4] = p[:, 1]        # identical models
    ptp, pty, yy = p.T @ p, p.T @ y, float(y @ y)
    obj = lambda w: yy - 2 * w @ pty + w @ ptp @ w
    a, b = simplex_by_active_set(ptp, pty), simplex_least_squares(ptp, pty, yy)
    assert abs(obj(a) - obj(b)) < 1e-8 * yy and abs(a.sum() - 1) < 1e-12 and a.min() >= 0
    if not seed % 2:
        assert np.abs(a - b).max() < 1e-7


def test_two_hundred_models(spark):
    """The KKT conditions hold: inside the support all slopes are equal, outside none is smaller."""
    rng = np.random.default_rng(1)
    y = rng.normal(size=600)
    p = y[:, None] * rng.uniform(0.3, 1.1, 200) + rng.normal(scale=0.8, size=(600, 200))
    cols = [f"m{k}" for k in range(200)]
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([p, y]), columns=[*cols, "y"]))
    ptp, pty, yy, n = oof_cross_products(df, cols, "y")
    assert n == 600 and np.allclose(ptp, p.T @ p) and np.allclose(pty, p.T @ y) and abs(yy - y @ y) < 1e-8
    w = np.array(SimplexBlend(cols, "y").fit(df).weights)
    slope = p.T @ (p @ w - y)
    inside = w > 1e-12
    assert abs(w.sum() - 1) < 1e-12 and w.min() >= 0 and 1 < inside.sum() < 200
    assert np.ptp(slope[inside]) < 1e-6 * np.abs(ptp).max() and slope[~inside].min() >= slope[inside].mean() - 1e-6 * np.abs(ptp).max()


def test_leave_one_out_with_three_hundred_features(spark):
    rng = np.random.default_rng(6)
    n, p = 900, 300
    x = rng.normal(size=(n, p)) * rng.uniform(0.5, 20, p) + rng.normal(size=p) * 5
    y = x[:, :10].sum(axis=1) + rng.normal(size=n)
    cols = [f"x{k}" for k in range(p)]
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=[*cols, "y"])).repartition(5)
    got = ridge_loo_mse(df, gram_sums(df, cols, "y")[None], cols, "y", [1.0, 50.0])
    xc, yc = x - x.mean(axis=0), y - y.mean()
    for a in (1.0, 50.0):
        hat = xc @ np.linalg.solve(xc.T @ xc + a * np.eye(p), xc.T)
        want = np.mean(((yc - hat @ yc) / (1 - 1 / n - np.diag(hat))) ** 2)
        assert abs(got[a] / want - 1) < 1e-8


def test_gram_drops_null_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (2.0, 4.0), (3.0, None)], "x double, y double")
    g = gram_sums(df, ["x"], "y")[None]
    assert g.n == 2
    b0, b = solve_ridge(g, 0.0)
    assert abs(b[0] - 2.0) < 1e-12 and abs(b0) < 1e-12


def test_nested_blend_weights_exclude_scored_fold(spark):
    from tabforge.operators.ensemble import nested_blend
    rng = np.random.default_rng(12)
    y = rng.normal(size=400)
    rows = [(i, i % 4, float(y[i]), float(y[i] + rng.normal(scale=0.4)), float(y[i] + rng.normal(scale=0.8)))
            for i in range(400)]
    df = spark.createDataFrame(rows, "id int, fold int, y double, a double, b double")
    out, weights = nested_blend(df, ["a", "b"], "y")
    for f, w in weights.items():
        direct = SimplexBlend(["a", "b"], "y").fit(df.where(F.col("fold") != f)).weights
        assert np.allclose(w, direct, atol=1e-12)
    r = out.where("id = 5").first()
    w = weights[r.fold]
    assert abs(r.blend - (w[0] * r.a + w[1] * r.b)) < 1e-12
