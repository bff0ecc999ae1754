import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabforge.functions.exprs import yeo_johnson, yeo_johnson_inverse
from tabforge.operators.knn import KNNImputer
from tabforge.operators.power import YeoJohnson


def test_yeo_johnson_inverse_all_branches(spark):
    df = spark.createDataFrame([(-3.0,), (-0.5,), (0.0,), (0.7,), (12.0,)], "x double")
    for lam in (0.0, 1.0, 2.0, -1.3, 0.4, 3.1):
        back = df.select((yeo_johnson_inverse(yeo_johnson("x", lam), lam) - F.col("x")).alias("d")).collect()
        assert max(abs(r.d) for r in back) < 1e-9, lam


def _np_yj(x, lam):
    out = np.empty_like(x)
    p = x >= 0
    out[p] = np.log1p(x[p]) if abs(lam) < 1e-12 else ((x[p] + 1) ** lam - 1) / lam
    out[~p] = -np.log1p(-x[~p]) if abs(lam - 2) < 1e-12 else -((1 - x[~p]) ** (2 - lam) - 1) / (2 - lam)
    return out


def test_yeo_johnson_lambda_is_grid_argmax(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.lognormal(1.0, 0.8, 400), -rng.exponential(1.0, 50)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(3)
    est = YeoJohnson(["x"])
    m = est.fit(df)

    def ll(lam):
        return -len(x) / 2 * math.log(_np_yj(x, lam).var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))
    coarse = max(est.coarse_grid(), key=ll)
    fine = max(est.fine_grid(coarse), key=ll)
    assert abs(m.lambdas["x"] - fine) < 1e-12
    out = np.array([r.x for r in m.transform(df).collect()])
    assert abs(out.mean()) < 1e-9 and abs(out.std() - 1) < 1e-9


def test_yeo_johnson_constant_column(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "x double")
    m = YeoJohnson(["x"]).fit(df)
    assert m.lambdas["x"] == 1.0 and m.scale["x"] == 1.0


def _brute_knn(rows, dist_idx, target_idx, k):
    """Reference nan-euclidean KNN mean over donors, ties by id."""
    n_dims = len(dist_idx)
    out = {}
    for q in rows:
        if q[target_idx] is not None:
            continue
        cands = []
        for d in rows:
            if d[target_idx] is None:
                continue
            pres = [(q[j], d[j]) for j in dist_idx if q[j] is not None and d[j] is not None]
            if not pres:
                continue
            d2 = n_dims / len(pres) * sum((a - b) ** 2 for a, b in pres)
            cands.append((d2, d[0], d[target_idx]))
        cands.sort()
        top = cands[:k]
        out[q[0]] = sum(v for _, _, v in top) / len(top) if top else None
    return out


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(300):
        a = float(rng.integers(0, 40))          # duplicated anchor values -> distance ties
        b = None if i % 9 == 0 else float(rng.normal(50, 10))
        c = None if i % 4 == 0 else float(rng.integers(0, 3))
        rows.append((i, a, b, c))
    rows.append((900, 1000.0, None, None))      # far from every donor: needs the coarser levels
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    model = KNNImputer(["b", "c"], ["a", "b", "c"], "id", k=5, anchor="a").fit(df)
    got = {r.id: (r.b, r.c) for r in model.transform(df).collect()}
    for t_idx, pos in ((2, 0), (3, 1)):
        for qid, val in _brute_knn(rows, [1, 2, 3], t_idx, 5).items():
            assert abs(got[qid][pos] - val) < 1e-9, (qid, t_idx)


def test_knn_categorical_rounds_half_even_and_few_donors(spark):
    rows = [(1, 0.0, "p"), (2, 1.0, "q"), (3, 2.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, c string")
    model = KNNImputer(["c"], ["a", "c"], "id", k=5).fit(df)
    # codes p=0, q=1; the two donors average 0.5 -> half to even -> 0 -> "p"
    got = {r.id: r.c for r in model.transform(df).collect()}
    assert got[3] == "p"


def test_knn_with_many_copies_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        if i % 3 == 0:                              # a third of the rows are copies of one row
            rows.append((i, 7.0, 3.0 if i % 2 else None, 1.0 if i % 4 else None))
        else:
            rows.append((i, float(rng.integers(0, 20)), None if i % 5 == 0 else float(rng.normal(3, 2)),
                         None if i % 7 == 0 else float(rng.integers(0, 3))))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    model = KNNImputer(["b", "c"], ["a", "b", "c"], "id", k=5, anchor="a").fit(df)
    got = {r.id: (r.b, r.c) for r in model.transform(df).collect()}
    for t_idx, pos in ((2, 0), (3, 1)):
        for qid, val in _brute_knn(rows, [1, 2, 3], t_idx, 5).items():
            assert abs(got[qid][pos] - val) < 1e-9, (qid, t_idx)


def test_yeo_johnson_lambda_far_from_zero(spark):
    """Large positive values: extreme lambdas give tiny variances that must stay accurate."""
    rng = np.random.default_rng(9)
    x = rng.uniform(1000.0, 2000.0, 600)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(4)
    est = YeoJohnson(["x"])
    m = est.fit(df)

    def ll(lam):
        t = _np_yj(x, lam)
        return -len(x) / 2 * math.log(np.var(t)) + (lam - 1) * np.sum(np.log1p(x))
    coarse = max(est.coarse_grid(), key=ll)
    fine = max(est.fine_grid(coarse), key=ll)
    assert abs(m.lambdas["x"] - fine) < 1e-12


def test_knn_two_anchor_grid_matches_brute_force(spark):
    """Many distinct rows share one anchor value; the second anchor separates them."""
    rng = np.random.default_rng(21)
    rows = []
    for i in range(450):
        a = 5.0 if i % 3 == 0 else float(rng.normal(0, 10))     # a third share one value of a
        e = float(rng.normal(0, 8))                               # complete second column
        b = None if i % 6 == 1 else float(rng.normal(1, 3))
        c = None if i % 5 == 2 else float(rng.integers(0, 4))
        rows.append((i, a, e, b, c))
    df = spark.createDataFrame(rows, "id long, a double, e double, b double, c double")
    model = KNNImputer(["b", "c"], ["a", "e", "b", "c"], "id", k=5).fit(df)
    assert sorted(model.anchors) == ["a", "e"]
    got = {r.id: (r.b, r.c) for r in model.transform(df).collect()}
    for t_idx, pos in ((3, 0), (4, 1)):
        for qid, val in _brute_knn(rows, [1, 2, 3, 4], t_idx, 5).items():
            assert abs(got[qid][pos] - val) < 1e-9, (qid, t_idx)


def test_lambda_beyond_the_first_grid(spark):
    rng = np.random.default_rng(1)
    cols = {"high": np.power((0.5 + 0.05 * np.abs(rng.normal(size=2000))) * 9.0 + 1, 1 / 9.0) - 1,
            "low": np.power(np.clip(0.05 + 0.01 * rng.normal(size=2000), 0.001, 0.11) * -8.3 + 1, 1 / -8.3) - 1}
    df = spark.createDataFrame(pd.DataFrame(cols))
    lams = YeoJohnson(list(cols)).fit(df).lambdas

    def likelihood(x, lam):
        t = (np.power(x + 1, lam) - 1) / lam
        return -len(x) / 2 * np.log(t.var()) + (lam - 1) * np.log1p(x).sum()

    for c, x in cols.items():
        assert abs(lams[c]) > 5
        grid = lams[c] + np.arange(-2000, 2001) / 100.0 + 1e-7
        assert likelihood(x, lams[c]) >= max(likelihood(x, g) for g in grid) - 1e-4


def test_lambda_search_ends_where_the_transform_overflows(spark):
    """Most values at the upper end: the likelihood grows with lambda until the power overflows."""
    df = spark.createDataFrame([(7.0 if i % 10 else 1.0 + i % 60 / 10, float(i % 7)) for i in range(400)], "x double, y double").repartition(3)
    model = YeoJohnson(["x", "y"]).fit(df)
    assert all(math.isfinite(v) for v in model.lambdas.values())
    assert df.count() == model.transform(df).where("x is not null and x = x").count()


def test_fit_rows_of_one_split_are_dealt_before_they_are_sorted(spark, monkeypatch):
    """The search for copies sorts no more than SORT_ROWS rows of a large split in one task."""
    from tabforge.operators import knn
    monkeypatch.setattr(knn, "SORT_ROWS", 100)
    df = spark.range(0, 2000, 1, 1).select("id", (F.col("id") % 50).cast("double").alias("x"),
                                           F.when(F.col("id") % 7 != 3, (F.col("id") % 50) * 2.0).alias("v"))
    model = knn.KNNImputer(["v"], ["x", "v"], "id", k=3).fit(df)
    assert df.rdd.getNumPartitions() == 1 and model._dealt().rdd.getNumPartitions() >= 20
    assert all(abs(r["v"] - 2.0 * r["x"]) < 1e-9 for r in model.transform(df).collect())


def test_column_means_are_taken_once_for_all_grids(spark, monkeypatch):
    from tabforge.operators import power
    calls, means = [], power._means
    monkeypatch.setattr(power, "_means", lambda *a: calls.append(1) or means(*a))
    df = spark.range(300).select((F.col("id") % 23 + 1.0).alias("x"))
    assert -5 < YeoJohnson(["x"]).fit(df).lambdas["x"] < 5 and len(calls) == 1
