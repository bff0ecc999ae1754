import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabforge.operators import audit


def _frame(spark):
    rng = np.random.default_rng(2)
    n = 500
    a = rng.normal(size=n)
    pdf = pd.DataFrame({"a": a, "b": a * 2 + rng.normal(scale=0.1, size=n), "c": rng.exponential(size=n),
                        "d": np.where(np.arange(n) % 10 == 0, np.nan, rng.normal(size=n))})
    rows = [tuple(None if (isinstance(v, float) and np.isnan(v)) else float(v) for v in r)
            for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double"), pdf


def test_skew_and_target_summary(spark):
    df, pdf = _frame(spark)
    c = pdf["c"].to_numpy()
    m = c.mean()
    pop = ((c - m) ** 3).mean() / ((c - m) ** 2).mean() ** 1.5
    rep = {r.column: r for r in audit.skewness_report(df, ["c"]).collect()}
    assert abs(rep["c"].skew - pop) < 1e-9 and rep["c"].is_skewed
    s = audit.target_summary(df, "c").first()
    assert abs(s.skew - pdf["c"].skew()) < 1e-9
    assert abs(s.median - pdf["c"].median()) < 1e-12


def test_corr_pairs_and_missing(spark):
    df, pdf = _frame(spark)
    pairs = {(r.col_a, r.col_b): r.abs_corr for r in audit.corr_pairs(df, ["a", "b", "c", "d"]).collect()}
    ref = pdf.corr().abs()
    for (x, y), v in pairs.items():
        assert abs(v - ref.loc[x, y]) < 1e-9
    high = audit.high_corr_pairs(df, ["a", "b", "c", "d"], 0.8).collect()
    assert [(r.col_a, r.col_b) for r in high] == [("a", "b")]
    miss = {r.column: r.pct_missing for r in audit.missing_report(df).collect()}
    assert miss == {"d": 10.0}


def test_z_outliers_and_value_counts(spark):
    df, pdf = _frame(spark)
    z = {r.column: r.n_outliers for r in audit.z_outliers(df, ["c"], 3.0).collect()}
    c = pdf["c"]
    assert z["c"] == int((np.abs((c - c.mean()) / c.std(ddof=0)) > 3.0).sum())
    lv = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert audit.low_variance(lv, ["x"]).first().n_distinct == 2


def test_low_variance_of_long_columns_shuffles_no_values(spark):
    """Continuous columns are sketched; a dominant value among 20,000 others is counted exactly."""
    df = spark.range(60_000).select(F.col("id").alias("key"), (F.col("id") * 0.5).alias("x"), (F.col("id") % 7).alias("short"),
                                    F.when(F.col("id") % 3 == 0, F.lit(7.5)).otherwise(F.col("id").cast("double")).alias("heavy"),
                                    F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"), F.lit(None).cast("double").alias("void"))
    got = {r["column"]: r for r in audit.low_variance(df, ["key", "x", "short", "heavy", "text", "void"]).collect()}
    assert set(got) == {"key", "x", "short", "heavy", "text"}
    assert got["short"]["exact"] and got["short"]["n_distinct"] == 7 and abs(got["short"]["top_share"] - 8572 / 60_000) < 1e-12
    for c, n in (("key", 60_000), ("x", 60_000), ("heavy", 40_001), ("text", 60_000)):
        assert not got[c]["exact"] and abs(got[c]["n_distinct"] / n - 1) < 0.08
    assert abs(got["heavy"]["top_share"] - 20_000 / 60_000) < 1e-12
    assert got["x"]["top_share"] <= 1 / 60_000 + 1e-12


def test_density_by_boxes_equals_the_full_sum(spark):
    rng = np.random.default_rng(7)
    for x in (rng.normal(size=3000), np.exp(rng.normal(size=2000) * 2), np.round(rng.normal(size=500) * 3), np.append(rng.normal(size=400), 1e5)):
        df = spark.createDataFrame(pd.DataFrame({"x": x}))
        got = audit.kde_grid(df, "x", 150, 3.0).orderBy("grid_idx").toPandas()
        h = x.std(ddof=1) * len(x) ** -0.2
        want = np.exp(-0.5 * ((got.x.to_numpy()[:, None] - x[None]) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
        assert len(got) == (want > 0).sum() or len(got) >= (want > 1e-300).sum()
        assert np.abs(got.density.to_numpy() - want).max() < 4e-12 / (h * np.sqrt(2 * np.pi)) + 1e-15
