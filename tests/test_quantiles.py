import numpy as np
from pyspark.sql import functions as F

from tabforge.functions.quantiles import exact_quantiles


def test_grouped_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    rows = []
    # a hot group holding most rows, many duplicates, a single-row group, an all-null group
    for i in range(3000):
        g = "hot" if i % 3 else f"g{i % 7}"
        v = float(rng.integers(0, 50)) if i % 2 else float(rng.normal())
        rows.append((i, g, v))
    rows.append((9001, "single", 4.5))
    rows.append((9002, "nulls", None))
    df = spark.createDataFrame(rows, "id long, g string, v double")
    got = {(r["g"], r["prob"]): r["value"]
           for r in exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.75, 1.0], ["g"], num_partitions=6).collect()}
    by = {}
    for _, g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    for g, vals in by.items():
        for p in (0.0, 0.25, 0.5, 0.75, 1.0):
            assert abs(got[(g, p)] - float(np.percentile(vals, p * 100))) < 1e-9, (g, p)
    assert not any(k[0] == "nulls" for k in got)


def test_multi_column_ungrouped(spark):
    df = spark.createDataFrame([(float(i), float(i % 4)) for i in range(11)], "a double, b double")
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, ["a", "b"], [0.5, 0.9]).collect()}
    assert got[("a", 0.5)] == 5.0
    assert abs(got[("a", 0.9)] - np.percentile(np.arange(11.0), 90)) < 1e-12
    assert got[("b", 0.5)] == float(np.median([i % 4 for i in range(11)]))


import pytest  # noqa: E402

import tabforge.functions.quantiles as Q  # noqa: E402


@pytest.mark.parametrize("accuracy", [10000, 20])
def test_band_path_matches_numpy(spark, accuracy):
    """Sketch and band against numpy; a coarse sketch makes the band wide."""
    rng = np.random.default_rng(8)
    rows = [(i, "hot" if i % 4 else "cold", float(rng.integers(0, 30)) if i % 3 else float(rng.normal()))
            for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["value"] for r in Q.exact_quantiles(df, ["v"], probs, ["g"], accuracy=accuracy).collect()}
    for g in ("hot", "cold"):
        vals = [v for _, gg, v in rows if gg == g]
        for p in probs:
            assert abs(got[(g, p)] - float(np.percentile(vals, p * 100))) < 1e-9, (g, p)


def test_band_path_hot_duplicate_value(spark):
    """A third of the values are one number and the median falls inside that run."""
    rng = np.random.default_rng(10)
    vals = [42.0 if i % 3 == 0 else float(rng.normal(42, 5)) for i in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    probs = [0.3, 0.5, 0.7]
    got = {r["prob"]: r["value"] for r in Q.exact_quantiles(df, ["v"], probs).collect()}
    for p in probs:
        assert abs(got[p] - float(np.percentile(vals, p * 100))) < 1e-9, p
    assert got[0.5] == 42.0


def test_null_group_and_missed_bracket(spark, monkeypatch):
    """A null group is a group of its own; a bracket that misses its rank is widened."""
    rng = np.random.default_rng(11)
    rows = [("a" if i % 2 else None, float(rng.normal())) for i in range(500)] + [("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    real = Q.F.percentile_approx
    monkeypatch.setattr(Q.F, "percentile_approx", lambda c, p, a: real(c, [0.9] * len(p), a))  # every bracket is wrong
    got = {r["g"]: r["value"] for r in Q.exact_quantiles(df, ["v"], [0.5], ["g"]).collect()}
    assert set(got) == {"a", None}
    for g in got:
        assert abs(got[g] - float(np.median([v for x, v in rows if x == g]))) < 1e-12


@pytest.mark.parametrize("local", [True, False])
@pytest.mark.parametrize("grouped", [True, False])
def test_narrowing_by_bins_matches_numpy(spark, grouped, local, monkeypatch):
    """A band above the bound is narrowed by exact bin counts: extremes, ties, infinities, a wide range of sizes."""
    if not local:
        monkeypatch.setattr(Q, "MAX_LOCAL_GROUPS", 0)   # tables of groups are checkpointed and joined
    rng = np.random.default_rng(12)
    vals = [float(v) for v in np.concatenate([np.exp(rng.uniform(-300, 300, 1500)), -np.exp(rng.uniform(-30, 30, 900)), np.full(700, 3.5),
                                              [np.inf, -np.inf, 0.0, -0.0]])]
    df = spark.createDataFrame([("a" if i % 3 else None, v) for i, v in enumerate(vals)], "g string, v double")
    probs = [0.0, 0.01, 0.37, 0.5, 0.7, 0.99, 1.0]
    got = {(r["g"] if grouped else 0, r["prob"]): r["value"]
           for r in Q.exact_quantiles(df, ["v"], probs, ["g"] if grouped else [], accuracy=20, max_band=5).collect()}
    for g in (("a", None) if grouped else (0,)):
        own = np.sort([v for i, v in enumerate(vals) if not grouped or ("a" if i % 3 else None) == g])
        for p in probs:
            h = p * (len(own) - 1)
            lo, hi = own[int(np.floor(h))], own[int(np.ceil(h))]
            want = lo if lo == hi else lo + (h - np.floor(h)) * (hi - lo)
            assert got[g, p] == want or abs(got[g, p] - want) <= 1e-12 * abs(want), (g, p)


def test_few_jobs(spark):
    """The number of Spark actions does not grow with columns or probs."""
    df = spark.range(5000).select(*[(F.col("id") * (k + 1) % 997).cast("double").alias(f"c{k}") for k in range(6)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quantile jobs", "")
    Q.exact_quantiles(df, [f"c{k}" for k in range(6)], [0.25, 0.5, 0.75]).collect()
    jobs = len(tracker.getJobIdsForGroup("quantile jobs"))
    spark.sparkContext.setJobGroup("other", "")
    assert jobs <= 8
