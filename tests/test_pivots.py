"""The cell index against brute force over every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import pivots
from tabforge.operators.knn import KNNImputer

D = 14


def wide_rows(n, seed, clusters=12, hot=True):
    """(id, 12 complete columns, two columns with nulls): clustered points, a third of them copies of one row."""
    rng = np.random.default_rng(seed)
    centres = np.round(rng.normal(0, 20, (clusters, 12)))  # whole numbers: ties are ties in any order of summing
    rows = []
    for i in range(n):
        x = centres[7 % clusters] if hot and i % 3 == 0 else centres[rng.integers(clusters)] + np.round(rng.normal(0, 2, 12))
        rows.append((i, *[float(v) for v in x], None if i % 5 == 1 else float(rng.integers(0, 9)), None if i % 7 == 2 else float(rng.integers(0, 3))))
    return rows


SCHEMA = "id long, " + ", ".join(f"x{c} double" for c in range(12)) + ", a double, b double"


def brute(rows, fit, k=5):
    """{(id, target): (mean, [d2 of the k nearest])} by every pair."""
    f = np.array([[np.nan if v is None else v for v in r[1:]] for r in fit], dtype=float)
    out = {}
    for r in rows:
        q = np.array([np.nan if v is None else v for v in r[1:]], dtype=float)
        for t, name in ((12, "a"), (13, "b")):
            if r[1 + t] is not None:
                continue
            both = ~np.isnan(f) & ~np.isnan(q)
            d2 = len(q) / np.maximum(1, both.sum(axis=1)) * np.where(both, (f - q) ** 2, 0.0).sum(axis=1)
            cand = sorted((d2[j], fit[j][0], f[j, t]) for j in range(len(fit)) if not np.isnan(f[j, t]) and both[j].any())[:k]
            out[r[0], name] = (sum(c[2] for c in cand) / len(cand) if cand else None, [c[0] for c in cand])
    return out


def imputed(model, df):
    return {r["id"]: (r["a"], r["b"]) for r in model.transform(df).collect()}


def check(got, want):
    for (i, name), (mean, _) in want.items():
        assert abs(got[i]["ab".index(name)] - mean) < 1e-9, (i, name)


@pytest.mark.parametrize("per_cell", [8, 64, 10_000])
def test_index_equals_every_pair(spark, per_cell):
    rows = wide_rows(600, per_cell)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5, "id")
    cols = SCHEMA.replace(" double", "").replace(" long", "").split(", ")[1:]
    model = KNNImputer(["a", "b"], cols, "id", donors_per_cell=per_cell).fit(df)
    assert len(model.index_cols) == 12
    check(imputed(model, df), brute(rows, rows))


def test_receivers_that_lack_index_columns_and_lie_far_away(spark):
    fit = wide_rows(400, 1)
    new = [list(r) for r in wide_rows(60, 2, hot=False)]
    for i, r in enumerate(new):
        r[0] += 1000
        if i % 4 == 0:
            r[1 + i % 12] = None            # lacks an index column: goes by the grid
        if i % 5 == 0:
            r[2 + i % 7] = 1e6              # far from every donor
    new = [tuple(r) for r in new]
    cols = SCHEMA.replace(" double", "").replace(" long", "").split(", ")[1:]
    model = KNNImputer(["a", "b"], cols, "id", donors_per_cell=16).fit(spark.createDataFrame(fit, SCHEMA))
    check(imputed(model, spark.createDataFrame(new, SCHEMA)), brute(new, fit))


def test_ties_at_the_bound_take_the_smaller_ids(spark):
    """Points of a lattice: many donors lie exactly as far as the k-th."""
    rng = np.random.default_rng(5)
    rows = [(i, *[float(v) for v in rng.integers(0, 2, 12)], None if i % 6 == 0 else float(i), 1.0) for i in range(500)]
    cols = SCHEMA.replace(" double", "").replace(" long", "").split(", ")[1:]
    model = KNNImputer(["a"], cols, "id", donors_per_cell=10).fit(spark.createDataFrame(rows, SCHEMA))
    check(imputed(model, spark.createDataFrame(rows, SCHEMA)), brute(rows, rows))


def test_fewer_donors_than_k_and_no_donor(spark):
    rows = [(i, *[float(i)] * 12, 3.0 if i < 2 else None, None) for i in range(9)]
    cols = SCHEMA.replace(" double", "").replace(" long", "").split(", ")[1:]
    got = imputed(KNNImputer(["a", "b"], cols, "id").fit(spark.createDataFrame(rows, SCHEMA)), spark.createDataFrame(rows, SCHEMA))
    assert all(v == (3.0, None) for v in got.values())


def test_bounds_never_exceed_the_nearest_donor():
    rng = np.random.default_rng(3)
    x, p = rng.normal(size=(400, 9)), rng.normal(size=(20, 9))
    index = pivots.CellIndex(tuple("c"), p, *[None] * 5)
    cell = index.pivot_distances(x).argmin(axis=1)
    part = [x[cell == j] for j in range(20)]
    reach = [np.sqrt(((m - p[j]) ** 2).sum(axis=1)) for j, m in enumerate(part)]
    has = [j for j in range(20) if len(part[j])]
    full = pivots.CellIndex(tuple("c"), p[has], np.array([len(part[j]) for j in has]), np.array([part[j].min(axis=0) for j in has]),
                            np.array([part[j].max(axis=0) for j in has]), np.array([reach[j].min() for j in has]), np.array([reach[j].max() for j in has]))
    q = rng.normal(size=(50, 9)) * 2
    bound, _ = full.bounds(q)
    for i in range(50):
        for n, j in enumerate(has):
            assert bound[i, n] <= ((part[j] - q[i]) ** 2).sum(axis=1).min() * (1 + 1e-9)


def _pairs_per_receiver(spark, n):
    rng = np.random.default_rng(n)
    latent = rng.uniform(0, 100, (n, 2))     # the 12 columns lie near a plane, as the columns of real tables do
    mix = np.random.default_rng(0).normal(size=(2, 12))
    x = latent @ mix + rng.normal(0, 0.5, (n, 12))
    rows = [(i, *[float(v) for v in x[i]], None if i % 20 == 0 else 1.0, 1.0) for i in range(n)]
    cols = SCHEMA.replace(" double", "").replace(" long", "").split(", ")[1:]
    df = spark.createDataFrame(rows, SCHEMA)
    model = KNNImputer(["a"], cols, "id", donors_per_cell=32).fit(df)
    enc = model._encode(df)
    receivers = enc.where("a is null").select(F.col("id").alias("qid"), F.lit("a").alias("_t"), *[F.col(c).alias(f"q_{c}") for c in cols])
    stats = {}
    model._by_index(receivers, ["a"], stats).count()
    return stats["pairs"] / receivers.count()


def test_candidates_do_not_grow_with_the_donors(spark):
    small, large = _pairs_per_receiver(spark, 1500), _pairs_per_receiver(spark, 6000)
    assert large < 1.3 * small and large < 600


def test_approximate_search_recalls_nine_of_ten(spark):
    rows = wide_rows(1500, 9, clusters=20, hot=False)
    df = spark.createDataFrame(rows, SCHEMA)
    cols = SCHEMA.replace(" double", "").replace(" long", "").split(", ")[1:]
    model = KNNImputer(["a", "b"], cols, "id", search="approximate", donors_per_cell=32).fit(df)
    receivers = model._encode(df).where("a is null").select(F.col("id").alias("qid"), F.lit("a").alias("_t"), *[F.col(c).alias(f"q_{c}") for c in cols])
    donors, index = model.cell_index()
    near = pivots.approximate_neighbours(receivers, donors, index, ["a"], model.dist_cols, 5).collect()
    want = brute(rows, rows)
    hits = sum(sum(t["d2"] <= want[r["qid"], "a"][1][-1] * (1 + 1e-9) for t in r["top"]) for r in near)
    assert len(near) == receivers.count() and hits / (5 * len(near)) >= 0.9
    assert all(v is not None for pair in imputed(model, df).values() for v in pair)


def test_codes_beyond_the_literal_map_are_joined(spark):
    rows = [(i, f"level {i % 300:03d}" if i % 9 else None, float(i % 300), 0.0) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, c string, x double, y double")
    model = KNNImputer(["c"], ["c", "x", "y"], "id", k=2).fit(df)
    assert not isinstance(model.codes["c"], dict)
    for r in model.transform(df).collect():
        if rows[r["id"]][1] is None:   # its copies, 300 rows away, carry the level
            same = [rows[j][1] for j in range(r["id"] % 300, 900, 300) if rows[j][1]]
            assert not same or r["c"] == same[0]
        else:
            assert r["c"] == rows[r["id"]][1]


def test_a_cell_is_dealt_into_bounded_groups(spark, monkeypatch):
    """Receivers and donors of a cell meet in groups, each pair of them in exactly one; results stay those of every pair."""
    import pyarrow as pa
    monkeypatch.setattr(pivots, "GROUP_ROWS", 20)
    donors = spark.range(300).select(F.col("id").alias("did"), F.lit(0).alias("cell"))
    visits = spark.range(1000, 1150).select(F.col("id").alias("qid"), F.lit("a").alias("_t"), F.lit(0).alias("cell"))
    index = pivots.CellIndex(("x",), np.zeros((1, 1)), np.array([300]), *[None] * 4)

    def sizes(left, right):
        return pa.table({"q": pa.array([left.num_rows], pa.int64()), "d": pa.array([right.num_rows], pa.int64())})

    met = pivots._measured(visits, donors, index, {0: 150}, sizes, "q long, d long", 4).collect()
    assert sum(r["q"] * r["d"] for r in met) == 300 * 150 and max(max(r) for r in met) < 60
    rows = wide_rows(300, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    cols = SCHEMA.replace(" double", "").replace(" long", "").split(", ")[1:]
    check(imputed(KNNImputer(["a", "b"], cols, "id").fit(df), df), brute(rows, rows))
