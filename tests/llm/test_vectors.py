"""Clustering and whitening against plain versions of the same definitions."""

import hashlib
import math
import random

import numpy as np
import pytest

from tabforge.llm import clustering, whitening
from tabforge.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, distance long, deviation long, whitened string, _codes int, _hit int, _got int"


def awkward(spark, dims=64, n=120, seed=3):
    """Repeated rows and ids, null ids, short, long, empty and null vectors, nulls, NaN, infinities, clashing columns."""
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.5) for _ in range(dims)]) for i in range(n)]
    rows += [rows[0], rows[0], (None, rows[3][1]), (None, rows[4][1]), (5, rows[6][1])]
    rows += [(900, None), (901, []), (902, [0.1] * (dims - 1)), (903, [0.1] * (dims + 1)), (904, [None] + [0.1] * (dims - 1)),
             (905, [math.nan] * dims), (906, [math.inf] + [0.0] * (dims - 1)), (907, [-math.inf] * dims)]
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, "w", 5, 6, 7) for i, v in rows], SCHEMA)


def kept(rows, dims=64):
    return [(i, v) for i, v in rows if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]


# ------------------------------------------------------------------ clustering

def lloyd(rows, k=16, rounds=3):
    """rows of (id, vector): [(id, cluster, distance)], centroids; every distance measured."""
    xs = [[math.floor(64 * c) for c in v] for _, v in rows]
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, hashlib.sha256(f"1:{rows[r][0]}".encode()).hexdigest(), xs[r]))
    cent = [xs[r] for r in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cent)) for x in xs]

    for _ in range(rounds):
        hits = assign()
        for j in range(len(cent)):
            members = [x for x, (_, h) in zip(xs, hits) if h == j]
            if members:
                cent[j] = [sum(col) // len(members) for col in zip(*members)]
    return [(i, j, d) for (i, _), (d, j) in zip(rows, assign())], cent


def report_of(rows):
    found, cent = lloyd(rows)
    per = {}
    for _, j, d in found:
        per[j] = per.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted(((i, j, d, per[j], sum(per.values()), sha[j]) for i, j, d in found), key=str)


def test_cluster_report_equals_every_distance_measured(spark):
    vectors = table(spark, SF, "embeddings")
    want = report_of([(r["vec_id"], r["embedding"]) for r in vectors.collect()])
    assert sorted((tuple(r) for r in clustering.cluster_report(vectors).collect()), key=str) == want


def test_cluster_awkward_rows_and_partitions(spark):
    vectors = awkward(spark)
    want = report_of(kept([(r["vec_id"], r["embedding"]) for r in vectors.collect()]))
    for frame in (vectors, vectors.repartition(9, "vec_id")):
        assert sorted((tuple(r) for r in clustering.cluster_report(frame).collect()), key=str) == want


def test_cluster_keeps_clashing_columns(spark):
    vectors = awkward(spark)
    found, cent, names = clustering.clustered(vectors)
    assert names == ("_cluster", "_distance") and len(cent) == 16
    assert found.columns == vectors.columns + list(names)
    assert {(r["cluster"], r["distance"], r["_codes"], r["_hit"]) for r in found.collect()} == {(2, 3, 5, 6)}


def test_cluster_empty_and_few(spark):
    vectors = awkward(spark)
    for none in (vectors.limit(0), vectors.where("vec_id >= 900")):
        report = clustering.cluster_report(none)
        assert report.count() == 0 and report.dtypes == clustering.cluster_report(vectors).dtypes
    few = vectors.where("vec_id in (1, 2, 3)")
    assert {r["distance"] for r in clustering.cluster_report(few).collect()} == {0}


def test_huge_components_are_held(spark):
    big = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.5] * 64)], "vec_id long, embedding array<double>")
    assert clustering.cluster_report(big).count() == 3


@pytest.mark.parametrize("seed", range(6))
def test_orchard_ties_copies_and_measured_distances(seed):
    """On a small grid nearly every vector has ties; equal centroids tie everywhere."""
    rng = np.random.default_rng(seed)
    cent = rng.integers(-2, 3, (12, 3))
    cent[5] = cent[2]
    x = rng.integers(-4, 5, (500, 3))
    got, best, measured = clustering.orchard(x, clustering.Neighbours.of(cent))
    d = ((x[:, None, :] - cent[None]) ** 2).sum(axis=2)
    assert (got == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert measured <= 500 * 12


def test_orchard_measures_few_of_far_apart_centroids():
    rng = np.random.default_rng(1)
    cent = np.stack([np.arange(100) * 1000, np.zeros(100, dtype=np.int64)], axis=1)
    x = cent[np.sort(rng.integers(0, 100, 400))] + rng.integers(-3, 4, (400, 2))
    got, _, measured = clustering.orchard(x, clustering.Neighbours.of(cent))
    assert (got == ((x[:, None] - cent[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert measured < 400 * 100 * 0.6


# ------------------------------------------------------------------ whitening

def plain_whitening(rows, k=32):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    z = (x - s // n) - (s % n) / n
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x], z @ u / np.sqrt(e), e / np.trace(v)


def compare_whitening(report, rows):
    n, deviation, white, explained = plain_whitening(rows)
    got = {}
    for r in report:
        got.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
        assert r["n"] == n and abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-8
    for j in range(white.shape[1]):
        mine = np.array([got[i, d][j + 1][0] for (i, _), d in zip(rows, deviation)])
        sign = np.sign(mine @ white[:, j])
        assert np.abs(mine * sign - white[:, j]).max() < 1e-7
    assert sum(len(v) for g in got.values() for v in g.values()) == len(rows) * white.shape[1]


def test_whitening_equals_lapack(spark):
    vectors = table(spark, SF, "embeddings")
    compare_whitening(whitening.whitening_report(vectors).collect(), [(r["vec_id"], r["embedding"]) for r in vectors.collect()])


def test_whitening_awkward_rows(spark):
    vectors = awkward(spark)
    rows = kept([(r["vec_id"], r["embedding"]) for r in vectors.collect()])
    compare_whitening(whitening.whitening_report(vectors.repartition(5, "vec_id")).collect(), rows)
    found, model, names = whitening.whitened(vectors)
    assert names == ("_deviation", "_whitened") and found.columns == vectors.columns + list(names)
    assert {(r["deviation"], r["whitened"], r["_codes"], r["_got"]) for r in found.collect()} == {(4, "w", 5, 7)}


def test_whitening_without_variance(spark):
    vectors = awkward(spark)
    same = spark.createDataFrame([(1, [0.5, 0.25])] * 5, "vec_id long, embedding array<double>")
    for none in (vectors.limit(0), vectors.where("vec_id >= 904"), same, same.limit(1)):
        assert whitening.whitening_report(none).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.5]) for i in range(10)], "vec_id long, embedding array<double>")
    report = whitening.whitening_report(line).collect()   # rank 1 of 3 dimensions
    assert {r["component"] for r in report} == {1} and len(report) == 10 and report[0]["identity_error"] < 1e-9


def test_deviation_is_exact_or_null():
    sums = (3 * 10 ** 13, 10 ** 13 + 1)
    model = whitening.Whitening(2, 10 ** 13, sums, np.ones(1), np.ones((2, 1)), 1.0)
    x = np.array([[3, 1], [4, 1]])
    assert model.deviation(x) == [1, None]  # n x - S = (0, -1) and (10^13, -1)


def spectrum(kind, n, rng):
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    if kind == "spread":
        return q, np.exp(rng.uniform(-12, 3, n))
    if kind == "clustered":
        return q, 1.0 + 1e-12 * rng.uniform(size=n)
    if kind == "pairs":
        return q, np.repeat(rng.uniform(0.1, 5, n // 2 + 1), 2)[:n]
    if kind == "low rank":
        return q, np.where(np.arange(n) < 3, 1.0 + np.arange(n), 0.0)
    return np.eye(n), rng.uniform(0, 1, n)  # diagonal already


@pytest.mark.parametrize("kind", ["spread", "clustered", "pairs", "low rank", "diagonal"])
@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_leading_eigenpairs(kind, n):
    q, e = spectrum(kind, n, np.random.default_rng(n))
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    k = min(n, 32)
    values, vectors = whitening.leading_eigenpairs(a, k)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    size = np.abs(e).max()
    assert np.abs(values - want).max() < 1e-13 * size * max(1, n)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * size * max(1, n)


def test_sturm_count_is_the_number_below():
    d, off = np.array([2.0, -1.0, 0.5, 3.0]), np.array([1.0, 0.0, 2.0])
    e = np.linalg.eigvalsh(np.diag(d) + np.diag(off, 1) + np.diag(off, -1))
    at = np.linspace(-4, 6, 41)
    assert (whitening.sturm_count(d, off, at) == (e[None] < at[:, None]).sum(axis=1)).all()
