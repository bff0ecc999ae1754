"""Centroid clustering (Lloyd's rounds) with Orchard's nearest-centroid search.

Vectors are integer codes floor(64 * c), so distances, sums and means are
exact and do not depend on how rows are spread over tasks.  Every centroid has
the list of the other centroids sorted by distance from it.  The search of a
vector walks the list of its current centroid; a centroid that is nearer (or
as near with a smaller number) becomes the current one and its list is walked
from the start; centroids already measured are marked and not measured again;
the walk stops at the first list entry strictly beyond twice the current
distance, as the triangle inequality puts it and all later ones strictly
farther from the vector than the current centroid.

A round is one scan: an Arrow function searches for the rows of a batch
together, and one aggregate (16 rows a task) adds counts and component sums.
The driver sees k x dims numbers a round.  Only the centroids and their lists
travel to the tasks: k is bounded by ``MAX_CENTROIDS``.

Defined cases: vectors that are null, of another length, or hold nulls, NaN or
infinities are dropped; an empty table, or one without a kept vector, gives an
empty result; fewer kept vectors than k give that many centroids.  Rows are
clustered one by one, repeated rows included; rows with equal ids start as
centroids in the order of their components, null ids after all others.  Products
64 * c beyond ``bound_of(dims)`` are held there, so that squared distances fit a
long.  Extra columns stay; ``cluster`` and ``distance`` get underscores in
front where the table has such columns.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.session import ship_package

from .common import fresh, written
from .vectors import codes, is_finite, matrix

CLUSTERS = 16
ROUNDS = 3
DIMS = 64
MAX_CENTROIDS = 2048  # the neighbour lists of so many take 64 MB


def bound_of(dims: int) -> float:
    """Largest component with which 4 x a squared distance fits a long."""
    return float(int((2.0 ** 60 / max(1, dims)) ** 0.5 / 2))


@dataclass(frozen=True)
class Neighbours:
    """Centroids and, for each, the others by rising squared distance."""

    centroids: np.ndarray   # (k, dims)
    order: np.ndarray       # (k, k - 1) centroid numbers
    gap: np.ndarray         # (k, k - 1) their squared distances

    @staticmethod
    def of(centroids: np.ndarray) -> Neighbours:
        k = len(centroids)
        order = np.empty((k, max(0, k - 1)), dtype=np.int64)
        gap = np.empty_like(order)
        for c in range(k):
            d = ((centroids - centroids[c]) ** 2).sum(axis=1)
            others = [j for j in np.lexsort((np.arange(k), d)) if j != c]
            order[c], gap[c] = others, d[others]
        return Neighbours(centroids, order, gap)


def orchard(x: np.ndarray, near: Neighbours) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of every row of ``x``, and how many distances were measured."""
    n, k = len(x), len(near.centroids)
    current = np.zeros(n, dtype=np.int64)
    best = ((x - near.centroids[0]) ** 2).sum(axis=1)
    marked = np.zeros((n, k), dtype=bool)
    marked[:, 0] = True
    at = np.zeros(n, dtype=np.int64)        # position in the list of the current centroid
    walking, measured = np.arange(n), n
    while walking.size and k > 1:
        walking = walking[at[walking] < k - 1]
        c, p = current[walking], at[walking]
        within = near.gap[c, p] <= 4 * best[walking]  # squared: strictly beyond twice the distance stops
        walking = walking[within]
        j = near.order[c[within], p[within]]
        at[walking] += 1
        unseen = ~marked[walking, j]
        rows, j = walking[unseen], j[unseen]
        marked[rows, j] = True
        d = ((x[rows] - near.centroids[j]) ** 2).sum(axis=1)
        measured += len(rows)
        closer = (d < best[rows]) | ((d == best[rows]) & (j < current[rows]))
        jump = rows[closer]
        current[jump], best[jump], at[jump] = j[closer], d[closer], 0
    return current, best, measured


def _searcher(near: Neighbours):
    """Arrow function: codes -> struct(cluster, distance)."""
    dims = near.centroids.shape[1]

    def search(v: pa.Array) -> pa.Array:
        cluster, distance, _ = orchard(matrix(v, dims), near)
        return pa.StructArray.from_arrays([pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["cluster", "distance"])

    search.__annotations__ = {"v": pa.Array, "return": pa.Array}
    return F.arrow_udf(search, "struct<cluster:int,distance:bigint>")


def coded(df: DataFrame, vector: str, dims: int, name: str) -> DataFrame:
    """The kept rows with their codes in column ``name``."""
    v = F.col(vector)
    kept = df.filter((F.size(v) == dims) & is_finite(v))
    return kept.withColumn(name, codes(v, bound_of(dims)))


def first_centroids(rows: DataFrame, id_col: str, x: str, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:id``, in that order: a top-k, at most k rows a task."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    top = rows.select(key.alias("key"), F.col(x).alias("x")).orderBy(F.asc_nulls_last("key"), "x").limit(k).collect()
    return np.array([r["x"] for r in top], dtype=np.int64)


def next_centroids(rows: DataFrame, x: str, centroids: np.ndarray) -> np.ndarray:
    """Exact floor(sum / count) of every cluster's vectors; an empty cluster keeps its centroid."""
    k, dims = centroids.shape
    search = _searcher(Neighbours.of(centroids))
    found = rows.select(F.col(x).alias("x")).withColumn("hit", search("x"))
    sums = [F.sum(F.col("x")[i].cast("decimal(38,0)") if dims > 1024 else F.col("x")[i]).alias(f"s{i}") for i in range(dims)]
    out = centroids.copy()
    for r in found.groupBy(F.col("hit.cluster").alias("c")).agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # k rows
        out[r["c"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
    return out


def fit(rows: DataFrame, id_col: str, x: str, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "1") -> np.ndarray:
    """The centroids (k, dims) after ``rounds`` rounds; no row when there is no vector."""
    if not 1 <= k <= MAX_CENTROIDS:
        raise ValueError(f"k must be from 1 to {MAX_CENTROIDS}")
    ship_package(rows.sparkSession)
    centroids = first_centroids(rows, id_col, x, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(rows, x, centroids)
    return centroids


def clustered(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dims: int = DIMS, k: int = CLUSTERS,
              rounds: int = ROUNDS, seed: str = "1") -> tuple[DataFrame, np.ndarray, tuple[str, str]]:
    """The kept rows of ``df`` with their cluster and squared distance, the centroids, and the two columns' names."""
    x, cluster, distance = fresh(df, "_codes"), fresh(df, "cluster"), fresh(df, "distance")
    rows = coded(df, vector, dims, x)
    centroids = fit(rows, id_col, x, k, rounds, seed)
    if not len(centroids):
        none = rows.filter(F.lit(False)).drop(x)
        return none.withColumns({cluster: F.lit(None).cast("int"), distance: F.lit(None).cast("long")}), centroids, (cluster, distance)
    hit = fresh(rows, "_hit")
    found = rows.withColumn(hit, _searcher(Neighbours.of(centroids))(x))
    found = found.withColumns({cluster: F.col(f"{hit}.cluster"), distance: F.col(f"{hit}.distance")}).drop(x, hit)
    return found, centroids, (cluster, distance)


_PER_CLUSTER = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
                             T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())])


def cluster_report(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    found, centroids, (cluster, distance) = clustered(vectors.select("vec_id", "embedding"))
    narrow = found.select("vec_id", F.col(cluster).alias("cluster"), F.col(distance).alias("distance"))
    narrow = written(narrow, "cluster-report")
    sums = narrow.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    per = {r["cluster"]: int(r["s"]) for r in sums}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = [(c, s, sum(per.values()), sha[c]) for c, s in sorted(per.items())]
    facts = F.broadcast(vectors.sparkSession.createDataFrame(table, _PER_CLUSTER))  # at most k rows
    return narrow.join(facts, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
