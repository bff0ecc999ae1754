"""Exact k-nearest-donor search over many columns by a cell index.

The search runs in the space of the columns that no donor lacks.  Donor rows
chosen by a hash are pivots; every donor belongs to the cell of its nearest
pivot, and the index keeps, per cell, the number of donors, the range of their
distances from the pivot and the range of every column.  The index is small
(``MAX_CELLS`` cells x columns) and goes to all tasks.

A receiver q and a donor d share at most the |Q| columns that q has, and among
them all index columns, so their nan-Euclidean distance obeys

    dist(q, d)^2 >= dims / |Q| * euclid(q, d)^2   (euclid over the index columns),

and every donor of a cell is at least as far from q, in euclid, as the cell's
box of column ranges, and as the triangle inequality says by the distance of q
from the pivot and the cell's range of distances.  A receiver visits the cells of
the nearest pivots until they hold k donors, then those that its k-th distance
leaves open by rising distance of their boxes, some more in each round, and is final when
no unvisited cell can hold a donor nearer than its k-th so far (or as near).
In a round the receivers and the donors of a cell are dealt into groups of
bounded size, each of which measures its pairs in arrays and keeps the k nearest
of every receiver; every round is checkpointed, so a lost executor redoes one
round.  Nothing is capped: past
``MAX_CELLS`` cells they hold more donors each.

``approximate_neighbours`` is the opt-in way by Spark's locality-sensitive
hashing; receivers that it leaves with fewer than k donors are searched
exactly.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import checkpoint_once, ensure_checkpoint_dir, ship_package

log = logging.getLogger(__name__)

MAX_CELLS = 16_384
DONORS_PER_CELL = 256
_BLOCK = 64          # receivers measured against all cells at once
_MORE = 4            # a round visits up to 4, 16, 64 ... cells
_FIRST = 8           # the first round looks at the cells of so many pivots
_SLACK = 1e-9        # relative room for rounding in the bounds
_ROUGH = 1e-12       # the same for squared distances by matrix product
GROUP_ROWS = 4_096   # receivers, and donors, that are measured against each other in one group
TASK_PAIRS = 50_000_000
TASK_ROWS = 20_000
_GROUP_CELLS = 1 << 18  # distances held at once


def squared_distance(cols: Sequence[str], n_dims: int) -> Column:
    """nan-Euclidean squared distance of q_<col> and d_<col>; null when no column is present in both."""
    present, total = F.lit(0), F.lit(0.0)
    for c in cols:
        q, d = F.col(f"q_{c}"), F.col(f"d_{c}")
        both = q.isNotNull() & d.isNotNull()
        present = present + both.cast("int")
        total = total + F.when(both, (q - d) * (q - d)).otherwise(F.lit(0.0))
    return F.when(present > 0, F.lit(float(n_dims)) / present * total)


@dataclass(frozen=True)
class CellIndex:
    """Pivots and cell summaries over ``cols``; cell j belongs to pivot j."""

    cols: tuple
    pivots: np.ndarray     # (cells, columns)
    count: np.ndarray      # donors of the cell
    low: np.ndarray        # (cells, columns) range of every column
    high: np.ndarray
    near: np.ndarray       # range of the distances from the pivot
    far: np.ndarray

    def pivot_distances(self, block: np.ndarray) -> np.ndarray:
        """Squared distances (rows, cells), column by column: the same bits however rows are batched."""
        out = np.zeros((len(block), len(self.pivots)))
        for c in range(block.shape[1]):
            d = block[:, c, None] - self.pivots[None, :, c]
            out += d * d
        return out

    def bounds(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower bounds of the squared distance to a donor of each cell, squared pivot distances)."""
        box = np.zeros((len(block), len(self.pivots)))
        for c in range(block.shape[1]):
            d = np.maximum(self.low[None, :, c] - block[:, c, None], block[:, c, None] - self.high[None, :, c])
            np.maximum(d, 0.0, out=d)
            box += d * d
        squared = self.pivot_distances(block)
        reach = np.sqrt(squared)
        ring = np.maximum(reach - self.far, self.near - reach) - _SLACK * (reach + self.far)
        return np.maximum(box, np.square(np.maximum(ring, 0.0))), squared

    def rough_distances(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(squared pivot distances by one matrix product, room for their rounding)."""
        size = (block * block).sum(axis=1)[:, None] + (self.pivots * self.pivots).sum(axis=1)[None, :]
        return np.maximum(size - 2.0 * (block @ self.pivots.T), 0.0), _ROUGH * size

    def within(self, block: np.ndarray, limit: np.ndarray, seen: list) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of the cells that may hold a donor within the squared ``limit`` of the row and that it has not ``seen``.

        Rows in order, the cells of a row by rising bound, then pivot distance.  Boxes are looked at only where the pivot says yes.
        """
        squared, room = self.rough_distances(block)
        least, most = np.sqrt(np.maximum(squared - room, 0.0)), np.sqrt(squared + room)
        ring = np.maximum(np.maximum(least - self.far, self.near - most) - _SLACK * (most + self.far), 0.0)
        open_ = ~(ring * ring > limit[:, None]) & (self.count > 0)
        at = np.repeat(np.arange(len(block)), [len(c) for c in seen])
        open_[at, np.concatenate([*seen, []]).astype(int)] = False
        row, cell = np.nonzero(open_)
        box = np.zeros(len(row))
        for c in range(block.shape[1]):
            x = block[row, c]
            d = np.maximum(np.maximum(self.low[cell, c] - x, x - self.high[cell, c]), 0.0)
            box += d * d
        near = ~(box > limit[row])
        row, cell, box = row[near], cell[near], box[near]
        order = np.lexsort((squared[row, cell], np.maximum(box, np.square(ring[row, cell])), row))
        return row[order], cell[order]

    def first_cells(self, block: np.ndarray, k: int) -> list:
        """Per row the cells of the nearest pivots, as many as hold k donors."""
        squared = self.rough_distances(block)[0]
        squared[:, self.count == 0] = np.inf
        some = min(_FIRST, squared.shape[1])
        near = np.argpartition(squared, some - 1, axis=1)[:, :some]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(squared, near, axis=1), axis=1), axis=1)
        held = np.cumsum(self.count[near], axis=1)
        need = np.minimum((held < k).sum(axis=1) + 1, min(some, int((self.count > 0).sum())))
        return [near[i, :n] for i, n in enumerate(need)]


def _vector(cols: Sequence[str], prefix: str) -> Column:
    return F.array(*[F.col(f"{prefix}{c}").cast("double") for c in cols])


def in_cells(rows: DataFrame, cols: Sequence[str], pivots: np.ndarray, prefix: str = "d_") -> DataFrame:
    """``rows`` with their cell (the nearest pivot, but for rounding) and their distance from its pivot."""
    index = CellIndex(tuple(cols), pivots, *[None] * 5)

    def nearest(vectors: pd.Series) -> pd.DataFrame:
        x = np.stack(vectors.to_numpy()).reshape(len(vectors), -1)
        cells, reach = np.empty(len(x), dtype=np.int32), np.zeros(len(x))
        for a in range(0, len(x), _BLOCK):
            cells[a:a + _BLOCK] = index.rough_distances(x[a:a + _BLOCK])[0].argmin(axis=1)
        for c in range(x.shape[1]):
            d = x[:, c] - pivots[cells, c]
            reach += d * d
        return pd.DataFrame({"cell": cells, "reach": np.sqrt(reach)})

    nearest.__annotations__ = {"vectors": pd.Series, "return": pd.DataFrame}
    hit = F.pandas_udf(nearest, "cell int, reach double")
    return rows.withColumn("_hit", hit(_vector(cols, prefix))).withColumn("cell", F.col("_hit.cell")).withColumn(
        "reach", F.col("_hit.reach")).drop("_hit")


def build_index(donors: DataFrame, cols: Sequence[str], per_cell: int = DONORS_PER_CELL,
                max_cells: int = MAX_CELLS) -> tuple[DataFrame, CellIndex]:
    """(donors with a column ``cell``, their index); ``donors`` has columns did and d_<col>, none of ``cols`` null."""
    ship_package(donors.sparkSession)
    vector = _vector(cols, "d_")
    distinct = donors.select(*[f"d_{c}" for c in cols]).distinct()
    cells = int(min(max_cells, max(1, -(-distinct.count() // per_cell))))
    # a bounded choice: one vector a cell, by a hash of the vector
    chosen = distinct.select(vector.alias("v")).orderBy(F.xxhash64("v"), "v").limit(cells).collect()
    pivots = np.array([r["v"] for r in chosen], dtype=float).reshape(-1, len(cols))
    dealt = donors.repartition(tasks_for(donors.sparkSession, donors.count(), TASK_ROWS), "did")
    placed = checkpoint_once(in_cells(dealt, cols, pivots))
    ranges = [f(F.col(f"d_{c}")).alias(f"{n}{k}") for k, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))]
    m = len(pivots)
    count, near, far = np.zeros(m, dtype=np.int64), np.zeros(m), np.zeros(m)
    low, high = np.zeros_like(pivots), np.zeros_like(pivots)
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("reach").alias("near"), F.max("reach").alias("far"),
                                        *ranges).collect():  # one row a cell
        j = r["cell"]
        count[j], near[j], far[j] = r["n"], r["near"], r["far"]
        low[j], high[j] = [r[f"lo{k}"] for k in range(len(cols))], [r[f"hi{k}"] for k in range(len(cols))]
    return placed.drop("reach"), CellIndex(tuple(cols), pivots, count, low, high, near, far)


def tasks_for(spark, work: int, most: int) -> int:
    """Tasks for ``work`` units: no more than ``most`` in one, and all cores where there is enough for them."""
    return max(1, min(spark.sparkContext.defaultParallelism, -(-int(work) // max(1, most // 16))), -(-int(work) // most))


def _next_cells(index: CellIndex, k: int, budget: int):
    """Pandas function: (index vector, scale, k-th squared distance, cells seen) -> cells to visit now."""
    def choose(v: pd.Series, scale: pd.Series, kth: pd.Series, seen: pd.Series) -> pd.Series:
        x, seen = np.stack(v.to_numpy()).reshape(len(v), -1), seen.to_list()
        kth = kth.to_numpy(dtype=float)
        limit = np.where(np.isnan(kth), np.inf, kth) * (1 + _SLACK) / (scale.to_numpy(dtype=float) * (1 - _SLACK))
        cells = []
        for a in range(0, len(x), _BLOCK):
            block, old = x[a:a + _BLOCK], seen[a:a + _BLOCK]
            if all(len(c) == 0 for c in old):
                cells += [c.tolist() for c in index.first_cells(block, k)]
                continue
            row, cell = index.within(block, limit[a:a + _BLOCK], old)
            start = np.searchsorted(row, np.arange(len(block) + 1))
            cells += [cell[start[i]:min(start[i + 1], start[i] + budget)].tolist() for i in range(len(block))]
        return pd.Series(cells)

    choose.__annotations__ = {"v": pd.Series, "scale": pd.Series, "kth": pd.Series, "seen": pd.Series, "return": pd.Series}
    return F.pandas_udf(choose, "array<int>")


def _matrix(table: pa.Table, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(values, presence), (rows, columns) each; a missing value is 0."""
    x = np.empty((table.num_rows, len(cols)), order="F")
    has = np.empty(x.shape, dtype=bool, order="F")
    for j, c in enumerate(cols):
        col = table.column(c)
        x[:, j], has[:, j] = pc.fill_null(col, 0.0).to_numpy(), pc.is_valid(col).to_numpy()
    return x, has


def _distances(q: np.ndarray, q_has: np.ndarray, d: np.ndarray, d_has: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(``squared_distance`` of every row of q to every row of d, to the same bits; whether a column is present in both)."""
    total = np.zeros((len(q), len(d)))
    for c in range(q.shape[1]):
        diff = q[:, c, None] - d[None, :, c]
        diff *= diff
        if not (q_has[:, c].all() and d_has[:, c].all()):
            diff[~(q_has[:, c, None] & d_has[None, :, c])] = 0.0
        total += diff
    present = q_has.astype(float) @ d_has.astype(float).T
    with np.errstate(divide="ignore", invalid="ignore"):
        return float(q.shape[1]) / present * total, present > 0   # where none is, 0 times infinity: not a number, the last of all


def _nearest_of_group(targets: Sequence[str], dist_cols: Sequence[str], k: int):
    """Arrow function: (some receivers, some donors) -> (qid, _t, d2, did, val) of the k nearest of these donors, none beyond ``_kth``."""
    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([left.schema.field("qid"), left.schema.field("_t"), ("d2", pa.float64()), right.schema.field("did"), ("val", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        donors = right.sort_by("did")   # equal distances: the smaller id, which is the smaller position
        q, q_has = _matrix(left, [f"q_{c}" for c in dist_cols])
        d, d_has = _matrix(donors, [f"d_{c}" for c in dist_cols])
        wanted, kth = left.column("_t").to_numpy(), left.column("_kth").to_pandas().to_numpy(dtype=float)
        whose, which, how_far, value = [], [], [], []
        for t in targets:
            c = list(dist_cols).index(t)
            rows, own = np.flatnonzero(wanted == t), np.flatnonzero(d_has[:, c])
            step = max(1, _GROUP_CELLS // max(1, len(own)))
            for a in range(0, len(rows) if len(own) else 0, step):
                r = rows[a:a + step]
                d2, meet = _distances(q[r], q_has[r], d[own], d_has[own])
                take = meet & ~(d2 > kth[r][:, None])
                if len(own) > k:
                    take &= ~(d2 > np.partition(d2, k - 1, axis=1)[:, k - 1, None])
                row, col = np.nonzero(take)
                order = np.lexsort((col, d2[row, col], row))
                row, col = row[order], col[order]
                first = np.arange(len(row)) - np.searchsorted(row, row) < k
                row, col = row[first], col[first]
                whose.append(r[row])
                which.append(own[col])
                how_far.append(d2[row, col])
                value.append(d[own[col], c])
        if not whose:
            return schema.empty_table()
        at, to = pa.array(np.concatenate(whose)), pa.array(np.concatenate(which))
        out = [left.column("qid").take(at), left.column("_t").take(at), pa.array(np.concatenate(how_far)), donors.column("did").take(to),
               pa.array(np.concatenate(value))]
        return pa.Table.from_arrays(out, schema=schema)

    return nearest


def _top_type(donors: DataFrame) -> str:
    return f"array<struct<d2:double,did:{dict(donors.dtypes)['did']},val:double>>"


def best_of(pairs: DataFrame, targets: Sequence[str], dist_cols: Sequence[str], k: int) -> DataFrame:
    """(qid, _t, new): the k nearest of the candidate pairs (receiver and donor columns side by side)."""
    value = F.lit(None).cast("double")
    for t in targets:
        value = F.when(F.col("_t") == t, F.col(f"d_{t}")).otherwise(value)
    cand = (pairs.withColumn("val", value).where(F.col("val").isNotNull())
            .withColumn("d2", squared_distance(dist_cols, len(dist_cols))).where(F.col("d2").isNotNull()))
    rank = F.row_number().over(Window.partitionBy("qid", "_t").orderBy("d2", "did"))
    return (cand.select("qid", "_t", "d2", "did", "val").withColumn("_r", rank).where(F.col("_r") <= k)
            .groupBy("qid", "_t").agg(F.sort_array(F.collect_list(F.struct("d2", "did", "val"))).alias("new")))


def _measured(visits: DataFrame, donors: DataFrame, index: CellIndex, visitors: dict, search, found_type: str, tasks: int) -> DataFrame:
    """What ``search`` finds for every visit of a cell.

    The receivers and the donors of a cell are dealt into groups of about ``GROUP_ROWS`` of each, by hashes of their
    keys, so a cell that many visit or that holds many donors is no large group.
    """
    shares = [(c, -(-n // GROUP_ROWS), -(-int(index.count[c]) // GROUP_ROWS)) for c, n in visitors.items()]
    shares = F.broadcast(visits.sparkSession.createDataFrame(shares, "cell int, _qs long, _ds long"))  # one row a cell
    key = ["cell", "_q", "_d"]
    q = visits.join(shares, "cell").select(*visits.columns, F.pmod(F.xxhash64("qid", "_t"), "_qs").alias("_q"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("_ds") - 1)).alias("_d"))
    d = donors.join(shares, "cell").select(*donors.columns, F.pmod(F.xxhash64("did"), "_ds").alias("_d"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("_qs") - 1)).alias("_q"))
    return q.repartition(tasks, *key).groupBy(*key).cogroup(d.repartition(tasks, *key).groupBy(*key)).applyInArrow(search, found_type)


def exact_neighbours(receivers: DataFrame, donors: DataFrame, index: CellIndex, targets: Sequence[str], dist_cols: Sequence[str],
                     k: int, stats: dict | None = None) -> DataFrame:
    """(qid, _t, top): the k nearest donors that have the target, with squared distance, donor id and value.

    receivers: (qid, _t, q_<col>...), no index column null; donors: as ``build_index`` returns them.
    ``stats``, when given, gets the number of rounds and of candidate pairs.
    """
    spark = receivers.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    q_cols, none = [f"q_{c}" for c in dist_cols], F.array().cast(_top_type(donors))
    present = F.lit(0)
    for c in q_cols:
        present = present + F.col(c).isNotNull().cast("int")
    search, tasks = _nearest_of_group(targets, dist_cols, k), tasks_for(spark, receivers.count(), TASK_ROWS)
    kinds = {**dict(receivers.dtypes), **dict(donors.dtypes)}
    found_type = f"qid {kinds['qid']}, _t string, d2 double, did {kinds['did']}, val double"
    pending = receivers.select("qid", "_t", *q_cols, (F.lit(float(len(dist_cols))) / present).alias("_scale"), F.lit(None).cast("double").alias("_kth"),
                               F.array().cast("array<int>").alias("_seen"), none.alias("top")).repartition(tasks, "qid", "_t")
    done, budget, pairs_seen = [], _MORE, 0
    while True:
        chosen = checkpoint_once(pending.withColumn("_cells", _next_cells(index, k, budget)(_vector(index.cols, "q_"), "_scale", "_kth", "_seen")))
        done.append(chosen.where(F.size("_cells") == 0).select("qid", "_t", "top"))
        going = chosen.where(F.size("_cells") > 0)
        visits = going.select("qid", "_t", *q_cols, "_kth", F.explode("_cells").alias("cell"))
        visitors = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}  # one row a cell
        if not visitors:
            break
        pairs = sum(n * int(index.count[c]) for c, n in visitors.items())
        pairs_seen += pairs
        found = _measured(visits, donors, index, visitors, search, found_type, tasks_for(spark, pairs, TASK_PAIRS))
        rank = F.row_number().over(Window.partitionBy("qid", "_t").orderBy("d2", "did"))
        best = (found.withColumn("_r", rank).where(F.col("_r") <= k).groupBy("qid", "_t")
                .agg(F.sort_array(F.collect_list(F.struct("d2", "did", "val"))).alias("new")).repartition(tasks, "qid", "_t"))
        joined = going.drop("_kth").repartition(tasks, "qid", "_t").join(best, ["qid", "_t"], "left")
        top = F.slice(F.sort_array(F.concat("top", F.coalesce("new", none))), 1, k)
        pending = (joined.withColumns({"top": top, "_seen": F.concat("_seen", "_cells")}).drop("new", "_cells")
                   .withColumn("_kth", F.when(F.size("top") >= k, F.element_at("top", -1)["d2"])))
        log.info("cell search: %d visits, %d pairs, up to %d cells each", sum(visitors.values()), pairs, budget)
        budget *= _MORE
    if stats is not None:
        stats.update(rounds=len(done), pairs=pairs_seen)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


# ------------------------------------------------------------------ approximate

RADIUS_SAMPLE = 500   # receivers searched exactly to learn how far k-th donors lie


def approximate_neighbours(receivers: DataFrame, donors: DataFrame, index: CellIndex, targets: Sequence[str], dist_cols: Sequence[str],
                           k: int, tables: int = 4, quantile: float = 0.95) -> DataFrame:
    """Like ``exact_neighbours``, from the pairs that ``BucketedRandomProjectionLSH`` finds within a radius.

    The radius covers ``quantile`` of the k-th distances of up to ``RADIUS_SAMPLE`` receivers (chosen by a hash of
    their id), which are searched exactly; buckets are two radii wide.  Receivers left with fewer than k donors go
    the exact way.
    """
    sample = receivers.orderBy(F.xxhash64("qid", "_t")).limit(RADIUS_SAMPLE)
    kth = exact_neighbours(sample, donors, index, targets, dist_cols, k).select(
        F.sqrt(F.element_at("top", -1)["d2"]).alias("d")).where("d is not null")
    radius = kth.agg(F.percentile("d", F.lit(quantile))).first()[0]
    if radius is None:
        return exact_neighbours(receivers, donors, index, targets, dist_cols, k)
    radius = max(float(radius), 1e-9)
    q_cols = [f"q_{c}" for c in dist_cols]
    q = receivers.withColumn("features", array_to_vector(_vector(index.cols, "q_")))
    d = donors.withColumn("features", array_to_vector(_vector(index.cols, "d_")))
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=2 * radius, numHashTables=tables, seed=42).fit(d)
    pairs = lsh.approxSimilarityJoin(q, d, radius, "euclid")
    flat = pairs.select(*[F.col(f"datasetA.{c}").alias(c) for c in ["qid", "_t", *q_cols]],
                        *[F.col(f"datasetB.{c}").alias(c) for c in donors.columns if c != "cell"])
    found = checkpoint_once(best_of(flat, targets, dist_cols, k))
    enough = found.where(F.size("new") >= k).select("qid", "_t", F.col("new").alias("top"))
    rest = receivers.join(enough.select("qid", "_t"), ["qid", "_t"], "left_anti")
    return enough.unionByName(exact_neighbours(rest, donors, index, targets, dist_cols, k))
