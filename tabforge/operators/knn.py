"""Exact k-nearest-neighbour imputation over mixed columns, without a cross join.

Distance (nan-Euclidean): d^2 = (D / present) * sum over coordinates present in
both rows of (a - b)^2, D = number of distance columns.  String columns are
coded 0.. by first appearance (order of the id column) before the distance.
A receiver (row with the target null) takes the mean of its k nearest donors
(fit rows with the target present; ties broken by donor id); categorical
targets round the mean code half-to-even and decode it.

Many columns.  Where more columns are complete than the grid has anchors, the
search goes by the cell index over all of them (``operators/pivots.py``); a
receiver that lacks one of those columns goes by the grid below.

Few columns.  One "anchor" column that is never null bounds the distance from
below: |anchor_q - anchor_d| <= d(q, d).  Donors and receivers are bucketed on
the anchor; level L uses bucket width w * 2^L and each pending receiver is
equi-joined with the donors of its own and the two neighbouring buckets.  A
receiver is final when its k-th candidate distance is below the gap to the
edge of that 3-bucket band (no donor outside can be closer), or when the band
covers every donor.  An unresolved receiver moves toward the level whose
width exceeds its current k-th distance (where it would be final), by at most
4x per round (each round is checkpointed, so lineage stays short and a lost
executor only redoes one round).  Copies are collapsed first: identical receivers are
searched once, and of identical donors only the k smallest ids (the only
ones any receiver can pick) take part.  Every level is exact; nothing is
capped or sampled.  A hot bucket
is split by AQE's skew-join handling.
"""

from __future__ import annotations

import itertools
import logging
import math
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.exprs import code_map
from tabforge.operators import pivots
from tabforge.operators.base import MAX_LITERAL_ENTRIES, ColumnEstimator, ColumnModel, checked_broadcast
from tabforge.operators.encode import first_appearance_codes
from tabforge.session import checkpoint_once, ensure_checkpoint_dir

log = logging.getLogger(__name__)


def knn_mean(receivers: DataFrame, donors: DataFrame, dist_cols: Sequence[str], anchors: Sequence[str],
             k: int, widths: Sequence[float], los: Sequence[float], his: Sequence[float],
             max_rounds: int = 64) -> DataFrame:
    """Exact k-nearest mean per (receiver, target) in long form.

    receivers: (qid, _t, q_<col>...)   one row per receiver and target column it lacks
    donors:    (did, _t, _val, d_<col>...) one row per fit row and target column it has
    Returns (qid, _t, knn_value, n_neighbours).

    Anchors are complete columns; cells are anchor buckets of width
    ``widths[j] * 2**level``.  A receiver's box is its cell plus the neighbouring
    cells (3^m of them).  A donor outside the box differs by more than the box
    margin in some anchor, so it is farther than the margin.  After a round, a
    receiver that is not final but has k candidates moves toward the first level
    whose smallest cell width exceeds its current k-th distance (an upper bound
    of the true one), by at most two levels per round; one with fewer than k
    candidates doubles its cells.
    """
    ensure_checkpoint_dir(receivers.sparkSession)
    m = len(anchors)
    qa = [F.col(f"q_{a}") for a in anchors]
    da = [F.col(f"d_{a}") for a in anchors]
    q_cols = [f"q_{c}" for c in dist_cols]
    top_level = max(int(math.ceil(math.log2(max(h - lo, w) / w))) for w, lo, h in zip(widths, los, his)) + 1
    min_width = min(widths)
    offsets = list(itertools.product((-1, 0, 1), repeat=m))
    bb = [f"_bb{j}" for j in range(m)]
    done = []
    pending = receivers.withColumn("_lv", F.lit(0))
    levels = [0]
    for rnd in range(max_rounds):
        t0 = time.perf_counter()
        scale = F.pow(F.lit(2.0), F.col("_lv"))
        qb = pending
        for j in range(m):
            qb = qb.withColumn(f"_w{j}", F.lit(widths[j]) * scale).withColumn(
                f"_b{j}", F.floor(qa[j] / F.col(f"_w{j}")).cast("long"))
        cells = F.array(*[F.struct(*[(F.col(f"_b{j}") + o[j]).alias(bb[j]) for j in range(m)]) for o in offsets])
        qx = qb.withColumn("_cell", F.explode(cells)).select("*", *[F.col(f"_cell.{c}").alias(c) for c in bb]).drop("_cell")
        db = donors.withColumn("_lv", F.explode(F.array(*[F.lit(lv) for lv in levels])))
        for j in range(m):
            db = db.withColumn(bb[j], F.floor(da[j] / (F.lit(widths[j]) * F.pow(F.lit(2.0), F.col("_lv")))).cast("long"))
        cand = qx.join(db, ["_t", "_lv", *bb]).withColumn("_d2", pivots.squared_distance(dist_cols, len(dist_cols))).where(
            F.col("_d2").isNotNull())
        rank = F.row_number().over(Window.partitionBy("qid", "_t").orderBy("_d2", "did"))
        top = cand.withColumn("_r", rank).where(F.col("_r") <= k)
        agg = top.groupBy("qid", "_t").agg(F.avg("_val").alias("knn_value"),
                                           F.count(F.lit(1)).alias("n_neighbours"), F.max("_d2").alias("_dk2"))
        gaps, covers = [], F.lit(True)
        for j in range(m):
            w = F.col(f"_w{j}")
            edge_lo = (F.col(f"_b{j}") - 1) * w
            edge_hi = (F.col(f"_b{j}") + 2) * w
            gaps.append(F.least(qa[j] - edge_lo, edge_hi - qa[j]) - F.lit(1e-9) * (F.abs(qa[j]) + w))
            covers = covers & (edge_lo <= F.lit(los[j])) & (edge_hi > F.lit(his[j]))
        margin = gaps[0] if m == 1 else F.least(*gaps)
        n_ok = F.coalesce(F.col("n_neighbours"), F.lit(0)) >= k
        dk = F.sqrt(F.col("_dk2"))
        jump = F.floor(F.log2(dk * F.lit(1.0 + 1e-6) / F.lit(min_width))).cast("int") + 1
        # grow at most 4x per round: the bound from a narrow box can be loose, and a box
        # far wider than needed would pull in many more candidates than the exact answer needs
        nxt = F.least(F.lit(top_level), F.col("_lv") + 2,
                      F.when(n_ok, F.greatest(F.col("_lv") + 1, jump)).otherwise(F.col("_lv") + 1))
        status = (qb.join(agg, ["qid", "_t"], "left")
                  .withColumn("_final", covers | (n_ok & (dk < margin)))
                  .withColumn("_next", nxt))
        status = checkpoint_once(status)
        done.append(status.where("_final").select("qid", "_t", "knn_value", "n_neighbours"))
        pending = status.where(~F.col("_final")).select("qid", "_t", *q_cols, F.col("_next").alias("_lv"))
        levels = sorted(r["_lv"] for r in pending.select("_lv").distinct().collect())
        log.info("knn round %d: %d receivers pending at levels %s, %.2fs", rnd,
                 pending.count() if levels else 0, levels, time.perf_counter() - t0)
        if not levels:
            break
    else:
        raise RuntimeError("KNN search did not converge; check the anchor column ranges")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def k_smallest_per_group(df: DataFrame, group_cols: Sequence[str], order_col: str, k: int) -> DataFrame:
    """Rows with the k smallest ``order_col`` per group (nulls in keys group together).

    Spark limits every task to k rows per group before the exchange (the window
    group limit), so a hot group of copies is no hot partition.
    """
    rank = F.row_number().over(Window.partitionBy(*group_cols).orderBy(order_col))
    return df.withColumn("_kr", rank).where(F.col("_kr") <= k).drop("_kr")


# Fit rows that one task sorts to find copies: a file may hold any number of rows in one split.
SORT_ROWS = 200_000

# Name of the constant anchor of receivers that have no other: their box covers all donors.
_ZERO = "_zero"


class KNNImputer(ColumnEstimator):
    """Fill ``target_cols`` nulls from the k nearest fit rows (sklearn ``KNNImputer`` semantics).

    ``dist_cols`` are all columns entering the distance (strings are coded);
    ``cat_cols`` lists which targets are categorical.  ``anchor`` must be a
    numeric distance column without nulls; by default the complete numeric
    column with the widest spread is used.  ``search``: ``auto`` takes the cell
    index when more than ``n_anchors`` columns are complete and no anchor is
    given, else the grid; ``grid``, ``index`` and ``approximate`` (LSH, see
    ``pivots.approximate_neighbours``) are taken as said.  Codes of a string
    column are a literal map up to ``MAX_LITERAL_ENTRIES`` levels and a joined
    table above, both ways.
    """

    def __init__(self, target_cols: Sequence[str], dist_cols: Sequence[str], id_col: str, k: int = 5,
                 anchor: str | Sequence[str] | None = None, donors_per_bucket: int = 64, n_anchors: int = 2,
                 search: str = "auto", donors_per_cell: int = pivots.DONORS_PER_CELL):
        super().__init__()
        if search not in ("auto", "grid", "index", "approximate"):
            raise ValueError(f"unknown search {search}")
        self.search, self.donors_per_cell = search, donors_per_cell
        self.target_cols, self.dist_cols, self.id_col = list(target_cols), list(dist_cols), id_col
        self.k, self.donors_per_bucket, self.n_anchors = k, donors_per_bucket, n_anchors
        self.anchor = [anchor] if isinstance(anchor, str) else (list(anchor) if anchor else None)

    def _fit(self, dataset: DataFrame) -> KNNImputerModel:
        types = {f.name: f.dataType.simpleString() for f in dataset.schema.fields}
        str_cols = [c for c in self.dist_cols if types[c] == "string"]
        codes, sizes = {}, {}
        for c in str_cols:
            tbl = first_appearance_codes(dataset, c, self.id_col)
            few = tbl.limit(MAX_LITERAL_ENTRIES + 1).collect()
            codes[c], sizes[c] = {r["value"]: r["code"] for r in few}, len(few)
            if len(few) > MAX_LITERAL_ENTRIES:
                codes[c] = checkpoint_once(tbl)
                sizes[c] = codes[c].count()
        model = KNNImputerModel(self, codes, sizes, [], [], [], [], dataset)
        enc = model.fit_encoded
        cols = model.dist_cols
        st = enc.agg(F.count(F.lit(1)).alias("n"),
                     *[F.count(c).alias(f"c_{c}") for c in cols],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in cols],
                     *[F.min(c).alias(f"lo_{c}") for c in cols],
                     *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
        anchors = self.anchor
        if anchors is None:
            # complete columns with the widest spread bound the distance best
            complete = [c for c in cols if st[f"c_{c}"] == st["n"] and (st[f"s_{c}"] or 0.0) > 0]
            if not complete:
                complete = [c for c in cols if st[f"c_{c}"] == st["n"]]
            if not complete:
                complete = [_ZERO]  # no bound on the distance: every donor is a candidate
            anchors = sorted(complete, key=lambda c: -(st[f"s_{c}"] or 0.0) if c != _ZERO else 0.0)[: self.n_anchors]
        n = max(int(st["n"]), 1)
        cells_per_dim = max(1.0, (n / self.donors_per_bucket) ** (1.0 / len(anchors)))
        los = [0.0 if a == _ZERO else float(st[f"lo_{a}"]) for a in anchors]
        his = [0.0 if a == _ZERO else float(st[f"hi_{a}"]) for a in anchors]
        widths = [((h - lo) / cells_per_dim) if h > lo else 1.0 for lo, h in zip(los, his)]
        model.n_fit = n
        model.anchors, model.widths, model.los, model.his = anchors, widths, los, his
        complete = [c for c in cols if st[f"c_{c}"] == st["n"] and st["n"]]
        if self.search in ("index", "approximate") or (self.search == "auto" and self.anchor is None and len(complete) > self.n_anchors):
            model.index_cols = complete
        return model


class KNNImputerModel(ColumnModel):
    def __init__(self, spec: KNNImputer, codes: dict, sizes: dict, anchors: list, widths: list, los: list, his: list,
                 fit_df: DataFrame):
        super().__init__()
        self.spec, self.codes, self.sizes, self.anchors = spec, codes, sizes, anchors
        self.widths, self.los, self.his = widths, los, his
        self.index_cols: list = []
        self.n_fit = 1
        # a string column without a level at fit says nothing of a distance
        self.dist_cols = [c for c in spec.dist_cols if sizes.get(c, 1)]
        self.fit_encoded = self._encode(fit_df)

    def _lookup(self, df: DataFrame, c: str, key, to: str) -> DataFrame:
        """``df`` with column ``to``: the code of the level ``key`` (or the level of a code, when ``key`` is numeric)."""
        back = dict(df.withColumn("_k", key).dtypes)["_k"] != "string"
        table = self.codes[c]
        if isinstance(table, dict):
            pairs = {v: k for k, v in table.items()} if back else table
            return df.withColumn(to, code_map(pairs, key, None) if pairs else F.lit(None))
        of, give = ("code", "value") if back else ("value", "code")
        lookup = checked_broadcast(table.select(F.col(of).alias("_of"), F.col(give).alias(to)), self.sizes[c])
        return df.join(lookup, key == F.col("_of"), "left").drop("_of")

    def _encode(self, df: DataFrame) -> DataFrame:
        s = self.spec
        out = df.select(F.col(s.id_col), *[F.col(c) if c in self.codes else F.col(c).cast("double").alias(c) for c in self.dist_cols])
        for c in self.dist_cols:
            if c in self.codes:
                out = self._lookup(out, c, F.col(c), f"_code_{c}").drop(c).withColumnRenamed(f"_code_{c}", c)
        return out.select(s.id_col, *[F.col(c).cast("double").alias(c) for c in self.dist_cols])

    def _dealt(self) -> DataFrame:
        """Encoded fit rows, dealt evenly into as many tasks as their number asks for."""
        tasks = pivots.tasks_for(self.fit_encoded.sparkSession, self.n_fit, SORT_ROWS)
        return self.fit_encoded.repartition(tasks, self.spec.id_col)

    def cell_index(self) -> tuple[DataFrame, pivots.CellIndex]:
        """(fit rows in cells, index), built once.  Of identical rows only the k smallest ids can ever be chosen."""
        if getattr(self, "_index", None) is None:
            rows = self._dealt().select(F.col(self.spec.id_col).alias("did"), *[F.col(c).alias(f"d_{c}") for c in self.dist_cols])
            kept = k_smallest_per_group(rows, [f"d_{c}" for c in self.dist_cols], "did", self.spec.k)
            self._index = pivots.build_index(checkpoint_once(kept), self.index_cols, self.spec.donors_per_cell)
        return self._index

    def _by_index(self, receivers: DataFrame, targets: list[str], stats: dict | None = None) -> DataFrame:
        donors, index = self.cell_index()
        if self.spec.search == "approximate":
            near = pivots.approximate_neighbours(receivers, donors, index, targets, self.dist_cols, self.spec.k)
        else:
            near = pivots.exact_neighbours(receivers, donors, index, targets, self.dist_cols, self.spec.k, stats)
        mean = F.aggregate(F.col("top.val"), F.lit(0.0), lambda a, x: a + x) / F.size("top")
        return near.select("qid", "_t", F.when(F.size("top") > 0, mean).alias("knn_value"), F.size("top").cast("long").alias("n_neighbours"))

    def _search(self, receivers: DataFrame, donors: DataFrame) -> DataFrame:
        """``knn_mean`` by the anchors that each receiver has: one search per pattern of null anchors that occurs."""
        receivers, donors = receivers.withColumn(f"q_{_ZERO}", F.lit(0.0)), donors.withColumn(f"d_{_ZERO}", F.lit(0.0))
        real = [a for a in self.anchors if a != _ZERO]
        pattern = F.concat(F.lit("p"), *[F.when(F.col(f"q_{a}").isNull(), "0").otherwise("1") for a in real])
        out = None
        for p in sorted(r[0] for r in receivers.select(pattern).distinct().collect()):  # at most 2^anchors
            use = [k for k, a in enumerate(self.anchors) if a in real and p[1 + real.index(a)] == "1"]
            bounds = [(self.anchors[k], self.widths[k], self.los[k], self.his[k]) for k in use] or [(_ZERO, 1.0, 0.0, 0.0)]
            part = knn_mean(receivers.where(pattern == p), donors, self.dist_cols, [b[0] for b in bounds], self.spec.k,
                            [b[1] for b in bounds], [b[2] for b in bounds], [b[3] for b in bounds])
            out = part if out is None else out.unionByName(part)
        empty = "qid long, _t string, knn_value double, n_neighbours long"
        return receivers.sparkSession.createDataFrame([], empty) if out is None else out

    def _donors(self, targets: list[str]) -> DataFrame:
        """Long form for the grid: one row per fit row and target that it has, copies beyond the k smallest ids left out."""
        s, d_cols = self.spec, [f"d_{c}" for c in self.dist_cols]
        donors = (self._dealt().select(
            F.col(s.id_col).alias("did"), *[F.col(c).alias(f"d_{c}") for c in self.dist_cols],
            F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col(t).alias("v")) for t in targets])).alias("_tv"))
            .where(F.col("_tv.v").isNotNull())
            .select("did", F.col("_tv.t").alias("_t"), F.col("_tv.v").alias("_val"), *d_cols))
        return checkpoint_once(k_smallest_per_group(donors, ["_t", *d_cols], "did", s.k))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.spec
        targets = [t for t in s.target_cols if t in dataset.columns and t in self.dist_cols]
        if not targets:
            return dataset
        feats = [F.col(c).alias(f"q_{c}") for c in self.dist_cols]
        enc = self._encode(dataset)
        # one row per (receiver, missing target); written once so every search level reads it directly
        receivers = (enc.select(F.col(s.id_col).alias("qid"), *feats, F.explode(F.array(
            *[F.when(F.col(t).isNull(), F.lit(t)) for t in targets])).alias("_t"))
            .where(F.col("_t").isNotNull()))
        receivers = checkpoint_once(receivers)
        # sklearn falls back to the donor mean when a receiver has no donor at a defined distance
        means = self.fit_encoded.agg(*[F.avg(t).alias(t) for t in targets]).first()
        q_cols = [f"q_{c}" for c in self.dist_cols]
        # copies: identical receivers get identical answers -> search once per distinct vector
        distinct_q = checkpoint_once(receivers.groupBy("_t", *q_cols).agg(F.min("qid").alias("qid")))
        indexed = F.lit(bool(self.index_cols))
        for c in self.index_cols:
            indexed = indexed & F.col(f"q_{c}").isNotNull()
        found = []
        if self.index_cols:
            found.append(self._by_index(distinct_q.where(indexed), targets))
        rest = distinct_q.where(~indexed)
        if not self.index_cols or not rest.isEmpty():
            found.append(self._search(rest, self._donors(targets)))
        res = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        rep = distinct_q.select(F.col("qid").alias("_rep"), "_t", *q_cols).alias("r")
        cond = [F.col("a._t") == F.col("r._t")] + [F.col(f"a.{c}").eqNullSafe(F.col(f"r.{c}")) for c in q_cols]
        mapped = receivers.alias("a").join(rep, cond).select(F.col("a.qid").alias("qid"), F.col("a._t").alias("_t"), "_rep")
        res = mapped.join(res.withColumnRenamed("qid", "_rep"), ["_rep", "_t"], "left")
        wide = res.groupBy("qid").agg(*[F.max(F.when(F.col("_t") == t, F.col("knn_value"))).alias(f"_imp_{t}")
                                        for t in targets])
        out = dataset.join(wide.withColumnRenamed("qid", s.id_col), s.id_col, "left")
        fills = {}
        for t in targets:
            val = F.coalesce(F.col(f"_imp_{t}"), F.lit(means[t]))
            if t in self.codes:
                out = self._lookup(out, t, F.bround(val, 0).cast("int"), f"_level_{t}")
                val = F.col(f"_level_{t}")
            fills[t] = F.coalesce(F.col(t), val.cast(dict(dataset.dtypes)[t]))
        return out.withColumns(fills).drop(*[f"_imp_{t}" for t in targets], *[f"_level_{t}" for t in targets])
