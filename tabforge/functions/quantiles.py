"""Exact, interpolated quantiles without shuffling all values or holding a group in one task.

Spark's ``percentile``/``median`` aggregates keep a value->count map per group
and merge it in one reducer, so a hot group with many distinct values lands in
a single task.  Here every size takes the same path of two scans:

1. One aggregate scan gives, per group and column, the value count and an
   ``approx_percentile`` bracket [lo, hi] around every wanted rank (a
   bounded-memory sketch; the bracket is +-3 ranks of the sketch's error).
2. One aggregate scan counts, per group, column and prob, the values below
   ``lo`` as one number and those inside the bracket by value.  The band is
   about 6/accuracy of the data, so its (value, count) pairs are summed up in
   order by one window per group and prob, and the wanted ranks read off.

The second scan checks the first: a rank that does not fall into its bracket
(the sketch's bound failed) gives no value, and those quantiles are narrowed
down by exact counts instead: 1,024 bins between the smallest and the largest
value, the bins of the wanted ranks, 1,024 bins in these, until the band is
small or one value.  A group whose band would exceed ``MAX_BAND`` values is
narrowed that way inside its bracket first, so no task sorts more than that.

The brackets reach the rows as literals (no groups) or by one join on the group
columns, whose table has one row per group.  Nothing depends on the order of
rows or on partitions, and what a step reads is either the input or a
checkpointed table, so a lost executor changes no rank.  Interpolation is the
linear one of pandas / numpy / DuckDB ``quantile_cont``: h = p*(n-1),
v[floor h] + (h - floor h) * (v[ceil h] - v[floor h]).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import checkpoint_once, ensure_checkpoint_dir

DEFAULT_ACCURACY = 10000
MAX_BAND = 2_000_000    # values that one window task sorts
_BINS = 1024
_WIDE = 4               # columns beyond which the band is taken from a long table
# Tables of one row per group up to this size go through the driver and are broadcast; larger ones are checkpointed and joined.
MAX_LOCAL_GROUPS = 4096


def _same_group(group_cols: Sequence[str]) -> Column:
    same = F.lit(True)
    for k, g in enumerate(group_cols):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    return same


def _beside(rows: DataFrame, table, group_cols: list[str], names: list[str]) -> tuple[DataFrame, list]:
    """``rows`` with the numbers ``names`` of their group at hand, as columns: joined, or literals where there are no groups."""
    if not group_cols:
        return rows, [F.lit(table.get(x)) for x in names]
    side = table.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(group_cols)], *names)
    return rows.join(side, _same_group(group_cols)), [F.col(x) for x in names]


def _local(spark, few: DataFrame) -> DataFrame:
    """The rows of a small result, read without a job."""
    return spark.createDataFrame(few.toArrow(), few.schema)


def _edges(n: int) -> list[str]:
    return [f"_{x}{i}" for x in ("lo", "hi") for i in range(n)]


def _settled(df: DataFrame, group_cols: list[str]):
    """The computed numbers: one row per group as a table; without groups they are one dictionary."""
    if not group_cols:
        row = df.first()
        return row.asDict() if row is not None else {}
    few = df.limit(MAX_LOCAL_GROUPS + 1).collect()
    if len(few) <= MAX_LOCAL_GROUPS:
        return F.broadcast(df.sparkSession.createDataFrame(few, df.schema))
    return checkpoint_once(df)


def _band(rows: DataFrame, brackets, group_cols: list[str], slots: list, vals: list[str]) -> DataFrame:
    """(groups, _i, v, c): counts by value inside the bracket of slot _i, and with v null all values below it."""
    if not group_cols and len(vals) > _WIDE and all(brackets.get(e) is not None for e in _edges(len(slots))):
        return _wide_band(rows, brackets, len(slots), vals)
    joined, edges = _beside(rows, brackets, group_cols, _edges(len(slots)))
    lo, hi = [e.cast("double") for e in edges[:len(slots)]], [e.cast("double") for e in edges[len(slots):]]
    entries = F.array(*[F.when(F.col(vals[k]) <= hi[i], F.struct(
        F.lit(i).alias("_i"), F.when(F.col(vals[k]) >= lo[i], F.col(vals[k])).alias("v"))) for i, (k, _) in enumerate(slots)])
    return (joined.select(*group_cols, F.explode(entries).alias("_e")).where("_e is not null").select(*group_cols, "_e._i", "_e.v")
            .groupBy(*group_cols, "_i", "v").agg(F.count(F.lit(1)).alias("c")))


def _long(rows: DataFrame, vals: list[str]) -> DataFrame:
    return rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(v).alias("v")) for k, v in enumerate(vals)])).alias("_r"))


def _wide_band(rows: DataFrame, brackets: dict, n: int, vals: list[str]) -> DataFrame:
    """``_band`` of many columns without groups: long first, so that the plan does not grow with columns x probs."""
    per = n // len(vals)   # slot k * per + j: column k, prob j
    long = _long(rows, vals)

    def edge(x: str, j: int) -> Column:
        return F.element_at(F.lit([float(brackets[f"_{x}{k * per + j}"]) for k in range(len(vals))]), F.col("_r.k") + 1)

    entries = F.array(*[F.when(F.col("_r.v") <= edge("hi", j), F.struct(
        (F.col("_r.k") * per + j).alias("_i"), F.when(F.col("_r.v") >= edge("lo", j), F.col("_r.v")).alias("v"))) for j in range(per)])
    return (long.where("_r.v is not null").select(F.explode(entries).alias("_e")).where("_e is not null").select("_e._i", "_e.v")
            .groupBy("_i", "v").agg(F.count(F.lit(1)).alias("c")))


def _ranked(rows: DataFrame, brackets, sizes, group_cols: list[str], slots: list, vals: list[str],
            names: Sequence[str]) -> DataFrame:
    """(groups, _i, column, prob, value) of every slot with a bracket; the value is null where the rank is not inside."""
    band = _band(rows, brackets, group_cols, slots, vals)
    upto = Window.partitionBy(*group_cols, "_i").orderBy(F.asc_nulls_first("v"))
    prob = F.element_at(F.array(*[F.lit(p) for _, p in slots]), F.col("_i") + 1)
    counted, n = _beside(band.withColumn("_end", F.sum("c").over(upto)), sizes, group_cols, [f"_n{vals[k]}" for k, _ in slots])
    placed = counted.withColumn("_h", prob * (F.element_at(F.array(*n), F.col("_i") + 1) - 1))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_end") - F.col("c")) & (rank < F.col("_end")), F.col("v")))

    picked = placed.groupBy(*group_cols, "_i").agg(at(F.floor("_h")).alias("_vlo"), at(F.ceil("_h")).alias("_vhi"), F.first("_h").alias("_h"))
    column = F.element_at(F.array(*[F.lit(names[k]) for k, _ in slots]), F.col("_i") + 1)
    value = F.col("_vlo") + (F.col("_h") - F.floor("_h")) * (F.col("_vhi") - F.col("_vlo"))
    same = F.when(F.col("_vlo") == F.col("_vhi"), F.col("_vlo")).otherwise(value)  # infinite neighbours too
    return picked.select(*group_cols, "_i", column.alias("column"), prob.alias("prob"), same.alias("value"))


def _narrowed(rows: DataFrame, brackets, sizes, group_cols: list[str], slots: list, vals: list[str], enough: int):
    """Brackets of at most ``enough`` values, or of one value, around the wanted ranks, by rounds of exact bin counts.

    Every round keeps the bins that hold the two ranks of a slot; their real
    smallest and largest values are the next bracket.  A wanted rank outside the
    given bracket keeps it as it is (``_ranked`` then gives no value).
    """
    idle = 0
    while True:
        joined, edges = _beside(rows, brackets, group_cols, _edges(len(slots)))
        lo, hi = [e.cast("double") for e in edges[:len(slots)]], [e.cast("double") for e in edges[len(slots):]]
        by_size = idle % 2 == 0   # bins of equal ratio first: they reach the size of a value in few rounds

        def scaled(v: Column) -> Column:
            held = F.greatest(F.least(v, F.lit(1.7e308)), F.lit(-1.7e308))
            return F.signum(held) * F.log1p(F.abs(held)) if by_size else held / 2

        def bin_of(v: Column, a: Column, b: Column) -> Column:
            share = F.try_divide(scaled(v) - scaled(a), scaled(b) - scaled(a))
            inner = F.greatest(F.least(F.floor(F.coalesce(share, F.lit(0.0)) * _BINS), F.lit(_BINS - 1)), F.lit(0))
            return F.when(v == b, _BINS - 1).when(v == a, 0).otherwise(inner).cast("int")

        entries = F.filter(F.array(*[F.when(F.col(vals[k]) <= hi[i], F.struct(
            F.lit(i).alias("_i"), F.when(F.col(vals[k]) >= lo[i], bin_of(F.col(vals[k]), lo[i], hi[i])).otherwise(-1).alias("b"),
            F.col(vals[k]).alias("v"))) for i, (k, _) in enumerate(slots)]), lambda x: x.isNotNull())
        bins = (joined.select(*group_cols, F.explode(entries).alias("_e")).select(*group_cols, "_e.*").groupBy(*group_cols, "_i", "b")
                .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("a"), F.max("v").alias("z")))
        upto = Window.partitionBy(*group_cols, "_i").orderBy("b")  # at most 1,025 rows each
        counted, n = _beside(bins.withColumn("_end", F.sum("c").over(upto)), sizes, group_cols, [f"_n{vals[k]}" for k, _ in slots])
        h = F.element_at(F.array(*[F.lit(p) for _, p in slots]), F.col("_i") + 1) * (F.element_at(F.array(*n), F.col("_i") + 1) - 1)
        wanted = (F.col("b") >= 0) & (F.ceil(h) >= F.col("_end") - F.col("c")) & (F.floor(h) < F.col("_end"))
        # between the ranks' two bins no other bin has values, so what is kept are exactly these bins' values
        kept = counted.where(wanted).groupBy(*group_cols, "_i").agg(F.min("a").alias("a"), F.max("z").alias("z"), F.sum("c").alias("c"))
        wide = _settled(kept.groupBy(*group_cols).agg(*[F.max(F.when(F.col("_i") == i, F.col(x))).alias(f"{to}{i}")
                                                        for i in range(len(slots)) for x, to in (("a", "_lo"), ("z", "_hi"), ("c", "_c"))]), group_cols)
        if _close(wide, group_cols, len(slots), enough):
            return wide
        idle = idle + 1 if _unchanged(brackets, wide, group_cols, len(slots)) else idle
        if idle == 4:   # neither kind of bins splits the band any more
            return wide
        brackets = wide


def _close(wide, group_cols: list[str], n: int, enough: int) -> bool:
    if not group_cols:
        return all(wide.get(f"_c{i}") is None or wide[f"_c{i}"] <= enough or wide[f"_lo{i}"] == wide[f"_hi{i}"] for i in range(n))
    done = F.lit(True)
    for i in range(n):
        done = done & F.coalesce((F.col(f"_c{i}") <= enough) | (F.col(f"_lo{i}") == F.col(f"_hi{i}")), F.lit(True))
    return wide.where(~done).isEmpty()


def _unchanged(before, after, group_cols: list[str], n: int) -> bool:
    if not group_cols:
        return all(before.get(e) == after.get(e) for e in _edges(n))
    return after.select(*group_cols, *_edges(n)).exceptAll(before.select(*group_cols, *_edges(n))).isEmpty()


def exact_quantiles(df: DataFrame, value_cols: str | Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = (), num_partitions: int | None = None,
                    accuracy: int = DEFAULT_ACCURACY, max_band: int = MAX_BAND) -> DataFrame:
    """Long result: ``group_cols..., column, prob, value`` (null values skipped)."""
    if isinstance(value_cols, str):
        value_cols = [value_cols]
    value_cols, group_cols, probs = list(value_cols), list(group_cols), [float(p) for p in probs]
    ensure_checkpoint_dir(df.sparkSession)
    vals = [f"_v{k}" for k in range(len(value_cols))]
    rows = df.select(*group_cols, *[F.col(c).cast("double").alias(v) for c, v in zip(value_cols, vals)])
    if num_partitions:
        rows = rows.repartition(num_partitions)
    eps = 3.0 / accuracy
    edges = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-eps, eps)})
    at = {e: i for i, e in enumerate(edges)}
    slots = [(k, p) for k in range(len(vals)) for p in probs]  # slot i: column k, prob p

    # scan 1: counts, extremes and brackets, one row per group
    sketch = _settled(rows.groupBy(*group_cols).agg(*[x for v in vals for x in (
        F.count(v).alias(f"_n{v}"), F.min(v).alias(f"_min{v}"), F.max(v).alias(f"_max{v}"),
        F.percentile_approx(v, edges, accuracy).alias(f"_q{v}"))]), group_cols)

    def edge(k: int, p: float, d: float) -> int:
        return at[min(1.0, max(0.0, p + d))]

    if group_cols:
        brackets = sketch.select(*group_cols, *[F.get(F.col(f"_q{vals[k]}"), edge(k, p, d)).cast("double").alias(f"{x}{i}")
                                                for i, (k, p) in enumerate(slots) for x, d in (("_lo", -eps), ("_hi", eps))])
        largest = sketch.agg(F.max(F.greatest(*[F.col(f"_n{v}") for v in vals], F.lit(0)))).first()[0] or 0
    else:
        brackets = {f"{x}{i}": sketch[f"_q{vals[k]}"][edge(k, p, d)] for i, (k, p) in enumerate(slots)
                    for x, d in (("_lo", -eps), ("_hi", eps)) if sketch[f"_q{vals[k]}"]}
        largest = max(sketch[f"_n{v}"] for v in vals)
    if largest * 2 * eps > max_band:
        brackets = _narrowed(rows, brackets, sketch, group_cols, slots, vals, max_band)

    # scan 2: rank the band
    def ranked(between) -> DataFrame:
        out = _ranked(rows, between, sketch, group_cols, slots, vals, value_cols)
        if not group_cols:
            return _local(df.sparkSession, out)   # columns x probs rows
        few = out.limit(MAX_LOCAL_GROUPS + 1).collect()
        if len(few) > MAX_LOCAL_GROUPS:
            return checkpoint_once(out)
        return df.sparkSession.createDataFrame(few, out.schema)

    result = ranked(brackets)
    if group_cols:
        missed = result.where(F.col("value").isNull()).groupBy(*group_cols).agg(
            *[F.max((F.col("_i") == i).cast("int")).alias(f"_m{i}") for i in range(len(slots))])
        none = missed.isEmpty()
    else:
        missed = {r["_i"] for r in result.where(F.col("value").isNull()).collect()}
        none = not missed
    if none:
        return result.drop("_i")
    if group_cols:
        again = missed.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(group_cols)], *[f"_m{i}" for i in range(len(slots))])
        whole = _settled(sketch.join(again, _same_group(group_cols)).select(*group_cols, *[
            F.when(F.col(f"_m{i}") == 1, F.col(f"{x}{vals[k]}")).alias(f"{to}{i}")
            for i, (k, _) in enumerate(slots) for x, to in (("_min", "_lo"), ("_max", "_hi"))]), group_cols)
    else:
        whole = {f"{to}{i}": sketch[f"{x}{vals[k]}"] for i, (k, _) in enumerate(slots) if i in missed
                 for x, to in (("_min", "_lo"), ("_max", "_hi"))}
    close = _narrowed(rows, whole, sketch, group_cols, slots, vals, max_band)
    return result.where(F.col("value").isNotNull()).unionByName(ranked(close)).drop("_i")
