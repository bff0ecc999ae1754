"""Data-audit statistics as Spark aggregates.

Each report is computed in one wide aggregate (one scan, partial aggregation
on the map side, a single small row reduced) and then reshaped to a long
``(column, ...)`` table with ``unpivot``.  Value counts (modes, distinct
counts) use long form ``groupBy(column, value)`` so that no task holds the
value map of a whole column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from tabforge.functions.exprs import adjusted_skew
from tabforge.functions.quantiles import exact_quantiles
from tabforge.operators.linear import balanced_sum


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]


def _wide_to_long(row_df: DataFrame, names: Sequence[str], value_name: str, key_name: str = "column") -> DataFrame:
    return row_df.unpivot([], list(names), key_name, value_name)


def target_summary(df: DataFrame, col: str) -> DataFrame:
    """n, sample-adjusted skew, min, max, mean, exact median of one column."""
    stats = df.agg(F.count(col).alias("n"), F.skewness(col).alias("_s"), F.min(col).alias("min"),
                   F.max(col).alias("max"), F.avg(col).alias("mean"))
    med = exact_quantiles(df, [col], [0.5]).first()
    return stats.select(F.lit(col).alias("column"), "n", adjusted_skew(F.col("_s"), F.col("n")).alias("skew"),
                        "min", "max", "mean", F.lit(med["value"] if med else None).cast("double").alias("median"))


def skewness_report(df: DataFrame, cols: Sequence[str], threshold: float = 0.75) -> DataFrame:
    """Population skewness per column (SciPy ``skew`` on non-null values) and the skewed flag."""
    row = df.agg(*[F.skewness(c).alias(c) for c in cols])
    long = _wide_to_long(row, cols, "skew")
    return long.withColumn("is_skewed", F.coalesce(F.abs("skew") > F.lit(threshold), F.lit(False)))


def skew_split(df: DataFrame, cols: Sequence[str], threshold: float = 0.75) -> tuple[list[str], list[str]]:
    """(skewed, rest) column lists, keeping the input order."""
    flags = {r["column"]: r["is_skewed"] for r in skewness_report(df, cols, threshold).collect()}
    skewed = [c for c in cols if flags.get(c)]
    return skewed, [c for c in cols if c not in skewed]


def missing_report(train: DataFrame, test: DataFrame | None = None, label: str | None = None,
                   only_missing: bool = True) -> DataFrame:
    """Percent null per column over train (minus label) union test, sorted descending."""
    data = train.drop(label) if label else train
    if test is not None:
        data = data.unionByName(test, allowMissingColumns=False)
    cols = data.columns
    row = data.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(c) for c in cols])
    rep = _wide_to_long(row, cols, "pct_missing")
    if only_missing:
        rep = rep.where(F.col("pct_missing") > 0)
    return rep.orderBy(F.desc("pct_missing"), F.asc("column"))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of every column with the target (pairwise null deletion)."""
    row = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    return _wide_to_long(row, cols, "corr").orderBy(F.desc_nulls_last("corr"), "column")


def top_correlated(df: DataFrame, cols: Sequence[str], target: str, k: int = 5) -> DataFrame:
    """Top-k columns by correlation with the target, the target itself excluded."""
    feats = [c for c in cols if c != target]
    return corr_with_target(df, feats, target).where(F.col("corr").isNotNull()).limit(k)


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """|corr| of every column pair (strict upper triangle by column position), pairwise null deletion.

    One scan whatever the number of columns: each task multiplies its Arrow
    batches with numpy (counts, sums, squares and products over the rows where
    both are present) and emits p^2/2 sums, which one aggregation adds up.
    Columns are shifted by their means so that the centred sums stay accurate.
    """
    cols = list(cols)
    p = len(cols)
    if p < 2:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, abs_corr double")
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{k}") for k, c in enumerate(cols)]).first()
    shifted = df.select(*[(F.col(c).cast("double") - F.lit(means[k] if means[k] is not None else 0.0)).alias(f"x{k}")
                          for k, c in enumerate(cols)])
    iu, ju = np.triu_indices(p, 1)

    def partial(batches):
        total = None
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            mask = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            sums = np.stack([mask.T @ mask, x.T @ mask, mask.T @ x, (x * x).T @ mask, mask.T @ (x * x), x.T @ x])
            total = sums if total is None else total + sums
        if total is not None:
            yield pd.DataFrame({"i": iu, "j": ju} | {c: total[k][iu, ju] for k, c in enumerate(("n", "a", "b", "aa", "bb", "ab"))})

    sums = (shifted.mapInPandas(partial, "i int, j int, n double, a double, b double, aa double, bb double, ab double")
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")]))
    n, a, b = F.col("n"), F.col("a"), F.col("b")
    var_a, var_b = F.col("aa") - a * a / n, F.col("bb") - b * b / n
    r = F.when((n > 1) & (var_a > 0) & (var_b > 0), (F.col("ab") - a * b / n) / F.sqrt(var_a * var_b))
    name = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.get(name, F.col("i")).alias("col_a"), F.get(name, F.col("j")).alias("col_b"), F.abs(r).alias("abs_corr"))


def high_corr_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.8) -> DataFrame:
    return corr_pairs(df, cols).where(F.col("abs_corr") > F.lit(threshold))


def collinear_columns(df: DataFrame, cols: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """Columns that have a pair above the threshold with an earlier column."""
    return (high_corr_pairs(df, cols, threshold).groupBy(F.col("col_b").alias("column"))
            .agg(F.count(F.lit(1)).alias("n_pairs"), F.max("abs_corr").alias("max_abs_corr")))


def z_outliers(df: DataFrame, cols: Sequence[str], threshold: float = 4.0) -> DataFrame:
    """Rows with |z| > threshold per column (population std, nulls dropped).

    Two passes: mean/std in one aggregate row, then a count with them as literals.
    """
    st = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    counts = []
    for c in cols:
        m, s = st[f"m_{c}"], st[f"s_{c}"]
        if m is None or s is None or s == 0:
            counts.append(F.lit(0).cast("bigint").alias(c))
        else:
            counts.append(F.count_if(F.abs((F.col(c) - F.lit(m)) / F.lit(s)) > F.lit(threshold)).alias(c))
    return _wide_to_long(df.agg(*counts), cols, "n_outliers")


def predicate_count(df: DataFrame, cond: Column, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count_if(cond).alias(name))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long (column, value, cnt) of non-null values; values compared as strings.

    Floating values get ``+ 0.0`` first so that -0.0 and 0.0 count as one value.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    as_str = [((F.col(c) + F.lit(0.0)) if isinstance(types[c], (DoubleType, FloatType)) else F.col(c))
              .cast("string").alias(c) for c in cols]
    long = df.select(*as_str).unpivot([], list(cols), "column", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value per column; the smallest value wins a tie (pandas ``mode().iloc[0]``)."""
    vc = value_counts(df, cols)
    return vc.groupBy("column").agg(F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("value"))).alias("m")).select(
        "column", F.col("m.value").alias("mode"), (-F.col("m.neg")).alias("cnt"))


def typed_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """{column: mode} with values cast back to the column type (driver dict, one row per column)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    if not cols:
        return out
    # values are counted in the column's own type: exact for 64-bit integers, and a tie picks the smallest number
    by_type: dict = {}
    for c in cols:
        by_type.setdefault(types[c].simpleString(), []).append(c)
    for same in by_type.values():
        zero = isinstance(types[same[0]], (DoubleType, FloatType))
        long = df.select(*[(F.col(c) + F.lit(0.0).cast(types[c]) if zero else F.col(c)).alias(c) for c in same]).unpivot(
            [], same, "column", "value").where(F.col("value").isNotNull())
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("value"))).alias("m"))
        for r in best.collect():
            out[r["column"]] = r["m"]["value"]
    return out


# Columns whose sketched distinct count is above this are not counted value by value.
MAX_COUNTED_VALUES = 10_000


def low_variance(df: DataFrame, cols: Sequence[str], max_counted: int = MAX_COUNTED_VALUES) -> DataFrame:
    """Distinct count and share of the dominant value per column (near-zero-variance finder).

    One scan of mergeable sketches estimates every column's distinct count.  A
    column that it shows as short is counted exactly (``exact`` true).  A longer
    one moves no values: ``n_distinct`` is the estimate (2 % standard error),
    and a second scan counts the value that a frequent-items sketch puts first
    exactly, so ``top_share`` is right for any value frequent enough to matter
    (the sketch finds every value above 1/2,500 of the rows) and at most that
    much too low otherwise.  A column without values has no row.
    """
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, n_distinct bigint, top_share double, exact boolean")
    sketch = df.agg(*[F.approx_count_distinct(c, 0.02).alias(f"d{k}") for k, c in enumerate(cols)]).first()
    short = [c for k, c in enumerate(cols) if sketch[f"d{k}"] <= max_counted]
    long = [(c, sketch[f"d{k}"]) for k, c in enumerate(cols) if sketch[f"d{k}"] > max_counted]
    out = value_counts(df, short).groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"), (F.max("cnt") / F.sum("cnt")).alias("top_share")).withColumn(
        "exact", F.lit(True)) if short else None
    if long:
        tops = df.agg(*[F.call_function("approx_top_k", F.col(c), F.lit(1)).alias(f"t{k}") for k, (c, _) in enumerate(long)]).first()
        found = [tops[f"t{k}"] for k in range(len(long))]
        shares = df.agg(*[((F.count_if(F.col(c) == F.lit(t[0]["item"])) if t else F.lit(1)) / F.count(c)).alias(f"s{k}")
                          for k, ((c, _), t) in enumerate(zip(long, found))]).first()
        rows = [(c, int(d), float(shares[f"s{k}"]), False) for k, (c, d) in enumerate(long)]
        part = df.sparkSession.createDataFrame(rows, "column string, n_distinct bigint, top_share double, exact boolean")
        out = part if out is None else out.unionByName(part)
    return out


def histogram(df: DataFrame, col: str, bins: int = 50, series: str | None = None) -> DataFrame:
    """Equal-width histogram over [min, max]; the max lands in the last bin, empty bins count 0.

    A column without values gives no rows.
    """
    st = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = st["lo"], st["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "series string, bin int, lo double, hi double, n bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    h = df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    h = every.join(h, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return h.select(F.lit(series or col).alias("series"), "bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "n")


# Gaussian terms vanish in double precision beyond ~38.6 bandwidths (exp(-745) is the
# smallest subnormal), so a box only needs the grid points within this many bandwidths.
KDE_SUPPORT = 40.0
# Boxes of one bandwidth and this many moments: see kde_grid for the error.
KDE_MOMENTS = 16


def kde_grid(df: DataFrame, col: str, grid_size: int = 200, cut: float = 0.0) -> DataFrame:
    """Gaussian KDE (Scott bandwidth, std * n^-1/5) on an evenly spaced grid, ``cut`` bandwidths past the data.

    A constant column, or one with fewer than two values, has no density: no rows.

    A fast Gauss transform: values are reduced to boxes one bandwidth h wide,
    with the moments M_k = sum s^k / k! of s = (v - centre) / h, |s| <= 1/2, by
    one partial aggregate; a box then adds exp(-t^2 / 2) sum_k M_k He_k(t) to
    the grid points x, t = (x - centre) / h, within KDE_SUPPORT bandwidths (He:
    Hermite polynomials).  By Cramer's bound, |He_k(t)| exp(-t^2 / 4) <= 1.09
    sqrt(k!), cutting the series after 16 terms changes the density by at most
    1.09 sum_{k >= 16} 2^-k / sqrt(k!) < 4e-12 of its largest possible value,
    1 / (h sqrt(2 pi)).  Boxes number at most the range over h, whatever the
    number of values.
    """
    st = df.agg(F.count(col).alias("n"), F.stddev_samp(col).alias("sd"), F.min(col).alias("lo"),
                F.max(col).alias("hi")).first()
    n, sd = st["n"], st["sd"]
    if not sd or math.isnan(sd):
        return df.sparkSession.createDataFrame([], "grid_idx int, x double, density double")
    h = sd * n ** (-1.0 / 5.0)
    g_lo, g_hi = st["lo"] - cut * h, st["hi"] + cut * h
    step = (g_hi - g_lo) / (grid_size - 1)
    value = F.col(col).cast("double")
    box = F.floor((value - F.lit(float(st["lo"]))) / F.lit(h))
    spread = df.where(F.col(col).isNotNull()).select(box.alias("b"), ((value - F.lit(float(st["lo"]))) / F.lit(h) - box - F.lit(0.5)).alias("s"))
    moments = spread.groupBy("b").agg(*[(F.sum(F.pow("s", k)) / F.lit(float(math.factorial(k)))).alias(f"m{k}") for k in range(KDE_MOMENTS)])
    # sum_k M_k He_k(t) as one polynomial of t: its coefficients are sums of moments
    series = np.zeros((KDE_MOMENTS, KDE_MOMENTS))
    for k in range(KDE_MOMENTS):
        series[k, :k + 1] = np.polynomial.hermite_e.herme2poly([0.0] * k + [1.0])
    centre = F.lit(float(st["lo"])) + (F.col("b") + F.lit(0.5)) * F.lit(h)
    boxes = moments.select(centre.alias("c"), *[balanced_sum([F.col(f"m{k}") * F.lit(float(series[k, j])) for k in range(KDE_MOMENTS) if series[k, j]])
                                                .alias(f"a{j}") for j in range(KDE_MOMENTS)])
    first = F.greatest(F.ceil((F.col("c") - F.lit(KDE_SUPPORT * h) - F.lit(g_lo)) / F.lit(step)), F.lit(0))
    last = F.least(F.floor((F.col("c") + F.lit(KDE_SUPPORT * h) - F.lit(g_lo)) / F.lit(step)), F.lit(grid_size - 1))
    pts = boxes.select("*", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("i"))
    pts = pts.withColumn("t", (F.lit(g_lo) + F.col("i") * F.lit(step) - F.col("c")) / F.lit(h))
    poly = F.col(f"a{KDE_MOMENTS - 1}")
    for j in range(KDE_MOMENTS - 2, -1, -1):
        poly = poly * F.col("t") + F.col(f"a{j}")
    norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
    return pts.groupBy("i").agg(F.sum(poly * F.exp(F.lit(-0.5) * F.col("t") * F.col("t"))).alias("_s")).select(
        F.col("i").alias("grid_idx"), (F.lit(g_lo) + F.col("i") * F.lit(step)).alias("x"),
        (F.col("_s") * F.lit(norm)).alias("density"))


def scatter_points(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Every (x, y) pair, as the scatter plot draws it."""
    return df.select(key, x, y)


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """(x_bin, y_bin, n): row counts on an equal-width grid over the ranges of both columns, empty cells left out.

    This is what a scatter plot of any number of rows can show; null pairs are skipped.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    st = both.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if st[0] is None:
        return df.sparkSession.createDataFrame([], "x_bin int, y_bin int, n bigint")

    def cell(c: str, lo: float, hi: float) -> Column:
        width = (hi - lo) / bins if hi > lo else 1.0
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))

    return both.groupBy(cell("x", st[0], st[1]).alias("x_bin"), cell("y", st[2], st[3]).alias("y_bin")).agg(F.count(F.lit(1)).alias("n"))


def audit_report(df: DataFrame, target: str, skew_threshold: float = 0.75, corr_threshold: float = 0.8,
                 z_threshold: float = 4.0) -> DataFrame:
    """The whole audit in long form (section, column, other, metric, value).

    Sections: target (its summary), missing (per cent null), skew (population
    skewness above the threshold), corr (with the target), collinear (pairs
    above the threshold), outliers (counts beyond the z threshold) and
    variance (distinct values and share of the commonest; see ``low_variance``).
    """
    numbers = numeric_columns(df, [target])
    texts = string_columns(df)

    def long(frame: DataFrame, section: str, values: Sequence[str], column: str = "column", other: str | None = None) -> DataFrame:
        cells = F.explode(F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values]))
        second = F.col(other) if other else F.lit(None).cast("string")
        return frame.select(F.lit(section).alias("section"), F.col(column).alias("column"), second.alias("other"),
                            cells.alias("c")).select("section", "column", "other", "c.*")

    parts = [long(target_summary(df, target), "target", ["n", "skew", "min", "max", "mean", "median"]),
             long(missing_report(df, label=target), "missing", ["pct_missing"]),
             long(low_variance(df, numbers + texts), "variance", ["n_distinct", "top_share"])]
    if numbers:
        parts += [long(skewness_report(df, numbers, skew_threshold).where("is_skewed"), "skew", ["skew"]),
                  long(corr_with_target(df, numbers, target), "corr", ["corr"]),
                  long(high_corr_pairs(df, numbers, corr_threshold), "collinear", ["abs_corr"], "col_a", "col_b"),
                  long(z_outliers(df, numbers, z_threshold), "outliers", ["n_outliers"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
