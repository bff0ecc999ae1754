"""Encoders and scalers fitted on training rows and applied as column expressions.

Fitted state is a dictionary per column (levels, medians, encodings) whose
size is bounded by the number of distinct levels; it is checked at fit and
inlined as literals, or joined as a DataFrame beyond ``MAX_LITERAL_ENTRIES``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.exprs import code_map
from tabforge.functions.quantiles import exact_quantiles
from tabforge.operators.audit import value_counts
from tabforge.operators.base import MAX_LITERAL_ENTRIES, ColumnEstimator, ColumnModel
from tabforge.session import checkpoint_once

MAX_ONE_HOT_LEVELS = 1000


def _slug(v: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]+", "_", str(v))


class OneHotEncoder(ColumnEstimator):
    """One 0/1 DOUBLE column per level seen at fit (sorted), unseen or null -> all zeros.

    Output names ``{col}_{level}``; the input columns are dropped.
    """

    def __init__(self, cols: Sequence[str], max_levels: int = MAX_ONE_HOT_LEVELS):
        super().__init__()
        self.cols, self.max_levels = list(cols), max_levels

    def _fit(self, dataset: DataFrame) -> OneHotModel:
        levels: dict[str, list[str]] = {c: [] for c in self.cols}
        if self.cols:
            # one row more than all columns together may hold: a wide column shows without its levels reaching the driver
            bound = len(self.cols) * self.max_levels + 1
            for r in value_counts(dataset, self.cols).select("column", "value").limit(bound).collect():
                levels[r["column"]].append(r["value"])
        for c, lv in levels.items():
            if len(lv) > self.max_levels:
                raise ValueError(f"{c}: {len(lv)} or more levels exceed max_levels={self.max_levels}; "
                                 "use TargetEncoder for high-cardinality columns")
            lv.sort()
        return OneHotModel(levels)


class OneHotModel(ColumnModel):
    def __init__(self, levels: dict[str, list[str]]):
        super().__init__()
        self.levels = levels

    @property
    def output_names(self) -> dict[tuple[str, str], str]:
        """{(column, level): output name}; levels whose plain names clash get their position as a suffix."""
        plain = [(c, v, k, f"{c}_{_slug(v)}") for c, lv in self.levels.items() for k, v in enumerate(lv)]
        seen = Counter(name.lower() for *_, name in plain)
        names, used = {}, {name.lower() for *_, name in plain if seen[name.lower()] == 1}
        for c, v, k, name in plain:
            if seen[name.lower()] > 1:
                name = f"{name}_{k}"
                while name.lower() in used:
                    name += "_"
                used.add(name.lower())
            names[c, v] = name
        return names

    @property
    def output_cols(self) -> list[str]:
        return list(self.output_names.values())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        others = {c.lower() for c in dataset.columns if c not in self.levels}
        cols = {}
        for (c, v), name in self.output_names.items():
            if name.lower() in others:
                raise ValueError(f"one-hot column {name} already exists")
            cols[name] = F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0))
        return dataset.withColumns(cols).drop(*self.levels.keys())


class RobustScaler(ColumnEstimator):
    """(x - median) / (q75 - q25) with exact quantiles; a zero range divides by 1."""

    def __init__(self, cols: Sequence[str], lower: float = 0.25, upper: float = 0.75):
        super().__init__()
        self.cols, self.lower, self.upper = list(cols), lower, upper

    def _fit(self, dataset: DataFrame) -> RobustScalerModel:
        q = {}
        if self.cols:
            for r in exact_quantiles(dataset, self.cols, [self.lower, 0.5, self.upper]).collect():
                q[(r["column"], round(r["prob"], 9))] = r["value"]
        center, scale = {}, {}
        for c in self.cols:
            med = q.get((c, 0.5))
            lo, hi = q.get((c, round(self.lower, 9))), q.get((c, round(self.upper, 9)))
            center[c] = med if med is not None else 0.0
            rng = (hi - lo) if lo is not None and hi is not None else 0.0
            scale[c] = rng if abs(rng) > 10 * 2.220446049250313e-16 else 1.0
        return RobustScalerModel(center, scale)


class RobustScalerModel(ColumnModel):
    def __init__(self, center: dict, scale: dict):
        super().__init__()
        self.center, self.scale = center, scale

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: (F.col(c).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])
                                    for c in self.center if c in dataset.columns})


class TargetEncoder(ColumnEstimator):
    """Smoothed target mean per level with sigmoid shrinkage toward the prior.

    weight = 1 / (1 + exp(-(n - min_samples_leaf) / smoothing));
    enc = prior * (1 - weight) + mean * weight; a level seen once, an unseen
    level and null all get the prior.  Fitted values are replaced in place.
    """

    def __init__(self, cols: Sequence[str], label: str, min_samples_leaf: int = 20, smoothing: float = 10.0):
        super().__init__()
        self.cols, self.label = list(cols), label
        self.min_samples_leaf, self.smoothing = min_samples_leaf, smoothing

    def _fit(self, dataset: DataFrame) -> TargetEncoderModel:
        prior = dataset.agg(F.avg(self.label)).first()[0]
        long = dataset.select(self.label, *[F.col(c).cast("string").alias(c) for c in self.cols]).unpivot(
            [self.label], self.cols, "column", "value").where(F.col("value").isNotNull())
        stats = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), F.avg(self.label).alias("m"))
        w = 1.0 / (1.0 + F.exp(-(F.col("n") - F.lit(self.min_samples_leaf)) / F.lit(self.smoothing)))
        enc = F.when(F.col("n") == 1, F.lit(prior)).otherwise(F.lit(prior) * (1 - w) + F.col("m") * w)
        table = stats.select("column", "value", enc.alias("enc"))
        few = table.limit(MAX_LITERAL_ENTRIES + 1).collect()
        if len(few) <= MAX_LITERAL_ENTRIES:
            maps: dict[str, dict] = {c: {} for c in self.cols}
            for r in few:
                maps[r["column"]][r["value"]] = r["enc"]
            return TargetEncoderModel(self.cols, prior, maps=maps)
        return TargetEncoderModel(self.cols, prior, frame=table)


class TargetEncoderModel(ColumnModel):
    def __init__(self, cols, prior, maps=None, frame=None):
        super().__init__()
        self.cols, self.prior, self.maps, self.frame = cols, prior, maps, frame

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.maps is not None:
            return dataset.withColumns({c: code_map(self.maps[c], F.col(c).cast("string"), self.prior).cast("double")
                                        if self.maps[c] else F.lit(self.prior).cast("double")
                                        for c in self.cols if c in dataset.columns})
        out = dataset
        for c in self.cols:
            lk = self.frame.where(F.col("column") == c).select(F.col("value").alias(f"_k_{c}"), F.col("enc").alias(f"_e_{c}"))
            out = (out.join(lk, F.col(c).cast("string") == F.col(f"_k_{c}"), "left")
                   .withColumn(c, F.coalesce(F.col(f"_e_{c}"), F.lit(self.prior))).drop(f"_k_{c}", f"_e_{c}"))
        return out


# Levels that a first-appearance code may number: they are ordered in one task.
MAX_CODED_LEVELS = 100_000


def first_appearance_codes(df: DataFrame, col: str, order_col: str, max_levels: int = MAX_CODED_LEVELS) -> DataFrame:
    """(value, code): levels numbered 0.. in order of first appearance by ``order_col``.

    The window runs over the level dictionary only (one row per level), whose
    size is checked first; a column with more levels is no category: an error.
    """
    firsts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.min(order_col).alias("_first"))
    firsts = checkpoint_once(firsts)
    if firsts.count() > max_levels:
        raise ValueError(f"{col}: more than {max_levels} levels; too many for a coded column")
    return firsts.select("value", (F.row_number().over(Window.orderBy("_first", "value")) - 1).alias("code"))
