"""Row filters, drops and null imputation (constant, mode, group median)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tabforge.functions.exprs import not_all_true
from tabforge.functions.quantiles import exact_quantiles
from tabforge.operators.audit import typed_modes
from tabforge.operators.base import MAX_LITERAL_ENTRIES, ColumnEstimator, ColumnModel, checked_broadcast


def drop_where(df: DataFrame, cond: Column) -> DataFrame:
    """Drop rows where ``cond`` is true; rows where it is null are kept (pandas semantics)."""
    return df.where(not_all_true(cond))


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    """coalesce(c, value) for the listed columns that exist (value cast to the column type)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
                           for c, v in values.items() if c in types})


def fallback_fill(df: DataFrame, str_value: str = "None", num_value: float = 0, exclude: Sequence[str] = ()) -> DataFrame:
    """Fill every remaining null by type: strings -> str_value, numbers -> num_value."""
    fills = {}
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, StringType):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit(str_value))
        elif isinstance(f.dataType, NumericType):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit(num_value).cast(f.dataType))
    return df.withColumns(fills) if fills else df


class GroupMedianImputer(ColumnEstimator):
    """Fill ``col`` nulls with the exact median of its ``group_col`` group, else the overall median.

    A group seen at fit whose values are all null, a null group, and a group
    unseen at fit all fall through to the overall median.
    """

    def __init__(self, col: str, group_col: str):
        super().__init__()
        self.col, self.group_col = col, group_col

    def _fit(self, dataset: DataFrame) -> GroupMedianModel:
        grp = exact_quantiles(dataset, [self.col], [0.5], [self.group_col]).select(
            self.group_col, F.col("value").alias("_grp_median"))
        n_groups = grp.count()
        overall = exact_quantiles(dataset, [self.col], [0.5]).first()
        overall = overall["value"] if overall else None
        if n_groups <= MAX_LITERAL_ENTRIES:
            table = {r[self.group_col]: r["_grp_median"] for r in grp.collect()}
            return GroupMedianModel(self.col, self.group_col, overall, table=table)
        return GroupMedianModel(self.col, self.group_col, overall, frame=grp, n_groups=n_groups)


class GroupMedianModel(ColumnModel):
    def __init__(self, col, group_col, overall, table=None, frame=None, n_groups=0):
        super().__init__()
        self.col, self.group_col, self.overall = col, group_col, overall
        self.table, self.frame, self.n_groups = table, frame, n_groups

    def _transform(self, dataset: DataFrame) -> DataFrame:
        overall = F.lit(self.overall).cast("double")
        if self.table is not None:
            entries = [x for k, v in self.table.items() if k is not None for x in (F.lit(k), F.lit(v))]
            grp = F.create_map(*entries)[F.col(self.group_col)] if entries else F.lit(None).cast("double")
            return dataset.withColumn(self.col, F.coalesce(F.col(self.col), grp, overall))
        joined = dataset.join(checked_broadcast(self.frame, self.n_groups), self.group_col, "left")
        filled = F.coalesce(F.col(self.col), F.col("_grp_median"), overall).alias(self.col)
        return joined.select(*[filled if c == self.col else F.col(f"`{c}`") for c in dataset.columns])


class ModeImputer(ColumnEstimator):
    """Fill nulls with the per-column mode of the fit table (smallest value on a tie)."""

    def __init__(self, cols: Sequence[str]):
        super().__init__()
        self.cols = list(cols)

    def _fit(self, dataset: DataFrame) -> ConstantFillModel:
        cols = [c for c in self.cols if c in dataset.columns]
        return ConstantFillModel(typed_modes(dataset, cols))


class ConstantFillModel(ColumnModel):
    def __init__(self, values: dict):
        super().__init__()
        self.values = {k: v for k, v in values.items() if v is not None}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return fill_constants(dataset, self.values)


class RoleImputer(ColumnEstimator):
    """Role-driven null filling.

    semantic_cat -> ``"None"``, semantic_num -> 0 (null means "absent"),
    genuine_cat -> mode fitted on the fit table, then (if ``fallback``) every
    other string -> ``"None"`` and number -> 0.
    """

    def __init__(self, semantic_cat=(), semantic_num=(), genuine_cat=(), genuine_num_median=(),
                 fallback: bool = True, str_value: str = "None", num_value: float = 0):
        super().__init__()
        self.semantic_cat, self.semantic_num = list(semantic_cat), list(semantic_num)
        self.genuine_cat, self.genuine_num_median = list(genuine_cat), list(genuine_num_median)
        self.fallback, self.str_value, self.num_value = fallback, str_value, num_value

    def _fit(self, dataset: DataFrame) -> RoleImputerModel:
        modes = typed_modes(dataset, [c for c in self.genuine_cat if c in dataset.columns])
        medians = {}
        cols = [c for c in self.genuine_num_median if c in dataset.columns]
        if cols:
            for r in exact_quantiles(dataset, cols, [0.5]).collect():
                medians[r["column"]] = r["value"]
        return RoleImputerModel(self, modes, medians)


class RoleImputerModel(ColumnModel):
    def __init__(self, spec: RoleImputer, modes: dict, medians: dict):
        super().__init__()
        self.spec, self.modes, self.medians = spec, modes, medians

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.spec
        fills = {c: s.str_value for c in s.semantic_cat}
        fills.update({c: s.num_value for c in s.semantic_num})
        fills.update({c: v for c, v in self.modes.items() if v is not None})
        fills.update({c: v for c, v in self.medians.items() if v is not None})
        out = fill_constants(dataset, fills)
        return fallback_fill(out, s.str_value, s.num_value) if s.fallback else out
