"""Derived columns, ordinal code maps and code casts (stateless or median-fitted)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.exprs import code_map, null_safe_sum, presence_flag
from tabforge.operators.base import ColumnEstimator, ColumnModel, ColumnTransformer
from tabforge.operators.clean import GroupMedianImputer


@dataclass
class DerivedSpec:
    """Derived-column spec: null-safe weighted sums, differences, presence flags."""

    sums: dict[str, list[tuple[str, float]]] = field(default_factory=dict)   # name -> [(col, weight)]
    diffs: dict[str, tuple[str, str]] = field(default_factory=dict)          # name -> (a, b): a - b, null propagates
    flags: dict[str, str] = field(default_factory=dict)                      # name -> col: (col > 0) as int, null -> 0

    def columns(self, available: Sequence[str]) -> dict[str, Column]:
        have = set(available)
        out: dict[str, Column] = {}
        for name, terms in self.sums.items():
            present = [(c, w) for c, w in terms if c in have]
            if present:
                out[name] = null_safe_sum([c for c, _ in present], [w for _, w in present])
        for name, (a, b) in self.diffs.items():
            if a in have and b in have:
                out[name] = F.col(a) - F.col(b)
        for name, c in self.flags.items():
            if c in have:
                out[name] = presence_flag(c)
        return out


class DerivedColumns(ColumnTransformer):
    def __init__(self, spec: DerivedSpec):
        super().__init__()
        self.spec = spec

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.spec.columns(dataset.columns)
        return dataset.withColumns(cols) if cols else dataset


class FeatureEngineer(ColumnEstimator):
    """Optional group-median fill of one column, then the derived columns.

    ``fill=None`` gives the variant without the fill; the median state is fitted
    only when a fill is requested.
    """

    def __init__(self, spec: DerivedSpec, fill: tuple[str, str] | None = None):
        super().__init__()
        self.spec, self.fill = spec, fill

    def _fit(self, dataset: DataFrame) -> FeatureEngineerModel:
        filler = None
        if self.fill is not None and all(c in dataset.columns for c in self.fill):
            filler = GroupMedianImputer(*self.fill).fit(dataset)
        return FeatureEngineerModel(self.spec, filler)


class FeatureEngineerModel(ColumnModel):
    def __init__(self, spec, filler):
        super().__init__()
        self.spec, self.filler = spec, filler

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.filler.transform(dataset) if self.filler is not None else dataset
        return DerivedColumns(self.spec).transform(out)


class OrdinalMapper(ColumnTransformer):
    """Map listed string columns through value->code dictionaries; unknown or null -> default."""

    def __init__(self, maps: Mapping[str, Mapping[str, float | int]], default: float | int = 0, as_double: bool = True):
        super().__init__()
        self.maps, self.default, self.as_double = dict(maps), default, as_double

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = {}
        for c, m in self.maps.items():
            if c in dataset.columns:
                e = code_map(m, c, self.default)
                cols[c] = e.cast("double") if self.as_double else e
        return dataset.withColumns(cols) if cols else dataset


class CastColumns(ColumnTransformer):
    """Cast listed columns that exist (e.g. an integer code to a nominal string)."""

    def __init__(self, cols: Sequence[str], to: str = "string"):
        super().__init__()
        self.cols, self.to = list(cols), to

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = {c: F.col(c).cast(self.to) for c in self.cols if c in dataset.columns}
        return dataset.withColumns(cols) if cols else dataset
