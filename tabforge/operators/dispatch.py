"""Column groups, each through its own transformer, side by side in one sparse feature vector.

The vector carries ML attribute metadata, so every feature has a name that can
be read back from the schema: ``<group>__<column>`` for a column that stays one
column, ``<group>__<column>_<level>`` for a one-hot level.  One-hot levels come
from Spark's StringIndexer and OneHotEncoder: all levels kept, sorted, an
unseen or null level gives no entry.  A row stores its non-zero entries only,
so 50,000 levels cost a row no more than five.  The levels of a column are held
on the driver and in the schema (that is what the metadata is), so their number
is bounded by ``max_levels`` (counted before they are collected).

A single one-hot column of more than ``TABLE_LEVELS`` levels takes another way:
its levels are numbered in a table, rows get their number by a join, and neither
the driver nor the schema holds a level.  The features are then a plain struct
with the fields of a vector, whose metadata names the table (``level_table``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder as SparkOneHotEncoder
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tabforge.operators.base import ColumnEstimator, ColumnModel
from tabforge.session import checkpoint_once, scratch_dir

MAX_LEVELS = 1_000_000
TABLE_LEVELS = 200_000


def feature_names(df: DataFrame, features_col: str = "features") -> list[str]:
    """Names of the entries of a vector column, in order, from its ML attributes."""
    attrs = df.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    named = sorted((a["idx"], a.get("name", str(a["idx"]))) for kind in attrs.values() for a in kind)
    return [name for _, name in named]


def level_table(df: DataFrame, features_col: str = "features") -> DataFrame | None:
    """(value, code, feature) of a column whose levels are in a table; None where the schema holds the names."""
    path = df.schema[features_col].metadata.get("level_table")
    return df.sparkSession.read.parquet(path) if path else None


def numbered_levels(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """(value, code, feature): the levels of ``col``, numbered from 0 in their order; ranges are numbered side by side."""
    spark = df.sparkSession
    levels = checkpoint_once(df.select(F.col(col).cast("string").alias("value")).where("value is not null").distinct())
    ranges = checkpoint_once(levels.repartitionByRange("value").withColumn("_range", F.spark_partition_id()))
    before, starts = 0, []
    for r in sorted(ranges.groupBy("_range").count().collect()):   # one row a range
        starts.append((r["_range"], before))
        before += r["count"]
    at = F.row_number().over(Window.partitionBy("_range").orderBy("value")) - 1
    codes = ranges.withColumn("_at", at).join(F.broadcast(spark.createDataFrame(starts, "_range int, _start long")), "_range")
    path = scratch_dir(spark, "levels")
    codes.select("value", (F.col("_start") + F.col("_at")).cast("int").alias("code"),
                 F.concat(F.lit(prefix), "value").alias("feature")).write.parquet(path)
    return spark.read.parquet(path)


class ColumnDispatcher(ColumnEstimator):
    """``groups``: (name, transformer, columns) in the order of the features.

    A transformer is ``"one_hot"``, ``"passthrough"`` or an estimator of this
    library with a Param ``cols`` that replaces its columns in place
    (RobustScaler, YeoJohnson, SkewRouter, TargetEncoder, ...).  It is fitted on
    working copies, so the input columns stay and a column may be in several
    groups.  A null in a number is an error unless ``handle_invalid`` is "keep"
    (NaN) or "skip" (row left out).
    """

    def __init__(self, groups: Sequence[tuple], output_col: str = "features", handle_invalid: str = "error", max_levels: int = MAX_LEVELS):
        super().__init__()
        names = [g[0] for g in groups]
        if len(set(names)) < len(names):
            raise ValueError(f"group names repeat: {names}")
        self.groups, self.output_col = [tuple(g) for g in groups], output_col
        self.handle_invalid, self.max_levels = handle_invalid, max_levels

    def _fit(self, dataset: DataFrame) -> ColumnDispatcherModel:
        copies, stages, inputs, data = {}, [], [], dataset
        for name, how, cols in self.groups:
            work = {f"{name}__{c}": c for c in cols}
            taken = {c.lower() for c in dataset.columns} & {w.lower() for w in work}
            if taken:
                raise ValueError(f"columns {sorted(taken)} already exist")
            copies |= {w: (c, how == "one_hot") for w, c in work.items()}
            if not work:
                continue
            if how == "one_hot":
                counts = dataset.agg(*[F.count_distinct(F.col(c).cast("string")).alias(w) for w, c in work.items()]).first()
                if len(self.groups) == len(work) == 1 and counts[0] > TABLE_LEVELS:
                    (w, c), = work.items()
                    return LevelTableModel(c, numbered_levels(dataset, c, f"{w}_"), counts[0], self.output_col)
                inputs += self._one_hot(dataset, work, stages, counts)
                continue
            if how != "passthrough":
                source = data.withColumns({w: F.col(c) for w, c in work.items()})
                stages.append(how.copy({how.getParam("cols"): list(work)}).fit(source))
            inputs += list(work)
        assembler = VectorAssembler(inputCols=inputs, outputCol=self.output_col, handleInvalid=self.handle_invalid)
        return ColumnDispatcherModel(copies, stages, assembler, self.output_col)

    def _one_hot(self, dataset: DataFrame, work: dict[str, str], stages: list, counts: Row) -> list[str]:
        """Adds the fitted stages of one group; gives its vector columns.  Columns without a level have none."""
        data = dataset.select(*[F.col(c).cast("string").alias(w) for w, c in work.items()])
        for w in work:
            if counts[w] > self.max_levels:
                raise ValueError(f"{work[w]}: {counts[w]} levels exceed max_levels={self.max_levels}")
        kept = [w for w in work if counts[w]]
        if not kept:
            return []
        indexer = StringIndexer(inputCols=kept, outputCols=[f"_i_{w}" for w in kept], handleInvalid="keep", stringOrderType="alphabetAsc").fit(data)
        # the vector replaces its working copy: StringIndexer has read it by then
        encoder = SparkOneHotEncoder(inputCols=indexer.getOutputCols(), outputCols=[f"_v_{w}" for w in kept], dropLast=True, handleInvalid="error")
        stages += [indexer, encoder.fit(indexer.transform(data)), _Rename({f"_v_{w}": w for w in kept}, [f"_i_{w}" for w in kept])]
        return kept


class _Rename:
    """Puts the one-hot vectors in the place of their working copies and drops the indexes."""

    def __init__(self, names: dict, drop: list):
        self.names, self.drop = names, drop

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.drop(*self.drop, *self.names.values())
        for old, new in self.names.items():
            out = out.withColumnRenamed(old, new)
        return out


class ColumnDispatcherModel(ColumnModel):
    def __init__(self, copies: dict, stages: list, assembler, output_col: str):
        super().__init__()
        self.copies, self.stages, self.assembler, self.output_col = copies, stages, assembler, output_col

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset.withColumns({w: F.col(c).cast("string") if text else F.col(c) for w, (c, text) in self.copies.items()})
        for stage in self.stages:
            out = stage.transform(out)
        return self.assembler.transform(out).select(*dataset.columns, self.output_col)


class LevelTableModel(ColumnModel):
    """One-hot features of one column with its levels in a table: a struct with the fields of a sparse vector."""

    def __init__(self, col: str, levels: DataFrame, n_levels: int, output_col: str):
        super().__init__()
        self.col, self.levels, self.n_levels, self.output_col = col, levels, n_levels, output_col

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, code = "_level_value", "_level_code"
        codes = self.levels.select(F.col("value").alias(key), F.col("code").alias(code))
        rows = dataset.join(codes, F.col(self.col).cast("string") == F.col(key), "left")
        known = F.col(code).isNotNull()
        sparse = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(self.n_levels).cast("int").alias("size"),
                          F.when(known, F.array(code)).otherwise(F.array().cast("array<int>")).alias("indices"),
                          F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))
        meta = {"ml_attr": {"num_attrs": self.n_levels}, "level_table": self.levels.inputFiles()[0].rsplit("/", 1)[0]}
        return rows.select(*[dataset[c] for c in dataset.columns], sparse.alias(self.output_col, metadata=meta))
