"""Scans and sinks: CSV with NA tokens, Parquet, JSON reports, previews, shapes.

Sinks write to a folder the caller names; on a cluster that folder lives on
the shared file system (see ``tabforge.session.scratch_dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

NA_TOKEN = "NA"


def read_csv_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   na_token: str = NA_TOKEN) -> DataFrame:
    """CSV with a header row; ``NA`` (and empty) become null, ``None`` stays a string.

    Pass an explicit schema on large inputs: inference costs a full extra scan.
    """
    reader = spark.read.option("header", True).option("nullValue", na_token).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv_table(df: DataFrame, path: str, na_token: str = NA_TOKEN) -> str:
    """CSV result sink with a header and no index column (one part file per task)."""
    df.write.mode("overwrite").option("header", True).option("nullValue", na_token).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_json_report(df: DataFrame, path: str) -> str:
    """JSON-lines report sink (one object per report row)."""
    df.write.mode("overwrite").json(path)
    return path


def read_json_report(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First n rows by key (``head()``): a top-n sort, not a full sort."""
    return df.orderBy(F.col(key)).limit(n)


def shape_report(df: DataFrame, name: str = "table") -> DataFrame:
    """(table, n_rows, n_cols): a count job plus the schema width."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def scored_table(pred: DataFrame, id_col: str = "Id", pred_col: str = "prediction",
                 out_col: str = "SalePrice") -> DataFrame:
    """Id + prediction mapped back from the log1p scale."""
    return pred.select(F.col(id_col), F.expm1(F.col(pred_col)).alias(out_col))
