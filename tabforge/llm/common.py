"""Helpers shared by the corpus operators: scratch tables, word counts, global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.session import scratch_dir

# White space of the corpus contracts, inside a regular-expression character class.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back.

    This cuts the lineage with files that every executor can read again after
    a loss, and later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def whole_text(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text as long; null has none.

    Every word and the white space after it become one character.
    """
    body = F.regexp_replace(whole_text(text), f"^[{SPACE}]+", "")
    return F.length(F.regexp_replace(body, f"[^{SPACE}]++[{SPACE}]*+", "w")).cast("long")


def text_key(text: Column) -> Column:
    """64-bit hash of a text; null differs from empty."""
    return F.xxhash64(F.when(text.isNull(), F.lit(1)).otherwise(F.lit(0)), text)


_POSITION_BITS = 33  # of monotonically_increasing_id: partition above, position below


def globally_indexed(df: DataFrame, order: list[str], index: str, name: str) -> DataFrame:
    """``df`` with ``index`` = 0-based rank in the order of the columns ``order``.

    One range exchange; no task ever sees more than its own range.  The sorted
    table is written with (partition, position); the rank is the position plus
    the number of rows in earlier partitions (one number per partition).
    Rows equal in all ``order`` columns get consecutive ranks in any order.
    """
    spark = df.sparkSession
    mid = fresh(df, "_mid")
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(spread.withColumn(mid, F.monotonically_increasing_id()), name)
    part = F.shiftright(F.col(mid), _POSITION_BITS)
    counts = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("p")).count().collect())
    offsets, below = [], 0
    for p, n in counts:
        offsets.append((p, below))
        below += n
    schema = T.StructType([T.StructField("_part", T.LongType()), T.StructField("_below", T.LongType())])
    start = F.broadcast(spark.createDataFrame(offsets, schema))  # one row per partition
    position = F.col(mid).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (placed.join(start, part == F.col("_part"))
            .withColumn(index, F.col("_below") + position).drop("_part", "_below", mid))
