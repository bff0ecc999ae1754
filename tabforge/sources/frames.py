"""Table loading and the standard frames the query catalogue runs on.

The test tables hold no nulls, so the frames inject them deterministically
from key values; the DuckDB oracle builds the same frames in SQL
(``tabforge.plans.oracle``).  Frames only rename, derive and aggregate
columns of the given tables, so their size grows with the tables.

* P  part as a house-like table: ``nbhd`` (25 brands, like Neighborhood),
     ``front`` (size, null on key%7=3), ``semcat``/``gencat`` (type, null on
     key%5=0 / key%11=0), ``y`` retail price.
* C  customers with their orders aggregated: ``x1`` order count, ``x2``
     account balance, ``seg``, ``nat``, label ``y = ln(1+sum(totalprice))``.
* K  customers by 13 counts and sums over their orders and lines, balance
     ``acct`` (null on key%9=4) and segment ``seg`` (null on key%7=3).
* L  lineitem numeric columns, with nulls in ``q`` (linenumber 7) and
     ``t`` (orderkey%13=0) for the null-safe feature operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def frame_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return part.select(
        k.alias("id"),
        F.col("p_brand").alias("nbhd"),
        F.when(k % 7 == 3, F.lit(None)).otherwise(F.col("p_size").cast("double")).alias("front"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("semcat"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("gencat"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("y"),
    )


def order_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders pre-aggregated per customer (map-side partial agg, then one shuffle on custkey)."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("x1"), F.sum("o_totalprice").alias("spend"))


def frame_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    stats = order_stats(spark, sf_dir)
    return (cust.join(stats, cust.c_custkey == stats.o_custkey)
            .select(F.col("c_custkey").alias("id"),
                    F.col("x1").cast("double").alias("x1"),
                    F.col("c_acctbal").alias("x2"),
                    F.col("c_mktsegment").alias("seg"),
                    F.col("c_nationkey").alias("nat"),
                    F.log1p("spend").alias("y")))


def frame_c_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers (with or without orders), features only: the table to score."""
    cust = table(spark, sf_dir, "customer")
    stats = order_stats(spark, sf_dir)
    return (cust.join(stats, cust.c_custkey == stats.o_custkey, "left")
            .select(F.col("c_custkey").alias("id"),
                    F.coalesce(F.col("x1"), F.lit(0)).cast("double").alias("x1"),
                    F.col("c_acctbal").alias("x2"),
                    F.col("c_mktsegment").alias("seg"),
                    F.col("c_nationkey").alias("nat")))


K_COMPLETE = ("n_orders", "n_urgent", "n_f", "n_o", "n_lines", "sum_qty", "max_qty", "min_qty", "n_r", "n_a", "max_line", "n_plain", "nat")


def frame_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are summed per order and orders per customer, each with partial aggregation, before any join."""
    def n(cond) -> Column:
        return F.count_if(cond).cast("double")

    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("sum_qty"), F.max("l_quantity").alias("max_qty"),
        F.min("l_quantity").alias("min_qty"), n(F.col("l_returnflag") == "R").alias("n_r"), n(F.col("l_returnflag") == "A").alias("n_a"),
        F.max("l_linenumber").cast("double").alias("max_line"), n(F.col("l_discount") == 0).alias("n_plain"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    o = orders.join(li, orders.o_orderkey == li.l_orderkey).groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"), n(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        n(F.col("o_orderstatus") == "F").alias("n_f"), n(F.col("o_orderstatus") == "O").alias("n_o"),
        *[F.sum(c).alias(c) for c in ("n_lines", "sum_qty", "n_r", "n_a", "n_plain")],
        F.max("max_qty").alias("max_qty"), F.min("min_qty").alias("min_qty"), F.max("max_line").alias("max_line"))
    cust, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    return cust.join(o, key == o.o_custkey).select(
        key.alias("id"), *[F.col(c) for c in K_COMPLETE[:-1]], F.col("c_nationkey").cast("double").alias("nat"),
        F.when(key % 9 == 4, F.lit(None)).otherwise(F.col("c_acctbal")).alias("acct"),
        F.when(key % 7 == 3, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("seg"))


L_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def frame_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", *L_NUMERIC,
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_quantity")).alias("q"),
        F.when(F.col("l_orderkey") % 13 == 0, F.lit(None)).otherwise(F.col("l_tax")).alias("t"),
    )
