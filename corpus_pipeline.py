"""Corpus pipeline: toxicity, exact dedup, near-duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  Every stage
works on all that its predecessor kept; all but the last return the columns of
``docs`` itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabforge.llm import exact_dedup, mixing, packing, simhash, toxicity
from tabforge.llm.common import documents, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash_dedup", drop_near_copies),
          ("source_mix", mix_sources), ("packing", pack)]

# The learned score, the fingerprints' vote and the optimal boundaries have no SQL form:
# tests/llm/test_pipeline.py checks the rows against a brute-force run instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
