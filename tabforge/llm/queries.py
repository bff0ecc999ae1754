"""The registered queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (clustering, exact_dedup, line_dedup, mixing, packing, pii, quality_rules, secret_scan, sharding, simhash,
               toxicity, url_filter, whitening)
from .common import documents, table
from .oracle import ORACLE  # noqa: F401  re-exported for the driver


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op1_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.passage_report(documents(spark, sf_dir))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judged(table(spark, sf_dir, "pages"), model)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(documents(spark, sf_dir), secret_scan.fresh_ledger(spark))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(documents(spark, sf_dir))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(documents(spark, sf_dir))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_report(table(spark, sf_dir, "embeddings"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(documents(spark, sf_dir))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_url_filter, op3_toxicity, op4_source_mix, op5_exact_dedup, op6_quality_rules, op7_secret_scan,
    op8_packing, op9_simhash_dedup, op10_sharding, op1_passage_dedup, op11_centroid_clustering, op12_pii,
    op13_embedding_whitening)}
