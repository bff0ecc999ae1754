"""Secret scans with an incremental blob ledger, DataFrame functions only.

Every version of every path is content-addressed: its blob is the SHA-256 of
its text (null counts as empty).  The ledger, Parquet under a shared folder,
remembers which (blob, rule version) pairs were scanned and what was found; a
scan reads only the blobs whose pair is missing, one text per blob, and joins
the findings back to all paths that hold the blob.  The rule version is a hash
of the rules, so changed rules scan again.

Findings are written before the pairs are marked as scanned: a run that dies
between the two scans those blobs again, and equal findings collapse.

A rule finds leftmost non-overlapping matches; a match is kept when its tested
group is long enough.  Spans are code points, end exclusive.  Positions come
from the lengths of the pieces between matches, summed in order per text.
Rows with null or repeated paths are each joined to their blob; extra columns
stay; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from tabforge.session import scratch_dir

from .common import fresh, whole_text, written


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 1       # characters that the tested group needs
    group: int = 0
    needs: tuple = ()    # every match contains one of these, in either case; texts without them are not searched


# Fixed rules of the contract, in their order.
BASE_RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
         r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2,
         ("passw", "secret", "token", "apikey", "api_key")),
    Rule("access", r"AKIA[A-Z0-9]+", 16, 0, ("akia",)),
    Rule("hex", r"[0-9a-f]{32,}", 32),  # a maximal run, so the same as the long ones among [0-9a-f]+
)
# Added by this operator.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0, ("private key-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, 0, ("eyj",)),
    Rule("userinfo", r"://[A-Za-z0-9._%+-]+:[A-Za-z0-9._%+-]+@", 8, 0, ("://",)),
)
RULES = BASE_RULES + MORE_RULES


def rule_version(rules=RULES) -> str:
    return hashlib.sha256(json.dumps([vars(r) for r in rules]).encode()).hexdigest()[:16]


def blob_of(text: Column) -> Column:
    return F.sha2(whole_text(text), 256)


def _present(text: Column, lowered: Column, rule: Rule) -> Column:
    """Whether a text can hold a match, by a plain search where the rule has literals."""
    if not rule.needs:
        return text.rlike(rule.pattern)
    out = F.lit(False)
    for literal in rule.needs:
        out = out | lowered.contains(literal)
    return out


def _hits(text: Column, lowered: Column, number: int, rule: Rule) -> Column:
    """Per match: rule number, order, length of the piece before it, of the match, of the tested group."""
    pattern = F.lit(rule.pattern)

    def lengths(found: Column) -> Column:
        return F.transform(found, lambda x: F.length(x).cast("long"))

    found = F.regexp_extract_all(text, pattern, 0)
    hits = F.transform(
        F.arrays_zip(lengths(F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found))).alias("gap"),
                     lengths(found).alias("width"),
                     lengths(F.regexp_extract_all(text, pattern, rule.group)).alias("tested")),
        lambda m, i: F.struct(F.lit(number).alias("rule"), i.alias("i"), m["gap"].alias("gap"),
                              m["width"].alias("width"), m["tested"].alias("tested")))
    none = F.array().cast("array<struct<rule:int,i:int,gap:bigint,width:bigint,tested:bigint>>")
    return F.when(_present(text, lowered, rule), hits).otherwise(none)


def find_spans(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, kind_no, kind, start, end) for every kept match in (blob, text)."""
    text, lowered = F.col("text"), F.col("lowered")
    blobs = blobs.withColumn("lowered", F.lower("text"))
    hits = blobs.select("blob", F.inline(F.concat(*[_hits(text, lowered, k, r) for k, r in enumerate(rules)])))
    upto = Window.partitionBy("blob", "rule").orderBy("i")  # the matches of one text
    end = F.sum(F.col("gap") + F.col("width")).over(upto)
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("rule") + 1)
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rule") + 1)
    return (hits.withColumn("end", end).filter(F.col("tested") >= least)
            .select("blob", F.col("rule").alias("kind_no"), kind.alias("kind"),
                    (F.col("end") - F.col("width")).alias("start"), "end"))


_SCANNED = "blob string, version string"
_FINDINGS = "blob string, kind_no int, kind string, start long, end long, version string"


class BlobLedger:
    """Scanned (blob, rule version) pairs and their findings under ``path``."""

    def __init__(self, spark: SparkSession, path: str, rules=RULES):
        self.spark, self.path, self.rules, self.version = spark, path.rstrip("/"), rules, rule_version(rules)

    def _read(self, name: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def is_new(self) -> bool:
        return self._read("scanned", _SCANNED) is None

    def scanned(self) -> DataFrame:
        rows = self._read("scanned", _SCANNED)
        rows = self.spark.createDataFrame([], _SCANNED) if rows is None else rows
        return rows.filter(F.col("version") == self.version)

    def findings(self) -> DataFrame:
        rows = self._read("findings", _FINDINGS)
        rows = self.spark.createDataFrame([], _FINDINGS) if rows is None else rows
        return rows.filter(F.col("version") == self.version).drop("version").distinct()

    def scan(self, versions: DataFrame, text: str = "text") -> DataFrame:
        """Scan the unseen blobs of ``versions``; return (blob) of every row, in a column named ``blob``, all columns kept but the text."""
        blob, name = blob_of(F.col(text)), fresh(versions, "blob")
        paths = written(versions.withColumn(name, blob).drop(text), "secret-paths")
        unseen = paths.select(F.col(name).alias("blob")).distinct()
        texts = versions.select(blob.alias("blob"), whole_text(F.col(text)).alias("text"))
        if not self.is_new():  # else every blob is unseen and no row needs a join
            unseen = written(unseen.join(self.scanned().select("blob"), "blob", "left_anti"), "secret-unseen")
            texts = texts.join(unseen, "blob", "left_semi")
        # each task sends at most one text per blob
        one = texts.groupBy("blob").agg(F.first("text").alias("text"))
        version = F.lit(self.version).alias("version")
        find_spans(one, self.rules).select("*", version).write.mode("append").parquet(f"{self.path}/findings")
        unseen.select("blob", version).write.mode("append").parquet(f"{self.path}/scanned")
        return paths


def secret_report(docs: DataFrame, ledger: BlobLedger) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of ``docs``."""
    paths = ledger.scan(docs.select("doc_id", "text"))
    n_base = len(BASE_RULES)
    span = F.struct("start", "kind_no", F.concat_ws(":", "kind", "start", "end").alias("s"))
    base = F.col("kind_no") < n_base
    per_blob = ledger.findings().groupBy("blob").agg(
        F.sort_array(F.collect_list(span)).alias("all"),
        *[F.sum((F.col("kind_no") == k).cast("long")).alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)],
        F.sort_array(F.collect_list(F.when(base, span))).alias("base"))
    texts = written(per_blob.select("blob", *[f"n_{r.kind}" for r in BASE_RULES], F.array_join("base.s", ",").alias("base"),
                                    F.array_join("all.s", ",").alias("spans")), "secret-texts")
    joined = paths.join(texts, "blob", "left")
    return joined.select("doc_id", *[F.coalesce(f"n_{r.kind}", F.lit(0).cast("long")).alias(f"n_{r.kind}") for r in BASE_RULES],
                         F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                         F.coalesce("spans", F.lit("")).alias("spans"))


def fresh_ledger(spark: SparkSession) -> BlobLedger:
    return BlobLedger(spark, scratch_dir(spark, "secret-ledger"))
