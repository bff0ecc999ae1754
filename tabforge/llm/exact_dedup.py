"""Exact deduplication by two-pass Bloom filtering, DataFrame functions only.

Pass 1 counts, for every text hash, two Bloom slots; the slots hit twice or
more become bitmaps of a bounded size, which are broadcast.  Pass 2 tests every
row: a row with a slot hit once only is alone and passes straight through; the
rest ("possibly repeated") are grouped by the SHA-256 of the normalised text.

Only slot counts (12 bytes a slot, summed before the shuffle) and the possibly
repeated rows move.  A false positive of the filter only costs a row of
shuffle, never a wrong answer.

Texts are equal when identical after deleting ``[\\x20\\x09-\\x0D]``; null
counts as empty, so null and empty texts form one group.  Of equal texts the
row with the most code points stays, then the smallest doc_id (null last); of
rows equal in that too, exactly one.  Empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, fresh, whole_text, written

_BLOCK = 32768  # bits of one bitmap of bitmap_construct_agg
# Upper bound of each of the two bitmaps: 2^27 bits = 16 MB.  Beyond ~10^8 rows the filter
# saturates and lets more rows through; results stay exact, and what shuffles is 60 bytes a row.
MAX_FILTER_BITS = 1 << 27


def normalised(text: Column) -> Column:
    return F.regexp_replace(whole_text(text), f"[{SPACE}]+", "")


def filter_bits(n_rows: int, max_bits: int = MAX_FILTER_BITS) -> int:
    """Slots of each hash function: 8 to 16 per row, a power of two, bounded."""
    return min(max_bits, 1 << max(16, math.ceil(math.log2(max(1, 8 * n_rows)))))


def _slots(h: Column, bits: int) -> list[Column]:
    return [F.pmod(h, F.lit(bits)), F.pmod(F.xxhash64(h, F.lit(1)), F.lit(bits))]


def repeat_bitmaps(hashes: DataFrame, column: str, bits: int, least: int = 2) -> list[DataFrame]:
    """For both hash functions, bitmaps (block, bitmap) of the slots that ``least`` rows or more hit."""
    h = F.col(column)
    s1, s2 = _slots(h, bits)
    hit = (hashes.select(F.explode(F.array(s1, s2 + F.lit(bits))).alias("slot"))
           .groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least))
    maps = written(hit.groupBy(F.expr(f"slot div {_BLOCK}").alias("block"))
                   .agg(F.expr(f"bitmap_construct_agg(slot % {_BLOCK})").alias("bitmap")), "repeat-bitmaps")
    blocks = bits // _BLOCK
    return [maps.filter(F.col("block") < blocks),
            maps.filter(F.col("block") >= blocks).withColumn("block", F.col("block") - blocks)]


def with_repeat_flag(df: DataFrame, h: Column, maps: list[DataFrame], bits: int, flag: str) -> DataFrame:
    """``df`` with ``flag``: true when every slot of the row's hash is set in the bitmaps."""
    flags = []
    keep = df.columns
    for k, (slot, bitmap) in enumerate(zip(_slots(h, bits), maps)):
        block, bits_col, pos, ok = (fresh(df, f"_{x}{k}") for x in ("block", "bitmap", "pos", "hit"))
        small = bitmap.select(F.col("block").alias(block), F.col("bitmap").alias(bits_col))
        df = df.withColumn(pos, slot)
        # at most bits/32768 rows of 4 KB: 16 MB by filter_bits
        df = df.join(F.broadcast(small), F.expr(f"`{pos}` div {_BLOCK}") == F.col(block), "left")
        byte = F.expr(f"conv(hex(substring(`{bits_col}`, cast(`{pos}` % {_BLOCK} div 8 as int) + 1, 1)), 16, 10)")
        bit = F.expr(f"cast(`{pos}` % 8 as int)")
        df = df.withColumn(ok, F.coalesce(F.getbit(byte.cast("int"), bit) == 1, F.lit(False)))
        flags.append(F.col(ok))
    return df.select(*[F.col(f"`{c}`") for c in keep], (flags[0] & flags[1]).alias(flag))


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    norm = normalised(F.col("text"))
    rows = written(docs.select(
        "doc_id", F.length(whole_text(F.col("text"))).alias("n_chars"), F.unhex(F.sha2(norm, 256)).alias("sha"))
        .withColumn("rid", F.monotonically_increasing_id())  # names a row from here on: the table is written once
        .withColumn("h", F.xxhash64("sha")), "dedup-rows")
    bits = filter_bits(rows.count())
    tested = with_repeat_flag(rows, F.col("h"), repeat_bitmaps(rows, "h", bits), bits, "maybe")
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    alone = tested.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha)
    maybe = tested.filter("maybe").select("doc_id", "n_chars", "sha", "rid")
    first = F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"),
                           F.col("doc_id").alias("doc_id"), F.col("rid").alias("rid")))
    groups = written(maybe.groupBy("sha").agg(first.alias("f"), F.count(F.lit(1)).alias("group_size"))
                     .select("sha", F.col("f.doc_id").alias("keep_id"), F.col("f.rid").alias("keep_rid"),
                             "group_size"), "dedup-groups")
    grouped = maybe.join(groups, "sha").select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), sha)
    return alone.unionByName(grouped)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows that the filter proves alone pass without a shuffle.  Of the others
    ``row_number() = 1`` keeps one per group; Spark limits each task to one row
    per group before the exchange, so a group of any size is no hot partition.
    """
    h, flag, sha, rank = (fresh(docs, x) for x in ("_h", "_maybe", "_sha", "_rank"))
    norm = normalised(F.col("text"))
    hashes = written(docs.select(F.xxhash64(norm).alias("h")), "dedup-hashes")
    bits = filter_bits(hashes.count())
    tested = with_repeat_flag(docs, F.xxhash64(norm), repeat_bitmaps(hashes, "h", bits), bits, flag)
    cols = [F.col(f"`{c}`") for c in docs.columns]
    alone = tested.filter(~F.col(flag)).select(*cols)
    order = Window.partitionBy(sha).orderBy(F.length(whole_text(F.col("text"))).desc(),
                                            F.col("doc_id").asc_nulls_last())
    grouped = (tested.filter(F.col(flag)).withColumn(sha, F.sha2(norm, 256))
               .withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).select(*cols))
    return alone.unionByName(grouped)
