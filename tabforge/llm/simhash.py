"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits: bit i is set when over half of the shingle hashes
(XXH64, seed 42) have it.  Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are
lower-cased; shingles are 3 words, repeats included (fewer words: the whole
sequence; none or null text: fingerprint zero).

Candidate search.  Two fingerprints at most 2 bits apart are at most 1 bit
apart in one of the two 31-bit parts (bits 0-30 and 31-61).  In each part the
codewords of the Hamming code [31, 26] are the anchors: a perfect covering
code of radius 1.  A fingerprint is a member of its nearest anchor; it is
replicated to every anchor within covering radius + threshold = 2 bits of its
part (its own, and the 15 others at distance 2, or none when it is a codeword
itself).  So the anchor of either of two linked fingerprints sees both, and a
member is compared with the replicas at its anchor, in one equi-join.

There are 2^26 anchors a part, so the fingerprints that meet at one grow with
the corpus.  Where a fingerprint would meet more than ``MAX_MEETINGS`` others,
an anchor is keyed together with untouched bits as well: of the 33 bits outside
the part a linked pair differs in 2 at most, so it agrees in one whole block of
three of 11 bits, and members and replicas carry (anchor, block, its bits), once
for each block.  That divides the meetings by about 2^11 / 3 and loses no pair.

Only distinct fingerprints take part; copies share one.  Components come from
the large-star / small-star iteration over the links, with min aggregates.
An empty table gives an empty result.  Rows with a null doc_id are grouped
like others; a component's id is its smallest non-null doc_id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tabforge.session import ship_package

from .common import fresh, text_key, written

SHINGLE = 3
MAX_BITS = 2
_PART_BITS = 31
_PARTS = (0, 31)
_BLOCKS, _BLOCK_BITS = 3, 11  # of the bits outside a part: one block more than the 2 bits that may differ
_ANCHORS = 1 << 26            # codewords of the [31, 26] code
MAX_MEETINGS = 64             # expected replicas that a member meets before anchors are keyed with blocks
_REPLICA_BYTES, _PARTITION_BYTES = 24, 256 << 20
_BLOCK = 1 << 16  # shingles counted at once: bounds the memory of a very long text


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    import xxhash
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words)))
    starts = np.concatenate([[0], ends[:last - 1]]).tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, last, _BLOCK):
        h = np.array([digest(joined[i:j], 42) for i, j in zip(starts[a:a + _BLOCK], stops[a:a + _BLOCK])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""
    @pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return simhash(text)


def _syndrome(part: Column) -> Column:
    """Position (1-31) of the one bit in which a 31-bit word differs from its nearest codeword; 0 for a codeword.

    Bit i of the word carries position i + 1; the syndrome is the xor of the
    positions of its set bits, taken as five parities over fixed masks.
    """
    out = F.lit(0)
    for k in range(5):
        mask = sum(1 << i for i in range(_PART_BITS) if (i + 1) >> k & 1)
        out = out.bitwiseOR(F.shiftleft((F.bit_count(part.bitwiseAND(F.lit(mask))) % 2).cast("int"), k))
    return out


def _flip(word: Column, position: Column) -> Column:
    """Toggle bit ``position`` (1-based; 0 toggles nothing)."""
    bit = F.when(position == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("long"), (position - 1).cast("int")))
    return word.bitwiseXOR(bit)


def anchors(part: Column) -> tuple[Column, Column]:
    """(the nearest anchor, all anchors within 2 bits) of a 31-bit word.

    With syndrome s, flipping positions p and q gives a codeword exactly when
    p xor q = s: position s alone (q = 0) is the nearest anchor, the 15 pairs
    with p < q are those at distance 2.
    """
    s = _syndrome(part)
    pairs = F.filter(F.sequence(F.lit(1), F.lit(_PART_BITS)), lambda p: p < p.bitwiseXOR(s))
    others = F.transform(pairs, lambda p: _flip(_flip(part, p), p.bitwiseXOR(s)))
    nearest = _flip(part, s)
    return nearest, F.array_distinct(F.concat(F.array(nearest), others))


def blocks_for(n: int, max_meetings: int = MAX_MEETINGS) -> int:
    """Blocks that anchors are keyed with for ``n`` distinct fingerprints: 1 (none) or 3."""
    return 1 if 2 * 16 * n <= max_meetings * _ANCHORS else _BLOCKS


def _keys(part: int, fp: Column, words: Column, blocks: int) -> Column:
    """Array of the join keys of the anchors ``words``: anchor, bits of the block, block and part in one long."""
    low = _PARTS[part]
    # the bits above the part, then those below it
    rest = F.shiftrightunsigned(fp, _PART_BITS) if low == 0 else (
        fp.bitwiseAND(F.lit((1 << low) - 1)).bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, low + _PART_BITS), low)))

    def of_block(block: int) -> Column:
        bits = (F.lit(0).cast("long") if blocks == 1 else
                F.shiftrightunsigned(rest, block * _BLOCK_BITS).bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1)))
        tail = F.shiftleft(bits, 3).bitwiseOR(F.lit(2 * block + part).cast("long"))
        return F.transform(words, lambda a: F.shiftleft(a, _BLOCK_BITS + 3).bitwiseOR(tail))
    return F.concat(*[of_block(block) for block in range(blocks)])


def members_and_replicas(fingerprints: DataFrame, blocks: int = 1) -> tuple[DataFrame, DataFrame]:
    """(a, key) of every fingerprint at its nearest anchors and (b, key) at all anchors within reach."""
    fp, own, near = F.col("fp"), [], []
    for k, low in enumerate(_PARTS):
        nearest, within = anchors(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << _PART_BITS) - 1)))
        own.append(_keys(k, fp, F.array(nearest), blocks))
        near.append(_keys(k, fp, within, blocks))
    return (fingerprints.select(fp.alias("a"), F.explode(F.concat(*own)).alias("key")),
            fingerprints.select(fp.alias("b"), F.explode(F.concat(*near)).alias("key")))


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, max_meetings: int = MAX_MEETINGS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fp`` at most ``max_bits`` (2) bits apart."""
    if max_bits > 2:
        raise ValueError("two parts of radius-1 anchors cover distances up to 2")
    n = fingerprints.count()
    blocks = blocks_for(n, max_meetings)
    # a narrow exchange first: each row becomes 32 or 96, more than its bytes let Spark foresee
    spread = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members, replicas = members_and_replicas(fingerprints.repartition(spread, "fp"), blocks)
    needed = n * 32 * blocks * _REPLICA_BYTES // _PARTITION_BYTES
    if needed > spread:
        members, replicas = members.repartition(needed, "key"), replicas.repartition(needed, "key")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # never a broadcast: Spark sizes both sides as before the explode, so 32 replicas of 300,000 rows would pass for a few MB
    # both directions hold, so a < b keeps each pair from one side
    return members.hint("merge").join(replicas.hint("merge"), "key").filter(near & (F.col("a") < F.col("b"))).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b).

    Large-star and small-star rounds until the edges stay the same; only their
    number and the exact sum of their 64-bit hashes reach the driver.
    """
    pairs = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), "simhash-edges")
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = written(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .filter("u <> v").distinct(), "simhash-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        pairs = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .filter("u <> v").distinct(), "simhash-small")
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _classes(rows: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root) for fingerprints that have a link."""
    return components(links(written(rows.select("fp").distinct(), "simhash-fps"), max_bits))


def simhash_report(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    ship_package(docs.sparkSession)
    rows = written(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-rows")
    roots = written(_classes(rows, max_bits), "simhash-roots")
    by_fp = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    group = F.coalesce("root", "fp")
    labelled = by_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", group.alias("g"), "low")
    ids = labelled.groupBy("g").agg(F.min("low").alias("component_id"))
    per_fp = written(labelled.join(ids, "g").select("fp", "component_id"), "simhash-components")
    return rows.join(per_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (null last).

    Rows alone in their component pass with one anti-join; of the others
    ``row_number() = 1`` keeps one, which Spark limits per task first.
    """
    ship_package(docs.sparkSession)
    rows = written(docs.select("doc_id", text_key(F.col("text")).alias("t"),
                               fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-rows")
    roots = written(_classes(rows, max_bits), "simhash-roots").withColumnRenamed("node", "fp")
    per_fp = (rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
              .join(roots, "fp", "left").withColumn("g", F.coalesce("root", "fp")))
    groups = per_fp.groupBy("g").agg(F.sum("n").alias("size")).filter("size > 1")
    grouped_fps = written(per_fp.join(groups, "g").select("fp", "g"), "simhash-groups")
    t, g, i, rank = (fresh(docs, x) for x in ("_t", "_g", "_i", "_rank"))
    linked = written(rows.join(grouped_fps, "fp").select(
        F.col("doc_id").alias(i), F.col("t").alias(t + "2"), F.col("g").alias(g)).distinct(), "simhash-linked")
    keyed = docs.withColumn(t, text_key(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(t) == F.col(t + "2"))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    alone = keyed.join(linked, same, "left_anti").select(*cols)
    order = Window.partitionBy(g).orderBy(F.col("doc_id").asc_nulls_last(), F.col(t))
    first = (keyed.join(linked, same).withColumn(rank, F.row_number().over(order))
             .filter(F.col(rank) == 1).select(*cols))
    return alone.unionByName(first)
