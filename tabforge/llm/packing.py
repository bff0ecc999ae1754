"""Packing into optimal length buckets and token-budget batches.

A token is a word ``[^\\x20\\x09-\\x0D]+``; a document longer than ``max_len``
is cut into pieces of ``max_len`` words and a rest, so no word is lost.  The
histogram of all piece lengths has at most ``max_len`` entries; dynamic
programming over it picks the bucket lengths (at most ``n_buckets``) with the
least padding in total.  In a bucket of length b, ``budget // b`` pieces make a
batch, in a hashed order, so a batch with its padding never exceeds the budget.

The place in a bucket comes from one global range sort on (bucket, hash), cut
into even ranges whatever the bucket sizes, so a bucket with a third of all
pieces is no hot task.  Documents without words (empty, null) are returned
once, with piece 0, no tokens and null bucket, batch and slot.  Repeated rows
(the copies of a mix) are numbered by ``copy`` and packed apart, each at its
own hash.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import globally_indexed, n_words, text_key, written

MAX_LEN = 2048
N_BUCKETS = 16
BUDGET = 16384
_COPIES = 4096    # copies of a row numbered at once


def best_boundaries(histogram: dict[int, int], n_buckets: int) -> list[int]:
    """Bucket lengths, ascending, that minimise sum over pieces of (bucket length - length)."""
    lengths = np.array(sorted(x for x, n in histogram.items() if x > 0 and n > 0), dtype=np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(x)] for x in lengths], dtype=np.float64)
    below = np.concatenate([[0.0], np.cumsum(counts)])
    n = len(lengths)
    # padded tokens of the first j lengths in k buckets; real tokens are the same for every choice
    cost = np.concatenate([[0.0], np.full(n, np.inf)])
    back = []
    for _ in range(min(n_buckets, n)):
        step = cost[None, :n] + lengths[:, None] * (below[1:, None] - below[None, :n])
        step[np.triu_indices(n, 1)] = np.inf  # a bucket ends at or after its start
        start = step.argmin(axis=1)
        back.append(start)
        cost = np.concatenate([[np.inf], step[np.arange(n), start]])
    cuts, j = [], n
    for start in reversed(back):
        if j == 0:
            break
        cuts.append(int(lengths[j - 1]))
        j = int(start[j - 1])
    return cuts[::-1]


def pieces(docs: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """doc_id, copy, piece, start, n_tokens, order: a row per piece, one for a document without words."""
    base = (docs.select("doc_id", n_words(F.col("text")).alias("words"), text_key(F.col("text")).alias("hash"))
            .groupBy("doc_id", "words", "hash").agg(F.count(F.lit(1)).alias("n"))
            # numbered block by block, so a row that repeats very often never becomes one long array
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {_COPIES}"))))
            .withColumn("copy", F.explode(F.sequence(F.col("block") * _COPIES + 1,
                                                     F.least(F.col("n"), (F.col("block") + 1) * _COPIES)))))
    last = F.greatest(F.expr(f"(words - 1) div {max_len}"), F.lit(0))
    cut = base.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.col("piece") * max_len
    return cut.select("doc_id", "copy", "piece", start.alias("start"),
                      F.least(F.col("words") - start, F.lit(max_len)).alias("n_tokens"),
                      F.xxhash64(F.lit(8), "hash", "doc_id", "copy", "piece").alias("order"))


def packed(docs: DataFrame, max_len: int = MAX_LEN, n_buckets: int = N_BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, copy, piece, start, n_tokens, bucket, batch_id, slot, padding."""
    if budget < max_len:
        raise ValueError("the token budget must hold the longest piece")
    cut = written(pieces(docs, max_len), "pack-pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("n_tokens").count().collect()}  # at most max_len + 1 rows
    bounds = best_boundaries(histogram, n_buckets)
    size = {b: 0 for b in bounds}
    for x, n in histogram.items():
        if x > 0:
            size[min(b for b in bounds if b >= x)] += n
    first_row, first_batch, rows, batches = {}, {}, histogram.get(0, 0), 0
    for b in bounds:
        first_row[b], first_batch[b] = rows, batches
        rows += size[b]
        batches += -(-size[b] // (budget // b))
    fit = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<int>")
    bucket = F.when(F.col("n_tokens") > 0, F.array_min(F.filter(fit, lambda b: b >= F.col("n_tokens"))))
    placed = globally_indexed(cut.withColumn("bucket", bucket), ["bucket", "order", "doc_id", "copy", "piece"], "rank", "pack-sorted")

    def lookup(values: dict[int, int]):
        table = F.create_map(*[F.lit(x).cast("long") for b in bounds for x in (b, values[b])]) if bounds else None
        return F.lit(None).cast("long") if table is None else F.element_at(table, F.col("bucket").cast("long"))

    place = F.col("rank") - lookup(first_row)
    per_batch = F.expr(f"{budget} div bucket")
    return placed.withColumn("place", place).select(
        "doc_id", "copy", "piece", "start", "n_tokens", "bucket",
        (lookup(first_batch) + F.floor(F.col("place") / per_batch)).alias("batch_id"),
        (F.col("place") % per_batch).alias("slot"),
        (F.col("bucket") - F.col("n_tokens")).alias("padding"))
