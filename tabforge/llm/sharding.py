"""Histogram sort into shards of nearly equal bytes; the rows are exchanged once.

Every row has a 192-bit key: the hash of its text, the hash of its doc_id, and
a hash that tells rows equal in both apart.  Shards are ranges of that key, so
copies of a text lie together and a group larger than a shard is still cut,
even one of equal rows.  The keyed rows are written first, so that a key never
changes when a task runs again.

Splitters are found by counting: a round counts the exact bytes and rows below
equally spaced probes of the key space (one partial aggregation), and the next
round probes only inside the intervals that hold a splitter not yet within
tolerance.  Each shard is cut into as many ranges of about equal bytes, by
splitters found in the same rounds, as it takes to use every shuffle partition.
Then the rows are exchanged once, each to the partition of its range, and
sorted there; the slot in a shard is the number of rows of the shard's earlier
ranges plus the position in its own.

Law ``bytes``: the sizes of the shards are near equal (within one row and the
tolerance).  Null texts count as empty; a null doc_id is a key value of its
own; very long texts are hashed whole.  Which of several equal rows takes which
slot may differ from run to run.  All columns of the table stay; where it has a
``size``, ``shard`` or ``slot``, the new columns get underscores in front.  An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, whole_text, written

_DIGITS = 3        # hexadecimal digits refined per round: 4096 probes for each open interval
_KEY_DIGITS = 48
OVERHEAD = 16      # bytes added to each text


def _hex64(h: Column) -> Column:
    return F.lpad(F.lower(F.hex(h)), 16, "0")


def shard_key(text: Column, doc_id: Column) -> Column:
    body = whole_text(text)
    return F.concat(_hex64(F.xxhash64(body)), _hex64(F.xxhash64(F.lit(10), doc_id.isNull(), doc_id)),
                    _hex64(F.xxhash64(F.monotonically_increasing_id())))


def find_splitters(rows: DataFrame, shards: int, tolerance: float = 0.001, ranges: int = 1) -> list[tuple[str, int]]:
    """``shards * ranges - 1`` splitters (key prefix, rows below it) over (key, size).

    A splitter is the first key of its range; every ``ranges``-th one begins a
    shard.  Rounds go on until the bytes below it differ from the ideal by at
    most ``tolerance`` of a shard (inside a shard: a tenth of a range), or its
    interval is one key.  The driver sees at most 4096 counts a round for each
    splitter that is still open.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    pieces = shards * ranges
    goals = [total * k / pieces for k in range(1, pieces)]
    within = [(tolerance if k % ranges == 0 else 0.1 / ranges) * total / shards for k in range(1, pieces)]
    # open interval of each splitter: key prefix, exact bytes and rows below it
    state = [("", 0, 0)] * len(goals)
    done: list[tuple[str, int] | None] = [None] * len(goals)
    for length in range(0, _KEY_DIGITS, _DIGITS):
        open_ = sorted({state[i][0] for i in range(len(goals)) if done[i] is None})
        if not open_:
            break
        width = min(length + _DIGITS, _KEY_DIGITS)
        inside = rows if length == 0 else rows.filter(F.substring("key", 1, length).isin(open_))
        counted = (inside.groupBy(F.substring("key", 1, width).alias("p"))
                   .agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect())
        bins: dict[str, list] = {}
        for r in sorted(counted, key=lambda r: r["p"]):
            bins.setdefault(r["p"][:length], []).append((r["p"], r["b"], r["n"]))
        for i, goal in enumerate(goals):
            if done[i] is not None:
                continue
            (prefix, below, n_below), allowed = state[i], within[i]
            for p, b, n in bins[prefix]:
                if below + b >= goal:
                    break
                below, n_below = below + b, n_below + n
            # the goal lies in bin p: its lower edge, its upper edge, or a finer probe inside
            if goal - below <= allowed:
                done[i] = (p, n_below)
            elif below + b - goal <= allowed or width == _KEY_DIGITS:
                low = width == _KEY_DIGITS and goal - below <= below + b - goal
                done[i] = (p, n_below) if low else (_after(p), n_below + n)
            else:
                state[i] = (p, below, n_below)
    return done


def _after(prefix: str) -> str:
    """The smallest key above all keys that begin with ``prefix``."""
    rest = prefix.rstrip("f")
    return "g" if not rest else rest[:-1] + "%x" % (int(rest[-1], 16) + 1)


def range_of(key: Column, splitters: list[tuple[str, int]], ranges: int) -> Column:
    """Number of splitters at or below the key: first the shard's, then those inside the shard."""
    firsts = [p for p, _ in splitters]
    heads = firsts[ranges - 1::ranges]
    shard = F.size(F.filter(F.array(*[F.lit(p) for p in heads]), lambda s: s <= key)) if heads else F.lit(0)
    if ranges == 1:
        return shard
    inner = [firsts[k * ranges:(k + 1) * ranges - 1] for k in range(len(heads) + 1)]
    table = F.array(*[F.array(*[F.lit(p) for p in part]) for part in inner])
    return shard * ranges + F.size(F.filter(F.element_at(table, shard + 1), lambda s: s <= key))


def shard_rows(docs: DataFrame, shards: int, tolerance: float = 0.001, carry: list[Column] | None = None) -> tuple[DataFrame, tuple[str, str, str]]:
    """``carry`` and the size, shard and slot of every row of ``docs``; and the names of these three columns.

    ``carry`` defaults to every column of ``docs``; pass a few to move less.
    """
    spark = docs.sparkSession
    text, doc_id = F.col("text"), F.col("doc_id")
    kept = [F.col(f"`{c}`") for c in docs.columns] if carry is None else carry
    taken = docs.select(*kept)
    size, shard, slot, key, piece, mid = (fresh(taken, x) for x in ("size", "shard", "slot", "_key", "_piece", "_mid"))
    keyed = docs.select(*kept, shard_key(text, doc_id).alias(key), (F.octet_length(whole_text(text)).cast("long") + F.lit(OVERHEAD)).alias(size))
    keyed = written(keyed, "shard-keyed")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, -(-partitions // shards))
    splitters = find_splitters(keyed.select(F.col(key).alias("key"), F.col(size).alias("size")), shards, tolerance, ranges)
    if not splitters and shards * ranges > 1:   # an empty table
        return keyed.select(*taken.columns, size, F.lit(0).alias(shard), F.lit(0).cast("long").alias(slot)), (size, shard, slot)
    pieces = len(splitters) + 1
    sent = keyed.withColumn(piece, range_of(F.col(key), splitters, ranges).cast("int")).repartitionById(pieces, piece)
    placed = written(sent.sortWithinPartitions(piece, key).drop(key).withColumn(mid, F.monotonically_increasing_id()), "shard-sorted")
    first = {r[0]: r[1] for r in placed.groupBy(piece).agg(F.min(mid)).collect()}   # one row per range
    below = [0, *[n for _, n in splitters]]
    rows = [(p, p // ranges, below[p] - below[p // ranges * ranges] - m) for p, m in sorted(first.items())]
    schema = T.StructType([T.StructField("_of", T.IntegerType()), T.StructField("_in", T.IntegerType()), T.StructField("_from", T.LongType())])
    side = F.broadcast(spark.createDataFrame(rows, schema))   # one row per range
    out = placed.join(side, F.col(piece) == F.col("_of")).withColumn(shard, F.col("_in")).withColumn(slot, F.col(mid) + F.col("_from"))
    return out.select(*taken.columns, size, shard, slot), (size, shard, slot)


def shard_report(docs: DataFrame, shards: int = 40) -> DataFrame:
    crc = F.crc32(F.encode(whole_text(F.col("text")), "UTF-8")).alias("text_crc32")
    rows, (size, shard, slot) = shard_rows(docs, shards, carry=[F.col("doc_id"), crc])
    return rows.select("doc_id", size, "text_crc32", F.lit("bytes").alias("law"), shard, slot,
                       F.lit(None).cast("int").alias("grown_shard"))
