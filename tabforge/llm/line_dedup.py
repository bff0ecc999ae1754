"""Line dedup by content-defined chunks of lines, DataFrame functions only.

A text is split at ``\\n``.  Every line gets a 32-bit hash; a rolling hash runs
over windows of two lines.  A chunk starts at a line whose rolling hash is a
local minimum (below the one before, not above the next).  The choice depends
on four neighbouring lines only, so the same passage is cut alike wherever it
stands, and inner chunks have two lines or more.

Chunks of two lines or more with at least one word that occur again anywhere
in the corpus are removed, except where they come first (by doc_id, null last,
then a hash of the text, then position).  Hashes only choose candidates, by
the two-pass Bloom filter of ``exact_dedup``; chunks are equal when their bytes
are, which grouping by the chunk text itself decides.

Rows that agree in doc_id and text count as one document and are treated
alike.  Null texts stay null and have no lines.  Single-line chunks are never
removed.  An empty table gives an empty result; other columns stay as they are,
and the two added ones get underscores in front where the table has such names.

``dedup_lines`` stops there: a repeated passage goes only where two cuts fall
inside it.  ``dedup_passages`` extends the matches line by line past their
chunks.  Repeated chunks go first, all copies but one; then every window of two
adjacent lines with a word, inside the first copy of a chunk or across a cut, is
a candidate (same filter, same check by bytes), and each line of a window that
is not the first of its kind goes.  So every repeated passage of two lines or
more goes over its whole length, while copies of a chunk are never windowed.
Nothing is lost by leaving their windows out: the first copy of the chunk holds
each of them, at an earlier place.  The first place of any
line is never removed: an earlier copy of its window would hold an earlier copy
of the line.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, fresh, text_key, whole_text, written
from .exact_dedup import filter_bits, repeat_bitmaps, with_repeat_flag

_BASE = 1_000_003
_MODULUS = 2_147_483_647


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once for the row."""
    return F.transform(F.array(value), body)[0]


def chunks(text: Column) -> Column:
    """Array of struct(text, start, n_lines, last, next): the chunks of a text in order; joined by newlines they give it back.

    ``start`` is the number of the first line, from 0; ``last`` the last line, ``next`` the one after it (null at the end).
    """
    def line_hash(line: Column) -> Column:
        return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")

    def rolling(hashes: Column) -> Column:
        return F.transform(hashes, lambda h, i: (F.when(i > 0, F.get(hashes, i - 1)).otherwise(F.lit(0)) * _BASE + h) % _MODULUS)

    def starts(r: Column) -> Column:
        cut = F.filter(F.sequence(F.lit(0), F.size(r) - 1), lambda i: (i == 0) | (
            (F.get(r, i) < F.get(r, i - 1)) & (F.get(r, i) <= F.coalesce(F.get(r, i + 1), F.get(r, i)))))
        return F.concat(cut, F.array(F.size(r)))

    def cut(lines: Column) -> Column:
        return _let(_let(_let(F.transform(lines, line_hash), rolling), starts), lambda s: F.transform(
            F.slice(s, F.lit(1), F.size(s) - 1), lambda a, k: F.struct(
                F.array_join(F.slice(lines, a + 1, F.get(s, k + 1) - a), "\n").alias("text"),
                a.alias("start"), (F.get(s, k + 1) - a).alias("n_lines"),
                F.get(lines, F.get(s, k + 1) - 1).alias("last"), F.get(lines, F.get(s, k + 1)).alias("next"))))

    return _let(F.split(text, "\n", -1), cut)


def _all_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, t, pos, c) for every chunk ``c`` of every text."""
    return docs.filter("text is not null").select("doc_id", text_key(F.col("text")).alias("t"),
                                                  F.posexplode(chunks(F.col("text"))).alias("pos", "c"))


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, t, pos, start, n_lines, chunk) for chunks that may be removed."""
    return _all_chunks(docs).filter(_removable()).select(
        "doc_id", "t", "pos", "c.start", "c.n_lines", F.col("c.text").alias("chunk"))


def _removable() -> Column:
    return (F.col("c.n_lines") >= 2) & F.col("c.text").rlike(f"[^{SPACE}]")


def _place(start: Column) -> Column:
    return F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("t").alias("t"),
                    F.col("pos").alias("pos"), start.alias("start"))


def _group_key(piece: str) -> Column:
    return F.unhex(F.md5(piece))


@dataclass(frozen=True)
class _Repeats:
    """The pieces that two Bloom passes leave possibly repeated, grouped by their bytes."""

    later: DataFrame    # (doc_id, t, pos, more) of the pieces whose bytes stand at an earlier place too
    firsts: DataFrame   # (piece, first) of every different piece: its bytes and its first place
    maps: list          # the filter, and its number of slots
    bits: int


def _repeats(numbered: Callable[[], DataFrame], piece: str) -> _Repeats:
    """Of ``numbered()`` (doc_id, t, pos, start, ``piece``, more).

    Pieces are grouped by a 128-bit hash together with the set of their texts:
    where that is one text, all have the same bytes, and the places meet their
    group by the hash alone.  Hashes shared by different pieces, if any, are
    grouped by the pieces themselves.
    """
    hashes = written(numbered().select(F.xxhash64(piece).alias("h")), "line-hashes")
    bits = filter_bits(hashes.count())
    maps = repeat_bitmaps(hashes, "h", bits)
    maybe = written(with_repeat_flag(numbered(), F.xxhash64(piece), maps, bits, "maybe")
                    .filter("maybe").drop("maybe").withColumn("k", _group_key(piece)), "line-candidates")
    place = _place(F.col("start"))
    groups = written(maybe.groupBy("k").agg(F.min(place).alias("first"), F.max(place).alias("last"),
                                            F.collect_set(piece).alias("texts")), "line-groups")
    alike = F.size("texts") == 1
    rest = [c for c in maybe.columns if c not in (piece, "k")]
    later = ~place.eqNullSafe(F.col("first"))
    again = groups.filter(alike & (F.col("first") != F.col("last"))).select("k", "first")
    out = maybe.drop(piece).join(again, "k").filter(later).select(*rest)
    firsts = groups.filter(alike).select(F.col("texts")[0].alias("piece"), "first")
    unlike = groups.filter(~alike).select("k")
    if not unlike.isEmpty():
        mixed = written(maybe.join(unlike, "k", "left_semi"), "line-unlike")
        own = written(mixed.groupBy(F.col(piece).alias("piece")).agg(F.min(place).alias("first")), "line-unlike-firsts")
        out = out.unionByName(mixed.join(own, F.col(piece) == F.col("piece")).filter(later).select(*rest))
        firsts = firsts.unionByName(own)
    return _Repeats(out, firsts, maps, bits)


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, t, pos, start, n_lines) of the chunk occurrences to remove."""
    return _repeats(lambda: _numbered(docs), "chunk").later


def _inner(text: Column, start: Column) -> Column:
    """Array of struct(pos, pair): the windows of two adjacent lines inside a chunk."""
    return _let(F.split(text, "\n", -1), lambda lines: F.transform(
        F.slice(lines, F.lit(1), F.size(lines) - 1),
        lambda line, i: F.struct((start + i).alias("pos"), F.concat(line, F.lit("\n"), F.get(lines, i + 1)).alias("pair"))))


def _windows(docs: DataFrame, found: _Repeats) -> DataFrame:
    """(doc_id, t, pos, start, pair) for the windows with a word in first copies of chunks and across cuts.

    ``pos`` is the number of a window's first line, from 0.  Chunks that the
    filter shows as alone are windowed where they are read, the others once for
    all copies, at the place of the first.
    """
    rows = with_repeat_flag(_all_chunks(docs), F.xxhash64("c.text"), found.maps, found.bits, "maybe")
    none = F.array().cast("array<struct<pos:int,pair:string>>")
    across = F.when(F.col("c.next").isNotNull(), F.array(F.struct(
        (F.col("c.start") + F.col("c.n_lines") - 1).alias("pos"), F.concat("c.last", F.lit("\n"), "c.next").alias("pair")))).otherwise(none)
    inner = F.when((F.col("c.n_lines") < 2) | (F.col("maybe") & _removable()), none).otherwise(_inner(F.col("c.text"), F.col("c.start")))
    read = rows.select("doc_id", "t", F.inline(F.concat(inner, across)))
    once = found.firsts.select(F.col("first.d").alias("doc_id"), F.col("first.t").alias("t"),
                               F.inline(_inner(F.col("piece"), F.col("first.start"))))
    return read.unionByName(once).filter(F.col("pair").rlike(f"[^{SPACE}]")).withColumn("start", F.col("pos"))


def _lines(text: Column) -> Column:
    """Array of struct(text): the lines of a text in order."""
    return F.transform(F.split(text, "\n", -1), lambda line: F.struct(line.alias("text")))


def dedup_lines(docs: DataFrame, n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """``docs`` with the repeated chunks taken out of ``text``, and the numbers of lines before and removed."""
    gone = repeated_chunks(docs).distinct().groupBy("doc_id", "t").agg(
        F.collect_list("pos").alias("gone"), F.sum("n_lines").cast("long").alias("lines_gone"))
    return _taken_out(docs, gone, chunks, n_lines, n_removed)


def dedup_passages(docs: DataFrame, n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """Like ``dedup_lines``, for every repeated passage of two lines or more with a word: chunk matches and their extensions."""
    found = _repeats(lambda: _numbered(docs), "chunk")
    more = _repeats(lambda: _windows(docs, found), "pair").later
    lines = (found.later.select("doc_id", "t", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n_lines") - 1)).alias("line"))
             .unionByName(more.select("doc_id", "t", F.explode(F.array(F.col("pos"), F.col("pos") + 1)).alias("line"))))
    gone = lines.groupBy("doc_id", "t").agg(F.collect_set("line").alias("gone"))
    return _taken_out(docs, gone.withColumn("lines_gone", F.size("gone").cast("long")), _lines, n_lines, n_removed)


def _met(docs: DataFrame, removals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``docs`` without a row in ``removals``, the others with its columns but the key (doc_id, t)).

    A Bloom filter of the documents in ``removals``, of a bounded size, lets
    all others pass straight through; only the rest meets the list.
    """
    d, t, flag = (fresh(docs, x) for x in ("_d", "_t", "_touched"))
    removed = written(removals.withColumnsRenamed({"doc_id": d, "t": t}).withColumn("h", F.xxhash64(d, t)), "line-removed")
    bits = filter_bits(removed.count())
    key = text_key(F.col("text"))
    flagged = with_repeat_flag(docs, F.xxhash64(F.col("doc_id"), key), repeat_bitmaps(removed, "h", bits, least=1), bits, flag)
    touched = flagged.filter(F.col(flag)).join(removed.drop("h"), F.col("doc_id").eqNullSafe(F.col(d)) & (key == F.col(t)), "left")
    return flagged.filter(~F.col(flag)).drop(flag), touched.drop(flag, d, t)


def _taken_out(docs: DataFrame, removals: DataFrame, pieces: Callable[[Column], Column], n_lines: str, n_removed: str) -> DataFrame:
    """``docs`` without the ``pieces`` of ``text`` at the positions in ``removals`` (doc_id, t, gone, lines_gone)."""
    n_lines, n_removed = fresh(docs, n_lines), fresh(docs, n_removed)
    gone, lines_gone = fresh(docs, "_gone"), fresh(docs, "_lines_gone")
    untouched, touched = _met(docs, removals.withColumnsRenamed({"gone": gone, "lines_gone": lines_gone}))
    text = F.col("text")
    lines = F.when(text.isNull(), F.lit(0)).otherwise(F.size(F.split(text, "\n", -1))).cast("long").alias(n_lines)
    whole = untouched.select(*[F.col(f"`{c}`") for c in docs.columns], lines, F.lit(0).cast("long").alias(n_removed))
    kept = _let(pieces(text), lambda c: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(c) - 1), F.col(gone)), lambda i: F.get(c, i)["text"]), "\n"))
    cut = touched.select(
        *[F.when(F.col(gone).isNull(), text).otherwise(kept).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        lines, F.coalesce(lines_gone, F.lit(0).cast("long")).alias(n_removed))
    return whole.unionByName(cut)


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the SHA-256 of the text that is left."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(whole_text(F.col("text")), 256).alias("text_sha256"))


def passage_report(docs: DataFrame) -> DataFrame:
    """The columns of ``line_report`` for ``dedup_passages``."""
    out = dedup_passages(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(whole_text(F.col("text")), 256).alias("text_sha256"))
