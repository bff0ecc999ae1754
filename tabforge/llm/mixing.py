"""Mixing sources to target weights by Pareto order sampling, DataFrame functions only.

1. Sources in code-point order (null last) weigh 5, 2, 1, repeating.  They
   share all words by weight; a target stops at ``cap`` (3) times its source's
   size and the excess is shared again by weight among the others.
2. Inside a source a document of s words gets ``e = min(cap, c * g(s))``
   expected copies, where ``g`` grows as the ``power``-th root-like power of s
   (in quarter-octave classes) and c is solved so that the expected words
   equal the target.  ``floor(e)`` copies are certain.
3. The rest ``l = e - floor(e)`` is an inclusion probability.  Documents are
   ranked by Pareto's variable ``(u / (1 - u)) / (l / (1 - l))`` with u a hash
   of doc_id and text, and taken from the lowest up while they fit in the
   words wanted; one document of fitting size closes the gap.  So the sample
   has a fixed size in words.

The cut-off in step 3 is found by counting words below probes of the rank
variable, each round inside the one interval that holds it, so no task ever
orders a whole source.  What remains per source are a few numbers; whether a
row is taken is then an expression of the row.

Null texts have no words and are never taken; null sources form one source;
an empty table gives an empty result.  Rows equal in doc_id and text are
decided alike.  Reruns agree, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, globally_indexed, n_words, text_key, written

WEIGHTS = (5, 2, 1)
CAP = 3
POWER = 0.25
_CLASSES_PER_OCTAVE = 4
_BITS = 52          # of the rank variable
_STEP = 13          # bits refined per round: 8192 probes for each source
_ROUNDS = 2
PARAMETERS = ("source", "source_size", "target", "scale", "cut", "last")


def _uniform(seed: int, doc_id: Column, text: Column) -> Column:
    h = F.xxhash64(F.lit(seed), doc_id, text_key(text))
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)


def _class(size: Column) -> Column:
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) * _CLASSES_PER_OCTAVE)


def _preference(cls: Column, power: float) -> Column:
    return F.pow(F.lit(2.0), cls.cast("double") * (power / _CLASSES_PER_OCTAVE))


def source_targets(rows: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size)."""
    sizes = written(rows.groupBy("source").agg(F.sum("size").alias("source_size"))
                    .withColumn("is_null", F.col("source").isNull()), "mix-sources")
    ranked = globally_indexed(sizes, ["is_null", "source"], "rank", "mix-ranks")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    src = written(ranked.select("source", "source_size", weight.alias("weight")), "mix-weights")
    total, all_weight = src.agg(F.sum("source_size"), F.sum("weight")).first()
    share = total / all_weight if total else 0.0
    limit = F.col("source_size") * float(cap)
    n_stopped = -1
    while total:  # each round stops at least one more source
        stopped = F.lit(share) * F.col("weight") > limit
        fixed, free, n = src.agg(F.sum(F.when(stopped, limit).otherwise(0.0)),
                                 F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))),
                                 F.sum(stopped.cast("int"))).first()
        if n == n_stopped or not free:
            break
        n_stopped, share = n, (total - fixed) / free
    return src.select("source", "source_size", F.least(limit, F.lit(float(share)) * F.col("weight")).alias("target"))


def _copies_scale(rows: DataFrame, targets: DataFrame, cap: float, power: float) -> DataFrame:
    """(source, source_size, target, scale): scale c with sum(min(cap, c * g) * size) = target; null if all stop."""
    classes = (rows.filter("size > 0").groupBy("source", "cls").agg(F.sum("size").alias("w"))
               .withColumn("g", _preference(F.col("cls"), power)))
    t = targets.select(F.col("source").alias("s"), "target")
    down = Window.partitionBy("source").orderBy(F.col("cls").desc())  # a source has at most ~200 classes
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    below = down.rowsBetween(0, Window.unboundedFollowing)
    c = ((F.col("target") - float(cap) * F.coalesce(F.sum("w").over(above), F.lit(0)))
         / F.sum(F.col("g") * F.col("w")).over(below))
    solved = (classes.join(t, F.col("source").eqNullSafe(F.col("s"))).withColumn("c", c)
              .filter(F.col("c") * F.col("g") <= float(cap))
              .groupBy("source").agg(F.max_by("c", "cls").alias("scale")))
    s = solved.select(F.col("source").alias("s"), "scale")
    return targets.join(s, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def _expected(scale: Column, g: Column, target: Column, cap: float) -> Column:
    e = F.least(F.lit(float(cap)), F.coalesce(scale * g, F.lit(float(cap))))
    return F.when(target > 0, e).otherwise(0.0)


def _whole(e: Column) -> Column:
    return F.floor(e + 1e-9).cast("long")


def _rank_key(e: Column, u: Column) -> Column:
    """Pareto's variable q as the integer floor(2^52 * q / (1 + q)), which keeps its order; null if nothing is left."""
    rest = F.greatest(e - _whole(e), F.lit(0.0))
    odds = (u / (1 - u)) / (rest / (1 - rest))
    return F.when(rest > 1e-12, F.floor(odds / (1 + odds) * float((1 << _BITS) - 1)).cast("long"))


def _cut_offs(ranked: DataFrame, params: DataFrame) -> DataFrame:
    """(source, cut, last): rows with key <= cut or = last fill the words that whole copies leave open."""
    certain = ranked.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    goal = (params.join(certain.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
            .select("source", (F.col("target") - F.coalesce("certain", F.lit(0))).alias("goal")))
    state = written(goal.select("source", "goal", F.lit(0).cast("long").alias("prefix"),
                                F.lit(0).cast("long").alias("below")), "mix-goals")
    part = ranked.filter("key is not null and size > 0").select("source", "size", "key")
    for k in range(_ROUNDS):
        shift = _BITS - _STEP * (k + 1)
        st = state.select(F.col("source").alias("s"), "prefix", "goal", "below")
        inside = part.join(st, F.col("source").eqNullSafe(F.col("s"))
                           & (F.shiftright("key", shift + _STEP) == F.col("prefix")))
        bins = inside.groupBy("source", "goal", "below", F.shiftright("key", shift).alias("bin")).agg(
            F.sum("size").alias("w"))
        state = _crossing(bins, "bin", f"mix-round{k}")
    st = state.select(F.col("source").alias("s"), "prefix", "goal", "below")
    last = part.join(st, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("key", shift) == F.col("prefix")))
    keys = last.groupBy("source", "goal", "below", "key").agg(F.sum("size").alias("w"))
    end = _crossing(keys, "key", "mix-cut", extra=["w"])
    cut = end.select(F.col("source").alias("s"), (F.col("prefix") - 1).alias("cut"), (F.col("goal") - F.col("below")).alias("gap"))
    # the words still open are closed by the one document beyond the cut-off whose size is nearest to them
    beyond = part.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("key") > F.col("cut")) & (F.col("size") < 2 * F.col("gap")))
    last = beyond.groupBy("source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")), "key")).alias("m")).select(
        "source", F.col("m.key").alias("last"))
    return cut.join(last, F.col("source").eqNullSafe(F.col("s")), "left").select(F.col("s").alias("source"), "cut", "last")


def _crossing(bins: DataFrame, key: str, name: str, extra: list[str] = ()) -> DataFrame:
    """Per source the bin in which the running words pass the goal (else its last), with the words below it."""
    up = Window.partitionBy("source").orderBy(key)
    w = bins.withColumn("start", F.col("below") + F.sum("w").over(up) - F.col("w"))
    hit = w.filter((F.col("start") <= F.col("goal")) | (F.col("start") == F.col("below")))
    best = hit.groupBy("source").agg(F.max_by(F.struct(key, "goal", F.col("start").alias("below"), *extra), key).alias("b"))
    return written(best.select("source", F.col(f"b.{key}").alias("prefix"), "b.goal", "b.below",
                               *[f"b.{c}" for c in extra]), name)


def mix_parameters(docs: DataFrame, weights=WEIGHTS, cap: float = CAP, power: float = POWER, seed: int = 4) -> DataFrame:
    """One row per source: source, source_size, target, scale, cut, last."""
    size = n_words(F.col("text"))
    rows = written(docs.select("source", size.alias("size"), _uniform(seed, F.col("doc_id"), F.col("text")).alias("u"))
                   .withColumn("cls", _class(F.col("size")).cast("int")), "mix-rows")
    params = written(_copies_scale(rows, source_targets(rows, weights, cap), cap, power), "mix-scale")
    p = params.select(F.col("source").alias("s"), "scale", "target")
    e = _expected(F.col("scale"), _preference(F.col("cls"), power), F.col("target"), cap)
    ranked = (rows.join(p, F.col("source").eqNullSafe(F.col("s"))).withColumn("e", e)
              .select("source", "size", _whole(F.col("e")).alias("whole"), _rank_key(F.col("e"), F.col("u")).alias("key")))
    cuts = _cut_offs(ranked, params).withColumnRenamed("source", "s")
    return written(params.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix-parameters")


def with_copies(docs: DataFrame, params: DataFrame, cap: float = CAP, power: float = POWER, seed: int = 4) -> DataFrame:
    """``docs`` with _mix_size, _mix_copies, _mix_source_size, _mix_target; names get underscores on a clash.

    ``params`` has one short row per source; Spark broadcasts it when measured small.
    """
    names = {c: fresh(docs, f"_mix_{c}") for c in PARAMETERS + ("size", "e", "copies")}
    n = {k: F.col(v) for k, v in names.items()}
    p = params.select(*[F.col(c).alias(names[c]) for c in PARAMETERS])
    out = docs.join(p, F.col("source").eqNullSafe(n["source"])).withColumn(names["size"], n_words(F.col("text")))
    out = out.withColumn(names["e"], _expected(n["scale"], _preference(_class(n["size"]).cast("int"), power), n["target"], cap))
    key = _rank_key(n["e"], _uniform(seed, F.col("doc_id"), F.col("text")))
    drawn = (F.coalesce(key <= n["cut"], F.lit(False)) | F.coalesce(key == n["last"], F.lit(False))).cast("long")
    copies = F.when(n["size"] > 0, _whole(n["e"]) + drawn).otherwise(F.lit(0).cast("long"))
    return out.withColumn(names["copies"], copies)


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words that the mix takes of each document."""
    rows = with_copies(docs.select("doc_id", "text", "source"), mix_parameters(docs))
    return rows.select("doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
                       F.col("_mix_target").alias("target"),
                       (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with the columns of ``docs``."""
    rows = with_copies(docs, mix_parameters(docs))
    copies = next(c for c in rows.columns[::-1] if c.endswith("_mix_copies"))
    one = fresh(rows, "_copy")
    repeated = rows.withColumn(one, F.explode(F.array_repeat(F.lit(1), F.col(copies).cast("int"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
