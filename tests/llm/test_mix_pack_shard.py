import itertools
import os
import random
import sys
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
import edge  # noqa: E402

from tabforge.llm import mixing, packing, sharding  # noqa: E402
from tabforge.llm.common import documents  # noqa: E402

SF = "/root/testdata/sf0.01"


def _mix(docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    return rows, sizes, brute.targets(sizes)


def test_mix_targets_and_totals(spark):
    docs = documents(spark, SF)
    rows, sizes, targets = _mix(docs)
    source = {d: s for d, _, s in rows}
    taken = Counter()
    for r in mixing.mix_report(docs).collect():
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - targets[s]) < 1e-6 * targets[s]
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        taken[s] += r["taken"]
    assert all(abs(taken[s] / targets[s] - 1) < 0.03 for s in targets)


def test_mix_reruns_agree_whatever_the_partitions(spark):
    docs = documents(spark, SF)
    one = Counter(tuple(r) for r in mixing.mix_report(docs).collect())
    two = Counter(tuple(r) for r in mixing.mix_report(docs.repartition(13, "n_chars")).collect())
    assert one == two


def test_mix_edge_cases(spark):
    docs = edge.frame(spark)
    rows, sizes, targets = _mix(docs)
    report = mixing.mix_report(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in report) == Counter((d, len(brute.words(t))) for d, t, _ in rows)
    assert {r["source_size"] for r in report} == set(sizes.values())
    assert all(any(abs(r["target"] - t) < 1e-6 for t in targets.values()) for r in report)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert sum(len(brute.words(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in report)


def test_mix_waterfill_of_uneven_sources(spark):
    rows = [(f"s{i:02d}", n) for i, n in enumerate([1, 1000, 3, 50, 2, 900, 0, 10])] + [(None, 77)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    expected = brute.targets(dict(rows))
    assert got.keys() == expected.keys() and all(abs(got[s] - expected[s]) < 1e-9 for s in got)


def test_pareto_key_keeps_the_order_of_the_odds_ratio(spark):
    rng = random.Random(2)
    rows = [(rng.random() * 0.98 + 0.01, rng.random() * 0.98 + 0.01) for _ in range(300)]
    df = spark.createDataFrame(rows, "e double, u double").withColumn("k", mixing._rank_key(F.col("e"), F.col("u")))
    got = [r["k"] for r in df.collect()]
    odds = [(u / (1 - u)) / (e / (1 - e)) for e, u in rows]
    order = sorted(range(300), key=odds.__getitem__)
    assert all(got[a] <= got[b] for a, b in zip(order, order[1:]))


def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(60):
        lengths = rng.sample(range(1, 40), rng.randint(1, 8))
        hist = {x: rng.randint(1, 30) for x in lengths} | {0: 5}
        k = rng.randint(1, 4)

        def waste(bounds):
            return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in hist.items() if x)

        best = min(waste((*c, max(lengths))) for size in range(k) for c in itertools.combinations(sorted(lengths)[:-1], min(size, len(lengths) - 1)))
        got = packing.best_boundaries(hist, k)
        assert len(got) <= k and waste(got) == best
    assert packing.best_boundaries({0: 3}, 4) == [] and packing.best_boundaries({}, 4) == []


def _check_packing(rows, texts, budget):
    tokens = Counter()
    for r in rows:
        tokens[r["doc_id"], r["copy"]] += r["n_tokens"]
    assert Counter(tokens.values()) == Counter(len(brute.words(t)) for t in texts)
    places = Counter((r["batch_id"], r["slot"]) for r in rows if r["n_tokens"])
    assert max(places.values()) == 1
    batches = defaultdict(list)
    for r in rows:
        if r["n_tokens"]:
            assert r["padding"] == r["bucket"] - r["n_tokens"] >= 0
            batches[r["batch_id"]].append(r)
        else:
            assert r["bucket"] is r["batch_id"] is r["slot"] is None
    assert set(batches) == set(range(len(batches)))
    for b in batches.values():
        assert len({r["bucket"] for r in b}) == 1 and len(b) * b[0]["bucket"] <= budget
        assert sorted(r["slot"] for r in b) == list(range(len(b)))


def test_packing_keeps_every_word_within_the_budget(spark):
    docs = documents(spark, SF)
    _check_packing(packing.packed(docs).collect(), [r["text"] for r in docs.collect()], packing.BUDGET)


def test_packing_edge_cases(spark):
    rows = packing.packed(edge.frame(spark), max_len=64, n_buckets=5, budget=256).collect()
    copies = Counter((r["doc_id"], r["copy"], r["piece"], r["start"]) for r in rows if r["doc_id"] == 8)
    assert {k[1] for k in copies} >= {1, 2, 3}  # repeated rows are packed apart
    words = sum(len(brute.words(r[1])) for r in edge.rows())
    assert sum(r["n_tokens"] for r in rows) == words
    assert max(Counter((r["batch_id"], r["slot"]) for r in rows if r["n_tokens"]).values()) == 1
    assert packing.packed(edge.empty(spark)).count() == 0


def test_shards_are_even_and_slots_gapless(spark):
    docs = documents(spark, SF)
    rows = sharding.shard_report(docs, 8).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert len(rows) == len(texts)
    shards = defaultdict(list)
    for r in rows:
        t = texts[r["doc_id"]]
        assert r["size"] == len(t) + 16 and r["text_crc32"] == zlib.crc32(t)
        assert r["law"] == "bytes" and r["grown_shard"] is None
        shards[r["shard"]].append(r)
    assert set(shards) == set(range(8))
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for s in shards.values():
        assert abs(sum(r["size"] for r in s) - total / 8) <= largest + 0.002 * total
        assert sorted(r["slot"] for r in s) == list(range(len(s)))


def test_group_of_copies_larger_than_a_shard_is_cut(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.repeat(F.lit("hot "), 20))
                                   .otherwise(F.concat(F.repeat(F.lit("text "), 16), "id")).alias("text"))
    size = Counter()
    for r in sharding.shard_report(docs, 10).collect():
        size[r["shard"]] += r["size"]
    assert len(size) == 10 and max(size.values()) - min(size.values()) <= 250


def test_sharding_edge_cases(spark):
    docs = edge.frame(spark)
    rows = sharding.shard_report(docs, 4).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in edge.rows())
    assert sharding.shard_report(edge.empty(spark)).count() == 0
    clash = docs.withColumns({"shard": F.lit(888), "slot": F.lit(999)})
    whole, names = sharding.shard_rows(clash, 4)
    assert names == ("_size", "_shard", "_slot") and whole.columns == [*clash.columns, *names]
    assert {(r["size"], r["shard"], r["slot"]) for r in whole.collect()} == {(7, 888, 999)}
    assert Counter(tuple(r)[:len(docs.columns)] for r in whole.collect()) == Counter(tuple(r) for r in docs.collect())


def _even(rows, shards, largest, total):
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(size) == set(range(shards))
    assert all(abs(v - total / shards) <= largest + 0.002 * total / shards for v in size.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_equal_rows_are_split(spark):
    """A third of the rows are one row repeated: the law holds all the same."""
    one = spark.range(300).select(F.lit(7).cast("long").alias("doc_id"), F.repeat(F.lit("hot "), 20).alias("text"))
    other = spark.range(600).select((F.col("id") + 1000).alias("doc_id"), F.concat(F.repeat(F.lit("text "), 16), "id").alias("text"))
    docs = one.unionByName(other)
    total = docs.agg(F.sum(F.octet_length("text") + 16)).first()[0]
    rows = sharding.shard_report(docs, 10).collect()
    _even(rows, 10, 100, total)
    same = one.unionByName(one)
    _even(sharding.shard_report(same, 6).collect(), 6, 96, 600 * 96)


def test_shards_are_the_key_ranges_of_a_sort(spark):
    """Brute force: sort all rows by their keys, cut where the bytes below reach k shards; only rows at a cut may differ."""
    docs = documents(spark, SF)
    n = 8
    rows, _ = sharding.shard_rows(docs, n, carry=[F.col("doc_id"), F.col("text")])
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in rows.collect()}
    keys = docs.select("doc_id", F.substring(sharding.shard_key(F.col("text"), F.col("doc_id")), 1, 32).alias("key"),
                       (F.octet_length(F.coalesce("text", F.lit(""))) + 16).alias("size")).collect()
    total, below, wrong = sum(r["size"] for r in keys), 0, 0
    order = sorted(keys, key=lambda r: r["key"])
    for r in order:
        wrong += got[r["doc_id"]][0] != min(n - 1, int((below + r["size"] / 2) * n / total))
        below += r["size"]
    assert wrong <= 2 * (n - 1)
    assert [r["doc_id"] for r in order] == sorted(got, key=lambda d: got[d])   # shard, then slot, is the order of the keys


def test_after_prefix():
    assert sharding._after("00a") == "00b" and sharding._after("0ff") == "1" and sharding._after("fff") == "g"


def test_packing_numbers_many_copies_of_a_row(spark):
    n = 2 * packing._COPIES + 3
    docs = spark.range(n).selectExpr("7L as doc_id", "'a b c' as text")
    rows = packing.pieces(docs).agg(F.count("*"), F.countDistinct("copy"), F.min("copy"), F.max("copy")).first()
    assert tuple(rows) == (n, n, 1, n)
