import hashlib
import os
import random
import sys
from collections import Counter

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
import edge  # noqa: E402

from tabforge.llm import exact_dedup, line_dedup, simhash  # noqa: E402
from tabforge.llm.common import documents  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_exact_report_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in edge.rows()]
    expected = Counter((rows[i][0], *v) for i, v in brute.exact_dedup(rows).items())
    got = Counter(tuple(r) for r in exact_dedup.dedup_report(edge.frame(spark)).collect())
    assert got == expected


def test_exact_dedup_keeps_one_row_of_each_group_with_all_columns(spark):
    rows = [(r[0], r[1]) for r in edge.rows()]
    expected = Counter(rows[i] for i, v in brute.exact_dedup(rows).items() if v[2])
    out = exact_dedup.exact_dedup(edge.frame(spark))
    assert out.columns == edge.frame(spark).columns
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert sum(got.values()) == sum(expected.values())
    assert {t or "" for _, t in got} == {t or "" for _, t in expected}


def test_saturated_filter_changes_nothing(spark):
    docs = documents(spark, SF)
    rows = docs.select("doc_id", F.xxhash64(exact_dedup.normalised(F.col("text"))).alias("h"))
    bits = 1 << 16
    maps = exact_dedup.repeat_bitmaps(rows, "h", bits)
    flagged = exact_dedup.with_repeat_flag(rows, F.col("h"), maps, bits, "maybe")
    repeated = rows.groupBy("h").count().filter("count > 1").select("h")
    assert flagged.join(repeated, "h").filter("not maybe").count() == 0  # no false negative
    assert flagged.filter("not maybe").count() > 100                     # most rows pass


def test_hot_group_of_copies(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot copy")
                                   .otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    out = exact_dedup.exact_dedup(docs)
    assert out.count() == 401 and out.filter("text = 'hot copy'").first()["doc_id"] == 0


def test_empty_tables(spark):
    e = edge.empty(spark)
    for out in (exact_dedup.dedup_report(e), exact_dedup.exact_dedup(e), simhash.simhash_report(e), simhash.one_of_each(e),
                line_dedup.line_report(e)):
        assert out.count() == 0


def test_fingerprints_equal_brute_force():
    for r in edge.rows():
        if len(r[1] or "") < 20_000:
            assert simhash.fingerprint(r[1]) == brute.fingerprint(r[1])


def test_long_text_fingerprint_counts_in_blocks():
    rng = random.Random(1)
    text = " ".join(rng.choice("abc") * rng.randint(1, 3) for _ in range(2000))
    whole, simhash._BLOCK = simhash._BLOCK, 7
    try:
        small = simhash.fingerprint(text)
    finally:
        simhash._BLOCK = whole
    assert small == simhash.fingerprint(text) == brute.fingerprint(text)


def test_anchor_of_either_sees_both(spark):
    rng = random.Random(9)
    pairs = [(x := rng.getrandbits(31), x ^ (1 << rng.randrange(31) if k % 3 else 0)) for k in range(400)]
    df = spark.createDataFrame(pairs, "x long, y long")
    member, _ = simhash.anchors(F.col("x"))
    own, near = simhash.anchors(F.col("y"))
    out = df.select(F.array_contains(near, member).alias("met"), F.bit_count(F.col("y").bitwiseXOR(own)).alias("d"),
                    F.size(near).alias("n")).collect()
    assert all(r["met"] for r in out)
    assert max(r["d"] for r in out) <= 1 and max(r["n"] for r in out) == 16


def test_links_equal_all_pairs(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:50]:
        g = f
        for _ in range(rng.randint(1, 4)):
            g ^= 1 << rng.randrange(64)
        fps.add(g)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in signed.values()], "fp long")).collect()}
    expected = {tuple(sorted((signed[a], signed[b]))) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2}
    assert got == expected and len(expected) > 10


def test_simhash_components_equal_brute_force(spark):
    for docs in (edge.frame(spark).filter("doc_id <> 15 or doc_id is null"), documents(spark, SF)):
        rows = [(r["doc_id"], brute.fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
        root = brute.simhash_components({f for _, f in rows})
        low = {}
        for d, f in rows:
            if d is not None:
                low[root[f]] = min(low.get(root[f], d), d)
        expected = Counter((d, f"{f:016x}", low.get(root[f])) for d, f in rows)
        assert Counter(tuple(r) for r in simhash.simhash_report(docs).collect()) == expected
        kept = simhash.one_of_each(docs)
        assert kept.columns == docs.columns
        assert sorted(root[brute.fingerprint(r["text"])] for r in kept.collect()) == sorted(set(root.values()))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 99)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 99: 99, 100: 99, 101: 99}


def test_line_dedup_equals_brute_force(spark):
    docs = documents(spark, SF)
    expected = brute.line_dedup([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == expected


def test_line_dedup_edge_cases(spark):
    docs = edge.frame(spark)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == len(edge.rows())
    assert sum(r["text"] is None for r in rows) == sum(r[1] is None for r in edge.rows())
    passage = edge.rows()[14][1].split("\n")
    held = [sum(line in (r["text"] or "") for line in passage) for r in rows if r["doc_id"] in (12, 13, 14)]
    assert max(held) == len(passage) and min(held) < len(passage) // 2  # one copy stays, shifted ones lose theirs


def test_line_report_hash_is_of_the_text_left(spark):
    docs = documents(spark, SF)
    texts = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    for r in line_dedup.line_report(docs).collect():
        assert r["text_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
