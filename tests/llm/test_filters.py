import hashlib
import os
import sys
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
import edge  # noqa: E402

from tabforge.llm import quality_rules, secret_scan, toxicity, url_filter  # noqa: E402
from tabforge.llm.common import documents, table  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_url_parts_and_rules(spark):
    urls = [None, "", "no scheme/x", "http://Ex.ORG", "HTTP://A.example.org/es/x?y#z", "https://example.org/en/17",
            "http://b.com/fr/", "http://com/de/a", "x://y://z/p", "http://?q", "http://ÀB.net/Ü?x", "http://notorg/", "://h#f",
            "http://EXAMPLE.org/en/2", "http://xexample.org/es/1", "http://h\nx/p\nq?r"]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, grams string")
    model = url_filter.fit(url_filter.labelled_urls(spark))
    for r in url_filter.judged(pages, model).collect():
        host, path = brute.url_parts(urls[r["page_id"]])
        rule, verdict = brute.url_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["p_block"] >= 0.5 else "allow"))
    assert url_filter.judged(pages.limit(0), model).count() == 0


def test_url_model_separates_unseen_sites(spark):
    model = url_filter.fit(url_filter.labelled_urls(spark))
    bad = ["http://www.mega-casino.net/en/3", "http://cheap-pills24.net/en/9", "http://m.adult-xx.net/de/1", "http://ads-tracker.net/en/7"]
    good = ["http://garden-news.net/en/3", "http://thereat.net/en/9", "http://m.oning.net/de/1", "http://stationer.net/en/7"]
    pages = spark.createDataFrame(list(enumerate(bad + good)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judged(pages, model).collect()}
    assert [got[i] for i in range(8)] == ["block"] * 4 + ["allow"] * 4


def _clauses(text):
    return toxicity.clause_scores(text, toxicity.seed_lexicon(), toxicity.grammar(), {})


def test_grammar_scores_clauses():
    plain = _clauses("an idiot")[0]
    assert _clauses("you idiot")[0] > plain                       # target
    assert _clauses("not an idiot")[0] < plain                    # negation
    assert _clauses("never. an idiot")[0] == plain                # negation ends with its clause
    assert _clauses("he said an idiot")[0] < _clauses("he saw an idiot")[0]
    assert _clauses("an “idiot”")[0] < plain                      # quoted
    assert _clauses("i will kill you")[0] > _clauses("to kill time")[0] > 0
    assert _clauses("a fine day")[0] == 0 and _clauses(None) == (0, 0, 0) and _clauses("")[2] == 0
    total, best, n = _clauses("an idiot. a moron! fine")
    assert total == 2 * best and n == 3


def test_composition_equals_running_in_turn():
    machine, parts = toxicity.grammar(), [toxicity.negation(), toxicity.reported(), toxicity.target(), toxicity.threat()]
    rng = np.random.default_rng(0)
    for _ in range(50):
        state, states = 0, [0] * 4
        for x in rng.choice(list(toxicity.SYMBOLS), 20):
            state, y, w = machine[state][x]
            v, z = 1.0, x
            for k, p in enumerate(parts):
                states[k], z, f = p[states[k]][z]
                v *= f
            assert (y, round(w, 12)) == (z, round(v, 12))


def test_toxicity_held_out(spark):
    docs, labels = documents(spark, "/root/testdata/sf0.1"), table(spark, "/root/testdata/sf0.1", "labels")
    rows = toxicity.toxicity_report(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == brute.held_out(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    pos = np.array([r["score"] for r in rows if r["held_out"] and r["toxic"]])
    neg = np.array([r["score"] for r in rows if r["held_out"] and not r["toxic"]])
    auc = (pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2
    assert auc > 0.95 and (neg >= 0.5).mean() < 0.02


def test_toxicity_edge_cases(spark):
    docs = edge.frame(spark)
    labels = spark.createDataFrame([(8, 0), (21, 1), (21, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity_report(docs, labels).collect()
    assert len(rows) == len(edge.rows()) and all(0 <= r["score"] <= 1 for r in rows)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[21] == max(score.values())
    clean = toxicity.without_toxic(docs, labels.limit(0))
    assert clean.columns == docs.columns and 21 not in {r["doc_id"] for r in clean.collect()}
    assert toxicity.toxicity_report(edge.empty(spark), labels).count() == 0


def test_labels_of_held_out_rows_are_never_read(spark):
    docs, labels = documents(spark, SF), table(spark, SF, "labels")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = Counter(tuple(r) for r in toxicity.toxicity_report(docs, labels).collect())
    assert one == Counter(tuple(r) for r in toxicity.toxicity_report(docs, flipped).collect())


def test_quality_statistics_equal_brute_force(spark):
    for r in edge.rows():
        assert quality_rules.text_stats(r[1])[:5] == brute.quality_stats(r[1])
    docs, labels = documents(spark, SF), table(spark, SF, "labels")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality_rules.quality_report(docs, labels).collect():
        stats = brute.quality_stats(texts[r["doc_id"]])
        assert tuple(r)[1:6] == stats
        assert r["base_failed"] == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert not (r["base_failed"] and r["kept"])


def test_decision_list_covers_planted_rules_and_keeps_the_rest():
    rng = np.random.default_rng(7)
    x = rng.random((3000, len(quality_rules.RATIOS)))
    bad = (x[:, 1] > 0.9) | ((x[:, 4] < 0.2) & (x[:, 3] > 0.7))
    rules = quality_rules.learn_rules(x, bad)
    test = rng.random((3000, len(quality_rules.RATIOS)))
    truth = (test[:, 1] > 0.9) | ((test[:, 4] < 0.2) & (test[:, 3] > 0.7))
    got = np.zeros(3000, dtype=bool)
    for rule in rules:
        got |= quality_rules._covered(rule, test)
    assert (got == truth).mean() > 0.97
    assert quality_rules.learn_rules(x, rng.random(3000) < 0.1) == []  # noise gives no rule


def test_quality_edge_cases(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_rules.quality_report(edge.frame(spark), none).collect()
    assert len(rows) == len(edge.rows()) and all(r["kept"] == (not r["base_failed"]) for r in rows)
    assert quality_rules.quality_report(edge.empty(spark), none).count() == 0


def _expected(text):
    spans = brute.base_spans(text)
    k = Counter(s[2] for s in spans)
    return k["assign"], k["access"], k["hex"], hashlib.sha256(brute.span_text(spans).encode()).hexdigest()


def test_secrets_equal_brute_force(spark):
    texts = [r[1] for r in edge.rows()] + ["token:token:abcdefgh9 secret=a password = 'p4ssw0rd/+=.'", "AKIA AKIA0123456789AB AKIAAKIA0123456789",
             "api_key=\"" + "f" * 40, "APIKEY : 12345678\nPasswd=“x” PASSWORD==========", "-----BEGIN RSA PRIVATE KEY-----",
             "😀 http://user:pass1234@host/ token=abcd\u00e9fgh tokenK=12345678"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secret_scan.secret_report(df, secret_scan.fresh_ledger(spark)).collect():
        assert tuple(r)[1:5] == _expected(texts[r["doc_id"]])
        base = [f"{k}:{a}:{b}" for a, _, k, b in brute.base_spans(texts[r["doc_id"]])]
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex")] == base
    assert "pem:0:31" in {s for r in secret_scan.secret_report(df, secret_scan.fresh_ledger(spark)).collect() for s in r["spans"].split(",")}


def test_ledger_scans_only_unseen_blobs(spark):
    ledger = secret_scan.fresh_ledger(spark)
    one = spark.createDataFrame([("a", "token=12345678"), ("b", "clean"), ("c", "token=12345678"), (None, None)], "path string, text string")
    assert ledger.scan(one).count() == 4
    assert ledger.scanned().count() == 3 and ledger.findings().count() == 1
    two = one.unionByName(spark.createDataFrame([("a", "secret: abcdefgh"), ("d", "token=12345678")], "path string, text string"))
    paths = ledger.scan(two)
    assert ledger.scanned().count() == 4 and ledger.findings().count() == 2
    found = paths.join(ledger.findings(), "blob")
    assert sorted(r["path"] for r in found.collect()) == ["a", "a", "c", "d"]
    newer = secret_scan.BlobLedger(spark, ledger.path, secret_scan.BASE_RULES)
    assert newer.scanned().count() == 0  # other rules, another version
    newer.scan(two)
    assert newer.scanned().count() == 4 and ledger.scanned().count() == 4


def test_secret_edge_cases(spark):
    docs = edge.frame(spark)
    rows = secret_scan.secret_report(docs, secret_scan.fresh_ledger(spark)).collect()
    assert Counter((r["doc_id"], *tuple(r)[1:5]) for r in rows) == Counter((r[0], *_expected(r[1])) for r in edge.rows())
    assert secret_scan.secret_report(edge.empty(spark), secret_scan.fresh_ledger(spark)).count() == 0
    assert set(secret_scan.fresh_ledger(spark).scan(docs).columns) == {c for c in docs.columns if c != "text"} | {"_blob"}
