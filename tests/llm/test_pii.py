"""Personal data against plain regular expressions and per-character checks."""

import hashlib
import os
import random
import re
import sys
import time
from collections import Counter

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import edge  # noqa: E402

from tabforge.llm import pii  # noqa: E402
from tabforge.llm.common import documents  # noqa: E402

SF = "/root/testdata/sf0.01"
NUMBER = r"[0-9]+(-[0-9]+)*"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9]){11,}", "phone": r"\+[0-9][\x20().0-9-]+[0-9]", "iban": pii.IBAN, "ssn": NUMBER, "routing": NUMBER,
    "birth": NUMBER,
}


BASE = dict(list(PLAIN.items())[:4]) | {"card": r"[0-9]([\x20-]?[0-9])+"}  # the contract's patterns


def digits(m):
    return re.sub("[^0-9]", "", m)


def luhn(d):
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def iban_part(m):
    want = pii.IBAN_LENGTHS.get(m[:2])
    for part in (m, re.sub(" [A-Z0-9]*$", "", m)):
        if len(part.replace(" ", "")) == want:
            return part
    return None


def iban_ok(m, text, s):
    part = iban_part(m)
    if part is None or re.match("[A-Za-z0-9]", text[s - 1:s] if s else "") or re.match("[A-Za-z0-9]", text[s + len(part):s + len(part) + 1]):
        return None
    body = part.replace(" ", "")
    return part if int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97 == 1 else None


def confirmed(kind, m, text, s):
    """The part of the match that the kind's validator confirms, or None."""
    alone = not (s and re.match("[A-Za-z0-9+.]", text[s - 1]))
    if kind == "iban":
        return iban_ok(m, text, s)
    good = {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda: 12 <= len(digits(m)) <= 19 and luhn(digits(m)), "phone": lambda: 9 <= len(digits(m)) <= 15,
        "ssn": lambda: alone and re.fullmatch("[0-9]{3}-[0-9]{2}-[0-9]{4}", m) and not re.search("^(000|666|9)|-00-|-0000$", m),
        "routing": lambda: alone and re.fullmatch("[0-9]{9}", m) and m != "0" * 9
        and sum(int(c) * w for c, w in zip(m, (3, 7, 1) * 3)) % 10 == 0,
        "birth": lambda: alone and re.fullmatch("(19|20)[0-9]{2}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])", m),
    }[kind]()
    return m if good else None


def brute(text):
    """Sorted [(start, kind_no, end, score)]."""
    text, out = text or "", []
    for k, kind in enumerate(pii.KINDS):
        ms = list(re.finditer(PLAIN[kind.name], text))
        for i, m in enumerate(ms):
            part = confirmed(kind.name, m[0], text, m.start())
            if part is None:
                continue
            left = text[max(ms[i - 1].end() - 1 if i else 0, m.start() - pii.BEFORE):m.start()]
            right = text[m.end():min(ms[i + 1].start() + 1 if i + 1 < len(ms) else len(text), m.end() + pii.AFTER)]
            near = f" {left.lower()} \n {right.lower()} "
            score = round(kind.score + (kind.bonus if re.search(f"[^a-z](?:{kind.context})[^a-z]", near) else 0), 2)
            if score >= pii.THRESHOLD:
                out.append((m.start(), k, m.start() + len(part), score))
    return sorted(out)


def row(doc_id, text):
    spans = brute(text)
    name = lambda s: f"{pii.KINDS[s[1]].name}:{s[0]}:{s[2]}"
    base = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "")
                  if confirmed(kind, m[0], text, m.start()))
    assert base == [s[:3] for s in spans if s[1] < 4]
    counts = Counter(s[1] for s in base)
    return (doc_id, *[counts[k] for k in range(4)], hashlib.sha256(",".join(map(name, base)).encode()).hexdigest(),
            ",".join(map(name, spans)), ",".join(str(s[3]) for s in spans))


def check(docs):
    want = Counter(row(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    assert Counter(tuple(r) for r in pii.pii_report(docs).collect()) == want
    return want


def test_documents(spark):
    want = check(documents(spark, SF))
    assert sum(r[1] for r in want) and sum(r[2] for r in want) and sum(r[4] for r in want)


def test_edge_rows(spark):
    docs = edge.frame(spark).withColumn("pii", F.lit(1))
    check(docs)
    found, name = pii.find_pii(docs)
    assert name == "_pii" and found.columns == [*docs.columns, "_pii"]
    assert pii.pii_report(edge.empty(spark)).collect() == []


def test_random_texts_of_awkward_pieces(spark):
    rng = random.Random(11)
    pieces = ["a@b.c", "_", "x.y%z", "@", ".", "1.2.3.4", "256.1.1.1", "007.000255.1.01", "4539 1488 0343 6467", "4539148803436467",
              "+1 (555) 555-1234", "+49", " ", "  ", "-", "12", "7", "é", "😀", "\n", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000",
              "GB82WEST12345698765432", "ES91 2100 0418 4502 0005 1332", "FR1420041010050500013M02606", "AND", "X", "iban", "ssn", "123-45-6789",
              "000-12-3456", "routing", "021000021", "123456789", "born", "1980-02-30", "2000-13-01", "card", "phone:", "(", ")"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 40))) for _ in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = check(docs)
    kinds = Counter(s.split(":")[0] for r in want for s in r[6].split(",") if s)
    assert set(kinds) == {k.name for k in pii.KINDS}


def test_checksums_and_context(spark):
    text = ("IBAN DE89 3704 0044 0532 0130 00 AND then DE89370400440532013001 bad; social security 123-45-6789, alone 123-45-6789;"
            " aba 021000021, number 021000022, born 1980-02-03")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = pii.pii_report(docs).first()["spans"].split(",")
    assert [f.split(":")[0] for f in found] == ["iban", "ssn", "routing", "birth"]
    assert pii.redacted(docs).first()["text"] == (
        "IBAN <IBAN> AND then DE89370400440532013001 bad; social security <SSN>, alone 123-45-6789;"
        " aba <ROUTING>, number 021000022, born <BIRTH>")


def test_redaction_of_overlaps_nulls_and_columns(spark):
    docs = spark.createDataFrame([(1, "x +1.2.3.4.567.890 y"), (2, None), (3, ""), (4, "plain 😀"), (5, "😀 a@b.co, c@d.co.")],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redacted(docs).collect()}
    assert got == {1: "x <PHONE> y", 2: None, 3: "", 4: "plain 😀", 5: "😀 <EMAIL>, <EMAIL>."}
    assert pii.redacted(docs).columns == docs.columns


def test_very_long_texts(spark):
    """Runs without a match, and many matches in one text, take time in proportion."""
    n = 400_000
    texts = ["x" * n, "1" * n, "1 " * n, "1." * n, "+" * n, "+1" + " " * n, "a@" * (n // 2), "a@b." * (n // 4), "A" * n, "1-" * n,
             "a@b.c " * 40_000, "4539148803436467, " * 20_000, "AB12" * (n // 4)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(8)
    start = time.time()
    got = {r["doc_id"]: r for r in pii.pii_report(docs).collect()}
    assert time.time() - start < 120
    assert got[10]["n_email"] == 40_000 and got[11]["n_card"] == 20_000 and got[0]["spans"] == ""
    assert got[10]["spans"].endswith("email:239994:239999")


def test_running_sums_in_blocks(spark):
    rows = [(list(range(n)),) for n in (1, 255, 256, 257, 512, 1000)]
    out = spark.createDataFrame(rows, "a array<int>").select("a", pii._running(F.col("a")).alias("s")).collect()
    for r in out:
        assert r["s"] == [sum(r["a"][:i + 1]) for i in range(len(r["a"]))]


def test_no_exchange_and_no_python(spark):
    plan = pii.pii_report(documents(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
