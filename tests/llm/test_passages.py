import os
import random
import sys

sys.path.insert(0, os.path.dirname(__file__))
import edge  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from tabforge.llm import line_dedup  # noqa: E402


def _common_runs(a, b):
    """(start in a, start in b, length) of the maximal runs of equal lines, by comparing all pairs of lines."""
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i] == b[j] and not (i and j and a[i - 1] == b[j - 1]):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                yield i, j, n


def _kept_lines(texts):
    """The lines that stay: those in no run of 2+ lines (with a word) that stands earlier."""
    gone = set()
    lines = [t.split("\n") for t in texts]
    for y, b in enumerate(lines):
        for x, a in enumerate(lines[:y + 1]):
            for i, j, n in _common_runs(a, b):
                if x < y or i < j:
                    for k in range(n - 1):
                        if (b[j + k] + b[j + k + 1]).strip(" \t\n\v\f\r"):
                            gone |= {(y, j + k), (y, j + k + 1)}
    return [[line for k, line in enumerate(t) if (y, k) not in gone] for y, t in enumerate(lines)]


def _texts():
    rng = random.Random(11)
    fresh = iter(range(10**6))

    def prose(n):
        return [f"line {next(fresh)} " + " ".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(n)]
    passages = [prose(n) for n in (1, 2, 2, 2, 3, 4, 5, 9)]
    texts = ["\n".join(prose(rng.randint(0, 5)) + rng.choice(passages) + prose(rng.randint(0, 3)) + rng.choice(passages) + prose(2))
             for _ in range(40)]
    return [*texts, "", "\n\n\n", "x\n\n\n\ny", " \n\n", "same\n" * 9, "a\nb\na\nb\na", "one line", texts[0]]


def test_every_repeated_passage_of_two_lines_goes(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_passages(docs).collect()}
    kept = _kept_lines(texts)
    for y, t in enumerate(texts):
        assert got[y]["text"] == "\n".join(kept[y])
        assert got[y]["n_lines"] == t.count("\n") + 1 and got[y]["n_removed"] == got[y]["n_lines"] - len(kept[y])
    left = {line for r in got.values() for line in r["text"].split("\n")}
    assert {line for t in texts for line in t.split("\n") if line} <= left  # every line stays somewhere


def test_two_line_passages_that_no_chunk_cut_frames(spark):
    passage = "first line of the passage\nsecond line of it"
    texts = [f"before {k} x\n{passage}\nafter {k} y" for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert line_dedup.dedup_passages(docs).filter("n_removed = 2").count() == 29
    assert line_dedup.dedup_lines(docs).filter("n_removed = 2").count() < 29  # the chunk rule of op1_line_dedup


def test_passages_edge_cases(spark):
    docs = edge.frame(spark)
    out = line_dedup.dedup_passages(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == len(edge.rows())
    assert sum(r["text"] is None for r in rows) == sum(r[1] is None for r in edge.rows())
    assert len({r["text"] for r in rows if r["doc_id"] == 8}) == 1  # copies of a row are treated alike
    passage = edge.rows()[14][1].split("\n")
    held = sorted(sum(line in (r["text"] or "") for line in passage) for r in rows if r["doc_id"] in (12, 13, 14))
    assert held == [0, 0, len(passage)]
    assert line_dedup.passage_report(edge.empty(spark)).count() == 0


def test_clashing_counts_keep_their_columns(spark, tmp_path):
    docs = edge.frame(spark).selectExpr("*", "777L as n_lines", "'x' as n_removed")
    for dedup in (line_dedup.dedup_lines, line_dedup.dedup_passages):
        out = dedup(docs)
        assert out.columns == [*docs.columns, "_n_lines", "_n_removed"]
        out.write.parquet(f"file://{tmp_path}/{dedup.__name__}")
        assert {(r["n_lines"], r["n_removed"]) for r in out.collect()} == {(777, "x")}


def test_pieces_that_share_a_hash_are_told_apart_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_group_key", lambda piece: F.substring(F.md5(piece), 1, 1))  # 16 values
    texts = _texts()[:30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_passages(docs).collect()}
    assert got == {y: "\n".join(lines) for y, lines in enumerate(_kept_lines(texts))}
