"""Quality rules: fixed base checks, then a learned decision list.

Statistics of a whole text (words ``[^\\x20\\x09-\\x0D]+``; null has none):
n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and for the list
n_lines, n_upper (A-Z), n_letters (A-Z, a-z) and n_bangs (``!``).

The list is learned by sequential covering on a bounded sample of labelled
rows that pass the base checks: a rule grows by the threshold condition with
the best information gain on two thirds of the rows, is pruned from its end on
the other third, and joins the list if it is precise there; the rows it covers
are removed and the next rule is grown.  The result is an ordered chain of
Spark conditions: a document that a rule covers is dropped, any other kept.

Empty and null texts fail the base checks (0 words).  Without labelled rows of
both kinds the list is empty and the base checks decide alone.  Rows with null
or repeated doc_ids are judged each by its own text; of repeated labels the
lowest quality counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tabforge.session import ship_package

from .common import written

MAX_LABELLED = 20_000   # labelled rows (of numbers) that the driver fits on
MIN_WORDS = 50
MAX_REPEAT = 50         # per cent
MAX_RULES = 16
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
CUTS = 40               # candidate thresholds per ratio

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_bangs")
RATIOS = ("word_length", "symbols", "dup_lines", "repeats", "upper", "bangs", "words_per_line", "n_words")
_SYMBOLS = [bytes([c]) for c in b"#*$%&|<>"]
_SPACES = [bytes([c]) for c in b" \t\n\x0b\x0c\r"]


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more, the first occurrence included."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), dtype=np.int64, count=len(words))
    pairs = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1].astype(np.int64)
    _, window, count = np.unique(pairs[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    mark = np.zeros(len(words), dtype=bool)
    for k in range(3):
        mark[k:len(words) - 2 + k] |= twice
    return int(mark.sum())


def text_stats(text: str | None) -> tuple:
    raw = (text or "").encode("utf-8")
    words = raw.split()  # bytes.split() splits at ASCII white space only
    spaces = sum(raw.count(c) for c in _SPACES)
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    codes = np.frombuffer(raw, dtype=np.uint8)
    upper = int(((codes >= 65) & (codes <= 90)).sum())
    lower = int(((codes >= 97) & (codes <= 122)).sum())
    return (len(words), len(text or "") - spaces, sum(raw.count(c) for c in _SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), upper, upper + lower, raw.count(b"!"))


def stats_column(text: Column) -> Column:
    @pandas_udf(", ".join(f"{c} long" for c in STATS))
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_stats(t) for t in texts], columns=list(STATS))
    return stats(text)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return {"word_length": F.col("word_chars") / words, "symbols": F.col("n_symbols") / words,
            "dup_lines": F.col("n_dup_lines") / lines, "repeats": F.col("n_repeat_words") / words,
            "upper": F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1)), "bangs": F.col("n_bangs") / words,
            "words_per_line": words / lines, "n_words": F.col("n_words").cast("double")}


@dataclass(frozen=True)
class Condition:
    ratio: str
    above: bool
    cut: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, RATIOS.index(self.ratio)]
        return v >= self.cut if self.above else v < self.cut

    def column(self) -> Column:
        v = ratios()[self.ratio]
        return v >= F.lit(self.cut) if self.above else v < F.lit(self.cut)


def _covered(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """Add the condition with the best information gain until no good row is covered."""
    rule, inside = [], np.ones(len(x), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p, n = (inside & bad).sum(), inside.sum()
        best, gain = None, 1e-9
        for j, name in enumerate(RATIOS):
            cuts = np.unique(np.quantile(x[inside & bad, j], np.linspace(0, 1, CUTS)))
            for cut in cuts:
                for above in (True, False):
                    c = Condition(name, above, float(cut))
                    got = inside & c.holds(x)
                    p2, n2 = (got & bad).sum(), got.sum()
                    if p2 and p2 * (np.log2(p2 / n2) - np.log2(p / n)) > gain:
                        best, gain = c, p2 * (np.log2(p2 / n2) - np.log2(p / n))
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return rule


def _worth(rule: list[Condition], x: np.ndarray, bad: np.ndarray) -> tuple[float, int]:
    """(precision, covered bad rows), the precision with one error added."""
    got = _covered(rule, x)
    p = int((got & bad).sum())
    return p / (int(got.sum()) + 1), p


def learn_rules(x: np.ndarray, bad: np.ndarray) -> list[list[Condition]]:
    """Ordered rules that say "drop"; ``x`` has a column per entry of RATIOS, in a stable row order."""
    rules: list[list[Condition]] = []
    prune = np.arange(len(x)) % 3 == 0
    while len(rules) < MAX_RULES and (bad & ~prune).sum() >= 5:
        rule = _grow(x[~prune], bad[~prune])
        if not rule:
            break
        shorter = [rule[:k] for k in range(1, len(rule) + 1)]
        rule = max(shorter, key=lambda r: (_worth(r, x[prune], bad[prune])[0], -len(r)))
        got = _covered(rule, x)
        if (got & bad).sum() / max(1, got.sum()) < MIN_PRECISION or _worth(rule, x[prune], bad[prune])[0] < MIN_PRECISION - 0.1:
            break
        rules.append(rule)
        x, bad, prune = x[~got], bad[~got], prune[~got]
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """True (keep) or false (drop) by the first rule that covers the row."""
    out = None
    for rule in rules:
        cond = rule[0].column()
        for c in rule[1:]:
            cond = cond & c.column()
        out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(stats: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[list[Condition]]:
    """Rules from at most ``max_labelled`` labelled rows, chosen by a hash of the id."""
    ids = (labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("id"))
           .agg(F.min("quality").alias("quality")).orderBy(F.xxhash64(F.lit(6), "id"), "id").limit(max_labelled))
    passing = stats.filter(~base_failed()).join(F.broadcast(ids), F.col("doc_id") == F.col("id"))
    rows = passing.select("id", "quality", *[c.alias(f"r{k}") for k, c in enumerate(ratios().values())]).collect()
    rows.sort(key=lambda r: (r["id"] * 2654435761 % 4294967296, tuple(r)))  # the same order on every run
    x = np.array([[r[f"r{k}"] for k in range(len(RATIOS))] for r in rows], dtype=float).reshape(-1, len(RATIOS))
    bad = np.array([r["quality"] == 0 for r in rows], dtype=bool)
    return learn_rules(x, bad) if bad.any() and not bad.all() else []


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept."""
    ship_package(docs.sparkSession)
    stats = written(docs.select("doc_id", stats_column(F.col("text")).alias("s")).select("doc_id", "s.*"), "quality-stats")
    rules = fit(stats, labels)
    return stats.select("doc_id", *STATS[:5], base_failed().alias("base_failed"),
                        (~base_failed() & verdict(rules)).alias("kept"))
