"""Toxicity by a weighted grammar of finite-state transducers over clauses.

Words become symbols: insult, threat, person (target), copula, intent,
negation, report and quotation mark.  Five transducers then rewrite a clause's
symbols, each with a factor: an insult counts in full only in a pattern
(target-copula-insult, vocative, insult phrase), negation weakens what follows
it, reported speech and quotation weaken what is quoted, a target near an
insult strengthens it, and a threat counts in full only with an intent or a
target.  They are composed once into one transducer.  A clause's score is the sum of lexical weight x factor;
a document is scored from its sum, its best clause and its density of clauses
through a logistic calibration.

The lexicon holds fixed words and learned ones: on a bounded sample of
labelled training rows, Spark counts in how many toxic and clean documents
each word and word beginning occurs, and those with a significant
log-likelihood ratio get their log odds as weight.  Only the text is an input
of a score.  Rows whose crc32(doc_id) mod 5 is 0 are never learned from.

Null and empty texts have no clause and get the calibration's base score.
Repeated labels of a doc_id count as toxic if one says so.  Without any
labelled row of both kinds the fixed words and a fixed calibration are used.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tabforge.session import ship_package

from .common import fresh, whole_text

# Bound of the labelled rows that the lexicon and the calibration are fitted on (~1 MB of ids, broadcast).
MAX_LABELLED = 12_000
MAX_LEARNED = 2_000      # learned lexicon entries kept, by significance
MIN_RATIO = 25.0         # log-likelihood ratio of a learned entry
MIN_SHARE = 0.6          # share of toxic documents among those with the entry
PREFIXES = (4, 5, 6)     # lengths of word beginnings, in code points
SEED_WEIGHT = 3.0

# Fixed words of the grammar.
INSULTS = """idiot idiots moron morons scum stupid worthless loser losers clown pathetic trash disgusting dumb fool
    imbecile vermin filth idiota idiotas imbécil estúpido estúpida basura idiote imbécile crétin ordure dummkopf trottel
    abschaum""".split()
THREATS = "kill hurt destroy beat burn shoot stab murder crush matar tuer töten umbringen destruir".split()
PERSONS = """you your yourself he she him her they them his their people du dich dir ihr sie tu toi vous ils elles usted
    ustedes ellos""".split()
COPULAS = """is are am was were be been being you're you’re he's he’s she's she’s they're they’re bist ist sind seid
    war waren es est êtes sont était étais eres son era eran fue""".split()
INTENTS = "will shall gonna going must should werde werden vais allons voy vamos".split()
NEGATIONS = "not never no neither nor isn't aren't don't doesn't wasn't nicht kein keine nie pas jamais nunca".split()
REPORTS = """said says say told called calls wrote writes claims claimed quoted reported according sagte sagt dit
    disait dijo dice""".split()

OTHER, INSULT, THREAT, PERSON, INTENT, NEGATION, REPORT, QUOTE, COPULA = "oitpgnrqc"
SYMBOLS = (OTHER, INSULT, THREAT, PERSON, INTENT, NEGATION, REPORT, QUOTE, COPULA)
BREAK = "."
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;\n]|[\"“”«»]")

# A transducer: state -> symbol -> (next state, symbol written, factor); state 0 starts a clause.
Transducer = dict


def _machine(states, step) -> Transducer:
    return {s: {x: step(s, x) for x in SYMBOLS} for s in states}


def negation(reach: int = 3, factor: float = 0.25) -> Transducer:
    """An insult or threat at most ``reach`` words after a negation is weakened; the state counts down."""
    def step(s, x):
        if x == NEGATION:
            return reach, x, 1.0
        return max(0, s - 1), x, factor if s and x in (INSULT, THREAT) else 1.0
    return _machine(range(reach + 1), step)


def reported(factor: float = 0.5) -> Transducer:
    """After a verb of saying, up to the end of the clause, or inside quotation marks.

    States: 0 plain, 1 after a report, 2 in quotation marks, 3 both.
    """
    def step(s, x):
        after = s | 1 if x == REPORT else s ^ 2 if x == QUOTE else s
        return after, x, factor if s and x in (INSULT, THREAT) else 1.0
    return _machine(range(4), step)


def target(reach: int = 4, factor: float = 1.5) -> Transducer:
    """An insult at most ``reach`` words after a person is strengthened."""
    def step(s, x):
        near = reach if x == PERSON else max(0, s - 1)
        return near, x, factor if s and x == INSULT else 1.0
    return _machine(range(reach + 1), step)


def threat(factor: float = 0.3) -> Transducer:
    """A threat counts in full after an intent or a person in its clause, else weakly."""
    def step(s, x):
        return (1 if x in (INTENT, PERSON) else s), x, factor if not s and x == THREAT else 1.0
    return _machine(range(2), step)


ISOLATED = 0.3  # factor of an insult outside every insult pattern


def insult(near: int = 2, reach: int = 4, factor: float = ISOLATED) -> Transducer:
    """An insult counts in full only in a pattern, else it is weakened.

    Patterns: a person, a copula at most ``near`` words on and the insult at
    most ``reach`` words after that; a person at most ``near`` words before it;
    the first word of a clause (vocative); directly after another insult.
    States: 0 start, 1 plain, 2 after an insult, then words left after a person
    (``near``) and after its copula (``reach``).
    """
    start, plain, phrase = range(3)
    person = {k: 2 + k for k in range(1, near + 1)}
    copula = {k: 2 + near + k for k in range(1, reach + 1)}
    left = {v: (group, k) for group in (person, copula) for k, v in group.items()}

    def step(s, x):
        group, k = left.get(s, ({}, 0))
        if x == INSULT:
            return phrase, x, factor if s == plain else 1.0
        if x == PERSON:
            return person[near], x, 1.0
        if x == COPULA and group is person:
            return copula[reach], x, 1.0
        if x == QUOTE:
            return s, x, 1.0
        return group.get(k - 1, plain), x, 1.0
    return _machine(range(3 + near + reach), step)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that feeds what ``first`` writes to ``second``; factors multiply."""
    out, todo, number = {}, [(0, 0)], {(0, 0): 0}
    while todo:
        a, b = todo.pop()
        row = {}
        for x in SYMBOLS:
            a2, y, w1 = first[a][x]
            b2, z, w2 = second[b][y]
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            row[x] = number[a2, b2], z, w1 * w2
        out[number[a, b]] = row
    return out


def grammar() -> Transducer:
    out = negation()
    for part in (reported(), target(), threat()):
        out = compose(out, part)
    return out


def full_grammar() -> Transducer:
    """The grammar with the insult patterns: what documents are scored by."""
    return compose(insult(), grammar())


@dataclass
class Lexicon:
    """word -> (symbol, weight), and word beginnings -> weight of an insult."""
    words: dict = field(default_factory=dict)
    beginnings: dict = field(default_factory=dict)

    def look_up(self, word: str) -> tuple[str, float]:
        if word in ".!?;\n":
            return BREAK, 0.0
        if word in "\"“”«»":
            return QUOTE, 0.0
        if (hit := self.words.get(word)) is not None:
            return hit
        return max(((INSULT, self.beginnings[word[:n]]) for n in PREFIXES if word[:n] in self.beginnings and len(word) >= n),
                   key=lambda x: x[1], default=(OTHER, 0.0))


def seed_lexicon() -> Lexicon:
    out = {}
    for symbol, weight, words in ((REPORT, 0.0, REPORTS), (NEGATION, 0.0, NEGATIONS), (INTENT, 0.0, INTENTS),
                                  (PERSON, 0.0, PERSONS), (COPULA, 0.0, COPULAS), (THREAT, SEED_WEIGHT, THREATS), (INSULT, SEED_WEIGHT, INSULTS)):
        out |= {w: (symbol, weight) for w in words}
    return Lexicon(out)


def clause_scores(text: str | None, lexicon: Lexicon, machine: Transducer, memo: dict) -> tuple[float, float, int]:
    """(sum of clause scores, best clause, number of clauses with a word)."""
    total = best = score = 0.0
    clauses = state = 0
    words = False
    for token in _TOKEN.findall((text or "").lower()):
        hit = memo.get(token)
        if hit is None:
            if len(memo) > 100_000:
                memo.clear()
            hit = memo[token] = lexicon.look_up(token)
        symbol, weight = hit
        if symbol == BREAK:
            clauses, words = clauses + words, False
            total, best, score, state = total + score, max(best, score), 0.0, 0
            continue
        words = True
        state, written, factor = machine[state][symbol]
        if weight and written in (INSULT, THREAT):
            score += weight * factor
    return max(0.0, total + score), max(best, score), clauses + words


def clause_column(text: Column, lexicon: Lexicon) -> Column:
    """struct(total, best, clauses) of each text."""
    machine = full_grammar()

    @pandas_udf("total double, best double, clauses long")
    def clauses(texts: pd.Series) -> pd.DataFrame:
        memo: dict = {}
        rows = [clause_scores(t, lexicon, machine, memo) for t in texts]
        return pd.DataFrame(rows, columns=["total", "best", "clauses"])
    return clauses(text)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5, is 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(text, toxic) of at most ``max_labelled`` labelled rows, chosen by a hash of the id; never held-out ones."""
    ids = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
           .groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(max_labelled))
    return docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("text", "toxic")


def _beginnings(words: Column, n: int) -> Column:
    """Distinct first ``n`` letters of the words that have them, marked by ``~``."""
    long = F.filter(words, lambda w: F.length(w) >= n)
    return F.array_distinct(F.transform(long, lambda w: F.concat(w.substr(F.lit(1), F.lit(n)), F.lit("~"))))


def learn_lexicon(train: DataFrame) -> Lexicon:
    """Seed lexicon plus learned words and word beginnings."""
    lexicon = seed_lexicon()
    n_clean, n_toxic = (train.agg(F.sum((F.col("toxic") == 0).cast("long")), F.sum((F.col("toxic") == 1).cast("long"))).first())
    if not n_clean or not n_toxic:
        return lexicon
    words = F.filter(F.array_distinct(F.split(F.lower(whole_text(F.col("text"))), r"[^\p{L}]+")), lambda w: F.length(w) >= 3)
    starts = [_beginnings(F.col("w"), n) for n in PREFIXES]
    units = train.select("toxic", words.alias("w")).select("toxic", F.explode(F.concat(F.col("w"), *starts)).alias("unit"))
    counted = units.groupBy("unit").agg(F.sum("toxic").cast("double").alias("t"), F.count(F.lit(1)).cast("double").alias("n"))
    base = n_toxic / (n_clean + n_toxic)
    t, n = F.col("t"), F.col("n")

    def part(x: Column, expected: Column) -> Column:
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    ratio = 2 * (part(t, n * base) + part(n - t, n * (1 - base)))
    # where most labels are toxic, a word over MIN_SHARE can still be commoner in clean texts: its weight would be negative
    weight = F.log((t + 0.5) / F.lit(n_toxic + 1.0)) - F.log((n - t + 0.5) / F.lit(n_clean + 1.0))
    rows = (counted.filter((t / n >= MIN_SHARE) & (t / n > base) & (weight > 0)).withColumn("ratio", ratio)
            .filter(F.col("ratio") >= MIN_RATIO).orderBy(F.col("ratio").desc(), "unit").limit(MAX_LEARNED).collect())
    for r in rows:
        weight = math.log((r["t"] + 0.5) / (n_toxic + 1)) - math.log((r["n"] - r["t"] + 0.5) / (n_clean + 1))
        unit = r["unit"]
        if unit.endswith("~"):
            lexicon.beginnings[unit[:-1]] = weight
        elif lexicon.words.get(unit, (INSULT,))[0] == INSULT:
            lexicon.words[unit] = (INSULT, weight)
    return lexicon


def _inputs(total, best, clauses, lib) -> list:
    """Inputs of the calibration, for numpy arrays or Spark columns alike."""
    return [lib.log1p(total), lib.log1p(best), total / lib.sqrt(1.0 + clauses)]


def calibrate(rows: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2) -> list[float]:
    """Logistic regression by Newton steps: intercept and one weight per input."""
    if len(set(toxic.tolist())) < 2:
        return [-2.0, 2.0, 0.0, 0.0]
    x = np.column_stack([np.ones(len(rows)), *_inputs(rows[:, 0], rows[:, 1], rows[:, 2], np)])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (toxic - p) - ridge * len(x) * np.r_[0, beta[1:]] / 100
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * len(x) / 100 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    beta: list[float]

    def scored(self, docs: DataFrame, score: str) -> DataFrame:
        """``docs`` with a score from 0 to 1; rows stay where they are."""
        c = fresh(docs, "_clauses")
        out = docs.withColumn(c, clause_column(F.col("text"), self.lexicon))
        z = F.lit(self.beta[0])
        for b, x in zip(self.beta[1:], _inputs(F.col(f"{c}.total"), F.col(f"{c}.best"), F.col(f"{c}.clauses").cast("double"), F)):
            z = z + F.lit(b) * x
        return out.withColumn(score, 1 / (1 + F.exp(-z))).drop(c)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    ship_package(docs.sparkSession)
    train = training_rows(docs, labels, max_labelled)
    lexicon = learn_lexicon(train)
    c = clause_column(F.col("text"), lexicon)
    rows = train.select("toxic", c.alias("c")).select("toxic", "c.*").collect()  # at most max_labelled rows of numbers
    data = np.array([[r["total"], r["best"], r["clauses"]] for r in rows], dtype=float).reshape(-1, 3)
    return ToxicityModel(lexicon, calibrate(data, np.array([r["toxic"] for r in rows], dtype=float)))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = fit(docs, labels)
    rows = model.scored(docs.select("doc_id", "text"), "score")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the model predicts to be toxic."""
    score = fresh(docs, "_score")
    rows = fit(docs, labels).scored(docs, score)
    toxic = (F.col(score) >= 0.5) & ~F.isnan(score)  # a null or NaN score condemns no document
    return rows.filter(~F.coalesce(toxic, F.lit(False))).select(*[F.col(f"`{c}`") for c in docs.columns])
