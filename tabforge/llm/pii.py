"""Personal data by pattern, checksum and context, DataFrame functions only.

Regular expressions propose spans; a validator of the kind confirms each one
(digit counts, Luhn, mod-97 with the country's length, the routing checksum,
part ranges); the words nearby adjust its score, and a proposal becomes a span
when its score reaches ``THRESHOLD``.  Nearby are the 40 code points before and
the 20 after a proposal, up to the nearest character of the next proposal of
its pattern.
The base kinds reach the threshold by their validator alone, so context only
moves their score; ``ssn``, ``routing`` and ``birth`` need a word of theirs.

Everything is one projection: a text is matched, validated and scored inside
its row, so nothing is shuffled and a long text costs its own length.
Positions are running sums of the pieces between matches, in two levels
(``_BLOCK`` pieces, then blocks), so that many matches in one text do not cost
their square.  Patterns never backtrack over a run: a match starts at the
beginning of its run (or where the match before ended), and repeated groups are
possessive, which also keeps very long texts off the stack.

Spans are code points, end exclusive.  A null text counts as empty and has no
spans; null or repeated ids, repeated rows and extra columns change nothing,
each row is judged alone; an empty table gives an empty result.  Added columns
get underscores in front where the table has such columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, whole_text

THRESHOLD = 0.5
BEFORE, AFTER = 40, 20
_BLOCK = 256

# Patterns.  Each finds what the plain pattern in its comment finds, without rescanning a run from every position.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"  # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"                 # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"                    # [0-9]([\x20-]?[0-9])+ of 12 digits or more: one match a chain either way
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
NUMBER = r"[0-9]++(?:-[0-9]++)*+"                         # [0-9]+(-[0-9]+)*: a whole run of digits and single hyphens

# Length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MR": 27, "MT": 31, "MU": 30,
    "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TN": 24, "TR": 26,
}


@dataclass(frozen=True)
class Kind:
    """One kind of personal data: who proposes it, who confirms it, what it is worth."""

    name: str
    pattern: str
    present: Callable[[Column], Column]    # cheap test: can the text hold a proposal?
    valid: Callable[[Column, Column, Column], Column]  # (match, before, after) -> boolean
    score: float                           # of a confirmed proposal
    context: str                           # words, as alternatives of a regular expression
    bonus: float = 0.3                     # of a context word nearby
    trim: Callable[[Column], Column] | None = None  # the part of the match that is the span, from its start


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def _ip_parts(m: Column, before: Column, after: Column) -> Column:
    """Parts at most 255, leading zeros or not."""
    return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _luhn(m: Column, before: Column, after: Column) -> Column:
    d = _digits(m)
    return F.when(_between(F.length(d), 12, 19), F.call_function("luhn_check", d)).otherwise(F.lit(False))


def _phone_digits(m: Column, before: Column, after: Column) -> Column:
    return _between(F.length(_digits(m)), 9, 15)


def _iban_part(m: Column) -> Column:
    """The match, or the match without its last group when only that has the country's length."""
    shorter = F.regexp_replace(m, r"\x20[A-Z0-9]*$", "")
    return F.when(F.length(F.replace(m, F.lit(" "))) == _iban_length(m), m).otherwise(shorter)


def _iban_length(m: Column) -> Column:
    by_length: dict[int, list[str]] = {}
    for country, n in sorted(IBAN_LENGTHS.items()):
        by_length.setdefault(n, []).append(country)
    out, country = F.lit(0), F.substring(m, 1, 2)
    for n, countries in by_length.items():
        out = F.when(country.isin(countries), n).otherwise(out)
    return out


def _mod97(m: Column) -> Column:
    """Remainder of the rearranged IBAN with A = 10 ... Z = 35, digit by digit."""
    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - F.ascii(F.lit("A")) + 10
        return F.when(c.rlike("[0-9]"), (rest * 10 + F.ascii(c) - F.ascii(F.lit("0"))) % 97).otherwise((rest * 100 + letter) % 97)

    turned = F.concat(F.substring(m, 5, 40), F.substring(m, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _iban(m: Column, before: Column, after: Column) -> Column:
    body = F.replace(_iban_part(m), F.lit(" "))
    alone = ~before.rlike("[A-Za-z0-9]$") & (~after.rlike("^[A-Za-z0-9]") | (F.length(_iban_part(m)) < F.length(m)))
    return F.when(alone & (F.length(body) == _iban_length(m)), _mod97(body) == 1).otherwise(F.lit(False))


def _ssn(m: Column, before: Column, after: Column) -> Column:
    return m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$") & ~m.rlike("^(000|666|9)|-00-|-0000$") & ~before.rlike("[A-Za-z0-9+.]$")


def _routing(m: Column, before: Column, after: Column) -> Column:
    """Nine digits whose sum weighted 3, 7, 1 divides by 10."""
    total = F.lit(0)
    for i, w in enumerate((3, 7, 1) * 3):
        total = total + F.lit(w) * F.substring(m, i + 1, 1).cast("int")
    return F.when(m.rlike("^[0-9]{9}$") & (m != "000000000") & ~before.rlike("[A-Za-z0-9+.]$"), total % 10 == 0).otherwise(F.lit(False))


def _birth(m: Column, before: Column, after: Column) -> Column:
    return m.rlike("^(19|20)[0-9]{2}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$") & ~before.rlike("[A-Za-z0-9+.]$")


# Base kinds in the contract's order, then the kinds that this operator adds.
BASE_KINDS = (
    Kind("email", EMAIL, lambda t: t.contains("@"), lambda m, b, a: F.lit(True), 0.7, "e-?mail|mail|contact|write|address"),
    Kind("ip", IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), _ip_parts, 0.5, "ip|host|server|address|login|client"),
    Kind("card", CARD, lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), _luhn, 0.6, "card|credit|debit|visa|mastercard|amex|pay|paid"),
    Kind("phone", PHONE, lambda t: t.contains("+"), _phone_digits, 0.6, "phone|tel|telephone|call|mobile|cell|fax|sms|whatsapp"),
)
MORE_KINDS = (
    Kind("iban", IBAN, lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), _iban, 0.7, "iban|account|bank|transfer|konto|compte|cuenta", trim=_iban_part),
    Kind("ssn", NUMBER, lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"), _ssn, 0.3, "ssn|social security|social-security|tax id"),
    Kind("routing", NUMBER, lambda t: t.rlike("[0-9]{9}"), _routing, 0.3, "routing|aba|transit|rtn"),
    Kind("birth", NUMBER, lambda t: t.rlike("[0-9]{4}-[0-9]{2}-[0-9]{2}"), _birth, 0.3,
         "born|birth|birthday|birthdate|dob|geboren|geburtsdatum|nacido|nacida|née?"),
)
KINDS = BASE_KINDS + MORE_KINDS

_SPAN = "array<struct<start:int,kind_no:int,end:int,score:double>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lengths: Column) -> Column:
    """Inclusive running sums of an array of integers: sums within blocks, on top of the blocks before."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda acc, x: acc + x)

    def with_blocks(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(v.a) - 1, F.lit(_BLOCK))
        sums = F.transform(starts, lambda s: total(F.slice(v.a, s + 1, F.lit(_BLOCK))))
        return _let(F.struct(v.a.alias("a"), sums.alias("sums")), from_blocks)

    def from_blocks(v: Column) -> Column:
        before = F.transform(v.sums, lambda x, i: total(F.slice(v.sums, F.lit(1), i)))
        return _let(F.struct(v.a.alias("a"), before.alias("before")), lambda w: F.transform(
            w.a, lambda x, i: w.before[(i / _BLOCK).cast("int")] + total(F.slice(w.a, i - i % _BLOCK + 1, i % _BLOCK + 1))))

    return _let(F.struct(lengths.alias("a")), with_blocks)


def _proposals(text: Column, pattern: str, keep: Callable[[Column, Column, Column, Column], Column]) -> Column:
    """Concatenated ``keep(start, match, before, after)`` of all leftmost non-overlapping matches."""
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)

    def placed(v: Column) -> Column:
        n = F.size(v.found)
        ends = _running(F.zip_with(v.found, F.slice(v.pieces, F.lit(1), n), lambda m, g: F.length(m) + F.length(g)))
        return _let(F.struct(v.found.alias("found"), v.pieces.alias("pieces"), ends.alias("ends")), lambda w: F.flatten(F.transform(
            w.found, lambda m, i: keep(w.ends[i] - F.length(m), m, around(w, i)[0], around(w, i)[1]))))

    def around(w: Column, i: Column) -> tuple[Column, Column]:
        """The text before and after match i, up to the nearest character of the matches next to it."""
        left = F.coalesce(F.substring(F.get(w.found, i - 1), -1, 1), F.lit(""))
        right = F.coalesce(F.substring(F.get(w.found, i + 1), 1, 1), F.lit(""))
        return F.substring(F.concat(left, w.pieces[i]), -BEFORE, BEFORE), F.substring(F.concat(w.pieces[i + 1], right), 1, AFTER)

    return _let(F.struct(found.alias("found"), pieces.alias("pieces")),
                lambda v: F.when(F.size(v.found) > 0, placed(v)).otherwise(F.array().cast(_SPAN)))


def _spans_of(text: Column, pattern: str, kinds: list[tuple[int, Kind]]) -> Column:
    """Spans of the kinds that share ``pattern``."""
    def keep(start: Column, m: Column, before: Column, after: Column) -> Column:
        out = F.array().cast(_SPAN)
        near = F.concat(F.lit(" "), F.lower(before), F.lit(" \n "), F.lower(after), F.lit(" "))
        for number, kind in kinds:
            part = kind.trim(m) if kind.trim else m
            score = F.lit(kind.score) + F.when(near.rlike(f"[^a-z](?:{kind.context})[^a-z]"), F.lit(kind.bonus)).otherwise(F.lit(0.0))
            span = F.array(F.struct(start.cast("int").alias("start"), F.lit(number).alias("kind_no"),
                                    (start + F.length(part)).cast("int").alias("end"), F.round(score, 2).alias("score")))
            out = F.when(kind.valid(m, before, after) & (score >= THRESHOLD), span).otherwise(out)
        return out

    present = F.lit(False)
    for _, kind in kinds:
        present = present | kind.present(text)
    return F.when(present, _proposals(text, pattern, keep)).otherwise(F.array().cast(_SPAN))


def find_pii(docs: DataFrame, text: str = "text", kinds: tuple = KINDS) -> tuple[DataFrame, str]:
    """``docs`` with a column of its spans, array<struct<start, kind_no, end, score>> sorted by start, then kind; and its name."""
    by_pattern: dict[str, list] = {}
    for number, kind in enumerate(kinds):
        by_pattern.setdefault(kind.pattern, []).append((number, kind))
    t = whole_text(F.col(text))
    spans = F.concat(*[_spans_of(t, pattern, group) for pattern, group in by_pattern.items()])
    name = fresh(docs, "pii")
    return docs.withColumn(name, F.sort_array(spans)), name


def redacted(docs: DataFrame, text: str = "text", kinds: tuple = KINDS) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in angle brackets; of overlapping spans the first, longest wins."""
    found, name = find_pii(docs, text, kinds)
    t, labels = F.col(text), F.array(*[F.lit(f"<{k.name.upper()}>") for k in kinds])

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(acc.out, F.array(F.concat(F.substring(t, acc.upto + 1, s.start - acc.upto), F.element_at(labels, s.kind_no + 1))))
        return F.when(s.start >= acc.upto, F.struct(s.end.alias("upto"), piece.alias("out"))).otherwise(acc)

    ordered = F.array_sort(F.col(name), lambda a, b: F.when(a.start != b.start, a.start - b.start)
                           .when(a.end != b.end, b.end - a.end).otherwise(a.kind_no - b.kind_no))
    start = F.struct(F.lit(0).alias("upto"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate(ordered, start, step, lambda acc: F.concat(F.array_join(acc.out, ""), F.substring(t, acc.upto + 1, F.length(t))))
    return found.withColumn(text, F.when(F.size(name) > 0, clean).otherwise(t)).drop(name)


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores of every row of ``docs``."""
    found, name = find_pii(docs.select("doc_id", "text"))
    names = F.array(*[F.lit(k.name) for k in KINDS])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.kind_no + 1), s.start, s.end)), ",")

    pii = F.col(name)
    base = F.filter(pii, lambda s: s.kind_no < len(BASE_KINDS))

    def count(k: int) -> Column:
        return F.size(F.filter(pii, lambda s: s.kind_no == k)).cast("long").alias(f"n_{BASE_KINDS[k].name}")

    return found.select("doc_id", *[count(k) for k in range(len(BASE_KINDS))], F.sha2(listed(base), 256).alias("base_sha256"), listed(pii).alias("spans"),
                        F.array_join(F.transform(pii, lambda s: s.score.cast("string")), ",").alias("scores"))
