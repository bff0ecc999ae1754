"""DuckDB SQL for the registered queries, where SQL can express them.

op2, op3 and op6 end in a trained model; op4, op8 and op10 in hashes, rankings
or optimal boundaries that DuckDB lacks; op9 needs XXH64; op13 eigenvectors.
Those are tested against brute force in tests/llm.
"""

from __future__ import annotations

from .pii import AFTER, BASE_KINDS, BEFORE, IBAN, IBAN_LENGTHS, KINDS, PHONE, THRESHOLD
from .secret_scan import BASE_RULES, RULES

_SPACE = r"[\x20\x09-\x0D]"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) AS text_sha256 FROM documents),
     w AS (SELECT doc_id, text_sha256,
                  first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
                  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""

LINE_DEDUP = f"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
     n AS (SELECT doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM l),
     h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM n),
     r AS (SELECT *, (coalesce(lag(h) OVER d, 0) * 1000003 + h) % 2147483647 AS r FROM h WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
     s AS (SELECT *, CASE WHEN i = 1 OR (r < lag(r) OVER d AND r <= coalesce(lead(r) OVER d, r)) THEN 1 ELSE 0 END AS s
           FROM r WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
     c AS (SELECT *, sum(s) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM s),
     k AS (SELECT doc_id, c, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk FROM c GROUP BY doc_id, c),
     f AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, c) AS copy FROM k),
     g AS (SELECT *, copy > 1 AND n >= 2 AND regexp_matches(chunk, '[^\\x20\\x09-\\x0D]') AS gone FROM f)
SELECT doc_id, sum(n)::BIGINT AS n_lines, sum(CASE WHEN gone THEN n ELSE 0 END)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN NOT gone THEN chunk END, chr(10) ORDER BY c), '')) AS text_sha256
FROM g GROUP BY doc_id
"""

PASSAGE_DEDUP = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
     n AS (SELECT doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM l),
     w AS (SELECT doc_id, i, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS pair FROM n),
     a AS (SELECT doc_id, i, row_number() OVER (PARTITION BY pair ORDER BY doc_id, i) > 1
                  AND regexp_matches(pair, '[^\\x20\\x09-\\x0D]') AS again FROM w WHERE pair IS NOT NULL),
     g AS (SELECT n.doc_id, n.i, n.line, coalesce(x.again, false) OR coalesce(y.again, false) AS gone FROM n
           LEFT JOIN a x ON x.doc_id = n.doc_id AND x.i = n.i LEFT JOIN a y ON y.doc_id = n.doc_id AND y.i = n.i - 1)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(CASE WHEN gone THEN 1 ELSE 0 END)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY i), '')) AS text_sha256
FROM g GROUP BY doc_id
"""


def _secret_scan() -> str:
    parts = []
    for k, r in enumerate(RULES):
        p = _quoted(r.pattern)
        parts.append(f"""
SELECT doc_id, {k} AS k, '{r.kind}' AS kind, {r.least} AS least, generate_subscripts(m, 1) AS i, unnest(m) AS m, unnest(t) AS t, p
FROM (SELECT doc_id, regexp_extract_all(text, {p}) AS m, regexp_extract_all(text, {p}, {r.group}) AS t,
             string_split_regex(text, {p}) AS p FROM documents WHERE regexp_matches(text, {p}))""")
    counts = ", ".join(f"count(*) FILTER (k = {k})::BIGINT AS n_{r.kind}" for k, r in enumerate(BASE_RULES))
    return f"""
WITH hit AS ({' UNION ALL '.join(parts)}),
     pos AS (SELECT *, sum(length(p[i]) + length(m)) OVER (PARTITION BY doc_id, k ORDER BY i) AS e FROM hit),
     span AS (SELECT doc_id, k, e - length(m) AS s, kind || ':' || (e - length(m)) || ':' || e AS x FROM pos WHERE length(t) >= least),
     doc AS (SELECT doc_id, {counts}, string_agg(x, ',' ORDER BY s, k) FILTER (k < {len(BASE_RULES)}) AS base,
                    string_agg(x, ',' ORDER BY s, k) AS spans FROM span GROUP BY doc_id)
SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN doc USING (doc_id)
"""


# The contract's and this library's patterns as plain regular expressions, by kind.
_PII_NUMBER = "[0-9]+(-[0-9]+)*"
_PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9]){11,}", "phone": PHONE, "iban": IBAN, "ssn": _PII_NUMBER, "routing": _PII_NUMBER, "birth": _PII_NUMBER,
}
_PII_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_PII_ALONE = "NOT regexp_matches(b, '[A-Za-z0-9+.]$')"
_PII_LUHN = f"""length({_PII_DIGITS}) BETWEEN 12 AND 19 AND list_sum([CASE WHEN (length({_PII_DIGITS}) - i) % 2 = 0 THEN x::INT
    WHEN 2 * x::INT > 9 THEN 2 * x::INT - 9 ELSE 2 * x::INT END for x, i in string_split({_PII_DIGITS}, '')]) % 10 = 0"""
_PII_LENGTH = f"coalesce(MAP {{{', '.join(f"'{c}': {n}" for c, n in IBAN_LENGTHS.items())}}}[left(m, 2)], 0)"
_PII_BODY = f"CASE WHEN length(replace(m, ' ', '')) = {_PII_LENGTH} THEN m ELSE regexp_replace(m, ' [A-Z0-9]*$', '') END"
_PII_TURNED = f"(substr(replace({_PII_BODY}, ' ', ''), 5) || left(m, 4))"
_PII_AS_DIGITS = f"array_to_string([CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE (ascii(c) - 55)::VARCHAR END for c in string_split({_PII_TURNED}, '')], '')"
_PII_VALID = {
    "email": "true",
    "ip": "len([x for x in string_split(m, '.') if length(ltrim(x, '0')) > 3 OR right(x, 3)::INT > 255]) = 0",
    "card": _PII_LUHN,
    "phone": f"length({_PII_DIGITS}) BETWEEN 9 AND 15",
    "iban": f"""NOT regexp_matches(b, '[A-Za-z0-9]$') AND (NOT regexp_matches(a, '^[A-Za-z0-9]') OR length({_PII_BODY}) < length(m))
        AND length(replace({_PII_BODY}, ' ', '')) = {_PII_LENGTH}
        AND ((left({_PII_AS_DIGITS}, 20)::HUGEINT % 97)::VARCHAR || substr({_PII_AS_DIGITS}, 21))::HUGEINT % 97 = 1""",
    "ssn": f"regexp_matches(m, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$') AND NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$') AND {_PII_ALONE}",
    "routing": f"""regexp_matches(m, '^[0-9]{{9}}$') AND m <> '000000000' AND {_PII_ALONE}
        AND list_sum([x::INT * [3, 7, 1][(i - 1) % 3 + 1] for x, i in string_split(CASE WHEN regexp_matches(m, '^[0-9]{{9}}$') THEN m ELSE '0' END, '')]) % 10 = 0""",
    "birth": f"regexp_matches(m, '^(19|20)[0-9]{{2}}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$') AND {_PII_ALONE}",
}


def _pii() -> str:
    parts = []
    for k, kind in enumerate(KINDS):
        p = _quoted(_PII_PATTERNS[kind.name])
        part = _PII_BODY if kind.trim else "m"
        parts.append(f"""
SELECT doc_id, {k} AS k, '{kind.name}' AS kind, s, s + length({part}) AS e,
       round({kind.score} + CASE WHEN regexp_matches(' ' || lower(b) || chr(32) || chr(10) || chr(32) || lower(a) || ' ', {_quoted(f'[^a-z](?:{kind.context})[^a-z]')})
                            THEN {kind.bonus} ELSE 0 END, 2) AS score
FROM (SELECT doc_id, m, right(coalesce(right(ms[i - 1], 1), '') || p[i], {BEFORE}) AS b,
             left(p[i + 1] || coalesce(left(ms[i + 1], 1), ''), {AFTER}) AS a,
             sum(length(p[i]) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS s
      FROM (SELECT doc_id, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, ms, p
            FROM (SELECT doc_id, regexp_extract_all(text, {p}) AS ms, string_split_regex(text, {p}) AS p
                  FROM documents WHERE regexp_matches(text, {p}))))
WHERE {_PII_VALID[kind.name]}""")
    counts = ", ".join(f"count(*) FILTER (k = {k})::BIGINT AS n_{kind.name}" for k, kind in enumerate(BASE_KINDS))
    return f"""
WITH span AS (SELECT *, kind || ':' || s || ':' || e AS x FROM ({' UNION ALL '.join(parts)}) WHERE score >= {THRESHOLD}),
     doc AS (SELECT doc_id, {counts}, string_agg(x, ',' ORDER BY s, k) FILTER (k < {len(BASE_KINDS)}) AS base,
                    string_agg(x, ',' ORDER BY s, k) AS spans, string_agg(score::DOUBLE::VARCHAR, ',' ORDER BY s, k) AS scores
             FROM span GROUP BY doc_id)
SELECT doc_id, {', '.join(f'coalesce(n_{kind.name}, 0) AS n_{kind.name}' for kind in BASE_KINDS)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM documents LEFT JOIN doc USING (doc_id)
"""


def _clustering(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS MATERIALIZED (SELECT rid, j, sum((e.x - c.y) * (e.x - c.y)) AS d FROM e JOIN c{r} c USING (i) GROUP BY rid, j),
a{r} AS MATERIALIZED (SELECT rid, j, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, j) = 1)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT j, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN e USING (rid) GROUP BY j, i),
c{r + 1} AS MATERIALIZED (SELECT j, i, CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS y
                          FROM c{r} LEFT JOIN m{r} USING (j, i))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, [floor(64 * c::DOUBLE)::BIGINT for c in embedding] AS xs
                        FROM embeddings WHERE len(embedding) = {dims}
                          AND len([c for c in embedding if c IS NOT NULL AND isfinite(c)]) = {dims}),
e AS MATERIALIZED (SELECT rid, generate_subscripts(xs, 1) AS i, unnest(xs) AS x FROM v),
f AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), xs) - 1 AS j, xs FROM v
                   QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), xs) <= {k}),
c0 AS MATERIALIZED (SELECT j, generate_subscripts(xs, 1) AS i, unnest(xs) AS y FROM f),{','.join(steps)},
s AS (SELECT j, sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j)
SELECT vec_id, a.j::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN s ON s.j = a.j
"""


ORACLE: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op1_passage_dedup": PASSAGE_DEDUP,
    "op5_exact_dedup": EXACT_DEDUP,
    "op7_secret_scan": _secret_scan(),
    "op11_centroid_clustering": _clustering(),
    "op12_pii": _pii(),
}
