"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

The standard frames are rebuilt as CTEs from the pre-registered table views.
"""

from __future__ import annotations

P_CTE = """P AS (
  SELECT p_partkey AS id, p_brand AS nbhd,
         CASE WHEN p_partkey % 7 = 3 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS front,
         CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS semcat,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS gencat,
         p_size AS size, p_retailprice AS y
  FROM part)"""

C_CTE = """ordstats AS (SELECT o_custkey, count(*) AS x1, sum(o_totalprice) AS spend FROM orders GROUP BY o_custkey),
C AS (
  SELECT c_custkey AS id, CAST(ordstats.x1 AS DOUBLE) AS x1, c_acctbal AS x2, c_mktsegment AS seg,
         c_nationkey AS nat, ln(1 + ordstats.spend) AS y
  FROM customer JOIN ordstats ON c_custkey = ordstats.o_custkey)"""

L_CTE = """L AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS q,
         CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_tax END AS t
  FROM lineitem)"""

LC_CTE = """LC AS (
  SELECT *, l_quantity + CAST((l_linenumber - 4) * 2 AS DOUBLE) AS qty_copy FROM lineitem)"""

ORACLE: dict[str, str] = {}


def _missing_sql(src: str, cols: list[str], only_missing: bool) -> str:
    aggs = ", ".join(f"avg(CASE WHEN {c} IS NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100 AS {c}"
                     for c in cols)
    unions = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS pct FROM m" for c in cols)
    where = "WHERE pct > 0" if only_missing else ""
    return f"m AS (SELECT {aggs} FROM {src}), r AS ({unions}) SELECT \"column\", round(pct, 6) AS pct_missing FROM r {where}"


ORACLE["csv_roundtrip"] = f"WITH {P_CTE} SELECT * FROM P"
ORACLE["json_report"] = (f"WITH {P_CTE}, "
                         + _missing_sql("P", ["id", "nbhd", "front", "semcat", "gencat", "size", "y"], False))
ORACLE["preview_head"] = f"WITH {P_CTE} SELECT * FROM P ORDER BY id LIMIT 5"
ORACLE["shape_report"] = (f"WITH {P_CTE} SELECT 'P' AS \"table\", count(*) AS n_rows, CAST(7 AS BIGINT) AS n_cols FROM P")
ORACLE["outlier_filter"] = (f"WITH {P_CTE} SELECT id, front, y FROM P "
                            "WHERE NOT coalesce(front > 45 AND y < 950, false)")
ORACLE["predicate_count"] = ("SELECT count(*) FILTER (WHERE l_quantity > 40 AND l_discount < CAST(0.03 AS DOUBLE)) "
                             "AS n_rows FROM lineitem")
ORACLE["eq_filter_drop"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders "
                            "WHERE o_orderstatus = 'F'")
ORACLE["select_by_type"] = "SELECT p_partkey, p_brand, p_type FROM part"
ORACLE["cast_code"] = f"WITH {P_CTE} SELECT id, CAST(size AS VARCHAR) AS size_code FROM P"

ORACLE["group_median_fill"] = f"""WITH {P_CTE},
g AS (SELECT nbhd, median(front) AS gm FROM P GROUP BY nbhd),
o AS (SELECT median(front) AS om FROM P)
SELECT P.id, P.nbhd, round(coalesce(P.front, g.gm, o.om), 6) AS front
FROM P LEFT JOIN g ON P.nbhd = g.nbhd, o"""

ORACLE["mode_fill"] = f"""WITH {P_CTE},
gc AS (SELECT gencat AS v, count(*) AS n FROM P WHERE gencat IS NOT NULL GROUP BY gencat),
gm AS (SELECT v FROM gc ORDER BY n DESC, v ASC LIMIT 1),
fc AS (SELECT front AS v, count(*) AS n FROM P WHERE front IS NOT NULL GROUP BY front),
fm AS (SELECT v FROM fc ORDER BY n DESC, v ASC LIMIT 1)
SELECT id, coalesce(gencat, (SELECT v FROM gm)) AS gencat, coalesce(front, (SELECT v FROM fm)) AS front FROM P"""

ORACLE["role_impute"] = f"""WITH {P_CTE},
gc AS (SELECT gencat AS v, count(*) AS n FROM P WHERE gencat IS NOT NULL GROUP BY gencat),
gm AS (SELECT v FROM gc ORDER BY n DESC, v ASC LIMIT 1)
SELECT id, coalesce(nbhd, 'None') AS nbhd, coalesce(semcat, 'None') AS semcat,
       coalesce(gencat, (SELECT v FROM gm)) AS gencat, coalesce(front, CAST(0 AS DOUBLE)) AS front, y FROM P"""

ORACLE["ordinal_map"] = f"""WITH {P_CTE}
SELECT id, CAST(CASE gencat WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 WHEN 'MEDIUM' THEN 3
                          WHEN 'LARGE' THEN 4 WHEN 'PROMO' THEN 5 ELSE 0 END AS DOUBLE) AS type_code FROM P"""

ORACLE["derived_features"] = f"""WITH {L_CTE}
SELECT l_orderkey, l_linenumber,
  round(coalesce(q, 0) + coalesce(t, 0) + coalesce(l_discount, 0), 6) AS total,
  round(coalesce(q, 0) + coalesce(t, 0) * CAST(0.5 AS DOUBLE) + coalesce(l_discount, 0) * CAST(0.5 AS DOUBLE), 6) AS weighted,
  round(l_linenumber - q, 6) AS line_gap,
  CAST(coalesce(CAST(q > 0 AS INTEGER), 0) AS INTEGER) AS has_q,
  CAST(coalesce(CAST(t > 0 AS INTEGER), 0) AS INTEGER) AS has_t,
  CAST(coalesce(CAST(l_discount > 0 AS INTEGER), 0) AS INTEGER) AS has_disc
FROM L"""

ORACLE["label_log1p_expm1"] = """SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS label,
  round(exp(ln(1 + o_totalprice)) - 1, 2) AS price_back FROM orders"""

ORACLE["scalar_math"] = """SELECT l_orderkey, l_linenumber, round(sqrt(l_extendedprice), 6) AS sqrt_price,
  round(pow(l_quantity, 2), 6) AS qty_sq, round(abs(l_extendedprice - CAST(50000 AS DOUBLE)), 6) AS abs_dev,
  (l_quantity > 25 AND abs(l_extendedprice - CAST(50000 AS DOUBLE)) < 20000) AS flag FROM lineitem"""

ORACLE["bround_codes"] = """SELECT l_orderkey, l_linenumber,
  round_even(l_quantity / CAST(2 AS DOUBLE), 0) AS half_code FROM lineitem"""

ORACLE["target_summary"] = """SELECT 'l_extendedprice' AS "column", count(l_extendedprice) AS n,
  round(skewness(l_extendedprice), 6) AS skew, round(min(l_extendedprice), 6) AS min,
  round(max(l_extendedprice), 6) AS max, round(avg(l_extendedprice), 6) AS mean,
  round(median(l_extendedprice), 6) AS median FROM lineitem"""


def _skew_sql(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", round(skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1)), 6)"
            f" AS skew FROM lineitem")


ORACLE["skew_all"] = ("WITH s AS (" + " UNION ALL ".join(
    _skew_sql(c) for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"])
    + ") SELECT \"column\", skew, coalesce(abs(skew) > CAST(0.75 AS DOUBLE), false) AS is_skewed FROM s")

ORACLE["missing_report"] = (f"WITH {P_CTE}, U AS (SELECT id, nbhd, front, semcat, gencat, size FROM P WHERE size <= 25 "
                            "UNION ALL SELECT id, nbhd, front, semcat, gencat, size FROM P WHERE size > 25), "
                            + _missing_sql("U", ["id", "nbhd", "front", "semcat", "gencat", "size"], True))

ORACLE["corr_target"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, l_extendedprice), 6) AS corr FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax", "l_linenumber"]) + ")"

_PAIR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "qty_copy"]
_PAIRS = [(a, b) for i, a in enumerate(_PAIR_COLS) for b in _PAIR_COLS[i + 1:]]
_PAIRS_SQL = (f"WITH {LC_CTE}, pr AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, abs(corr({a}, {b})) AS abs_corr FROM LC" for a, b in _PAIRS) + ")")

ORACLE["corr_pairs"] = _PAIRS_SQL + " SELECT col_a, col_b, round(abs_corr, 6) AS abs_corr FROM pr WHERE abs_corr > CAST(0.8 AS DOUBLE)"
ORACLE["collinear_columns"] = (_PAIRS_SQL + " SELECT col_b AS \"column\", count(*) AS n_pairs, round(max(abs_corr), 6) AS max_abs_corr "
                               "FROM pr WHERE abs_corr > CAST(0.8 AS DOUBLE) GROUP BY col_b")
ORACLE["heatmap_data"] = _PAIRS_SQL + " SELECT col_a, col_b, round(abs_corr, 6) AS abs_corr FROM pr"
ORACLE["top5_corr"] = (f"WITH {LC_CTE}, c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", corr({c}, l_extendedprice) AS corr FROM LC"
    for c in ["l_quantity", "l_discount", "l_tax", "qty_copy", "l_linenumber"])
    + ") SELECT \"column\", round(corr, 6) AS corr FROM c ORDER BY corr DESC LIMIT 5")

ORACLE["z_outliers"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE abs(({c} - m) / s) > CAST(1.5 AS DOUBLE)) AS n_outliers "
    f"FROM lineitem, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM lineitem)"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]) + ")"

ORACLE["quartiles"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, CAST({p} AS DOUBLE)), 6) AS value FROM lineitem"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"] for p in ("0.25", "0.5", "0.75")) + ")"

ORACLE["low_variance"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_distinct, round(CAST(max(n) AS DOUBLE) / sum(n), 6) AS top_share "
    f"FROM (SELECT {c} AS v, count(*) AS n FROM lineitem GROUP BY {c})"
    for c in ["l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_linenumber"]) + ")"


def _hist_sql(series: str, expr: str, bins: int = 50, table: str = "orders") -> str:
    return (f"SELECT '{series}' AS series, g.bin, round(s.lo + g.bin * s.w, 6) AS lo, round(s.lo + (g.bin + 1) * s.w, 6) AS hi, "
            f"coalesce(c.n, 0) AS n FROM (SELECT CAST(i AS INTEGER) AS bin FROM range(0, {bins}) t(i)) g "
            f"CROSS JOIN (SELECT CAST(min({expr}) AS DOUBLE) AS lo, CAST(max({expr}) - min({expr}) AS DOUBLE) / {bins} AS w FROM {table}) s "
            f"LEFT JOIN (SELECT least(CAST(floor(({expr} - lo) / w) AS INTEGER), {bins - 1}) AS bin, count(*) AS n FROM {table}, "
            f"(SELECT CAST(min({expr}) AS DOUBLE) AS lo, CAST(max({expr}) - min({expr}) AS DOUBLE) / {bins} AS w FROM {table}) GROUP BY 1) c "
            f"ON c.bin = g.bin")


ORACLE["hist_target"] = ("SELECT * FROM (" + _hist_sql("o_totalprice", "o_totalprice") + " UNION ALL "
                         + _hist_sql("log_price", "ln(1 + o_totalprice)") + ")")
ORACLE["hist_gaps"] = _hist_sql("l_quantity", "l_quantity", 120, "lineitem")

ORACLE["kde_grid"] = """WITH v AS (SELECT ln(1 + o_totalprice) AS x FROM orders),
st AS (SELECT count(x) AS n, stddev_samp(x) * pow(count(x), CAST(-0.2 AS DOUBLE)) AS h, min(x) AS lo, max(x) AS hi FROM v),
gr AS (SELECT i, lo - 3 * h AS glo, (hi + 3 * h - (lo - 3 * h)) / 199 AS step, h, n FROM st, range(0, 200) t(i))
SELECT CAST(i AS INTEGER) AS grid_idx, round(glo + i * step, 6) AS x,
  round(sum(exp(-0.5 * ((glo + i * step - v.x) / h) * ((glo + i * step - v.x) / h))) * (1 / (n * h * sqrt(2 * pi()))), 8) AS density
FROM gr, v GROUP BY i, glo, step, h, n"""

ORACLE["scatter_extract"] = "SELECT o_orderkey, o_totalprice, o_custkey FROM orders"

ORACLE["scatter_bins"] = """SELECT least(CAST(floor((CAST(l_quantity AS DOUBLE) - x0) / xw) AS INTEGER), 49) AS x_bin,
  least(CAST(floor((CAST(l_extendedprice AS DOUBLE) - y0) / yw) AS INTEGER), 49) AS y_bin, count(*) AS n
FROM lineitem, (SELECT CAST(min(l_quantity) AS DOUBLE) AS x0, CAST(max(l_quantity) - min(l_quantity) AS DOUBLE) / 50 AS xw,
  CAST(min(l_extendedprice) AS DOUBLE) AS y0, CAST(max(l_extendedprice) - min(l_extendedprice) AS DOUBLE) / 50 AS yw FROM lineitem)
GROUP BY 1, 2"""


# ------------------------------------------------------------------ encoders

ORACLE["category_codes"] = f"""WITH {P_CTE},
f AS (SELECT gencat AS value, min(id) AS first FROM P WHERE gencat IS NOT NULL GROUP BY gencat)
SELECT value, CAST(row_number() OVER (ORDER BY first, value) - 1 AS INTEGER) AS code FROM f"""


def _robust_sql() -> str:
    cols = ["y", "front", "z"]
    qs = ", ".join(f"quantile_cont({c}, CAST(0.25 AS DOUBLE)) AS {c}_25, quantile_cont({c}, CAST(0.5 AS DOUBLE)) AS {c}_50, "
                   f"quantile_cont({c}, CAST(0.75 AS DOUBLE)) AS {c}_75" for c in cols)
    outs = ", ".join(f"round(({c} - {c}_50) / (CASE WHEN abs({c}_75 - {c}_25) > 1e-15 THEN {c}_75 - {c}_25 "
                     f"ELSE CAST(1 AS DOUBLE) END), 6) AS {c}_s" for c in cols)
    return (f"WITH {P_CTE}, PZ AS (SELECT *, CAST(CASE WHEN size > 45 THEN size ELSE 0 END AS DOUBLE) AS z FROM P), "
            f"Q AS (SELECT {qs} FROM PZ) SELECT id, {outs} FROM PZ, Q")


ORACLE["robust_scale"] = _robust_sql()

ORACLE["one_hot"] = f"""WITH {C_CTE}
SELECT id, {", ".join(f"CASE WHEN seg = '{v}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS seg_{v}"
                      for v in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"])} FROM C"""

ORACLE["target_encode"] = f"""WITH {C_CTE},
pr AS (SELECT avg(y) AS prior FROM C),
st AS (SELECT nat, count(*) AS n, avg(y) AS m FROM C GROUP BY nat),
en AS (SELECT nat, CASE WHEN n = 1 THEN prior
   ELSE prior * (1 - 1 / (1 + exp(-(n - 20) / CAST(10 AS DOUBLE)))) + m * (1 / (1 + exp(-(n - 20) / CAST(10 AS DOUBLE)))) END AS e
   FROM st, pr)
SELECT C.id, round(coalesce(en.e, pr.prior), 6) AS nat_te FROM C LEFT JOIN en ON C.nat = en.nat, pr"""


def _yj(x: str, lam: str) -> str:
    return (f"CASE WHEN {x} >= 0 THEN (CASE WHEN abs({lam}) < 1e-12 THEN ln(1 + {x}) "
            f"ELSE (pow({x} + 1, {lam}) - 1) / {lam} END) "
            f"ELSE (CASE WHEN abs({lam} - 2) < 1e-12 THEN -ln(1 - {x}) "
            f"ELSE -(pow(1 - {x}, 2 - {lam}) - 1) / (2 - {lam}) END) END")


ORACLE["yeo_johnson"] = f"""WITH {C_CTE},
X AS (SELECT id, x2 / CAST(1000 AS DOUBLE) AS x FROM C),
G1 AS (SELECT CAST(k AS DOUBLE) / 10 AS lam FROM range(-50, 51) t(k)),
L1 AS (SELECT lam, -CAST(count(*) AS DOUBLE) / 2 * ln(var_pop({_yj("x", "lam")}))
              + (lam - 1) * sum(sign(x) * ln(1 + abs(x))) AS ll FROM X, G1 GROUP BY lam),
B1 AS (SELECT arg_max(lam, ll) AS lam1 FROM L1),
G2 AS (SELECT lam1 + CAST(j - 100 AS DOUBLE) / 1000 AS lam FROM B1, range(0, 201) t(j)),
L2 AS (SELECT lam, -CAST(count(*) AS DOUBLE) / 2 * ln(var_pop({_yj("x", "lam")}))
              + (lam - 1) * sum(sign(x) * ln(1 + abs(x))) AS ll FROM X, G2 GROUP BY lam),
B2 AS (SELECT arg_max(lam, ll) AS lam2 FROM L2),
T AS (SELECT id, {_yj("x", "lam2")} AS t, lam2 FROM X, B2),
TS AS (SELECT avg(t) AS m, stddev_pop(t) AS sd FROM T)
SELECT id, round((t - m) / sd, 6) AS xb_yj, round(lam2, 6) AS lam FROM T, TS"""


def _knn_target_sql(name: str, target: str, cols: list[str]) -> str:
    both = lambda c: f"q.{c} IS NOT NULL AND dn.{c} IS NOT NULL"
    present = " + ".join(f"(CASE WHEN {both(c)} THEN 1 ELSE 0 END)" for c in cols)
    ss = " + ".join(f"(CASE WHEN {both(c)} THEN (q.{c} - dn.{c}) * (q.{c} - dn.{c}) ELSE CAST(0 AS DOUBLE) END)" for c in cols)
    return f"""PR_{name} AS (SELECT q.id AS qid, dn.id AS did, dn.{target} AS val, {present} AS present, {ss} AS ss
   FROM E q, E dn WHERE q.{target} IS NULL AND dn.{target} IS NOT NULL),
D_{name} AS (SELECT qid, did, val, CAST({len(cols)} AS DOUBLE) / present * ss AS d2 FROM PR_{name} WHERE present > 0),
R_{name} AS (SELECT qid, val, row_number() OVER (PARTITION BY qid ORDER BY d2, did) AS rn FROM D_{name}),
I_{name} AS (SELECT qid, avg(val) AS m FROM R_{name} WHERE rn <= 5 GROUP BY qid)"""


ORACLE["knn_impute"] = f"""WITH {P_CTE},
NC AS (SELECT value, row_number() OVER (ORDER BY first, value) - 1 AS code
       FROM (SELECT nbhd AS value, min(id) AS first FROM P WHERE nbhd IS NOT NULL GROUP BY nbhd)),
GC AS (SELECT value, row_number() OVER (ORDER BY first, value) - 1 AS code
       FROM (SELECT gencat AS value, min(id) AS first FROM P WHERE gencat IS NOT NULL GROUP BY gencat)),
E AS (SELECT P.id, CAST(NC.code AS DOUBLE) AS a, CAST(GC.code AS DOUBLE) AS b, P.front AS c, P.y AS d, P.gencat, P.front
      FROM P LEFT JOIN NC ON P.nbhd = NC.value LEFT JOIN GC ON P.gencat = GC.value),
{_knn_target_sql("g", "b", ["a", "b", "c", "d"])},
{_knn_target_sql("f", "c", ["a", "b", "c", "d"])}
SELECT E.id, coalesce(E.gencat, GC2.value) AS gencat, round(coalesce(E.front, I_f.m), 6) AS front
FROM E LEFT JOIN I_g ON E.id = I_g.qid
       LEFT JOIN GC GC2 ON GC2.code = CAST(round_even(I_g.m, 0) AS BIGINT)
       LEFT JOIN I_f ON E.id = I_f.qid"""


K_CTE = """LS AS (SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS sum_qty, max(l_quantity) AS max_qty, min(l_quantity) AS min_qty,
  CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS n_r, CAST(count(*) FILTER (l_returnflag = 'A') AS DOUBLE) AS n_a,
  CAST(max(l_linenumber) AS DOUBLE) AS max_line, CAST(count(*) FILTER (l_discount = 0) AS DOUBLE) AS n_plain FROM lineitem GROUP BY l_orderkey),
OS AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n_orders, CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) AS n_urgent,
  CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) AS n_f, CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) AS n_o,
  sum(n_lines) AS n_lines, sum(sum_qty) AS sum_qty, max(max_qty) AS max_qty, min(min_qty) AS min_qty, sum(n_r) AS n_r, sum(n_a) AS n_a,
  max(max_line) AS max_line, sum(n_plain) AS n_plain FROM orders JOIN LS ON o_orderkey = l_orderkey GROUP BY o_custkey),
K AS (SELECT c_custkey AS id, OS.* EXCLUDE (o_custkey), CAST(c_nationkey AS DOUBLE) AS nat,
  CASE WHEN c_custkey % 9 = 4 THEN NULL ELSE c_acctbal END AS acct, CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE c_mktsegment END AS seg
  FROM customer JOIN OS ON c_custkey = o_custkey)"""


def _knn_wide_sql() -> str:
    from tabforge.sources.frames import K_COMPLETE
    cols = [*K_COMPLETE, "acct", "code"]
    return f"""WITH {K_CTE},
SC AS (SELECT value, row_number() OVER (ORDER BY first, value) - 1 AS code FROM (SELECT seg AS value, min(id) AS first FROM K WHERE seg IS NOT NULL GROUP BY seg)),
E AS (SELECT K.*, CAST(SC.code AS DOUBLE) AS code FROM K LEFT JOIN SC ON K.seg = SC.value),
{_knn_target_sql("s", "code", cols)},
{_knn_target_sql("a", "acct", cols)}
SELECT E.id, coalesce(E.seg, SC2.value) AS seg, round(coalesce(E.acct, I_a.m), 6) AS acct
FROM E LEFT JOIN I_s ON E.id = I_s.qid LEFT JOIN SC SC2 ON SC2.code = CAST(round_even(I_s.m, 0) AS BIGINT) LEFT JOIN I_a ON E.id = I_a.qid"""


ORACLE["knn_wide"] = _knn_wide_sql()

# One-hot ridge in closed form: n (mean - b0) / (n + alpha), with b0 the mean of the level means weighted n / (n + alpha).
ORACLE["wide_ridge"] = """WITH S AS (SELECT l_partkey, count(*) AS n, avg(ln(1 + l_extendedprice)) AS m FROM lineitem GROUP BY l_partkey),
B AS (SELECT sum(n / (n + CAST(10 AS DOUBLE)) * m) / sum(n / (n + CAST(10 AS DOUBLE))) AS b0 FROM S)
SELECT 'nom__part_' || l_partkey AS feature, round(n / (n + CAST(10 AS DOUBLE)) * (m - b0), 6) AS coef, round(b0, 6) AS intercept FROM S, B"""


# ------------------------------------------------------------------ linear models on frame C

FOLD_SQL = "CAST(((id % 2147483647) * 1103515245 + 42) % 2147483647 % 5 AS INTEGER)"
CF_CTE = f"CF AS (SELECT *, {FOLD_SQL} AS fold FROM C)"
LAB_CTE = "LAB AS (SELECT * FROM C WHERE NOT coalesce(x1 > 20 AND y < CAST(14 AS DOUBLE), false))"
LABF_CTE = f"LABF AS (SELECT *, {FOLD_SQL} AS fold FROM LAB)"


def _ridge_ctes(tag: str, src: str, xs: list[str], alpha: float, by_fold: bool) -> str:
    """CTE {tag}_co(fold?, m_x.., my, b_x..): centred ridge coefficients from raw sums."""
    sums = ["count(*) AS n", "sum(y) AS sy"] + [f"sum({x}) AS s_{x}" for x in xs] + [f"sum({x} * y) AS s_{x}_y" for x in xs]
    sums += [f"sum({a} * {b}) AS s_{a}_{b}" for i, a in enumerate(xs) for b in xs[i:]]
    names = ["n", "sy"] + [f"s_{x}" for x in xs] + [f"s_{x}_y" for x in xs] + [f"s_{a}_{b}" for i, a in enumerate(xs) for b in xs[i:]]
    if by_fold:
        fs = f"{tag}_fs AS (SELECT fold, {', '.join(sums)} FROM {src} GROUP BY fold)"
        ts = f"{tag}_ts AS (SELECT {', '.join(f'sum({n}) AS {n}' for n in names)} FROM {tag}_fs)"
        tr = (f"{tag}_tr AS (SELECT f.fold, {', '.join(f't.{n} - f.{n} AS {n}' for n in names)} "
              f"FROM {tag}_fs f, {tag}_ts t)")
        head, key = f"{fs},\n{ts},\n{tr}", "fold, "
    else:
        head, key = f"{tag}_tr AS (SELECT {', '.join(sums)} FROM {src})", ""
    cen = [f"s_{x} / n AS m_{x}" for x in xs] + ["sy / n AS my"]
    cen += [f"s_{x}_y - s_{x} * sy / n AS c_{x}_y" for x in xs]
    cen += [f"s_{a}_{b} - s_{a} * s_{b} / n AS c_{a}_{b}" for i, a in enumerate(xs) for b in xs[i:]]
    ce = f"{tag}_ce AS (SELECT {key}n, {', '.join(cen)} FROM {tag}_tr)"
    a = f"CAST({alpha!r} AS DOUBLE)"
    if len(xs) == 1:
        x = xs[0]
        coef = f"c_{x}_y / (c_{x}_{x} + {a}) AS b_{x}"
    else:
        x1, x2 = xs
        det = f"((c_{x1}_{x1} + {a}) * (c_{x2}_{x2} + {a}) - c_{x1}_{x2} * c_{x1}_{x2})"
        coef = (f"((c_{x2}_{x2} + {a}) * c_{x1}_y - c_{x1}_{x2} * c_{x2}_y) / {det} AS b_{x1}, "
                f"((c_{x1}_{x1} + {a}) * c_{x2}_y - c_{x1}_{x2} * c_{x1}_y) / {det} AS b_{x2}")
    co = f"{tag}_co AS (SELECT {key}n, my, {', '.join(f'm_{x}' for x in xs)}, {coef} FROM {tag}_ce)"
    return f"{head},\n{ce},\n{co}"


def _pred(tag: str, xs: list[str], row: str = "") -> str:
    r = f"{row}." if row else ""
    return f"({tag}_co.my + " + " + ".join(f"{tag}_co.b_{x} * ({r}{x} - {tag}_co.m_{x})" for x in xs) + ")"


def _oof_sql(tag: str, src: str, xs: list[str], alpha: float = 10.0) -> str:
    return _ridge_ctes(tag, src, xs, alpha, True) + (
        f",\n{tag}_oof AS (SELECT {src}.id, {src}.fold, {src}.y, {_pred(tag, xs, src)} AS p "
        f"FROM {src} JOIN {tag}_co ON {src}.fold = {tag}_co.fold)")


ORACLE["fold_assign"] = f"WITH {C_CTE}, {CF_CTE} SELECT id, fold FROM CF"

ORACLE["flagship_oof"] = (f"WITH {C_CTE}, {LAB_CTE}, {LABF_CTE},\n" + _oof_sql("r", "LABF", ["x1", "x2"])
                          + "\nSELECT id, fold, round(p, 6) AS pred_log, round(exp(p) - 1, 0) AS predicted_spend FROM r_oof")

ORACLE["ridge_fit"] = (f"WITH {C_CTE},\n" + _ridge_ctes("r", "C", ["x1", "x2"], 10.0, False)
                       + "\nSELECT '(intercept)' AS feature, round(my - b_x1 * m_x1 - b_x2 * m_x2, 6) AS coef FROM r_co"
                       " UNION ALL SELECT 'x1', round(b_x1, 6) FROM r_co UNION ALL SELECT 'x2', round(b_x2, 6) FROM r_co")

ORACLE["lasso_fit"] = f"""WITH {C_CTE},
ls AS (SELECT avg(x1) AS m, avg(y) AS my, covar_pop(x1, y) AS c, var_pop(x1) AS g FROM C),
b AS (SELECT sign(c) * greatest(abs(c) - CAST(0.01 AS DOUBLE), 0) / g AS b1, m, my FROM ls)
SELECT '(intercept)' AS feature, round(my - b1 * m, 6) AS coef FROM b UNION ALL SELECT 'x1', round(b1, 6) FROM b"""

ORACLE["cv_scores"] = (f"WITH {C_CTE}, {CF_CTE},\n" + _oof_sql("r", "CF", ["x1"])
                       + "\nSELECT 'ridge_x1' AS model, fold, count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse"
                       " FROM r_oof GROUP BY fold")

ORACLE["oof_predictions"] = (f"WITH {C_CTE}, {CF_CTE},\n" + _oof_sql("r", "CF", ["x1"])
                             + "\nSELECT id, fold, round(y, 6) AS y, round(p, 6) AS oof FROM r_oof")

_TWO = (f"WITH {C_CTE}, {CF_CTE},\n" + _oof_sql("a", "CF", ["x1"]) + ",\n" + _oof_sql("b", "CF", ["x2"])
        + ",\nAB AS (SELECT a_oof.id, a_oof.y, a_oof.p AS p_a, b_oof.p AS p_b FROM a_oof JOIN b_oof ON a_oof.id = b_oof.id)")

ORACLE["average_blend"] = (_TWO + "\nSELECT id, round(p_a, 6) AS p_a, round(p_b, 6) AS p_b, "
                           "round(p_a * CAST(0.5 AS DOUBLE) + p_b * CAST(0.5 AS DOUBLE), 6) AS blend FROM AB")
ORACLE["weighted_blend"] = (_TWO + "\nSELECT id, round(p_a * CAST(0.7 AS DOUBLE) + p_b * CAST(0.3 AS DOUBLE), 6) AS blend FROM AB")
ORACLE["blend_weights"] = (_TWO + """,
W AS (SELECT greatest(least(sum((y - p_b) * (p_a - p_b)) / sum((p_a - p_b) * (p_a - p_b)), 1), 0) AS w FROM AB),
R AS (SELECT sqrt(avg((y - (w * p_a + (1 - w) * p_b)) * (y - (w * p_a + (1 - w) * p_b)))) AS rmse FROM AB, W)
SELECT 'ridge_x1' AS model, round(w, 6) AS weight, round(rmse, 6) AS pooled_rmse FROM W, R
UNION ALL SELECT 'ridge_x2', round(1 - w, 6), round(rmse, 6) FROM W, R""")

ORACLE["ridge_cv_loo"] = f"""WITH {C_CTE},
rs AS (SELECT count(*) AS n, avg(x1) AS m, avg(y) AS my, covar_pop(x1, y) * count(*) AS sxy,
             var_pop(x1) * count(*) AS sxx FROM C),
al AS (SELECT CAST(a AS DOUBLE) AS alpha FROM (VALUES (0.1), (1.0), (10.0), (100.0)) v(a)),
lo AS (SELECT alpha, avg(pow((y - (my + sxy / (sxx + alpha) * (x1 - m)))
                         / (1 - (1 / CAST(n AS DOUBLE) + (x1 - m) * (x1 - m) / (sxx + alpha))), 2)) AS loo
       FROM C, rs, al GROUP BY alpha)
SELECT alpha, round(loo, 8) AS loo_mse, loo = min(loo) OVER () AS chosen FROM lo"""

_SCORES = (f"WITH {C_CTE}, {CF_CTE},\n" + _oof_sql("a", "CF", ["x1"]) + ",\n" + _oof_sql("b", "CF", ["x2"]) + ",\n"
           + _oof_sql("c", "CF", ["x1", "x2"]) + """,
SC AS (SELECT 'ridge_x1' AS model, fold, sqrt(avg((y - p) * (y - p))) AS rmse FROM a_oof GROUP BY fold
       UNION ALL SELECT 'ridge_x2', fold, sqrt(avg((y - p) * (y - p))) FROM b_oof GROUP BY fold
       UNION ALL SELECT 'ridge_x1x2', fold, sqrt(avg((y - p) * (y - p))) FROM c_oof GROUP BY fold),
SM AS (SELECT model, avg(rmse) AS mean_rmse, stddev_pop(rmse) AS std_rmse, count(*) AS n_folds FROM SC GROUP BY model)""")

ORACLE["model_compare"] = (_SCORES + "\nSELECT model, round(mean_rmse, 6) AS mean_rmse, round(std_rmse, 6) AS std_rmse, "
                           "n_folds FROM SM")
ORACLE["keep_if_better"] = (_SCORES + "\nSELECT arg_min(model, mean_rmse) AS best_model, round(min(mean_rmse), 6) AS best_rmse FROM SM")

ORACLE["refit_and_score"] = (f"WITH {C_CTE}, {LAB_CTE},\n" + _ridge_ctes("r", "LAB", ["x1", "x2"], 10.0, False) + """,
U AS (SELECT c_custkey AS id, CAST(coalesce(ordstats.x1, 0) AS DOUBLE) AS x1, c_acctbal AS x2
      FROM customer LEFT JOIN ordstats ON c_custkey = ordstats.o_custkey)
SELECT U.id, round(exp(""" + _pred("r", ["x1", "x2"], "U") + ") - 1, 0) AS predicted_spend FROM U, r_co")


_SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

ORACLE["average_models"] = (f"WITH {C_CTE},\n" + _ridge_ctes("a", "C", ["x1"], 10.0, False) + ",\n"
                            + _ridge_ctes("b", "C", ["x2"], 10.0, False)
                            + "\nSELECT C.id, round(" + _pred("a", ["x1"], "C") + ", 6) AS p_a, round("
                            + _pred("b", ["x2"], "C") + ", 6) AS p_b, round((" + _pred("a", ["x1"], "C") + " + "
                            + _pred("b", ["x2"], "C") + ") / 2, 6) AS blend FROM C, a_co, b_co")

ORACLE["scored_parquet"] = (f"WITH {C_CTE}, {LAB_CTE},\n" + _ridge_ctes("r", "LAB", ["x1", "x2"], 10.0, False) + """,
U AS (SELECT c_custkey AS id, c_mktsegment AS seg, CAST(coalesce(ordstats.x1, 0) AS DOUBLE) AS x1, c_acctbal AS x2
      FROM customer LEFT JOIN ordstats ON c_custkey = ordstats.o_custkey)
SELECT U.id, U.seg, round(exp(""" + _pred("r", ["x1", "x2"], "U") + ") - 1, 0) AS predicted_spend FROM U, r_co")


ORACLE["nested_blend_rmse"] = (_TWO + """,
ABF AS (SELECT AB.*, CF.fold FROM AB JOIN CF ON AB.id = CF.id),
FS AS (SELECT fold, sum((y - p_b) * (p_a - p_b)) AS num, sum((p_a - p_b) * (p_a - p_b)) AS den FROM ABF GROUP BY fold),
TS AS (SELECT sum(num) AS num, sum(den) AS den FROM FS),
W AS (SELECT FS.fold, greatest(least((TS.num - FS.num) / (TS.den - FS.den), 1), 0) AS w FROM FS, TS),
B AS (SELECT ABF.fold, ABF.y, W.w * ABF.p_a + (1 - W.w) * ABF.p_b AS blend, W.w FROM ABF JOIN W ON ABF.fold = W.fold),
P AS (SELECT sqrt(avg((y - blend) * (y - blend))) AS pooled FROM B)
SELECT fold, count(*) AS n, round(sqrt(avg((y - blend) * (y - blend))), 6) AS rmse, round(max(w), 6) AS weight_a,
       round(max(pooled), 6) AS pooled_rmse
FROM B, P GROUP BY fold""")

ORACLE["blend_gate"] = (f"WITH {C_CTE}, {CF_CTE},\n" + _oof_sql("a", "CF", ["x1"]) + ",\n" + _oof_sql("b", "CF", ["x2"])
                        + ",\n" + _oof_sql("c", "CF", ["x1", "x2"]) + """,
J AS (SELECT a_oof.y, a_oof.p AS pa, b_oof.p AS pb, c_oof.p AS pc
      FROM a_oof JOIN b_oof ON a_oof.id = b_oof.id JOIN c_oof ON a_oof.id = c_oof.id),
E AS (SELECT sqrt(avg(pow(y - (pa + pb) / 2, 2))) AS wo, sqrt(avg(pow(y - (pa + pb + pc) / 3, 2))) AS wi FROM J)
SELECT 'ridge_x1x2' AS candidate, round(wo, 6) AS rmse_without, round(wi, 6) AS rmse_with, wi < wo AS kept FROM E""")


def _one_hot_clash_sql() -> str:
    level = ("CASE WHEN o_orderpriority LIKE '1%' THEN CASE WHEN o_orderkey % 2 = 0 THEN replace(o_orderpriority, '-', ' ') "
             "ELSE o_orderpriority END ELSE 'other' END")
    levels = ("1 URGENT", "1-URGENT", "other")
    return (f"SELECT o_orderkey, {', '.join(f'CAST(v = {chr(39)}{x}{chr(39)} AS DOUBLE) AS level_{i}' for i, x in enumerate(levels))} "
            f"FROM (SELECT o_orderkey, {level} AS v FROM orders)")


ORACLE["one_hot_clash"] = _one_hot_clash_sql()


def _search_ridge_sql() -> str:
    from tabforge.operators.trees import sample_space
    trials = ", ".join(f"({i}, CAST({t['alpha']!r} AS DOUBLE))" for i, t in enumerate(sample_space({"alpha": (1e-2, 1e4, "log")}, 20, 42)))
    return f"""WITH {C_CTE}, {CF_CTE},
t(trial, alpha) AS (VALUES {trials}),
k AS (SELECT DISTINCT fold AS k FROM CF),
s AS (SELECT k, avg(x1) AS mx, avg(y) AS my, covar_pop(x1, y) * count(*) AS cxy, var_pop(x1) * count(*) AS cxx FROM CF, k WHERE fold <> k GROUP BY k),
e AS (SELECT trial, alpha, fold, sqrt(avg(pow(y - my - (x1 - mx) * cxy / (cxx + alpha), 2))) AS rmse FROM CF JOIN s ON fold = k, t GROUP BY 1, 2, 3),
m AS (SELECT trial, alpha, avg(rmse) AS score FROM e GROUP BY 1, 2)
SELECT CAST(trial AS INTEGER) AS trial, round(alpha, 6) AS alpha, round(score, 6) AS score,
  trial = (SELECT min_by(trial, score) FROM m) AS best FROM m"""


ORACLE["search_ridge"] = _search_ridge_sql()


def _low_variance_wide_sql() -> str:
    cols = ["l_returnflag", "l_quantity", "l_discount", "l_extendedprice", "l_orderkey", "half"]
    counts = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS v, count(*) AS n FROM H GROUP BY 2" for c in cols)
    return f"""WITH H AS (SELECT *, CASE WHEN l_linenumber <= 3 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS half FROM lineitem),
V AS ({counts}), S AS (SELECT "column", count(*) AS d, max(n) / CAST(sum(n) AS DOUBLE) AS s FROM V GROUP BY 1)
SELECT "column", d <= 1000 AS exact, CASE WHEN d <= 1000 THEN d END AS n_distinct, CASE WHEN d <= 1000 OR s > 0.01 THEN round(s, 6) END AS top_share FROM S"""


ORACLE["low_variance_wide"] = _low_variance_wide_sql()


def _cv_grid_sql() -> str:
    from tabforge.plans.catalogue import CV_ALPHAS
    trials = ", ".join(f"(CAST({a!r} AS DOUBLE))" for a in CV_ALPHAS)
    return f"""WITH {C_CTE}, {CF_CTE},
t(alpha) AS (VALUES {trials}),
k AS (SELECT DISTINCT fold AS k FROM CF),
s AS (SELECT k, avg(x1) AS mx, avg(y) AS my, covar_pop(x1, y) * count(*) AS cxy, var_pop(x1) * count(*) AS cxx FROM CF, k WHERE fold <> k GROUP BY k),
e AS (SELECT alpha, fold, sqrt(avg(pow(y - my - (x1 - mx) * cxy / (cxx + alpha), 2))) AS rmse FROM CF JOIN s ON fold = k, t GROUP BY 1, 2),
m AS (SELECT alpha, avg(rmse) AS mean_rmse, stddev_pop(rmse) AS std_rmse FROM e GROUP BY 1)
SELECT alpha, round(mean_rmse, 6) AS mean_rmse, round(std_rmse, 6) AS std_rmse, alpha = (SELECT min_by(alpha, mean_rmse) FROM m) AS best FROM m"""


ORACLE["cv_grid"] = _cv_grid_sql()


def _audit_sql() -> str:
    num = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "qty_copy"]
    y = "l_extendedprice"

    def row(section, column, metric, value, other="CAST(NULL AS VARCHAR)", source="L", where=""):
        return (f"SELECT '{section}' AS section, '{column}' AS \"column\", {other} AS other, '{metric}' AS metric, "
                f"round(CAST({value} AS DOUBLE), 6) AS value FROM {source} {where}")

    parts = [row("target", y, m, v) for m, v in (("n", f"count({y})"), ("skew", f"skewness({y})"), ("min", f"min({y})"),
                                                 ("max", f"max({y})"), ("mean", f"avg({y})"), ("median", f"quantile_cont({y}, CAST(0.5 AS DOUBLE))"))]
    parts += [row("missing", "l_tax", "pct_missing", "100.0 * (count(*) - count(l_tax)) / count(*)")]
    for c in num:
        skew = f"(sum(pow({c} - m, 3)) / count({c})) / pow(sum(pow({c} - m, 2)) / count({c}), CAST(1.5 AS DOUBLE))"
        parts.append(f"SELECT * FROM ({row('skew', c, 'skew', skew, source=f'L, (SELECT avg({c}) AS m FROM L)')}) WHERE abs(value) > 0.75")
        parts.append(row("corr", c, "corr", f"corr({c}, {y})"))
        parts.append(row("outliers", c, "n_outliers", f"count(*) FILTER (abs(({c} - m) / s) > 1.5)",
                         source=f"L, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM L)"))
    for i, a in enumerate(num):
        for b in num[i + 1:]:
            parts.append(f"SELECT * FROM ({row('collinear', a, 'abs_corr', f'abs(corr({a}, {b}))', other=chr(39) + b + chr(39))}) WHERE value > 0.8")
    for c in num + ["l_returnflag"]:
        counts = f"(SELECT {c} AS v, count(*) AS n FROM L WHERE {c} IS NOT NULL GROUP BY 1)"
        parts.append(row("variance", c, "n_distinct", "count(*)", source=counts))
        parts.append(row("variance", c, "top_share", "CAST(max(n) AS DOUBLE) / sum(n)", source=counts))
    return ("WITH L AS (SELECT l_quantity, l_discount, CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_tax END AS l_tax, l_linenumber, "
            "l_quantity + (l_linenumber - 4) * CAST(2.0 AS DOUBLE) AS qty_copy, l_extendedprice, l_returnflag FROM lineitem)\n"
            + "\nUNION ALL ".join(parts))


ORACLE["audit_report"] = _audit_sql()
ORACLE["audit_json"] = ORACLE["audit_report"]


# ---------------------------------------------------------------- linear models of any width

def _eliminate(tag: str, src: str, p: int, keys: list[str]) -> str:
    """CTEs that solve the p x p system in the columns a_i_j (j = p: right side) of ``src``, one row per key; result {tag}_x."""
    head, out, prev = "".join(f"{k}, " for k in keys), [], src
    for k in range(p):
        cols = [(f"a_{k}_{j} / a_{k}_{k}" if i == k else f"a_{i}_{j} - a_{i}_{k} * a_{k}_{j} / a_{k}_{k}") + f" AS a_{i}_{j}"
                for i in range(p) for j in range(k + 1, p + 1)]
        out.append(f"{tag}_e{k} AS (SELECT {head}{', '.join(cols)} FROM {prev})")
        prev = f"{tag}_e{k}"
    return ",\n".join(out) + f",\n{tag}_x AS (SELECT {head}{', '.join(f'a_{i}_{p} AS x_{i}' for i in range(p))} FROM {prev})"


def _wide_ridge(tag: str, src: str, xs: list[str], alpha: float, keys: list[str]) -> str:
    """CTEs {tag}_m (means m_i, my) and {tag}_x (coefficients x_i) of a centred ridge per key over ``src``(keys, xs, y)."""
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    head = "".join(f"{k}, " for k in keys)
    on = " AND ".join(f"s.{k} = m.{k}" for k in keys) or "TRUE"
    means = ", ".join(f"avg({x}) AS m_{i}" for i, x in enumerate(xs))
    d = [f"(s.{x} - m.m_{i})" for i, x in enumerate(xs)]
    sums = [f"sum({d[i]} * {d[j]})" + (f" + CAST({alpha!r} AS DOUBLE)" if i == j else "") + f" AS a_{i}_{j}"
            for i in range(len(xs)) for j in range(len(xs))]
    sums += [f"sum({d[i]} * (s.y - m.my)) AS a_{i}_{len(xs)}" for i in range(len(xs))]
    by = f" GROUP BY {', '.join(f's.{k}' for k in keys)}" if keys else ""
    shead = "".join(f"s.{k}, " for k in keys)
    return (f"{tag}_m AS (SELECT {head}count(*) AS n, {means}, avg(y) AS my FROM {src}{group}),\n"
            f"{tag}_g AS (SELECT {shead}{', '.join(sums)} FROM {src} s JOIN {tag}_m m ON {on}{by}),\n"
            + _eliminate(tag, f"{tag}_g", len(xs), keys))


def _wide_pred(tag: str, xs: list[str], row: str) -> str:
    return f"({tag}_m.my + " + " + ".join(f"{tag}_x.x_{i} * ({row}.{x} - {tag}_m.m_{i})" for i, x in enumerate(xs)) + ")"


def _lasso_ctes(tag: str, src: str, xs: list[str], alpha: float, keys: list[str], rounds: int = 60) -> str:
    """CTEs {tag}_m and {tag}_x as for the ridge, by ``rounds`` of coordinate descent (needs WITH RECURSIVE)."""
    p, head = len(xs), "".join(f"{k}, " for k in keys)
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    on = " AND ".join(f"s.{k} = m.{k}" for k in keys) or "TRUE"
    d = [f"(s.{x} - m.m_{i})" for i, x in enumerate(xs)]
    shead = "".join(f"s.{k}, " for k in keys)
    by = f" GROUP BY {', '.join(f's.{k}' for k in keys)}" if keys else ""
    sums = ", ".join([f"avg({d[i]} * {d[j]}) AS g_{i}_{j}" for i in range(p) for j in range(p)]
                     + [f"avg({d[i]} * (s.y - m.my)) AS c_{i}" for i in range(p)])
    step = f"SELECT cd.*, g.* EXCLUDE ({', '.join(keys)})" if keys else "SELECT cd.*, g.*"
    inner = (f"{step} FROM {tag}_cd cd JOIN {tag}_g g ON "
             + (" AND ".join(f"cd.{k} = g.{k}" for k in keys) or "TRUE") + f" WHERE it < {rounds}")
    for i in range(p):
        r = f"(c_{i}" + "".join(f" - g_{i}_{j} * x_{j}" for j in range(p) if j != i) + ")"
        inner = f"SELECT * REPLACE (sign({r}) * greatest(abs({r}) - CAST({alpha!r} AS DOUBLE), 0) / g_{i}_{i} AS x_{i}) FROM ({inner})"
    names = ", ".join(f"x_{i}" for i in range(p))
    zeros = ", ".join(f"CAST(0 AS DOUBLE) AS x_{i}" for i in range(p))
    return (f"{tag}_m AS (SELECT {head}count(*) AS n, {', '.join(f'avg({x}) AS m_{i}' for i, x in enumerate(xs))}, avg(y) AS my FROM {src}{group}),\n"
            f"{tag}_g AS (SELECT {shead}{sums} FROM {src} s JOIN {tag}_m m ON {on}{by}),\n"
            f"{tag}_cd AS (SELECT {head}0 AS it, {zeros} FROM {tag}_g UNION ALL SELECT {head}it + 1, {names} FROM ({inner})),\n"
            f"{tag}_x AS (SELECT {head}{names} FROM {tag}_cd WHERE it = {rounds})")


_SEG_COLS = [f"seg_{s}" for s in _SEGS]
_ONE_HOT = ", ".join(f"CASE WHEN seg = '{s}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS seg_{s}" for s in _SEGS)
_COEF_XS = ["x1", "x2"] + _SEG_COLS

ORACLE["coef_top5"] = (f"WITH {C_CTE},\nH AS (SELECT x1, x2, y, {_ONE_HOT} FROM C),\n" + _wide_ridge("r", "H", _COEF_XS, 10.0, [])
                       + ",\nF AS (" + " UNION ALL ".join(f"SELECT '{x}' AS feature, x_{i} AS coef FROM r_x" for i, x in enumerate(_COEF_XS)) + """),
R AS (SELECT 'positive' AS direction, row_number() OVER (ORDER BY coef DESC, feature) AS rank, feature, coef FROM F WHERE coef > 0
      UNION ALL SELECT 'negative', row_number() OVER (ORDER BY coef, feature), feature, coef FROM F WHERE coef < 0)
SELECT direction, CAST(rank AS INTEGER) AS rank, feature, round(coef, 6) AS coef FROM R WHERE rank <= 5""")

ORACLE["l1_select"] = (f"WITH RECURSIVE {C_CTE},\nN AS (SELECT x1, x2, CAST(nat AS DOUBLE) AS natd, y FROM C),\n"
                       + _lasso_ctes("l", "N", ["x1", "x2", "natd"], 0.0005, []) + "\n"
                       + " UNION ALL ".join(f"SELECT '{x}' AS feature, round(x_{i}, 9) + 0 AS coef, abs(x_{i}) >= 1e-5 AS kept FROM l_x"
                                            for i, x in enumerate(["x1", "x2", "natd"])))


def _stack_sql() -> str:
    """Out-of-fold ridge(x1), ridge(x2), lasso(x1, x2); leave-one-out ridge over the three; bases refitted on all rows."""
    bases = {"r1": ["x1"], "r2": ["x2"], "l": ["x1", "x2"]}

    def base(tag, src, keys):
        return (_lasso_ctes(tag, src, bases["l"], 0.0005, keys) if tag.startswith("l")
                else _wide_ridge(tag, src, bases[tag.rstrip("ft")], 10.0, keys))

    parts = [f"WITH RECURSIVE {C_CTE}, {CF_CTE}",
             "TR AS (SELECT k.fold AS f, CF.* FROM (SELECT DISTINCT fold FROM CF) k JOIN CF ON CF.fold <> k.fold)"]
    parts += [base(t + "f", "TR", ["f"]) for t in bases] + [base(t + "t", "C", []) for t in bases]

    def preds(suffix, row):
        return ", ".join(f"{_wide_pred(t + suffix, xs, row)} AS p{i}" for i, (t, xs) in enumerate(bases.items()))

    joins = " ".join(f"JOIN {t}f_m ON {t}f_m.f = CF.fold JOIN {t}f_x ON {t}f_x.f = CF.fold" for t in bases)
    parts.append(f"OOF AS (SELECT CF.y, {preds('f', 'CF')} FROM CF {joins})")
    tables = ", ".join(f"{t}t_m, {t}t_x" for t in bases)
    parts.append(f"ALLP AS (SELECT C.id, {preds('t', 'C')} FROM C, {tables})")
    ps = ["p0", "p1", "p2"]
    pd = [f"({{r}}.{x} - mm.m_{i})" for i, x in enumerate(ps)]
    d = [x.format(r="o") for x in pd]
    parts.append("mm AS (SELECT count(*) AS n, " + ", ".join(f"avg({x}) AS m_{i}" for i, x in enumerate(ps)) + ", avg(y) AS my FROM OOF)")
    # per alpha the meta system; the columns of the inverse come from three more right sides
    gram = ", ".join([f"sum({d[i]} * {d[j]}) AS g_{i}_{j}" for i in range(3) for j in range(3)] + [f"sum({d[i]} * (o.y - mm.my)) AS c_{i}" for i in range(3)])
    parts.append(f"mg AS (SELECT {gram} FROM OOF o, mm)")
    parts.append("al AS (SELECT CAST(a AS DOUBLE) AS alpha FROM (VALUES (0.1), (1.0), (10.0), (100.0)) v(a))")
    for k in range(4):
        cols = [f"g_{i}_{j}" + (" + alpha" if i == j else "") + f" AS a_{i}_{j}" for i in range(3) for j in range(3)]
        cols += [(f"c_{i}" if k == 0 else f"CAST({int(i == k - 1)} AS DOUBLE)") + f" AS a_{i}_3" for i in range(3)]
        parts.append(f"s{k} AS (SELECT alpha, {', '.join(cols)} FROM mg, al)")
        parts.append(_eliminate(f"v{k}", f"s{k}", 3, ["alpha"]))
    fit = " + ".join(f"v0_x.x_{i} * {d[i]}" for i in range(3))
    h = " + ".join(f"{d[i]} * {d[j]} * v{j + 1}_x.x_{i}" for i in range(3) for j in range(3))
    vjoin = " ".join(f"JOIN v{k}_x ON v{k}_x.alpha = v0_x.alpha" for k in (1, 2, 3))
    parts.append(f"lo AS (SELECT v0_x.alpha, avg(pow((o.y - mm.my - ({fit})) / (1 - (CAST(1 AS DOUBLE) / mm.n + {h})), 2)) AS loo "
                 f"FROM v0_x {vjoin}, OOF o, mm GROUP BY v0_x.alpha)")
    parts.append("best AS (SELECT alpha FROM lo ORDER BY loo, alpha LIMIT 1)")
    out = " + ".join(f"v0_x.x_{i} * {pd[i].format(r='a')}" for i in range(3))
    return ",\n".join(parts) + (f"\nSELECT a.id, round(mm.my + {out}, 6) AS prediction "
                                "FROM ALLP a, mm, best JOIN v0_x ON v0_x.alpha = best.alpha")


ORACLE["stack_ridge"] = _stack_sql()


def _ablation_sql() -> str:
    """Per fold: encoders, robust scaling and ridge fitted on the other folds; both variants' fold scores."""
    raw = ["x1", "x2"] + _SEG_COLS + ["te"]
    w = "(1 / (1 + exp(-(n - 20) / CAST(10 AS DOUBLE))))"
    parts = [f"WITH {C_CTE}, {CF_CTE}",
             "K AS (SELECT DISTINCT fold AS f FROM CF)",
             "PR AS (SELECT f, avg(y) AS prior FROM K JOIN CF ON CF.fold <> f GROUP BY f)",
             "ST AS (SELECT f, nat, count(*) AS n, avg(y) AS m FROM K JOIN CF ON CF.fold <> f GROUP BY f, nat)",
             f"EN AS (SELECT f, nat, CASE WHEN n = 1 THEN prior ELSE prior * (1 - {w}) + m * {w} END AS e FROM ST JOIN PR USING (f))",
             f"X AS (SELECT PR.f, CF.fold, CF.id, CF.y, x1, x2, {_ONE_HOT}, coalesce(e, prior) AS te "
             "FROM PR CROSS JOIN CF LEFT JOIN EN ON EN.f = PR.f AND EN.nat = CF.nat)",
             "Q AS (SELECT f, " + ", ".join(f"quantile_cont({c}, 0.5) AS med_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr_{c}"
                                            for c in raw) + " FROM X WHERE fold <> f GROUP BY f)",
             "Z AS (SELECT X.f, X.fold, X.y, " + ", ".join(f"(X.{c} - med_{c}) / (CASE WHEN abs(iqr_{c}) > 2.3e-15 THEN iqr_{c} ELSE 1 END) AS {c}"
                                                          for c in raw) + " FROM X JOIN Q USING (f))",
             "ZT AS (SELECT * FROM Z WHERE fold <> f)"]
    scores = []
    for name, xs in (("base", ["x1", "x2"]), ("improved", raw)):
        tag = name[0]
        parts.append(_wide_ridge(tag, "ZT", xs, 10.0, ["f"]))
        p = _wide_pred(tag, xs, "Z")
        scores.append(f"SELECT '{name}' AS model, Z.f, sqrt(avg(pow(Z.y - {p}, 2))) AS rmse FROM Z JOIN {tag}_m ON {tag}_m.f = Z.f "
                      f"JOIN {tag}_x ON {tag}_x.f = Z.f WHERE Z.fold = Z.f GROUP BY Z.f")
    parts.append("SC AS (" + " UNION ALL ".join(scores) + ")")
    return ",\n".join(parts) + ("\nSELECT model, round(avg(rmse), 6) AS mean_rmse, round(stddev_pop(rmse), 6) AS std_rmse, "
                                "count(*) AS n_folds FROM SC GROUP BY model")


ORACLE["ablation"] = _ablation_sql()


def _skew_route_sql() -> str:
    """Skewed columns: Yeo-Johnson by the two grids, standardised; then every column robustly scaled."""
    ll = "-CAST(count(*) AS DOUBLE) / 2 * ln(var_pop({t})) + (lam - 1) * sum(sign(x) * ln(1 + abs(x))) AS ll"
    t = _yj("x", "lam")
    cols = ["x1", "x2", "x3"]
    long = " UNION ALL ".join(f"SELECT id, '{c}' AS col, {c} AS x FROM C3" for c in cols)
    wide = ", ".join(f"round(max(CASE WHEN Z.col = '{c}' THEN z END), 6) AS {c}" for c in cols)
    return f"""WITH {C_CTE},
C3 AS (SELECT id, x1, x2, exp(x1 / CAST(5 AS DOUBLE)) AS x3 FROM C),
X AS ({long}),
M AS (SELECT col, avg(x) AS m, var_pop(x) AS v FROM X GROUP BY col),
S AS (SELECT X.col, abs(avg(pow(x - m, 3)) / pow(max(v), CAST(1.5 AS DOUBLE))) > 0.75 AS skewed FROM X JOIN M USING (col) GROUP BY X.col),
XS AS (SELECT X.* FROM X JOIN S USING (col) WHERE skewed),
G1 AS (SELECT CAST(k AS DOUBLE) / 10 AS lam FROM range(-50, 51) t(k)),
L1 AS (SELECT col, lam, {ll.format(t=t)} FROM XS, G1 GROUP BY col, lam),
B1 AS (SELECT col, arg_max(lam, ll) AS lam1 FROM L1 GROUP BY col),
G2 AS (SELECT col, lam1 + CAST(j - 100 AS DOUBLE) / 1000 AS lam FROM B1, range(0, 201) t(j)),
L2 AS (SELECT XS.col, lam, {ll.format(t=t)} FROM XS JOIN G2 ON XS.col = G2.col GROUP BY XS.col, lam),
B2 AS (SELECT col, arg_max(lam, ll) AS lam FROM L2 GROUP BY col),
T AS (SELECT id, XS.col, {t} AS t FROM XS JOIN B2 ON XS.col = B2.col),
TS AS (SELECT col, avg(t) AS m, stddev_pop(t) AS sd FROM T GROUP BY col),
R AS (SELECT id, T.col, (t - m) / sd AS x FROM T JOIN TS ON T.col = TS.col
      UNION ALL SELECT id, X.col, x FROM X JOIN S ON X.col = S.col WHERE NOT skewed),
Q AS (SELECT col, median(x) AS med, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM R GROUP BY col),
Z AS (SELECT id, R.col, (x - med) / (CASE WHEN abs(iqr) > 2.3e-15 THEN iqr ELSE 1 END) AS z FROM R JOIN Q ON R.col = Q.col),
N AS (SELECT coalesce(string_agg(col, ',' ORDER BY col), '') AS names FROM S WHERE skewed)
SELECT id, {wide}, max(names) AS skewed_cols FROM Z, N GROUP BY id"""


ORACLE["skew_route"] = _skew_route_sql()
