"""Column expressions used across the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def as_col(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_sum(cols: Sequence[ColLike], weights: Sequence[float] | None = None) -> Column:
    """sum_i w_i * coalesce(c_i, 0)  (pandas ``fillna(0)`` then add)."""
    weights = list(weights) if weights is not None else [1.0] * len(cols)
    terms = [F.coalesce(as_col(c).cast("double"), F.lit(0.0)) * F.lit(float(w)) if w != 1.0
             else F.coalesce(as_col(c).cast("double"), F.lit(0.0))
             for c, w in zip(cols, weights)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def presence_flag(c: ColLike, threshold: float = 0.0) -> Column:
    """1 if c > threshold else 0; a null operand gives 0 (pandas comparison)."""
    return F.coalesce((as_col(c) > F.lit(threshold)).cast("int"), F.lit(0))


def not_all_true(cond: Column) -> Column:
    """Negation that keeps rows whose condition is null (pandas boolean drop)."""
    return ~F.coalesce(cond, F.lit(False))


def code_map(mapping: Mapping[str, float | int], c: ColLike, default: float | int | None = 0) -> Column:
    """Dictionary lookup value -> code through a literal map; unknown -> default."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    looked = m[as_col(c)]
    return looked if default is None else F.coalesce(looked, F.lit(default))


def round_half_even(c: ColLike, scale: int = 0) -> Column:
    """numpy/pandas ``round``: ties to even."""
    return F.bround(as_col(c), scale)


def log1p(c: ColLike) -> Column:
    return F.log1p(as_col(c))


def expm1(c: ColLike) -> Column:
    return F.expm1(as_col(c))


def yeo_johnson(c: ColLike, lam: float) -> Column:
    """Yeo-Johnson power transform with a fixed lambda (four branches)."""
    x = as_col(c).cast("double")
    lam = float(lam)
    if abs(lam) < 1e-12:
        pos = F.log1p(x)
    else:
        pos = (F.pow(x + F.lit(1.0), F.lit(lam)) - F.lit(1.0)) / F.lit(lam)
    if abs(lam - 2.0) < 1e-12:
        neg = -F.log1p(-x)
    else:
        neg = -(F.pow(F.lit(1.0) - x, F.lit(2.0 - lam)) - F.lit(1.0)) / F.lit(2.0 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def yeo_johnson_inverse(c: ColLike, lam: float) -> Column:
    y = as_col(c).cast("double")
    lam = float(lam)
    if abs(lam) < 1e-12:
        pos = F.expm1(y)
    else:
        pos = F.pow(y * F.lit(lam) + F.lit(1.0), F.lit(1.0 / lam)) - F.lit(1.0)
    if abs(lam - 2.0) < 1e-12:
        neg = -F.expm1(-y)
    else:
        neg = F.lit(1.0) - F.pow(F.lit(1.0) - y * F.lit(2.0 - lam), F.lit(1.0 / (2.0 - lam)))
    return F.when(y >= 0, pos).otherwise(neg)


def adjusted_skew(pop_skew: Column, n: Column) -> Column:
    """Sample-adjusted (pandas) skewness from the population (Spark) one."""
    n = n.cast("double")
    return F.when(n > 2, pop_skew * F.sqrt(n * (n - 1)) / (n - 2))


def modmul_hash(key: ColLike, seed: int = 42) -> Column:
    """Deterministic portable hash of an integer key in [0, 2^31-1).

    One multiplicative-congruential step modulo the Mersenne prime 2^31-1;
    the intermediate stays below 2^62, so the same value is reproduced by any
    SQL engine with 64-bit integers (used for folds and samplers).
    """
    p = F.lit(2147483647)
    k = F.pmod(as_col(key).cast("long"), p)
    return F.pmod(k * F.lit(1103515245) + F.lit(int(seed)), p)
