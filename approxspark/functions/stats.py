"""Normal and Student-t quantiles.

``z`` is a driver-side constant (the confidence level is a parameter). The t quantile depends on
the degrees of freedom, which can differ per group, so it is a Column: exact literal values for
small degrees of freedom (computed on the driver), a Cornish-Fisher series beyond. The same
expression is emitted as SQL text for the DuckDB oracles.

Tabulated and series values join without a visible step: at the first degree of freedom beyond the
table the series' next term, and so its error, is below 1e-12 of the quantile for confidences up to 99.99%.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Degrees of freedom up to this value use exact driver-computed quantiles.
EXACT_T_MAX_DF = 1000


def z_value(confidence: float) -> float:
    """Two-sided normal critical value for a confidence level in (0, 1)."""
    if not 0 < confidence < 1:
        raise ValueError("confidence must be between 0 and 1")
    return NormalDist().inv_cdf((1 + confidence) / 2)


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the regularized incomplete beta (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def _betainc(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1 - x) / b


def t_cdf(t: float, df: float) -> float:
    x = df / (df + t * t)
    tail = 0.5 * _betainc(df / 2.0, 0.5, x)
    return 1.0 - tail if t >= 0 else tail


def t_ppf(p: float, df: float) -> float:
    """Exact Student-t quantile by inverting the CDF (driver side)."""
    if df == 1:
        return math.tan(math.pi * (p - 0.5))
    if df == 2:
        return (2 * p - 1) / math.sqrt(2 * p * (1 - p))
    t = NormalDist().inv_cdf(p)
    lo, hi = (0.0, 1e3) if p >= 0.5 else (-1e3, 0.0)
    log_c = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
    for _ in range(200):  # Newton steps, kept inside a bracket that halves where they leave it
        gap = t_cdf(t, df) - p
        lo, hi = (t, hi) if gap < 0 else (lo, t)
        step = gap / math.exp(log_c - (df + 1) / 2 * math.log1p(t * t / df))
        new = t - step if lo < t - step < hi else (lo + hi) / 2
        if abs(new - t) <= 1e-15 * max(1.0, abs(new)):
            return new
        t = new
    return t


@lru_cache(maxsize=16)
def t_table(p: float) -> tuple[float, ...]:
    """Quantiles for 1 ... EXACT_T_MAX_DF degrees of freedom."""
    return tuple(t_ppf(p, k) for k in range(1, EXACT_T_MAX_DF + 1))


def t_value(confidence: float, df: float) -> float:
    return t_ppf((1 + confidence) / 2, df)


def _cornish_fisher_terms(z: float) -> list[float]:
    # Abramowitz & Stegun 26.7.5 coefficients of 1/df^k, k = 0..4
    return [
        z,
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]


def t_quantile_sql(confidence: float, df_sql: str) -> str:
    """DuckDB SQL text of the two-sided t critical value for df = ``df_sql``.

    NULL when df < 1.
    """
    p = (1 + confidence) / 2
    z = NormalDist().inv_cdf(p)
    g = _cornish_fisher_terms(z)
    nu = f"CAST({df_sql} AS DOUBLE)"
    series = f"({g[0]!r} + {g[1]!r} / {nu} + {g[2]!r} / ({nu} * {nu}) + {g[3]!r} / ({nu} * {nu} * {nu}) + {g[4]!r} / ({nu} * {nu} * {nu} * {nu}))"
    table = ", ".join(map(repr, t_table(p)))
    exact = f"([{table}])[CAST({df_sql} AS INTEGER)]"
    return f"(CASE WHEN {df_sql} IS NULL OR {df_sql} < 1 THEN NULL WHEN {df_sql} <= {EXACT_T_MAX_DF} THEN {exact} ELSE {series} END)"


def t_quantile(confidence: float, df: Column | str) -> Column:
    """Column form of :func:`t_quantile_sql`; ``df`` is a column name or Column."""
    return _t_from_column(confidence, F.col(df) if isinstance(df, str) else df)


def _t_from_column(confidence: float, df: Column) -> Column:
    p = (1 + confidence) / 2
    z = NormalDist().inv_cdf(p)
    g = _cornish_fisher_terms(z)
    nu = df.cast("double")
    series = F.lit(g[0]) + F.lit(g[1]) / nu + F.lit(g[2]) / (nu * nu) + F.lit(g[3]) / (nu * nu * nu) + F.lit(g[4]) / (nu * nu * nu * nu)
    expr = F.when(df.isNull() | (df < 1), F.lit(None).cast("double"))
    exact = F.get(F.lit(list(t_table(p))), (df - 1).cast("int"))
    return expr.when(df <= EXACT_T_MAX_DF, exact).otherwise(series)
