"""Distribution tails, two ways.

* Python scalars (``norm_sf``, ``chi2_sf``, ``t_sf``, ``ks_sf``) for small
  driver-side numbers (a statistic already reduced by Spark) and tests.
  SciPy is not a dependency: ``math.erfc``/``math.lgamma`` plus a series and
  a continued fraction are enough.
* SQL text builders (``sql_norm_cdf`` ...) that parse in both Spark SQL
  (via ``F.expr``) and DuckDB, so p-values are computed per row or per
  group inside the plan and the same formula serves as oracle.  The normal
  CDF uses the Zelen-Severo polynomial (|error| < 7.5e-8); chi-square with
  more than one degree of freedom uses the Wilson-Hilferty transform.
  Constants are written in e-notation so both engines read them as DOUBLE.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


# scalars

def norm_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    """Inverse normal CDF (Acklam's rational approximation + one Newton step)."""
    if p <= 0.0:
        return -math.inf
    if p >= 1.0:
        return math.inf
    a = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
         1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00]
    b = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
         6.680131188771972e01, -1.328068155288572e01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
         -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
         3.754408661907416e00]
    lo = 0.02425
    if p < lo:
        q = math.sqrt(-2 * math.log(p))
        x = (((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / \
            ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    elif p <= 1 - lo:
        q = p - 0.5
        r = q * q
        x = (((((a[0] * r + a[1]) * r + a[2]) * r + a[3]) * r + a[4]) * r + a[5]) * q / \
            (((((b[0] * r + b[1]) * r + b[2]) * r + b[3]) * r + b[4]) * r + 1)
    else:
        q = math.sqrt(-2 * math.log(1 - p))
        x = -(((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / \
            ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    e = norm_cdf(x) - p
    u = e * math.sqrt(2 * math.pi) * math.exp(x * x / 2)
    return x - u / (1 + x * u / 2)


def _gammainc_lower_reg(a: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x < a + 1:
        term = 1.0 / a
        total = term
        n = a
        for _ in range(1000):
            n += 1
            term *= x / n
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return total * math.exp(-x + a * math.log(x) - math.lgamma(a))
    return 1.0 - _gammainc_upper_cf(a, x)


def _gammainc_upper_cf(a: float, x: float) -> float:
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_sf(x: float, df: float) -> float:
    if x is None or x != x:
        return float("nan")
    if x <= 0:
        return 1.0
    return 1.0 - _gammainc_lower_reg(df / 2.0, x / 2.0)


def _betacf(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1, a - 1
    c, d = 1.0, 1 - qab * x / qap
    d = tiny if abs(d) < tiny else d
    d = 1 / d
    h = d
    for m in range(1, 1000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def t_sf(t: float, df: float) -> float:
    """P(T > t) for Student's t."""
    x = df / (df + t * t)
    tail = 0.5 * betainc_reg(df / 2.0, 0.5, x)
    return tail if t >= 0 else 1 - tail


def ks_sf(lam: float, terms: int = 100) -> float:
    """Kolmogorov distribution tail Q(lambda) = 2 sum (-1)^(j-1) exp(-2 j^2 lambda^2)."""
    if lam < 0.2:
        return 1.0
    s = sum(2 * (-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, terms + 1))
    return min(1.0, max(0.0, s))


# shared SQL snippets

def sql_norm_cdf(z: str) -> str:
    """Standard normal CDF of a SQL expression ``z`` (Zelen-Severo)."""
    t = f"(1.0e0 / (1.0e0 + 2.316419e-1 * abs({z})))"
    poly = (f"({t} * (3.19381530e-1 + {t} * (-3.56563782e-1 + {t} * (1.781477937e0"
            f" + {t} * (-1.821255978e0 + {t} * 1.330274429e0)))))")
    upper = f"(3.989422804014327e-1 * exp(-5.0e-1 * ({z}) * ({z})) * {poly})"
    return f"(CASE WHEN ({z}) >= 0 THEN 1.0e0 - {upper} ELSE {upper} END)"


def sql_chi2_sf(x: str, df: int) -> str:
    """Chi-square upper tail: exact for 1 d.o.f., Wilson-Hilferty otherwise."""
    if df == 1:
        return f"(CASE WHEN ({x}) <= 0 THEN 1.0e0 ELSE 2.0e0 * (1.0e0 - {sql_norm_cdf(f'sqrt({x})')}) END)"
    k = float(df)
    z = (f"((power(greatest({x}, 0.0e0) / {k!r}e0, 1.0e0 / 3.0e0) - (1.0e0 - 2.0e0 / (9.0e0 * {k!r}e0)))"
         f" / sqrt(2.0e0 / (9.0e0 * {k!r}e0)))").replace(".0e0e0", ".0e0")
    return f"(1.0e0 - {sql_norm_cdf(z)})"


def sql_ks_sf_spark(lam: str, terms: int = 100) -> str:
    return (f"(CASE WHEN ({lam}) < 2.0e-1 THEN 1.0e0 ELSE least(1.0e0, greatest(0.0e0, "
            f"aggregate(sequence(1, {terms}), 0.0e0, (acc, j) -> acc + 2.0e0 * power(-1.0e0, j - 1)"
            f" * exp(-2.0e0 * j * j * ({lam}) * ({lam}))))) END)")


def sql_ks_sf_duckdb(lam: str, terms: int = 100) -> str:
    return (f"(CASE WHEN ({lam}) < 2.0e-1 THEN 1.0e0 ELSE least(1.0e0, greatest(0.0e0, "
            f"list_sum(list_transform(range(1, {terms + 1}), lambda j: 2.0e0 * power(-1.0e0, j - 1)"
            f" * exp(-2.0e0 * j * j * ({lam}) * ({lam})))))) END)")


def norm_cdf_col(z) -> Column:
    name = z if isinstance(z, str) else None
    if name is None:
        raise TypeError("pass a column name; build the column first with withColumn")
    return F.expr(sql_norm_cdf(f"`{name}`"))


def chi2_sf_col(x: str, df: int) -> Column:
    return F.expr(sql_chi2_sf(f"`{x}`", df))


def ks_sf_col(lam: str) -> Column:
    return F.expr(sql_ks_sf_spark(f"`{lam}`"))
