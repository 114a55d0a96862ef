"""Null-safe numeric helpers shared by all operators.

Decisions from the data model: NaN and +-inf become NULL, failed casts
give NULL (``try_cast``), division by zero gives NULL (``try_divide``),
and reported floats are quantised with ``round(x * 10^d) / 10^d``, which
rounds identically in Spark and DuckDB (``round(x, d)`` does not: the two
engines disagree on decimal halfway cases such as 1.005).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rnd(col, digits: int = 6) -> Column:
    scale = float(10 ** digits)
    return F.round(_c(col) * F.lit(scale)) / F.lit(scale)


def sql_rnd(expr: str, digits: int = 6) -> str:
    return f"(round(({expr}) * 1e{digits}) / 1e{digits})"


EXACT_SCALE = 10


def exact_mean(col) -> Column:
    """Mean from an exact decimal sum (values with at most 10 decimals),
    turned into a double once and divided by the count.  A double sum
    depends on the order rows arrive in, so a mean on a rounding halfway
    point could round either way under another partitioning; this one is
    the same under any partitioning and in DuckDB (``sql_exact_mean``).
    Falls back to the double mean when a value or the sum does not fit."""
    c = _c(col)
    d = c.try_cast(f"decimal(38,{EXACT_SCALE})")
    s = F.try_sum(d)
    return F.when((F.count(d) == F.count(c)) & s.isNotNull(), s.cast("double") / F.count(c)).otherwise(F.avg(c))


def sql_exact_mean(expr: str) -> str:
    d = f"TRY_CAST({expr} AS DECIMAL(38,{EXACT_SCALE}))"
    return f"(CASE WHEN count({d}) = count({expr}) THEN CAST(sum({d}) AS DOUBLE) / count({expr}) ELSE avg({expr}) END)"


def clean_double(col) -> Column:
    """NaN and +-inf to NULL (P5 and the NaN rule of the data model)."""
    c = _c(col).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def safe_div(a, b) -> Column:
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def div0(a, b, default: float = 0.0) -> Column:
    """Ratio that is ``default`` when undefined (metrics such as precision)."""
    return F.coalesce(safe_div(a, b), F.lit(default))


def flag(cond: Column) -> Column:
    """Boolean to 0/1 int where NULL counts as False (denominator keeps the row)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def share(cond: Column) -> Column:
    """Share of rows where ``cond`` holds; NULL comparisons count as False."""
    return F.avg(flag(cond).cast("double"))


def bias_adjusted_skew(g1: Column, n: Column) -> Column:
    """Sample skewness G1 from Spark's population g1."""
    n = n.cast("double")
    return g1 * F.sqrt(n * (n - 1)) / (n - 2)


def bias_adjusted_kurt(g2: Column, n: Column) -> Column:
    """Sample excess kurtosis G2 from Spark's population excess kurtosis g2."""
    n = n.cast("double")
    return (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
