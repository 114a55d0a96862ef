"""Scalar and row-wise feature transforms (X1-X25) as column expressions.

All of these stay inside whole-stage codegen: regex, string, arithmetic,
calendar and trigonometric built-ins only, no Python UDF.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def regex_extract_default(col, pattern: str, default: str, group: int = 1) -> Column:
    """First regex group, ``default`` when there is no match."""
    v = F.regexp_extract(_c(col), pattern, group)
    return F.when(_c(col).isNull() | (v == ""), F.lit(default)).otherwise(v)


def value_map(col, mapping: Mapping[str, str], keep_unmapped: bool = True) -> Column:
    """Synonym or ordinal lookup through a literal map."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    looked = F.element_at(m, _c(col)) if mapping else F.lit(None)
    return F.coalesce(looked, _c(col)) if keep_unmapped else looked


def prefix_clean(col, empty_default: str = "NONE", null_default: str = "MISSING") -> Column:
    """Drop '.', '/' and digits, upper-case, trim, spaces to '_'."""
    s = F.upper(F.trim(F.regexp_replace(F.regexp_replace(_c(col), r"[./]", ""), r"[0-9]", "")))
    s = F.regexp_replace(s, r"\s+", "_")
    return F.when(_c(col).isNull(), F.lit(null_default)).when(s == "", F.lit(empty_default)).otherwise(s)


def first_char(col, default: str = "U") -> Column:
    """X4."""
    return F.when(_c(col).isNull() | (F.length(_c(col)) == 0), F.lit(default)).otherwise(F.substring(_c(col), 1, 1))


def token_count(col) -> Column:
    """Whitespace tokens of the trimmed text (0 for NULL)."""
    toks = F.filter(F.split(F.trim(_c(col)), r"\s+"), lambda t: t != "")
    return F.coalesce(F.size(toks), F.lit(0))


def present(col) -> Column:
    """X6."""
    return _c(col).isNotNull().cast("int")


def fixed_bins(col, edges: Sequence[float], labels: Sequence[str] | None = None, right: bool = True) -> Column:
    """X11: pandas ``cut`` with fixed edges: right-closed unless
    ``right=False``; values outside the edges give NULL."""
    x = _c(col)
    out = None
    for i in range(len(edges) - 1):
        lo, hi = float(edges[i]), float(edges[i + 1])
        cond = (x > lo) & (x <= hi) if right else (x >= lo) & (x < hi)
        val = F.lit(labels[i]) if labels else F.lit(i)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def equal_width_bins(col, lo: Column, hi: Column, n: int) -> Column:
    """Pandas ``cut(x, n)``: n equal bins over [min, max], right-closed,
    the first edge lowered by 0.1% of the range so the minimum is included.
    Returns the bin number 0..n-1."""
    x = _c(col)
    width = (hi - lo) / F.lit(float(n))
    raw = F.ceil((x - lo) / width).cast("int") - 1
    return F.when(x.isNull(), None).when(hi == lo, F.lit(0)).otherwise(F.least(F.greatest(raw, F.lit(0)), F.lit(n - 1)))


def calendar_parts(ts) -> dict[str, Column]:
    """Hour, Monday-based weekday (0 = Monday), month, quarter, year,
    day of year."""
    t = _c(ts)
    return {"hour": F.hour(t), "weekday": F.weekday(t), "month": F.month(t), "quarter": F.quarter(t),
            "year": F.year(t), "day_of_year": F.dayofyear(t)}


def days_since(ts, origin: Column) -> Column:
    """Elapsed days (float) since ``origin``."""
    return F.timestamp_diff("MICROSECOND", origin, _c(ts)).cast("double") / F.lit(86400e6)


def cyclic(x, period: float) -> tuple[Column, Column]:
    """Sin and cos of 2*pi*x/period."""
    a = _c(x).cast("double") * F.lit(2 * math.pi / period)
    return F.sin(a), F.cos(a)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance with R = 6371 km."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def rbf(distance: Column, scale: float = 50.0) -> Column:
    """exp(-d / scale)."""
    return F.exp(-distance / F.lit(float(scale)))


def in_box(lat, lon, box: tuple[float, float, float, float]) -> Column:
    """1 if the point is inside (lat0, lat1, lon0, lon1)."""
    a0, a1, o0, o1 = box
    return (_c(lat).between(a0, a1) & _c(lon).between(o0, o1)).cast("int")


def log1p_target(y) -> Column:
    """X23 forward."""
    return F.log1p(_c(y))


def expm1_clip(z) -> Column:
    """X23 inverse, clipped at 0."""
    return F.greatest(F.expm1(_c(z)), F.lit(0.0))


def masked(col, key_text: Column, colname: str, pct: int = 15) -> Column:
    """Seeded cell masking: NULL when bucket(key || column) < pct."""
    from fathom.functions.hashing import bucket
    return F.when(bucket(key_text, colname) < pct, F.lit(None)).otherwise(_c(col))


def gaussian_noise(col, sigma: float, seed: int = 42) -> Column:
    """Additive N(0, sigma^2) noise (partition-dependent: rows check only)."""
    return _c(col) + F.randn(seed) * F.lit(float(sigma))
