"""Mutual information by neighbours and local Moran significance against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import mutual_info as M
from fathom.operators import spatial as G


def _digamma(n):
    return -0.57721566490153286 + sum(1 / i for i in range(1, n))


def test_digamma_text(spark):
    got = spark.range(1, 400).select("id", F.expr(M.digamma_sql("id")).alias("d")).collect()
    assert all(abs(r.d - _digamma(r.id)) < 1e-9 for r in got)


@pytest.mark.parametrize("k", [3, 5])
def test_information_equals_all_pairs(spark, k):
    """Continuous, integer-valued and constant features; equal rows; a NULL."""
    rng = np.random.default_rng(k)
    n = 300
    x = rng.normal(size=n)
    rows = [(i, float(x[i]), float(round(2 * x[i])), 7.0, float(x[i] + 0.3 * rng.normal()) if i % 9 else 1.5) for i in range(n)]
    df = spark.createDataFrame([*rows, (n, None, 1.0, 7.0, 0.0)], "id long, a double, b double, c double, y double")
    got = {r.feature: (r.n, r.mutual_information) for r in M.neighbour_information(df, "id", ["a", "b", "c"], "y", k).collect()}
    for f in ("a", "b", "c"):
        full = df.select("id", F.col(f).alias("x"), "y").dropna()
        pts = np.array([(r.x, r.y) for r in M.on_grid(full, "id", ["x", "y"]).collect()], dtype=np.int64)
        d = np.abs(pts[:, None] - pts[None])
        joint = np.sort(d.max(axis=2), axis=1)[:, k]                  # itself at 0
        near = (d < joint[:, None, None]).sum(axis=1) - 1
        want = _digamma(len(pts)) + _digamma(k) - np.mean([_digamma(a + 1) + _digamma(b + 1) for a, b in near])
        assert got[f][0] == len(pts) and got[f][1] == pytest.approx(max(want, 0), abs=1e-8)
    assert got["a"][1] > 0.8 and got["c"][1] < 0.15


def test_information_of_few_rows(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 1.0)], "id long, a double, y double")
    assert [tuple(r) for r in M.neighbour_information(df, "id", ["a"], "y").collect()] == [("a", 2, None)]


def _grid(spark, value):
    """20 x 20 points with four neighbours at most 1 apart in the table given."""
    pts = [(r * 20 + c, value(r, c)) for r in range(20) for c in range(20)]
    nb = [(r * 20 + c, q * 20 + d) for r in range(20) for c in range(20) for q, d in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1))
          if 0 <= q < 20 and 0 <= d < 20]
    return pts, nb, spark.createDataFrame(pts, "id long, v double"), spark.createDataFrame(nb, "id long, neighbour long")


def test_clusters_are_significant_and_noise_is_not(spark):
    rng = np.random.default_rng(1)
    noise = rng.normal(size=(20, 20))
    pts, nb, df, near = _grid(spark, lambda r, c: float(noise[r, c] + (6 if r < 6 and c < 6 else 0) - (6 if r > 13 and c > 13 else 0)))
    got = {r.id: r for r in G.local_moran(df, near, "v", 199).collect()}
    inner = [got[r * 20 + c] for r in range(1, 5) for c in range(1, 5)]
    cold = [got[r * 20 + c] for r in range(15, 19) for c in range(15, 19)]
    assert all(r.quadrant == "HH" and r.p_sim < 0.05 for r in inner) and all(r.quadrant == "LL" and r.p_sim < 0.05 for r in cold)
    quiet = [got[r * 20 + c] for r in range(8, 12) for c in range(8, 12)]
    assert sum(r.p_sim < 0.05 for r in quiet) <= 4


def test_local_moran_equals_a_loop(spark):
    rng = np.random.default_rng(2)
    pts, nb, df, near = _grid(spark, lambda r, c: float(rng.normal()))
    got = {r.id: r for r in G.local_moran(df, near, "v", 49, seed="t").collect()}
    z = np.array([v for _, v in pts])
    z -= z.mean()
    draws = {}
    for r in G.permutation_draws(spark, 400, 4, 49, "t").collect():
        draws.setdefault(r.p, []).append(r["at"])
    assert len(draws) == 49 and all(len(set(d)) == 4 and max(d) < 399 for d in draws.values())
    for i in range(0, 400, 7):
        lag = np.mean([z[b] for a, b in nb if a == i])
        m = sum(z[i] * np.mean([z[a if a < i else a + 1] for a in d]) >= z[i] * lag for d in draws.values())
        assert got[i].p_sim == pytest.approx((min(m, 49 - m) + 1) / 50)
        assert got[i].local_i == pytest.approx(z[i] * lag * 399 / (z @ z))


def test_too_few_points_have_no_p_value(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, None)], "id long, v double")
    near = spark.createDataFrame([(1, 2), (2, 1), (1, 3), (2, 3)], "id long, neighbour long")
    got = G.local_moran(df, near, "v", 9).collect()
    assert {r.id for r in got} == {1, 2} and all(r.p_sim is None and math.isfinite(r.local_i) for r in got)
