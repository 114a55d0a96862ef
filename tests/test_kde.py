"""Kernel density without a cut-off against plain sums in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import kde

POINT = "id long, lat double, lon double"


def brute(points, ref, h):
    """log density by log-sum-exp over all pairs."""
    p, r = np.array(points, dtype=float), np.array(ref, dtype=float)
    e = -((p[:, None, :] - r[None, :, :]) ** 2).sum(-1) / (2 * h * h)
    top = e.max(axis=1)
    return top + np.log(np.exp(e - top[:, None]).sum(axis=1)) - math.log(len(r) * 2 * math.pi * h * h)


def scores(spark, points, ref, h):
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], POINT)
    base = spark.createDataFrame([tuple(map(float, r)) for r in ref], "lat double, lon double")
    got = {r.id: r.log_density for r in kde.log_density(df, base, h).collect()}
    return np.array([got[i] for i in range(len(points))])


@pytest.mark.parametrize("h", [0.3, 2.0, 50.0])
def test_equals_all_pairs(spark, h):
    rng = np.random.default_rng(1)
    ref = np.concatenate([rng.normal(0, 1, (700, 2)), rng.normal((30, 40), 0.2, (500, 2)), rng.uniform(-60, 60, (80, 2))])
    points = np.concatenate([ref[::9], rng.uniform(-90, 90, (60, 2)), [(1e3, 1e3), (-89, 200)]])   # the last ones far from all
    got, want = scores(spark, points, ref, h), brute(points, ref, h)
    # the error of a sum is 2e-11 of it; beyond that the rounding of large exponents
    assert np.abs(got - want).max() < 1e-10 + 4e-16 * np.abs(want).max() * 8


def test_far_points_keep_their_order(spark):
    """What a cut at some bandwidths would make equal or NULL."""
    got = scores(spark, [(0, 10.0 * k) for k in range(1, 7)], [(0, 0), (0, 0.5), (0, 0)], 1.0)
    assert all(a > b for a, b in zip(got, got[1:])) and got[-1] < -1500


def test_one_cell_with_most_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(kde, "AT_ONCE", 50)          # points of a cell are dealt to several tasks
    rng = np.random.default_rng(2)
    ref = np.concatenate([rng.normal(0, 1e-3, (4000, 2)), [(0.5, 0.5)] * 3])
    points = np.concatenate([ref[:300], [(0.5, 0.5)] * 5, [(4.0, -3.0)]])
    assert np.abs(scores(spark, points, ref, 1.0) - brute(points, ref, 1.0)).max() < 1e-10


def test_pairs_of_cells_do_not_grow_with_the_rows(spark):
    rng = np.random.default_rng(3)
    sizes = []
    for n in (2000, 20_000):
        xy = spark.createDataFrame([(0, float(a), float(b)) for a, b in rng.uniform(0, 6, (n, 2))], "g long, x double, y double")
        cells = xy.select("g", kde._cell("x", kde.SIDE).alias("tx"), kde._cell("y", kde.SIDE).alias("ty")).distinct()
        sizes.append(sum(f.count() for _, f in kde._cell_pairs(cells, xy, n, kde.ETA)))
    assert sizes[1] < 1.5 * sizes[0]


def test_without_coordinates_or_references(spark):
    points = spark.createDataFrame([(1, None, 1.0), (2, 1.0, 1.0), (2, 1.0, 1.0), (None, 1.0, 1.0)], POINT)
    none = spark.createDataFrame([], "lat double, lon double")
    ref = spark.createDataFrame([(1.0, 1.0), (None, 2.0)], "lat double, lon double")
    want = -math.log(2 * math.pi)
    got = [(r.id, r.log_density) for r in kde.log_density(points, ref, 1.0).collect()]
    assert len(got) == 4 and all(d is None if i == 1 else abs(d - want) < 1e-11 for i, d in got)
    assert [r.log_density for r in kde.log_density(points, none, 1.0).collect()] == [None] * 4
    assert kde.log_density(points.where(F.lit(False)), ref, 1.0).count() == 0


def test_bandwidth_scores(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), i % 3) for i, (a, b) in enumerate(rng.normal(0, 2, (150, 2)))]
    got = {r.bandwidth: (r.mean_log_likelihood, r.n_scored) for r in kde.bandwidth_scores(
        spark.createDataFrame(rows, "lat double, lon double, fold int"), [0.05, 1.0, 30.0]).collect()}
    for h, (mean, n) in got.items():
        ll = np.concatenate([brute([r[:2] for r in rows if r[2] == f], [r[:2] for r in rows if r[2] != f], h) for f in range(3)])
        assert n == 150 and abs(mean - ll.mean()) < 1e-9
    assert max(got, key=got.get) == 1.0


def test_a_block_gets_each_bundle_once(spark):
    """What travels goes to blocks of many cells, not to each cell of targets by itself."""
    rng = np.random.default_rng(5)
    xy = spark.createDataFrame([(0, float(a), float(b)) for a, b in rng.uniform(0, 30, (6000, 2))], "g long, x double, y double")
    cells = xy.select("g", kde._cell("x", kde.SIDE).alias("tx"), kde._cell("y", kde.SIDE).alias("ty")).distinct()
    assert sum(f.count() for _, f in kde._cell_pairs(cells, xy, 6000, kde.ETA)) < 2 * 6000


def test_bundles_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(kde, "BUSY", 300)
    rng = np.random.default_rng(6)
    ref = np.concatenate([rng.normal(0, 0.05, (1500, 2)), rng.normal(0, 3, (500, 2))])
    points = np.concatenate([ref[::20], rng.uniform(-20, 20, (80, 2))])
    assert np.abs(scores(spark, points, ref, 1.0) - brute(points, ref, 1.0)).max() < 1e-10


def test_points_close_together_share_their_sums(monkeypatch):
    """Sums are made at nodes where many points lie together, and cells' expansions only as long as their share asks for."""
    rng = np.random.default_rng(7)
    ref = np.column_stack([rng.uniform(0, 2 * kde.SIDE, 4000), rng.uniform(0, kde.SIDE, 4000)])
    keys = np.column_stack([np.zeros(4000, dtype=np.int64), np.zeros(4000, dtype=np.int64), np.floor(ref / kde.SIDE).astype(np.int64)])
    rows = kde.pa.RecordBatch.from_arrays([kde.pa.array(c) for c in (*keys.T, *ref.T)], names=["g", "level", "cx", "cy", "x", "y"])
    bundles, asked = kde.pa.Table.from_batches(list(kde._build(iter([rows])))), []
    for name, size in (("log_sums", lambda x, y: len(x)), ("grid_sums", lambda x, y: len(x) * len(y))):
        monkeypatch.setattr(kde._Cells, name, lambda self, x, y, *more, of=getattr(kde._Cells, name), size=size: (
            asked.append(size(x, y)), of(self, x, y, *more))[1])
    made = []
    for n in (30_000, 60_000):
        asked.clear()
        points = rng.uniform(0, kde.SIDE, (n, 2))
        got = kde._evaluate(points[:, 0], points[:, 1], bundles, kde.ETA)
        made.append(sum(asked))
        some = points[::100]
        assert np.abs(got[::100] - brute(some, ref, 1.0) - math.log(4000 * 2 * math.pi)).max() < 1e-10
    assert made[1] < 1.1 * made[0] < 0.5 * 30_000
