"""Whitening against plain numpy on small tables, and the refinement on matrices with clustered eigenvalues."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.llm import QUERIES, whitening
from tests.conftest import SF_SMALL
from tests.llm.fixtures import with_clashes

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """(distinct x, mean, eigenvalues falling, vectors) of the usable rows by plain numpy."""
    x = np.array(sorted({tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in rows}), dtype=np.float64)
    y = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / len(x))
    return x, x.mean(axis=0), values[::-1], vectors[:, ::-1]


def test_query_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    x, mean, values, vectors = brute([r.embedding for r in rows])
    got = QUERIES["op11_mixed_precision_whitening"](spark, SF_SMALL).collect()
    assert len(got) == 16 * len(rows)
    one = {r.vec_id: np.floor(64 * np.array(r.embedding, dtype=np.float64)) + 1_000_000 for r in rows}
    by = {(r.vec_id, r.component): r for r in got}
    white = np.array([[by[i, k + 1].whitened for k in range(16)] for i in one])
    want = (np.array(list(one.values())) - mean) @ (vectors[:, :16] / np.sqrt(values[:16]))
    signs = np.sign((white * want).sum(axis=0))
    assert np.abs(white - want * signs).max() < 1e-9
    assert {r.n for r in got} == {len(x)} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    sums = [int(s) for s in x.sum(axis=0)]
    for r in got[::97]:
        assert r.deviation == sum((len(x) * int(a) - s) ** 2 for a, s in zip(one[r.vec_id], sums))
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)


@pytest.mark.parametrize("values", [
    [9, 5, 3, 2, 1, 0.5, 0.25, 0.1],
    [5, 5, 5, 1, 1, 0.5, 0.5, 0.1],                                  # equal
    [5, 5 + 1e-9, 5 + 2e-9, 1, 1 + 1e-11, 1e-3, 1e-3 + 1e-10, 0],    # clusters narrower than float32
    [1, 1 + 1e-7, 1 + 2e-7, 1 + 3e-7, 1 + 4e-7, 1 + 5e-7, 1 + 6e-7, 1 + 7e-7],
])
def test_refinement_gives_double_precision(values):
    wide = whitening.WIDE
    q = np.linalg.qr(np.random.default_rng(4).normal(size=(8, 8)))[0].astype(wide)
    for _ in range(4):                                               # orthogonal in extended precision too
        q = q @ (1.5 * np.eye(8, dtype=wide) - 0.5 * (q.T @ q))
    a = (q * np.array(values, dtype=wide)) @ q.T
    a = (a + a.T) / 2
    rough = np.linalg.eigh(a.astype(np.float32))[1]
    got, x = whitening.refined(a, rough)
    assert np.abs(x.T @ x - np.eye(8)).max() < 1e-17
    assert np.abs(np.sort(got) - np.sort(np.array(values, dtype=wide))).max() < 1e-16
    assert np.abs(a @ x - x * got).max() < 1e-17
    assert np.abs((a @ rough.astype(wide) - rough * got)).max() > 1e-9 or len(set(values)) < 5


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0]), (2, [1.0, 0.5]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.5]),
            (7, [1.0, 0.5]), (None, [-0.25, 0.125]), (8, [1.0]), (9, []), (10, [1.0, 2.0, 3.0]), (11, [0.3, -0.7])]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA), "whitened", "deviation", "n", "i")
    model = whitening.fit(df)
    got = whitening.transform(df, model).collect()
    usable = [v for i, v in rows if i in (1, 2, 7, None, 11)]
    assert sorted(str(r.vec_id) for r in got) == sorted(["1", "2", "7", "7", "None", "11"])
    x, mean, values, vectors = brute([[np.float32(c) for c in v] for v in usable])
    assert model.n == 4 and model.dim == 2 and np.allclose(model.values, values, rtol=1e-14)
    assert all(len(r.whitened) == 2 and r.n == "clash" for r in got)
    same = [r for r in got if r.vec_id in (2, 7)]
    assert len({(tuple(r.whitened), r.deviation) for r in same}) == 1


def test_one_vector_and_none(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], SCHEMA)
    model = whitening.fit(df)
    assert model.n == 1 and not len(model.values)
    assert [(r.deviation, r.whitened) for r in whitening.transform(df, model).collect()] == [(0, [])] * 2
    empty = df.where(F.lit(False))
    assert whitening.transform(empty, whitening.fit(empty)).count() == 0


def test_flat_directions_have_no_component(spark):
    df = spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0]) for i in range(9)], SCHEMA)
    model = whitening.fit(df)
    assert len(model.values) == 1 and model.identity_error < 1e-12


def test_huge_entries_stay_exact(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 3e38])]
    df = spark.createDataFrame(rows, SCHEMA)
    model = whitening.fit(df)
    assert model.n == 3 and model.identity_error < 1e-9
    assert [r.deviation for r in whitening.transform(df, model).collect()] == [None] * 3   # beyond a long
