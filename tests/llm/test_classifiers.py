import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.llm import labelled, ordinal_toxicity, quality_nbsvm
from tests.conftest import SF_ORACLE
from tests.llm.fixtures import awkward, frame, prose, with_clashes


def labelled_rows(n=300):
    rnd, docs, labels = random.Random(1), [], []
    for i in range(1000, 1000 + n):
        bad, rude = rnd.random() < 0.3, rnd.random() < 0.3
        t = prose(rnd.randint(5, 60), i).split(" ")
        if rude:
            t[rnd.randrange(len(t)):0] = rnd.sample(["dolt", "oaf", "cretin", "lout"], rnd.randint(2, 4))
        docs.append((i, " ".join(w + "%%%" if bad else w for w in t)))
        labels.append((i, int(not bad), int(rude)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = labelled_rows()
    return (frame(spark, docs + awkward()),
            spark.createDataFrame([*labels, (1000, None, None), (None, 1, 0), (7, 1, 0), (7, 1, 0)],
                                  "doc_id long, quality int, toxic int"), {i: (q, t) for i, q, t in labels})


def test_quality_separates_held_out_rows(tables):
    docs, labels, truth = tables
    model = quality_nbsvm.fit(docs, labels)
    rows = quality_nbsvm.score(with_clashes(docs, "model", "score"), model).withColumn(
        "out", labelled.fold(F.col("doc_id")) == 0).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    out = [((r.score >= 0.3) == truth[r.doc_id][0]) for r in rows if r.out and r.doc_id in truth]
    assert len(out) > 30 and np.mean(out) > 0.95
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1      # null and empty alike


def test_toxicity_separates_held_out_rows(tables):
    docs, labels, truth = tables
    rows = ordinal_toxicity.score(with_clashes(docs, "grade", "ids"), ordinal_toxicity.fit(docs, labels)).withColumn(
        "out", labelled.fold(F.col("doc_id")) == 0).collect()
    assert len(rows) == docs.count() and all(0 <= r.p_toxic <= 1 and 0 <= r.expected_severity <= 2 for r in rows)
    out = [((r.p_toxic >= 0.5) == truth[r.doc_id][1]) for r in rows if r.out and r.doc_id in truth]
    assert np.mean(out) > 0.9


@pytest.mark.parametrize("module", [quality_nbsvm, ordinal_toxicity])
def test_without_labels_or_with_one_class(spark, module):
    docs = frame(spark, awkward())
    label = "quality" if module is quality_nbsvm else "toxic"
    for given in ([], [(i, 1, 0) for i in range(4, 12)]):
        labels = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
        scored = module.score(docs, module.fit(docs, labels, label))
        assert scored.count() == len(awkward())
    assert module.score(frame(spark, []), module.fit(docs, labels, label)).count() == 0


def test_quality_on_the_given_tables(spark):
    rows = quality_nbsvm.op4_quality_nbsvm(spark, SF_ORACLE).join(
        spark.read.parquet(f"{SF_ORACLE}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    rows = [np.unique(np.append(rng.integers(1, 40, 6), 0)).astype(np.int32) for _ in range(80)]
    y = np.array([int(r.sum() % 2) for r in rows])
    ratio = np.ones(quality_nbsvm._SIZE)
    w = quality_nbsvm.dual_coordinate_descent(rows, y, ratio, epochs=3000, tol=1e-7)
    sign = np.where(y > 0, 1, -1)
    loss = lambda v: 0.5 * v @ v + sum(
        max(0.0, 1 - s * v[r].sum() / np.sqrt(len(r))) for r, s in zip(rows, sign))
    best = loss(w)
    for _ in range(300):
        v = w.copy()
        v[:40] += rng.normal(0, 0.02, 40)
        assert loss(v) >= best - 1e-6


def test_ordinal_model_recovers_order_and_thresholds():
    rng = np.random.default_rng(4)
    w = rng.normal(0, 1.5, 30)
    rows = [np.flatnonzero(rng.random(30) < 0.3) for _ in range(4000)]
    eta = np.array([w[r].sum() for r in rows])
    u = rng.random(4000)
    grades = (u[:, None] > 1 / (1 + np.exp(-(np.array([-1.0, 0.5, 2.0]) - eta[:, None])))).sum(axis=1)
    m = ordinal_toxicity.Ordinal(4, 30).fit(rows, grades, steps=600)
    assert np.corrcoef(m.w, w)[0, 1] > 0.97
    assert np.abs(m.thresholds() - [-1.0, 0.5, 2.0]).max() < 0.5 and (np.diff(m.thresholds()) > 0).all()
    assert np.allclose(m.probabilities(eta).sum(axis=1), 1)


def test_sample_is_bounded_and_leaves_the_held_out_fold(tables):
    docs, labels, _ = tables
    got = labelled.sample(docs, labels, "quality", 50).withColumn("f", labelled.fold(F.col("doc_id"))).collect()
    assert 0 < len({r.doc_id for r in got}) <= 50 and all(r.f != 0 for r in got)
