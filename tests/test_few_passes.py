"""Operators whose work must not grow with rounds, trees or models: same results, few passes over the rows."""

import numpy as np
import pytest

from fathom.operators import kernels, ml


def test_mice_rounds_take_no_pass_over_the_rows(spark, monkeypatch):
    rnd = np.random.default_rng(7)
    a = rnd.normal(size=200)
    x = np.stack([a, a + .1 * rnd.normal(size=200), 2 * a + .1 * rnd.normal(size=200), 50 + rnd.normal(size=200)], axis=1)
    miss = rnd.random(x.shape) < .3
    data = [(i, *[None if m else float(v) for v, m in zip(r, q)], "kept") for i, (r, q) in enumerate(zip(x, miss))]
    data += [(200, float("nan"), None, 1.0, 50.0, "kept"), (201, None, None, None, None, None)]
    cols = ["a", "b", "c", "d"]
    d = spark.createDataFrame(data, "k int, a double, b double, c double, d double, note string")
    start = dict.fromkeys(cols, 0.5)
    want = kernels._mice_by_rows(d, cols, 10, start).orderBy("k").collect()
    calls = []
    monkeypatch.setattr(ml, "gram", lambda *args, **kw: calls.append(args))
    got = kernels.mice(d, cols, start=start)
    assert not calls and got.columns == d.columns
    got = got.orderBy("k").collect()
    assert [r.note for r in got] == [r.note for r in want]
    assert np.allclose([[r[c] for c in cols] for r in got], [[r[c] for c in cols] for r in want], rtol=1e-7, atol=1e-9, equal_nan=True)
    assert [got[0][c] for c, m in zip(cols, miss[0]) if not m] == [float(v) for v, m in zip(x[0], miss[0]) if not m]


def _walk(nodes, row):
    """Path length of a row, node by node."""
    from fathom.operators import iforest
    at, depth = 0, 0
    while nodes[at].feature >= 0:
        at = nodes[at].left if row[nodes[at].feature] < nodes[at].threshold else nodes[at].right
        depth += 1
    return depth + iforest._c(nodes[at].size)


def test_isolation_scores_are_those_of_a_walk_down_each_tree(spark):
    from fathom.operators import iforest
    rnd = np.random.default_rng(5)
    x = np.column_stack([rnd.normal(size=400), rnd.integers(0, 4, 400), rnd.exponential(size=400)])
    x[3, 0], x[4, 2], x[5, 2] = np.nan, np.inf, -np.inf
    d = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double, c double")
    forest = iforest.fit(d.where("k > 5"), ["a", "b", "c"], ["k"], n_trees=7, psi=64).cache()
    trees = {}
    for r in forest.orderBy("tree", "node").collect():
        trees.setdefault(r.tree, []).append(r)
    assert len(trees) == 7
    got = {r.k: r.anomaly_score for r in iforest.score(d, forest, ["a", "b", "c"], 64).collect()}
    for i, row in enumerate(x):
        mean = sum(_walk(nodes, row) for nodes in trees.values()) / 7
        assert got[i] == pytest.approx(2.0 ** (-mean / iforest._c(64)), rel=1e-12)


def test_isolation_forest_scores_the_rows_once(spark, monkeypatch):
    """Cut and counts read stored scores."""
    from fathom.operators import iforest
    from fathom.plans import models
    from tests.conftest import SF_SMALL
    kept, scored = [], []
    made, store = iforest.score, models.stored
    monkeypatch.setattr(iforest, "score", lambda *args, **kw: scored.append(made(*args, **kw)) or scored[-1])
    monkeypatch.setattr(models, "stored", lambda df, what: kept.append(what) or store(df, what))
    row = models.isolation_forest(spark, SF_SMALL).first()
    assert len(scored) == 1 and kept == ["scores"]
    assert 0 < row.n_outliers <= 0.03 * row.n + 1


def test_isolation_samples_are_drawn_by_the_hash_of_key_and_tree(spark):
    """Each tree's leaves hold the rows that its hash chose; no expression hashes the key once for each tree."""
    from pyspark.sql import functions as F
    from fathom.operators import iforest
    d = spark.range(900).selectExpr("id AS k", "cast(id AS double) AS a", "cast(id * 7 % 31 AS double) AS b")
    forest = iforest.fit(d, ["a", "b"], ["k"], n_trees=5, psi=32)
    cut = int(2.0 * 32 / 900 * 2 ** 31)
    hits = d.crossJoin(spark.range(5).selectExpr("cast(id AS int) AS tree")).where(
        F.pmod(F.xxhash64(F.col("k").cast("string"), "tree"), F.lit(2 ** 31)) < cut).groupBy("tree").count()
    want = {r.tree: min(r["count"], 32) for r in hits.collect()}
    got = {r.tree: r.s for r in forest.where("feature < 0").groupBy("tree").agg(F.sum("size").alias("s")).collect()}
    assert got == want and len(got) == 5
    assert "lambdafunction" not in forest._jdf.queryExecution().analyzed().toString()
    keys = spark.createDataFrame([("1-2",), ("",), (None,), ("é-9",)], "k string")
    for t in (0, 1, 99, 2 ** 31 - 1):
        rows = keys.select(F.xxhash64("k").alias("s"), F.xxhash64("k", F.lit(t)).alias("h")).collect()
        assert iforest._hashed(np.array([r.s for r in rows]).view(np.uint64), t).view(np.int64).tolist() == [r.h for r in rows]


def test_stacked_fits_read_narrow_stored_rows(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from fathom.plans import models
    from tests.conftest import SF_ORACLE
    files, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *args: files.append(df.inputFiles()) or fit(self, df, *args))
    rows = {r.model: r for r in models.ensemble_stack_calibrate(spark, SF_ORACLE).collect()}
    assert list(rows) == ["lr", "rf", "vote", "stack", "platt", "isotonic"]
    assert len(files) == 4 and all("/rows-" in f for fs in files for f in fs)
    d = models.doc_table(spark, SF_ORACLE)
    test = LogisticRegression(regParam=0.01).fit(d.where("split = 'train'")).transform(d.where("split = 'test'"))
    p = [(r.probability[1], r.label) for r in test.select("probability", "label").collect()]
    assert rows["lr"].test_brier == pytest.approx(sum((a - y) ** 2 for a, y in p) / len(p), rel=1e-6)
    pairs = [(a > b) + 0.5 * (a == b) for a, y in p if y == 1 for b, z in p if z == 0]
    assert rows["lr"].test_auc == pytest.approx(sum(pairs) / len(pairs), rel=1e-6)


def test_knn_models_gather_lines_and_neighbours_once(spark, monkeypatch):
    from fathom.operators import neighbors
    from fathom.plans import models
    from tests.conftest import SF_SMALL
    kept, files, store, knn = [], [], models.stored, neighbors.knn
    monkeypatch.setattr(models, "stored", lambda df, what: kept.append(what) or store(df, what))
    monkeypatch.setattr(neighbors, "knn", lambda q, r, *a, **kw: files.append([*q.inputFiles(), *r.inputFiles()]) or knn(q, r, *a, **kw))
    rows = models.knn_models(spark, SF_SMALL).collect()
    assert [(r.model, r.metric) for r in rows[2:]] == [
        (m, v) for m in ("knn_regressor_k7_distance", "knn_regressor_k5_uniform") for v in ("rmse", "r2")]
    assert kept == ["lines", "neighbours"] and len(files) == 2 and all("/lines-" in f for f in files[1])
    li = models._std_lineitem(spark, SF_SMALL).select(*models.REG_FEATURES, "label", "split", *models.LINE_KEY).collect()
    train, test = ([r for r in li if r.split == part] for part in ("train", "test"))
    x, y = np.array([r[:4] for r in train]), np.array([r.label for r in train])
    keys = np.array(["-".join(str(v) if c != "l_linenumber" else str(float(v)) for c, v in zip(models.LINE_KEY, r[6:])) for r in train])
    e2 = []
    for r in test:
        d = np.sqrt(((x - np.array(r[:4])) ** 2).sum(axis=1))
        e2.append((r.label - y[np.lexsort((keys, np.round(d, 12)))[:5]].mean()) ** 2)
    assert rows[4].value == pytest.approx(np.mean(e2) ** 0.5, rel=1e-2)      # ties in distance may fall otherwise
