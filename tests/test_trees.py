"""Tree learners that grow together: the same models as Spark's and as fits of their own, from few passes."""

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from fathom.operators import crossval, ml, trees
from tests.conftest import SF_SMALL

X = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rnd = np.random.default_rng(4)
    n = 900
    a, b, c = rnd.integers(0, 60, n).astype(float), rnd.exponential(size=n), rnd.integers(0, 4, n).astype(float)
    y = 1e4 + 3 * a + 40 * (b > 1) * c + rnd.normal(size=n)
    rows = [(*map(float, r), int(k)) for r, k in zip(np.column_stack([a, b, c, y]), rnd.integers(0, 3, n))]
    return ml.assemble(spark.createDataFrame(rows, "a double, b double, c double, label double, fold int"), X).cache()


def _values(df):
    return {(r.a, r.b, r.c): r.prediction for r in df.collect()}


@pytest.mark.parametrize("kind, options", [
    (DecisionTreeRegressor, {"maxDepth": 5}), (DecisionTreeRegressor, {"maxDepth": 9, "minInstancesPerNode": 11, "maxBins": 16}),
    (DecisionTreeRegressor, {"maxDepth": 4, "minInfoGain": 5.0}), (GBTRegressor, {"maxIter": 6, "maxDepth": 3, "stepSize": 0.3}),
    (RandomForestRegressor, {"numTrees": 1, "maxDepth": 4, "bootstrap": False})])
def test_predictions_are_those_of_spark(table, kind, options):
    estimator = kind(seed=1, labelCol="label", **options)
    want = _values(estimator.fit(table).transform(table))
    got = _values(trees.fit_one(table, "label", trees.spec(estimator)).transform(table))
    assert list(got) == list(want) and np.allclose(list(got.values()), list(want.values()), rtol=1e-9)


def test_forest_is_the_mean_of_trees_on_rows_drawn_with_replacement(spark, monkeypatch):
    """Against trees on copies of the rows, as often as the hash draws them; few values, so the thresholds are the same."""
    rnd = np.random.default_rng(6)
    d = spark.createDataFrame([(*map(float, rnd.integers(0, 9, 3)), float(rnd.normal()), 0) for _ in range(500)],
                              "a double, b double, c double, label double, fold int")
    d = ml.assemble(d, X)
    monkeypatch.setattr(trees, "BLOCK", 64)
    cell = trees.cells(d, "label", {"fold": 1}, 32)
    forest = trees.spec(RandomForestRegressor(numTrees=3, maxDepth=4, featureSubsetStrategy="all", seed=9))
    (model,), _ = trees.fit(cell, [(forest, "fold", np.array([True]))])
    assert [w for w, _ in model] == [1 / 3] * 3
    rows = cell.rows.toPandas()
    bins = np.stack([rows["cell"] // s % n for s, n in zip(cell.strides, cell.sizes)])
    for j, (_, tree) in enumerate(model):
        drawn = trees.bootstrap(rows["id"].to_numpy(), (9, j))
        copies = spark.createDataFrame([(*map(float, v), float(y)) for v, y, k in zip(bins.T, rows["label"], drawn) for _ in range(k)],
                                       "a double, b double, c double, label double")
        own = DecisionTreeRegressor(maxDepth=4).setLabelCol("label").fit(ml.assemble(copies, X))
        at = ml.assemble(spark.createDataFrame([tuple(map(float, v)) for v in bins.T], "a double, b double, c double"), X)
        assert np.allclose(tree.predict(bins) + cell.mean, [r.prediction for r in own.transform(at).collect()])


def test_bootstrap_numbers_are_poisson():
    n = 400_000
    drawn = [trees.bootstrap(np.arange(n), (42, j)) for j in range(2)]
    for w in drawn:
        assert np.allclose(np.bincount(w, minlength=6)[:6] / n, [np.exp(-1) / f for f in (1, 1, 2, 6, 24, 120)], atol=4e-3)
    assert abs(np.corrcoef(*drawn)[0, 1]) < 0.01
    assert (trees.bootstrap(np.arange(100, 200), (42, 1)) == drawn[1][100:200]).all()


def test_boosting_in_passes_is_boosting_on_the_driver(table, monkeypatch):
    boosted = trees.spec(GBTRegressor(maxIter=4, maxDepth=2, seed=1))
    cell = trees.cells(table, "label", {"fold": 3}, 32)
    fits = [(boosted, "fold", np.arange(3) != f) for f in range(3)]
    near, _ = trees.fit(cell, fits)
    monkeypatch.setattr(trees, "LOCAL", 0)
    far, _ = trees.fit(cell, fits)
    for m, q in zip(near, far):
        assert [t.feature for _, t in m] == [t.feature for _, t in q] and [t.cut for _, t in m] == [t.cut for _, t in q]
        assert np.allclose(np.concatenate([t.value for _, t in m]), np.concatenate([t.value for _, t in q]))


def test_many_values_take_thresholds_from_quantiles(table, monkeypatch):
    monkeypatch.setattr(trees, "VALUES", 30)
    cell = trees.cells(table, "label", {"fold": 3}, 8)
    b = np.array([r.b for r in table.select("b").collect()])
    assert np.allclose(cell.limits[1], np.quantile(b, np.arange(1, 8) / 8)) and len(cell.limits[2]) == 3


def test_scores_are_those_of_single_fits_without_a_fit_of_sparks(table, monkeypatch):
    """Every split of every scheme, trees from one growth and linear models from Gram matrices."""
    learners = {"tree": lambda: DecisionTreeRegressor(maxDepth=3, maxBins=32, seed=1), "ols": lambda: LinearRegression(),
                "net": lambda: LinearRegression(regParam=3.0, elasticNetParam=0.4),
                "ridge": lambda: LinearRegression(regParam=3.0, standardization=False)}
    few = table.withColumn("a", F.floor(F.col("a") / 6).cast("double")).withColumn("b", F.floor("b").cast("double")).drop("features")
    few = ml.assemble(few, X)                                          # few values: thresholds do not depend on the split
    schemes = [crossval.Scheme("s", ("fold",), 3), crossval.Scheme("t", ("fold",), 3, expanding=True)]
    keys = ["scheme", "fold", "learner", "part"]
    want = crossval._fit_scores(few, "label", learners, schemes, 4).toPandas().sort_values(keys)
    for kind in (DecisionTreeRegressor, LinearRegression):
        monkeypatch.setattr(kind, "fit", lambda *args: pytest.fail("a fit of its own"))
    got = crossval.estimator_scores(few, "label", learners, schemes).toPandas().sort_values(keys)
    assert got[keys].to_numpy().tolist() == want[keys].to_numpy().tolist() and (got["n"].to_numpy() == want["n"].to_numpy()).all()
    for c in ("rmse", "mae", "r2"):
        assert np.allclose(got[c], want[c], rtol=1e-5), c


def _no_fit(monkeypatch, *kinds):
    for kind in kinds:
        monkeypatch.setattr(kind, "fit", lambda *args: pytest.fail("a fit of its own"))


def test_cv_learner_table_has_no_fit_per_split(spark, monkeypatch):
    from fathom.plans import selection
    _no_fit(monkeypatch, DecisionTreeRegressor, RandomForestRegressor)
    rows = selection.cv_learner_table(spark, SF_SMALL).collect()
    assert {(r.scheme, r.learner) for r in rows} == {(s, m) for s in ("shuffled", "time", "space") for m in ("linear", "tree_6", "forest_20")}


def test_randomised_search_has_no_fit_per_candidate(spark, monkeypatch):
    from fathom.plans import selection
    _no_fit(monkeypatch, DecisionTreeRegressor, RandomForestRegressor, GBTRegressor)
    rows = selection.randomised_search(spark, SF_SMALL).collect()
    assert len(rows) == 12 and sorted(r.place for r in rows) == list(range(1, 13))
    best = min(rows, key=lambda r: r.place)
    assert best.refit_test_rmse > 0 and all(r.refit_test_rmse is None for r in rows if r is not best)


def test_regressor_screening_keeps_no_rows_in_memory(spark, monkeypatch):
    from pyspark.sql import DataFrame
    from fathom.plans import models
    _no_fit(monkeypatch, DecisionTreeRegressor, RandomForestRegressor, GBTRegressor)
    for name in ("cache", "persist"):
        monkeypatch.setattr(DataFrame, name, lambda *args, **kw: pytest.fail("rows kept in memory"))
    rows = models.regressor_screening(spark, SF_SMALL).collect()
    assert {r.model for r in rows} == {"ols", "ridge_alpha1", "lasso_alpha1", "elastic_net", "huber", "decision_tree", "random_forest",
                                       "bagged_trees", "gradient_boosting"}
    assert [r.test_rmse for r in rows] == sorted(r.test_rmse for r in rows)
