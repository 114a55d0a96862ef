"""Penalty paths, cross-validated tables and random search against plain numpy on the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import crossval, penalty, search

NAMES = [f"x{i}" for i in range(6)]


def _rows(n=200, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 6)) * [1, 10, 0.1, 1, 1, 1] + [0, 100, 0, 0, 0, 0]
    x[:, 4] = x[:, 3] + rng.normal(0, 0.1, n)                        # nearly the same
    y = 3 * x[:, 0] + 0.2 * x[:, 1] + x[:, 3] + rng.normal(0, 1, n)
    return x, y, np.arange(n) % 5


@pytest.fixture(scope="module")
def frame(spark):
    x, y, fold = _rows()
    rows = [(*map(float, r), float(t), int(f)) for r, t, f in zip(x, y, fold)]
    rows.append((None, *[1.0] * 5, 1.0, 0))                          # left out
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in NAMES) + ", label double, fold int")


def _slow(z, y, a, share, rounds=20000):
    """Proximal gradient steps on the rows themselves."""
    n = len(y)
    mean, label = z.mean(axis=0), y.mean()
    z, y = z - mean, y - label
    w, size = np.zeros(z.shape[1]), 1 / (np.linalg.norm(z, 2) ** 2 / n + a * (1 - share))
    for _ in range(rounds):
        g = w - size * (z.T @ (z @ w - y) / n + a * (1 - share) * w)
        w = np.sign(g) * np.maximum(np.abs(g) - size * a * share, 0)
    return np.concatenate([[label - mean @ w], w])


def test_choice_equals_a_slow_solver_on_the_rows(frame):
    x, y, fold = _rows()
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    grid = penalty.log_grid(-2, 1, 5)
    got = penalty.choose(frame, NAMES, "label", "fold", 5, grid, {"lasso": [1.0], "mixed": [0.3, 0.9], "ridge": [0.0]})

    def best(share, solve):
        mse = [np.mean([np.mean((y[fold == f] - np.column_stack([np.ones((fold == f).sum()), z[fold == f]])
                                 @ solve(z[fold != f], y[fold != f], a)) ** 2) for f in range(5)]) for a in grid]
        return min(mse), grid[int(np.argmin(mse))]

    lasso = best(1.0, lambda a, b, p: _slow(a, b, p, 1.0))
    assert (got["lasso"].cv_mse.min(), got["lasso"].penalty) == pytest.approx(lasso, rel=1e-6)
    refit = _slow(z, y, got["lasso"].penalty, 1.0)
    assert got["lasso"].zeroed == int((refit[1:] == 0).sum())
    assert got["lasso"].coefficients == pytest.approx(refit, abs=1e-6)
    mixed = {s: best(s, lambda a, b, p, s=s: _slow(a, b, p, s)) for s in (0.3, 0.9)}
    share = min(mixed, key=mixed.get)
    assert (got["mixed"].share, got["mixed"].penalty) == (share, mixed[share][1])

    def ridge(a, b, p):
        c = a - a.mean(axis=0)
        w = np.linalg.solve(c.T @ c + p * np.eye(6), c.T @ (b - b.mean()))
        return np.concatenate([[b.mean() - a.mean(axis=0) @ w], w])
    assert (got["ridge"].cv_mse.min(), got["ridge"].penalty) == pytest.approx(best(0.0, ridge), rel=1e-8)
    assert got["ridge"].coefficients == pytest.approx(ridge(z, y, got["ridge"].penalty), rel=1e-8, abs=1e-10)


def test_large_penalties_zero_everything(frame):
    got = penalty.choose(frame, NAMES, "label", "fold", 5, [1e6], {"lasso": [1.0]})["lasso"]
    assert got.zeroed == 6 and got.coefficients[0] == pytest.approx(_rows()[1].mean())


SCHEMES = [crossval.Scheme("plain", ("fold",), 5), crossval.Scheme("twice", ("fold", "other"), 5),
           crossval.Scheme("time", ("fold",), 5, expanding=True)]
LEARNERS = {"mean": crossval.Linear(), "two": crossval.Linear(("x0", "x1")), "ridge": crossval.Linear(tuple(NAMES), 5.0)}


def test_linear_scores_equal_a_loop(frame):
    df = frame.withColumn("other", F.pmod(F.col("fold") * 3 + 1, F.lit(5)))
    got = {(r.scheme, r.repeat, r.fold, r.learner, r.part): r for r in crossval.linear_scores(df, NAMES, "label", LEARNERS, SCHEMES).collect()}
    x, y, fold = _rows()
    assert len(got) == (5 + 10 + 4) * 3 * 2
    for (scheme, repeat, i, learner, part), r in got.items():
        f = (fold * 3 + 1) % 5 if repeat else fold
        train = f < i if scheme == "time" else f != i
        cols = [NAMES.index(c) for c in LEARNERS[learner].features]
        mean = x[train][:, cols].mean(axis=0)
        c = x[train][:, cols] - mean
        w = np.linalg.solve(c.T @ c + LEARNERS[learner].alpha * np.eye(len(cols)), c.T @ (y[train] - y[train].mean())) if cols else []
        rows = train if part == "train" else f == i
        e = y[rows] - y[train].mean() - (x[rows][:, cols] - mean) @ w
        assert (r.n, r.rmse, r.mae) == pytest.approx((rows.sum(), np.sqrt(np.mean(e ** 2)), np.abs(e).mean()), rel=1e-9)
        assert r.r2 == pytest.approx(1 - (e ** 2).sum() / ((y[rows] - y[rows].mean()) ** 2).sum(), rel=1e-9, abs=1e-9)


def test_estimators_give_the_same_table_as_gram_matrices(frame):
    from pyspark.ml.regression import LinearRegression
    from fathom.operators import ml
    df = frame.dropna()
    a = crossval.candidate_table(crossval.linear_scores(df, NAMES, "label", {"ols": crossval.Linear(tuple(NAMES))}, SCHEMES[:1])).first()
    scores = crossval.estimator_scores(ml.assemble(df, NAMES), "label", {"ols": lambda: LinearRegression(solver="normal")}, SCHEMES[:1])
    b = crossval.candidate_table(scores).first()
    for c in ("n_splits", "cv_rmse", "cv_rmse_std", "train_rmse", "cv_mae", "cv_r2", "gap", "place"):
        assert b[c] == pytest.approx(a[c], rel=1e-6)
    assert b.fit_seconds > 0


def test_inflation_is_against_the_reference(spark):
    t = spark.createDataFrame([("plain", "m", 2.0), ("time", "m", 3.0)], "scheme string, learner string, cv_rmse double")
    assert [tuple(r) for r in crossval.scheme_inflation(t, "plain").collect()] == [("time", "m", 0.5)]


def test_random_search_draws_and_refits(frame):
    from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
    from fathom.operators import ml
    families = {"line": search.Family(LinearRegression, {"regParam": search.LogUniform(1e-6, 1e-3)}, {}),
                "tree": search.Family(DecisionTreeRegressor, {"maxDepth": search.IntRange(1, 2)}, {"seed": 1})}
    df = ml.assemble(frame.dropna(), NAMES)
    table, model, name = search.random_search(df, "label", families, 2, SCHEMES[0])
    rows = table.orderBy("place").collect()
    assert [r.place for r in rows] == [1, 2, 3, 4] and rows[0].learner == name and name.startswith("line")
    assert rows[0].cv_rmse == min(r.cv_rmse for r in rows) and model.transform(df).count() == 200
    again = families["line"].draw("search", "line", 0)
    assert f"regParam={again['regParam']:.6g}" in {r.parameters for r in rows}
    us = [search.uniform("s", i) for i in range(2000)]
    assert 0 <= min(us) and max(us) < 1 and abs(np.mean(us) - .5) < .03
    assert {search.IntRange(2, 4).at(u) for u in us} == {2, 3, 4} and {search.Choice("ab").at(u) for u in us} == {"a", "b"}
    assert all(1e-3 <= search.LogUniform(1e-3, 10).at(u) <= 10 for u in us)


def test_search_from_gram_matrices_equals_cross_validator(frame):
    """Errors and refit of Spark's CrossValidator, without a fit a fold and candidate."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    from fathom.operators import folds, ml
    df = folds.kfold(ml.assemble(frame.dropna(), NAMES), ["label"], 3, "search").withColumn("label", F.col("label") * 50 + 7)
    lr = LinearRegression(standardization=False, tol=1e-12, maxIter=1000)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.1, 5.0, 40.0]).addGrid(lr.elasticNetParam, [0.0, 0.4, 1.0]).build()
    model = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(metricName="rmse"), foldCol="fold", numFolds=3).fit(df)
    candidates = [(g[lr.regParam], g[lr.elasticNetParam]) for g in grid]
    grams = list(crossval.fold_grams(df, NAMES, "label", {"fold": 3}).values())
    found = penalty.search(grams, candidates)
    assert found.cv_rmse == pytest.approx(np.array(model.avgMetrics), rel=1e-6)
    for g, (reg, share) in zip(grid, candidates):
        m = lr.copy(g).fit(df)
        assert penalty.spark_linear(sum(grams), reg, share) == pytest.approx(np.array([m.intercept, *m.coefficients]), rel=1e-4, abs=1e-6)
    assert found.coefficients[1:] == pytest.approx(np.array(model.bestModel.coefficients), rel=1e-4, abs=1e-6)


def test_penalty_queries_put_no_rows_in_order(spark, monkeypatch):
    """Only the queries with folds of time need all rows sorted; the other folds are the same without."""
    from fathom.operators import folds
    from fathom.plans import selection
    sf = "/root/testdata/sf0.001"
    full, plain = selection.priced_lines(spark, sf), selection.priced_lines(spark, sf, ordered=False)
    assert full.select(*plain.columns).exceptAll(plain).isEmpty() and full.count() == plain.count()
    monkeypatch.setattr(folds, "ordered_tiles", lambda *a, **k: pytest.fail("rows were put in order"))
    assert selection.penalty_choice(spark, sf).count() and selection.coefficient_paths(spark, sf).count()


def test_learning_curve_scores_the_rows_once(spark):
    """The table is made from stored scores, not from a second and third pass over the rows."""
    from fathom.plans import diagnostics
    t = diagnostics.learning_curve(spark, "/root/testdata/sf0.001")
    assert t.count() == len(diagnostics.FRACTIONS) and "InArrow" not in t._jdf.queryExecution().toString()


def test_estimators_are_scored_in_one_pass_over_the_rows(frame, monkeypatch):
    """Trees under two schemes: the same scores as fit by fit, from one aggregate."""
    from pyspark.ml.regression import DecisionTreeRegressor
    from pyspark.sql.classic.dataframe import DataFrame

    from fathom.operators import ml
    df = ml.assemble(frame.dropna(), NAMES)
    schemes = [crossval.Scheme("a", ("fold",), 5), crossval.Scheme("b", ("fold",), 5, expanding=True),
               crossval.Scheme("c", ("fold",), 4, ignored=4)]
    learners = {f"tree_{d}": lambda d=d: DecisionTreeRegressor(maxDepth=d, seed=1) for d in (1, 3)}
    collects, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collects.append(1) or collect(self))
    scores = crossval.estimator_scores(df, "label", learners, schemes)
    monkeypatch.undo()
    assert len(collects) == 1
    got = {(r["scheme"], r["fold"], r["learner"], r["part"]): r for r in scores.collect()}
    assert len(got) == (5 + 4 + 4) * 2 * 2
    for scheme in schemes:
        for split in scheme.splits():
            train, test = df.where(split.trains(F.col("fold"))), df.where(F.col("fold") == split.fold)
            model = learners["tree_3"]().setLabelCol("label").fit(train)
            for part, rows in (("train", train), ("test", test)):
                want = model.transform(rows).agg(*crossval.errors()).first()
                r = got[scheme.name, split.fold, "tree_3", part]
                assert r["n"] == want["n"]
                assert [r[c] for c in ("rmse", "mae", "r2")] == pytest.approx([want[c] for c in ("rmse", "mae", "r2")], rel=1e-9)


def test_model_fits_do_not_split_the_rows_again(spark, monkeypatch):
    """The hash that deals rows to training and test is taken once, not in every pass of a fit."""
    from pyspark.ml.base import Estimator

    from fathom.plans import diagnostics, models
    from tests.conftest import SF_SMALL
    plans, fit = [], Estimator.fit

    def seen(self, df, params=None):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return fit(self, df, params)

    monkeypatch.setattr(Estimator, "fit", seen)
    assert models.coefficients(spark, SF_SMALL).count() == 12
    assert diagnostics.permutation_importance(spark, SF_SMALL).count() == 4
    assert len(plans) == 4 and not any("md5" in p for p in plans)
