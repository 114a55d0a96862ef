"""Survival, discriminant and calibration models against closed forms and plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import aft, ml


def _survival(spark, distribution, n=1500, seed=3, censor=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    u = rng.uniform(1e-9, 1 - 1e-9, n)
    e = {"weibull": np.log(-np.log(u)), "log_normal": rng.normal(size=n), "log_logistic": np.log(u / (1 - u))}[distribution]
    t = np.exp(1.0 + 0.5 * x + 0.7 * e)
    c = rng.exponential(np.exp(1.5), n) if censor else np.full(n, np.inf)
    rows = [(float(min(a, b)), int(a <= b), float(v)) for a, b, v in zip(t, c, x)]
    return rows, spark.createDataFrame([*rows, (0.0, 1, 0.0), (None, 1, 0.0)], "t double, e int, x double")


def _log_likelihood(rows, distribution, a, b, s):
    total = 0.0
    for t, e, x in rows:
        z = (math.log(t) - a - b * x) / s
        if distribution == "weibull":
            f, q = z - math.exp(z), -math.exp(z)
        elif distribution == "log_logistic":
            f, q = z - 2 * math.log1p(math.exp(z)), -math.log1p(math.exp(z))
        else:
            f, q = -0.5 * z * z - 0.5 * math.log(2 * math.pi), math.log(0.5 * math.erfc(z / math.sqrt(2)))
        total += f - math.log(s) - math.log(t) if e else q
    return total


@pytest.mark.parametrize("distribution", list(aft.DISTRIBUTIONS))
def test_aft_is_the_maximum_and_recovers_the_truth(spark, distribution):
    rows, df = _survival(spark, distribution)
    m = aft.fit(df, "t", "e", ["x"], distribution)
    assert m.converged and m.n == len(rows)
    assert (m.intercept, m.coefficients[0], m.sigma) == pytest.approx((1.0, 0.5, 0.7), abs=0.12)
    at = (m.intercept, float(m.coefficients[0]), m.sigma)
    best = _log_likelihood(rows, distribution, *at)
    assert m.log_likelihood == pytest.approx(best, rel=1e-9)
    assert m.aic == pytest.approx(6 - 2 * best) and m.bic == pytest.approx(3 * math.log(len(rows)) - 2 * best)
    for i in range(3):
        for h in (-1e-3, 1e-3):
            moved = list(at)
            moved[i] += h
            assert _log_likelihood(rows, distribution, *moved) < best


def test_log_normal_without_censoring_is_least_squares(spark):
    rows, df = _survival(spark, "log_normal", 300, censor=False)
    m = aft.fit(df, "t", "e", ["x"], "log_normal")
    x, y = np.array([[1, r[2]] for r in rows]), np.log([r[0] for r in rows])
    b = np.linalg.lstsq(x, y, rcond=None)[0]
    assert (m.intercept, m.coefficients[0]) == pytest.approx(tuple(b), rel=1e-6)
    assert m.sigma == pytest.approx(np.sqrt(np.mean((y - x @ b) ** 2)), rel=1e-6)


def test_weibull_equals_spark_ml(spark):
    from pyspark.ml.regression import AFTSurvivalRegression
    rows, df = _survival(spark, "weibull", 600)
    m = aft.fit(df, "t", "e", ["x"], "weibull")
    clean = ml.assemble(df.where("t > 0").withColumnsRenamed({"t": "label"}).withColumn("censor", F.col("e").cast("double")), ["x"])
    other = AFTSurvivalRegression(tol=1e-10, maxIter=500).fit(clean)
    assert (m.intercept, m.coefficients[0], m.sigma) == pytest.approx((other.intercept, other.coefficients[0], other.scale), rel=1e-3)


def test_normal_tail_far_out():
    z = np.array([0.0, 7.9, 8.1, 40.0])
    assert aft._log_upper(z)[:2] == pytest.approx([math.log(.5), math.log(.5 * math.erfc(7.9 / math.sqrt(2)))])
    assert aft._log_upper(z)[2:] == pytest.approx([-0.5 * v * v - math.log(v * math.sqrt(2 * math.pi)) + math.log(1 - 1 / v ** 2 + 3 / v ** 4) for v in z[2:]], rel=1e-4)


def test_no_rows(spark):
    with pytest.raises(ValueError):
        aft.fit(spark.createDataFrame([(0.0, 1, 1.0)], "t double, e int, x double"), "t", "e", ["x"])


def test_quadratic_discriminant_equals_gaussian_bayes(spark):
    rng = np.random.default_rng(5)
    rows = [(int(c), *map(float, rng.normal(size=3) * (1 + c) + c)) for c in (0, 1, 2) for _ in range(40)]
    df = spark.createDataFrame([*rows, (1, None, 0.0, 0.0)], "y int, a double, b double, c double")
    fit = ml.qda_fit(df, ["a", "b", "c"], "y", 0.1)
    got = [r.p1 for r in ml.qda_scores(df.dropna(), fit).collect()]
    x, y = np.array([r[1:] for r in rows]), np.array([r[0] for r in rows])
    dens = []
    for c in (0, 1, 2):
        cov = 0.9 * np.cov(x[y == c].T) + 0.1 * np.eye(3)
        d = x - x[y == c].mean(axis=0)
        dens.append(np.exp(-0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(cov), d)) / np.sqrt(np.linalg.det(cov)) / 3)
    assert got == pytest.approx((dens[2] / sum(dens)).tolist(), rel=1e-9)


def test_isotonic_calibration_is_pooled_adjacent_violators(spark):
    """What the calibration step fits: distinct scores with their counts."""
    from pyspark.ml.regression import IsotonicRegression
    rng = np.random.default_rng(6)
    rows = [(round(float(s), 2), float(rng.uniform() < s ** 2)) for s in rng.uniform(size=400)]
    df = spark.createDataFrame(rows, "p double, label double").repartition(5)
    steps = df.groupBy("p").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("n"))
    fit = IsotonicRegression(featuresCol="p", weightCol="n").fit(steps)
    got = {r.p: r.prediction for r in fit.transform(steps).collect()}
    blocks = []
    for p in sorted({r[0] for r in rows}):
        mine = [y for q, y in rows if q == p]
        blocks.append([[p], sum(mine), len(mine)])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            ps, s, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + ps, blocks[-1][1] + s, blocks[-1][2] + n]
    want = {p: s / n for ps, s, n in blocks for p in ps}
    assert got == pytest.approx(want, abs=1e-9)


def test_bootstrap_grams_equal_those_of_exploded_weights(spark):
    """Same hash, weights and sums without a row per (row, replicate); keys longer than one md5 block too."""
    from fathom.operators import folds
    rng = np.random.default_rng(5)
    rows = [(f"{'é' * (i % 7)}{'k' * (60 * (i % 11 == 0))}{i}", float(a), float(a * 2 + b)) for i, (a, b) in enumerate(rng.normal(size=(500, 2)))]
    df = spark.createDataFrame([*rows, ("none", None, 1.0), ("", 1.0, 2.0)], "k string, x double, label double")
    want = ml.gram_by(folds.bootstrap_weights(df, ["k"], 12), ["x"], ["label"], "replicate", weight=F.col("weight").cast("double"))
    got = folds.weighted_grams(df, ["x"], "label", ["k"], 12)
    assert sorted(got) == sorted(want)
    for r, g in want.items():
        assert got[r][:-1, :-1] == pytest.approx(g["xx"]) and got[r][:-1, -1:] == pytest.approx(g["xy"]) and got[r][-1, -1] == pytest.approx(g["yy"][0])
    assert folds.weighted_grams(df.where("k = 'none'"), ["x"], "label", ["k"], 3) == {}


def test_depth_sweep_grows_one_tree(spark, monkeypatch):
    """Depths 1 to 19 from a single fit, equal to a tree grown for each depth."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import DecisionTreeRegressor
    from fathom.plans import diagnostics
    fits, fit = [], DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    got = {r.max_depth: r for r in diagnostics.depth_sweep(spark, "/root/testdata/sf0.001").collect()}
    assert sorted(got) == list(diagnostics.DEPTHS) and len(fits) == 1
    train, test = diagnostics._split(spark, "/root/testdata/sf0.001")
    score = RegressionEvaluator(metricName="rmse")
    for depth in (1, 4, 9):
        m = DecisionTreeRegressor(maxDepth=depth, seed=42).fit(train)
        assert (got[depth].train_rmse, got[depth].test_rmse) == pytest.approx((score.evaluate(m.transform(train)), score.evaluate(m.transform(test))), rel=1e-9)
