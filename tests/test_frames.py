"""Learnt frames, row filters, side-by-side joins, version records, triggers, bands and attributions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import crossval, drift, evalreg, frames, penalty


def test_adaptive_cast_projects_the_columns(spark):
    rows = [(str(i) if i % 10 else "x", str(i) if i % 4 else "n/a", None if i % 2 else "1.5") for i in range(100)]
    out = frames.adaptive_cast(spark.createDataFrame(rows, "a string, b string, c string"), ["a", "b", "c"], 0.8)
    assert dict(out.dtypes) == {"a": "double", "b": "string", "c": "double"}
    assert out.where("a IS NULL").count() == 10 and out.where("c = 1.5").count() == 50


@pytest.mark.parametrize("log", [False, True])
def test_fences_keep_what_lies_inside(spark, log):
    y = np.random.default_rng(1).lognormal(0, 1, 400)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)] + [(999, None)], "i int, y double")
    kept = {r.i for r in frames.within_fences(df, F.log("y") if log else F.col("y")).collect()}
    v = np.log(y) if log else y
    q1, q3 = np.quantile(v, [.25, .75])
    assert kept == set(np.flatnonzero((v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))))


def test_frame_gives_every_table_the_columns_of_the_fit(spark):
    train = spark.createDataFrame([(1.0, 5, "b", "t"), (2.0, 5, "a", "t"), (3.0, 5, None, "t"), (4.0, 5, "c", "t")],
                                  "x double, flat int, cat string, text string")
    frame = frames.fit_frame(train, None, ["cat"])
    assert frame.columns == ["x", "flat", "cat"] and frame.levels["cat"] == ("a", "b", "c")
    assert frame.numeric == {"x": (2.5, 1.5), "flat": (5.0, 1.0)}
    other = spark.createDataFrame([(1, "4.0", "z", 9), (2, "?", "c", 9), (3, None, None, 9)], "id int, x string, cat string, more int")
    got = [tuple(r) for r in frame.apply(other, keep=["id"]).orderBy("id").collect()]
    assert got == [(1, 1.0, 0.0, -1), (2, 0.0, 0.0, 2), (3, 0.0, 0.0, -1)]
    assert frame.apply(spark.createDataFrame([(1,)], "id int"), keep=["id"]).first()[1:] == (0.0, 0.0, -1)
    with pytest.raises(ValueError):
        frames.fit_frame(train, [], ["cat"], most_levels=2)


def test_side_by_side_aligns_by_key(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, y double")
    b = spark.createDataFrame([(2, 21.0), (3, 31.0)], "k int, p double")
    got = {r.k: (r.label, r.pred) for r in frames.side_by_side(["k"], {"label": (a, "y"), "pred": (b, "p")}).collect()}
    assert got == {1: (10.0, None), 2: (20.0, 21.0), 3: (None, 31.0)}


def test_versions_are_appended_once(spark, tmp_path):
    path, rec = str(tmp_path / "v"), lambda n: spark.createDataFrame([(n, "h%d" % n, n * 2)], "n_rows int, hash string, other int")
    assert [frames.append_version(rec(n), path, ["n_rows", "hash"]) for n in (5, 5, 7, 5)] == [1, 1, 2, 3]
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("version", "n_rows").collect()) == [(1, 5), (2, 7), (3, 5)]


@pytest.mark.parametrize("psi,now,n,want", [(.1, 10.9, 999, (False, False, False)), (.21, 10.0, 0, (True, False, False)),
                                            (.2, 11.1, 0, (False, True, False)), (None, None, 1000, (False, False, True))])
def test_retrain_triggers(spark, psi, now, n, want):
    one = lambda v, c, t: spark.createDataFrame([(v,)], f"{c} {t}")
    psis = spark.createDataFrame([("a", 0.0), ("b", psi)], "feature string, psi double")
    r = drift.retrain_triggers(psis, one(10.0, "rmse", "double"), one(now, "rmse", "double"), one(n, "n", "long")).first()
    assert (r.psi_trigger, r.rmse_trigger, r.label_trigger) == want and r.retrain == any(want)


def test_out_of_fold_means_and_band(spark):
    rng = np.random.default_rng(2)
    rows = [("abz"[i % 3] if i != 7 else "once", i % 4, float(rng.normal())) for i in range(60)] + [(None, 1, 5.0), (None, 2, 7.0)]
    df = spark.createDataFrame(rows, "g string, f int, y double")
    got = sorted(((str(r.g), r.f, r.y, r.oof) for r in evalreg.oof_group_means(df, "y", "g", "f").collect()))
    for g, f, y, oof in got:
        mine = [v for a, b, v in rows if str(a) == g and b != f]
        rest = [v for a, b, v in rows if b != f]
        # the NULL group joins no total of its own, and a group of one fold has no other rows
        want = np.mean(rest) if not mine else np.mean(mine)
        assert oof is None if g == "None" else oof == pytest.approx(want)
    b = evalreg.uncertainty_band(df.withColumn("p", F.lit(0.0)), "y", "p", 1.0, 2.0).first()
    rmse = np.sqrt(np.mean([r[2] ** 2 for r in rows]))
    assert (b.n, b.oof_rmse, b.lower_band, b.upper_band) == pytest.approx((62, rmse, 2 * rmse, rmse))


def test_attributions_equal_least_squares(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) + [5, 0, 0]
    x[:, 1] += x[:, 0]
    y = x @ [1.0, -2.0, 0.0] + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    got = {r.feature: r for r in evalreg.linear_attributions(df, "y", ["a", "b", "c"]).collect()}
    beta = np.linalg.lstsq(np.column_stack([np.ones(200), x]), y, rcond=None)[0][1:]
    for i, f in enumerate("abc"):
        alone = np.cov(x[:, i], y)[0, 1] / np.var(x[:, i], ddof=1)
        assert (got[f].adjusted, got[f].unadjusted, got[f].change) == pytest.approx((beta[i], alone, beta[i] - alone), abs=1e-9)
        assert got[f].mean_abs_attribution == pytest.approx(np.abs(beta[i] * (x[:, i] - x[:, i].mean())).mean())


def test_elimination_drops_the_smallest_coefficient():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5)) * [1, 10, 1, 1, 1]
    y = x @ [3, 0.01, -2, 0.5, 1] + 0.1 * rng.normal(size=300)
    z = np.column_stack([np.ones(300), x, y])
    names = list("abcde")
    steps = penalty.eliminate(z.T @ z, names, 2, 1.0)
    left, s = list(range(5)), (x - x.mean(0)) / x.std(0)
    for dropped, coef, kept in steps:
        w = np.linalg.solve(s[:, left].T @ s[:, left] + np.eye(len(left)), s[:, left].T @ (y - y.mean()))
        i = int(np.argmin(np.abs(w)))
        assert dropped == names[left[i]] and coef == pytest.approx(w[i], rel=1e-8)
        left.pop(i)
    assert [s[0] for s in steps] == ["b", "d", "e"] and steps[-1][2] == ["a", "c"]


def test_rows_of_the_ignored_fold_take_no_part(spark):
    rows = [(float(i), 2.0 * i, i % 3) for i in range(30)] + [(float(i), -99.0, 3) for i in range(30)]
    df = spark.createDataFrame(rows, "x double, label double, f int")
    s = crossval.Scheme("some", ("f",), 3, ignored=3)
    got = crossval.linear_scores(df, ["x"], "label", {"ols": crossval.Linear(("x",))}, [s]).collect()
    assert len(got) == 6 and all(r.rmse < 1e-9 for r in got) and sum(r.n for r in got if r.part == "test") == 30


def test_ice_curves_of_a_linear_model_are_parallel(spark):
    from pyspark.ml.regression import LinearRegression
    from fathom.operators import ml
    from fathom.plans.diagnostics import ice_curves
    rng = np.random.default_rng(5)
    rows = [(i, *map(float, rng.normal(size=2))) for i in range(300)]
    df = ml.assemble(spark.createDataFrame(rows, "k int, a double, b double").withColumn("label", 2 * F.col("a") + F.col("b")), ["a", "b"])
    got = ice_curves(LinearRegression().fit(df), df, "a", [0, 1, 3], ["k"], 50, ["a", "b"]).collect()
    assert len(got) == 150 and len({r.k for r in got}) == 50
    assert all(r.centred == pytest.approx(2 * r.grid_value, abs=1e-6) for r in got)


def test_latest_period_is_held_out(spark):
    from fathom.operators import folds
    df = spark.createDataFrame([(2000 + i % 3, i) for i in range(90)] + [(None, 1)], "p int, i int")
    frame, last, periods = folds.latest_period_holdout(df, "p", 50, 20)
    assert last == 2002 and sorted(r.p for r in periods.collect()) == [2000, 2001]
    assert {(r.split, r["count"]) for r in frame.groupBy("split").count().collect()} == {("train", 60), ("valid", 30), (None, 1)}
    assert folds.latest_period_holdout(df, "p", 61, 20) is None and folds.latest_period_holdout(df.where("p = 2000"), "p", 1, 1) is None
