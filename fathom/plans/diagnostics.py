"""Model diagnostics (E34, E45-E50, L22, L25): curves, partial dependence,
permutation importance, feature selection and bootstrap bands."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Window
from pyspark.sql import functions as F

from fathom.functions.hashing import salted_h32
from fathom.functions.numeric import rnd, sql_rnd
from fathom.functions.special import norm_ppf
from fathom.operators import folds, ml
from fathom.operators.ordered import exact_quantiles
from fathom.plans.models import REG_FEATURES, li_table
from fathom.plans.registry import query
from fathom.session import cut_lineage, stored
from fathom.plans.slice import SQL_SCORED_ORDERS, scored_orders

QQ_N = 20
QQ_PROBS = [(i + 0.5) / QQ_N for i in range(QQ_N)]


@query("qq_points", ["E45"], sql=f"""
WITH {SQL_SCORED_ORDERS},
r AS (SELECT o_totalprice - pred AS r FROM so WHERE split = 'test'),
s AS (SELECT avg(r) AS m, stddev_samp(r) AS sd, quantile_cont(r, [{', '.join(repr(p) + 'e0' if 'e' not in repr(p) else repr(p) for p in QQ_PROBS)}]) AS qs FROM r),
qg AS (SELECT * FROM (VALUES {', '.join(f'({i}, {norm_ppf(p)!r}e0)' if 'e' not in repr(norm_ppf(p)) else f'({i}, {norm_ppf(p)!r})' for i, p in enumerate(QQ_PROBS))}) AS v(i, theoretical))
SELECT CAST(i AS INTEGER) AS i, {sql_rnd('theoretical', 8)} AS theoretical, {sql_rnd('(qs[i + 1] - m) / sd', 8)} AS sample
FROM qg CROSS JOIN s
""")
def qq_points(spark, sf_dir):
    """Standardised residual quantiles against normal quantiles."""
    r = scored_orders(spark, sf_dir).where(F.col("split") == "test").select((F.col("o_totalprice") - F.col("pred")).alias("r"))
    s = r.agg(F.avg("r").alias("m"), F.stddev_samp("r").alias("sd")) \
        .crossJoin(F.broadcast(exact_quantiles(r, "r", QQ_PROBS, out="qs").select("qs")))    # one row each
    g = spark.createDataFrame([(i, float(norm_ppf(p))) for i, p in enumerate(QQ_PROBS)], "i int, theoretical double")
    j = g.crossJoin(F.broadcast(s))  # one row
    return j.select("i", rnd("theoretical", 8).alias("theoretical"),
                    rnd((F.element_at("qs", F.col("i") + 1) - F.col("m")) / F.col("sd"), 8).alias("sample"))


# sizes of the diagnostics
ALPHAS = [10.0 ** (e / 2) for e in range(-6, 7)]   # 13 ridge penalties
DEPTHS = range(1, 20)
PERMUTATIONS = 30
REPLICATES = 100


def _split(spark, sf_dir):
    d = li_table(spark, sf_dir)
    return d.where("split = 'train'"), d.where("split = 'test'")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FRACTIONS = (0.1, 0.2, 0.4, 0.6, 0.8, 1.0)


@query("learning_curve", ["E46", "F14"])
def learning_curve(spark, sf_dir):
    """Training and cross-validated RMSE of least squares on nested growing
    samples of the training rows (hash thresholds), five hash folds each: the
    sample a row enters is a scheme of its own, so all come from two passes."""
    from fathom.operators import crossval, folds
    train, _ = _split(spark, sf_dir)
    u = salted_h32(F.concat_ws("-", *LINE_KEY), "lcurve") / F.lit(4294967296.0)
    rows = folds.kfold(train, LINE_KEY, 5, "lcurve-fold")
    schemes = []
    for i, fraction in enumerate(FRACTIONS):
        # rows outside the sample belong to a sixth fold, which is neither trained on nor scored
        rows = rows.withColumn(f"s{i}", F.when(u < fraction, F.col("fold")).otherwise(F.lit(5)))
        schemes.append(crossval.Scheme(f"{fraction:g}", (f"s{i}",), 5, ignored=5))
    scores = cut_lineage(crossval.linear_scores(rows, REG_FEATURES, "label", {"ols": crossval.Linear(tuple(REG_FEATURES))}, schemes))   # read twice
    sizes = scores.where("part = 'test'").groupBy("scheme").agg(F.sum("n").alias("n_rows"))
    t = crossval.candidate_table(scores).join(sizes, "scheme")
    return t.select(F.col("scheme").cast("double").alias("fraction"), "n_rows", "train_rmse", "cv_rmse", "cv_rmse_std", "gap")


@query("validation_curve", ["E47"])
def validation_curve(spark, sf_dir):
    """Ridge over 13 penalties: training and cross-validated RMSE (5 hash
    folds of the training rows) with its spread, and the RMSE on the test
    rows of the fit on all training rows."""
    from fathom.operators import crossval, folds, penalty
    train, test = _split(spark, sf_dir)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    train = folds.kfold(train, keys, 5, "curve")
    ridge = penalty.choose(train, REG_FEATURES, "label", "fold", 5, ALPHAS, {"ridge": [penalty.RIDGE]})["ridge"]
    total = sum(crossval.fold_grams(train, REG_FEATURES, "label", {"fold": 5}).values())
    held_out = crossval.fold_grams(test.withColumn("__all", F.lit(0)), REG_FEATURES, "label", {"__all": 1})["__all", 0]
    error = penalty.mean_square(penalty.rescaled(held_out, total), ridge.paths) ** 0.5
    rows = [(a, float(ridge.train_rmse[i]), float(ridge.cv_rmse[i]), float(ridge.cv_rmse_std[i]), float(error[i]), a == ridge.penalty)
            for i, a in enumerate(ALPHAS)]
    return spark.createDataFrame(rows, "alpha double, train_rmse double, cv_rmse double, cv_rmse_std double, test_rmse double, chosen boolean")


@query("depth_sweep", ["E48", "M4"])
def depth_sweep(spark, sf_dir):
    """RMSE of trees of depth 1 to 19: the upper levels of one tree, grown once and scored in one pass."""
    rows = li_table(spark, sf_dir)
    model = DecisionTreeRegressor(maxDepth=max(DEPTHS), seed=42).fit(rows.where("split = 'train'"))
    scores = ml.depth_scores(rows, REG_FEATURES, "label", "split", ml.tree_nodes(model), DEPTHS)
    at = {p: F.max(F.when(F.col("part") == p, F.col("rmse"))).alias(f"{p}_rmse") for p in ("train", "test")}
    return scores.groupBy(F.col("depth").alias("max_depth")).agg(*at.values())


@query("partial_dependence", ["E49"])
def partial_dependence(spark, sf_dir):
    """Average prediction with one feature set to each grid value, for every
    test row: a grid of 10 values is a fixed-size cross product."""
    train, test = _split(spark, sf_dir)
    m = RandomForestRegressor(numTrees=20, maxDepth=5, seed=42).fit(train)
    grid = spark.createDataFrame([(float(v),) for v in range(1, 51, 5)], "grid_value double")
    base = test.drop("features").crossJoin(F.broadcast(grid)).withColumn("l_quantity", F.col("grid_value"))
    scored = m.transform(VectorAssembler(inputCols=REG_FEATURES, outputCol="features").transform(base))
    return scored.groupBy("grid_value").agg(F.avg("prediction").alias("partial_dependence"), F.count(F.lit(1)).alias("n"))


ICE_ROWS = 200


def ice_curves(model, rows, feature, values, key, n_rows=ICE_ROWS, features=REG_FEATURES):
    """(key, grid_value, prediction, centred) of the ``n_rows`` rows of
    smallest key hash with one feature set to each value of a short grid;
    ``centred`` is the change since the first value.  Their mean per value is
    the partial dependence of the sample."""
    spark = rows.sparkSession
    sample = rows.withColumn("__h", salted_h32(F.concat_ws("-", *key), "ice")).orderBy("__h", *key).limit(n_rows).drop("__h", "features")
    grid = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "__i int, grid_value double")
    base = cut_lineage(sample).crossJoin(F.broadcast(grid)).withColumn(feature, F.col("grid_value"))   # n_rows x a short grid
    scored = model.transform(VectorAssembler(inputCols=list(features), outputCol="features").transform(base))
    first = F.min_by("prediction", "__i").over(Window.partitionBy(*key))
    return scored.withColumn("centred", F.col("prediction") - first).select(*key, "grid_value", "prediction", "centred")


@query("ice_curves", ["E49"])
def ice_curves_query(spark, sf_dir):
    """Curves of 200 test rows over ten quantities under a forest."""
    train, test = _split(spark, sf_dir)
    m = RandomForestRegressor(numTrees=20, maxDepth=5, seed=42).fit(train)
    return ice_curves(m, test, "l_quantity", range(1, 51, 5), LINE_KEY)


@query("permutation_importance", ["E50"])
def permutation_importance(spark, sf_dir):
    """Increase in test RMSE when one feature's values are permuted across
    rows.  Rows are ranked once in hash order; repeat r gives each row the
    value of the row a hashed number of ranks further on, so all repeats and
    features come from one join on the rank and one aggregate."""
    from fathom.operators.ordered import row_numbers
    d = ml.assemble(stored(li_table(spark, sf_dir).drop("features"), "lines"), REG_FEATURES)
    train, test = d.where("split = 'train'"), d.where("split = 'test'")
    m = LinearRegression().fit(train)
    coef = {c: float(v) for c, v in zip(REG_FEATURES, m.coefficients.toArray())}
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    t = m.transform(test).select(*REG_FEATURES, "label", "prediction", key.alias("__k")) \
        .withColumn("__h", salted_h32("__k", "perm"))
    own = cut_lineage(row_numbers(t, ["__h", "__k"], name="__slot"))
    n = own.count()
    rep = F.explode(F.sequence(F.lit(0), F.lit(PERMUTATIONS - 1)))
    shift = 1 + salted_h32(F.col("rep").cast("string"), "shift") % max(n - 1, 1)
    want = own.withColumn("rep", rep).withColumn("__from", (F.col("__slot") - 1 + shift) % n + 1)
    donor = own.select(F.col("__slot").alias("__from"), *[F.col(f).alias(f"__v_{f}") for f in REG_FEATURES])
    e = F.col("label") - F.col("prediction")
    moved = want.join(donor, "__from").groupBy("rep").agg(F.sqrt(F.avg(e * e)).alias("base"), *[
        F.sqrt(F.avg(F.pow(e - coef[f] * (F.col(f"__v_{f}") - F.col(f)), 2))).alias(f) for f in REG_FEATURES])
    long = moved.select("rep", F.explode(F.array(*[F.struct(
        F.lit(f).alias("feature"), (F.col(f) - F.col("base")).alias("up")) for f in REG_FEATURES])).alias("x"))
    return long.groupBy("x.feature").agg(F.avg("x.up").alias("importance_mean"), F.stddev("x.up").alias("importance_std"))


@query("importance_selection", ["L22", "L25", "L21"])
def importance_selection(spark, sf_dir):
    """Keep features with importance >= k x median (k = 0.75, 1, 1.25);
    L25: recursive elimination down to 2 features by smallest |coef| of a
    ridge fit on standardised columns (one Gram matrix per step)."""
    import numpy as np
    train, _ = _split(spark, sf_dir)
    rf = RandomForestRegressor(numTrees=30, maxDepth=5, seed=42).fit(train)
    imp = rf.featureImportances.toArray()
    med = float(np.median(imp))
    rows = [("select_from_model", f"{k}x_median", ",".join(f for f, v in zip(REG_FEATURES, imp) if v >= k * med))
            for k in (0.75, 1.0, 1.25)]
    keep = list(REG_FEATURES)
    stats = train.agg(*[F.avg(c).alias(f"m_{c}") for c in REG_FEATURES], *[F.stddev_pop(c).alias(f"s_{c}") for c in REG_FEATURES]).first()
    z = train.select(*[((F.col(c) - stats[f"m_{c}"]) / (stats[f"s_{c}"] or 1.0)).alias(c) for c in REG_FEATURES], "label")
    while len(keep) > 2:
        g = ml.gram(z, keep, ["label"])
        beta = ml.ridge_solve(g, 1.0)[1:]
        drop = keep[int(np.argmin(np.abs(beta)))]
        rows.append(("rfe_step", f"drop_{drop}", ",".join(k for k in keep if k != drop)))
        keep.remove(drop)
    return spark.createDataFrame(rows, "method string, step string, kept string")


@query("bootstrap_band", ["E34", "F16"])
def bootstrap_band(spark, sf_dir):
    """5-95% prediction band from weighted least squares refits on Poisson
    bootstrap weights: the weighted Gram matrices of all replicates, then the
    band per test row from the replicate coefficients."""
    import numpy as np
    train, test = _split(spark, sf_dir)
    reps = REPLICATES
    grams = folds.weighted_grams(train, REG_FEATURES, "label", LINE_KEY, reps)
    betas = [ml.ridge_solve({"xx": g[:-1, :-1], "xy": g[:-1, -1:]}, 1e-6) for g in grams.values()]
    b = np.array(betas)
    coef = spark.createDataFrame([(i, *[float(x) for x in row]) for i, row in enumerate(b)],
                                 "rep int, b0 double, " + ", ".join(f"b{j + 1} double" for j in range(len(REG_FEATURES))))
    t = test.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *REG_FEATURES, "label")
    made = F.sort_array(F.transform("coefs", lambda r: sum(
        (r[f"b{j + 1}"] * F.col(c) for j, c in enumerate(REG_FEATURES)), r["b0"])))
    # the replicate predictions of a row are one array: no copies of the row, no shuffle
    rows = t.crossJoin(F.broadcast(coef.agg(F.collect_list(F.struct(*coef.columns)).alias("coefs")))).select("label", made.alias("p"))
    def at(q):
        pos = q * (reps - 1)
        lo = F.element_at("p", int(pos) + 1)
        return lo + (pos - int(pos)) * (F.element_at("p", min(int(pos) + 2, reps)) - lo)
    band = rows.select("label", at(0.05).alias("lower"), at(0.95).alias("upper"))
    return band.agg(F.avg(F.col("label").between(F.col("lower"), F.col("upper")).cast("double")).alias("coverage"),
                    F.avg(F.col("upper") - F.col("lower")).alias("mean_width"), F.count(F.lit(1)).alias("n"))

