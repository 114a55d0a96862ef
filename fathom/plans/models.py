"""Model queries (M1-M23 and model-based reports).  Results depend on
learner internals and timings, so they are checked by rows."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (AFTSurvivalRegression, DecisionTreeRegressor, GBTRegressor, IsotonicRegression, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import functions as F

from fathom.functions.hashing import sql_bucket, sql_key_text
from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import crossval
from fathom.operators import evalcls as C
from fathom.operators import folds
from fathom.operators import ml
from fathom.operators import penalty
from fathom.operators.ordered import quantile_row
from fathom.plans.registry import query
from fathom.session import stored
from fathom.sources.tables import Tables

CLS_FEATURES = ["log_chars", "n_lines", "lang_en", "lang_fr", "lang_de"]
REG_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def doc_table(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang", "n_chars", "text")
    j = t.labels.select("doc_id", F.col("toxic").cast("double").alias("label")).join(d, "doc_id")
    j = j.select("doc_id", "label", F.log1p("n_chars").alias("log_chars"),
                 (F.size(F.split(F.col("text"), "\n")) - 1).cast("double").alias("n_lines"),
                 *[(F.col("lang") == lg).cast("double").alias(f"lang_{lg}") for lg in ["en", "fr", "de"]])
    j = folds.holdout(j, ["doc_id"])
    return ml.assemble(j, CLS_FEATURES)


def li_table(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                               "l_discount", "l_tax", "l_extendedprice")
    li = li.withColumn("l_linenumber", F.col("l_linenumber").cast("double")).withColumnRenamed("l_extendedprice", "label")
    li = folds.holdout(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return ml.assemble(li, REG_FEATURES)


def _auc_f1(pred, threshold=0.5):
    p = ml.positive_probability(pred).withColumn("y", F.col("label").cast("int"))
    auc = C.roc_auc(p, "y", "p1").select("roc_auc")
    f1 = C.binary_metrics(p, "y", "p1", threshold).select("f1")
    return auc.crossJoin(f1).first()


@query("classifier_screening", ["M1", "M4", "M5", "M6", "M7", "M9", "M11", "M15"])
def classifier_screening(spark, sf_dir):
    d = doc_table(spark, sf_dir).cache()
    train, test = d.where("split = 'train'"), d.where("split = 'test'")
    n_pos = train.where("label = 1").count()
    n = train.count()
    w_pos = n / (2.0 * max(n_pos, 1))
    w_neg = n / (2.0 * max(n - n_pos, 1))
    train_w = train.withColumn("w", F.when(F.col("label") == 1, w_pos).otherwise(w_neg))  # balanced classes
    models = {
        "logistic_l2_balanced": LogisticRegression(regParam=0.01, weightCol="w"),
        "logistic_l1": LogisticRegression(regParam=0.01, elasticNetParam=1.0),
        "decision_tree": DecisionTreeClassifier(maxDepth=5, seed=42),
        "random_forest": RandomForestClassifier(numTrees=50, maxDepth=6, seed=42),
        "gradient_boosting": GBTClassifier(maxIter=30, maxDepth=3, seed=42),
        "naive_bayes_gaussian": NaiveBayes(modelType="gaussian"),
        "mlp": MultilayerPerceptronClassifier(layers=[len(CLS_FEATURES), 8, 2], maxIter=100, seed=42),
    }
    rows = []
    for name, est in models.items():
        tr = train_w if name == "logistic_l2_balanced" else train
        model, secs = ml.fit_and_time(est, tr)
        r = _auc_f1(model.transform(test))
        rows.append((name, float(secs), r["roc_auc"], float(r["f1"])))
    d.unpersist()
    return spark.createDataFrame(rows, "model string, fit_seconds double, test_auc double, test_f1 double") \
        .orderBy(F.desc("test_auc"))


@query("coefficients", ["E51"])
def coefficients(spark, sf_dir):
    """Signed coefficients of the linear models and importances of the forest, one row per model and feature."""
    rows = li_table(spark, sf_dir).where("split = 'train'").select(*REG_FEATURES, "label")
    train = ml.assemble(stored(rows, "train"), REG_FEATURES)
    out = None
    for name, est in (("ols", LinearRegression()), ("lasso", LinearRegression(regParam=1.0, elasticNetParam=1.0)),
                      ("random_forest", RandomForestRegressor(numTrees=30, maxDepth=6, seed=42))):
        part = ml.coefficient_table(est.fit(train), REG_FEATURES, name, spark)
        out = part if out is None else out.unionByName(part)
    return out


@query("regressor_screening", ["M2", "M3", "M5", "M6", "M11", "M23"])
def regressor_screening(spark, sf_dir):
    """Regressors fitted on the training rows, scored on both parts.  The trees of all models grow together, so the
    forests share their fit time evenly."""
    d = li_table(spark, sf_dir).select(*REG_FEATURES, "label", (F.col("split") == "test").cast("int").alias("part"))
    d = stored(d, "lines")                                                 # narrow: not assembled rows in executor memory
    n = d.where("part = 0").count()
    models = {
        "ols": lambda: LinearRegression(),
        "ridge_alpha1": lambda: LinearRegression(regParam=ml.ridge_reg_param(1.0, n), standardization=False),
        "lasso_alpha1": lambda: LinearRegression(regParam=1.0, elasticNetParam=1.0, standardization=False),
        "elastic_net": lambda: LinearRegression(regParam=1.0, elasticNetParam=0.5, standardization=False),
        "huber": lambda: LinearRegression(loss="huber", epsilon=1.35),
        "decision_tree": lambda: DecisionTreeRegressor(maxDepth=6, seed=42),
        "random_forest": lambda: RandomForestRegressor(numTrees=30, maxDepth=6, seed=42),
        "bagged_trees": lambda: RandomForestRegressor(numTrees=30, maxDepth=6, featureSubsetStrategy="all", seed=42),
        "gradient_boosting": lambda: GBTRegressor(maxIter=30, maxDepth=4, seed=42),
    }
    holdout = crossval.Scheme("holdout", ("part",), 2, expanding=True)     # part 1 scored by models of part 0
    scores = {(r["learner"], r["part"]): r for r in crossval.estimator_scores(ml.assemble(d, REG_FEATURES), "label", models, [holdout]).collect()}
    rows = []
    for name in models:
        train, test = (scores.get((name, part)) for part in ("train", "test"))
        if train and test:
            rows.append((name, test["fit_seconds"], test["rmse"], test["r2"], train["rmse"]))
    out = spark.createDataFrame(rows, "model string, fit_seconds double, test_rmse double, test_r2 double, train_rmse double")
    return out.withColumn("gap", F.col("test_rmse") - F.col("train_rmse")).orderBy("test_rmse")


@query("cv_search", ["M13", "M14", "M20"])
def cv_search(spark, sf_dir):
    """Grid and randomised search, cross-validated on a fixed hash fold column: all fits from one pass over the rows."""
    d = folds.kfold(li_table(spark, sf_dir).where("split = 'train'"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                    5, "cv")
    grams = list(crossval.fold_grams(d, REG_FEATURES, "label", {"fold": 5}).values())
    grid = [(reg, share) for reg in (0.0, 0.01, 0.1, 1.0, 10.0) for share in (0.0, 1.0)]
    # randomised search: a hash-chosen subset of the grid (deterministic)
    import hashlib
    sampled = [g for i, g in enumerate(grid) if int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 2 == 0]
    rows = []
    for name, g in [("grid", grid), ("randomised", sampled)]:
        found = penalty.search(grams, g)
        for (reg, share), m in zip(g, found.cv_rmse):
            rows.append((name, reg, share, float(m), int(sum(1 for c in found.coefficients[1:] if c == 0.0))))
    return spark.createDataFrame(rows, "search string, reg_param double, l1_ratio double, cv_rmse double, best_zero_coefs int")


@query("ensemble_stack_calibrate", ["M16", "M17", "M18", "E30"])
def ensemble_stack_calibrate(spark, sf_dir):
    d = folds.kfold(doc_table(spark, sf_dir), ["doc_id"], 3, "stack").select("doc_id", "label", *CLS_FEATURES, "split", "fold")
    d = ml.assemble(stored(d, "rows"), CLS_FEATURES)          # narrow: texts are read once, not in every pass of the fits
    train, test = d.where("split = 'train'"), d.where("split = 'test'")
    base = {"lr": LogisticRegression(regParam=0.01), "rf": RandomForestClassifier(numTrees=40, maxDepth=5, seed=42)}
    # out-of-fold scores on training rows (E30): fit on folds != i, score fold i; test rows by fits on all training rows
    parts = [(train.where(F.col("fold") != i), train.where(F.col("fold") == i)) for i in range(3)] + [(train, test)]
    jobs = [(name, tr) for tr, _ in parts for name in base]
    with ThreadPool(4) as pool:
        fits = iter(pool.map(lambda job: base[job[0]].copy().fit(job[1]), jobs))
    scores = None
    for _, sc in parts:
        for name in base:
            model = next(fits).setPredictionCol(f"y_{name}").setProbabilityCol(f"v_{name}").setRawPredictionCol(f"r_{name}")
            sc = ml.positive_probability(model.transform(sc), f"v_{name}", f"p_{name}")
        part = sc.select("doc_id", "label", "split", *[f"p_{name}" for name in base])
        scores = part if scores is None else scores.unionByName(part)
    scores = stored(scores, "scores")
    oof, te = scores.where("split = 'train'").drop("split"), scores.where("split = 'test'").drop("split")
    meta_in = ml.assemble(oof, ["p_lr", "p_rf"], "meta")
    meta = LogisticRegression(featuresCol="meta").fit(meta_in)                     # M17 stacking
    platt = LogisticRegression(featuresCol="meta_rf").fit(ml.assemble(oof, ["p_rf"], "meta_rf"))  # M18 sigmoid
    te = ml.assemble(te, ["p_lr", "p_rf"], "meta")
    te = ml.positive_probability(meta.transform(te).drop("rawPrediction", "prediction"), out="p_stack").drop("probability")
    # isotonic calibration: Spark pools adjacent violators per range partition before the last pooling, and the
    # scores are counted per distinct value first
    steps = oof.groupBy("p_rf").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("n"))
    isotonic = IsotonicRegression(featuresCol="p_rf", labelCol="label", weightCol="n", predictionCol="p_isotonic").fit(steps)
    te = isotonic.transform(te)
    te = ml.assemble(te, ["p_rf"], "meta_rf")
    te = ml.positive_probability(platt.setFeaturesCol("meta_rf").transform(te), out="p_platt")
    te = te.withColumn("p_vote", (F.col("p_lr") + F.col("p_rf")) / 2).withColumn("y", F.col("label").cast("int"))  # M16
    made = ["p_lr", "p_rf", "p_vote", "p_stack", "p_platt", "p_isotonic"]
    te = stored(te.select("y", *made), "test-scores")
    brier = te.agg(*[F.avg((F.col(c) - F.col("y")) ** 2).alias(c) for c in made]).first()
    rows = [(c[2:], C.roc_auc(te, "y", c).first()["roc_auc"], float(brier[c])) for c in made]
    return spark.createDataFrame(rows, "model string, test_auc double, test_brier double")


@query("gram_models", ["H6", "M12", "M19", "A7"])
def gram_models(spark, sf_dir):
    """Nested-set R^2 (H6), Bayesian ridge (M12) and a two-target least
    squares (M19), all from one Gram-matrix aggregate."""
    li = Tables(spark, sf_dir).lineitem.withColumn(
        "ship_day", F.datediff("l_shipdate", F.lit("1992-01-01")).cast("double"))
    g = ml.gram(li, ["l_quantity", "l_discount", "l_tax"], ["l_extendedprice", "ship_day"])
    rows = [("uplift_r2", s, float(r)) for s, r in ml.nested_uplift(g, [["l_quantity"], ["l_quantity", "l_discount"],
                                                                        ["l_quantity", "l_discount", "l_tax"]])]
    br = ml.bayesian_ridge(g, 0)
    rows += [("bayes_ridge_coef", c, float(v)) for c, v in zip(["l_quantity", "l_discount", "l_tax"], br["coef"])]
    rows.append(("bayes_ridge_alpha", "noise_precision", br["alpha"]))
    std = li.select(ml.predictive_std(li, ["l_quantity", "l_discount", "l_tax"], br).alias("s")).agg(F.avg("s")).first()[0]
    rows.append(("bayes_ridge_mean_std", "per_row", float(std)))
    for k, t in enumerate(["l_extendedprice", "ship_day"]):
        beta = ml.ridge_solve(g, 0.0, k)
        rows += [(f"multi_output_{t}", n, float(b)) for n, b in zip(g["names"], beta)]
    return spark.createDataFrame(rows, "report string, term string, value double")


@query("lda_classifier", ["M8"])
def lda_classifier(spark, sf_dir):
    d = doc_table(spark, sf_dir)
    train, test = d.where("split = 'train'"), d.where("split = 'test'")
    fit = ml.lda_fit(train, CLS_FEATURES, "label")
    scored = ml.lda_scores(test, fit).withColumn("y", F.col("label").cast("int"))
    return C.roc_auc(scored, "y", "p1")


QDA_X = ["log_chars", "n_lines"]
QDA_REG = 0.1
_QDA_SPLIT = sql_bucket(sql_key_text("doc_id"), "split")


def _sql_qda():
    """Posterior of class 1 from each class's own 2 x 2 covariance."""
    score = ("ln(pr) - 0.5e0 * ln(c11 * c22 - c12 * c12) - 0.5e0 * (c22 * power(x1 - m1, 2) - 2 * c12 * (x1 - m1) * (x2 - m2) "
             "+ c11 * power(x2 - m2, 2)) / (c11 * c22 - c12 * c12)")
    return f"""
WITH d AS (SELECT doc_id, CAST(toxic AS INTEGER) AS y, ln(1 + n_chars) AS x1,
                  CAST(len(string_split(text, chr(10))) - 1 AS DOUBLE) AS x2, {_QDA_SPLIT} < 80 AS train
           FROM labels JOIN documents USING (doc_id)),
s AS (SELECT y, count(*) / sum(count(*)) OVER () AS pr, avg(x1) AS m1, avg(x2) AS m2,
             {1 - QDA_REG}e0 * covar_samp(x1, x1) + {QDA_REG}e0 AS c11, {1 - QDA_REG}e0 * covar_samp(x2, x2) + {QDA_REG}e0 AS c22,
             {1 - QDA_REG}e0 * covar_samp(x1, x2) AS c12 FROM d WHERE train GROUP BY y),
q AS (SELECT doc_id, d.y AS label, s.y AS cls, {score} AS score FROM d CROSS JOIN s WHERE NOT train),
p AS (SELECT doc_id, label, max(score) FILTER (WHERE cls = 1) AS s1, max(score) FILTER (WHERE cls = 0) AS s0 FROM q GROUP BY ALL)
SELECT doc_id, label, {sql_rnd('1 / (1 + exp(s0 - s1))', 6)} AS p1 FROM p"""


@query("qda_scores", ["M8"], sql=_sql_qda())
def qda_scores(spark, sf_dir):
    """Quadratic discriminant posterior of the toxic class for the test documents."""
    d = doc_table(spark, sf_dir).drop("features")
    fit = ml.qda_fit(d.where("split = 'train'"), QDA_X, "label", QDA_REG)
    scored = ml.qda_scores(d.where("split = 'test'"), fit)
    return scored.select("doc_id", F.col("label").cast("int").alias("label"), rnd("p1", 6).alias("p1"))


@query("spatial_vs_random_cv", ["F12", "L17", "H8", "E30"])
def spatial_vs_random_cv(spark, sf_dir):
    from fathom.plans.common import coords
    lat, lon = coords("c_custkey")
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_acctbal", lat.alias("lat"), lon.alias("lon"))
    c = ml.assemble(c, ["lat", "lon"])
    km = KMeans(k=5, seed=42, featuresCol="features", predictionCol="cluster").fit(c)   # L17 geo clusters
    c = km.transform(c).withColumn("spatial_fold", F.col("cluster"))                  # F12 spatial folds
    c = folds.kfold(c, ["c_custkey"], 5, "random", name="random_fold")
    rows = []
    for scheme in ["random_fold", "spatial_fold"]:
        for i in range(5):
            tr, te = c.where(F.col(scheme) != i), c.where(F.col(scheme) == i)
            if te.isEmpty():
                continue
            m = LinearRegression(featuresCol="features", labelCol="c_acctbal").fit(tr)
            r2 = RegressionEvaluator(labelCol="c_acctbal", metricName="r2").evaluate(m.transform(te))
            rows.append((scheme, i, float(r2)))
    res = spark.createDataFrame(rows, "scheme string, fold int, r2 double")
    return res.groupBy("scheme").agg(F.avg("r2").alias("r2_mean"), F.stddev("r2").alias("r2_std"), F.count(F.lit(1)).alias("folds"))


@query("aft_comparison", ["V7", "V8"])
def aft_comparison(spark, sf_dir):
    """Weibull, log-normal and log-logistic models of the time to the first
    error, with AIC, BIC and concordance; best AIC first."""
    from fathom.operators import aft, survival
    from fathom.plans.survival import subjects
    s = subjects(spark, sf_dir).where(F.col("duration") > 0).withColumn("risk_d", F.col("risk").cast("double")) \
        .withColumn("is_even", (F.col("grp") == "even").cast("double"))
    rows = []
    for name in aft.DISTRIBUTIONS:
        m = aft.fit(s, "duration", "event", ["risk_d", "is_even"], name)
        c = survival.c_index(s.withColumn("__risk", -m.median()), "duration", "event", "__risk").first()["c_index"]
        rows.append((name, m.intercept, *map(float, m.coefficients), m.sigma, m.log_likelihood, m.aic, m.bic, float(c), m.n, m.converged))
    return spark.createDataFrame(rows, "distribution string, intercept double, coef_risk double, coef_even double, sigma double, "
                                       "log_likelihood double, aic double, bic double, c_index double, n int, converged boolean") \
        .orderBy("aic")


@query("aft_weibull", ["V7"])
def aft_weibull(spark, sf_dir):
    from fathom.plans.survival import subjects
    s = subjects(spark, sf_dir).where(F.col("duration") > 0).withColumn("risk_d", F.col("risk").cast("double"))
    s = ml.assemble(s, ["risk_d"])
    m = AFTSurvivalRegression(censorCol="event", labelCol="duration", quantileProbabilities=[0.5],
                              quantilesCol="q").fit(s.withColumn("event", F.col("event").cast("double")))
    rows = [("intercept", float(m.intercept)), ("risk", float(m.coefficients[0])), ("scale", float(m.scale))]
    return spark.createDataFrame(rows, "term string, value double")


QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)


@query("quantile_regression", ["V12", "E36"])
def quantile_regression(spark, sf_dir):
    """Linear quantile regression by iteratively reweighted least squares:
    each iteration is one weighted Gram aggregate and a 2 x 2 solve."""
    li = Tables(spark, sf_dir).lineitem.select("l_quantity", "l_extendedprice").cache()
    rows = []
    for q in QUANTILES:
        beta = ml.ridge_solve(ml.gram(li, ["l_quantity"], ["l_extendedprice"]))
        for _ in range(15):
            r = F.col("l_extendedprice") - (F.lit(float(beta[0])) + F.lit(float(beta[1])) * F.col("l_quantity"))
            w = F.when(r >= 0, F.lit(q)).otherwise(F.lit(1 - q)) / F.greatest(F.abs(r), F.lit(1e-3))
            beta = ml.ridge_solve(ml.gram(li, ["l_quantity"], ["l_extendedprice"], weight=w))
        r = F.col("l_extendedprice") - (F.lit(float(beta[0])) + F.lit(float(beta[1])) * F.col("l_quantity"))
        loss = li.agg(F.avg(F.when(r >= 0, q * r).otherwise((q - 1) * r))).first()[0]
        rows.append((q, float(beta[0]), float(beta[1]), float(loss)))
    li.unpersist()
    return spark.createDataFrame(rows, "quantile double, intercept double, slope double, pinball double")





@query("isolation_forest", ["L26"])
def isolation_forest(spark, sf_dir):
    """Isolation-forest outlier flag at 3% contamination on the lineitem
    numerics (whole table): counts, cut and mean score."""
    from fathom.operators import iforest
    from fathom.operators.ordered import quantiles
    li = Tables(spark, sf_dir).lineitem
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    forest = iforest.fit(li.select(*key, *feats), feats, key, n_trees=100, psi=256)
    scored = stored(iforest.score(li.select(*feats), forest, feats, 256).select("anomaly_score"), "scores")
    cut = quantiles(scored.withColumn("__g", F.lit(1)), "anomaly_score", [0.97], ["__g"]).select(F.col("quantiles")[0].alias("cut"))
    j = scored.crossJoin(F.broadcast(cut))  # one row
    return j.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("anomaly_score") > F.col("cut")).cast("int")).alias("n_outliers"),
                 F.first("cut").alias("score_cut"), F.avg("anomaly_score").alias("mean_score"))


def _std_lineitem(spark, sf_dir):
    li = li_table(spark, sf_dir).drop("features")
    stats = li.where("split = 'train'").agg(*[F.avg(c).alias(f"m_{c}") for c in REG_FEATURES],
                                            *[F.stddev_pop(c).alias(f"s_{c}") for c in REG_FEATURES]).first()
    return li.withColumns({c: (F.col(c) - stats[f"m_{c}"]) / (stats[f"s_{c}"] or 1.0) for c in REG_FEATURES})


LANDMARKS = 50


@query("kernel_maps", ["L15", "L16"])
def kernel_maps(spark, sf_dir):
    """Ridge on raw features, on 50 random Fourier features and on a
    Nyström map with 50 hash-chosen landmarks: test RMSE of each.  One pass
    chooses the landmarks, one sums the Gram matrices of all maps."""
    import numpy as np
    from fathom.functions.hashing import salted_h32
    from fathom.operators import kernels
    li = _std_lineitem(spark, sf_dir)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    drawn = li.where("split = 'train'").select(*REG_FEATURES, salted_h32(key, "landmark").alias("__h"), key.alias("__k")) \
        .orderBy("__h", "__k").limit(LANDMARKS).collect()      # a top-k, kept small in each task
    maps = {"raw": kernels.IDENTITY, "rff_50": kernels.random_fourier(len(REG_FEATURES), 50, gamma=0.5),
            "nystroem_50": kernels.nystroem(np.array([[r[c] for c in REG_FEATURES] for r in drawn], dtype=float), 0.5)}
    grams = kernels.mapped_grams(li, REG_FEATURES, "label", "split", ["train", "test"], maps)
    rows = []
    for name in maps:
        g, t = grams[name, "train"], grams[name, "test"]
        r = np.append(ml.ridge_solve({"xx": g[:-1, :-1], "xy": g[:-1, -1:]}, 1e-3), -1.0)
        rows.append((name, float(np.sqrt(max(r @ t @ r, 0.0) / t[0, 0]))))
    return spark.createDataFrame(rows, "features string, test_rmse double")


@query("mice_impute", ["L5", "L2", "X24"])
def mice_impute(spark, sf_dir):
    """Mask 15% of cells by hash (X24), impute by median (L2) and by chained
    equations (L5), and score both against the true values."""
    from fathom.operators import kernels
    from fathom.sources.tables import with_injected_missing
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    li = Tables(spark, sf_dir).lineitem.select(*key, *cols, *[F.col(c).alias(f"true_{c}") for c in cols])
    masked = stored(with_injected_missing(li, key, cols).drop(*key), "masked")
    med = {c: q[0] if q else 0.0 for c, q in quantile_row(masked, cols, [0.5], prefix="").first().asDict().items()}
    j = kernels.mice(masked.withColumns({f"m_{c}": F.col(c).isNull() for c in cols}), cols, start=med)
    rows = j.agg(*[F.sqrt(F.avg(F.when(F.col(f"m_{c}"), (F.col(c) - F.col(f"true_{c}")) ** 2))).alias(f"mice_{c}") for c in cols],
                 *[F.sqrt(F.avg(F.when(F.col(f"m_{c}"), (F.lit(float(med[c])) - F.col(f"true_{c}")) ** 2))).alias(f"median_{c}")
                   for c in cols]).first()
    out = [(c, float(rows[f"median_{c}"]), float(rows[f"mice_{c}"])) for c in cols]
    return spark.createDataFrame(out, "column_name string, median_rmse double, mice_rmse double")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("knn_impute", ["L4", "X24"])
def knn_impute(spark, sf_dir):
    """Mask 15% of ``l_extendedprice`` by hash (X24) and fill it from the
    nearest lines in raw (l_quantity, p_retailprice): k=5 uniform and k=7
    by inverse distance, both from one exact k=7 donor search.  Filled
    count, RMSE and MAE against the true values over the masked cells."""
    from fathom.operators import neighbors
    from fathom.sources.tables import with_injected_missing
    t = Tables(spark, sf_dir)
    feats = ["l_quantity", "p_retailprice"]
    li = t.lineitem.select(*LINE_KEY, "l_quantity", "l_extendedprice") \
        .join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey") \
        .withColumn("line_key", F.concat_ws("-", *LINE_KEY))
    truth = li.select("line_key", F.col("l_extendedprice").alias("true_price"))
    masked = with_injected_missing(li, LINE_KEY, ["l_extendedprice"]).select("line_key", *feats, "l_extendedprice")
    nb = neighbors.impute_neighbours(masked, "line_key", "l_extendedprice", feats, 7)
    outs = []
    for k, w in [(5, "uniform"), (7, "distance")]:
        imp = neighbors.knn_impute(masked, "line_key", "l_extendedprice", feats, k, w, nb=nb)
        err = F.col("l_extendedprice") - F.col("true_price")
        outs.append(imp.where("missing_l_extendedprice").join(truth, "line_key").agg(
            F.lit(f"knn_k{k}_{w}").alias("method"), F.count(F.lit(1)).alias("n_masked"),
            F.count("l_extendedprice").alias("n_filled"),
            F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae")))
    return outs[0].unionByName(outs[1])


def _standardise(train, test, feats):
    st = train.agg(*[F.avg(c).alias(f"m_{c}") for c in feats], *[F.stddev_pop(c).alias(f"s_{c}") for c in feats]).first()
    f = {c: (F.col(c) - F.lit(float(st[f"m_{c}"]))) / F.lit(float(st[f"s_{c}"] or 1.0)) for c in feats}
    return train.withColumns(f), test.withColumns(f)


@query("knn_models", ["M10"])
def knn_models(spark, sf_dir):
    """KNN classifier (k=7, inverse-distance vote) on the standardised
    document features and KNN regressors (k=7 inverse distance, k=5
    uniform) on the standardised lineitem features, all from the exact grid
    neighbour join: test AUC/F1 and RMSE/R2 as (model, metric, value)."""
    from fathom.operators import neighbors
    d = doc_table(spark, sf_dir).drop("features")
    tr, te = _standardise(d.where("split = 'train'"), d.where("split = 'test'"), CLS_FEATURES)
    nb = neighbors.knn(te, tr.withColumnRenamed("doc_id", "ref_id"), CLS_FEATURES, 7, qid="doc_id", rid="ref_id",
                       ref_cols=["label"])
    vote = neighbors.class_vote(nb, "doc_id", "label", "distance")
    p = vote.groupBy("doc_id").agg(F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("share"))), F.lit(0.0)).alias("p1")) \
        .join(te.select("doc_id", F.col("label").cast("int").alias("y")), "doc_id")
    cls = C.roc_auc(p, "y", "p1").select(F.lit("knn_classifier_k7_distance").alias("model"), F.lit("roc_auc").alias("metric"),
                                         F.col("roc_auc").alias("value")) \
        .unionByName(C.binary_metrics(p, "y", "p1", 0.5).select(
            F.lit("knn_classifier_k7_distance").alias("model"), F.lit("f1").alias("metric"), F.col("f1").alias("value")))
    li = stored(_std_lineitem(spark, sf_dir).select(F.concat_ws("-", *LINE_KEY).alias("line_key"), *REG_FEATURES, "label", "split"), "lines")
    ref = li.where("split = 'train'").select(F.col("line_key").alias("ref_key"), *REG_FEATURES, "label")
    q = li.where("split = 'test'").select("line_key", *REG_FEATURES, "label")
    # lines and neighbours are stored, as several passes read them
    nb = neighbors.knn(q, ref, REG_FEATURES, 7, qid="line_key", rid="ref_key", ref_cols=["label"])
    names = {"knn_regressor_k7_distance": (7, "distance"), "knn_regressor_k5_uniform": (5, "uniform")}
    near = stored(nb.select("line_key", "rank", "distance", "label"), "neighbours")
    out, true = cls, q.select("line_key", F.col("label").alias("true"))
    for name, (k, w) in names.items():
        pred = neighbors.weighted_mean(near.where(F.col("rank") <= k), "line_key", "label", w)
        e = F.col("true") - F.col("label")
        m = pred.join(true, "line_key").agg(
            F.sqrt(F.avg(e * e)).alias("rmse"),
            (1 - F.sum(e * e) / (F.sum(F.col("true") ** 2) - F.sum("true") ** 2 / F.count(F.lit(1)))).alias("r2"))
        both = F.explode(F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).alias("value")) for v in ("rmse", "r2")]))
        out = out.unionByName(m.select(both.alias("s")).select(F.lit(name).alias("model"), "s.metric", "s.value"))
    return out
