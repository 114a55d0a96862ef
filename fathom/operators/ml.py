"""Model training and scoring on Spark (M1-M23 and the model-based
reports).  Learners are Spark ML estimators; closed-form models (ridge
variants, Bayesian ridge, LDA, multi-output least squares, nested-set R^2)
use one distributed aggregate of the Gram matrix and solve the d x d system
on the driver: only d x d numbers ever leave the executors."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.session import ensure_checkpoint_dir


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """The feature list fixed at fit time, NULL rows skipped at fit."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip").transform(df)


def positive_probability(df: DataFrame, col: str = "probability", out: str = "p1") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(col))[1])


def ridge_reg_param(alpha: float, n: int) -> float:
    """scikit-learn alpha -> Spark regParam for ridge (Spark's loss is
    1/(2n) sum r^2 + regParam/2 ||w||^2)."""
    return alpha / n


def fit_and_time(estimator, train: DataFrame):
    t0 = time.perf_counter()
    model = estimator.fit(train)
    return model, time.perf_counter() - t0


def tree_nodes(model) -> dict[str, np.ndarray]:
    """Nodes of a fitted regression tree by id (the root 0): feature (-1 at
    leaves), threshold, left and right child, prediction.  Read from the
    model as Spark stores it, at most 2^(depth + 1) of them."""
    path = f"{ensure_checkpoint_dir(SparkSession.getActiveSession())}/tree-{uuid.uuid4().hex}"
    model.save(path)
    nodes = SparkSession.getActiveSession().read.parquet(f"{path}/data").select(
        "id", F.when(F.col("leftChild") < 0, F.lit(-1)).otherwise(F.col("split.featureIndex")).alias("feature"),
        F.coalesce(F.get("split.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), "prediction").toPandas().sort_values("id")
    return {c: nodes[c].to_numpy() for c in nodes.columns[1:]}


def depth_scores(df: DataFrame, features: Sequence[str], label: str, part: str, nodes: dict[str, np.ndarray],
                 depths: Sequence[int]) -> DataFrame:
    """(depth, part, n, rmse) of a tree cut at each depth, on the rows of
    each ``part``, from one pass.  Trees grow level by level, so the tree of a
    smaller depth is the upper levels of a deeper one."""
    deepest, wanted, p = max(depths), set(depths), len(features)

    def run(batches):
        sums = {}
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy() for i in range(p)])
            y, parts = batch.column(p).to_numpy(), np.asarray(batch.column(p + 1).to_pylist(), dtype=object)
            at, rows = np.zeros(len(y), np.int64), np.arange(len(y))
            groups = [(name, parts == name) for name in set(parts.tolist())]
            for depth in range(deepest + 1):
                if depth:
                    feature = nodes["feature"][at]
                    below = np.where(x[rows, feature] <= nodes["threshold"][at], nodes["left"][at], nodes["right"][at])
                    at = np.where(feature < 0, at, below)
                if depth in wanted:
                    error = np.square(y - nodes["prediction"][at])
                    for name, mine in groups:
                        n, ss = sums.get((depth, name), (0, 0.0))
                        sums[depth, name] = (n + int(mine.sum()), ss + float(error[mine].sum()))
        keys = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()),
                                          pa.array([sums[k][0] for k in keys], pa.int64()),
                                          pa.array([sums[k][1] for k in keys], pa.float64())], names=["depth", "part", "n", "ss"])

    rows = df.select(*[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate([*features, label])], F.col(part).alias("__part")).dropna()
    return rows.mapInArrow(run, "depth int, part string, n long, ss double").groupBy("depth", "part") \
        .agg(F.sum("n").alias("n"), F.sqrt(F.sum("ss") / F.sum("n")).alias("rmse"))


def gram(df: DataFrame, features: Sequence[str], targets: Sequence[str], weight: Column | None = None) -> dict:
    """One aggregate: n, sums, X'X and X'Y (with an intercept column)."""
    cols = ["__one"] + list(features)
    w = weight if weight is not None else F.lit(1.0)
    d = df.select(F.lit(1.0).alias("__one"), *[F.col(c).cast("double") for c in features],
                  *[F.col(t).cast("double").alias(f"__t{k}") for k, t in enumerate(targets)], w.alias("__w")).dropna()
    exprs = [F.sum(F.col("__w")).alias("sw")]
    for i, a in enumerate(cols):
        for j, b in enumerate(cols[i:], start=i):
            exprs.append(F.sum(F.col("__w") * F.col(a) * F.col(b)).alias(f"xx_{i}_{j}"))
        for k, t in enumerate(targets):
            exprs.append(F.sum(F.col("__w") * F.col(a) * F.col(f"__t{k}")).alias(f"xy_{i}_{k}"))
    for k, t in enumerate(targets):
        exprs.append(F.sum(F.col("__w") * F.col(f"__t{k}") * F.col(f"__t{k}")).alias(f"yy_{k}"))
    row = d.agg(*exprs).first()
    p = len(cols)
    xx = np.zeros((p, p))
    xy = np.zeros((p, len(targets)))
    for i in range(p):
        for j in range(i, p):
            xx[i, j] = xx[j, i] = row[f"xx_{i}_{j}"] or 0.0
        for k in range(len(targets)):
            xy[i, k] = row[f"xy_{i}_{k}"] or 0.0
    yy = np.array([row[f"yy_{k}"] or 0.0 for k in range(len(targets))])
    return {"n": row["sw"] or 0.0, "xx": xx, "xy": xy, "yy": yy, "names": cols}


def gram_by(df: DataFrame, features: Sequence[str], targets: Sequence[str], group: str,
            weight: Column | None = None) -> dict:
    """``gram`` for every value of ``group`` in one grouped aggregate (the
    group count must be small: replicates, folds)."""
    cols = ["__one"] + list(features)
    w = weight if weight is not None else F.lit(1.0)
    d = df.select(F.col(group).alias("__g"), F.lit(1.0).alias("__one"), *[F.col(c).cast("double") for c in features],
                  *[F.col(t).cast("double").alias(f"__t{k}") for k, t in enumerate(targets)], w.alias("__w")).dropna()
    exprs = [F.sum(F.col("__w")).alias("sw")]
    for i, a in enumerate(cols):
        for j, b in enumerate(cols[i:], start=i):
            exprs.append(F.sum(F.col("__w") * F.col(a) * F.col(b)).alias(f"xx_{i}_{j}"))
        for k in range(len(targets)):
            exprs.append(F.sum(F.col("__w") * F.col(a) * F.col(f"__t{k}")).alias(f"xy_{i}_{k}"))
    for k in range(len(targets)):
        exprs.append(F.sum(F.col("__w") * F.col(f"__t{k}") * F.col(f"__t{k}")).alias(f"yy_{k}"))
    out = {}
    p = len(cols)
    for row in d.groupBy("__g").agg(*exprs).collect():  # one row per group value
        xx = np.zeros((p, p))
        xy = np.zeros((p, len(targets)))
        for i in range(p):
            for j in range(i, p):
                xx[i, j] = xx[j, i] = row[f"xx_{i}_{j}"] or 0.0
            for k in range(len(targets)):
                xy[i, k] = row[f"xy_{i}_{k}"] or 0.0
        out[row["__g"]] = {"n": row["sw"], "xx": xx, "xy": xy,
                           "yy": np.array([row[f"yy_{k}"] or 0.0 for k in range(len(targets))]), "names": cols}
    return out


def ridge_solve(g: dict, alpha: float = 0.0, k: int = 0) -> np.ndarray:
    """Coefficients (intercept first) of ridge on target k; the intercept is
    not penalised."""
    pen = alpha * np.eye(g["xx"].shape[0])
    pen[0, 0] = 0.0
    return np.linalg.solve(g["xx"] + pen, g["xy"][:, k])


def r2_from_gram(g: dict, beta: np.ndarray, k: int = 0) -> float:
    n = g["n"]
    sy = g["xy"][0, k]
    sst = g["yy"][k] - sy * sy / n
    sse = g["yy"][k] - 2 * beta @ g["xy"][:, k] + beta @ g["xx"] @ beta
    return float(1 - sse / sst) if sst > 0 else float("nan")


def nested_uplift(g: dict, sets: Sequence[Sequence[str]], alpha: float = 0.0) -> list[tuple[str, float]]:
    """H6: R^2 of each nested feature set, from sub-matrices of one Gram."""
    names = g["names"]
    out = []
    for s in sets:
        idx = [0] + [names.index(c) for c in s]
        sub = {"n": g["n"], "xx": g["xx"][np.ix_(idx, idx)], "xy": g["xy"][idx, :], "yy": g["yy"]}
        beta = ridge_solve(sub, alpha)
        out.append(("+".join(s), r2_from_gram(sub, beta)))
    return out


def bayesian_ridge(g: dict, k: int = 0, iters: int = 300, tol: float = 1e-6) -> dict:
    """Evidence maximisation (MacKay updates) on the centred Gram
    matrix; returns coefficients, alpha (noise precision), lambda (weight
    precision) and the posterior covariance for per-row std."""
    n = g["n"]
    p = g["xx"].shape[0] - 1
    mx = g["xx"][0, 1:] / n
    my = g["xy"][0, k] / n
    sxx = g["xx"][1:, 1:] - n * np.outer(mx, mx)
    sxy = g["xy"][1:, k] - n * mx * my
    syy = g["yy"][k] - n * my * my
    eig, vec = np.linalg.eigh(sxx)
    alpha, lam = 1.0 / max(syy / n, 1e-12), 1.0
    coef = np.zeros(p)
    for _ in range(iters):
        cov = np.linalg.inv(alpha * sxx + lam * np.eye(p))
        coef = alpha * cov @ sxy
        gamma = float(np.sum(alpha * eig / (lam + alpha * eig)))
        lam_new = gamma / max(float(coef @ coef), 1e-12)
        rss = syy - 2 * coef @ sxy + coef @ sxx @ coef
        alpha_new = (n - gamma) / max(float(rss), 1e-12)
        done = abs(lam_new - lam) < tol * lam and abs(alpha_new - alpha) < tol * alpha
        alpha, lam = alpha_new, lam_new
        if done:
            break
    cov = np.linalg.inv(alpha * sxx + lam * np.eye(p))
    intercept = my - mx @ coef
    return {"coef": coef, "intercept": float(intercept), "alpha": float(alpha), "lambda": float(lam),
            "cov": cov, "mx": mx}


def predictive_std(df: DataFrame, features: Sequence[str], fit: dict) -> Column:
    """sqrt(1/alpha + (x - mean)' Sigma (x - mean)) as a column expression."""
    p = len(features)
    xc = [F.col(c) - F.lit(float(fit["mx"][i])) for i, c in enumerate(features)]
    quad = F.lit(0.0)
    for i in range(p):
        for j in range(p):
            quad = quad + F.lit(float(fit["cov"][i, j])) * xc[i] * xc[j]
    return F.sqrt(F.lit(1.0 / fit["alpha"]) + quad)


def lda_fit(df: DataFrame, features: Sequence[str], label: str) -> dict:
    """M8 (linear discriminant): class counts, means and the pooled
    covariance from one grouped aggregate of sums and cross-products."""
    exprs = [F.count(F.lit(1)).alias("n")] + [F.sum(c).alias(f"s_{i}") for i, c in enumerate(features)]
    exprs += [F.sum(F.col(a) * F.col(b)).alias(f"p_{i}_{j}") for i, a in enumerate(features)
              for j, b in enumerate(features) if j >= i]
    rows = df.groupBy(label).agg(*exprs).collect()  # one row per class
    d = len(features)
    total = sum(r["n"] for r in rows)
    pooled = np.zeros((d, d))
    means, priors = {}, {}
    for r in rows:
        n = r["n"]
        s = np.array([r[f"s_{i}"] for i in range(d)])
        m = s / n
        pp = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                pp[i, j] = pp[j, i] = r[f"p_{i}_{j}"]
        pooled += pp - n * np.outer(m, m)
        means[r[label]] = m
        priors[r[label]] = n / total
    pooled /= max(total - len(rows), 1)
    inv = np.linalg.pinv(pooled)
    return {"means": means, "priors": priors, "inv": inv, "features": list(features)}


def lda_scores(df: DataFrame, fit: dict) -> DataFrame:
    """Linear discriminant per class, posterior of class 1 by softmax."""
    feats = fit["features"]
    scores = {}
    for cls, m in fit["means"].items():
        w = fit["inv"] @ m
        b = -0.5 * m @ fit["inv"] @ m + np.log(fit["priors"][cls])
        expr = F.lit(float(b))
        for i, c in enumerate(feats):
            expr = expr + F.lit(float(w[i])) * F.col(c)
        scores[cls] = expr
    classes = sorted(scores)
    mx = F.greatest(*[scores[c] for c in classes]) if len(classes) > 1 else scores[classes[0]]
    den = sum((F.exp(scores[c] - mx) for c in classes), F.lit(0.0))
    return df.withColumn("p1", F.exp(scores[classes[-1]] - mx) / den)


def qda_fit(df: DataFrame, features: Sequence[str], label: str, reg: float = 0.1) -> dict:
    """M8 (quadratic discriminant): prior, mean and covariance of each class,
    (1 - reg) S + reg I, from one grouped aggregate.  Classes with fewer than
    two rows are left out."""
    d = len(features)
    exprs = [F.count(F.lit(1)).alias("n")] + [F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)]
    exprs += [F.covar_samp(F.col(features[i]), F.col(features[j])).alias(f"c_{i}_{j}") for i in range(d) for j in range(i, d)]
    rows = [r for r in df.select(label, *[F.col(c).cast("double").alias(c) for c in features]).dropna().groupBy(label).agg(*exprs).collect()
            if r["n"] > 1]                                    # one row per class
    total = sum(r["n"] for r in rows)
    classes = {}
    for r in rows:
        cov = np.array([[r[f"c_{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)])
        cov = (1 - reg) * cov + reg * np.eye(d)
        classes[r[label]] = {"prior": r["n"] / total, "mean": np.array([r[f"m_{i}"] for i in range(d)]),
                             "inverse": np.linalg.inv(cov), "log_det": float(np.linalg.slogdet(cov)[1])}
    return {"features": list(features), "classes": classes}


def qda_scores(df: DataFrame, fit: dict, out: str = "p1") -> DataFrame:
    """df with the posterior of the largest class label, from the classes' log densities."""
    feats, classes = fit["features"], sorted(fit["classes"])
    scores = {}
    for cls in classes:
        c = fit["classes"][cls]
        apart = [F.col(f) - F.lit(float(c["mean"][i])) for i, f in enumerate(feats)]
        square = sum((F.lit(float(c["inverse"][i, j])) * apart[i] * apart[j] for i in range(len(feats)) for j in range(len(feats))), F.lit(0.0))
        scores[cls] = F.lit(float(np.log(c["prior"]) - 0.5 * c["log_det"])) - 0.5 * square
    last = scores[classes[-1]]
    odds = sum((F.exp(scores[c] - last) for c in classes[:-1]), F.lit(0.0))
    return df.withColumn(out, 1 / (1 + odds))


def coefficient_table(model, features: Sequence[str], name: str, spark) -> DataFrame:
    """Signed coefficients or importances of a fitted model."""
    if hasattr(model, "coefficients"):
        vals = model.coefficients.toArray().tolist()
        kind = "coefficient"
    elif hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray().tolist()
        kind = "importance"
    else:
        return spark.createDataFrame([], "model string, feature string, kind string, value double")
    return spark.createDataFrame([(name, f, kind, float(v)) for f, v in zip(features, vals)],
                                 "model string, feature string, kind string, value double")
