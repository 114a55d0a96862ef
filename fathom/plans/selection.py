"""Model selection (M13, M15, M20, E47, H8): candidate tables over several
cross-validation schemes, penalty paths and randomised search."""

from __future__ import annotations

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from fathom.functions.hashing import sql_bucket, sql_key_text
from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import crossval, folds, ml, penalty, search
from fathom.plans.common import LI_KEY, coords, sql_coords
from fathom.plans.registry import query
from fathom.sources.tables import Tables

FOLDS, REPEATS = 5, 3
BASIC = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
SCHEMES = [
    crossval.Scheme("shuffled", ("fold_0",), FOLDS),
    crossval.Scheme("repeated", tuple(f"fold_{r}" for r in range(REPEATS)), FOLDS),
    crossval.Scheme("time", ("fold_time",), FOLDS, expanding=True),
    crossval.Scheme("space", ("fold_space",), FOLDS),
]
LEARNERS = {
    "mean": crossval.Linear(),
    "line": crossval.Linear(("l_quantity",)),
    "ridge_line": crossval.Linear(("l_quantity",), alpha=1e6),
}


def priced_lines(spark, sf_dir, ordered: bool = True):
    """Line items with their price as label, and fold numbers: hash folds in
    three repeats, fifths of the map by supplier, and (``ordered``: all rows
    are put in order) fifths of the time."""
    _, lon = coords("l_suppkey")
    li = Tables(spark, sf_dir).lineitem.select(*LI_KEY, "l_quantity", "l_discount", "l_tax", "l_shipdate",
                                               F.col("l_extendedprice").alias("label"))
    for r in range(REPEATS):
        li = folds.kfold(li, LI_KEY, FOLDS, f"cv{r}", name=f"fold_{r}")
    li = li.withColumn("fold_space", F.least(F.floor((lon + 180.0) / 72.0).cast("int"), F.lit(FOLDS - 1)))
    if ordered:
        li = folds.ordered_tiles(li, ["l_shipdate", *LI_KEY], FOLDS, "__tile").withColumn("fold_time", F.col("__tile") - 1).drop("__tile")
    return li.withColumn("l_linenumber", F.col("l_linenumber").cast("double"))


_KT = sql_key_text(*LI_KEY)
_SPLITS = " UNION ALL ".join(
    f"SELECT '{s.name}' AS scheme, {r} AS repeat, i AS fold, x, y, "
    + (f"CASE WHEN {c} = i THEN 'test' WHEN {c} < i THEN 'train' END AS part" if s.expanding else
       f"CASE WHEN {c} = i THEN 'test' ELSE 'train' END AS part")
    + f" FROM z CROSS JOIN range({int(s.expanding)}, {s.folds}) AS t(i)"
    for s in SCHEMES for r, c in enumerate(s.columns))
SQL_CANDIDATES = f"""
z AS (SELECT l_extendedprice AS y, CAST(l_quantity AS DOUBLE) AS x, {", ".join(f"{sql_bucket(_KT, f'cv{r}', FOLDS)} AS fold_{r}" for r in range(REPEATS))},
             least(CAST(floor(({sql_coords('l_suppkey')[1]} + 180.0e0) / 72.0e0) AS INTEGER), {FOLDS - 1}) AS fold_space,
             ntile({FOLDS}) OVER (ORDER BY l_shipdate, {", ".join(LI_KEY)}) - 1 AS fold_time FROM lineitem),
sp AS ({_SPLITS}),
st AS (SELECT scheme, repeat, fold, avg(x) AS mx, avg(y) AS my, regr_sxy(y, x) AS sxy, regr_sxx(y, x) AS sxx
       FROM sp WHERE part = 'train' GROUP BY ALL),
le AS (SELECT scheme, repeat, fold, mx, my, 'mean' AS learner, 0.0e0 AS b FROM st
       UNION ALL SELECT scheme, repeat, fold, mx, my, 'line', sxy / sxx FROM st
       UNION ALL SELECT scheme, repeat, fold, mx, my, 'ridge_line', sxy / (sxx + 1e6) FROM st),
er AS (SELECT scheme, repeat, fold, learner, part, sqrt(avg(power(y - my - b * (x - mx), 2))) AS rmse,
              avg(abs(y - my - b * (x - mx))) AS mae, 1 - sum(power(y - my - b * (x - mx), 2)) / (var_pop(y) * count(*)) AS r2
       FROM sp JOIN le USING (scheme, repeat, fold) WHERE part IS NOT NULL GROUP BY ALL),
ct AS (SELECT scheme, learner, count(*) FILTER (WHERE part = 'test') AS n_splits, avg(rmse) FILTER (WHERE part = 'test') AS cv_rmse,
              stddev_pop(rmse) FILTER (WHERE part = 'test') AS cv_rmse_std, avg(rmse) FILTER (WHERE part = 'train') AS train_rmse,
              avg(mae) FILTER (WHERE part = 'test') AS cv_mae, avg(r2) FILTER (WHERE part = 'test') AS cv_r2,
              avg(r2) FILTER (WHERE part = 'train') AS train_r2 FROM er GROUP BY ALL)"""
_SCORED = ("cv_rmse", "cv_rmse_std", "train_rmse", "cv_mae")


def _linear_table(spark, sf_dir):
    return crossval.candidate_table(crossval.linear_scores(priced_lines(spark, sf_dir), ["l_quantity"], "label", LEARNERS, SCHEMES))


@query("cv_candidate_table", ["M15", "H5", "H8"], sql=f"""
WITH {SQL_CANDIDATES}
SELECT scheme, learner, n_splits, {", ".join(f"{sql_rnd(c, 4)} AS {c}" for c in _SCORED)}, {sql_rnd('cv_r2', 8)} AS cv_r2,
       {sql_rnd('train_r2', 8)} AS train_r2, {sql_rnd('cv_rmse - train_rmse', 4)} AS gap,
       CAST(row_number() OVER (PARTITION BY scheme ORDER BY cv_rmse, learner) AS INTEGER) AS place FROM ct
""")
def cv_candidate_table(spark, sf_dir):
    """Linear learners under shuffled, repeated, time-ordered and spatial folds, from two passes over the rows."""
    t = _linear_table(spark, sf_dir)
    return t.select("scheme", "learner", "n_splits", *[rnd(c, 4).alias(c) for c in _SCORED],
                    *[rnd(c, 8).alias(c) for c in ("cv_r2", "train_r2")], rnd("gap", 4).alias("gap"), F.col("place").cast("int").alias("place"))


@query("cv_scheme_inflation", ["H8", "F12"], sql=f"""
WITH {SQL_CANDIDATES}
SELECT a.scheme, learner, {sql_rnd('a.cv_rmse / b.cv_rmse - 1', 8)} AS inflation
FROM ct a JOIN ct b USING (learner) WHERE b.scheme = 'shuffled' AND a.scheme <> 'shuffled'
""")
def cv_scheme_inflation(spark, sf_dir):
    """How much shuffled folds flatter each learner against the other schemes."""
    i = crossval.scheme_inflation(_linear_table(spark, sf_dir), "shuffled")
    return i.select("scheme", "learner", rnd("inflation", 8).alias("inflation"))


@query("cv_learner_table", ["M15", "H8", "M2", "M4", "M5", "M6"])
def cv_learner_table(spark, sf_dir):
    """Tree learners and regressions of several features, cross-validated under three schemes with fit times."""
    from fathom.session import cut_lineage, stored
    three = [crossval.Scheme(s.name, s.columns[:1], s.folds, s.expanding) for s in SCHEMES if s.name != "repeated"]
    rows = stored(priced_lines(spark, sf_dir).select(*BASIC, "label", *[c for s in three for c in s.columns]), "lines")
    learners = {
        "tree_6": lambda: DecisionTreeRegressor(maxDepth=6, seed=42),
        "forest_20": lambda: RandomForestRegressor(numTrees=20, maxDepth=5, seed=42),
    }
    scores = crossval.linear_scores(rows, BASIC, "label", {"linear": crossval.Linear(tuple(BASIC))}, three) \
        .unionByName(crossval.estimator_scores(ml.assemble(rows, BASIC), "label", learners, three))
    table = crossval.candidate_table(cut_lineage(scores))
    return table.join(crossval.scheme_inflation(table, "shuffled"), ["scheme", "learner"], "left")


def expanded(df):
    """Squares and products of the four features beside them: 14 columns."""
    made = {c: F.col(c).cast("double") for c in BASIC}
    for i, a in enumerate(BASIC):
        for b in BASIC[i:]:
            made[f"{a}_x_{b}"] = F.col(a).cast("double") * F.col(b).cast("double")
    return df.withColumns(made), list(made)


PENALTIES = penalty.log_grid(-3, 3, 60)
MIXED = [0.1, 0.3, 0.5, 0.7, 0.9]


@query("penalty_choice", ["M20", "M14"])
def penalty_choice(spark, sf_dir):
    """Ridge, lasso and elastic net on the expanded features: share and
    penalty of least cross-validated error, and how many coefficients are zero."""
    df, names = expanded(priced_lines(spark, sf_dir, ordered=False))
    found = penalty.choose(df, names, "label", "fold_0", FOLDS, PENALTIES,
                           {"ridge": [penalty.RIDGE], "lasso": [1.0], "elastic_net": MIXED})
    rows = [(c.family, c.share, c.penalty, float(c.cv_mse.min() ** 0.5), c.zeroed, n, float(b))
            for c in found.values() for n, b in zip(["intercept", *names], c.coefficients)]
    return spark.createDataFrame(rows, "family string, l1_share double, penalty double, cv_rmse double, zeroed int, "
                                       "term string, coefficient double")


@query("coefficient_paths", ["E47"])
def coefficient_paths(spark, sf_dir):
    """Coefficients of ridge and lasso along 60 penalties, with the cross-validated error of each."""
    df, names = expanded(priced_lines(spark, sf_dir, ordered=False))
    found = penalty.choose(df, names, "label", "fold_0", FOLDS, penalty.log_grid(-4, 3, 60), {"ridge": [penalty.RIDGE], "lasso": [1.0]})
    grid = penalty.log_grid(-4, 3, 60)
    rows = [(c.family, a, n, float(c.paths[i, j + 1]), float(c.cv_rmse[i])) for c in found.values()
            for i, a in enumerate(grid) for j, n in enumerate(names)]
    return spark.createDataFrame(rows, "family string, penalty double, feature string, coefficient double, cv_rmse double")


FAMILIES = {
    "linear": search.Family(LinearRegression, {"regParam": search.LogUniform(1e-3, 1e3), "elasticNetParam": search.Uniform(0.0, 1.0)}, {}),
    "tree": search.Family(DecisionTreeRegressor, {"maxDepth": search.IntRange(2, 10), "minInstancesPerNode": search.IntRange(1, 20)}, {"seed": 42}),
    "forest": search.Family(RandomForestRegressor, {"maxDepth": search.IntRange(3, 8), "numTrees": search.IntRange(5, 20),
                                                    "featureSubsetStrategy": search.Choice(("all", "sqrt", "onethird"))}, {"seed": 42}),
    "boosting": search.Family(GBTRegressor, {"maxDepth": search.IntRange(2, 4), "stepSize": search.LogUniform(0.05, 0.5)}, {"maxIter": 8, "seed": 42}),
}


@query("randomised_search", ["M13", "M15"])
def randomised_search(spark, sf_dir):
    """Three random candidates of each of four families, three-fold CV on the
    training rows, the best refitted and scored on the test rows."""
    from fathom.session import stored
    df = folds.holdout(folds.kfold(priced_lines(spark, sf_dir, ordered=False), LI_KEY, 3, "search"), LI_KEY)
    df = ml.assemble(stored(df.select(*BASIC, "label", "fold", "split"), "lines"), BASIC)
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    table, best, name = search.random_search(train, "label", FAMILIES, 3, crossval.Scheme("search", ("fold",), 3))
    refit = best.transform(test).agg(*crossval.errors()).select(F.col("rmse").alias("refit_test_rmse"), F.col("r2").alias("refit_test_r2"))
    chosen = F.col("learner") == name
    return table.crossJoin(F.broadcast(refit)).select(
        "place", "family", F.col("learner").alias("candidate"), "parameters", "cv_rmse", "cv_rmse_std", "train_rmse", "gap", "fit_seconds",
        *[F.when(chosen, F.col(c)).alias(c) for c in ("refit_test_rmse", "refit_test_r2")])


@query("recursive_elimination", ["L25"])
def recursive_elimination(spark, sf_dir):
    """The 14 expanded features down to six, all steps from one Gram matrix."""
    df, names = expanded(priced_lines(spark, sf_dir, ordered=False))
    gram = sum(crossval.fold_grams(df, names, "label", {"fold_0": FOLDS}).values())
    steps = penalty.eliminate(gram, names, 6)
    return spark.createDataFrame([(i + 1, d, b, ",".join(left)) for i, (d, b, left) in enumerate(steps)],
                                 "step int, dropped string, coefficient double, kept string")
