"""Significance tests over score tables (H1-H5) and a two-sample t-test.

Score tables are long (model, fold, score) frames: small, one row per
model and fold.  Ranks use window functions partitioned by fold or model
pair; average ranks for ties come from rank() plus the tie count.  P-values
use the shared SQL formulas in ``functions.special`` (normal approximation
for Wilcoxon, chi-square for Friedman) so that they can be reproduced by
the oracle; SciPy's exact small-sample Wilcoxon tables are not used.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.special import sql_chi2_sf, sql_norm_cdf
from fathom.session import cut_lineage


def avg_rank(order: Column, partition: list[str], tie_key: Column) -> Column:
    w = Window.partitionBy(*partition).orderBy(order)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*partition, tie_key))
    return F.rank().over(w) + (ties - 1) / 2.0


def oof_group_mean_scores(df: DataFrame, y: str, fold_col: str, k: int, models: Mapping[str, Column | None]) -> DataFrame:
    """(model, fold, split, rmse) for group-mean models: every row is
    predicted, for each held-out fold i, by the mean over rows outside fold
    i with the same key (overall mean outside i when the key is unseen).
    Test rows are fold i, training rows the rest.  A fold's squared error
    about a prediction p is sum y^2 - 2 p sum y + n p^2, so everything comes
    from one aggregate per (model, key, fold); y is centred first, which keeps
    the squares small."""
    at = df.agg(F.count(F.lit(1)).alias("an"), F.avg(y).alias("am"))  # one row
    pairs = F.array(*[F.struct(F.lit(name).alias("model"),
                               (key if key is not None else F.lit("")).cast("string").alias("k"))
                      for name, key in models.items()])
    d = df.crossJoin(F.broadcast(at)).select((F.col(y) - F.col("am")).alias("__y"), F.col(fold_col).alias("__f"),
                                             F.explode(pairs).alias("__p")) \
        .select("__y", "__f", F.col("__p.model").alias("model"), F.col("__p.k").alias("__k"))
    kf = cut_lineage(d.groupBy("model", "__k", "__f").agg(
        F.count(F.lit(1)).alias("kn"), F.sum("__y").alias("ks"), F.sum(F.col("__y") * F.col("__y")).alias("kq")))
    kt = kf.groupBy("model", "__k").agg(F.sum("kn").alias("tn"), F.sum("ks").alias("ts"))
    ft = kf.groupBy("model", "__f").agg(F.sum("kn").alias("fn"), F.sum("ks").alias("fs"))
    ft = ft.groupBy(F.col("__f").alias("__i")).agg(F.max("fn").alias("fn"), F.max("fs").alias("fs"))  # k rows
    held = kf.select("model", "__k", F.col("__f").alias("__i"), F.col("kn").alias("on"), F.col("ks").alias("os"))
    tot = ft.agg(F.sum("fn").alias("an"), F.sum("fs").alias("as"))
    j = kf.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))) \
        .join(held, ["model", "__k", "__i"], "left").join(kt, ["model", "__k"]) \
        .join(F.broadcast(ft), "__i").crossJoin(F.broadcast(tot))
    n_out = F.col("tn") - F.coalesce("on", F.lit(0))
    pred = F.when(n_out > 0, (F.col("ts") - F.coalesce("os", F.lit(0.0))) / n_out) \
        .otherwise((F.col("as") - F.col("fs")) / (F.col("an") - F.col("fn")))
    sse = F.col("kq") - 2 * F.col("__pred") * F.col("ks") + F.col("kn") * F.col("__pred") * F.col("__pred")
    return j.withColumn("__pred", pred) \
        .groupBy("model", F.col("__i").cast("int").alias("fold"),
                 F.when(F.col("__f") == F.col("__i"), "test").otherwise("train").alias("split")) \
        .agg(F.sqrt(F.sum(sse) / F.sum("kn")).alias("rmse"))


def screening_table(scores: DataFrame) -> DataFrame:
    """H5: per model test mean and std over folds, train mean, overfit gap."""
    t = scores.groupBy("model").agg(
        F.avg(F.when(F.col("split") == "test", F.col("score"))).alias("test_mean"),
        F.stddev_samp(F.when(F.col("split") == "test", F.col("score"))).alias("test_std"),
        F.avg(F.when(F.col("split") == "train", F.col("score"))).alias("train_mean"))
    return t.withColumn("overfit_gap", F.col("test_mean") - F.col("train_mean"))


def friedman(scores: DataFrame) -> DataFrame:
    """H1: Friedman chi-square over (model, fold, score), lower score = rank 1."""
    r = scores.withColumn("rank", avg_rank(F.col("score"), ["fold"], F.col("score")))
    mr = r.groupBy("model").agg(F.avg("rank").alias("mean_rank"), F.sum("rank").alias("rank_sum"))
    dims = scores.agg(F.countDistinct("model").alias("k"), F.countDistinct("fold").alias("n"))
    s = mr.crossJoin(dims).groupBy("k", "n").agg(F.sum(F.col("rank_sum") * F.col("rank_sum")).alias("ss"))
    stat = s.select("k", "n", (12.0 * F.col("ss") / (F.col("n") * F.col("k") * (F.col("k") + 1))
                               - 3.0 * F.col("n") * (F.col("k") + 1)).alias("statistic"))
    return stat


def friedman_pvalue(stat: DataFrame, k: int) -> DataFrame:
    return stat.withColumn("p_value", F.expr(sql_chi2_sf("statistic", k - 1)))


def wilcoxon_signed(diffs: DataFrame, pair_cols: list[str]) -> DataFrame:
    """Signed-rank sums of differences ``d`` per pair (zeros dropped, tied
    |d| share the average rank): W+, W-, n, and the normal z of W+."""
    nz = diffs.where(F.col("d") != 0).withColumn("ad", F.abs("d"))
    r = nz.withColumn("rank", avg_rank(F.col("ad"), pair_cols, F.col("ad")))
    agg = r.groupBy(*pair_cols).agg(F.sum(F.when(F.col("d") > 0, F.col("rank")).otherwise(0.0)).alias("w_plus"),
                                    F.sum(F.when(F.col("d") < 0, F.col("rank")).otherwise(0.0)).alias("w_minus"),
                                    F.count(F.lit(1)).alias("n_nonzero"))
    allp = diffs.select(*pair_cols).distinct()
    j = allp.join(agg, pair_cols, "left").fillna({"w_plus": 0.0, "w_minus": 0.0, "n_nonzero": 0})
    n = F.col("n_nonzero").cast("double")
    mu = n * (n + 1) / 4
    sd = F.sqrt(n * (n + 1) * (2 * n + 1) / 24)
    return j.withColumn("z", F.when(n > 0, (F.col("w_plus") - mu) / sd))


def one_sided_p(z_col: str) -> Column:
    """P(Z >= z); 1 when undefined."""
    return F.coalesce(F.expr(f"1.0e0 - {sql_norm_cdf(f'`{z_col}`')}"), F.lit(1.0))


def two_sided_p(z_col: str) -> Column:
    return F.coalesce(F.least(F.lit(1.0), F.expr(f"2.0e0 * (1.0e0 - {sql_norm_cdf(f'abs(`{z_col}`)')})")), F.lit(1.0))


def student_t(df: DataFrame, group_col: str, value: str, a: str = "A", b: str = "B") -> DataFrame:
    """H4: pooled two-sample t statistic between arms ``a`` and ``b``
    (normal-approximation p-value)."""
    s = df.groupBy(group_col).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v"))
    x = s.where(F.col(group_col) == a).select(F.col("n").alias("n1"), F.col("m").alias("m1"), F.col("v").alias("v1"))
    y = s.where(F.col(group_col) == b).select(F.col("n").alias("n2"), F.col("m").alias("m2"), F.col("v").alias("v2"))
    j = x.crossJoin(y)
    sp = ((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2")) / (F.col("n1") + F.col("n2") - 2)
    t = (F.col("m1") - F.col("m2")) / F.sqrt(sp * (1.0 / F.col("n1") + 1.0 / F.col("n2")))
    return j.withColumn("t", t).withColumn("df", (F.col("n1") + F.col("n2") - 2).cast("long"))
