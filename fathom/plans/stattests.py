"""Significance-test queries (H1-H5) over the out-of-fold RMSE table of
group-mean price models (orders, 5 hash folds), and an A/B t-test."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.hashing import sql_bucket, sql_key_text
from fathom.functions.numeric import rnd, sql_rnd
from fathom.functions.special import sql_chi2_sf, sql_norm_cdf
from fathom.operators import folds
from fathom.operators import stattests as H
from fathom.plans.registry import query
from fathom.session import cut_lineage
from fathom.sources.tables import Tables

K = 5
MODELS = {"dummy": None, "by_priority": "o_orderpriority", "by_status": "o_orderstatus",
          "by_priority_status": "o_orderpriority || '/' || o_orderstatus"}


def score_table(spark, sf_dir):
    o = folds.kfold(Tables(spark, sf_dir).orders, ["o_orderkey"], K, "cvfold")
    models = {n: (F.expr(k) if k else None) for n, k in MODELS.items()}
    s = H.oof_group_mean_scores(o, "o_totalprice", "fold", K, models)
    return s.withColumn("score", rnd("rmse", 6)).drop("rmse")


def _sql_scores():
    parts = []
    for name, key in MODELS.items():
        k = key or "''"
        parts.append(f"""
  SELECT '{name}' AS model, CAST(i AS INTEGER) AS fold, CASE WHEN d.f = i THEN 'test' ELSE 'train' END AS split,
         {sql_rnd('sqrt(avg(power(d.y - CASE WHEN kt.tn - coalesce(kf.kn, 0) > 0 THEN (kt.ts - coalesce(kf.ks, 0.0e0)) / (kt.tn - coalesce(kf.kn, 0)) ELSE (alls.asum - ft.fs) / (alls.an - ft.fn) END, 2)))', 6)} AS score
  FROM (SELECT o_totalprice AS y, fold AS f, CAST({k} AS VARCHAR) AS k FROM o) d CROSS JOIN range(0, {K}) AS r(i)
  LEFT JOIN (SELECT CAST({k} AS VARCHAR) AS k, fold AS f, count(*) AS kn, sum(o_totalprice) AS ks FROM o GROUP BY 1, 2) kf
         ON kf.k = d.k AND kf.f = r.i
  JOIN (SELECT CAST({k} AS VARCHAR) AS k, count(*) AS tn, sum(o_totalprice) AS ts FROM o GROUP BY 1) kt ON kt.k = d.k
  JOIN (SELECT fold AS f, count(*) AS fn, sum(o_totalprice) AS fs FROM o GROUP BY 1) ft ON ft.f = r.i
  CROSS JOIN (SELECT count(*) AS an, sum(o_totalprice) AS asum FROM o) alls
  GROUP BY ALL""")
    return (f"o AS (SELECT *, CAST({sql_bucket(sql_key_text('o_orderkey'), 'cvfold', K)} AS INTEGER) AS fold FROM orders),\n"
            "sc AS (" + "\n  UNION ALL".join(parts) + ")")


SQL_SCORES = _sql_scores()


@query("cv_score_table", ["H5", "M15", "E30"], sql=f"""
WITH {SQL_SCORES}
SELECT model, fold, split, score FROM sc
""")
def cv_score_table(spark, sf_dir):
    return score_table(spark, sf_dir).select("model", "fold", "split", "score")


@query("cv_screening", ["H5", "M15"], sql=f"""
WITH {SQL_SCORES},
t AS (SELECT model, avg(score) FILTER (WHERE split = 'test') AS test_mean,
             stddev_samp(score) FILTER (WHERE split = 'test') AS test_std,
             avg(score) FILTER (WHERE split = 'train') AS train_mean FROM sc GROUP BY model)
SELECT model, {sql_rnd('test_mean', 4)} AS test_mean, {sql_rnd('test_std', 4)} AS test_std,
       {sql_rnd('train_mean', 4)} AS train_mean, {sql_rnd('test_mean - train_mean', 4)} AS overfit_gap FROM t
""")
def cv_screening(spark, sf_dir):
    t = H.screening_table(score_table(spark, sf_dir))
    return t.select("model", *[rnd(c, 4).alias(c) for c in ["test_mean", "test_std", "train_mean", "overfit_gap"]])


SQL_TEST = """te AS (SELECT model, fold, score FROM sc WHERE split = 'test'),
rk AS (SELECT model, fold, rank() OVER (PARTITION BY fold ORDER BY score)
              + (count(*) OVER (PARTITION BY fold, score) - 1) / 2.0e0 AS rank FROM te),
fr AS (SELECT count(DISTINCT model) AS k, count(DISTINCT fold) AS n FROM te),
rs AS (SELECT model, sum(rank) AS rank_sum FROM rk GROUP BY model),
fs AS (SELECT 12.0e0 * sum(rank_sum * rank_sum) / (any_value(n) * any_value(k) * (any_value(k) + 1))
              - 3.0e0 * any_value(n) * (any_value(k) + 1) AS statistic FROM rs CROSS JOIN fr),
ch AS (SELECT arg_min(model, (m, model)) AS champion FROM (SELECT model, avg(score) AS m FROM te GROUP BY model)),
df AS (SELECT a.model, a.fold, a.score - c.score AS d FROM te a JOIN te c ON a.fold = c.fold
       CROSS JOIN ch WHERE c.model = ch.champion AND a.model <> ch.champion),
wr AS (SELECT model, d, rank() OVER (PARTITION BY model ORDER BY abs(d))
              + (count(*) OVER (PARTITION BY model, abs(d)) - 1) / 2.0e0 AS rank FROM df WHERE d <> 0),
ws AS (SELECT m.model, coalesce(sum(CASE WHEN d > 0 THEN rank ELSE 0.0e0 END), 0.0e0) AS w_plus,
              coalesce(sum(CASE WHEN d < 0 THEN rank ELSE 0.0e0 END), 0.0e0) AS w_minus, count(d) AS nn
       FROM (SELECT DISTINCT model FROM df) m LEFT JOIN wr USING (model) GROUP BY m.model),
wz AS (SELECT *, CASE WHEN nn > 0 THEN (w_plus - nn * (nn + 1) / 4.0e0) / sqrt(nn * (nn + 1) * (2 * nn + 1) / 24.0e0) END AS z FROM ws)"""


@query("friedman_wilcoxon", ["H1", "H2", "J9"], sql=f"""
WITH {SQL_SCORES}, {SQL_TEST}
SELECT 'friedman' AS test, 'all' AS model, {sql_rnd('statistic', 6)} AS statistic,
       {sql_rnd(sql_chi2_sf('statistic', len(MODELS) - 1), 6)} AS p_value, CAST(NULL AS DOUBLE) AS p_bonferroni FROM fs
UNION ALL
SELECT 'wilcoxon_vs_champion', model, {sql_rnd('w_plus', 6)},
       {sql_rnd(f"coalesce(1.0e0 - {sql_norm_cdf('z')}, 1.0e0)", 6)},
       {sql_rnd(f"least(1.0e0, coalesce(1.0e0 - {sql_norm_cdf('z')}, 1.0e0) * {len(MODELS) - 1})", 6)} FROM wz
""")
def friedman_wilcoxon(spark, sf_dir):
    # models x folds rows from a whole-table aggregate, read four times below: computed once
    sc = cut_lineage(score_table(spark, sf_dir).where(F.col("split") == "test").select("model", "fold", "score"))
    fr = H.friedman_pvalue(H.friedman(sc), len(MODELS)).select(
        F.lit("friedman").alias("test"), F.lit("all").alias("model"), rnd("statistic", 6).alias("statistic"),
        rnd("p_value", 6).alias("p_value"), F.lit(None).cast("double").alias("p_bonferroni"))
    means = sc.groupBy("model").agg(F.avg("score").alias("m"))
    champ = means.agg(F.min_by("model", F.struct("m", "model")).alias("champion"))
    # the champion's score per fold, then one pair per (other model, fold)
    c = sc.join(F.broadcast(champ), F.col("model") == F.col("champion")).select("fold", F.col("score").alias("c_score"))
    d = sc.join(F.broadcast(champ), F.col("model") != F.col("champion")).join(c, "fold") \
        .select("model", "fold", (F.col("score") - F.col("c_score")).alias("d"))
    w = H.wilcoxon_signed(d, ["model"]).withColumn("p", H.one_sided_p("z"))
    wil = w.select(F.lit("wilcoxon_vs_champion").alias("test"), "model", rnd("w_plus", 6).alias("statistic"),
                   rnd("p", 6).alias("p_value"),
                   rnd(F.least(F.lit(1.0), F.col("p") * (len(MODELS) - 1)), 6).alias("p_bonferroni"))
    return fr.unionByName(wil)


@query("pairwise_wilcoxon", ["H3", "J6"], sql=f"""
WITH {SQL_SCORES},
te AS (SELECT model, fold, score FROM sc WHERE split = 'test'),
df AS (SELECT a.model AS model_a, b.model AS model_b, a.score - b.score AS d
       FROM te a JOIN te b ON a.fold = b.fold AND a.model < b.model),
wr AS (SELECT model_a, model_b, d, rank() OVER (PARTITION BY model_a, model_b ORDER BY abs(d))
              + (count(*) OVER (PARTITION BY model_a, model_b, abs(d)) - 1) / 2.0e0 AS rank FROM df WHERE d <> 0),
ws AS (SELECT p.model_a, p.model_b, coalesce(sum(CASE WHEN d > 0 THEN rank ELSE 0.0e0 END), 0.0e0) AS w_plus,
              coalesce(sum(CASE WHEN d < 0 THEN rank ELSE 0.0e0 END), 0.0e0) AS w_minus, count(d) AS nn
       FROM (SELECT DISTINCT model_a, model_b FROM df) p LEFT JOIN wr USING (model_a, model_b) GROUP BY ALL),
wz AS (SELECT *, CASE WHEN nn > 0 THEN (w_plus - nn * (nn + 1) / 4.0e0) / sqrt(nn * (nn + 1) * (2 * nn + 1) / 24.0e0) END AS z FROM ws)
SELECT model_a, model_b, {sql_rnd('least(w_plus, w_minus)', 6)} AS statistic,
       {sql_rnd(f"coalesce(least(1.0e0, 2.0e0 * (1.0e0 - {sql_norm_cdf('abs(z)')})), 1.0e0)", 6)} AS p_value FROM wz
""")
def pairwise_wilcoxon(spark, sf_dir):
    sc = score_table(spark, sf_dir).where(F.col("split") == "test").select("model", "fold", "score")
    a, b = sc.alias("a"), sc.alias("b")
    d = a.join(b, (F.col("a.fold") == F.col("b.fold")) & (F.col("a.model") < F.col("b.model"))) \
        .select(F.col("a.model").alias("model_a"), F.col("b.model").alias("model_b"),
                (F.col("a.score") - F.col("b.score")).alias("d"))
    w = H.wilcoxon_signed(d, ["model_a", "model_b"]).withColumn("p", H.two_sided_p("z"))
    return w.select("model_a", "model_b", rnd(F.least("w_plus", "w_minus"), 6).alias("statistic"),
                    rnd("p", 6).alias("p_value"))


@query("ttest_ab", ["H4", "F15"], sql=f"""
WITH s AS (SELECT CASE WHEN {sql_bucket(sql_key_text('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey'), 'ab', 2)} = 0
                       THEN 'A' ELSE 'B' END AS arm, abs(l_extendedprice - 38000.0e0) AS ae FROM lineitem),
g AS (SELECT arm, count(ae) AS n, avg(ae) AS m, var_samp(ae) AS v FROM s GROUP BY arm),
j AS (SELECT a.n AS n1, a.m AS m1, a.v AS v1, b.n AS n2, b.m AS m2, b.v AS v2 FROM g a, g b WHERE a.arm = 'A' AND b.arm = 'B'),
t AS (SELECT *, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0e0 / n1 + 1.0e0 / n2)) AS t FROM j)
SELECT n1, n2, {sql_rnd('m1', 4)} AS mean_a, {sql_rnd('m2', 4)} AS mean_b, {sql_rnd('t', 6)} AS t,
       CAST(n1 + n2 - 2 AS BIGINT) AS df, {sql_rnd(f"2.0e0 * (1.0e0 - {sql_norm_cdf('abs(t)')})", 6)} AS p_value FROM t
""")
def ttest_ab(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    li = folds.ab_arm(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    li = li.withColumn("ae", F.abs(F.col("l_extendedprice") - 38000.0))
    t = H.student_t(li, "arm", "ae")
    return t.select("n1", "n2", rnd("m1", 4).alias("mean_a"), rnd("m2", 4).alias("mean_b"), rnd("t", 6).alias("t"), "df",
                    rnd(F.expr(f"2.0e0 * (1.0e0 - {sql_norm_cdf('abs(t)')})"), 6).alias("p_value"))
