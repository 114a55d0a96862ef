"""Regression evaluation queries (E20-E54) on the group-mean price model
of the minimum slice (orders, hash split, smoothed mean per priority)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathom.functions.hashing import sql_bucket, sql_key_text
from fathom.functions.numeric import rnd, sql_rnd
from fathom.functions.special import sql_chi2_sf
from fathom.operators import evalreg as R
from fathom.operators import folds, halo
from fathom.plans.registry import query
from fathom.plans.slice import SQL_SCORED_ORDERS, scored_orders
from fathom.session import small_side
from fathom.sources.tables import Tables

Y, P = "o_totalprice", "pred"


def _test(spark, sf_dir):
    return scored_orders(spark, sf_dir).where(F.col("split") == "test")


REG = ["mae", "rmse", "r2", "mape", "median_ae", "resid_mean", "resid_std", "max_abs_error", "explained_variance"]


@query("regression_metrics", ["E20", "E21", "E22", "E23", "E24"], sql=f"""
WITH {SQL_SCORED_ORDERS},
t AS (SELECT * FROM so WHERE split = 'test'),
b AS (SELECT avg(o_totalprice) AS bmean, median(o_totalprice) AS bmed FROM so WHERE split = 'train')
SELECT count(*) AS n, {sql_rnd('avg(abs(o_totalprice - pred))', 4)} AS mae,
       {sql_rnd('sqrt(avg((o_totalprice - pred) * (o_totalprice - pred)))', 4)} AS rmse,
       {sql_rnd('1 - sum((o_totalprice - pred) * (o_totalprice - pred)) / (var_pop(o_totalprice) * count(*))', 8)} AS r2,
       {sql_rnd('avg(abs(o_totalprice - pred) / greatest(abs(o_totalprice), 1.0e0))', 8)} AS mape,
       {sql_rnd('median(abs(o_totalprice - pred))', 4)} AS median_ae,
       {sql_rnd('avg(o_totalprice - pred)', 4)} AS resid_mean, {sql_rnd('stddev_pop(o_totalprice - pred)', 4)} AS resid_std,
       {sql_rnd('max(abs(o_totalprice - pred))', 4)} AS max_abs_error,
       {sql_rnd('1 - var_pop(o_totalprice - pred) / var_pop(o_totalprice)', 8)} AS explained_variance,
       {sql_rnd('sqrt(avg(power(ln(1 + greatest(pred, 0.0e0)) - ln(1 + o_totalprice), 2)))', 8)} AS rmsle,
       {sql_rnd('sqrt(avg((o_totalprice - bmean) * (o_totalprice - bmean)))', 4)} AS mean_baseline_rmse,
       {sql_rnd('sqrt(avg((o_totalprice - bmed) * (o_totalprice - bmed)))', 4)} AS median_baseline_rmse
FROM t CROSS JOIN b
""")
def regression_metrics(spark, sf_dir):
    from fathom.session import cut_lineage
    # scoring runs once: the moments, both quantile passes and the baseline read this
    so = cut_lineage(scored_orders(spark, sf_dir).select(Y, P, "split"))
    test = so.where(F.col("split") == "test")
    from fathom.operators.ordered import quantile_row
    train = so.where(F.col("split") == "train")
    base = train.agg(F.avg(Y).alias("bmean")).crossJoin(
        quantile_row(train, [Y], [0.5], "__q_").select(F.col(f"__q_{Y}")[0].alias("bmed")))
    t = test.crossJoin(F.broadcast(base))  # one row of training state
    y, p = F.col(Y), F.col(P)
    d = F.log1p(F.greatest(p, F.lit(0.0))) - F.log1p(y)
    m = t.agg(*R.regression_aggs(y, p, 1.0), F.sqrt(F.avg(d * d)).alias("rmsle"),
              F.sqrt(F.avg((y - F.col("bmean")) ** 2)).alias("mean_baseline_rmse"),
              F.sqrt(F.avg((y - F.col("bmed")) ** 2)).alias("median_baseline_rmse")) \
        .crossJoin(R.median_abs_error(t, y, p))
    digits = {"r2": 8, "mape": 8, "explained_variance": 8, "rmsle": 8}
    return m.select("n", *[rnd(c, digits.get(c, 4)).alias(c) for c in REG + ["rmsle", "mean_baseline_rmse",
                                                                              "median_baseline_rmse"]])


SQL_PRIO_MISSING = f"CASE WHEN {sql_bucket(sql_key_text('o_orderkey'), 'o_orderpriority')} < 15 THEN NULL ELSE o_orderpriority END"


@query("segment_metrics", ["E27", "F11", "E25"], sql=f"""
WITH {SQL_SCORED_ORDERS},
t AS (SELECT *, {SQL_PRIO_MISSING} AS prio_seen FROM so WHERE split = 'test'),
e AS (SELECT list_sort(list_distinct(quantile_cont(o_totalprice, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges FROM t),
q AS (SELECT t.*, CAST(CASE WHEN o_totalprice = edges[1] THEN 0
                      WHEN o_totalprice < edges[1] OR o_totalprice > edges[len(edges)] THEN NULL
                      ELSE len(list_filter(edges, lambda x: x < o_totalprice)) - 1 END AS VARCHAR) AS quintile
      FROM t CROSS JOIN e),
lg AS (SELECT 'prio_seen' AS group_column, prio_seen AS group_value, o_totalprice, pred FROM q
       UNION ALL SELECT 'target_quintile', quintile, o_totalprice, pred FROM q)
SELECT group_column, group_value, count(*) AS n, {sql_rnd('avg(abs(o_totalprice - pred))', 4)} AS mae,
       {sql_rnd('sqrt(avg((o_totalprice - pred) * (o_totalprice - pred)))', 4)} AS rmse
FROM lg GROUP BY ALL HAVING count(*) >= 5
""")
def segment_metrics(spark, sf_dir):
    from fathom.functions.hashing import bucket, key_text
    from fathom.session import cut_lineage
    # scored once for the quintile edges, the bin join and the subgroup metrics
    t = cut_lineage(_test(spark, sf_dir).select("o_orderkey", "o_orderpriority", Y, P))
    # the priority as seen at scoring time, with 15% injected NULL keys (kept as a segment)
    t = t.withColumn("prio_seen", F.when(bucket(key_text("o_orderkey"), "o_orderpriority") < 15, None)
                     .otherwise(F.col("o_orderpriority")))
    q = folds.qcut_assign(t, Y, folds.qcut_edges(t, Y, 5), "quintile").withColumn("quintile", F.col("quintile").cast("string"))
    seg = R.subgroup_regression(q.withColumnRenamed("quintile", "target_quintile"), Y, P,
                                ["prio_seen", "target_quintile"], min_n=5, keep_null_keys=True)
    return seg.select("group_column", "group_value", "n", rnd("mae", 4).alias("mae"), rnd("rmse", 4).alias("rmse"))


@query("region_mask_metrics", ["E26"], sql=f"""
WITH {SQL_SCORED_ORDERS},
t AS (SELECT * FROM so WHERE split = 'test'),
m AS (SELECT 'high_value' AS mask, o_totalprice, pred FROM t WHERE o_totalprice > 300000.0e0
      UNION ALL SELECT 'urgent', o_totalprice, pred FROM t WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT 'recent', o_totalprice, pred FROM t WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00')
SELECT mask, count(*) AS n, {sql_rnd('sqrt(avg((o_totalprice - pred) * (o_totalprice - pred)))', 4)} AS rmse,
       {sql_rnd('avg(abs(o_totalprice - pred))', 4)} AS mae FROM m GROUP BY mask
""")
def region_mask_metrics(spark, sf_dir):
    t = _test(spark, sf_dir)
    masks = F.array_compact(F.array(
        F.when(F.col(Y) > 300000.0, F.lit("high_value")),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("urgent")),
        F.when(F.col("o_orderdate") >= F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), F.lit("recent"))))
    e = t.withColumn("mask", F.explode(masks))
    r = F.col(Y) - F.col(P)
    return e.groupBy("mask").agg(F.count(F.lit(1)).alias("n"), rnd(F.sqrt(F.avg(r * r)), 4).alias("rmse"),
                                 rnd(F.avg(F.abs(r)), 4).alias("mae"))


@query("error_severity", ["E29"], sql=f"""
WITH {SQL_SCORED_ORDERS},
t AS (SELECT * FROM so WHERE split = 'test'),
ov AS (SELECT sqrt(avg((o_totalprice - pred) * (o_totalprice - pred))) AS m FROM t),
e AS (SELECT o_orderkey, abs(o_totalprice - pred) AS a, m FROM t CROSS JOIN ov)
SELECT CASE WHEN a <= 0 THEN NULL WHEN a <= 0.5e0 * m THEN 'low' WHEN a <= m THEN 'medium'
            WHEN a <= 2 * m THEN 'high' ELSE 'critical' END AS severity,
       count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM e WHERE a > m GROUP BY 1
""")
def error_severity(spark, sf_dir):
    e = R.error_rows(_test(spark, sf_dir), Y, P)
    return e.groupBy("severity").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("conformal_band", ["E31", "E32", "E33", "E35", "F13"], sql=f"""
WITH {SQL_SCORED_ORDERS},
cal AS (SELECT abs(o_totalprice - pred) AS ar FROM so
        WHERE split = 'train' AND {sql_bucket(sql_key_text('o_orderkey'), 'calib')} < 20),
cn AS (SELECT count(*) AS n FROM cal),
qh AS (SELECT min(ar) AS q_hat, any_value(n) AS n_cal FROM (SELECT ar, row_number() OVER (ORDER BY ar) AS rk FROM cal) CROSS JOIN cn
       WHERE rk >= ceil(least(ceil((n + 1) * 0.9e0) / n, 1.0e0) * n)),
rng AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM so WHERE split = 'train'),
t AS (SELECT * FROM so WHERE split = 'test'),
rm AS (SELECT sqrt(avg((o_totalprice - pred) * (o_totalprice - pred))) AS rmse FROM t)
SELECT {sql_rnd('any_value(q_hat)', 4)} AS q_hat, any_value(n_cal) AS n_calibration,
       {sql_rnd('avg(CASE WHEN o_totalprice BETWEEN greatest(pred - q_hat, lo) AND least(pred + q_hat, hi) THEN 1.0e0 ELSE 0.0e0 END)', 8)} AS coverage,
       count(*) FILTER (WHERE least(pred + q_hat, hi) - greatest(pred - q_hat, lo) > 250000.0e0) AS n_wide,
       {sql_rnd('avg(CASE WHEN abs(o_totalprice - pred) <= rmse THEN 1.0e0 ELSE 0.0e0 END)', 8)} AS within_1_rmse,
       {sql_rnd('avg(CASE WHEN abs(o_totalprice - pred) <= 2 * rmse THEN 1.0e0 ELSE 0.0e0 END)', 8)} AS within_2_rmse,
       {sql_rnd('avg(CASE WHEN abs(o_totalprice - pred) <= 3 * rmse THEN 1.0e0 ELSE 0.0e0 END)', 8)} AS within_3_rmse
FROM t CROSS JOIN qh CROSS JOIN rng CROSS JOIN rm
""")
def conformal_band(spark, sf_dir):
    so = scored_orders(spark, sf_dir)
    train = so.where(F.col("split") == "train")
    cal = folds.calibration_flag(train, ["o_orderkey"], 20, "calib").where(F.col("is_calibration") == 1)
    qh = R.conformal_quantile(cal, Y, P, alpha=0.1)
    rng = train.agg(F.min(Y).alias("lo"), F.max(Y).alias("hi"))
    test = so.where(F.col("split") == "test")
    j = test.crossJoin(F.broadcast(qh)).crossJoin(F.broadcast(rng))  # one-row states
    lower = F.greatest(F.col(P) - F.col("q_hat"), F.col("lo"))
    upper = F.least(F.col(P) + F.col("q_hat"), F.col("hi"))
    band = j.agg(F.first("q_hat").alias("q_hat"), F.first("n_calibration").alias("n_calibration"),
                 F.avg(F.col(Y).between(lower, upper).cast("double")).alias("coverage"),
                 F.count(F.when(upper - lower > 250000.0, 1)).alias("n_wide"))
    cov = R.interval_coverage(test, Y, P)
    return band.crossJoin(cov).select(rnd("q_hat", 4).alias("q_hat"), "n_calibration", rnd("coverage", 8).alias("coverage"),
                                      "n_wide", *[rnd(f"within_{k}_rmse", 8).alias(f"within_{k}_rmse") for k in (1, 2, 3)])


@query("loss_tables", ["E36", "E37", "E38", "E39", "E41"], sql=f"""
WITH {SQL_SCORED_ORDERS},
s AS (SELECT split, avg((o_totalprice - pred) * (o_totalprice - pred)) AS mse, avg(abs(o_totalprice - pred)) AS mae
      FROM so GROUP BY split),
gp AS (SELECT max(mse) FILTER (WHERE split = 'test') AS te, max(mse) FILTER (WHERE split = 'train') AS tr FROM s),
bm AS (SELECT avg(o_totalprice) AS bmean FROM so WHERE split = 'train'),
t AS (SELECT * FROM so WHERE split = 'test')
SELECT {sql_rnd('avg(CASE WHEN o_totalprice - pred >= 0 THEN 0.1e0 * (o_totalprice - pred) ELSE (0.1e0 - 1) * (o_totalprice - pred) END)', 4)} AS pinball_q10,
       {sql_rnd('avg(CASE WHEN o_totalprice - pred >= 0 THEN 0.5e0 * (o_totalprice - pred) ELSE (0.5e0 - 1) * (o_totalprice - pred) END)', 4)} AS pinball_q50,
       {sql_rnd('avg(CASE WHEN o_totalprice - pred >= 0 THEN 0.9e0 * (o_totalprice - pred) ELSE (0.9e0 - 1) * (o_totalprice - pred) END)', 4)} AS pinball_q90,
       {sql_rnd('avg(CASE WHEN o_totalprice - pred > 0 THEN 2.0e0 * (o_totalprice - pred) * (o_totalprice - pred) ELSE (o_totalprice - pred) * (o_totalprice - pred) END)', 0)} AS asymmetric_sq,
       {sql_rnd('avg(CASE WHEN abs(o_totalprice - pred) <= 100000.0e0 THEN 0.5e0 * (o_totalprice - pred) * (o_totalprice - pred) ELSE 100000.0e0 * (abs(o_totalprice - pred) - 0.5e0 * 100000.0e0) END)', 0)} AS huber,
       {sql_rnd('0.01e0 * avg(abs(o_totalprice - pred))', 6)} AS business_cost,
       {sql_rnd('0.01e0 * (avg(abs(o_totalprice - bmean)) - avg(abs(o_totalprice - pred)))', 6)} AS savings_vs_baseline,
       {sql_rnd('any_value((te - tr) / te)', 8)} AS generalisation_gap, any_value((te - tr) / te > 0.3e0) AS overfit_flag
FROM t CROSS JOIN gp CROSS JOIN bm
""")
def loss_tables(spark, sf_dir):
    so = scored_orders(spark, sf_dir)
    y, p = F.col(Y), F.col(P)
    mse = so.groupBy("split").agg(F.avg((y - p) ** 2).alias("mse"))
    gap = mse.agg(F.max(F.when(F.col("split") == "test", F.col("mse"))).alias("te"),
                  F.max(F.when(F.col("split") == "train", F.col("mse"))).alias("tr"))
    bm = so.where(F.col("split") == "train").agg(F.avg(Y).alias("bmean"))
    t = so.where(F.col("split") == "test").crossJoin(F.broadcast(gap)).crossJoin(F.broadcast(bm))
    g = (F.col("te") - F.col("tr")) / F.col("te")
    return t.agg(*[rnd(F.avg(R.pinball(y, p, q)), 4).alias(f"pinball_q{int(q * 100)}") for q in (0.1, 0.5, 0.9)],
                 rnd(F.avg(R.asymmetric_sq(y, p, 2.0)), 0).alias("asymmetric_sq"),
                 rnd(F.avg(R.huber_loss(y - p, 100000.0)), 0).alias("huber"),
                 rnd(0.01 * F.avg(F.abs(y - p)), 6).alias("business_cost"),
                 rnd(0.01 * (F.avg(F.abs(y - F.col("bmean"))) - F.avg(F.abs(y - p))), 6).alias("savings_vs_baseline"),
                 rnd(F.first(g), 8).alias("generalisation_gap"), F.first(g > 0.3).alias("overfit_flag"))


@query("breusch_pagan", ["E42", "E43"], sql=f"""
WITH {SQL_SCORED_ORDERS},
t AS (SELECT o_totalprice - pred AS r, pred FROM so WHERE split = 'test'),
mu AS (SELECT avg(r) AS m FROM t),
mo AS (SELECT count(*) AS n, avg(power(r - m, 2)) AS m2, avg(power(r - m, 3)) AS m3, avg(power(r - m, 4)) AS m4 FROM t CROSS JOIN mu),
bp AS (SELECT count(*) * regr_r2(r * r, pred) AS stat FROM t),
jb AS (SELECT n, n / 6.0e0 * (power(m3 / power(m2, 1.5e0), 2) + power(m4 / (m2 * m2) - 3, 2) / 4) AS jb FROM mo)
SELECT {sql_rnd('stat', 6)} AS bp_statistic, {sql_rnd(sql_chi2_sf('stat', 1), 6)} AS bp_pvalue,
       {sql_rnd('jb', 6)} AS jarque_bera, {sql_rnd(sql_chi2_sf('jb', 2), 6)} AS jb_pvalue, n
FROM bp CROSS JOIN jb
""")
def breusch_pagan(spark, sf_dir):
    t = _test(spark, sf_dir).select((F.col(Y) - F.col(P)).alias("r"), P)
    mu = t.agg(F.avg("r").alias("m"))
    mo = t.crossJoin(F.broadcast(mu)).agg(F.count(F.lit(1)).alias("n"),
                                          *[F.avg(F.pow(F.col("r") - F.col("m"), k)).alias(f"m{k}") for k in (2, 3, 4)])
    bp = t.agg((F.count(F.lit(1)) * F.expr("regr_r2(r * r, pred)")).alias("stat"))
    jb = mo.select("n", (F.col("n") / 6.0 * (F.pow(F.col("m3") / F.pow("m2", 1.5), 2)
                                           + F.pow(F.col("m4") / (F.col("m2") * F.col("m2")) - 3, 2) / 4)).alias("jb"))
    j = bp.crossJoin(jb)
    return j.select(rnd("stat", 6).alias("bp_statistic"), rnd(F.expr(sql_chi2_sf("stat", 1)), 6).alias("bp_pvalue"),
                    rnd("jb", 6).alias("jarque_bera"), rnd(F.expr(sql_chi2_sf("jb", 2)), 6).alias("jb_pvalue"), "n")


MAX_LAG = 48
REPORTED_LAGS = (1, 24)


@query("residual_acf", ["E44", "J12"], sql=f"""
WITH c AS (SELECT ts, event_id, value - avg(value) OVER (PARTITION BY event_type) AS e FROM events WHERE value IS NOT NULL),
z AS (SELECT ts, event_id, e - avg(e) OVER () AS r FROM c),
l AS (SELECT r, """ + ", ".join(f"lag(r, {k}) OVER w AS l{k}" for k in range(1, MAX_LAG + 1)) + """ FROM z
      WINDOW w AS (ORDER BY ts, event_id))
""" + "\nUNION ALL\n".join(f"SELECT {k} AS lag, {sql_rnd(f'sum(r * l{k}) / sum(r * r)', 8)} AS acf, "
                           f"{'true' if k in REPORTED_LAGS else 'false'} AS reported FROM l" for k in range(1, MAX_LAG + 1)))
def residual_acf(spark, sf_dir):
    """Autocorrelation of the residuals of the event-type means, row by row in time order."""
    e = Tables(spark, sf_dir).events.select("ts", "event_id", "event_type", "value").where("value IS NOT NULL")
    means = small_side(e.groupBy("event_type").agg(F.avg("value").alias("pred")))
    residuals = e.join(means, "event_type").select("ts", "event_id", (F.col("value") - F.col("pred")).alias("r"))
    acf = halo.autocorrelation(residuals, ["ts", "event_id"], "r", MAX_LAG)
    return acf.select("lag", rnd("acf", 8).alias("acf"), F.col("lag").isin(*REPORTED_LAGS).alias("reported"))


@query("linear_attribution", ["E52", "H7"], sql=f"""
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
                  avg(l_quantity) AS mx, regr_slope(l_extendedprice, l_discount) AS b_disc FROM lineitem)
SELECT {sql_rnd('any_value(b)', 6)} AS slope, {sql_rnd('any_value(a)', 4)} AS intercept,
       {sql_rnd('avg(abs(b * (l_quantity - mx)))', 4)} AS mean_abs_attribution,
       {sql_rnd('any_value(b_disc)', 4)} AS slope_discount
FROM lineitem CROSS JOIN f
""")
def linear_attribution(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    f = li.agg(F.expr("regr_slope(l_extendedprice, l_quantity)").alias("b"),
               F.expr("regr_intercept(l_extendedprice, l_quantity)").alias("a"), F.avg("l_quantity").alias("mx"),
               F.expr("regr_slope(l_extendedprice, l_discount)").alias("b_disc"))
    j = li.crossJoin(F.broadcast(f))  # one row
    return j.agg(rnd(F.first("b"), 6).alias("slope"), rnd(F.first("a"), 4).alias("intercept"),
                 rnd(F.avg(F.abs(F.col("b") * (F.col("l_quantity") - F.col("mx")))), 4).alias("mean_abs_attribution"),
                 rnd(F.first("b_disc"), 4).alias("slope_discount"))


def _group_mean_preds(so, key):
    """Unsmoothed group-mean model on ``key`` (train rows), global mean
    for unseen or NULL keys."""
    train = so.where(F.col("split") == "train")
    g = train.agg(F.avg(Y).alias("__gm"))
    lv = train.groupBy(key).agg(F.avg(Y).alias("__lm"))
    return so.where(F.col("split") == "test").join(lv, key, "left").crossJoin(F.broadcast(g)) \
        .select("o_orderkey", Y, F.coalesce("__lm", "__gm").alias("p"))


MODEL_KEYS = {"dummy_mean": None, "by_priority": "o_orderpriority", "by_status": "o_orderstatus",
              "by_customer": "o_custkey"}


@query("improvement_over_dummy", ["E53", "J8", "J9"], sql=f"""
WITH {SQL_SCORED_ORDERS},
tr AS (SELECT * FROM so WHERE split = 'train'), te AS (SELECT * FROM so WHERE split = 'test'),
gm AS (SELECT avg(o_totalprice) AS g FROM tr),
preds AS (
  SELECT 'dummy_mean' AS model, o_totalprice AS y, g AS p FROM te CROSS JOIN gm
  UNION ALL SELECT 'by_priority', te.o_totalprice, coalesce(l.m, g) FROM te
    LEFT JOIN (SELECT o_orderpriority, avg(o_totalprice) AS m FROM tr GROUP BY 1) l USING (o_orderpriority) CROSS JOIN gm
  UNION ALL SELECT 'by_status', te.o_totalprice, coalesce(l.m, g) FROM te
    LEFT JOIN (SELECT o_orderstatus, avg(o_totalprice) AS m FROM tr GROUP BY 1) l USING (o_orderstatus) CROSS JOIN gm
  UNION ALL SELECT 'by_customer', te.o_totalprice, coalesce(l.m, g) FROM te
    LEFT JOIN (SELECT o_custkey, avg(o_totalprice) AS m FROM tr GROUP BY 1) l USING (o_custkey) CROSS JOIN gm),
sc AS (SELECT model, sqrt(avg((y - p) * (y - p))) AS rmse FROM preds GROUP BY model),
d AS (SELECT rmse AS drmse FROM sc WHERE model = 'dummy_mean')
SELECT model, {sql_rnd('rmse', 4)} AS rmse, {sql_rnd('100.0e0 * (drmse - rmse) / drmse', 6)} AS improvement_pct,
       CAST(rank() OVER (ORDER BY rmse) AS INTEGER) AS rank, rmse = min(rmse) OVER () AS champion
FROM sc CROSS JOIN d
""")
def improvement_over_dummy(spark, sf_dir):
    so = scored_orders(spark, sf_dir)
    parts = []
    for name, key in MODEL_KEYS.items():
        if key is None:
            train = so.where(F.col("split") == "train").agg(F.avg(Y).alias("p"))
            pr = so.where(F.col("split") == "test").crossJoin(F.broadcast(train)).select(Y, "p")
        else:
            pr = _group_mean_preds(so, key).select(Y, "p")
        parts.append(pr.agg(F.lit(name).alias("model"), F.sqrt(F.avg((F.col(Y) - F.col("p")) ** 2)).alias("rmse")))
    sc = parts[0]
    for p in parts[1:]:
        sc = sc.unionByName(p)
    d = sc.where(F.col("model") == "dummy_mean").select(F.col("rmse").alias("drmse"))
    w = Window.orderBy("rmse")  # one row per model
    best = sc.agg(F.min("rmse").alias("best"))
    return sc.crossJoin(d).crossJoin(best).select(
        "model", rnd("rmse", 4).alias("rmse"),
        rnd(100.0 * (F.col("drmse") - F.col("rmse")) / F.col("drmse"), 6).alias("improvement_pct"),
        F.rank().over(w).cast("int").alias("rank"), (F.col("rmse") == F.col("best")).alias("champion"))


@query("band_group_report", ["E28", "E54", "X12"], sql=f"""
WITH {SQL_SCORED_ORDERS},
t AS (SELECT * FROM so WHERE split = 'test'),
r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, median(o_totalprice) AS med FROM t),
b AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(greatest(CAST(ceil((o_totalprice - lo) / ((hi - lo) / 5.0e0)) AS INTEGER) - 1, 0), 4) END AS band,
             CASE WHEN o_totalprice > med THEN 'high' ELSE 'low' END || '/' || o_orderstatus AS grp,
             abs(o_totalprice - pred) AS ae, o_totalprice, pred FROM t CROSS JOIN r)
SELECT 'band' AS report, CAST(band AS VARCHAR) AS grp, count(*) AS n, {sql_rnd('avg(ae)', 4)} AS mean_error,
       {sql_rnd('median(ae)', 4)} AS median_error, {sql_rnd('avg(o_totalprice)', 4)} AS mean_target,
       {sql_rnd('avg(pred)', 4)} AS mean_pred FROM b GROUP BY band
UNION ALL
SELECT 'group', grp, count(*), {sql_rnd('avg(ae)', 4)}, {sql_rnd('median(ae)', 4)}, {sql_rnd('avg(o_totalprice)', 4)},
       {sql_rnd('avg(pred)', 4)} FROM b GROUP BY grp
""")
def band_group_report(spark, sf_dir):
    from fathom.operators.features import equal_width_bins
    from fathom.operators.ordered import quantile_row, quantiles
    from fathom.session import cut_lineage
    # scored once for the range, the median and both reports
    t = cut_lineage(_test(spark, sf_dir).select("o_orderstatus", Y, P))
    r = t.agg(F.min(Y).alias("lo"), F.max(Y).alias("hi")).crossJoin(
        quantile_row(t, [Y], [0.5], "__q_").select(F.col(f"__q_{Y}")[0].alias("med")))
    j = t.crossJoin(F.broadcast(r)).withColumns({
        "band": equal_width_bins(Y, F.col("lo"), F.col("hi"), 5).cast("string"),
        "grp": F.concat(F.when(F.col(Y) > F.col("med"), "high").otherwise("low"), F.lit("/"), F.col("o_orderstatus")),
        "ae": F.abs(F.col(Y) - F.col(P))})
    # both reports in one pass: each row once per report; medians from the checked quantile path
    long = j.select(F.explode(F.array(F.struct(F.lit("band").alias("report"), F.col("band").alias("grp")),
                                      F.struct(F.lit("group").alias("report"), F.col("grp").alias("grp")))).alias("g"),
                    "ae", Y, P).select("g.*", "ae", Y, P)
    rep = long.groupBy("report", "grp").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("ae"), 4).alias("mean_error"),
        rnd(F.avg(Y), 4).alias("mean_target"), rnd(F.avg(P), 4).alias("mean_pred"))
    med = quantiles(long, "ae", [0.5], ["report", "grp"]).select(
        "report", "grp", rnd(F.col("quantiles")[0], 4).alias("median_error"))
    return rep.join(med, ["report", "grp"], "left").select("report", "grp", "n", "mean_error", "median_error",
                                                           "mean_target", "mean_pred")


OVER_COST, UNDER_COST = 1.0, 1.5


@query("oof_uncertainty_band", ["E30"], sql=f"""
WITH o AS (SELECT o_totalprice AS y, o_orderpriority AS g, {sql_bucket(sql_key_text('o_orderkey'), 'band', 5)} AS f FROM orders),
c AS (SELECT g, f, sum(y) AS s, count(y) AS n FROM o GROUP BY ALL),
w AS (SELECT g, sum(s) AS gs, sum(n) AS gn FROM c GROUP BY g),
p AS (SELECT c.g, c.f, (gs - s) / (gn - n) AS oof FROM c JOIN w USING (g)),
e AS (SELECT y, y - oof AS e FROM o JOIN p USING (g, f)),
m AS (SELECT count(*) AS n, sqrt(avg(e * e)) AS r, avg(abs(e)) AS a, 1 - sum(e * e) / (var_pop(y) * count(*)) AS r2 FROM e)
SELECT n, {sql_rnd('r', 4)} AS oof_rmse, {sql_rnd('a', 4)} AS oof_mae, {sql_rnd('r2', 8)} AS oof_r2,
       {sql_rnd(f'r * {UNDER_COST}e0', 4)} AS lower_band, {sql_rnd(f'r * {OVER_COST}e0', 4)} AS upper_band FROM m
""")
def oof_uncertainty_band(spark, sf_dir):
    """Band of the out-of-fold group means when predicting too little costs half as much again as too much."""
    o = folds.kfold(Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderkey"], 5, "band")
    b = R.uncertainty_band(R.oof_group_means(o, "o_totalprice", "o_orderpriority", "fold"), "o_totalprice", "oof", OVER_COST, UNDER_COST)
    return b.select("n", *[rnd(c, 4).alias(c) for c in ("oof_rmse", "oof_mae", "lower_band", "upper_band")], rnd("oof_r2", 8).alias("oof_r2"))


_QT = "covar_pop(q, t)"


@query("adjusted_attributions", ["E52", "H7", "E51"], sql=f"""
WITH l AS (SELECT l_extendedprice AS y, CAST(l_quantity AS DOUBLE) AS q, l_tax + l_quantity / 1000 AS t FROM lineitem),
s AS (SELECT avg(q) AS mq, avg(t) AS mt, var_pop(q) AS qq, var_pop(t) AS tt, {_QT} AS qt, covar_pop(q, y) AS qy, covar_pop(t, y) AS ty FROM l),
b AS (SELECT *, (tt * qy - qt * ty) / (qq * tt - qt * qt) AS bq, (qq * ty - qt * qy) / (qq * tt - qt * qt) AS bt FROM s)
SELECT 'q' AS feature, {sql_rnd('any_value(qy / qq)', 4)} AS unadjusted, {sql_rnd('any_value(bq)', 4)} AS adjusted,
       {sql_rnd('avg(abs(bq * (q - mq)))', 4)} AS mean_abs_attribution, {sql_rnd('any_value(bq - qy / qq)', 4)} AS change FROM l CROSS JOIN b
UNION ALL
SELECT 't', {sql_rnd('any_value(ty / tt)', 2)}, {sql_rnd('any_value(bt)', 2)}, {sql_rnd('avg(abs(bt * (t - mt)))', 4)},
       {sql_rnd('any_value(bt - ty / tt)', 2)} FROM l CROSS JOIN b
""")
def adjusted_attributions(spark, sf_dir):
    """Price on quantity and on a tax that rises with it: slopes alone and beside each other."""
    li = Tables(spark, sf_dir).lineitem.select(F.col("l_extendedprice").alias("y"), F.col("l_quantity").cast("double").alias("q"),
                                               (F.col("l_tax") + F.col("l_quantity") / 1000).alias("t"))
    a = R.linear_attributions(li, "y", ["q", "t"])
    wide = lambda c: F.when(F.col("feature") == "q", rnd(c, 4)).otherwise(rnd(c, 2)).alias(c)
    return a.select("feature", wide("unadjusted"), wide("adjusted"), rnd("mean_abs_attribution", 4).alias("mean_abs_attribution"), wide("change"))
