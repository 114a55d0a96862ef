"""Survival queries (V1-V5, V8) on events: per user, days from the first
event to the first purchase, censored at the end of the month."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.numeric import rnd, sql_rnd
from fathom.functions.special import sql_chi2_sf
from fathom.operators import survival as V
from fathom.plans.registry import query
from fathom.sources.tables import Tables


def subjects(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    end = e.agg(F.max("ts").alias("__end"))
    u = e.groupBy("user_id").agg(F.min("ts").alias("first_ts"),
                                 F.min(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("purchase_ts"),
                                 F.count(F.when(F.col("event_type") == "error", 1)).alias("risk"))
    u = u.crossJoin(F.broadcast(end))  # one row
    stop = F.coalesce(F.col("purchase_ts"), F.col("__end"))
    days = F.timestamp_diff("MICROSECOND", F.col("first_ts"), stop).cast("double") / F.lit(86400e6)
    return u.select("user_id", rnd(days, 6).alias("duration"), F.col("purchase_ts").isNotNull().cast("int").alias("event"),
                    F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd").alias("grp"), "risk")


SQL_SUBJ = """en AS (SELECT max(ts) AS t_end FROM events),
us AS (SELECT user_id, min(ts) AS first_ts, min(ts) FILTER (WHERE event_type = 'purchase') AS purchase_ts,
              count(*) FILTER (WHERE event_type = 'error') AS risk FROM events GROUP BY user_id),
s AS (SELECT user_id, round((epoch_us(coalesce(purchase_ts, t_end)) - epoch_us(first_ts)) / 86400000000.0e0 * 1e6) / 1e6 AS duration,
             CAST(purchase_ts IS NOT NULL AS INTEGER) AS event,
             CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS grp, risk FROM us CROSS JOIN en)"""

SQL_KM = """tc AS (SELECT grp, duration AS time, sum(event) AS d, sum(1 - event) AS c FROM s GROUP BY ALL),
tt AS (SELECT grp, count(*) AS N FROM s GROUP BY grp),
r AS (SELECT tc.*, N - coalesce(sum(d + c) OVER (PARTITION BY grp ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n
      FROM tc JOIN tt USING (grp)),
k AS (SELECT grp, time, n, d, c,
             sum(CASE WHEN d < n THEN ln(1 - d / n) ELSE 0.0e0 END) OVER w AS log_s,
             sum(CASE WHEN d >= n THEN 1 ELSE 0 END) OVER w AS zero,
             sum(CASE WHEN d < n THEN d / (n * (n - d)) ELSE 0.0e0 END) OVER w AS gw,
             sum(d / n) OVER w AS na
      FROM r WINDOW w AS (PARTITION BY grp ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
km AS (SELECT *, CASE WHEN zero > 0 THEN 0.0e0 ELSE exp(log_s) END AS surv FROM k)"""


@query("kaplan_meier", ["V1", "V2", "V4"], sql=f"""
WITH {SQL_SUBJ}, {SQL_KM}
SELECT grp, time, CAST(n AS BIGINT) AS n_at_risk, CAST(d AS BIGINT) AS n_events, CAST(c AS BIGINT) AS n_censored,
       {sql_rnd('surv', 8)} AS survival, {sql_rnd('surv * sqrt(gw)', 8)} AS se,
       {sql_rnd('greatest(0.0e0, surv - 1.96e0 * surv * sqrt(gw))', 8)} AS lower,
       {sql_rnd('least(1.0e0, surv + 1.96e0 * surv * sqrt(gw))', 8)} AS upper,
       {sql_rnd('na', 8)} AS cumulative_hazard
FROM km
""")
def kaplan_meier(spark, sf_dir):
    km = V.kaplan_meier(subjects(spark, sf_dir), "duration", "event", ["grp"])
    return km.select("grp", "time", "n_at_risk", "n_events", "n_censored",
                     *[rnd(c, 8).alias(c) for c in ["survival", "se", "lower", "upper", "cumulative_hazard"]])


@query("km_median", ["V1", "V2"], sql=f"""
WITH {SQL_SUBJ}, {SQL_KM}
SELECT grp, min(time) FILTER (WHERE surv <= 0.5e0) AS median_time FROM km GROUP BY grp
""")
def km_median(spark, sf_dir):
    km = V.kaplan_meier(subjects(spark, sf_dir), "duration", "event", ["grp"])
    return V.median_survival(km, ["grp"])


@query("logrank", ["V3"], sql=f"""
WITH {SQL_SUBJ},
tc AS (SELECT duration AS time, sum(event) AS d, count(*) AS r, sum(CASE WHEN grp = 'even' THEN event ELSE 0 END) AS d1,
              sum(CASE WHEN grp = 'even' THEN 1 ELSE 0 END) AS r1 FROM s GROUP BY duration),
na AS (SELECT count(*) AS N, sum(CASE WHEN grp = 'even' THEN 1 ELSE 0 END) AS N1 FROM s),
g AS (SELECT tc.*, N - coalesce(sum(r) OVER w, 0) AS n, N1 - coalesce(sum(r1) OVER w, 0) AS n1
      FROM tc CROSS JOIN na WINDOW w AS (ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (SELECT sum(d1) AS o1, sum(d * n1 / n) AS e1,
             sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0.0e0 END) AS v FROM g)
SELECT CAST(o1 AS BIGINT) AS observed_1, {sql_rnd('e1', 8)} AS expected_1, {sql_rnd('v', 8)} AS variance,
       {sql_rnd('(o1 - e1) * (o1 - e1) / v', 8)} AS statistic, {sql_rnd(sql_chi2_sf('(o1 - e1) * (o1 - e1) / v', 1), 6)} AS p_value
FROM a
""")
def logrank(spark, sf_dir):
    lr = V.logrank(subjects(spark, sf_dir), "duration", "event", "grp", "even")
    return lr.select(F.col("observed_1").cast("long").alias("observed_1"), rnd("expected_1", 8).alias("expected_1"),
                     rnd("variance", 8).alias("variance"), rnd("statistic", 8).alias("statistic"),
                     rnd(F.expr(sql_chi2_sf("statistic", 1)), 6).alias("p_value"))


@query("censoring_summary", ["V5"], sql=f"""
WITH {SQL_SUBJ}
SELECT count(*) AS n, CAST(sum(event) AS BIGINT) AS n_events, {sql_rnd('1 - avg(CAST(event AS DOUBLE))', 8)} AS censoring_rate,
       {sql_rnd('avg(duration) FILTER (WHERE event = 1)', 8)} AS mean_of_events,
       {sql_rnd('avg(duration)', 8)} AS mean_ignoring_censoring FROM s
""")
def censoring_summary(spark, sf_dir):
    c = V.censoring_summary(subjects(spark, sf_dir), "duration", "event")
    return c.select("n", "n_events", *[rnd(x, 8).alias(x) for x in ["censoring_rate", "mean_of_events",
                                                                     "mean_ignoring_censoring"]])


@query("c_index", ["V8"], sql=f"""
WITH {SQL_SUBJ},
p AS (SELECT CASE WHEN i.risk > j.risk THEN 1.0e0 ELSE 0.0e0 END AS conc, CASE WHEN i.risk = j.risk THEN 1.0e0 ELSE 0.0e0 END AS tie
      FROM s i JOIN s j ON i.duration < j.duration WHERE i.event = 1)
SELECT CAST(sum(conc) AS BIGINT) AS concordant, CAST(sum(tie) AS BIGINT) AS tied, count(*) AS comparable,
       {sql_rnd('(sum(conc) + 0.5e0 * sum(tie)) / count(*)', 8)} AS c_index, true AS exact FROM p
""")
def c_index(spark, sf_dir):
    c = V.c_index(subjects(spark, sf_dir), "duration", "event", "risk")
    return c.select(F.col("concordant").cast("long").alias("concordant"), F.col("tied").cast("long").alias("tied"),
                    F.col("comparable").cast("long").alias("comparable"), rnd("c_index", 8).alias("c_index"), "exact")


@query("cox_ph", ["V6"])
def cox_ph(spark, sf_dir):
    """Cox PH (Breslow ties, L2 0.1) on the error count and the user group,
    with hazard ratios, Wald p-values and the baseline survival at the
    median event time."""
    import numpy as np
    from fathom.operators.ordered import quantile_row
    from fathom.operators import survival_models as SM
    s = subjects(spark, sf_dir).withColumn("is_even", (F.col("grp") == "even").cast("double")) \
        .withColumn("risk_d", F.col("risk").cast("double"))
    fit = SM.cox_ph(s, "duration", "event", ["risk_d", "is_even"], penalizer=0.1)
    base = SM.cox_baseline(s, "duration", "event", ["risk_d", "is_even"], fit["coef"])
    s0 = quantile_row(base, ["S0"], [0.5], "q_").first()["q_S0"][0]
    rows = [(c, float(b), float(np.exp(b)), float(se), float(p), float(s0))
            for c, b, se, p in zip(fit["covariates"], fit["coef"], fit["se"], fit["p"])]
    return spark.createDataFrame(rows, "covariate string, coef double, hazard_ratio double, se double, p_value double, "
                                       "baseline_survival_mid double")


@query("tobit", ["V10"])
def tobit(spark, sf_dir):
    """Right-censored normal model of log1p(days) on the error count,
    with RMSE on events for the Tobit and the least-squares start."""
    from fathom.operators import survival_models as SM
    s = subjects(spark, sf_dir).select(F.log1p("duration").alias("y"), (1 - F.col("event")).alias("censored"),
                                       F.col("risk").cast("double").alias("risk_d"), "event")
    fit = SM.tobit(s, "y", "censored", ["risk_d"])
    ev = s.where(F.col("event") == 1)
    def rmse(a, b):
        return ev.agg(F.sqrt(F.avg((F.col("y") - (F.lit(a) + F.lit(b) * F.col("risk_d"))) ** 2))).first()[0]
    rows = [("tobit", fit["intercept"], float(fit["coef"][0]), fit["sigma"], float(rmse(fit["intercept"], float(fit["coef"][0])))),
            ("ols", float(fit["ols"][0]), float(fit["ols"][1]), fit["ols_sigma"], float(rmse(float(fit["ols"][0]), float(fit["ols"][1]))))]
    return spark.createDataFrame(rows, "model string, intercept double, slope double, sigma double, rmse_events double")


def _cox_split(spark, sf_dir):
    """Subjects with a hash split and Cox risk scores fitted on training rows."""
    from fathom.operators import folds
    from fathom.operators import survival_models as SM
    s = subjects(spark, sf_dir).withColumn("is_even", (F.col("grp") == "even").cast("double")) \
        .withColumn("risk_d", F.col("risk").cast("double"))
    s = folds.holdout(s, ["user_id"], 70, "survsplit")
    cov = ["risk_d", "is_even"]
    train = s.where(F.col("split") == "train")
    fit = SM.cox_ph(train, "duration", "event", cov, penalizer=0.1)
    lin = F.lit(0.0)
    for c, b in zip(cov, fit["coef"]):
        lin = lin + F.lit(float(b)) * F.col(c)
    base = SM.cox_baseline(train, "duration", "event", cov, fit["coef"])  # (t, H0, S0) at event times
    return s.withColumn("hr", F.exp(lin)), base


def _h0_at(base, times):
    """Breslow H0 at given times (step function): for a fixed small list of
    times, the last baseline value at or before each."""
    g = base.sparkSession.createDataFrame([(i, float(t)) for i, t in enumerate(times)], "gi int, g double")
    return g.join(base, F.col("t") <= F.col("g"), "left").groupBy("gi", "g") \
        .agg(F.coalesce(F.max("H0"), F.lit(0.0)).alias("H0"))  # H0 is non-decreasing in t


@query("survival_calibration", ["V11", "F11"])
def survival_calibration(spark, sf_dir):
    """Predicted survival at the median event time by decile of the
    prediction (test rows only), against the Kaplan-Meier survival of each
    decile at that time; deciles with fewer than 5 rows are left out."""
    from fathom.operators import folds
    from fathom.operators import survival as V
    from fathom.operators.ordered import quantile_row
    s, base = _cox_split(spark, sf_dir)
    test = s.where(F.col("split") == "test")
    events = s.where((F.col("event") == 1) & (F.col("split") == "train"))
    t_med = quantile_row(events, ["duration"], [0.5], "q_").first()["q_duration"][0]
    h0 = _h0_at(base, [t_med]).first()["H0"]
    p = test.withColumn("pred_surv", F.exp(-F.lit(float(h0)) * F.col("hr")))
    b = folds.qcut_assign(p, "pred_surv", folds.qcut_edges(p, "pred_surv", 10), "decile")
    km = V.kaplan_meier(b, "duration", "event", ["decile"])
    obs = km.where(F.col("time") <= t_med).groupBy("decile").agg(F.min("survival").alias("observed"))
    pred = b.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.avg("pred_surv").alias("predicted"))
    return pred.where(F.col("n") >= 5).join(obs, "decile", "left") \
        .withColumn("observed", F.coalesce("observed", F.lit(1.0))).withColumn("time", F.lit(float(t_med)))


@query("integrated_brier", ["V9"])
def integrated_brier(spark, sf_dir):
    """Integrated Brier score of the Cox model on test rows over a 20-point
    time grid, with inverse-probability-of-censoring weights from the
    censoring Kaplan-Meier (G), trapezoid rule over the grid."""
    import numpy as np
    from fathom.operators.ordered import quantile_row, running_totals
    s, base = _cox_split(spark, sf_dir)
    test = s.where(F.col("split") == "test")
    train = s.where(F.col("split") == "train")
    lo, hi = quantile_row(train.where(F.col("event") == 1), ["duration"], [0.05, 0.95], "q_").first()["q_duration"]
    grid = [float(x) for x in np.linspace(lo, hi, 20)]
    h0 = {r["gi"]: r["H0"] for r in _h0_at(base, grid).collect()}  # 20 numbers
    # censoring KM of the training subjects: log G accumulated over distinct times
    tc = train.groupBy(F.col("duration").alias("t")).agg(F.sum((1 - F.col("event")).cast("long")).alias("dc"),
                                                     F.count(F.lit(1)).alias("r"))
    n_all = train.count()
    gone = running_totals(tc, ["t"], {"rem": F.col("r")}, inclusive=False)
    inc = gone.withColumn("n", F.lit(n_all) - F.col("rem")).withColumn(
        "lg", F.when(F.col("dc") < F.col("n"), F.log(1 - F.col("dc") / F.col("n"))).otherwise(F.lit(-1e9)))
    # G just before each subject's time (exclusive sum) and G at each grid time (inclusive, step)
    times = inc.select("t", "lg").unionByName(test.select(F.col("duration").alias("t"), F.lit(0.0).alias("lg"))) \
        .groupBy("t").agg(F.sum("lg").alias("lg"))   # test times that no training subject has
    gb = running_totals(times, ["t"], {"lg_before": F.col("lg")}, inclusive=False)
    gpt = spark.createDataFrame([(i, g) for i, g in enumerate(grid)], "gi int, g double")
    g_grid = gpt.join(inc, F.col("t") <= F.col("g"), "left").groupBy("gi") \
        .agg(F.exp(F.coalesce(F.sum("lg"), F.lit(0.0))).alias("G_t"))   # 20 rows
    subj = test.join(gb.select(F.col("t").alias("duration"), F.exp("lg_before").alias("G_Ti")), "duration")
    h0df = spark.createDataFrame([(i, grid[i], float(h0[i])) for i in range(len(grid))], "gi int, g double, H0 double")
    pairs = subj.crossJoin(F.broadcast(h0df.join(g_grid, "gi")))   # test rows x 20 grid points (fixed)
    sp = F.exp(-F.col("H0") * F.col("hr"))
    term = F.when((F.col("duration") <= F.col("g")) & (F.col("event") == 1), sp * sp / F.col("G_Ti")) \
        .when(F.col("duration") > F.col("g"), (1 - sp) * (1 - sp) / F.col("G_t")).otherwise(F.lit(0.0))
    bs = pairs.groupBy("gi", "g").agg(F.avg(term).alias("brier")).orderBy("gi").collect()  # 20 rows
    xs = [r["g"] for r in bs]
    ys = [r["brier"] for r in bs]
    ibs = float(np.trapezoid(ys, xs) / (xs[-1] - xs[0])) if len(xs) > 1 else float("nan")
    rows = [(int(r["gi"]), float(r["g"]), float(r["brier"])) for r in bs] + [(-1, float("nan"), ibs)]
    return spark.createDataFrame(rows, "grid_index int, time double, brier double")
