"""Drift queries (D1-D9) on the two halves of the events month."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.numeric import rnd, sql_rnd
from fathom.functions.special import sql_ks_sf_duckdb
from fathom.operators import drift, folds, profile
from fathom.plans.common import SQL_EVENTS_FEATURES, coords, events_features, sql_coords
from fathom.plans.registry import query
from fathom.session import small_side
from fathom.sources.tables import Tables

FEATURES = ["value", "k"]
N_Q = 100


def _halves(spark, sf_dir):
    e = events_features(spark, sf_dir)
    lv = drift.long_values(e, FEATURES, extra=["event_id", "ts", "half"])
    return lv.where(F.col("half") == "reference"), lv.where(F.col("half") == "current")


def _probs_sql():
    return "[" + ", ".join(f"{p!r}e0" if "e" not in repr(p) else repr(p) for p in profile.linspace(N_Q)) + "]"


SQL_MISSING = """md AS (
  SELECT feature, 1.0e0 - count(x) FILTER (WHERE half = 'reference') / count(*) FILTER (WHERE half = 'reference') AS tm,
         1.0e0 - count(x) FILTER (WHERE half = 'current') / count(*) FILTER (WHERE half = 'current') AS cm
  FROM lv GROUP BY feature)"""

SQL_PROFILE = """pd AS (
  SELECT feature, avg(x) FILTER (WHERE half = 'reference') AS train_mean, stddev_pop(x) FILTER (WHERE half = 'reference') AS train_std,
         avg(x) FILTER (WHERE half = 'current') AS current_mean, stddev_pop(x) FILTER (WHERE half = 'current') AS current_std,
         count(x) FILTER (WHERE half = 'current') AS n_current
  FROM lv GROUP BY feature)"""

SQL_KS = f"""rq AS (SELECT feature, quantile_cont(x, {_probs_sql()}) AS qs FROM lv
               WHERE half = 'reference' AND x IS NOT NULL GROUP BY feature),
pts AS (SELECT feature, unnest(qs) AS x FROM rq),
u AS (SELECT feature, x, 1 AS wr, 0 AS wc FROM pts
      UNION ALL SELECT feature, x, 0, 1 FROM lv WHERE half = 'current' AND x IS NOT NULL),
pv AS (SELECT feature, x, sum(wr) AS wr, sum(wc) AS wc FROM u GROUP BY ALL),
cu AS (SELECT feature, sum(wr) OVER w AS cr, sum(wc) OVER w AS cc,
              sum(wr) OVER (PARTITION BY feature) AS n_ref, sum(wc) OVER (PARTITION BY feature) AS n_cur
       FROM pv WINDOW w AS (PARTITION BY feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks0 AS (SELECT feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
               max(abs(cr / n_ref - cc / n_cur)) AS d FROM cu GROUP BY ALL HAVING n_cur >= 10),
ks AS (SELECT *, {sql_ks_sf_duckdb('sqrt(n_ref * n_cur / (n_ref + n_cur)) * d')} AS p FROM ks0)"""

SQL_PSI = """rng AS (SELECT feature, min(x) AS lo, max(x) AS hi, count(*) AS n_ref FROM lv
               WHERE half = 'reference' AND x IS NOT NULL GROUP BY feature),
nc AS (SELECT feature, count(*) AS n_cur FROM lv WHERE half = 'current' AND x IS NOT NULL GROUP BY feature),
bn AS (SELECT lv.feature, lv.half,
              CASE WHEN x < lo OR x > hi THEN NULL WHEN hi - lo = 0 THEN 0 WHEN x = hi THEN 9
                   ELSE least(CAST(floor((x - lo) * (10.0e0 / (hi - lo))) AS INTEGER), 9) END AS bin
       FROM lv JOIN rng USING (feature) WHERE x IS NOT NULL),
rc AS (SELECT feature, bin, count(*) AS e FROM bn WHERE half = 'reference' GROUP BY ALL),
cc AS (SELECT feature, bin, count(*) AS a FROM bn WHERE half = 'current' AND bin IS NOT NULL GROUP BY ALL),
gr AS (SELECT feature, CAST(r.bin AS INTEGER) AS bin FROM rng CROSS JOIN range(0, 10) AS r(bin)),
ps AS (SELECT gr.feature, n_cur,
              sum((coalesce(cc.a, 0) / n_cur + 1e-8 - (coalesce(rc.e, 0) / n_ref + 1e-8))
                  * ln((coalesce(cc.a, 0) / n_cur + 1e-8) / (coalesce(rc.e, 0) / n_ref + 1e-8))) AS psi
       FROM gr LEFT JOIN rc USING (feature, bin) LEFT JOIN cc USING (feature, bin)
       JOIN rng USING (feature) JOIN nc USING (feature) GROUP BY ALL)"""


@query("missing_drift", ["D1"], sql=f"""
WITH {SQL_EVENTS_FEATURES}, {SQL_MISSING}
SELECT feature, {sql_rnd('tm', 6)} AS train_missing_rate, {sql_rnd('cm', 6)} AS current_missing_rate,
       {sql_rnd('abs(cm - tm)', 6)} AS absolute_change, abs(cm - tm) >= 0.05e0 AS missing_alert FROM md
""")
def missing_drift(spark, sf_dir):
    ref, cur = _halves(spark, sf_dir)
    d = drift.missing_drift(ref, cur, 0.05)
    return d.select("feature", *[rnd(c, 6).alias(c) for c in ["train_missing_rate", "current_missing_rate",
                                                              "absolute_change"]], "missing_alert")


def _ks(spark, sf_dir):
    ref, cur = _halves(spark, sf_dir)
    pts = drift.reference_points(ref, N_Q)
    return drift.ks_against_points(pts, cur, min_n=10)


@query("ks_drift", ["D2", "Q6"], sql=f"""
WITH {SQL_EVENTS_FEATURES}, {SQL_KS}
SELECT feature, n_ref, n_cur, {sql_rnd('d', 6)} AS ks_statistic, {sql_rnd('p', 6)} AS ks_pvalue, p < 0.05e0 AS ks_alert FROM ks
""")
def ks_drift(spark, sf_dir):
    k = _ks(spark, sf_dir)
    return k.select("feature", "n_ref", "n_cur", rnd("ks_statistic", 6).alias("ks_statistic"),
                    rnd("ks_pvalue", 6).alias("ks_pvalue"), "ks_alert")


@query("profile_drift", ["D3"], sql=f"""
WITH {SQL_EVENTS_FEATURES}, {SQL_PROFILE}
SELECT feature, {sql_rnd('train_mean', 6)} AS train_mean, {sql_rnd('current_mean', 6)} AS current_mean,
       {sql_rnd('train_std', 6)} AS train_std, {sql_rnd('current_std', 6)} AS current_std, n_current FROM pd
""")
def profile_drift(spark, sf_dir):
    ref, cur = _halves(spark, sf_dir)
    r = drift.profile_stats(ref).select("feature", F.col("mean").alias("train_mean"), F.col("std").alias("train_std"))
    c = drift.profile_stats(cur).select("feature", F.col("mean").alias("current_mean"),
                                        F.col("std").alias("current_std"), F.col("n").alias("n_current"))
    j = r.join(c, "feature")
    return j.select("feature", *[rnd(x, 6).alias(x) for x in ["train_mean", "current_mean", "train_std", "current_std"]],
                    "n_current")


@query("psi_drift", ["D4", "A9"], sql=f"""
WITH {SQL_EVENTS_FEATURES}, {SQL_PSI}
SELECT feature, {sql_rnd('psi', 6)} AS psi, psi > 0.2e0 AS psi_alert, n_cur AS n_current FROM ps
""")
def psi_drift(spark, sf_dir):
    ref, cur = _halves(spark, sf_dir)
    p = drift.psi(ref, cur, bins=10)
    return p.select("feature", rnd("psi", 6).alias("psi"), (F.col("psi") > 0.2).alias("psi_alert"), "n_current")


@query("window_mean_drift", ["D5", "F6"], sql=f"""
WITH {SQL_EVENTS_FEATURES},
c AS (SELECT *, CAST(ntile(4) OVER (ORDER BY ts, event_id) AS INTEGER) AS tile FROM e WHERE half = 'current')
SELECT 'value' AS feature, tile, {sql_rnd('avg(value)', 6)} AS mean, count(value) AS n FROM c GROUP BY tile
UNION ALL
SELECT 'k', tile, {sql_rnd('avg(k)', 6)}, count(k) FROM c GROUP BY tile
""")
def window_mean_drift(spark, sf_dir):
    e = events_features(spark, sf_dir).where(F.col("half") == "current")
    t = folds.ordered_tiles(e, ["ts", "event_id"], 4, "tile")
    m = drift.window_means(drift.long_values(t, FEATURES, extra=["tile"]), "tile")
    return m.select("feature", "tile", rnd("mean", 6).alias("mean"), "n")


@query("drift_report", ["D1", "D2", "D3", "D4", "D7", "D8", "Q6"], sql=f"""
WITH {SQL_EVENTS_FEATURES}, {SQL_MISSING}, {SQL_PROFILE}, {SQL_KS}, {SQL_PSI}
SELECT md.feature, {sql_rnd('tm', 6)} AS train_missing_rate, {sql_rnd('cm', 6)} AS current_missing_rate,
       abs(cm - tm) >= 0.05e0 AS missing_alert,
       {sql_rnd('d', 6)} AS ks_statistic, {sql_rnd('p', 6)} AS ks_pvalue, p < 0.05e0 AS ks_alert,
       {sql_rnd('train_mean', 6)} AS train_mean, {sql_rnd('current_mean', 6)} AS current_mean,
       {sql_rnd('train_std', 6)} AS train_std, {sql_rnd('current_std', 6)} AS current_std,
       {sql_rnd('psi', 6)} AS psi, 0.2e0 AS psi_limit, psi > 0.2e0 AS psi_alert, pd.n_current,
       (psi > 0.2e0 OR coalesce(p < 0.05e0, false) OR abs(cm - tm) >= 0.05e0) AS retrain
FROM md JOIN pd USING (feature) LEFT JOIN ks USING (feature) JOIN ps USING (feature)
""")
def drift_report(spark, sf_dir):
    e = events_features(spark, sf_dir)
    lv = drift.long_values(e, FEATURES, extra=["half"])
    # missingness, moments and PSI of both halves from one aggregate and one binning pass
    hr = drift.half_report(lv, "half", "reference", "current", bins=10, missing_limit=0.05)
    ks = _ks(spark, sf_dir).select("feature", "ks_statistic", "ks_pvalue", "ks_alert")
    j = hr.join(ks, "feature", "left")
    retrain = (F.col("psi") > 0.2) | F.coalesce(F.col("ks_alert"), F.lit(False)) | F.col("missing_alert")
    return j.select(
        "feature", rnd("train_missing_rate", 6).alias("train_missing_rate"),
        rnd("current_missing_rate", 6).alias("current_missing_rate"), "missing_alert",
        rnd("ks_statistic", 6).alias("ks_statistic"), rnd("ks_pvalue", 6).alias("ks_pvalue"), "ks_alert",
        *[rnd(x, 6).alias(x) for x in ["train_mean", "current_mean", "train_std", "current_std", "psi"]],
        F.lit(0.2).alias("psi_limit"), (F.col("psi") > 0.2).alias("psi_alert"), "n_current", retrain.alias("retrain"))


@query("retrain_triggers", ["D8"], sql=f"""
WITH {SQL_EVENTS_FEATURES}, {SQL_PSI},
m AS (SELECT event_type, avg(value) AS pred FROM e WHERE half = 'reference' GROUP BY 1),
r AS (SELECT half, sqrt(avg(power(value - pred, 2))) AS rmse, count(value) AS n FROM e JOIN m USING (event_type) WHERE value IS NOT NULL GROUP BY 1),
t AS (SELECT (SELECT max(psi) FROM ps) AS p, max(rmse) FILTER (WHERE half = 'reference') AS b, max(rmse) FILTER (WHERE half = 'current') AS c,
             max(n) FILTER (WHERE half = 'current') AS n FROM r)
SELECT {sql_rnd('p', 6)} AS max_psi, {sql_rnd('b', 6)} AS baseline_rmse, {sql_rnd('c', 6)} AS current_rmse, n AS n_new_labels,
       p > 0.2e0 AS psi_trigger, c > 1.1e0 * b AS rmse_trigger, n >= 1000 AS label_trigger,
       p > 0.2e0 OR c > 1.1e0 * b OR n >= 1000 AS retrain FROM t
""")
def retrain_triggers(spark, sf_dir):
    """Whether drift, the error of the event-type means or the number of new labels calls for retraining."""
    ref, cur = _halves(spark, sf_dir)
    e = events_features(spark, sf_dir).where("value IS NOT NULL")
    means = small_side(e.where(F.col("half") == "reference").groupBy("event_type").agg(F.avg("value").alias("pred")))
    scored = e.join(means, "event_type").groupBy("half").agg(
        F.sqrt(F.avg((F.col("value") - F.col("pred")) ** 2)).alias("rmse"), F.count("value").alias("n"))
    base, now = scored.where(F.col("half") == "reference"), scored.where(F.col("half") == "current")
    t = drift.retrain_triggers(drift.psi(ref, cur, bins=10), base, now, now)
    return t.select(*[rnd(c, 6).alias(c) for c in ("max_psi", "baseline_rmse", "current_rmse")], "n_new_labels", "psi_trigger",
                    "rmse_trigger", "label_trigger", "retrain")


LAST_N, PSI_LIMIT = 100, 0.2
_BIN = ("CASE WHEN x < lo OR x > hi THEN -1 WHEN lo = hi THEN 0 WHEN x = hi THEN 9 "
        "ELSE least(CAST(floor((x - lo) * (10.0e0 / (hi - lo))) AS INTEGER), 9) END")
SQL_LAST_N = f"""
WITH {SQL_EVENTS_FEATURES},
pr AS (SELECT feature, min(x) AS lo, max(x) AS hi, count(x) AS n FROM lv WHERE half = 'reference' AND x IS NOT NULL GROUP BY 1),
b AS (SELECT feature, event_id, ts, half, n, {_BIN} AS bin FROM lv JOIN pr USING (feature) WHERE x IS NOT NULL),
sh AS (SELECT feature, {", ".join(f"count(*) FILTER (WHERE bin = {i}) / any_value(n) + 1e-8 AS e{i}" for i in range(10))}
       FROM b WHERE half = 'reference' GROUP BY 1),
r AS (SELECT feature, event_id, count(*) OVER w AS m,
             {", ".join(f"count(*) FILTER (WHERE bin = {i}) OVER w AS c{i}" for i in range(10))}
      FROM b WHERE half = 'current'
      WINDOW w AS (PARTITION BY feature ORDER BY ts, event_id ROWS BETWEEN {LAST_N - 1} PRECEDING AND CURRENT ROW)),
p AS (SELECT feature, event_id, CAST(m AS INTEGER) AS n_window,
             {" + ".join(f"(c{i} / m + 1e-8 - e{i}) * ln((c{i} / m + 1e-8) / e{i})" for i in range(10))} AS psi
      FROM r JOIN sh USING (feature) WHERE m >= {LAST_N // 2})
SELECT feature, event_id, n_window, {sql_rnd("psi", 6)} AS psi, psi > {PSI_LIMIT}e0 AS drifted FROM p
"""


def last_n_report(scores):
    return scores.select("feature", "event_id", "n_window", rnd("psi", 6).alias("psi"), (F.col("psi") > PSI_LIMIT).alias("drifted"))


@query("rolling_psi_last_n", ["D6", "T1"], sql=SQL_LAST_N)
def rolling_psi_last_n(spark, sf_dir):
    """PSI of each feature's last 100 values at every value of the second half, against the first half."""
    e = events_features(spark, sf_dir)
    lv = drift.long_values(e, FEATURES, extra=["event_id", "ts", "half"])
    profile = small_side(drift.bin_profile(lv.where(F.col("half") == "reference")))
    return last_n_report(drift.last_n_psi(lv.where(F.col("half") == "current"), profile, ["ts", "event_id"], LAST_N,
                                          keep=["event_id"]))


LAT_S, LON_S = sql_coords("s_suppkey")
LAT_C, LON_C = sql_coords("c_custkey")


@query("spatial_bounds_check", ["D9"], sql=f"""
WITH b AS (SELECT min({LAT_S}) AS a0, max({LAT_S}) AS a1, min({LON_S}) AS o0, max({LON_S}) AS o1 FROM supplier),
i AS (SELECT ({LAT_C} BETWEEN a0 AND a1) AND ({LON_C} BETWEEN o0 AND o1) AS inside FROM customer CROSS JOIN b)
SELECT bool_and(inside) AS all_inside, count(*) FILTER (WHERE NOT inside) AS n_outside, count(*) AS n_points FROM i
""")
def spatial_bounds_check(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lat, lon = coords("s_suppkey")
    s = t.supplier.select(lat.alias("lat"), lon.alias("lon"))
    lat, lon = coords("c_custkey")
    c = t.customer.select(lat.alias("lat"), lon.alias("lon"))
    return drift.bounds_check(s, c, "lat", "lon")
