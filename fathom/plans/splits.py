"""Split and fold queries (F1-F16) on orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.hashing import sql_bucket, sql_h32, sql_key_text, sql_salted_h32
from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import folds
from fathom.plans.registry import query
from fathom.sources.tables import Tables

OKT = sql_key_text("o_orderkey")


@query("holdout_split_counts", ["F1", "F13", "F15"], sql=f"""
WITH s AS (
  SELECT o_orderkey,
         CASE WHEN {sql_bucket(OKT, 'split')} < 80 THEN 'train' ELSE 'test' END AS split,
         CAST({sql_bucket(OKT, 'calib')} < 20 AS INTEGER) AS is_calibration,
         CASE WHEN {sql_bucket(OKT, 'ab', 2)} = 0 THEN 'A' ELSE 'B' END AS arm
  FROM orders)
SELECT split, CASE WHEN split = 'train' THEN is_calibration END AS is_calibration, arm,
       count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM s GROUP BY ALL
""")
def holdout_split_counts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    o = folds.ab_arm(folds.calibration_flag(folds.holdout(o, ["o_orderkey"]), ["o_orderkey"]), ["o_orderkey"])
    o = o.withColumn("is_calibration", F.when(F.col("split") == "train", F.col("is_calibration")))
    return o.groupBy("split", "is_calibration", "arm").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("stratified_split_counts", ["F2"], sql=f"""
WITH r AS (
  SELECT o_orderkey, o_orderstatus,
         row_number() OVER (PARTITION BY o_orderstatus
                            ORDER BY {sql_salted_h32(OKT, 'strat')}, {OKT}) AS rn,
         count(*) OVER (PARTITION BY o_orderstatus) AS n
  FROM orders),
s AS (SELECT *, CASE WHEN rn <= (n * 20 + 50) // 100 THEN 'test' ELSE 'train' END AS split FROM r)
SELECT o_orderstatus, split, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM s GROUP BY ALL
""")
def stratified_split_counts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus")
    s = folds.stratified_holdout(o, ["o_orderkey"], ["o_orderstatus"], test_pct=20)
    return s.groupBy("o_orderstatus", "split").agg(F.count(F.lit(1)).alias("n"),
                                                    F.sum("o_orderkey").alias("key_sum"))


@query("quartile_stratified_split", ["F3", "F11"], sql=f"""
WITH e AS (SELECT list_sort(list_distinct(quantile_cont(o_totalprice, [0.0, 0.25, 0.5, 0.75, 1.0]))) AS edges
           FROM orders),
b AS (
  SELECT o_orderkey, o_totalprice,
         CASE WHEN o_totalprice = edges[1] THEN 0
              WHEN o_totalprice < edges[1] OR o_totalprice > edges[len(edges)] THEN NULL
              ELSE len(list_filter(edges, lambda x: x < o_totalprice)) - 1 END AS qbin,
         edges
  FROM orders CROSS JOIN e),
r AS (
  SELECT *, row_number() OVER (PARTITION BY qbin ORDER BY {sql_salted_h32(OKT, 'strat')}, {OKT}) AS rn,
         count(*) OVER (PARTITION BY qbin) AS nb
  FROM b)
SELECT CAST(qbin AS INTEGER) AS qbin, {sql_rnd('edges[qbin + 1]', 4)} AS lower_edge,
       {sql_rnd('edges[qbin + 2]', 4)} AS upper_edge,
       count(*) AS n, CAST(sum(CASE WHEN rn <= (nb * 20 + 50) // 100 THEN 1 ELSE 0 END) AS BIGINT) AS n_test,
       CAST(sum(CASE WHEN rn <= (nb * 20 + 50) // 100 THEN o_orderkey ELSE 0 END) AS BIGINT) AS test_key_sum
FROM r GROUP BY ALL
""")
def quartile_stratified_split(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    edges = folds.qcut_edges(o, "o_totalprice", 4)
    binned = folds.qcut_assign(o, "o_totalprice", edges, "qbin")
    s = folds.stratified_holdout(binned, ["o_orderkey"], ["qbin"], test_pct=20)
    s = s.crossJoin(F.broadcast(edges))
    is_test = F.col("split") == "test"
    return s.groupBy("qbin", F.col("edges")[F.col("qbin")].alias("lo"), F.col("edges")[F.col("qbin") + 1].alias("hi")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum(is_test.cast("long")).alias("n_test"),
             F.sum(F.when(is_test, F.col("o_orderkey")).otherwise(F.lit(0))).alias("test_key_sum")) \
        .select("qbin", rnd("lo", 4).alias("lower_edge"), rnd("hi", 4).alias("upper_edge"), "n", "n_test", "test_key_sum")


@query("time_holdout", ["F4", "F9", "F6"], sql="""
WITH r AS (
  SELECT event_id, ts,
         row_number() OVER (ORDER BY ts, event_id) AS rn,
         count(*) OVER () AS n,
         CAST(ntile(6) OVER (ORDER BY ts, event_id) AS INTEGER) AS tile
  FROM events)
SELECT tile, CASE WHEN rn > n - (n * 20 + 50) // 100 THEN 'test' ELSE 'train' END AS split,
       count(*) AS n, min(event_id) AS min_event_id, max(event_id) AS max_event_id,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM r GROUP BY ALL
""")
def time_holdout(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("event_id", "ts")
    e = folds.time_series_folds(e, ["ts", "event_id"], n_splits=5, name="tile")
    e = folds.time_holdout(e, ["ts", "event_id"], test_pct=20)
    return e.groupBy("tile", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("min_event_id"), F.max("event_id").alias("max_event_id"),
        F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_ts"))


@query("repeated_kfold_counts", ["F6", "F10"], sql=f"""
SELECT CAST(r.repeat AS INTEGER) AS repeat,
       CAST({sql_h32(OKT + " || 'rkfold' || CAST(r.repeat AS VARCHAR)")} % 5 AS INTEGER) AS fold,
       count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders CROSS JOIN range(1, 4) AS r(repeat)
GROUP BY ALL
""")
def repeated_kfold_counts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    f = folds.repeated_kfold(o, ["o_orderkey"], k=5, repeats=3)
    return f.groupBy("repeat", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("stratified_kfold_counts", ["F7"], sql=f"""
WITH r AS (
  SELECT o_orderkey, o_orderstatus,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY {sql_salted_h32(OKT, 'skfold')}, {OKT}) AS rn
  FROM orders)
SELECT o_orderstatus, CAST((rn - 1) % 5 AS INTEGER) AS fold, count(*) AS n,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM r GROUP BY ALL
""")
def stratified_kfold_counts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus")
    f = folds.stratified_kfold(o, ["o_orderkey"], ["o_orderstatus"], k=5)
    return f.groupBy("o_orderstatus", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("group_kfold_counts", ["F8"], sql="""
WITH g AS (SELECT o_custkey, count(*) AS size FROM orders GROUP BY o_custkey),
r AS (SELECT o_custkey, row_number() OVER (ORDER BY size DESC, CAST(o_custkey AS VARCHAR)) - 1 AS r0 FROM g),
a AS (SELECT o_custkey, CAST(CASE WHEN (r0 // 5) % 2 = 0 THEN r0 % 5 ELSE 4 - r0 % 5 END AS INTEGER) AS fold FROM r)
SELECT fold, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_groups,
       CAST(sum(o_custkey) AS BIGINT) AS group_key_sum
FROM orders JOIN a USING (o_custkey) GROUP BY fold
""")
def group_kfold_counts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey")
    f = folds.group_kfold(o, "o_custkey", k=5)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_custkey").alias("n_groups"),
                                 F.sum("o_custkey").alias("group_key_sum"))


@query("nested_sample_counts", ["F14"], sql=f"""
SELECT f.fraction, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders CROSS JOIN (VALUES (0.1e0), (0.25e0), (0.5e0), (1.0e0)) AS f(fraction)
WHERE {sql_salted_h32(OKT, 'lcurve')} / 4294967296.0e0 < f.fraction
GROUP BY f.fraction
""")
def nested_sample_counts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    s = folds.nested_samples(o, ["o_orderkey"], [0.1, 0.25, 0.5, 1.0])
    return s.groupBy("fraction").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


def _sql_poisson_case(u: str) -> str:
    parts = " ".join(f"WHEN {u} < {p!r}e0 THEN {k}" if "e" not in repr(p) else f"WHEN {u} < {p!r} THEN {k}"
                     for k, p in enumerate(folds.POISSON1_CDF))
    return f"CASE {parts} ELSE 11 END"


@query("bootstrap_weight_sums", ["F16"], sql=f"""
WITH w AS (
  SELECT o_orderkey, CAST(r.replicate AS INTEGER) AS replicate,
         {_sql_poisson_case(sql_h32(OKT + " || 'boot' || CAST(r.replicate AS VARCHAR)") + " / 4294967296.0e0")} AS weight
  FROM orders CROSS JOIN range(1, 6) AS r(replicate))
SELECT replicate, CAST(sum(weight) AS BIGINT) AS weight_sum,
       count(*) FILTER (WHERE weight = 0) AS n_out_of_bag, max(weight) AS max_weight
FROM w GROUP BY replicate
""")
def bootstrap_weight_sums(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    w = folds.bootstrap_weights(o, ["o_orderkey"], 5)
    return w.groupBy("replicate").agg(F.sum("weight").alias("weight_sum"),
                                      F.count(F.when(F.col("weight") == 0, 1)).alias("n_out_of_bag"),
                                      F.max("weight").alias("max_weight"))


@query("latest_year_holdout", ["F5"], sql=f"""
WITH lines AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey),
o AS (SELECT year(o_orderdate) AS yr, o_totalprice AS y, CAST(coalesce(n_lines, 0) AS DOUBLE) AS x
      FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey WHERE o_orderdate IS NOT NULL),
h AS (SELECT max(yr) AS hy, count(DISTINCT yr) AS n_years FROM o),
tr AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, count(*) AS train_rows,
              string_agg(DISTINCT CAST(yr AS VARCHAR), ',' ORDER BY CAST(yr AS VARCHAR)) AS train_years
       FROM o, h WHERE yr < hy),
va AS (SELECT count(*) AS holdout_rows,
              avg(abs(y - (intercept + slope * x))) AS mae,
              sqrt(avg((y - (intercept + slope * x)) * (y - (intercept + slope * x)))) AS rmse,
              1 - sum((y - (intercept + slope * x)) * (y - (intercept + slope * x))) / (var_pop(y) * count(*)) AS r2
       FROM o, h, tr WHERE yr = hy)
SELECT CAST(hy AS INTEGER) AS holdout_year, train_years, train_rows, holdout_rows,
       {sql_rnd('slope', 4)} AS slope, {sql_rnd('intercept', 4)} AS intercept,
       {sql_rnd('mae', 4)} AS mae, {sql_rnd('rmse', 4)} AS rmse, {sql_rnd('r2', 6)} AS r2
FROM h, tr, va WHERE n_years >= 2 AND train_rows >= 100 AND holdout_rows >= 20
""")
def latest_year_holdout(spark, sf_dir):
    """fit order value on its line count over every year but the
    latest, score on the latest year; no row when a size guard fails."""
    t = Tables(spark, sf_dir)
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    o = t.orders.where(F.col("o_orderdate").isNotNull()) \
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left") \
        .select(F.year("o_orderdate").alias("yr"), F.col("o_totalprice").alias("y"),
                F.coalesce(F.col("n_lines"), F.lit(0)).cast("double").alias("x"))
    cut = folds.latest_period_holdout(o, "yr", min_train=100, min_valid=20)
    schema = ("holdout_year int, train_years string, train_rows long, holdout_rows long, slope double, "
              "intercept double, mae double, rmse double, r2 double")
    if cut is None:
        return spark.createDataFrame([], schema)
    s, last, periods = cut
    years = periods.agg(F.array_join(F.sort_array(F.collect_set(F.col("yr").cast("string"))), ",").alias("train_years"))  # years are few
    fit = s.where(F.col("split") == "train").agg(
        F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
        F.count(F.lit(1)).alias("train_rows")).first()
    p = F.lit(fit["intercept"]) + F.lit(fit["slope"]) * F.col("x")
    r = F.col("y") - p
    out = s.where(F.col("split") == "valid").agg(
        F.lit(int(last)).alias("holdout_year"),
        F.lit(fit["train_rows"]).cast("long").alias("train_rows"), F.count(F.lit(1)).alias("holdout_rows"),
        rnd(F.lit(fit["slope"]), 4).alias("slope"), rnd(F.lit(fit["intercept"]), 4).alias("intercept"),
        rnd(F.avg(F.abs(r)), 4).alias("mae"), rnd(F.sqrt(F.avg(r * r)), 4).alias("rmse"),
        rnd(F.lit(1.0) - F.sum(r * r) / (F.var_pop("y") * F.count(F.lit(1))), 6).alias("r2"))
    return out.crossJoin(F.broadcast(years)).select("holdout_year", "train_years", *out.columns[1:])
