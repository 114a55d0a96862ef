"""The minimum slice: which order-priority and status groups does the
group-mean price model serve worst?  (F1, L11, J1, E20, E25, J7)"""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.hashing import sql_bucket, sql_key_text
from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import evalreg, folds, learned
from fathom.plans.registry import query
from fathom.sources.tables import Tables


def scored_orders(spark, sf_dir, smoothing: float = 10.0):
    """Orders with a hash split and the smoothed group-mean prediction
    learnt on training rows (shared by the regression queries)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus",
                                            "o_totalprice", "o_orderdate")
    o = folds.holdout(o, ["o_orderkey"], 80, "split")
    train = o.where(F.col("split") == "train")
    state = learned.fit_target_encoding(train, "o_orderpriority", "o_totalprice", smoothing=smoothing)
    return learned.apply_target_encoding(o, state, "o_orderpriority", "pred")


SQL_SCORED_ORDERS = f"""
o AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_totalprice, o_orderdate,
         CASE WHEN {sql_bucket(sql_key_text('o_orderkey'), 'split')} < 80 THEN 'train' ELSE 'test' END AS split
  FROM orders),
g AS (SELECT avg(o_totalprice) AS gmean FROM o WHERE split = 'train'),
lv AS (
  SELECT o_orderpriority,
         (count(*) * avg(o_totalprice) + 10.0e0 * (SELECT gmean FROM g)) / (count(*) + 10.0e0) AS enc
  FROM o WHERE split = 'train' GROUP BY o_orderpriority),
so AS (
  SELECT o.*, coalesce(lv.enc, (SELECT gmean FROM g)) AS pred
  FROM o LEFT JOIN lv USING (o_orderpriority))
"""


@query("group_model_worst_segments", ["F1", "L11", "J1", "E20", "E25", "J7"], sql=f"""
WITH {SQL_SCORED_ORDERS},
t AS (SELECT * FROM so WHERE split = 'test'),
ov AS (SELECT sqrt(avg((o_totalprice - pred) * (o_totalprice - pred))) AS overall_rmse FROM t),
lg AS (
  SELECT 'o_orderpriority' AS group_column, o_orderpriority AS group_value, o_totalprice, pred FROM t
  UNION ALL
  SELECT 'o_orderstatus', o_orderstatus, o_totalprice, pred FROM t),
gr AS (
  SELECT group_column, group_value, count(*) AS n,
         sqrt(avg((o_totalprice - pred) * (o_totalprice - pred))) AS rmse,
         avg(abs(o_totalprice - pred)) AS mae,
         1 - sum((o_totalprice - pred) * (o_totalprice - pred)) / (var_pop(o_totalprice) * count(*)) AS r2
  FROM lg WHERE group_value IS NOT NULL GROUP BY group_column, group_value HAVING count(*) >= 20)
SELECT group_column, group_value, n,
       {sql_rnd('rmse', 4)} AS rmse, {sql_rnd('mae', 4)} AS mae, {sql_rnd('r2', 6)} AS r2,
       {sql_rnd('rmse / overall_rmse', 6)} AS rmse_gap, rmse / overall_rmse > 1.25 AS alert
FROM gr CROSS JOIN ov
ORDER BY rmse_gap DESC, group_column, group_value
""")
def group_model_worst_segments(spark, sf_dir):
    so = scored_orders(spark, sf_dir)
    test = so.where(F.col("split") == "test")
    seg = evalreg.subgroup_regression(test, "o_totalprice", "pred", ["o_orderpriority", "o_orderstatus"],
                                      min_n=20, gap_limit=1.25)
    return seg.select(
        "group_column", "group_value", "n",
        rnd("rmse", 4).alias("rmse"), rnd("mae", 4).alias("mae"), rnd("r2", 6).alias("r2"),
        rnd("rmse_gap", 6).alias("rmse_gap"), "alert",
    ).orderBy(F.desc("rmse_gap"), "group_column", "group_value")
