"""Queries of learnt frames, row filters, side-by-side results, overviews and
version records (P2, P9, L20, L21, J3, A11, Q22)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fathom.functions.hashing import sql_bucket, sql_h32, sql_key_text
from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import folds, frames, profile
from fathom.plans.common import SPLIT_TS, coords, sql_coords
from fathom.plans.registry import query
from fathom.plans.slice import SQL_SCORED_ORDERS, scored_orders
from fathom.session import ensure_checkpoint_dir
from fathom.sources.tables import Tables

TEXTS = ["value_text", "event_type", "k_text", "user_text"]
_TEXTS_SQL = """t AS (SELECT event_id, CAST(value AS VARCHAR) AS value_text, event_type, regexp_extract(props, '"k": (\\d+)', 1) AS k_text,
                  CASE WHEN event_id % 4 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS user_text FROM events)"""


@query("adaptive_cast_frame", ["P2"], sql=f"""
WITH {_TEXTS_SQL}
SELECT event_id, TRY_CAST(value_text AS DOUBLE) AS value_text, event_type, TRY_CAST(k_text AS DOUBLE) AS k_text, user_text FROM t
""")
def adaptive_cast_frame(spark, sf_dir):
    """Events as text, cast back: columns that parse in more than 80% of their values become numbers."""
    e = Tables(spark, sf_dir).events
    t = e.select("event_id", F.col("value").cast("string").alias("value_text"), "event_type",
                 F.regexp_extract("props", r'"k": (\d+)', 1).alias("k_text"),
                 F.when(F.col("event_id") % 4 == 0, F.lit("n/a")).otherwise(F.col("user_id").cast("string")).alias("user_text"))
    return frames.adaptive_cast(t, TEXTS, 0.8)


@query("fence_filter", ["P9"], sql="\nUNION ALL\n".join(f"""
SELECT '{name}' AS form, {sql_rnd('any_value(lo)', 6)} AS lower, {sql_rnd('any_value(hi)', 6)} AS upper, count(*) AS n_kept,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders CROSS JOIN (SELECT q[1] - 1.5e0 * (q[2] - q[1]) AS lo, q[2] + 1.5e0 * (q[2] - q[1]) AS hi
                        FROM (SELECT quantile_cont({v}, [0.25, 0.75]) AS q FROM orders)) AS f
WHERE {v} BETWEEN lo AND hi""" for name, v in (("plain", "o_totalprice"), ("log", "ln(o_totalprice)"))))
def fence_filter(spark, sf_dir):
    """Orders within the quartile fences of the price and of its logarithm."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    out = None
    for name, v in (("plain", F.col("o_totalprice")), ("log", F.log("o_totalprice"))):
        kept = frames.within_fences(o, v).agg(rnd(F.first("lower"), 6).alias("lower"), rnd(F.first("upper"), 6).alias("upper"),
                                              F.count(F.lit(1)).alias("n_kept"), F.sum("o_orderkey").alias("key_sum"))
        row = kept.select(F.lit(name).alias("form"), "*")
        out = row if out is None else out.unionByName(row)
    return out


_SPLIT = f"CASE WHEN {sql_bucket(sql_key_text('c_custkey'), 'split')} < 80 THEN 'train' ELSE 'test' END"


@query("survival_frame", ["L20", "L21", "L10"], sql=f"""
WITH c AS (SELECT *, {_SPLIT} AS split FROM customer),
q AS (SELECT quantile_cont(c_acctbal, [0.25, 0.5, 0.75]) AS b, quantile_cont(c_nationkey, [0.25, 0.5, 0.75]) AS n FROM c WHERE split = 'train'),
l AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT c_mktsegment FROM c WHERE split = 'train' AND c_mktsegment IS NOT NULL))
SELECT c_custkey, {sql_rnd('coalesce((c_acctbal - b[2]) / (b[3] - b[1]), 0)', 8)} AS c_acctbal,
       {sql_rnd('coalesce((c_nationkey - n[2]) / (n[3] - n[1]), 0)', 8)} AS c_nationkey,
       coalesce(code, -1) AS c_mktsegment
FROM c CROSS JOIN q LEFT JOIN l USING (c_mktsegment) WHERE split = 'test'
""")
def survival_frame(spark, sf_dir):
    """Robust-scaled numbers and ordinal categories learnt on training customers, applied to the test customers."""
    c = folds.holdout(Tables(spark, sf_dir).customer, ["c_custkey"])
    train = c.where("split = 'train'")
    frame = frames.fit_frame(train.select("c_acctbal", "c_nationkey", "c_mktsegment"), None, ["c_mktsegment"])
    out = frame.apply(c.where("split = 'test'"), keep=["c_custkey"])
    return out.select("c_custkey", rnd("c_acctbal", 8).alias("c_acctbal"), rnd("c_nationkey", 8).alias("c_nationkey"), "c_mktsegment")


@query("side_by_side", ["J3"], sql=f"""
WITH {SQL_SCORED_ORDERS}
SELECT o_orderkey, o_totalprice AS label, o_orderpriority AS priority, {sql_rnd('pred', 6)} AS grouped,
       {sql_rnd('(SELECT gmean FROM g)', 6)} AS baseline FROM so WHERE split = 'test'
""")
def side_by_side(spark, sf_dir):
    """Label, a feature and two models' predictions of the test orders, joined by row key."""
    so = scored_orders(spark, sf_dir)
    test, mean = so.where("split = 'test'"), so.where("split = 'train'").agg(F.avg("o_totalprice").alias("m"))
    base = test.select("o_orderkey").crossJoin(F.broadcast(mean))
    out = frames.side_by_side(["o_orderkey"], {"label": (test, "o_totalprice"), "priority": (test, "o_orderpriority"),
                                               "grouped": (test, "pred"), "baseline": (base, "m")})
    return out.select("o_orderkey", "label", "priority", rnd("grouped", 6).alias("grouped"), rnd("baseline", 6).alias("baseline"))


OVERVIEW = ["c_acctbal", "lat", "lon", "orders", "spend"]
_LAT, _LON = sql_coords("c_custkey")
_PAIRS = [(a, b) for i, a in enumerate(OVERVIEW) for b in OVERVIEW[i + 1:]]


@query("coordinate_overview", ["A11"], sql=f"""
WITH sp AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS orders, sum(o_totalprice) AS spend FROM orders GROUP BY 1),
c AS (SELECT c_acctbal, {_LAT} AS lat, {_LON} AS lon, coalesce(orders, 0) AS orders, coalesce(spend, 0) AS spend
      FROM customer LEFT JOIN sp ON o_custkey = c_custkey),
p AS ({" UNION ALL ".join(f"SELECT 'correlation' AS section, '{a}~{b}' AS name, corr({a}, {b}) AS value FROM c" for a, b in _PAIRS)}),
a AS ({" UNION ALL ".join(f"SELECT 'range' AS section, '{f}_{x}' AS name, {f}({x}) AS value FROM c" for x in ("lat", "lon") for f in ("min", "max"))}
      UNION ALL SELECT 'cap_share', 'orders', avg(CASE WHEN orders = (SELECT max(orders) FROM c) THEN 1.0e0 ELSE 0.0e0 END) FROM c
      UNION ALL SELECT * FROM (SELECT * FROM p ORDER BY abs(value) DESC, name LIMIT 8))
SELECT section, name, {sql_rnd('value', 8)} AS value FROM a
""")
def coordinate_overview(spark, sf_dir):
    """Where customers are, how many are at the largest number of orders, and the eight strongest correlations."""
    lat, lon = coords("c_custkey")
    t = Tables(spark, sf_dir)
    sp = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).cast("double").alias("orders"), F.sum("o_totalprice").alias("spend"))
    c = t.customer.select("c_custkey", "c_acctbal", lat.alias("lat"), lon.alias("lon")).join(sp, "c_custkey", "left").fillna(0.0, subset=["orders", "spend"])
    o = frames.overview(c, "lat", "lon", "orders", OVERVIEW, 8)
    return o.select("section", "name", rnd("value", 8).alias("value"))


_EVENT_TEXT = "concat_ws('|', CAST(event_id AS VARCHAR), event_type, CAST(user_id AS VARCHAR))"


def _sql_version(v, where):
    return (f"SELECT {v} AS version, count(*) AS n_rows, 3 AS n_features, count(*) FILTER (WHERE {sql_bucket(sql_key_text('event_id'), 'split')} < 80) AS n_train, "
            f"bit_xor({sql_h32(_EVENT_TEXT)}) AS hash_xor FROM events WHERE {where}")


@query("dataset_versions", ["Q22", "Q23"], sql=_sql_version(1, f"ts < TIMESTAMP '{SPLIT_TS}'") + "\nUNION ALL\n" + _sql_version(2, "true"))
def dataset_versions(spark, sf_dir):
    """Version records of a growing table: the first half, all rows, and all rows again, which adds no version."""
    path = f"{ensure_checkpoint_dir(spark)}/versions-{uuid.uuid4().hex[:8]}"
    e = folds.holdout(Tables(spark, sf_dir).events.select("event_id", "event_type", "user_id", "ts"), ["event_id"])
    for part in (e.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")), e, e):
        fp = profile.fingerprint(part, profile.row_fingerprint_text(["event_id", "event_type", "user_id"]))
        sizes = part.agg(F.count(F.when(F.col("split") == "train", 1)).alias("n_train"))
        record = fp.crossJoin(sizes).select("n_rows", F.lit(3).alias("n_features"), "n_train", "hash_xor")
        frames.append_version(record, path, ["n_rows", "n_features", "hash_xor"])
    return spark.read.parquet(path).select(F.col("version").cast("int").alias("version"), "n_rows", "n_features", "n_train", "hash_xor")
