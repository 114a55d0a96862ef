"""Stand-in inputs shared by the queries (FIXTURES.md part 2), each as a
Spark DataFrame builder and the equivalent DuckDB CTE text."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.hashing import sql_key_text
from fathom.sources.tables import ROW_KEYS, Tables, sql_injected_missing, with_injected_missing

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_KEY = list(ROW_KEYS["lineitem"])
LI_MISSING = LI_NUM + ["l_returnflag"]


def lineitem_missing(spark, sf_dir):
    """lineitem with 15% injected NULLs in four numerics and the return flag."""
    li = Tables(spark, sf_dir).lineitem.select(*LI_KEY, *LI_NUM, "l_returnflag", "l_linestatus", "l_shipdate")
    return with_injected_missing(li, LI_KEY, LI_MISSING)


SQL_LI_MISSING = "li AS (SELECT " + ", ".join(LI_KEY) + ", " + ", ".join(
    f"{sql_injected_missing(c, LI_KEY)} AS {c}" for c in LI_MISSING) + \
    ", l_linestatus, l_shipdate FROM lineitem)"

LI_KT_SQL = sql_key_text(*LI_KEY)


def events_value_missing(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")
    return with_injected_missing(e, ["event_id"], ["value"])


SQL_EVENTS_MISSING = ("ev AS (SELECT event_id, ts, user_id, event_type, "
                      f"{sql_injected_missing('value', ['event_id'])} AS value FROM events)")

# Drift reference / current split of events (FIXTURES part 2).
SPLIT_TS = "2024-01-16 00:00:00"


def events_halves(spark, sf_dir, missing: bool = False):
    e = events_value_missing(spark, sf_dir) if missing else \
        Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")
    half = F.when(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"), F.lit("reference")).otherwise(F.lit("current"))
    return e.withColumn("half", half)


SQL_HALF = f"CASE WHEN ts < TIMESTAMP '{SPLIT_TS}' THEN 'reference' ELSE 'current' END"


def events_features(spark, sf_dir):
    """events halves with two numeric features: ``value`` (15% injected
    NULLs) and ``k`` parsed from the JSON text ``props`` (P1/P3 coercion)."""
    e = Tables(spark, sf_dir).events
    e = with_injected_missing(e, ["event_id"], ["value"])
    k = F.regexp_extract(F.col("props"), r'"k": (\d+)', 1)
    e = e.withColumn("k", F.when(k.isin("", "nan", "NA"), None).otherwise(k).try_cast("double"))
    half = F.when(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"), F.lit("reference")).otherwise(F.lit("current"))
    return e.select("event_id", "ts", "user_id", "event_type", "value", "k", half.alias("half"))


SQL_EVENTS_FEATURES = (
    "e AS (SELECT event_id, ts, user_id, event_type, "
    f"{sql_injected_missing('value', ['event_id'])} AS value, "
    "TRY_CAST(CASE WHEN regexp_extract(props, '\"k\": (\\d+)', 1) IN ('', 'nan', 'NA') THEN NULL "
    "ELSE regexp_extract(props, '\"k\": (\\d+)', 1) END AS DOUBLE) AS k, "
    f"CASE WHEN ts < TIMESTAMP '{SPLIT_TS}' THEN 'reference' ELSE 'current' END AS half FROM events),\n"
    "lv AS (SELECT event_id, ts, half, 'value' AS feature, value AS x FROM e "
    "UNION ALL SELECT event_id, ts, half, 'k', k FROM e)")



def coords(key: str):
    """Points on a map by a fixed formula of an integer key."""
    lat = F.lit(-60.0) + ((F.col(key) * 7919) % 12001) / F.lit(100.0)
    lon = F.lit(-180.0) + ((F.col(key) * 104729) % 36001) / F.lit(100.0)
    return lat, lon


def sql_coords(key: str) -> tuple[str, str]:
    return (f"(-60.0e0 + (({key} * 7919) % 12001) / 100.0e0)", f"(-180.0e0 + (({key} * 104729) % 36001) / 100.0e0)")
