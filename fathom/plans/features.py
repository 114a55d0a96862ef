"""Row-wise feature queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from fathom.functions.hashing import key_text, salted_h32, sql_key_text, sql_salted_h32
from fathom.functions.numeric import rnd, safe_div, sql_rnd
from fathom.operators import features as X
from fathom.plans.common import LI_KEY, SQL_LI_MISSING, coords, lineitem_missing, sql_coords
from fathom.plans.registry import query
from fathom.sources.tables import Tables

# Fixed values of the stand-in feature rules.
NAME_SYNONYMS = {"hot": "warm", "cold": "cool", "new": "fresh", "old": "aged"}
TYPE_ORDINAL = {"ECONOMY": "1", "STANDARD": "2", "MEDIUM": "3", "LARGE": "4", "PROMO": "5"}
SIZE_EDGES = [0.0, 10.0, 20.0, 35.0, 50.0]
SIZE_LABELS = ["xs", "s", "m", "l"]


@query("text_features", ["X1", "X2", "X3", "X4", "X5", "X21", "X22"], sql="""
SELECT p_partkey,
       CASE WHEN regexp_extract(p_name, '^(\\w+) ', 1) = '' THEN 'none' ELSE regexp_extract(p_name, '^(\\w+) ', 1) END AS adjective,
       coalesce(CASE regexp_extract(p_name, '^(\\w+) ', 1) WHEN 'hot' THEN 'warm' WHEN 'cold' THEN 'cool'
                WHEN 'new' THEN 'fresh' WHEN 'old' THEN 'aged' END,
                CASE WHEN regexp_extract(p_name, '^(\\w+) ', 1) = '' THEN 'none' ELSE regexp_extract(p_name, '^(\\w+) ', 1) END) AS adjective_group,
       CASE WHEN p_brand IS NULL THEN 'MISSING'
            WHEN regexp_replace(upper(trim(regexp_replace(regexp_replace(p_brand, '[./]', '', 'g'), '[0-9]', '', 'g'))), '\\s+', '_', 'g') = '' THEN 'NONE'
            ELSE regexp_replace(upper(trim(regexp_replace(regexp_replace(p_brand, '[./]', '', 'g'), '[0-9]', '', 'g'))), '\\s+', '_', 'g') END AS brand_prefix,
       CASE WHEN p_type IS NULL OR length(p_type) = 0 THEN 'U' ELSE substr(p_type, 1, 1) END AS type_initial,
       CAST(len(list_filter(regexp_split_to_array(trim(p_name), '\\s+'), lambda t: t <> '')) AS INTEGER) AS n_tokens,
       CAST(coalesce(CASE p_type WHEN 'ECONOMY' THEN '1' WHEN 'STANDARD' THEN '2' WHEN 'MEDIUM' THEN '3'
                     WHEN 'LARGE' THEN '4' WHEN 'PROMO' THEN '5' END, '0') AS INTEGER) AS type_rank,
       coalesce(CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_type END, 'None') AS type_filled
FROM part
""")
def text_features(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    adj = X.regex_extract_default("p_name", r"^(\w+) ", "none")
    return p.select(
        "p_partkey", adj.alias("adjective"), X.value_map(adj, NAME_SYNONYMS).alias("adjective_group"),
        X.prefix_clean("p_brand").alias("brand_prefix"), X.first_char("p_type").alias("type_initial"),
        X.token_count("p_name").alias("n_tokens"),
        F.coalesce(X.value_map("p_type", TYPE_ORDINAL, keep_unmapped=False), F.lit("0")).cast("int").alias("type_rank"),
        F.coalesce(F.when(F.col("p_type") == "SMALL", None).otherwise(F.col("p_type")), F.lit("None")).alias("type_filled"),
    )


@query("numeric_features", ["X6", "X7", "X8", "X9", "X10", "X11", "X23", "X24"], sql=f"""
WITH {SQL_LI_MISSING}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(l_discount IS NOT NULL AS INTEGER) AS has_discount,
       {sql_rnd('coalesce(l_discount, 0.0e0) + coalesce(l_tax, 0.0e0)', 6)} AS rate_sum,
       CAST(coalesce(l_quantity, 0.0e0) = 1.0e0 AS INTEGER) AS is_single,
       {sql_rnd('l_extendedprice / nullif(l_quantity, 0.0e0)', 6)} AS unit_price,
       {sql_rnd('ln(1 + greatest(coalesce(l_extendedprice, 0.0e0), 0.0e0))', 6)} AS log_price,
       {sql_rnd('l_quantity * l_discount', 6)} AS qty_x_disc,
       {sql_rnd('l_quantity * l_quantity', 6)} AS qty_sq,
       {sql_rnd('l_quantity * l_discount * l_tax', 8)} AS qty_disc_tax,
       {sql_rnd('l_extendedprice / greatest(l_quantity, 1.0e0)', 6)} AS price_per_qty_floor,
       CAST(l_quantity > 25.0e0 AND l_discount >= 0.05e0 AS DOUBLE) AS bulk_discounted,
       CASE WHEN l_quantity > 0.0e0 AND l_quantity <= 10.0e0 THEN 'xs' WHEN l_quantity > 10.0e0 AND l_quantity <= 20.0e0 THEN 's'
            WHEN l_quantity > 20.0e0 AND l_quantity <= 35.0e0 THEN 'm' WHEN l_quantity > 35.0e0 AND l_quantity <= 50.0e0 THEN 'l' END AS qty_band,
       CASE WHEN l_quantity >= 0.0e0 AND l_quantity < 10.0e0 THEN 0 WHEN l_quantity >= 10.0e0 AND l_quantity < 20.0e0 THEN 1
            WHEN l_quantity >= 20.0e0 AND l_quantity < 35.0e0 THEN 2 WHEN l_quantity >= 35.0e0 AND l_quantity < 50.0e0 THEN 3 END AS qty_bin_left,
       {sql_rnd('greatest(exp(ln(1 + l_extendedprice)) - 1, 0.0e0)', 4)} AS price_roundtrip
FROM li
""")
def numeric_features(spark, sf_dir):
    li = lineitem_missing(spark, sf_dir)
    q, d, t, p = (F.col(c) for c in ["l_quantity", "l_discount", "l_tax", "l_extendedprice"])
    return li.select(
        *LI_KEY, X.present("l_discount").alias("has_discount"),
        rnd(F.coalesce(d, F.lit(0.0)) + F.coalesce(t, F.lit(0.0)), 6).alias("rate_sum"),
        (F.coalesce(q, F.lit(0.0)) == 1.0).cast("int").alias("is_single"),
        rnd(safe_div(p, q), 6).alias("unit_price"),
        rnd(F.log1p(F.greatest(F.coalesce(p, F.lit(0.0)), F.lit(0.0))), 6).alias("log_price"),
        rnd(q * d, 6).alias("qty_x_disc"), rnd(q * q, 6).alias("qty_sq"), rnd(q * d * t, 8).alias("qty_disc_tax"),
        rnd(p / F.greatest(q, F.lit(1.0)), 6).alias("price_per_qty_floor"),
        ((q > 25.0) & (d >= 0.05)).cast("double").alias("bulk_discounted"),
        X.fixed_bins(q, SIZE_EDGES, SIZE_LABELS).alias("qty_band"),
        X.fixed_bins(q, SIZE_EDGES, right=False).alias("qty_bin_left"),
        rnd(X.expm1_clip(X.log1p_target(p)), 4).alias("price_roundtrip"),
    )


@query("equal_width_bins", ["X12", "A9"], sql="""
WITH r AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part),
b AS (SELECT CASE WHEN hi = lo THEN 0 ELSE
        least(greatest(CAST(ceil((p_retailprice - lo) / ((hi - lo) / 5.0e0)) AS INTEGER) - 1, 0), 4) END AS bin
      FROM part CROSS JOIN r)
SELECT bin, count(*) AS n FROM b GROUP BY bin
""")
def equal_width_bins(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    r = p.agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))
    j = p.crossJoin(F.broadcast(r))  # one row
    return j.select(X.equal_width_bins("p_retailprice", F.col("lo"), F.col("hi"), 5).alias("bin")) \
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


TWO_PI = 2 * math.pi


@query("calendar_features", ["X13", "X14", "X15", "X16"], sql=f"""
WITH t0 AS (SELECT min(ts) AS t0 FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00')
SELECT event_id, hour(ts) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, month(ts) AS month,
       quarter(ts) AS quarter, year(ts) - 2024 AS year_offset, dayofyear(ts) AS day_of_year,
       {sql_rnd('(epoch_us(ts) - epoch_us(t0)) / 86400000000.0e0', 6)} AS days_since_start,
       {sql_rnd(f'sin(hour(ts) * {TWO_PI / 24!r})', 6)} AS hour_sin, {sql_rnd(f'cos(hour(ts) * {TWO_PI / 24!r})', 6)} AS hour_cos,
       {sql_rnd(f'sin((isodow(ts) - 1) * {TWO_PI / 7!r})', 6)} AS weekday_sin,
       CAST((hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 16 AND 19) AND isodow(ts) <= 5 AS INTEGER) AS rush_hour,
       CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend,
       CAST(event_type = 'purchase' AND hour(ts) >= 22 AS INTEGER) AS late_purchase
FROM events CROSS JOIN t0
""")
def calendar_features(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    t0 = e.where(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")).agg(F.min("ts").alias("t0"))
    j = e.crossJoin(F.broadcast(t0))  # one row of training state
    parts = X.calendar_parts("ts")
    hs, hc = X.cyclic(parts["hour"], 24)
    ws, _ = X.cyclic(parts["weekday"], 7)
    rush = ((parts["hour"].between(7, 9) | parts["hour"].between(16, 19)) & (parts["weekday"] <= 4)).cast("int")
    cols = set(e.columns)
    late = ((F.col("event_type") == "purchase") & (parts["hour"] >= 22)).cast("int") if "event_type" in cols \
        else F.lit(0)  # X16: absent input gives zeros
    return j.select("event_id", parts["hour"].alias("hour"), parts["weekday"].alias("weekday"),
                    parts["month"].alias("month"), parts["quarter"].alias("quarter"),
                    (parts["year"] - 2024).alias("year_offset"), parts["day_of_year"].alias("day_of_year"),
                    rnd(X.days_since("ts", F.col("t0")), 6).alias("days_since_start"),
                    rnd(hs, 6).alias("hour_sin"), rnd(hc, 6).alias("hour_cos"), rnd(ws, 6).alias("weekday_sin"),
                    rush.alias("rush_hour"), (parts["weekday"] >= 5).cast("int").alias("is_weekend"),
                    late.alias("late_purchase"))


# Fixed reference points for the geo features (name, lat, lon).
HUBS = [("north_hub", 45.0, 10.0), ("south_hub", -20.0, -50.0), ("east_hub", 30.0, 120.0)]
TROPICS = (-23.5, 23.5, -180.0, 180.0)


def _sql_hav(lat, lon, hlat, hlon):
    return (f"(2 * 6371.0e0 * asin(sqrt(power(sin(radians({hlat!r}e0 - {lat}) / 2), 2) + "
            f"cos(radians({lat})) * cos(radians({hlat!r}e0)) * power(sin(radians({hlon!r}e0 - {lon}) / 2), 2))))")


LAT_C, LON_C = sql_coords("c_custkey")


@query("geo_features", ["X17", "X18", "X19", "X20"], sql="""
WITH c AS (SELECT c_custkey, """ + LAT_C + " AS lat, " + LON_C + """ AS lon FROM customer)
SELECT c_custkey, """ + ", ".join(
    f"{sql_rnd(_sql_hav('lat', 'lon', a, o), 6)} AS dist_{n}, {sql_rnd('exp(-' + _sql_hav('lat', 'lon', a, o) + ' / 50.0e0)', 9)} AS rbf_{n}"
    for n, a, o in HUBS) + """,
       CAST(lat BETWEEN -23.5e0 AND 23.5e0 AND lon BETWEEN -180.0e0 AND 180.0e0 AS INTEGER) AS in_tropics,
       CAST(floor(lat / 15.0e0) AS INTEGER) AS lat_band,
       """ + sql_rnd("abs(lon + 120.0e0)", 6) + " AS coast_proxy, " + sql_rnd("lat * lon", 6) + """ AS lat_x_lon
FROM c
""")
def geo_features(spark, sf_dir):
    lat, lon = coords("c_custkey")
    c = Tables(spark, sf_dir).customer.select("c_custkey", lat.alias("lat"), lon.alias("lon"))
    cols = []
    for n, a, o in HUBS:
        d = X.haversine_km("lat", "lon", F.lit(a), F.lit(o))
        cols += [rnd(d, 6).alias(f"dist_{n}"), rnd(X.rbf(d, 50.0), 9).alias(f"rbf_{n}")]
    return c.select("c_custkey", *cols, X.in_box("lat", "lon", TROPICS).alias("in_tropics"),
                    F.floor(F.col("lat") / 15.0).cast("int").alias("lat_band"),
                    rnd(F.abs(F.col("lon") + 120.0), 6).alias("coast_proxy"), rnd(F.col("lat") * F.col("lon"), 6).alias("lat_x_lon"))


NOISE_LEVELS = (0.0, 0.05, 0.1, 0.2, 0.5)   # in standard deviations of the input
_LI_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _sql_unit(salt: str) -> str:
    return f"(({sql_salted_h32(sql_key_text(*_LI_KEY), salt)} + 0.5e0) / 4294967296.0e0)"


@query("noise_robustness", ["X25", "E40"], sql=f"""
WITH s AS (SELECT stddev_pop(l_quantity) AS sd, regr_slope(l_extendedprice, l_quantity) AS b,
                  regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
z AS (SELECT l_quantity, l_extendedprice,
             sqrt(-2.0e0 * ln({_sql_unit('noise_r')})) * cos(2.0e0 * pi() * {_sql_unit('noise_a')}) AS z FROM lineitem)
SELECT level, {sql_rnd('sqrt(avg(power(l_extendedprice - (a + b * (l_quantity + level * sd * z)), 2)))', 2)} AS rmse
FROM z CROSS JOIN s CROSS JOIN (SELECT unnest([{', '.join(f'{x}e0' for x in NOISE_LEVELS)}]) AS level) GROUP BY level
""")
def noise_robustness(spark, sf_dir):
    """RMSE of the price line over quantity as Gaussian noise is added to its
    input.  The noise is a hash normal (Box-Muller on two salted row hashes),
    so it does not depend on partitioning."""
    li = Tables(spark, sf_dir).lineitem
    s = li.agg(F.stddev_pop("l_quantity").alias("sd"), F.regr_slope("l_extendedprice", "l_quantity").alias("b"),
               F.regr_intercept("l_extendedprice", "l_quantity").alias("a"))
    unit = lambda salt: (salted_h32(key_text(*_LI_KEY), salt) + 0.5) / 4294967296.0
    z = F.sqrt(-2.0 * F.log(unit("noise_r"))) * F.cos(2.0 * F.pi() * unit("noise_a"))
    rows = li.select("l_quantity", "l_extendedprice", z.alias("z"),
                     F.explode(F.array(*[F.lit(x) for x in NOISE_LEVELS])).alias("level")).crossJoin(F.broadcast(s))
    err = F.col("l_extendedprice") - (F.col("a") + F.col("b") * (F.col("l_quantity") + F.col("level") * F.col("sd") * F.col("z")))
    return rows.groupBy("level").agg(rnd(F.sqrt(F.avg(F.pow(err, 2))), 2).alias("rmse"))
