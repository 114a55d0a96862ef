"""Aggregation and join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import aggregates as A
from fathom.plans.common import LI_NUM
from fathom.plans.registry import query
from fathom.sources.tables import Tables


def _cust(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))


SQL_CUST = """cu AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query("grouped_reports", ["A1", "A2", "A3"], sql=f"""
WITH {SQL_CUST},
lg AS (SELECT 'c_mktsegment' AS group_column, c_mktsegment AS group_value, c_acctbal FROM cu
       UNION ALL SELECT 'n_name', n_name, c_acctbal FROM cu
       UNION ALL SELECT 'r_name', r_name, c_acctbal FROM cu)
SELECT group_column, group_value, count(*) AS n, {sql_rnd('avg(c_acctbal)', 6)} AS mean,
       {sql_rnd('median(c_acctbal)', 6)} AS median, {sql_rnd('stddev_samp(c_acctbal)', 6)} AS std
FROM lg WHERE group_value IS NOT NULL GROUP BY ALL
""")
def grouped_reports(spark, sf_dir):
    r = A.grouped_report(_cust(spark, sf_dir), "c_acctbal", ["c_mktsegment", "n_name", "r_name"])
    return r.select("group_column", "group_value", "n", *[rnd(c, 6).alias(c) for c in ["mean", "median", "std"]])


# Fixed tier edges and labels for account balances (right-closed).
TIER_EDGES = [-1000.0, 0.0, 2500.0, 5000.0, 7500.0, 10000.0, 20000.0]
TIER_LABELS = ["negative", "low", "mid", "high", "top", "beyond"]


@query("tier_means_with_empty", ["A4", "X11"], sql="""
WITH t AS (SELECT CASE """ + " ".join(
    f"WHEN c_acctbal > {TIER_EDGES[i]!r}e0 AND c_acctbal <= {TIER_EDGES[i + 1]!r}e0 THEN '{TIER_LABELS[i]}'"
    for i in range(len(TIER_LABELS))) + """ END AS tier, c_acctbal FROM customer),
d AS (SELECT * FROM (VALUES """ + ", ".join(f"('{lab}')" for lab in TIER_LABELS) + """) AS v(tier)),
g AS (SELECT tier, count(*) AS n, avg(c_acctbal) AS mean FROM t WHERE tier IS NOT NULL GROUP BY tier)
SELECT d.tier, coalesce(g.n, 0) AS n, """ + sql_rnd("g.mean", 6) + """ AS mean FROM d LEFT JOIN g USING (tier)
""")
def tier_means_with_empty(spark, sf_dir):
    from fathom.operators.features import fixed_bins
    c = Tables(spark, sf_dir).customer.withColumn("tier", fixed_bins("c_acctbal", TIER_EDGES, TIER_LABELS))
    rep = c.where(F.col("tier").isNotNull()).groupBy("tier").agg(F.count(F.lit(1)).alias("n"),
                                                                 F.avg("c_acctbal").alias("mean"))
    dom = spark.createDataFrame([(lab,) for lab in TIER_LABELS], "tier string")  # the fixed domain of levels
    return A.with_domain(rep, dom, "tier").select("tier", "n", rnd("mean", 6).alias("mean"))


@query("corr_matrix", ["A5"], sql="\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {sql_rnd(f'corr({a}, {b})', 8)} AS r FROM lineitem"
    for i, a in enumerate(LI_NUM) for b in LI_NUM[i + 1:]))
def corr_matrix(spark, sf_dir):
    return A.corr_long(Tables(spark, sf_dir).lineitem, LI_NUM).withColumn("r", rnd("r", 8))


@query("corr_with_target", ["A6", "A11"], sql="""
SELECT feature, r FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {sql_rnd(f'corr(CAST({c} AS DOUBLE), o_totalprice)', 8)} AS r FROM orders"
    for c in ["o_orderkey", "o_custkey"]) + ") ORDER BY abs(r) DESC")
def corr_with_target(spark, sf_dir):
    r = A.corr_with_target(Tables(spark, sf_dir).orders, ["o_orderkey", "o_custkey"], "o_totalprice")
    return r.withColumn("r", rnd("r", 8))


VIF_COLS = ["l_quantity", "l_discount", "l_tax"]


def _vif_sql():
    r = {("l_quantity", "l_discount"): "r12", ("l_quantity", "l_tax"): "r13", ("l_discount", "l_tax"): "r23"}
    sel = ", ".join(f"corr({a}, {b}) AS {n}" for (a, b), n in r.items())
    forms = {"l_quantity": "(r12*r12 + r13*r13 - 2*r12*r13*r23) / (1 - r23*r23)",
             "l_discount": "(r12*r12 + r23*r23 - 2*r12*r13*r23) / (1 - r13*r13)",
             "l_tax": "(r13*r13 + r23*r23 - 2*r12*r13*r23) / (1 - r12*r12)"}
    parts = [f"SELECT '{c}' AS feature, {f} AS r2 FROM c" for c, f in forms.items()]
    return (f"WITH c AS (SELECT {sel} FROM lineitem), v AS ({' UNION ALL '.join(parts)})\n"
            f"SELECT feature, {sql_rnd('r2', 8)} AS r2, {sql_rnd('CASE WHEN r2 >= 0.999e0 THEN 9999.0e0 ELSE 1 / (1 - r2) END', 8)} AS vif,"
            " CASE WHEN r2 >= 0.999e0 THEN 9999.0e0 ELSE 1 / (1 - r2) END > 10.0e0 AS alert FROM v")


@query("vif", ["A7"], sql=_vif_sql())
def vif(spark, sf_dir):
    v = A.vif(Tables(spark, sf_dir).lineitem, VIF_COLS)
    return v.select("feature", rnd("r2", 8).alias("r2"), rnd("vif", 8).alias("vif"), "alert")


LAT_EDGES = [0.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0]


@query("value_histogram", ["A9", "T4", "J13"], sql="""
WITH b AS (SELECT CASE """ + " ".join(
    f"WHEN value >= {LAT_EDGES[i]!r}e0 AND value {'<=' if i == len(LAT_EDGES) - 2 else '<'} {LAT_EDGES[i + 1]!r}e0 THEN {i}"
    for i in range(len(LAT_EDGES) - 1)) + """ END AS bin FROM events),
d AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, {LAT_EDGES[i]!r}e0, {LAT_EDGES[i + 1]!r}e0)"
                                           for i in range(len(LAT_EDGES) - 1)) + """) AS v(bin, lower, upper)),
c AS (SELECT bin, count(*) AS count FROM b WHERE bin IS NOT NULL GROUP BY bin)
SELECT d.bin, d.lower, d.upper, coalesce(c.count, 0) AS count,
       CAST(sum(coalesce(c.count, 0)) OVER (ORDER BY d.bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative
FROM d LEFT JOIN c USING (bin)
""")
def value_histogram(spark, sf_dir):
    return A.fixed_edge_histogram(Tables(spark, sf_dir).events, "value", LAT_EDGES)


@query("pivot_hour_weekday", ["A13"], sql="""
WITH e AS (SELECT hour(ts) AS hour, isodow(ts) - 1 AS wd, value FROM events)
SELECT hour, """ + ", ".join(f"{sql_rnd(f'coalesce(avg(value) FILTER (WHERE wd = {d}), 0.0e0)', 6)} AS \"{d}\""
                             for d in range(7)) + """ FROM e GROUP BY hour
""")
def pivot_hour_weekday(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select(F.hour("ts").alias("hour"), F.weekday("ts").alias("wd"), "value")
    p = A.pivot_mean(e, "hour", "wd", list(range(7)), "value", 0.0)
    return p.select("hour", *[rnd(F.col(str(d)), 6).alias(str(d)) for d in range(7)])


@query("long_report", ["A14", "A12"], sql=f"""
SELECT hour(ts) AS hour, event_type, count(*) AS n, {sql_rnd('avg(value)', 6)} AS mean_value
FROM events GROUP BY ALL
""")
def long_report(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.groupBy(F.hour("ts").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n"),
                                                                    rnd(F.avg("value"), 6).alias("mean_value"))


@query("membership_joins", ["J1", "J2", "J3", "J10"], sql="""
WITH early AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01 00:00:00')
SELECT 'seen' AS membership, count(*) AS n_parts, CAST(sum(p_partkey) AS BIGINT) AS key_sum
FROM part WHERE p_partkey IN (SELECT l_partkey FROM early)
UNION ALL
SELECT 'unseen', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM early)
""")
def membership_joins(spark, sf_dir):
    t = Tables(spark, sf_dir)
    early = t.lineitem.where(F.col("l_shipdate") < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")) \
        .select(F.col("l_partkey").alias("p_partkey")).distinct()
    p = t.part.select("p_partkey")
    seen = p.join(early, "p_partkey", "left_semi").agg(F.lit("seen").alias("membership"),
                                                       F.count(F.lit(1)).alias("n_parts"), F.sum("p_partkey").alias("key_sum"))
    unseen = p.join(early, "p_partkey", "left_anti").agg(F.lit("unseen").alias("membership"),
                                                         F.count(F.lit(1)).alias("n_parts"), F.sum("p_partkey").alias("key_sum"))
    return seen.unionByName(unseen)


@query("stacked_reports", ["J11", "J14"], sql=f"""
SELECT 'early' AS source, o_orderstatus, count(*) AS n, {sql_rnd('avg(o_totalprice)', 6)} AS mean_price
FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00' GROUP BY o_orderstatus
UNION ALL
SELECT 'late', o_orderstatus, count(*), {sql_rnd('avg(o_totalprice)', 6)}
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' GROUP BY o_orderstatus
""")
def stacked_reports(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")

    def rep(df, name):
        return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                               rnd(F.avg("o_totalprice"), 6).alias("mean_price")) \
            .select(F.lit(name).alias("source"), "*")
    return rep(o.where(F.col("o_orderdate") < cut), "early").unionByName(rep(o.where(F.col("o_orderdate") >= cut), "late"))
