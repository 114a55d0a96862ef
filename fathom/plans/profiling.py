"""Profiling and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.hashing import sql_h32
from fathom.functions.numeric import rnd, sql_exact_mean, sql_rnd
from fathom.operators import profile
from fathom.plans.common import LI_MISSING, LI_NUM, SQL_LI_MISSING, lineitem_missing
from fathom.plans.registry import query
from fathom.sources.tables import Tables


def _union_sql(template: str, cols) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


_MISS_TYPES = {"l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
               "l_returnflag": "string"}


@query("missingness_report", ["Q1", "Q2", "Q3"], sql=f"""
WITH {SQL_LI_MISSING}
""" + _union_sql("""SELECT '{c}' AS column_name, '%s' AS dtype, count(*) - count({c}) AS n_missing,
  (round((1.0e0 - count({c}) / count(*)) * 1e6) / 1e6) AS missing_rate, count(DISTINCT {c}) AS n_distinct FROM li""",
                 LI_MISSING).replace("'%s'", "__DT__") + "\nORDER BY missing_rate DESC, column_name")
def missingness_report(spark, sf_dir):
    li = lineitem_missing(spark, sf_dir).select(*LI_MISSING)
    r = profile.missingness_report(li, LI_MISSING)
    return r.withColumn("missing_rate", rnd("missing_rate", 6)).orderBy(F.desc("missing_rate"), "column_name")


def _fix_missing_sql():
    from fathom.plans.registry import ORACLES
    sql = ORACLES["missingness_report"]
    parts = sql.split("UNION ALL")
    out = []
    for p, c in zip(parts, LI_MISSING):
        out.append(p.replace("__DT__", f"'{_MISS_TYPES[c]}'"))
    ORACLES["missingness_report"] = "UNION ALL".join(out)


_fix_missing_sql()


@query("numeric_summary", ["Q4"], sql=f"""
WITH {SQL_LI_MISSING}
""" + _union_sql(f"""SELECT '{{c}}' AS column_name, count({{c}}) AS count, {sql_rnd(sql_exact_mean('{c}'), 6)} AS mean,
  {sql_rnd('stddev_samp({c})', 6)} AS std, {sql_rnd('min({c})', 6)} AS min,
  {sql_rnd('quantile_cont({c}, 0.25)', 6)} AS q25, {sql_rnd('quantile_cont({c}, 0.5)', 6)} AS q50,
  {sql_rnd('quantile_cont({c}, 0.75)', 6)} AS q75, {sql_rnd('max({c})', 6)} AS max FROM li""", LI_NUM))
def numeric_summary(spark, sf_dir):
    li = lineitem_missing(spark, sf_dir)
    r = profile.numeric_summary(li, LI_NUM)
    return r.select("column_name", "count", *[rnd(c, 6).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


PART_CATS = ["p_brand", "p_type", "p_name"]


@query("categorical_summary", ["Q5", "A12"], sql="""
WITH p AS (""" + _union_sql("SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM part", PART_CATS) + """),
c AS (SELECT column_name, value, count(*) AS cnt FROM p WHERE value IS NOT NULL GROUP BY ALL)
SELECT column_name, count(*) AS n_distinct, arg_min(value, (-cnt, value)) AS top, max(cnt) AS top_count
FROM c GROUP BY column_name
""")
def categorical_summary(spark, sf_dir):
    return profile.categorical_summary(Tables(spark, sf_dir).part, PART_CATS)


@query("category_counts", ["Q7", "Q8"], sql="""
WITH p AS (SELECT 'p_type' AS column_name, p_type AS value FROM part
           UNION ALL SELECT 'p_brand', p_brand FROM part
           UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR) FROM labels),
c AS (SELECT column_name, value, count(*) AS count FROM p WHERE value IS NOT NULL GROUP BY ALL)
SELECT column_name, value, count, round(count / sum(count) OVER (PARTITION BY column_name) * 1e6) / 1e6 AS share FROM c
""")
def category_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    parts = profile.value_counts(t.part, ["p_type", "p_brand"])
    lab = profile.value_counts(t.labels, ["toxic"])
    return parts.unionByName(lab).withColumn("share", rnd("share", 6))


QUANT_N = 100


def _sql_probs(n):
    return "[" + ", ".join(f"{p!r}e0" if "e" not in repr(p) else repr(p) for p in profile.linspace(n)) + "]"


@query("training_profile", ["Q6"], sql="""
WITH q AS (""" + _union_sql(f"""SELECT '{{c}}' AS column_name, count({{c}}) AS n, avg({{c}}) AS mean, stddev_pop({{c}}) AS std,
  min({{c}}) AS min, max({{c}}) AS max, quantile_cont({{c}}, {_sql_probs(QUANT_N)}) AS quantiles FROM lineitem""", LI_NUM) + f""")
SELECT column_name, n, {sql_rnd('mean', 8)} AS mean, {sql_rnd('std', 6)} AS std, {sql_rnd('min', 6)} AS min,
       {sql_rnd('max', 6)} AS max, CAST(u.i - 1 AS INTEGER) AS q_index, {sql_rnd('quantiles[u.i]', 6)} AS quantile
FROM q CROSS JOIN range(1, {QUANT_N + 1}) AS u(i)
""")
def training_profile(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    p = profile.training_profile(li, LI_NUM, QUANT_N)
    # 8 decimals for the means: a mean of 2-decimal values can sit on a 6-decimal halfway point
    return p.select("column_name", "n", rnd("mean", 8).alias("mean"), *[rnd(c, 6).alias(c) for c in ["std", "min", "max"]],
                    F.posexplode("quantiles").alias("q_index", "quantile")) \
        .withColumn("quantile", rnd("quantile", 6))


@query("skew_kurtosis", ["Q9"], sql="""
SELECT column_name, skewness, kurtosis FROM (""" + _union_sql(f"""SELECT '{{c}}' AS column_name, {sql_rnd('skewness({c})', 6)} AS skewness,
  {sql_rnd('kurtosis({c})', 6)} AS kurtosis FROM lineitem""", LI_NUM) + ") ORDER BY abs(skewness) DESC")
def skew_kurtosis(spark, sf_dir):
    r = profile.skew_kurtosis(Tables(spark, sf_dir).lineitem, LI_NUM)
    return r.select("column_name", rnd("skewness", 6).alias("skewness"), rnd("kurtosis", 6).alias("kurtosis")) \
        .orderBy(F.desc(F.abs("skewness")))


@query("cap_share", ["Q10", "P7", "P8"], sql="""
SELECT o_orderstatus, count(*) AS n,
       round(avg(CASE WHEN o_totalprice >= 400000.0e0 THEN 1.0e0 ELSE 0.0e0 END) * 1e6) / 1e6 AS share_at_cap,
       count(*) FILTER (WHERE o_totalprice < 400000.0e0) AS n_below_cap
FROM orders WHERE TRY_CAST(o_totalprice AS DOUBLE) IS NOT NULL GROUP BY o_orderstatus
""")
def cap_share(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    o = o.where(F.col("o_totalprice").try_cast("double").isNotNull())  # P8
    cap = F.col("o_totalprice") >= 400000.0
    return o.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg(cap.cast("double")), 6).alias("share_at_cap"),
        F.count(F.when(~cap, 1)).alias("n_below_cap"))  # P7: rows kept below the cap


@query("iqr_outliers", ["P9", "P12"], sql="""
WITH f AS (""" + _union_sql("""SELECT '{c}' AS column_name, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem""", LI_NUM) + """),
g AS (SELECT *, q1 - 1.5e0 * (q3 - q1) AS lower, q3 + 1.5e0 * (q3 - q1) AS upper FROM f),
x AS (""" + _union_sql("""SELECT '{c}' AS column_name, {c} AS x FROM lineitem""", LI_NUM) + """)
SELECT g.column_name, round(q1 * 1e6) / 1e6 AS q1, round(q3 * 1e6) / 1e6 AS q3, round(lower * 1e6) / 1e6 AS lower,
       round(upper * 1e6) / 1e6 AS upper,
       CAST(sum(CASE WHEN x < lower OR x > upper THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
FROM x JOIN g USING (column_name) GROUP BY ALL
""")
def iqr_outliers(spark, sf_dir):
    r = profile.iqr_outliers(Tables(spark, sf_dir).lineitem, LI_NUM)
    return r.select("column_name", *[rnd(c, 6).alias(c) for c in ["q1", "q3", "lower", "upper"]], "n_outliers")


@query("zscore_filter", ["P11"], sql="""
WITH s AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in LI_NUM) + """ FROM lineitem),
z AS (SELECT l_returnflag, (""" + " OR ".join(
    f"coalesce(abs(({c} - m_{c}) / nullif(s_{c}, 0)) > 3.0e0, false)" for c in LI_NUM) + """) AS is_outlier
      FROM lineitem CROSS JOIN s)
SELECT l_returnflag, count(*) FILTER (WHERE NOT is_outlier) AS n_kept, count(*) FILTER (WHERE is_outlier) AS n_removed
FROM z GROUP BY l_returnflag
""")
def zscore_filter(spark, sf_dir):
    z = profile.zscore_flags(Tables(spark, sf_dir).lineitem, LI_NUM, 3.0)
    return z.groupBy("l_returnflag").agg(F.count(F.when(~F.col("is_outlier"), 1)).alias("n_kept"),
                                         F.count(F.when(F.col("is_outlier"), 1)).alias("n_removed"))


LEAK_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_returnflag", "price_per_unit", "l_extendedprice"]

LEAK_TERMS = ("price", "amount", "total")   # name parts of money columns in these tables


@query("leakage_audit", ["Q19"], sql="""
WITH b AS (SELECT l_quantity, l_discount, l_tax, l_linenumber, l_returnflag,
                  l_extendedprice / l_quantity AS price_per_unit, l_extendedprice FROM lineitem),
c AS (SELECT 'l_quantity' AS column_name, corr(l_quantity, l_extendedprice) AS r FROM b
      UNION ALL SELECT 'l_discount', corr(l_discount, l_extendedprice) FROM b
      UNION ALL SELECT 'l_tax', corr(l_tax, l_extendedprice) FROM b
      UNION ALL SELECT 'l_linenumber', corr(CAST(l_linenumber AS DOUBLE), l_extendedprice) FROM b
      UNION ALL SELECT 'l_returnflag', CAST(NULL AS DOUBLE) FROM b
      UNION ALL SELECT 'price_per_unit', corr(price_per_unit, l_extendedprice) FROM b)
SELECT DISTINCT column_name, round(r * 1e6) / 1e6 AS target_corr,
       regexp_matches(lower(column_name), 'price|amount|total') AS name_flag,
       coalesce(abs(r) > 0.9e0, false) AS corr_flag,
       regexp_matches(lower(column_name), 'price|amount|total')
         OR coalesce(abs(r) > 0.9e0, false) AS suspicious
FROM c
""")
def leakage_audit(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.withColumn("price_per_unit", F.col("l_extendedprice") / F.col("l_quantity"))
    r = profile.leakage_audit(li.select(*LEAK_COLS), "l_extendedprice", LEAK_TERMS)
    return r.withColumn("target_corr", rnd("target_corr", 6))


MISSING_RULES = [
    profile.MissingRule("structural", "own_level", columns=("l_returnflag",)),
    profile.MissingRule("sporadic", "typical_value", below=0.01),
    profile.MissingRule("by_segment", "segment_median", columns=("l_discount", "l_tax")),
    profile.MissingRule("unexplained", "model_based"),
]


@query("missing_taxonomy", ["Q20"], sql=f"""
WITH {SQL_LI_MISSING},
r AS (""" + _union_sql("SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing, 1.0e0 - count({c}) / count(*) AS missing_rate FROM li",
                       LI_MISSING) + """),
t(rule, reason, remedy, col, below) AS (VALUES (0, 'structural', 'own_level', 'l_returnflag', NULL),
  (1, 'sporadic', 'typical_value', NULL, 0.01e0), (2, 'by_segment', 'segment_median', 'l_discount', NULL),
  (2, 'by_segment', 'segment_median', 'l_tax', NULL), (3, 'unexplained', 'model_based', NULL, NULL))
SELECT column_name, round(missing_rate * 1e6) / 1e6 AS missing_rate, arg_min(reason, rule) AS reason, arg_min(remedy, rule) AS remedy
FROM r JOIN t ON (col IS NULL OR col = column_name) AND (below IS NULL OR missing_rate < below)
WHERE n_missing > 0 GROUP BY column_name, missing_rate
""")
def missing_taxonomy(spark, sf_dir):
    rep = profile.missingness_report(lineitem_missing(spark, sf_dir), LI_MISSING, distinct=False)
    return profile.missing_taxonomy(rep, MISSING_RULES).withColumn("missing_rate", rnd("missing_rate", 6))


FP_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("dataset_fingerprint", ["Q21", "Q22"], sql=f"""
WITH t AS (SELECT concat_ws('|', CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'),
                            CAST(o_orderkey AS VARCHAR), o_orderpriority, o_orderstatus,
                            CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)) AS txt,
                  CASE WHEN {sql_h32("CAST(o_orderkey AS VARCHAR) || 'split'").replace('::BIGINT)', '::BIGINT % 100)')} < 80 THEN 'train' ELSE 'test' END AS split
           FROM orders)
SELECT count(*) AS n_rows, 6 AS n_columns, bit_xor({sql_h32('txt')}) AS hash_xor,
       CAST(sum({sql_h32('txt')}) AS BIGINT) AS hash_sum,
       count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test
FROM t
""")
def dataset_fingerprint(spark, sf_dir):
    from fathom.operators import folds
    o = Tables(spark, sf_dir).orders.select(*FP_COLS)
    txt = profile.row_fingerprint_text(FP_COLS, {
        "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "o_totalprice": F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")})
    fp = profile.fingerprint(o, txt)
    sizes = folds.holdout(o, ["o_orderkey"]).agg(F.count(F.when(F.col("split") == "train", 1)).alias("n_train"),
                                                 F.count(F.when(F.col("split") == "test", 1)).alias("n_test"))
    return fp.crossJoin(sizes).select("n_rows", F.lit(len(FP_COLS)).alias("n_columns"), "hash_xor", "hash_sum",
                                      "n_train", "n_test")


@query("feature_registry", ["Q23"], sql="""
""" + _union_sql(f"""SELECT '{{c}}' AS feature, 'double' AS dtype, {sql_rnd(sql_exact_mean('{c}'), 6)} AS mean,
  {sql_rnd('stddev_samp({c})', 6)} AS std, {sql_rnd('min({c})', 6)} AS min, {sql_rnd('max({c})', 6)} AS max,
  'v1' AS version FROM lineitem""", LI_NUM))
def feature_registry(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    s = profile.numeric_summary(li, LI_NUM, exact_means=True)
    return s.select(F.col("column_name").alias("feature"), F.lit("double").alias("dtype"),
                    *[rnd(c, 6).alias(c) for c in ["mean", "std", "min", "max"]], F.lit("v1").alias("version"))


@query("sum_constraint_share", ["Q25"], sql=f"""
WITH {SQL_LI_MISSING}
SELECT count(*) AS n, round(avg(CASE WHEN coalesce(l_quantity, 0.0e0) + coalesce(l_discount * 1000.0e0, 0.0e0)
  + coalesce(l_tax * 1000.0e0, 0.0e0) BETWEEN 95.0e0 AND 105.0e0 THEN 1.0e0 ELSE 0.0e0 END) * 1e6) / 1e6 AS share_in_range
FROM li
""")
def sum_constraint_share(spark, sf_dir):
    li = lineitem_missing(spark, sf_dir).withColumn("d1000", F.col("l_discount") * 1000.0) \
        .withColumn("t1000", F.col("l_tax") * 1000.0)
    r = profile.sum_constraint_share(li, ["l_quantity", "d1000", "t1000"], 95.0, 105.0)
    return r.withColumn("share_in_range", rnd("share_in_range", 6))
