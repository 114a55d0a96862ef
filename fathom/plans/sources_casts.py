"""Source, sink and cast queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from fathom.functions.hashing import sql_bucket, sql_key_text
from fathom.functions.numeric import clean_double, rnd, sql_rnd
from fathom.plans.registry import query
from fathom.session import ensure_checkpoint_dir
from fathom.sources import tables as src
from fathom.sources.tables import Tables

SENTINELS = ["nan", "NA", ""]
TARGET_CANDIDATES = ["target", "label", "o_totalprice", "price"]


def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:8]}")


def infer_target(columns, candidates=TARGET_CANDIDATES, numeric=()):
    """First candidate name present, else the last numeric column."""
    for c in candidates:
        if c in columns:
            return c
    return list(numeric)[-1] if numeric else None


@query("coerce_casts", ["P1", "P3", "P4", "P5", "P6", "P10", "P13"], sql=f"""
WITH e AS (
  SELECT TRY_CAST(CASE WHEN regexp_extract(props, '"k": (\\d+)', 1) IN ('nan', 'NA', '') THEN NULL
                       ELSE regexp_extract(props, '"k": (\\d+)', 1) END AS DOUBLE) AS k,
         try_strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ts_parsed,
         try_strptime(event_type, '%Y-%m-%d %H:%M:%S') AS type_parsed,
         CASE WHEN isinf(value * 1e308 * 10.0e0) OR isnan(value * 1e308 * 10.0e0) THEN NULL ELSE value * 1e308 * 10.0e0 END AS blown,
         value, event_type FROM events)
SELECT count(*) AS n, count(k) AS n_k_parsed, {sql_rnd('sum(k)', 4)} AS k_sum, count(ts_parsed) AS n_ts_parsed,
       count(type_parsed) AS n_type_parsed, count(*) - count(blown) AS n_inf_to_null,
       count(*) FILTER (WHERE NOT (value > 400.0e0 AND event_type = 'click')) AS n_after_domain_rule,
       'o_totalprice' AS inferred_target, 5 AS n_columns_kept
FROM e
""")
def coerce_casts(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    raw = F.regexp_extract("props", r'"k": (\d+)', 1)
    k = F.when(raw.isin(*SENTINELS), None).otherwise(raw).try_cast("double")           # P3 + P1
    txt = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    ts_parsed = F.try_to_timestamp(txt, F.lit("yyyy-MM-dd HH:mm:ss"))                # P4
    type_parsed = F.try_to_timestamp(F.col("event_type"), F.lit("yyyy-MM-dd HH:mm:ss"))
    blown = clean_double(F.col("value") * F.lit(1e308) * F.lit(10.0))                  # P5
    kept = e.drop("props", "no_such_column")                                           # P6 ignores absent names
    target = infer_target(Tables(spark, sf_dir).orders.columns)                        # P13
    d = e.select(k.alias("k"), ts_parsed.alias("tp"), type_parsed.alias("yp"), blown.alias("b"), "value", "event_type")
    rule = ~((F.col("value") > 400.0) & (F.col("event_type") == "click"))              # P10
    return d.agg(F.count(F.lit(1)).alias("n"), F.count("k").alias("n_k_parsed"), rnd(F.sum("k"), 4).alias("k_sum"),
                 F.count("tp").alias("n_ts_parsed"), F.count("yp").alias("n_type_parsed"),
                 (F.count(F.lit(1)) - F.count("b")).alias("n_inf_to_null"),
                 F.count(F.when(F.coalesce(rule, F.lit(True)), 1)).alias("n_after_domain_rule"),
                 F.lit(target).alias("inferred_target"), F.lit(len(kept.columns)).alias("n_columns_kept"))


@query("adaptive_cast", ["P2"], sql=f"""
WITH t AS (SELECT CAST(value AS VARCHAR) AS value_text, event_type,
                  regexp_extract(props, '"k": (\\d+)', 1) AS k_text,
                  CASE WHEN event_id % 4 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS user_text FROM events),
p AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n_nonnull, count(TRY_CAST({c} AS DOUBLE)) AS n_parsed FROM t"
    for c in ["value_text", "event_type", "k_text", "user_text"]) + f""")
SELECT column_name, n_nonnull, n_parsed, {sql_rnd('n_parsed / n_nonnull', 6)} AS share,
       n_parsed / n_nonnull > 0.8e0 AS to_numeric FROM p
""")
def adaptive_cast(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    t = e.select(F.col("value").cast("string").alias("value_text"), "event_type",
                 F.regexp_extract("props", r'"k": (\d+)', 1).alias("k_text"),
                 F.when(F.col("event_id") % 4 == 0, F.lit("n/a")).otherwise(F.col("user_id").cast("string")).alias("user_text"))
    cols = ["value_text", "event_type", "k_text", "user_text"]
    agg = t.agg(*[F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n_nonnull"),
                           F.count(F.col(c).try_cast("double")).alias("n_parsed")).alias(c) for c in cols])
    long = agg.select(F.explode(F.array(*cols)).alias("s")).select("s.*")
    share = F.col("n_parsed") / F.col("n_nonnull")
    return long.select("column_name", "n_nonnull", "n_parsed", rnd(share, 6).alias("share"), (share > 0.8).alias("to_numeric"))


@query("csv_roundtrip", ["S1", "S4", "S6"], sql=f"""
SELECT o_orderstatus, count(*) AS n, {sql_rnd('avg(o_totalprice)', 4)} AS mean_price FROM orders GROUP BY o_orderstatus
""")
def csv_roundtrip(spark, sf_dir):
    """Write a projection of orders as CSV (S4), read it back with an
    explicit schema (S1, no inference pass) as a later job would (S6)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = _scratch(spark, "orders_csv")
    src.write_table(o, path, fmt="csv")
    back = src.read_csv(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double")
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("o_totalprice"), 4).alias("mean_price"))


@query("candidate_scan", ["S2", "S3"], sql=f"""
SELECT count(*) AS n, {sql_rnd('avg(o_totalprice)', 4)} AS mean_charges FROM orders
""")
def candidate_scan(spark, sf_dir):
    """First readable candidate with alias renames and a 3-of-4 signature."""
    df = src.read_by_candidates(spark, [f"{sf_dir}/no_such_table.parquet", src.table_path(sf_dir, "orders")],
                                aliases={"o_totalprice": "charges"},
                                expected=["o_orderkey", "charges", "o_orderdate", "region"], min_match=3)
    return df.agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("charges"), 4).alias("mean_charges"))


@query("first_n_sample", ["S7"], sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 10
""")
def first_n_sample(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return src.first_n_sample(o, ["o_orderkey"], 10, label="o_totalprice")


@query("json_report_sink", ["S5"])
def json_report_sink(spark, sf_dir):
    """Drift report written as JSON lines (NaN/inf -> null) and read back."""
    from fathom.plans.drift import drift_report
    inf = F.lit(float("inf"))
    r = drift_report(spark, sf_dir).withColumn("blown", F.col("current_std") * inf) \
        .withColumn("undefined", inf - inf)  # inf and NaN on purpose: both must come back as null
    path = _scratch(spark, "drift_json")
    src.write_json_report(r, path)
    return spark.read.json(path)


RUNS = (("run-0", 10.0, "production"), ("run-1", 0.0, "staging"))


@query("experiment_log", ["Q24", "M22"], sql=f"""
WITH o AS (
  SELECT *, CASE WHEN {sql_bucket(sql_key_text('o_orderkey'), 'split')} < 80 THEN 'train' ELSE 'test' END AS split FROM orders),
g AS (SELECT avg(o_totalprice) AS gmean FROM o WHERE split = 'train'),
lv AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m FROM o WHERE split = 'train' GROUP BY 1),
r AS (SELECT * FROM (VALUES ('run-0', 10.0e0, 'production'), ('run-1', 0.0e0, 'staging')) AS t(run_id, smoothing, status)),
e AS (SELECT run_id, smoothing, status,
             o_totalprice - coalesce((n * m + smoothing * gmean) / (n + smoothing), gmean) AS err
      FROM r CROSS JOIN g CROSS JOIN (SELECT * FROM o LEFT JOIN lv USING (o_orderpriority)) AS j WHERE split = 'test')
SELECT run_id, 'group_mean_priority' AS model, 'smoothing=' || CAST(CAST(smoothing AS INTEGER) AS VARCHAR) AS params,
       {sql_rnd('sqrt(avg(err * err))', 4)} AS rmse, {sql_rnd('avg(abs(err))', 4)} AS mae, status
FROM e GROUP BY run_id, smoothing, status
""")
def experiment_log(spark, sf_dir):
    """Runs and model records appended to a registry table: every run is
    fitted and scored with its own parameters."""
    from fathom.plans.slice import scored_orders
    path = _scratch(spark, "runs")
    for run, smoothing, status in RUNS:
        so = scored_orders(spark, sf_dir, smoothing).where(F.col("split") == "test")
        err = F.col("o_totalprice") - F.col("pred")
        so.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae")).select(
            F.lit(run).alias("run_id"), F.lit("group_mean_priority").alias("model"),
            F.lit(f"smoothing={smoothing:.0f}").alias("params"), rnd("rmse", 4).alias("rmse"), rnd("mae", 4).alias("mae"),
            F.lit(status).alias("status")).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("batch_scoring", ["M21", "Q16", "Q18", "E14", "E31"])
def batch_scoring(spark, sf_dir):
    """Fit, save and reload a pipeline, then score new rows with the
    required-column check, range flags, low-confidence flag and bounds."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from fathom.operators import contract
    from fathom.plans.models import CLS_FEATURES, doc_table
    d = doc_table(spark, sf_dir).drop("features")
    train, new = d.where("split = 'train'"), d.where("split = 'test'")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=CLS_FEATURES, outputCol="features", handleInvalid="keep"),
                            LogisticRegression(regParam=0.01)])
    path = _scratch(spark, "model")
    pipe.fit(train).write().overwrite().save(path)
    model = PipelineModel.load(path)
    contract.require_columns(new, CLS_FEATURES)
    scored = model.transform(new)
    from fathom.operators.ml import positive_probability
    s = positive_probability(scored, out="probability")
    thr = 0.5
    return s.select("doc_id", "probability",
                    (F.col("probability") >= thr).cast("int").alias("predicted"),
                    F.lit(thr).alias("decision_threshold"),
                    (F.abs(F.col("probability") - thr) < 0.10).alias("low_confidence"),
                    (~F.col("log_chars").between(0.0, 12.0)).alias("range_warning"),
                    F.greatest(F.lit(0.0), F.col("probability") - 0.1).alias("lower"),
                    F.least(F.lit(1.0), F.col("probability") + 0.1).alias("upper"))
