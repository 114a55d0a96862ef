"""Classification evaluation queries (E1-E14) on labels joined to
documents: label ``toxic``, score a fixed logistic curve of ``n_chars``."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.hashing import sql_unit_uniform, unit_uniform
from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import evalcls as C
from fathom.operators import folds
from fathom.operators.features import fixed_bins
from fathom.plans.registry import query
from fathom.sources.tables import Tables

# Fixed constants of the stand-in score: 1 / (1 + exp(-(n_chars - C0) / D0)).
C0, D0 = 2000.0, 1500.0
THRESHOLD = 0.5
LEN_EDGES = [0.0, 500.0, 2000.0, 5000.0, 1.0e9]
LEN_LABELS = ["short", "medium", "long", "very_long"]


def scored_labels(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    j = t.labels.select("doc_id", F.col("toxic").alias("y")).join(d, "doc_id")
    s = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("n_chars") - F.lit(C0)) / F.lit(D0)))
    band = F.coalesce(fixed_bins("n_chars", LEN_EDGES, LEN_LABELS, right=False), F.lit("unknown"))
    return j.withColumn("score", rnd(s, 6)).withColumn("length_band", band)


SQL_LAB = f"""lab AS (
  SELECT l.doc_id, l.toxic AS y, d.lang, d.source, d.n_chars,
         {sql_rnd(f'1.0e0 / (1.0e0 + exp(-(d.n_chars - {C0!r}e0) / {D0!r}e0))', 6)} AS score,
         CASE """ + " ".join(
    f"WHEN d.n_chars >= {LEN_EDGES[i]!r}e0 AND d.n_chars < {LEN_EDGES[i + 1]!r}e0 THEN '{LEN_LABELS[i]}'"
    for i in range(len(LEN_LABELS))) + """ ELSE 'unknown' END AS length_band
  FROM labels l JOIN documents d USING (doc_id))"""

SQL_COUNTS = """cnt AS (
  SELECT count(*) AS n, sum(CASE WHEN y = 1 AND score >= 0.5e0 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN y = 0 AND score >= 0.5e0 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN y = 0 AND score < 0.5e0 THEN 1 ELSE 0 END) AS tn,
         sum(CASE WHEN y = 1 AND score < 0.5e0 THEN 1 ELSE 0 END) AS fn,
         avg((score - y) * (score - y)) AS brier FROM lab)"""

M = ["accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1", "mcc", "kappa", "brier"]


def _sql_metric_exprs(tp="tp", fp="fp", tn="tn", fn="fn", n="n"):
    def d0(a, b):
        return f"coalesce(({a}) / nullif({b}, 0), 0.0e0)"
    return {
        "accuracy": f"({tp} + {tn}) / {n}",
        "balanced_accuracy": f"({d0(tp, f'{tp} + {fn}')} + {d0(tn, f'{tn} + {fp}')}) / 2",
        "precision": d0(tp, f"{tp} + {fp}"), "recall": d0(tp, f"{tp} + {fn}"),
        "specificity": d0(tn, f"{tn} + {fp}"), "f1": d0(f"2.0e0 * {tp}", f"2.0e0 * {tp} + {fp} + {fn}"),
        "mcc": d0(f"{tp} * {tn} - {fp} * {fn}", f"sqrt(({tp} + {fp}) * ({tp} + {fn}) * ({tn} + {fp}) * ({tn} + {fn}))"),
        "kappa": d0(f"({tp} + {tn}) / {n} - (({tp} + {fp}) * ({tp} + {fn}) + ({fn} + {tn}) * ({fp} + {tn})) / ({n} * {n})",
                    f"1 - (({tp} + {fp}) * ({tp} + {fn}) + ({fn} + {tn}) * ({fp} + {tn})) / ({n} * {n})"),
    }


@query("binary_metrics", ["E1", "E5"], sql=f"""
WITH {SQL_LAB}, {SQL_COUNTS},
c AS (SELECT n, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn, CAST(fn AS DOUBLE) AS fn, brier FROM cnt)
SELECT n, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn, """
    + ", ".join(f"{sql_rnd(e, 8)} AS {k}" for k, e in _sql_metric_exprs().items()) + f""", {sql_rnd('brier', 8)} AS brier FROM c
""")
def binary_metrics(spark, sf_dir):
    m = C.binary_metrics(scored_labels(spark, sf_dir), "y", "score", THRESHOLD)
    return m.select("n", "tp", "fp", "tn", "fn", *[rnd(c, 8).alias(c) for c in M])


@query("class_report", ["E2"], sql=f"""
WITH {SQL_LAB}, {SQL_COUNTS},
c AS (SELECT CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn, CAST(fn AS DOUBLE) AS fn FROM cnt),
r AS (SELECT '1' AS label, coalesce(tp / nullif(tp + fp, 0), 0.0e0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0e0) AS recall,
             coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0e0) AS f1, tp + fn AS support FROM c
      UNION ALL
      SELECT '0', coalesce(tn / nullif(tn + fn, 0), 0.0e0), coalesce(tn / nullif(tn + fp, 0), 0.0e0),
             coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0.0e0), tn + fp FROM c),
a AS (SELECT * FROM r
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), sum(support) FROM r)
SELECT label, {sql_rnd('precision', 8)} AS precision, {sql_rnd('recall', 8)} AS recall, {sql_rnd('f1', 8)} AS f1,
       support FROM a
""")
def class_report(spark, sf_dir):
    r = C.class_report(scored_labels(spark, sf_dir), "y", "score", THRESHOLD)
    return r.select("label", *[rnd(c, 8).alias(c) for c in ["precision", "recall", "f1"]], "support")


SQL_CURVES = """sc AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM lab GROUP BY score),
cv AS (SELECT score AS threshold, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
              sum(pos) OVER () AS P, sum(neg) OVER () AS N
       FROM sc WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query("ranking_metrics", ["E3", "E4", "J13"], sql=f"""
WITH {SQL_LAB}, {SQL_CURVES},
au AS (SELECT sum(pos * (coalesce(nb, 0) + 0.5e0 * neg)) AS num, sum(pos) AS np_, sum(neg) AS nn_
       FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb FROM sc)),
ap AS (SELECT sum(tp / (tp + fp) * pos / P) AS ap FROM cv)
SELECT {sql_rnd('CASE WHEN np_ > 0 AND nn_ > 0 THEN num / (np_ * nn_) END', 8)} AS roc_auc,
       {sql_rnd('ap', 8)} AS average_precision, CAST(np_ AS BIGINT) AS n_pos, CAST(nn_ AS BIGINT) AS n_neg
FROM au CROSS JOIN ap
""")
def ranking_metrics(spark, sf_dir):
    lab = scored_labels(spark, sf_dir)
    auc = C.roc_auc(lab, "y", "score")
    ap = C.average_precision(lab, "y", "score")
    return auc.crossJoin(ap).select(rnd("roc_auc", 8).alias("roc_auc"), rnd("average_precision", 8).alias("average_precision"),
                                    "n_pos", "n_neg")


@query("threshold_search", ["E6", "E7", "E8"], sql=f"""
WITH {SQL_LAB}, {SQL_CURVES},
pk AS (SELECT least(greatest(CAST(floor(score * 200.0e0) AS INTEGER) - 9, 0), 181) AS k, sum(y) AS pos, sum(1 - y) AS neg
       FROM lab GROUP BY 1),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM pk),
g AS (SELECT CAST(i AS INTEGER) AS i, (i + 10) / 200.0e0 AS threshold FROM range(0, 181) AS r(i)),
t AS (SELECT g.i, g.threshold, coalesce(sum(pk.pos), 0) AS tp, coalesce(sum(pk.neg), 0) AS fp
      FROM g LEFT JOIN pk ON pk.k > g.i GROUP BY g.i, g.threshold),
t2 AS (SELECT t.*, (P - tp) + fp AS cost,
              coalesce(2.0e0 * tp / nullif(2.0e0 * tp + fp + (P - tp), 0), 0.0e0) AS f1 FROM t CROSS JOIN tot),
yo AS (SELECT arg_max(threshold, (tp / P - fp / N, threshold)) AS yt, max(tp / P - fp / N) AS yj FROM cv)
SELECT {sql_rnd('arg_min(threshold, (cost, i))', 6)} AS cost_threshold, CAST(min(cost) AS DOUBLE) AS min_cost,
       {sql_rnd('arg_min(threshold, (-f1, i))', 6)} AS f1_threshold, {sql_rnd('max(f1)', 8)} AS max_f1,
       {sql_rnd('any_value(yt)', 6)} AS youden_threshold, {sql_rnd('any_value(yj)', 8)} AS youden_j
FROM t2 CROSS JOIN yo
""")
def threshold_search(spark, sf_dir):
    lab = scored_labels(spark, sf_dir)
    best = C.best_thresholds(C.threshold_table(lab, "y", "score"))
    yo = C.youden(lab, "y", "score")
    return best.crossJoin(yo).select(
        rnd("cost_threshold", 6).alias("cost_threshold"), F.col("min_cost").cast("double").alias("min_cost"),
        rnd("f1_threshold", 6).alias("f1_threshold"), rnd("max_f1", 8).alias("max_f1"),
        rnd("youden_threshold", 6).alias("youden_threshold"), rnd("youden_j", 8).alias("youden_j"))


@query("calibration_bins", ["E9", "F11"], sql=f"""
WITH {SQL_LAB},
e AS (SELECT list_sort(list_distinct(quantile_cont(score, [0.0, 0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1.0]))) AS edges FROM lab),
b AS (SELECT y, score, CASE WHEN score = edges[1] THEN 0 WHEN score < edges[1] OR score > edges[len(edges)] THEN NULL
                        ELSE len(list_filter(edges, lambda x: x < score)) - 1 END AS bin FROM lab CROSS JOIN e)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, {sql_rnd('avg(score)', 8)} AS mean_predicted,
       {sql_rnd('avg(CAST(y AS DOUBLE))', 8)} AS fraction_positive FROM b GROUP BY bin
""")
def calibration_bins(spark, sf_dir):
    lab = scored_labels(spark, sf_dir)
    b = folds.qcut_assign(lab, "score", folds.qcut_edges(lab, "score", 8), "bin")
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("score"), 8).alias("mean_predicted"),
                                rnd(F.avg(F.col("y").cast("double")), 8).alias("fraction_positive"))


@query("roc_curve", ["E10"], sql=f"""
WITH {SQL_LAB}, {SQL_CURVES}
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, {sql_rnd('tp / P', 8)} AS tpr,
       {sql_rnd('fp / N', 8)} AS fpr, {sql_rnd('tp / (tp + fp)', 8)} AS precision FROM cv
""")
def roc_curve(spark, sf_dir):
    c = C.curves(scored_labels(spark, sf_dir), "y", "score")
    return c.select("threshold", "tp", "fp", *[rnd(x, 8).alias(x) for x in ["tpr", "fpr", "precision"]])


@query("baselines", ["E11"], sql=f"""
WITH {SQL_LAB},
p AS (SELECT avg(CAST(y AS DOUBLE)) AS p1 FROM lab),
b AS (SELECT 'most_frequent' AS strategy, y, CASE WHEN p1 > 0.5e0 THEN 1.0e0 ELSE 0.0e0 END AS prob FROM lab CROSS JOIN p
      UNION ALL
      SELECT 'stratified', y, CASE WHEN {sql_unit_uniform('CAST(doc_id AS VARCHAR)', 'dummy')} < p1 THEN 1.0e0 ELSE 0.0e0 END
      FROM lab CROSS JOIN p),
c AS (SELECT strategy, count(*) AS n,
             CAST(sum(CASE WHEN y = 1 AND prob >= 0.5e0 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
             CAST(sum(CASE WHEN y = 0 AND prob >= 0.5e0 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
             CAST(sum(CASE WHEN y = 0 AND prob < 0.5e0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
             CAST(sum(CASE WHEN y = 1 AND prob < 0.5e0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
             avg((prob - y) * (prob - y)) AS brier FROM b GROUP BY strategy)
SELECT strategy, {sql_rnd('(tp + tn) / n', 8)} AS accuracy, {sql_rnd('coalesce(tp / nullif(tp + fp, 0), 0.0e0)', 8)} AS precision,
       {sql_rnd('coalesce(tp / nullif(tp + fn, 0), 0.0e0)', 8)} AS recall,
       {sql_rnd('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0e0)', 8)} AS f1, {sql_rnd('brier', 8)} AS brier FROM c
""")
def baselines(spark, sf_dir):
    lab = scored_labels(spark, sf_dir)
    p1 = lab.agg(F.avg(F.col("y").cast("double")).alias("p1"))
    j = lab.crossJoin(F.broadcast(p1))  # one row
    mf = j.select(F.lit("most_frequent").alias("strategy"), "y",
                  F.when(F.col("p1") > 0.5, 1.0).otherwise(0.0).alias("prob"))
    st = j.select(F.lit("stratified").alias("strategy"), "y",
                  F.when(unit_uniform(F.col("doc_id").cast("string"), "dummy") < F.col("p1"), 1.0).otherwise(0.0).alias("prob"))
    b = mf.unionByName(st)
    pred = (F.col("prob") >= 0.5).cast("int")
    c = b.groupBy("strategy").agg(*C.confusion_aggs(F.col("y"), pred), F.avg((F.col("prob") - F.col("y")) ** 2).alias("brier"))
    m = C.metrics_from_counts(c)
    return m.select("strategy", *[rnd(x, 8).alias(x) for x in ["accuracy", "precision", "recall", "f1", "brier"]])


@query("subgroup_f1", ["E12"], sql=f"""
WITH {SQL_LAB},
lg AS (SELECT 'lang' AS group_column, lang AS group_value, y, score FROM lab
       UNION ALL SELECT 'source', source, y, score FROM lab
       UNION ALL SELECT 'length_band', length_band, y, score FROM lab),
ov AS (SELECT coalesce(2.0e0 * sum(CASE WHEN y = 1 AND score >= 0.5e0 THEN 1 ELSE 0 END) / nullif(
         2.0e0 * sum(CASE WHEN y = 1 AND score >= 0.5e0 THEN 1 ELSE 0 END) + sum(CASE WHEN y = 0 AND score >= 0.5e0 THEN 1 ELSE 0 END)
         + sum(CASE WHEN y = 1 AND score < 0.5e0 THEN 1 ELSE 0 END), 0), 0.0e0) AS overall_f1 FROM lab),
g AS (SELECT group_column, group_value, count(*) AS n, avg(CAST(y AS DOUBLE)) AS positive_rate,
             coalesce(2.0e0 * sum(CASE WHEN y = 1 AND score >= 0.5e0 THEN 1 ELSE 0 END) / nullif(
               2.0e0 * sum(CASE WHEN y = 1 AND score >= 0.5e0 THEN 1 ELSE 0 END) + sum(CASE WHEN y = 0 AND score >= 0.5e0 THEN 1 ELSE 0 END)
               + sum(CASE WHEN y = 1 AND score < 0.5e0 THEN 1 ELSE 0 END), 0), 0.0e0) AS f1
      FROM lg WHERE group_value IS NOT NULL GROUP BY ALL),
sc AS (SELECT group_column, group_value, score, sum(y) AS pos, sum(1 - y) AS neg FROM lg GROUP BY ALL),
au AS (SELECT group_column, group_value,
              CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (coalesce(nb, 0) + 0.5e0 * neg)) / (sum(pos) * sum(neg)) END AS auc
       FROM (SELECT *, sum(neg) OVER (PARTITION BY group_column, group_value ORDER BY score
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb FROM sc) GROUP BY ALL)
SELECT g.group_column, g.group_value, n, {sql_rnd('positive_rate', 8)} AS positive_rate, {sql_rnd('f1', 8)} AS f1,
       {sql_rnd('auc', 8)} AS roc_auc, {sql_rnd('f1 - overall_f1', 8)} AS f1_gap, overall_f1 - f1 > 0.10e0 AS alert
FROM g LEFT JOIN au USING (group_column, group_value) CROSS JOIN ov WHERE n >= 10
""")
def subgroup_f1(spark, sf_dir):
    s = C.subgroup_metrics(scored_labels(spark, sf_dir), "y", "score", THRESHOLD, ["lang", "source", "length_band"])
    return s.select("group_column", "group_value", "n",
                    *[rnd(c, 8).alias(c) for c in ["positive_rate", "f1", "roc_auc", "f1_gap"]], "alert")


@query("error_rows", ["E13", "E14"], sql=f"""
WITH {SQL_LAB}
SELECT CASE WHEN y = 1 AND score < 0.5e0 THEN 'false_negative' WHEN y = 0 AND score >= 0.5e0 THEN 'false_positive'
            ELSE 'correct' END AS error_type,
       abs(score - 0.5e0) < 0.1e0 AS low_confidence, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS key_sum
FROM lab GROUP BY ALL
""")
def error_rows(spark, sf_dir):
    e = C.error_labels(scored_labels(spark, sf_dir), "y", "score", THRESHOLD, 0.10)
    return e.groupBy("error_type", "low_confidence").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("key_sum"))



