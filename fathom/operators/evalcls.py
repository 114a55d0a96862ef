"""Binary classification evaluation.

Everything reduces to counts: confusion counts are conditional sums; AUC,
average precision, ROC/PR curves and Youden's threshold come from counts per
distinct score followed by running sums (``ordered.running_totals``), so no
global sort lands in one task; threshold grids pre-aggregate rows into at
most grid-size bins before any window runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.numeric import div0
from fathom.operators.evalreg import explode_groups
from fathom.operators.ordered import running_totals


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def confusion_aggs(y: Column, pred: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"),
            F.sum(((y == 1) & (pred == 1)).cast("long")).alias("tp"),
            F.sum(((y == 0) & (pred == 1)).cast("long")).alias("fp"),
            F.sum(((y == 0) & (pred == 0)).cast("long")).alias("tn"),
            F.sum(((y == 1) & (pred == 0)).cast("long")).alias("fn")]


def metrics_from_counts(df: DataFrame) -> DataFrame:
    """E1/E5 column math over tp, fp, tn, fn (0 where undefined)."""
    tp, fp, tn, fn, n = (F.col(c).cast("double") for c in ["tp", "fp", "tn", "fn", "n"])
    precision = div0(tp, tp + fp)
    recall = div0(tp, tp + fn)
    spec = div0(tn, tn + fp)
    f1 = div0(2 * tp, 2 * tp + fp + fn)
    mcc = div0(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))
    po = (tp + tn) / n
    pe = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n)
    kappa = div0(po - pe, 1 - pe)
    return df.withColumns({"accuracy": (tp + tn) / n, "balanced_accuracy": (recall + spec) / 2,
                           "precision": precision, "recall": recall, "specificity": spec, "f1": f1,
                           "mcc": mcc, "kappa": kappa})


def binary_metrics(df: DataFrame, y: str, score: str, threshold: float) -> DataFrame:
    """Counts and metrics at ``threshold`` (score >= t is positive),
    plus the Brier score."""
    yv, s = F.col(y), F.col(score)
    pred = (s >= threshold).cast("int")
    agg = df.agg(*confusion_aggs(yv, pred), F.avg((s - yv) * (s - yv)).alias("brier"))
    return metrics_from_counts(agg)


def class_report(df: DataFrame, y: str, score: str, threshold: float) -> DataFrame:
    """Per-class precision, recall, F1, support; macro and weighted rows."""
    m = binary_metrics(df, y, score, threshold)
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ["tp", "fp", "tn", "fn"])
    rows = m.select(F.explode(F.array(
        F.struct(F.lit("1").alias("label"), div0(tp, tp + fp).alias("precision"), div0(tp, tp + fn).alias("recall"),
                 div0(2 * tp, 2 * tp + fp + fn).alias("f1"), (tp + fn).alias("support")),
        F.struct(F.lit("0").alias("label"), div0(tn, tn + fn).alias("precision"), div0(tn, tn + fp).alias("recall"),
                 div0(2 * tn, 2 * tn + fn + fp).alias("f1"), (tn + fp).alias("support")))).alias("r")).select("r.*")
    macro = rows.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                     F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    tot = F.sum("support")
    weighted = rows.agg(F.lit("weighted avg").alias("label"),
                        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"), tot.alias("support"))
    return rows.unionByName(macro).unionByName(weighted)


def score_counts(df: DataFrame, y: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (per group)."""
    return df.groupBy(*group_cols, score).agg(F.sum(F.col(y).cast("long")).alias("pos"),
                                              F.sum((1 - F.col(y)).cast("long")).alias("neg"))


def roc_auc(df: DataFrame, y: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """AUC = P(score_pos > score_neg) + 0.5 P(tie), from negatives
    strictly below each distinct score; NULL when a class is absent."""
    sc = score_counts(df, y, score, group_cols)
    cum = running_totals(sc, [score], {"neg_below": F.col("neg")}, group_cols, inclusive=False)
    agg = cum.groupBy(*group_cols).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("__num"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return agg.withColumn("roc_auc", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                                            F.col("__num") / (F.col("n_pos") * F.col("n_neg")))).drop("__num")


def curves(df: DataFrame, y: str, score: str) -> DataFrame:
    """ROC and PR points per distinct score, descending thresholds."""
    sc = score_counts(df, y, score).withColumn("__neg_s", -F.col(score))
    cum = running_totals(sc, ["__neg_s"], {"tp": F.col("pos"), "fp": F.col("neg")})
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = cum.crossJoin(F.broadcast(tot))  # one row
    return j.select(F.col(score).alias("threshold"), "tp", "fp",
                    (F.col("tp") / F.col("P")).alias("tpr"), (F.col("fp") / F.col("N")).alias("fpr"),
                    (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), "P", "N")


def average_precision(df: DataFrame, y: str, score: str) -> DataFrame:
    """Sum over distinct thresholds (descending) of
    (recall_k - recall_{k-1}) * precision_k."""
    c = curves(df, y, score)
    pos = score_counts(df, y, score).select(F.col(score).alias("threshold"), "pos")
    return c.join(pos, "threshold").agg(F.sum(F.col("precision") * F.col("pos") / F.col("P")).alias("average_precision"))


def grid_thresholds(n: int = 181, lo_num: int = 10, den: int = 200) -> list[float]:
    """Threshold grid t_i = (lo_num + i) / den: 0.05, 0.055, ..., 0.95."""
    return [(lo_num + i) / den for i in range(n)]


def threshold_table(df: DataFrame, y: str, score: str, n: int = 181, lo_num: int = 10, den: int = 200,
                    fn_cost: float = 1.0, fp_cost: float = 1.0) -> DataFrame:
    """E6/E7 table: for each grid threshold t_i the counts of ``score >= t_i``.
    Rows are first reduced to k = number of grid points <= score (at most
    n + 1 groups), then suffix sums run over that tiny table."""
    k = F.least(F.greatest(F.floor(F.col(score) * F.lit(float(den))).cast("int") - (lo_num - 1), F.lit(0)), F.lit(n))
    per_k = df.groupBy(k.alias("k")).agg(F.sum(F.col(y).cast("long")).alias("pos"),
                                         F.sum((1 - F.col(y)).cast("long")).alias("neg"))
    spark = df.sparkSession
    grid = spark.range(n).select(F.col("id").cast("int").alias("i"),
                                 ((F.col("id") + lo_num) / F.lit(float(den))).alias("threshold"))
    tot = per_k.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    # positives predicted at t_i are rows with k > i
    j = grid.crossJoin(F.broadcast(per_k)).where(F.col("k") > F.col("i")) \
        .groupBy("i", "threshold").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp"))
    t = grid.join(j, ["i", "threshold"], "left").crossJoin(F.broadcast(tot)) \
        .withColumns({"tp": F.coalesce("tp", F.lit(0)), "fp": F.coalesce("fp", F.lit(0))})
    t = t.withColumns({"fn": F.col("P") - F.col("tp"), "tn": F.col("N") - F.col("fp")})
    return t.withColumns({"cost": F.col("fn") * fn_cost + F.col("fp") * fp_cost,
                          "f1": div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))})


def best_thresholds(table: DataFrame) -> DataFrame:
    """E6 min cost and E7 max F1, the first (lowest) threshold winning ties."""
    return table.agg(
        F.min_by("threshold", F.struct("cost", "i")).alias("cost_threshold"),
        F.min("cost").alias("min_cost"),
        F.min_by("threshold", F.struct((-F.col("f1")).alias("nf1"), F.col("i"))).alias("f1_threshold"),
        F.max("f1").alias("max_f1"))


def youden(df: DataFrame, y: str, score: str) -> DataFrame:
    """Distinct-score threshold maximising tpr - fpr (higher threshold
    wins ties, as the ROC walk meets it first)."""
    c = curves(df, y, score)
    return c.agg(F.max_by("threshold", F.struct((F.col("tpr") - F.col("fpr")).alias("j"), F.col("threshold")))
                 .alias("youden_threshold"), F.max(F.col("tpr") - F.col("fpr")).alias("youden_j"))


def subgroup_metrics(df: DataFrame, y: str, score: str, threshold: float, group_cols: Sequence[str],
                     min_n: int = 10, gap_limit: float = 0.10) -> DataFrame:
    """Per (group column, value) with n >= min_n: positive rate, F1,
    AUC (NULL with one class), F1 gap against overall, alert when the group
    is more than ``gap_limit`` below."""
    pred = (F.col(score) >= threshold).cast("int")
    overall = df.agg(*confusion_aggs(F.col(y), pred)).select(
        div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("overall_f1"))
    long = explode_groups(df, group_cols).where(F.col("group_value").isNotNull())
    g = long.groupBy("group_column", "group_value").agg(
        *confusion_aggs(F.col(y), pred), F.avg(F.col(y).cast("double")).alias("positive_rate"))
    g = g.withColumn("f1", div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))
    auc = roc_auc(long, y, score, ["group_column", "group_value"]).select("group_column", "group_value", "roc_auc")
    out = g.where(F.col("n") >= min_n).join(auc, ["group_column", "group_value"], "left").crossJoin(F.broadcast(overall))
    return out.select("group_column", "group_value", "n", "positive_rate", "f1", "roc_auc",
                      (F.col("f1") - F.col("overall_f1")).alias("f1_gap"),
                      ((F.col("overall_f1") - F.col("f1")) > gap_limit).alias("alert"))


def error_labels(df: DataFrame, y: str, score: str, threshold: float, band: float = 0.10) -> DataFrame:
    """Error type per row and a low-confidence flag (strictly
    within +-band of the threshold)."""
    pred = (F.col(score) >= threshold).cast("int")
    kind = F.when((F.col(y) == 1) & (pred == 0), "false_negative") \
        .when((F.col(y) == 0) & (pred == 1), "false_positive").otherwise("correct")
    return df.withColumns({"predicted": pred, "error_type": kind,
                           "low_confidence": F.abs(F.col(score) - F.lit(threshold)) < band})
