"""Regression evaluation (E20-E54): one aggregate per report, grouped
reports by exploding (group column, group value) pairs so many group keys
cost one scan and one shuffle of partial aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.numeric import flag


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def regression_aggs(y: Column, p: Column, mape_floor: float = 1.0) -> list[Column]:
    r = y - p
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(r)).alias("mae"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        (F.lit(1.0) - F.sum(r * r) / (F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
        F.avg(F.abs(r) / F.greatest(F.abs(y), F.lit(float(mape_floor)))).alias("mape"),
        F.avg(r).alias("resid_mean"),
        F.stddev_pop(r).alias("resid_std"),
        F.max(F.abs(r)).alias("max_abs_error"),
        (F.lit(1.0) - F.var_pop(r) / F.var_pop(y)).alias("explained_variance"),
    ]


def median_abs_error(df: DataFrame, y, p) -> DataFrame:
    """One row: the exact median absolute error, from the checked quantile
    path (residuals are continuous, so their distinct values are never
    merged in one task)."""
    from fathom.operators.ordered import quantile_row
    ae = df.select(F.abs(_c(y) - _c(p)).alias("__ae"))
    return quantile_row(ae, ["__ae"], [0.5], "__q").select(F.col("__q__ae")[0].alias("median_ae"))


def regression_metrics(df: DataFrame, y: str, p: str, mape_floor: float = 1.0) -> DataFrame:
    """MAE, RMSE, R^2, MAPE (denominator floored), median AE,
    residual mean and population std, max abs error, explained variance."""
    return df.agg(*regression_aggs(_c(y), _c(p), mape_floor)).crossJoin(median_abs_error(df, y, p))


def rmsle(df: DataFrame, y: str, p: str) -> DataFrame:
    """Predictions clipped at 0."""
    d = F.log1p(F.greatest(F.col(p), F.lit(0.0))) - F.log1p(F.col(y))
    return df.agg(F.sqrt(F.avg(d * d)).alias("rmsle"))


def explode_groups(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """One row per (row, group column) with the value as text."""
    pairs = F.array(*[F.struct(F.lit(g).alias("group_column"), F.col(g).cast("string").alias("group_value"))
                      for g in group_cols])
    return df.withColumn("__g", F.explode(pairs)).select("*", "__g.group_column", "__g.group_value").drop("__g")


def subgroup_regression(df: DataFrame, y: str, p: str, group_cols: Sequence[str], min_n: int = 20,
                        gap_limit: float = 1.25, keep_null_keys: bool = False) -> DataFrame:
    """Per (group column, value): n, RMSE, MAE, R^2, RMSE gap
    against the overall RMSE and an alert when gap > ``gap_limit``.
    Groups under ``min_n`` rows are left out; NULL keys are dropped unless
    ``keep_null_keys``."""
    yv, pv = F.col(y), F.col(p)
    r = yv - pv
    overall = df.agg(F.sqrt(F.avg(r * r)).alias("overall_rmse"))
    long = explode_groups(df, group_cols)
    if not keep_null_keys:
        long = long.where(F.col("group_value").isNotNull())
    g = long.groupBy("group_column", "group_value").agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(r * r)).alias("rmse"),
        F.avg(F.abs(r)).alias("mae"),
        (F.lit(1.0) - F.sum(r * r) / (F.var_pop(yv) * F.count(F.lit(1)))).alias("r2"),
    ).where(F.col("n") >= min_n)
    g = g.crossJoin(F.broadcast(overall))  # one row
    return g.withColumn("rmse_gap", F.col("rmse") / F.col("overall_rmse")) \
        .withColumn("alert", F.col("rmse_gap") > F.lit(gap_limit))


def error_rows(df: DataFrame, y: str, p: str, pct_floor: float = 1.0) -> DataFrame:
    """Residual, abs error, pct error (denominator floored), severity
    by RMSE multiples, keeping rows whose abs error exceeds the RMSE.
    Severity bins are right-closed from 0 exclusive: (0, .5], (.5, 1],
    (1, 2], (2, inf) x RMSE; an error of exactly 0 has none."""
    r = F.col(y) - F.col(p)
    overall = df.agg(F.sqrt(F.avg(r * r)).alias("__rmse"))
    j = df.crossJoin(F.broadcast(overall)).withColumns({
        "residual": r, "abs_error": F.abs(r),
        "pct_error": F.abs(r) / F.greatest(F.abs(F.col(y)), F.lit(float(pct_floor))),
    })
    a, m = F.col("abs_error"), F.col("__rmse")
    sev = F.when(a <= 0, None).when(a <= 0.5 * m, "low").when(a <= m, "medium") \
        .when(a <= 2 * m, "high").otherwise("critical")
    return j.withColumn("severity", sev).where(a > m).drop("__rmse")


def interval_coverage(df: DataFrame, y: str, p: str, width: Column | None = None) -> DataFrame:
    """Share of rows within 1, 2 and 3 RMSE of the prediction."""
    r = F.abs(F.col(y) - F.col(p))
    overall = df.agg(F.sqrt(F.avg((F.col(y) - F.col(p)) ** 2)).alias("__rmse"))
    j = df.crossJoin(F.broadcast(overall))
    return j.agg(*[F.avg(flag(r <= k * F.col("__rmse")).cast("double")).alias(f"within_{k}_rmse") for k in (1, 2, 3)])


def conformal_quantile(calib: DataFrame, y: str, p: str, alpha: float = 0.1) -> DataFrame:
    """Q-hat = the ceil((n+1)(1-alpha))/n empirical quantile of the
    calibration absolute residuals (higher order statistic)."""
    r = F.abs(F.col(y) - F.col(p))
    n = calib.agg(F.count(F.lit(1)).alias("n"))
    level = F.least(F.ceil((F.col("n") + 1) * (1 - alpha)) / F.col("n"), F.lit(1.0))
    ranked = calib.select(r.alias("ar"))
    # higher empirical quantile = smallest value with cumulative share >= level
    from fathom.operators.ordered import row_numbers
    rn = row_numbers(ranked.withColumn("__k", F.monotonically_increasing_id()), ["ar", "__k"], name="rk")
    j = rn.crossJoin(F.broadcast(n)).where(F.col("rk") >= F.ceil(level * F.col("n")))
    return j.agg(F.min("ar").alias("q_hat"), F.first("n").alias("n_calibration"))


def pinball(y: Column, q_pred: Column, q: float) -> Column:
    """Pinball loss for quantile q (aggregate with avg)."""
    d = y - q_pred
    return F.when(d >= 0, q * d).otherwise((q - 1) * d)


def asymmetric_sq(y: Column, p: Column, alpha: float = 2.0) -> Column:
    """Alpha * e^2 for under-prediction (e > 0), e^2 otherwise."""
    e = y - p
    return F.when(e > 0, alpha * e * e).otherwise(e * e)


def huber_loss(e: Column, delta: float = 1.0) -> Column:
    a = F.abs(e)
    return F.when(a <= delta, 0.5 * e * e).otherwise(delta * (a - 0.5 * delta))


def oof_group_means(df: DataFrame, y: str, group: str, fold: str) -> DataFrame:
    """df with ``oof``: the mean of ``y`` over the rows of the same group in
    the other folds (of all rows of the other folds where there are none);
    NULL for rows without a group.  Sums per (group, fold), no refit."""
    from fathom.session import small_side
    cell = df.groupBy(group, fold).agg(F.sum(y).alias("__s"), F.count(y).alias("__n"))
    whole = cell.groupBy(group).agg(F.sum("__s").alias("__gs"), F.sum("__n").alias("__gn"))
    by_fold = cell.groupBy(fold).agg(F.sum("__s").alias("__fs"), F.sum("__n").alias("__fn"))
    total = cell.agg(F.sum("__s").alias("__ts"), F.sum("__n").alias("__tn"))
    left = cell.join(whole, group).join(F.broadcast(by_fold), fold).crossJoin(F.broadcast(total)).select(
        F.col(group).alias("__g"), F.col(fold).alias("__f"),
        F.coalesce(F.try_divide(F.col("__gs") - F.col("__s"), F.col("__gn") - F.col("__n")),
                   F.try_divide(F.col("__ts") - F.col("__fs"), F.col("__tn") - F.col("__fn"))).alias("oof"))
    same = F.col(group).eqNullSafe(F.col("__g")) & F.col(fold).eqNullSafe(F.col("__f"))
    return df.join(small_side(left), same, "left").drop("__g", "__f")


def uncertainty_band(df: DataFrame, y: str, pred: str, over_cost: float = 1.0, under_cost: float = 1.0) -> DataFrame:
    """One row with RMSE, MAE and R2 of out-of-fold predictions and the
    half-widths of a band below and above a prediction: the RMSE times the
    cost of predicting too little and too much."""
    e = F.col(y) - F.col(pred)
    rows = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
    m = rows.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("oof_rmse"), F.avg(F.abs(e)).alias("oof_mae"),
                 (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(F.lit(1)))).alias("oof_r2"))
    return m.withColumn("lower_band", F.col("oof_rmse") * under_cost).withColumn("upper_band", F.col("oof_rmse") * over_cost)


def linear_attributions(df: DataFrame, y: str, features) -> DataFrame:
    """Per feature the slope of ``y`` on it alone, its slope beside
    the other features, what adjusting changed, and the mean of
    |adjusted slope x (x - mean)| over the rows: one Gram matrix, one pass."""
    import numpy as np
    from fathom.operators import ml
    features = list(features)
    g = ml.gram(df, features, [y])
    n, xx, xy = g["n"], g["xx"], g["xy"][:, 0]
    mean, label = xx[0, 1:] / n, xy[0] / n
    s, c = xx[1:, 1:] - n * np.outer(mean, mean), xy[1:] - n * mean * label
    adjusted = np.linalg.lstsq(s, c, rcond=None)[0]
    size = df.select(*features, y).dropna().agg(*[F.avg(F.abs(F.lit(float(b)) * (F.col(f) - F.lit(float(m))))).alias(f)
                                                  for f, b, m in zip(features, adjusted, mean)]).first()
    rows = [(f, float(c[i] / s[i, i]) if s[i, i] > 0 else None, float(adjusted[i]), float(size[f])) for i, f in enumerate(features)]
    t = df.sparkSession.createDataFrame(rows, "feature string, unadjusted double, adjusted double, mean_abs_attribution double")
    return t.withColumn("change", F.col("adjusted") - F.col("unadjusted"))
