"""Aggregations (A1-A14): grouped reports over many keys in one scan,
correlation tables, VIF from a distributed correlation matrix, histograms
and pivots."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.operators.evalreg import explode_groups


def grouped_report(df: DataFrame, target: str, group_cols: Sequence[str], median: bool = True) -> DataFrame:
    """A1-A3: n, mean, median (exact), sample std of ``target`` for every
    group column at once: rows are exploded to (group column, value) so
    the scan and the partial aggregation happen once (grouping sets)."""
    long = explode_groups(df, group_cols).where(F.col("group_value").isNotNull())
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean"), F.stddev_samp(target).alias("std")]
    rep = long.groupBy("group_column", "group_value").agg(*aggs)
    if not median:
        return rep
    from fathom.operators.ordered import quantiles
    med = quantiles(long, target, [0.5], ["group_column", "group_value"]) \
        .select("group_column", "group_value", F.col("quantiles")[0].cast("double").alias("median"))
    return rep.join(med, ["group_column", "group_value"], "left").select("group_column", "group_value", "n", "mean",
                                                                        "median", "std")


def with_domain(report: DataFrame, domain: DataFrame, key: str) -> DataFrame:
    """A4 / empty groups: left join from the domain so levels without rows
    appear with n = 0 and NULL statistics (pandas observed=False)."""
    return domain.join(report, key, "left").withColumn("n", F.coalesce(F.col("n"), F.lit(0)))


def corr_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: pairwise Pearson correlations in one aggregate, long form."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return agg.selectExpr(f"stack({len(pairs)}, {stack}) as (feature_a, feature_b, r)")


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Correlation of each feature with the target, |r| descending."""
    agg = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (feature, r)").orderBy(F.desc(F.abs("r")))


def vif(df: DataFrame, cols: Sequence[str], cap: float = 9999.0, alert: float = 10.0) -> DataFrame:
    """VIF_i = [R^-1]_ii from the correlation matrix, which is one
    distributed aggregate; only the d x d matrix reaches the driver.
    VIF is ``cap`` when R^2 >= 0.999 (singular or near-singular)."""
    d = len(cols)
    row = df.agg(*[F.corr(a, b).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]).first()
    r = np.eye(d)
    for i in range(d):
        for j in range(i + 1, d):
            v = row[f"{i}_{j}"]
            r[i, j] = r[j, i] = float("nan") if v is None else v
    try:
        inv = np.linalg.inv(r)
        vifs = [float(inv[i, i]) for i in range(d)]
    except np.linalg.LinAlgError:
        vifs = [float("inf")] * d
    out = []
    for c, v in zip(cols, vifs):
        r2 = 1 - 1 / v if v and np.isfinite(v) and v != 0 else 1.0
        val = cap if (not np.isfinite(v) or r2 >= 0.999) else v
        out.append((c, float(r2), float(val), bool(val > alert)))
    return df.sparkSession.createDataFrame(out, "feature string, r2 double, vif double, alert boolean")


def fixed_edge_histogram(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """Counts per fixed bin [e_i, e_i+1), last bin closed; values
    outside the edges are dropped; cumulative counts over the few bins."""
    x = F.col(col)
    b = None
    for i in range(len(edges) - 1):
        lo, hi = float(edges[i]), float(edges[i + 1])
        cond = (x >= lo) & ((x <= hi) if i == len(edges) - 2 else (x < hi))
        b = F.when(cond, F.lit(i)) if b is None else b.when(cond, F.lit(i))
    counts = df.select(b.alias("bin")).where(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    dom = spark.createDataFrame([(i, float(edges[i]), float(edges[i + 1])) for i in range(len(edges) - 1)],
                                "bin int, lower double, upper double")
    from pyspark.sql import Window
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # a handful of bins
    return dom.join(counts, "bin", "left").withColumn("count", F.coalesce("count", F.lit(0))) \
        .withColumn("cumulative", F.sum("count").over(w))


def pivot_mean(df: DataFrame, row_key: str, col_key: str, values: Sequence, value: str, fill: float = 0.0,
               fn=F.avg) -> DataFrame:
    """Two-key pivot with the column levels given (no extra job to
    discover them) and empty cells filled."""
    p = df.groupBy(row_key).pivot(col_key, list(values)).agg(fn(value))
    return p.fillna(fill)
