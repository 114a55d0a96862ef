"""Splits and folds (F1-F16).

Every split is one new column computed from the md5 hash of the row key
and a salt, so the same rows land in the same split on any cluster and any
partitioning.  Stratified and ordered splits need exact per-group ranks;
those come from ``ordered.row_numbers``, which never puts a whole group in
one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.hashing import bucket, key_text, salted_h32, salted_h32_columns, unit_uniform
from fathom.operators.ordered import ntile_of, row_numbers
from fathom.session import small_side


def _kt(key_cols: Sequence[str]) -> Column:
    return key_text(*key_cols)


def holdout(df: DataFrame, key_cols: Sequence[str], train_pct: int = 80, salt: str = "split",
            name: str = "split") -> DataFrame:
    """'train' when bucket(key, salt) < train_pct, else 'test'."""
    return df.withColumn(name, F.when(bucket(_kt(key_cols), salt) < train_pct, F.lit("train"))
                         .otherwise(F.lit("test")))


def calibration_flag(df: DataFrame, key_cols: Sequence[str], pct: int = 20, salt: str = "calib",
                     name: str = "is_calibration") -> DataFrame:
    """a second salt picks calibration rows (use on training rows)."""
    return df.withColumn(name, (bucket(_kt(key_cols), salt) < pct).cast("int"))


def ab_arm(df: DataFrame, key_cols: Sequence[str], salt: str = "ab", name: str = "arm") -> DataFrame:
    """arm 'A' or 'B' by hash parity."""
    return df.withColumn(name, F.when(bucket(_kt(key_cols), salt, 2) == 0, F.lit("A")).otherwise(F.lit("B")))


def _rank_in_strata(df: DataFrame, key_cols: Sequence[str], strata: Sequence[str], salt: str,
                    num_partitions: int | None = None) -> DataFrame:
    with_h = df.withColumn("__h", salted_h32(_kt(key_cols), salt)).withColumn("__kt", _kt(key_cols))
    ranked = row_numbers(with_h, ["__h", "__kt"], strata, name="__rn", num_partitions=num_partitions)
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("__n"))
    return ranked.join(small_side(sizes), list(strata), "left") if strata else ranked.crossJoin(F.broadcast(sizes))


def stratified_holdout(df: DataFrame, key_cols: Sequence[str], strata: Sequence[str],
                       test_pct: int = 20, salt: str = "strat", name: str = "split") -> DataFrame:
    """within each stratum, rows in hash order; the first
    round(n * test_pct / 100) are 'test'.  Counts are exact per stratum."""
    r = _rank_in_strata(df, key_cols, strata, salt)
    n_test = F.expr(f"(__n * {int(test_pct)} + 50) div 100")
    return r.withColumn(name, F.when(F.col("__rn") <= n_test, F.lit("test")).otherwise(F.lit("train"))) \
        .drop("__h", "__kt", "__rn", "__n")


def kfold(df: DataFrame, key_cols: Sequence[str], k: int = 5, salt: str = "kfold",
          name: str = "fold") -> DataFrame:
    """F6 shuffled: fold = bucket(key, salt) mod k."""
    return df.withColumn(name, bucket(_kt(key_cols), salt, k).cast("int"))


def stratified_kfold(df: DataFrame, key_cols: Sequence[str], strata: Sequence[str], k: int = 5,
                     salt: str = "skfold", name: str = "fold") -> DataFrame:
    """within each stratum in hash order, fold = (rank - 1) mod k."""
    r = _rank_in_strata(df, key_cols, strata, salt)
    return r.withColumn(name, ((F.col("__rn") - 1) % k).cast("int")).drop("__h", "__kt", "__rn", "__n")


def ordered_tiles(df: DataFrame, order_cols: Sequence[str], k: int, name: str = "tile",
                  group_cols: Sequence[str] = ()) -> DataFrame:
    """SQL ntile(k) over an order (sequential K-fold F6, TimeSeriesSplit F9,
    window drift D5) without a single-task window."""
    r = row_numbers(df, order_cols, group_cols, name="__rn")
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__n"))
    r = r.join(small_side(sizes), list(group_cols), "left") if group_cols else r.crossJoin(F.broadcast(sizes))
    return r.withColumn(name, ntile_of(F.col("__rn"), F.col("__n"), k)).drop("__rn", "__n")


def time_holdout(df: DataFrame, order_cols: Sequence[str], test_pct: int = 20,
                 name: str = "split") -> DataFrame:
    """the last round(n * test_pct / 100) rows in time order are 'test'."""
    r = row_numbers(df, order_cols, name="__rn")
    sizes = df.agg(F.count(F.lit(1)).alias("__n"))
    r = r.crossJoin(F.broadcast(sizes))
    n_test = F.expr(f"(__n * {int(test_pct)} + 50) div 100")
    return r.withColumn(name, F.when(F.col("__rn") > F.col("__n") - n_test, F.lit("test"))
                        .otherwise(F.lit("train"))).drop("__rn", "__n")


def time_series_folds(df: DataFrame, order_cols: Sequence[str], n_splits: int = 5,
                      name: str = "tile") -> DataFrame:
    """ntile(n_splits + 1); split i trains on tiles < i and tests on tile i."""
    return ordered_tiles(df, order_cols, n_splits + 1, name)


def repeated_kfold(df: DataFrame, key_cols: Sequence[str], k: int = 5, repeats: int = 5,
                   salt: str = "rkfold") -> DataFrame:
    """one row per (row, repeat) with the repeat number in the salt."""
    kt = _kt(key_cols)
    out = df.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    text = F.concat(kt, F.lit(salt), F.col("repeat").cast("string"))
    return out.withColumn("fold", (salted_h32(text, "") % k).cast("int"))


def group_kfold(df: DataFrame, group_col: str, k: int = 5, name: str = "fold") -> DataFrame:
    """F8: no group in two folds.  Groups are ranked by size (desc, then
    key) and dealt out in snake order 0..k-1, k-1..0, which keeps fold
    sizes balanced like the greedy 'lightest fold first' rule while staying
    a distributed rank instead of a driver loop."""
    sizes = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("__size")) \
        .withColumn("__neg", -F.col("__size")).withColumn("__gk", F.col(group_col).cast("string"))
    ranked = row_numbers(sizes, ["__neg", "__gk"], name="__rn")
    r0 = F.col("__rn") - 1
    lap = (r0 / k).cast("long")
    pos = r0 % k
    assign = ranked.select(group_col, F.when(lap % 2 == 0, pos).otherwise(k - 1 - pos).cast("int").alias(name))
    return df.join(assign, group_col, "left")


def qcut_edges(df: DataFrame, col: str, q: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """exact quantile edges (linear interpolation), duplicates dropped."""
    from fathom.operators.ordered import column_quantiles
    probs = [i / q for i in range(q + 1)]
    e = column_quantiles(df, [col], probs, group_cols)
    if group_cols:
        return e.select(*group_cols, F.array_distinct("quantiles").alias("edges"))
    # one row even when the column has no values (edges NULL)
    return e.agg(F.first(F.array_distinct("quantiles"), ignorenulls=True).alias("edges"))


def qcut_assign(df: DataFrame, col: str, edges: DataFrame, name: str = "qbin",
                group_cols: Sequence[str] = ()) -> DataFrame:
    """Bin number 0..len(edges)-2: right-closed, lowest edge included,
    values outside the edges give NULL (pandas ``qcut`` semantics)."""
    j = df.join(F.broadcast(edges), list(group_cols), "left") if group_cols else df.crossJoin(F.broadcast(edges))
    x = F.col(col)
    inner = F.size(F.filter(F.col("edges"), lambda e: e < x)) - 1
    b = F.when(x.isNull(), None) \
        .when(x == F.element_at("edges", 1), F.lit(0)) \
        .when((x < F.element_at("edges", 1)) | (x > F.element_at("edges", -1)), None) \
        .otherwise(inner)
    return j.withColumn(name, b.cast("int")).drop("edges")


def nested_samples(df: DataFrame, key_cols: Sequence[str], fractions: Sequence[float],
                   salt: str = "lcurve") -> DataFrame:
    """growing nested samples; a row in the 10% sample is in the 20% one."""
    u = unit_uniform(_kt(key_cols), salt)
    out = df.withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
    return out.where(u < F.col("fraction"))


# Poisson(1) cumulative probabilities P(K <= k), k = 0..10, from the rule
# P(K = j) = e^-1 / j!.
POISSON1_CDF = [sum(math.exp(-1.0) / math.factorial(j) for j in range(k + 1)) for k in range(11)]


def bootstrap_weights(df: DataFrame, key_cols: Sequence[str], replicates: int,
                      salt: str = "boot") -> DataFrame:
    """F16: Poisson(1) weight per (row, replicate) by inverse CDF of a hash
    uniform: the distributed bootstrap, with no row copies."""
    kt = _kt(key_cols)
    out = df.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    u = salted_h32(F.concat(kt, F.lit(salt), F.col("replicate").cast("string")), "") / F.lit(4294967296.0)
    w = F.lit(11)
    for k in reversed(range(len(POISSON1_CDF))):
        w = F.when(u < F.lit(POISSON1_CDF[k]), F.lit(k)).otherwise(w)
    return out.withColumn("weight", w.cast("int"))


def weighted_grams(df: DataFrame, features: Sequence[str], label: str, key_cols: Sequence[str], replicates: int,
                   salt: str = "boot") -> dict[int, np.ndarray]:
    """Gram matrix of [1, features, label] under the weights of
    ``bootstrap_weights`` for every replicate, from one pass without a row per
    (row, replicate); rows with a NULL left out."""
    width = len(features) + 2
    first, second = np.triu_indices(width)
    steps = [np.uint32(math.ceil(c * 2.0 ** 32)) for c in POISSON1_CDF]

    def run(batches):
        sums = np.zeros((replicates, len(first)))
        for whole in batches:
            for i in range(0, whole.num_rows, 8192):                # the hash's working arrays stay in the cache
                batch = whole.slice(i, 8192)
                z = np.column_stack([np.ones(batch.num_rows), *[batch.column(j).to_numpy() for j in range(1, width)]])
                weight = np.empty((replicates, len(z)))
                for r, h in enumerate(salted_h32_columns(batch.column(0), [f"{salt}{r + 1}" for r in range(replicates)])):
                    weight[r] = sum((h >= s).view(np.uint8) for s in steps)
                sums += weight @ (z[:, first] * z[:, second])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], names=["k", "v"])

    rows = df.select(_kt(key_cols).alias("__kt"), *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate([*features, label])]) \
        .dropna().mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v"))
    flat = np.zeros(replicates * len(first))
    for r in rows.collect():                                        # replicates x (features + 2)^2 / 2 numbers
        flat[r["k"]] = r["v"]
    out = {}
    for r, values in enumerate(flat.reshape(replicates, -1)):
        gram = np.zeros((width, width))
        gram[first, second] = gram[second, first] = values
        if gram[0, 0]:
            out[r + 1] = gram
    return out


def latest_period_holdout(df: DataFrame, period_col: str, min_train: int = 100, min_valid: int = 20,
                          name: str = "split"):
    """rows of the latest period are held out, earlier rows train.

    Returns ``(frame with split column, holdout period, table of train
    periods)`` or ``None`` when there are fewer than two periods or a side is
    under its size guard.  One row of counts reaches the driver; the periods
    stay a table."""
    per = df.where(F.col(period_col).isNotNull()).groupBy(period_col).agg(F.count(F.lit(1)).alias("n"))
    s = per.agg(F.max(period_col).alias("last"), F.count(F.lit(1)).alias("n_periods"),
                F.max_by("n", period_col).alias("n_last"), F.sum("n").alias("n_all")).first()
    if s is None or s["n_periods"] is None or s["n_periods"] < 2:
        return None
    n_train = s["n_all"] - s["n_last"]
    if n_train < min_train or s["n_last"] < min_valid:
        return None
    last = s["last"]
    split = F.when(F.col(period_col) == F.lit(last), F.lit("valid")) \
        .when(F.col(period_col) < F.lit(last), F.lit("train"))
    return df.withColumn(name, split), last, per.where(F.col(period_col) < F.lit(last)).select(period_col)
