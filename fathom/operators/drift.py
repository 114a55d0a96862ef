"""Drift and monitoring (D1-D9) between a reference and a current table.

Inputs are long (feature, x) tables so every feature is handled by the
same scan, shuffle and aggregate.  The KS statistic is computed from
running counts over distinct values (``ordered.running_totals``), so the
number of distinct values never has to fit in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.special import ks_sf_col
from fathom.operators.ordered import running_totals


def long_values(df: DataFrame, features: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """(feature, x) pairs, NULLs kept."""
    return df.select(*extra, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                                                 for c in features])).alias("p")).select(*extra, "p.*")


def missing_rates(long: DataFrame) -> DataFrame:
    return long.groupBy("feature").agg((F.lit(1.0) - F.count("x") / F.count(F.lit(1))).alias("missing_rate"))


def missing_drift(ref: DataFrame, cur: DataFrame, limit: float = 0.05) -> DataFrame:
    """|current - training| missing rate, alert when >= limit."""
    r = missing_rates(ref).withColumnRenamed("missing_rate", "train_missing_rate")
    c = missing_rates(cur).withColumnRenamed("missing_rate", "current_missing_rate")
    j = r.join(c, "feature")
    ch = F.abs(F.col("current_missing_rate") - F.col("train_missing_rate"))
    return j.withColumn("absolute_change", ch).withColumn("missing_alert", ch >= limit)


def profile_stats(long: DataFrame) -> DataFrame:
    """D3 side: mean and population std per feature."""
    return long.groupBy("feature").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))


def reference_points(ref_long: DataFrame, n_quantiles: int = 100) -> DataFrame:
    """The Q6 compact reference: ``n_quantiles`` exact quantiles at
    linspace(0, 1, n) per feature, as (feature, x) points."""
    from fathom.operators.ordered import quantiles
    probs = [i / (n_quantiles - 1) for i in range(n_quantiles)]
    q = quantiles(ref_long, "x", probs, ["feature"], out="qs")
    return q.select("feature", F.explode("qs").alias("x"))


def ks_against_points(ref_points: DataFrame, cur: DataFrame, min_n: int = 10,
                      p_limit: float = 0.05) -> DataFrame:
    """Two-sample KS statistic of incoming values against stored
    reference points (e.g. the 100 profile quantiles), per feature.
    p-value from the asymptotic Kolmogorov series with
    en = n*m/(n+m) (SciPy may use the exact small-sample form instead)."""
    a = ref_points.where(F.col("x").isNotNull()).select("feature", "x", F.lit(1).alias("wr"), F.lit(0).alias("wc"))
    b = cur.where(F.col("x").isNotNull()).select("feature", "x", F.lit(0).alias("wr"), F.lit(1).alias("wc"))
    per_value = a.unionByName(b).groupBy("feature", "x").agg(F.sum("wr").cast("long").alias("wr"),
                                                             F.sum("wc").cast("long").alias("wc"))
    cum = running_totals(per_value, ["x"], {"cr": F.col("wr"), "cc": F.col("wc")}, ["feature"])
    sizes = per_value.groupBy("feature").agg(F.sum("wr").alias("n_ref"), F.sum("wc").alias("n_cur"))
    j = cum.join(F.broadcast(sizes), "feature")  # one row per feature
    d = F.abs(F.col("cr") / F.col("n_ref") - F.col("cc") / F.col("n_cur"))
    stat = j.groupBy("feature", "n_ref", "n_cur").agg(F.max(d).alias("ks_statistic")) \
        .where(F.col("n_cur") >= min_n)
    en = F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur"))
    stat = stat.withColumn("__lam", F.sqrt(en) * F.col("ks_statistic"))
    return stat.withColumn("ks_pvalue", ks_sf_col("__lam")).drop("__lam") \
        .withColumn("ks_alert", F.col("ks_pvalue") < p_limit)


def psi(ref: DataFrame, cur: DataFrame, bins: int = 10, eps: float = 1e-8) -> DataFrame:
    """Population stability index on equal-width bins of the reference
    range.  Current values outside the range are lost from the bins but
    stay in the denominator; every bin gets +eps."""
    r = ref.where(F.col("x").isNotNull())
    c = cur.where(F.col("x").isNotNull())
    rng = r.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n_ref"))
    n_cur = c.groupBy("feature").agg(F.count(F.lit(1)).alias("n_cur"))

    def bin_of(x: Column) -> Column:
        width = F.col("hi") - F.col("lo")
        raw = F.floor((x - F.col("lo")) * (F.lit(float(bins)) / width)).cast("int")
        return F.when((x < F.col("lo")) | (x > F.col("hi")), None) \
            .when(width == 0, F.lit(0)) \
            .when(x == F.col("hi"), F.lit(bins - 1)).otherwise(F.least(raw, F.lit(bins - 1)))

    rb = r.join(F.broadcast(rng), "feature").select("feature", bin_of(F.col("x")).alias("bin"))
    cb = c.join(F.broadcast(rng), "feature").select("feature", bin_of(F.col("x")).alias("bin"))
    rc = rb.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("e"))
    cc = cb.where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("a"))
    grid = rng.select("feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    g = grid.join(rc, ["feature", "bin"], "left").join(cc, ["feature", "bin"], "left") \
        .join(F.broadcast(rng.select("feature", "n_ref")), "feature").join(F.broadcast(n_cur), "feature")
    e = F.coalesce(F.col("e"), F.lit(0)) / F.col("n_ref") + eps
    a = F.coalesce(F.col("a"), F.lit(0)) / F.col("n_cur") + eps
    return g.groupBy("feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"), F.first("n_cur").alias("n_current"))


def window_means(long_with_tile: DataFrame, tile_col: str = "tile") -> DataFrame:
    """Mean per feature per window/tile."""
    return long_with_tile.groupBy("feature", tile_col).agg(F.avg("x").alias("mean"), F.count("x").alias("n"))


def bounds_check(train: DataFrame, incoming: DataFrame, lat: str, lon: str) -> DataFrame:
    """Every incoming point inside the training lat/lon range."""
    b = train.agg(F.min(lat).alias("__lat0"), F.max(lat).alias("__lat1"),
                  F.min(lon).alias("__lon0"), F.max(lon).alias("__lon1"))
    j = incoming.crossJoin(F.broadcast(b))  # one row
    inside = F.col(lat).between(F.col("__lat0"), F.col("__lat1")) & F.col(lon).between(F.col("__lon0"), F.col("__lon1"))
    return j.agg(F.bool_and(inside).alias("all_inside"), F.count(F.when(~inside, 1)).alias("n_outside"),
                 F.count(F.lit(1)).alias("n_points"))


def half_report(long: DataFrame, half: str = "half", ref: str = "reference", cur: str = "current",
                bins: int = 10, eps: float = 1e-8, missing_limit: float = 0.05) -> DataFrame:
    """D1 + D3 + D4 over (feature, ``half``, x) rows of both halves in two
    passes instead of one per statistic and half: one grouped aggregate with
    per-half conditional counts, moments and the reference range, then one
    binning pass over both halves for the PSI (same rules as ``psi``).
    Features without a value in either half are left out, as the joins of
    ``missing_drift``, ``profile_stats`` and ``psi`` would."""
    is_ref, is_cur = F.col(half) == ref, F.col(half) == cur
    x = F.col("x")
    st = long.where(is_ref | is_cur).groupBy("feature").agg(
        F.count(F.when(is_ref, 1)).alias("__rows_ref"), F.count(F.when(is_cur, 1)).alias("__rows_cur"),
        F.count(F.when(is_ref, x)).alias("n_ref"), F.count(F.when(is_cur, x)).alias("n_current"),
        F.avg(F.when(is_ref, x)).alias("train_mean"), F.stddev_pop(F.when(is_ref, x)).alias("train_std"),
        F.avg(F.when(is_cur, x)).alias("current_mean"), F.stddev_pop(F.when(is_cur, x)).alias("current_std"),
        F.min(F.when(is_ref, x)).alias("lo"), F.max(F.when(is_ref, x)).alias("hi"))
    st = st.where((F.col("n_ref") > 0) & (F.col("n_current") > 0)).withColumns({
        "train_missing_rate": F.lit(1.0) - F.col("n_ref") / F.col("__rows_ref"),
        "current_missing_rate": F.lit(1.0) - F.col("n_current") / F.col("__rows_cur")})
    ch = F.abs(F.col("current_missing_rate") - F.col("train_missing_rate"))
    st = st.withColumn("absolute_change", ch).withColumn("missing_alert", ch >= missing_limit)
    width = F.col("hi") - F.col("lo")
    raw = F.floor((x - F.col("lo")) * (F.lit(float(bins)) / width)).cast("int")
    bin_of = F.when((x < F.col("lo")) | (x > F.col("hi")), None).when(width == 0, F.lit(0)) \
        .when(x == F.col("hi"), F.lit(bins - 1)).otherwise(F.least(raw, F.lit(bins - 1)))
    rng = st.select("feature", "lo", "hi")  # one row per feature
    binned = long.where((is_ref | is_cur) & x.isNotNull()).join(F.broadcast(rng), "feature") \
        .select("feature", bin_of.alias("bin"), is_ref.alias("__r")).where(F.col("bin").isNotNull())
    per_bin = binned.groupBy("feature", "bin").agg(F.count(F.when(F.col("__r"), 1)).alias("e"),
                                                   F.count(F.when(~F.col("__r"), 1)).alias("a"))
    grid = st.select("feature", "n_ref", "n_current", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    g = grid.join(per_bin, ["feature", "bin"], "left")
    e = F.coalesce(F.col("e"), F.lit(0)) / F.col("n_ref") + eps
    a = F.coalesce(F.col("a"), F.lit(0)) / F.col("n_current") + eps
    p = g.groupBy("feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
    return st.join(p, "feature").select(
        "feature", "train_missing_rate", "current_missing_rate", "absolute_change", "missing_alert",
        "train_mean", "train_std", "current_mean", "current_std", "n_current", "psi")


# ---- D6: PSI over the last N values of a feature ----

def bin_profile(ref: DataFrame, bins: int = 10) -> DataFrame:
    """One row per feature of (feature, x): range, and the shares of the
    values in each of ``bins`` equal-width bins, as an array."""
    r = ref.where(F.col("x").isNotNull())
    rng = r.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n_ref"))
    hits = binned(r, rng, bins).groupBy("feature").agg(
        *[F.count(F.when(F.col("bin") == i, 1)).alias(f"__c{i}") for i in range(bins)])
    shares = F.array(*[F.col(f"__c{i}") / F.col("n_ref") for i in range(bins)])
    return rng.join(hits, "feature").select("feature", "lo", "hi", shares.alias("shares"))


def binned(long: DataFrame, profile: DataFrame, bins: int = 10) -> DataFrame:
    """long with ``bin``, -1 outside the profile's range; values that are
    NULL or of a feature without a profile are left out.  The profile has
    one row per feature and is broadcast by that bound."""
    x, lo, hi = F.col("x"), F.col("lo"), F.col("hi")
    raw = F.floor((x - lo) * (F.lit(float(bins)) / (hi - lo))).cast("int")
    b = F.when((x < lo) | (x > hi), -1).when(lo == hi, 0).when(x == hi, bins - 1).otherwise(F.least(raw, F.lit(bins - 1)))
    ranges = F.broadcast(profile.select("feature", "lo", "hi"))
    return long.where(x.isNotNull()).join(ranges, "feature").select(*long.columns, b.cast("int").alias("bin"))


def psi_of_counts(counts: Sequence[Column], n: Column, shares: Column, eps: float = 1e-8) -> Column:
    """PSI of bin counts out of ``n`` against an array of shares."""
    total = F.lit(0.0)
    for i, c in enumerate(counts):
        a, e = c / n + eps, F.get(shares, F.lit(i)) + eps
        total = total + (a - e) * F.log(a / e)
    return total


def last_n_psi(cur: DataFrame, profile: DataFrame, order_cols: Sequence[str], n: int = 100, bins: int = 10,
               keep: Sequence[str] = ()) -> DataFrame:
    """At each value of (feature, x, order columns), the PSI of the
    feature's last ``n`` values against the profile, from n/2 values on:
    (feature, *keep, n_window, psi).  Rolling counts come from range
    partitions with copies of the n rows before (``halo``)."""
    from fathom.operators.halo import last_sums
    names = [f"__c{i}" for i in range(bins)]
    rows = binned(cur, profile, bins).select("feature", *dict.fromkeys([*order_cols, *keep]), "bin")
    sums = last_sums(rows, order_cols, {c: (F.col("bin") == i).cast("long") for i, c in enumerate(names)}, n, ["feature"])
    full = sums.where(F.col("n_rows") >= n // 2).join(F.broadcast(profile.select("feature", "shares")), "feature")
    psi_col = psi_of_counts([F.col(c) for c in names], F.col("n_rows"), F.col("shares"))
    return full.select("feature", *keep, F.col("n_rows").alias("n_window"), psi_col.alias("psi"))


def retrain_triggers(psi_by_feature: DataFrame, baseline_rmse: DataFrame, current_rmse: DataFrame, new_labels: DataFrame,
                     psi_limit: float = 0.2, rise: float = 0.10, least_labels: int = 1000) -> DataFrame:
    """One row with the reasons to retrain: the largest PSI beyond its
    limit, the RMSE risen by more than ``rise`` over the baseline, at least
    ``least_labels`` new labels; ``retrain`` if any holds.  Inputs are a
    (feature, psi) table and one-row tables ``rmse``, ``rmse`` and ``n``."""
    p = psi_by_feature.agg(F.max("psi").alias("max_psi"))
    j = p.crossJoin(baseline_rmse.select(F.col("rmse").alias("baseline_rmse"))) \
        .crossJoin(current_rmse.select(F.col("rmse").alias("current_rmse"))).crossJoin(new_labels.select(F.col("n").alias("n_new_labels")))
    on = lambda c: F.coalesce(c, F.lit(False))
    j = j.withColumns({"psi_trigger": on(F.col("max_psi") > psi_limit),
                       "rmse_trigger": on(F.col("current_rmse") > (1 + rise) * F.col("baseline_rmse")),
                       "label_trigger": on(F.col("n_new_labels") >= least_labels)})
    return j.withColumn("retrain", F.col("psi_trigger") | F.col("rmse_trigger") | F.col("label_trigger"))
