"""Survival statistics (V1-V5, V8): Kaplan-Meier, Nelson-Aalen, log-rank,
censoring summary and Harrell's C.

Each estimator works on counts per distinct time (events d, censored c)
followed by running sums over time (``ordered.running_totals``): the
number of distinct times never has to fit in one task, and a group that
holds a third of the subjects is split across tasks by the range
partitioning inside ``running_totals``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.operators.ordered import running_totals


def time_counts(df: DataFrame, duration: str, event: str, group_cols: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_cols, F.col(duration).alias("time")).agg(
        F.sum(F.col(event).cast("long")).alias("d"),
        F.sum((1 - F.col(event)).cast("long")).alias("c"))


def kaplan_meier(df: DataFrame, duration: str, event: str, group_cols: Sequence[str] = (), z: float = 1.96) -> DataFrame:
    """V1/V2/V4: per (group, distinct time): at risk, events, censored,
    S(t) = prod(1 - d/n), Greenwood standard error and a plain 95% band,
    Nelson-Aalen H(t) = sum d/n.  S is 0 from the first time where every
    subject at risk has the event."""
    tc = time_counts(df, duration, event, group_cols)
    tot = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("N"))
    gone = running_totals(tc, ["time"], {"removed_before": F.col("d") + F.col("c")}, group_cols, inclusive=False)
    j = gone.join(tot, list(group_cols), "left") if group_cols else gone.crossJoin(F.broadcast(tot))
    j = j.withColumn("n_at_risk", F.col("N") - F.col("removed_before"))
    n, d = F.col("n_at_risk").cast("double"), F.col("d").cast("double")
    terms = {
        "log_s": F.when(d < n, F.log(1 - d / n)).otherwise(F.lit(0.0)),
        "zero": (d >= n).cast("long"),
        "gw": F.when(d < n, d / (n * (n - d))).otherwise(F.lit(0.0)),
        "na": d / n,
    }
    run = running_totals(j, ["time"], terms, group_cols)
    s = F.when(F.col("zero") > 0, F.lit(0.0)).otherwise(F.exp("log_s"))
    out = run.withColumn("survival", s).withColumn("se", F.col("survival") * F.sqrt("gw"))
    return out.select(*group_cols, "time", "n_at_risk", F.col("d").alias("n_events"), F.col("c").alias("n_censored"),
                      "survival", "se",
                      F.greatest(F.lit(0.0), F.col("survival") - z * F.col("se")).alias("lower"),
                      F.least(F.lit(1.0), F.col("survival") + z * F.col("se")).alias("upper"),
                      F.col("na").alias("cumulative_hazard"))


def median_survival(curve: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Smallest time with S(t) <= 0.5; NULL when the curve never gets there."""
    g = curve.groupBy(*group_cols) if group_cols else curve
    return g.agg(F.min(F.when(F.col("survival") <= 0.5, F.col("time"))).alias("median_time"))


def logrank(df: DataFrame, duration: str, event: str, group_col: str, first_level) -> DataFrame:
    """V3: two-group log-rank statistic (chi-square, 1 d.o.f.)."""
    g1 = (F.col(group_col) == F.lit(first_level)).cast("long")
    tc = df.groupBy(F.col(duration).alias("time")).agg(
        F.sum(F.col(event).cast("long")).alias("d"), F.count(F.lit(1)).alias("r"),
        F.sum(F.col(event).cast("long") * g1).alias("d1"), F.sum(g1).alias("r1"))
    n_all = df.agg(F.count(F.lit(1)).alias("N"), F.sum(g1).alias("N1"))
    gone = running_totals(tc, ["time"], {"rem": F.col("r"), "rem1": F.col("r1")}, inclusive=False)
    j = gone.crossJoin(F.broadcast(n_all))
    n = (F.col("N") - F.col("rem")).cast("double")
    n1 = (F.col("N1") - F.col("rem1")).cast("double")
    d = F.col("d").cast("double")
    e1 = d * n1 / n
    v = F.when(n > 1, d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1)).otherwise(F.lit(0.0))
    agg = j.agg(F.sum("d1").alias("observed_1"), F.sum(e1).alias("expected_1"), F.sum(v).alias("variance"))
    return agg.withColumn("statistic", F.pow(F.col("observed_1") - F.col("expected_1"), 2) / F.col("variance"))


def censoring_summary(df: DataFrame, duration: str, event: str) -> DataFrame:
    """V5: counts, censoring rate, complete-case mean, all-as-events mean."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(event).cast("long")).alias("n_events"),
                  (1 - F.avg(F.col(event).cast("double"))).alias("censoring_rate"),
                  F.avg(F.when(F.col(event) == 1, F.col(duration))).alias("mean_of_events"),
                  F.avg(duration).alias("mean_ignoring_censoring"))


def c_index(df: DataFrame, duration: str, event: str, risk: str) -> DataFrame:
    """V8: Harrell's C, exact for any number of distinct risks.  A pair
    (i, j) is comparable when T_i < T_j and i had the event; it is
    concordant when risk_i > risk_j and counts 1/2 on a risk tie.

    Risks become dense ranks r.  r_j < r_i exactly when, at the highest bit
    b where they differ, r_i has 1 and r_j has 0, i.e. when
    r_j >> b = (r_i >> b) - 1 for a b with bit b of r_i set.  So with
    later(b, node, t) = #{j: T_j > t, r_j >> b = node} the concordant count
    of an event at (t, r) is a sum over at most log2(#ranks) levels; the
    comparable count (level -1, one node) and the tied count (level -2,
    node r) are the same kind of lookup.  All lookups come from one running
    count over time per (level, node) (``running_totals``, which splits a
    big node across tasks); no pair is ever formed: O(n log #ranks) rows."""
    from fathom.operators.ordered import row_numbers
    s = df.where(F.col(duration).isNotNull())
    lv = s.select(risk).distinct()
    ranked = row_numbers(lv, [risk], name="__rk").select(risk, (F.col("__rk") - 1).alias("__r"))
    n_ranks = ranked.count()
    n_bits = max(1, (max(n_ranks, 1) - 1).bit_length())
    s = s.join(ranked, risk).select(F.col(duration).alias("time"), "__r", F.col(event).alias("__e"))
    per = s.groupBy("time", "__r").agg(F.count(F.lit(1)).alias("cnt"), F.sum((F.col("__e") == 1).cast("long")).alias("m"))
    bits = F.sequence(F.lit(0), F.lit(n_bits - 1))
    r = F.col("__r").cast("long")

    def by_level(frame, *keep):
        """One row per (level, rank) for levels -1, -2 and the bits."""
        lv = F.concat(F.array(F.struct(F.lit(-1).alias("b"), F.lit(0).cast("long").alias("node")),
                              F.struct(F.lit(-2).alias("b"), r.alias("node"))),
                      F.transform(bits, lambda x: F.struct(x.alias("b"), r.alias("node"))))
        return frame.select(*keep, F.explode(lv).alias("k")).select(*keep, "k.b", "k.node")
    shifted = F.expr("shiftright(node, b)")
    # count rows: every (time, rank) count once per level, keyed by its node there
    counts = by_level(per, "time", "cnt").withColumn("node", F.when(F.col("b") >= 0, shifted).otherwise(F.col("node"))) \
        .groupBy("b", "node", "time").agg(F.sum("cnt").alias("cnt"))
    # lookups: an event (time, rank) with m events asks later() at the node just
    # below its own on every level where its bit is set
    asks = by_level(per.where(F.col("m") > 0), "time", "m") \
        .where((F.col("b") < 0) | ((shifted % 2) == 1)) \
        .withColumn("node", F.when(F.col("b") >= 0, shifted - 1).otherwise(F.col("node")))
    u = counts.unionByName(asks.select("b", "node", "time", F.lit(0).cast("long").alias("cnt")))
    cum = running_totals(u, ["time"], {"cum": F.col("cnt")}, ["b", "node"]) \
        .groupBy("b", "node", "time").agg(F.max("cum").alias("cum"))
    tot = counts.groupBy("b", "node").agg(F.sum("cnt").alias("tot"))
    later = cum.join(tot, ["b", "node"]).select("b", "node", "time", (F.col("tot") - F.col("cum")).alias("later"))
    j = asks.join(later, ["b", "node", "time"])
    w = F.col("m") * F.col("later")
    agg = j.agg(F.coalesce(F.sum(F.when(F.col("b") >= 0, w)), F.lit(0)).alias("concordant"),
                F.coalesce(F.sum(F.when(F.col("b") == -2, w)), F.lit(0)).alias("tied"),
                F.coalesce(F.sum(F.when(F.col("b") == -1, w)), F.lit(0)).alias("comparable"))
    return agg.select("concordant", "tied", "comparable",
                      F.try_divide(F.col("concordant") + 0.5 * F.col("tied"), F.col("comparable")).alias("c_index"),
                      F.lit(True).alias("exact"))
