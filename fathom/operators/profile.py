"""Profiling, data quality and contracts (Q1-Q25).

Each report is one aggregate pass over the table (all columns at once),
then reshaped to one row per column with ``stack``/``explode``; there is no
driver loop over columns.  Category reports unpivot to (column, value)
pairs first so partial aggregation happens map-side before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.functions.numeric import bias_adjusted_kurt, bias_adjusted_skew, exact_mean, flag

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _per_column(df: DataFrame, cols: Sequence[str], make: callable) -> DataFrame:
    """One aggregate producing a struct per column, exploded to rows."""
    structs = [F.struct(F.lit(c).alias("column_name"), *make(c)).alias(f"__s{i}") for i, c in enumerate(cols)]
    agg = df.agg(*structs)
    return agg.select(F.explode(F.array(*[F.col(f"__s{i}") for i in range(len(cols))])).alias("s")).select("s.*")


def missingness_report(df: DataFrame, cols: Sequence[str] | None = None, distinct: bool = True,
                       approx_distinct: bool = False) -> DataFrame:
    """Q1/Q2: per column dtype, missing count and rate, distinct count."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def make(c):
        out = [F.lit(types[c]).alias("dtype"),
               (F.count(F.lit(1)) - F.count(F.col(c))).alias("n_missing"),
               (F.lit(1.0) - F.count(F.col(c)) / F.count(F.lit(1))).alias("missing_rate")]
        if distinct:
            out.append((F.approx_count_distinct(c) if approx_distinct else F.countDistinct(c)).alias("n_distinct"))
        return out

    return _per_column(df, cols, make)


def numeric_summary(df: DataFrame, cols: Sequence[str], exact_means: bool = False) -> DataFrame:
    """Q4: count, mean, sample std, min, quartiles (exact), max.  With
    ``exact_means`` the mean comes from an exact decimal sum, so it does not
    depend on the order rows are summed in (``numeric.exact_mean``)."""
    from fathom.operators.ordered import column_quantiles

    def make(c):
        mean = exact_mean(c) if exact_means else F.avg(c).cast("double")
        return [F.count(c).alias("count"), mean.alias("mean"),
                F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")]
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75]).select(
        "column_name", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(["q25", "q50", "q75"])])
    return _per_column(df, cols, make).join(q, "column_name", "left") \
        .select("column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def unpivot_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) pairs for text columns (A12 long reshape)."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                         for c in cols])).alias("p")).select("p.*")


def categorical_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q5: distinct count, top value and its count; ties go to the smaller value."""
    counts = unpivot_text(df, cols).where(F.col("value").isNotNull()) \
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_distinct"),
        F.min_by("value", F.struct((-F.col("cnt")).alias("nc"), F.col("value").alias("v"))).alias("top"),
        F.max("cnt").alias("top_count"),
    )


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q7/Q8: count and share of each value per column (NULLs left out)."""
    pairs = unpivot_text(df, cols).where(F.col("value").isNotNull())
    counts = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("column_name").agg(F.sum("count").alias("__tot"))
    return counts.join(F.broadcast(totals), "column_name").withColumn("share", F.col("count") / F.col("__tot")).drop("__tot")


def linspace(n: int) -> list[float]:
    return [i / (n - 1) for i in range(n)]


def training_profile(df: DataFrame, cols: Sequence[str], n_quantiles: int = 100) -> DataFrame:
    """Q6: mean, population std, min, max and ``n_quantiles`` exact quantiles
    at linspace(0, 1, n) per numeric column: the compact drift reference.
    Moments come from one aggregate; quantiles from the distributed exact
    path (``ordered.exact_quantiles``) on the unpivoted values."""
    from fathom.operators.ordered import quantiles
    probs = linspace(n_quantiles)

    def make(c):
        return [F.count(c).alias("n"), F.avg(c).cast("double").alias("mean"), F.stddev_pop(c).alias("std"),
                F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")]
    moments = _per_column(df, cols, make)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"))
                                         for c in cols])).alias("p")).select("p.*")
    q = quantiles(long, "x", probs, ["column_name"]).drop("n_values")
    return moments.join(q, "column_name", "left")


def skew_kurtosis(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q9: bias-adjusted skewness G1 and excess kurtosis G2."""
    def make(c):
        n = F.count(c)
        return [bias_adjusted_skew(F.skewness(c), n).alias("skewness"),
                bias_adjusted_kurt(F.kurtosis(c), n).alias("kurtosis")]
    return _per_column(df, cols, make)


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """IQR fences (exact quartiles) and the count outside per column."""
    from fathom.operators.ordered import column_quantiles
    fences = column_quantiles(df, cols, [0.25, 0.75]) \
        .select("column_name", F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("q3"))
    fences = fences.withColumn("lower", F.col("q1") - k * (F.col("q3") - F.col("q1"))) \
        .withColumn("upper", F.col("q3") + k * (F.col("q3") - F.col("q1")))
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"))
                                          for c in cols])).alias("p")).select("p.*")
    j = pairs.join(F.broadcast(fences), "column_name")  # one row per column
    cnt = j.groupBy("column_name").agg(F.sum(flag((F.col("x") < F.col("lower")) | (F.col("x") > F.col("upper"))))
                                  .cast("long").alias("n_outliers"))
    return fences.join(cnt, "column_name")


def zscore_flags(df: DataFrame, cols: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Flag rows where any feature has |z| > limit (population std)."""
    stats = df.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"__s_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))
    z = F.array(*[F.abs(F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}"))) for c in cols])
    j = j.withColumn("is_outlier", F.exists(z, lambda v: F.coalesce(v > limit, F.lit(False))))
    return j.drop(*[f"__m_{c}" for c in cols], *[f"__s_{c}" for c in cols])


def leakage_audit(df: DataFrame, target: str, terms: Sequence[str], corr_limit: float = 0.9) -> DataFrame:
    """Q19: per column, a name flag (suspicious term) and a correlation flag
    (|corr with target| > limit), from one aggregate of ``corr``."""
    cols = [c for c in df.columns if c != target]
    nums = set(numeric_columns(df))
    corrs = df.agg(*[(F.corr(F.col(c).cast("double"), F.col(target).cast("double")) if c in nums
                      else F.lit(None).cast("double")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = corrs.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, target_corr)")
    pattern = "|".join(re.escape(t) for t in terms)
    return long.withColumn("name_flag", F.lower(F.col("column_name")).rlike(pattern)) \
        .withColumn("corr_flag", F.coalesce(F.abs(F.col("target_corr")) > corr_limit, F.lit(False))) \
        .withColumn("suspicious", F.col("name_flag") | F.col("corr_flag"))


@dataclass(frozen=True)
class MissingRule:
    """A rule of the missing-data table: it holds for the named columns (all
    if None) whose missing rate is below ``below`` (any if None), and gives
    them a reason and a remedy."""

    reason: str
    remedy: str
    columns: tuple[str, ...] | None = None
    below: float | None = None


def missing_taxonomy(report: DataFrame, rules: Sequence[MissingRule]) -> DataFrame:
    """Q20: (column_name, missing_rate, reason, remedy) of the columns of a
    missingness report that lack values, from the first rule that holds;
    both NULL where none does.  The rules become a small table joined to the
    report (a row per column of the data): no branches in code."""
    spark = report.sparkSession
    table = spark.createDataFrame([(i, r.reason, r.remedy, list(r.columns) if r.columns is not None else None, r.below)
                                   for i, r in enumerate(rules)],
                                  "rule int, reason string, remedy string, columns array<string>, below double")
    holds = (F.col("columns").isNull() | F.array_contains("columns", F.col("column_name"))) \
        & (F.col("below").isNull() | (F.col("missing_rate") < F.col("below")))
    matched = report.where(F.col("n_missing") > 0).join(F.broadcast(table), holds, "left")
    return matched.groupBy("column_name", "missing_rate").agg(
        F.min_by(F.struct("reason", "remedy"), "rule").alias("__first")).select("column_name", "missing_rate", "__first.*")


def row_fingerprint_text(cols: Sequence[str], formats: Mapping[str, Column] | None = None) -> Column:
    """Row text for fingerprints: columns in sorted name order, joined by '|'."""
    formats = formats or {}
    return F.concat_ws("|", *[F.coalesce(formats.get(c, F.col(c).cast("string")), F.lit("")) for c in sorted(cols)])


def fingerprint(df: DataFrame, row_text: Column) -> DataFrame:
    """Q21: order-free dataset fingerprint: row count, XOR and sum of a
    32-bit row hash.  Same rows in any order or partitioning give the same
    result."""
    from fathom.functions.hashing import h32
    h = h32(row_text)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(h).alias("hash_xor"), F.sum(h).alias("hash_sum"))


def sum_constraint_share(df: DataFrame, parts: Sequence[str], lo: float = 95.0, hi: float = 105.0) -> DataFrame:
    """Q25: share of rows whose parts (NULL as 0) add up to within [lo, hi].
    The default limits are fixed values of the check (percentages)."""
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in parts), F.lit(0.0))
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(flag(total.between(lo, hi)).cast("double")).alias("share_in_range"))
