"""Data contracts and row validation (Q11-Q18).

A contract is two small tables learnt from training rows: one row per
column (kind, missing rate, distinct count, min, max, quantiles) and the
allowed values of text columns (top 50 by count).  Validation joins
incoming (column, value) pairs to the contract; row validation builds a
reason array per row with column expressions, never a row loop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.hashing import h32
from fathom.functions.numeric import flag
from fathom.operators.ordered import column_quantiles
from fathom.operators.profile import numeric_columns

CONTRACT_QUANTILES = [0.01, 0.05, 0.5, 0.95, 0.99]


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], k: int,
                    tiebreak: str, buckets: int = 64) -> DataFrame:
    """Exact top-k rows per group without one task per group: rank inside
    (group, hash bucket of the tie-break column) first, keep k per bucket,
    then rank the <= k * buckets survivors per group."""
    b = (h32(F.col(tiebreak).cast("string")) % buckets).alias("__b")
    w1 = Window.partitionBy(*group_cols, "__b").orderBy(*order)
    stage = df.withColumn("__b", b).withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= k)
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    return stage.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k).drop("__b", "__r1")


def build_contract(train: DataFrame, cols: Sequence[str] | None = None,
                   top_n: int = 50) -> tuple[DataFrame, DataFrame]:
    """Q11: (column table, allowed-values table)."""
    cols = list(cols or train.columns)
    nums = set(numeric_columns(train))
    types = {f.name: f.dataType.simpleString() for f in train.schema.fields}
    structs = []
    for c in cols:
        is_num = c in nums
        x = F.col(c).cast("double") if is_num else F.lit(None).cast("double")
        structs.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("dtype"),
            F.lit("numeric" if is_num else "categorical").alias("kind"),
            (F.lit(1.0) - F.count(F.col(c)) / F.count(F.lit(1))).alias("missing_rate"),
            F.countDistinct(c).alias("unique_values"),
            F.min(x).alias("min"), F.max(x).alias("max"),
        ).alias(f"__s{len(structs)}"))
    table = train.agg(*structs).select(F.explode(F.array(*[F.col(f"__s{i}") for i in range(len(cols))])).alias("s")) \
        .select("s.*")
    # exact quantiles of the numeric columns from the checked quantile path (one row per column)
    qn = ["q01", "q05", "q50", "q95", "q99"]
    num_cols = [c for c in cols if c in nums]
    if num_cols:
        q = column_quantiles(train, num_cols, CONTRACT_QUANTILES) \
            .select("column_name", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(qn)])
        table = table.join(q, "column_name", "left")
    else:
        table = table.select("*", *[F.lit(None).cast("double").alias(n) for n in qn])
    table = table.select("column_name", "dtype", "kind", "missing_rate", "unique_values", "min", "max", *qn)
    texts = [c for c in cols if c not in nums]
    if texts:
        pairs = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                          F.col(c).cast("string").alias("value")) for c in texts]))
                             .alias("p")).select("p.*").where(F.col("value").isNotNull())
        counts = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
        allowed = top_k_per_group(counts, ["column_name"], [F.desc("count"), F.asc("value")], top_n, "value")
    else:
        allowed = train.sparkSession.createDataFrame([], "column_name string, value string, count long, rank int")
    return table, allowed


def validate_against_contract(incoming: DataFrame, contract: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Q12: per contract column present in the input: training and current
    missing rate and change; for numeric columns the share outside the
    training 1%-99% quantiles; for text the share of new or rare values
    (NULL counts as known).  Comparisons with NULL count as False while the
    row stays in the denominator."""
    table, allowed = contract
    present = set(incoming.columns)
    meta = table.where(F.col("column_name").isin(*present))
    pairs = incoming.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                 F.col(c).try_cast("double").alias("x")) for c in incoming.columns])).alias("p")).select("p.*")
    al = allowed.select("column_name", "value", F.lit(True).alias("__allowed"))
    # at most top_n allowed values per column
    j = pairs.join(F.broadcast(meta), "column_name").join(F.broadcast(al), ["column_name", "value"], "left")
    outside = (F.col("x") < F.col("q01")) | (F.col("x") > F.col("q99"))
    known = F.col("value").isNull() | F.col("__allowed").isNotNull()
    agg = j.groupBy("column_name", "kind", F.col("missing_rate").alias("training_missing_rate")).agg(
        (F.count(F.lit(1)) - F.count("value")).alias("__nm"), F.count(F.lit(1)).alias("__n"),
        F.avg(flag(outside).cast("double")).alias("__out"),
        F.avg(flag(~known).cast("double")).alias("__new"))
    cur = F.col("__nm") / F.col("__n")
    return agg.select(
        "column_name", "kind", "training_missing_rate", cur.alias("current_missing_rate"),
        F.abs(cur - F.col("training_missing_rate")).alias("missing_rate_change"),
        F.when(F.col("kind") == "numeric", F.col("__out")).alias("outside_1_99_share"),
        F.when(F.col("kind") == "categorical", F.col("__new")).alias("new_category_share"))


def column_status(incoming: DataFrame, required: Sequence[str]) -> DataFrame:
    """(column_name, status) for every column that is required or
    present: 'ok', 'missing' or 'extra' (schema metadata only)."""
    wanted = incoming.sparkSession.createDataFrame([(c,) for c in required], "column_name string").distinct()
    here = incoming.sparkSession.createDataFrame([(c,) for c in incoming.columns], "column_name string")
    both = wanted.withColumn("w", F.lit(True)).join(here.withColumn("h", F.lit(True)), "column_name", "full")
    return both.select("column_name", F.when(F.col("h").isNull(), "missing").when(F.col("w").isNull(), "extra")
                       .otherwise("ok").alias("status"))


def require_columns(incoming: DataFrame, required: Sequence[str]) -> None:
    """Q18: a missing required column is fatal."""
    missing = sorted(set(required) - set(incoming.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def schema_test(report: DataFrame, max_missing_rate: float = 0.35, max_new_share: float = 0.05) -> DataFrame:
    """Q14: boolean checks over a Q12 report (the new-category limit is
    checked, not only stored)."""
    return report.agg(
        F.bool_and(F.col("current_missing_rate") <= max_missing_rate).alias("missing_within_limit"),
        F.bool_and(F.coalesce(F.col("new_category_share") <= max_new_share, F.lit(True))).alias("new_categories_within_limit"),
        F.count(F.lit(1)).alias("n_columns_checked"))


def row_reasons(contract_table_row: Mapping[str, tuple], numeric: Sequence[str], text: Sequence[str],
                allowed_col: Mapping[str, str] | None = None) -> Column:
    """Reason array for one row; ``contract_table_row`` columns must be
    joined onto the row as ``__min_<c>``/``__max_<c>`` and the membership
    flags as ``__ok_<c>``."""
    reasons = []
    for c in numeric:
        reasons.append(F.when(F.col(c).isNull(), F.lit(f"{c}:missing")))
        reasons.append(F.when(F.col(c) < F.col(f"__min_{c}"), F.lit(f"{c}:below_train_min")))
        reasons.append(F.when(F.col(c) > F.col(f"__max_{c}"), F.lit(f"{c}:above_train_max")))
    for c in text:
        reasons.append(F.when(F.col(c).isNull(), F.lit(f"{c}:missing")))
        reasons.append(F.when(F.col(c).isNotNull() & F.col(f"__ok_{c}").isNull(), F.lit(f"{c}:unknown_category")))
    return F.slice(F.array_compact(F.array(*reasons)), 1, 10)


def validate_rows(incoming: DataFrame, contract: tuple[DataFrame, DataFrame], numeric: Sequence[str],
                  text: Sequence[str]) -> DataFrame:
    """Q13: each row with its reasons (at most 10) and an accepted flag."""
    table, allowed = contract
    bounds = table.where(F.col("column_name").isin(*numeric)).groupBy().pivot("column_name", list(numeric)) \
        .agg(F.first("min").alias("min"), F.first("max").alias("max"))
    rename = {}
    for c in numeric:
        rename[f"{c}_min"] = f"__min_{c}"
        rename[f"{c}_max"] = f"__max_{c}"
    bounds = bounds.withColumnsRenamed(rename)
    j = incoming.crossJoin(F.broadcast(bounds))  # one row
    for c in text:
        ok = allowed.where(F.col("column_name") == c).select(F.col("value").alias(f"__v_{c}"),
                                                             F.lit(True).alias(f"__ok_{c}"))
        j = j.join(F.broadcast(ok), j[c] == ok[f"__v_{c}"], "left").drop(f"__v_{c}")  # <= top_n rows
    j = j.withColumn("reasons", row_reasons({}, numeric, text))
    j = j.withColumn("accepted", F.size("reasons") == 0)
    drop = [f"__min_{c}" for c in numeric] + [f"__max_{c}" for c in numeric] + [f"__ok_{c}" for c in text]
    return j.drop(*drop)


def range_rule_failures(df: DataFrame, key_cols: Sequence[str], ranges: Mapping[str, tuple],
                        domains: Mapping[str, Sequence[str]] | None = None,
                        not_null: Sequence[str] = ()) -> DataFrame:
    """Q15/Q16: lazy validation, all failures as a long table
    (key..., column_name, rule)."""
    domains = domains or {}
    fails = []
    for c, (lo, hi) in ranges.items():
        if lo is not None:
            fails.append(F.when(F.col(c) < lo, F.struct(F.lit(c).alias("column_name"), F.lit(f"min {lo}").alias("rule"))))
        if hi is not None:
            fails.append(F.when(F.col(c) > hi, F.struct(F.lit(c).alias("column_name"), F.lit(f"max {hi}").alias("rule"))))
    for c, values in domains.items():
        fails.append(F.when(F.col(c).isNotNull() & ~F.col(c).isin(*values),
                            F.struct(F.lit(c).alias("column_name"), F.lit("domain").alias("rule"))))
    for c in not_null:
        fails.append(F.when(F.col(c).isNull(), F.struct(F.lit(c).alias("column_name"), F.lit("not null").alias("rule"))))
    arr = F.array_compact(F.array(*fails))
    return df.select(*key_cols, F.explode(arr).alias("f")).select(*key_cols, "f.column_name", "f.rule")


def quarantine_split(df: DataFrame, failures_flag: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected frames from one flag expression."""
    flagged = df.withColumn("__bad", failures_flag)
    return flagged.where(~F.col("__bad")).drop("__bad"), flagged.where(F.col("__bad")).drop("__bad")
