"""Learnt transforms (L1-L24): state is fitted on training rows as a small
table, then applied to any rows by a join.

State tables have one row per category level or per column.  Where the
level count is bounded (a category domain) they are broadcast explicitly;
otherwise the join is left to AQE, which broadcasts only when the runtime
size is under the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.numeric import safe_div
from fathom.operators.ordered import column_quantiles, quantile_row
from fathom.session import small_side

RARE_LABEL = "Rare"


# L1
def fit_rare_levels(df: DataFrame, col: str, min_count: int = 10) -> DataFrame:
    """Levels of ``col`` with at least ``min_count`` training rows."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= min_count).select(col)


def apply_rare_levels(df: DataFrame, kept: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Levels not kept at fit time (rare or unseen) become 'Rare'."""
    out = out or col
    k = kept.select(F.col(col).alias("__lvl"), F.lit(True).alias("__kept"))
    k = small_side(k)
    j = df.join(k, df[col] == F.col("__lvl"), "left")
    return j.withColumn(out, F.when(F.col(col).isNull(), F.lit(None).cast("string"))
                        .when(F.col("__kept"), F.col(col)).otherwise(F.lit(RARE_LABEL))) \
        .drop("__lvl", "__kept")


# L2
def fit_imputer(df: DataFrame, cols: Sequence[str], strategy: str = "median") -> DataFrame:
    """One-row state: fill value per column (median exact, mean, or mode)
    and whether the column had missing values in training (indicator)."""
    exprs = []
    for c in cols:
        if strategy == "median":
            pass  # exact medians come from the checked quantile path below
        elif strategy == "mean":
            exprs.append(F.avg(c).alias(f"fill_{c}"))
        elif strategy == "mode":
            exprs.append(F.mode(F.col(c), deterministic=True).alias(f"fill_{c}"))
        else:
            raise ValueError(strategy)
        exprs.append((F.count(F.lit(1)) > F.count(c)).alias(f"hasnull_{c}"))
    state = df.agg(*exprs)
    if strategy == "median":
        med = quantile_row(df, cols, [0.5], "__q_")
        state = state.crossJoin(med).select(*[x for c in cols for x in (F.col(f"__q_{c}")[0].alias(f"fill_{c}"),
                                                                          F.col(f"hasnull_{c}"))])
    return state


def apply_imputer(df: DataFrame, state: DataFrame, cols: Sequence[str], indicator: bool = True) -> DataFrame:
    j = df.crossJoin(F.broadcast(state))  # one row
    new = {c: F.coalesce(F.col(c), F.col(f"fill_{c}")) for c in cols}
    if indicator:
        for c in cols:
            new[f"{c}_missing"] = F.when(F.col(f"hasnull_{c}"), F.col(c).isNull().cast("int"))
    j = j.withColumns(new)
    return j.drop(*[f"fill_{c}" for c in cols], *[f"hasnull_{c}" for c in cols])


# L3
def fit_group_median(df: DataFrame, col: str, group_col: str) -> tuple[DataFrame, DataFrame]:
    per_group = column_quantiles(df, [col], [0.5], [group_col]).select(group_col, F.col("quantiles")[0].alias("__gmed"))
    overall = quantile_row(df, [col], [0.5], "__q_").select(F.col(f"__q_{col}")[0].alias("__med"))
    return per_group, overall


def apply_group_median(df: DataFrame, state: tuple[DataFrame, DataFrame], col: str, group_col: str,
                       out: str | None = None) -> DataFrame:
    per_group, overall = state
    out = out or col
    j = df.join(small_side(per_group), group_col, "left").crossJoin(F.broadcast(overall))
    return j.withColumn(out, F.coalesce(F.col(col), F.col("__gmed"), F.col("__med"))).drop("__gmed", "__med")


# L6
def fit_winsor(df: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    return quantile_row(df, cols, [lo, hi], "q_")


def apply_winsor(df: DataFrame, state: DataFrame, cols: Sequence[str]) -> DataFrame:
    j = df.crossJoin(F.broadcast(state))
    j = j.withColumns({c: F.least(F.greatest(F.col(c), F.col(f"q_{c}")[0]), F.col(f"q_{c}")[1]) for c in cols})
    return j.drop(*[f"q_{c}" for c in cols])


# L7
def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str = "standard") -> DataFrame:
    """standard: mean / population std; robust: median / IQR; minmax: min / range."""
    exprs = []
    if kind == "robust":
        q = quantile_row(df, cols, [0.25, 0.5, 0.75], "__q_")
        return q.select(*[x for c in cols for x in (F.col(f"__q_{c}")[1].alias(f"c_{c}"),
                                                     (F.col(f"__q_{c}")[2] - F.col(f"__q_{c}")[0]).alias(f"s_{c}"))])
    for c in cols:
        if kind == "standard":
            exprs += [F.avg(c).alias(f"c_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
        elif kind == "minmax":
            exprs += [F.min(c).alias(f"c_{c}"), (F.max(c) - F.min(c)).alias(f"s_{c}")]
        else:
            raise ValueError(kind)
    return df.agg(*exprs)


def apply_scaler(df: DataFrame, state: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """A zero scale is guarded: the column is only centred (scale 1)."""
    j = df.crossJoin(F.broadcast(state))
    scale = {c: F.when(F.col(f"s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"s_{c}")) for c in cols}
    j = j.withColumns({f"{c}{suffix}": (F.col(c) - F.col(f"c_{c}")) / scale[c] for c in cols})
    return j.drop(*[f"c_{c}" for c in cols], *[f"s_{c}" for c in cols])


# L8-L10
def fit_levels(df: DataFrame, col: str, min_frequency: int = 1) -> DataFrame:
    """Level table with alphabetical code (L10) for levels seen at least
    ``min_frequency`` times; the rest are pooled (L8)."""
    from fathom.operators.ordered import row_numbers
    lv = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= min_frequency)
    return row_numbers(lv, [col], name="code").withColumn("code", F.col("code") - 1)


def apply_ordinal(df: DataFrame, levels: DataFrame, col: str, out: str) -> DataFrame:
    """Ordinal code, unknown = -1."""
    lv = levels.select(F.col(col).alias("__lvl"), F.col("code").alias("__code"))
    j = df.join(small_side(lv), df[col] == F.col("__lvl"), "left")
    return j.withColumn(out, F.coalesce(F.col("__code"), F.lit(-1)).cast("int")).drop("__lvl", "__code")


def fit_one_hot(df: DataFrame, col: str, min_frequency: int = 1, drop: str | None = None,
                max_levels: int = 1000) -> tuple[DataFrame, list]:
    """L8/L9 state: the level counts, and the levels that get an indicator in
    alphabetical order.  Indicators are columns, so more than ``max_levels``
    of them is an error.  ``drop='first'`` leaves out the first level,
    ``drop='if_binary'`` the first of exactly two."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    kept = [r[0] for r in counts.where(F.col("__n") >= min_frequency).orderBy(col).limit(max_levels + 1).collect()]
    if len(kept) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels")
    if drop == "first" or (drop == "if_binary" and len(kept) == 2):
        kept = kept[1:]
    return counts.withColumn("__rare", F.col("__n") < min_frequency), kept


def apply_one_hot(df: DataFrame, state: tuple[DataFrame, list], col: str) -> DataFrame:
    """Indicator columns ``<col>_<level>``, and ``<col>_infrequent`` for the
    pooled levels below the minimum frequency; levels not seen in the fit and
    NULL give all zeros."""
    counts, kept = state
    rare = small_side(counts.where("__rare").select(F.col(col).alias("__lvl"), F.lit(1).alias("__r")))
    j = df.join(rare, df[col] == F.col("__lvl"), "left")
    new = {f"{col}_{v}": F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)) for v in kept}
    return j.withColumns(new | {f"{col}_infrequent": F.coalesce("__r", F.lit(0))}).drop("__lvl", "__r")


# L11-L12
def fit_target_encoding(df: DataFrame, col: str, target: str, smoothing: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """Per level: (n * mean + s * global) / (n + s).  Returns (levels, global)."""
    glob = df.where(F.col(target).isNotNull()).agg(F.avg(target).alias("__global"))
    lv = df.where(F.col(target).isNotNull()).groupBy(col).agg(
        F.count(F.lit(1)).alias("__n"), F.avg(target).alias("__mean"))
    lv = lv.crossJoin(F.broadcast(glob)).select(
        col, ((F.col("__n") * F.col("__mean") + F.lit(float(smoothing)) * F.col("__global"))
              / (F.col("__n") + F.lit(float(smoothing)))).alias("__enc"))
    return lv, glob


def apply_target_encoding(df: DataFrame, state: tuple[DataFrame, DataFrame], col: str, out: str) -> DataFrame:
    """Unknown or NULL level -> global mean."""
    lv, glob = state
    j = df.join(small_side(lv), col, "left").crossJoin(F.broadcast(glob))
    return j.withColumn(out, F.coalesce(F.col("__enc"), F.col("__global"))).drop("__enc", "__global")


def oof_target_encoding(df: DataFrame, col: str, target: str, fold_col: str, out: str,
                        smoothing: float = 10.0) -> DataFrame:
    """Each row is encoded with statistics of the other folds only:
    level totals minus own-fold sums, so no row sees its own target."""
    base = df.where(F.col(target).isNotNull())
    per_fold = base.groupBy(col, fold_col).agg(F.count(F.lit(1)).alias("__fn"), F.sum(target).alias("__fs"))
    per_level = base.groupBy(col).agg(F.count(F.lit(1)).alias("__ln"), F.sum(target).alias("__ls"))
    fold_tot = base.groupBy(fold_col).agg(F.count(F.lit(1)).alias("__tn"), F.sum(target).alias("__ts"))
    all_tot = base.agg(F.count(F.lit(1)).alias("__an"), F.sum(target).alias("__as"))
    s = F.lit(float(smoothing))
    j = (df.join(small_side(per_fold), [col, fold_col], "left").join(small_side(per_level), col, "left")
         .join(F.broadcast(fold_tot), fold_col, "left").crossJoin(F.broadcast(all_tot)))
    n_out = F.coalesce(F.col("__ln"), F.lit(0)) - F.coalesce(F.col("__fn"), F.lit(0))
    s_out = F.coalesce(F.col("__ls"), F.lit(0.0)) - F.coalesce(F.col("__fs"), F.lit(0.0))
    g_out = safe_div(F.col("__as") - F.coalesce(F.col("__ts"), F.lit(0.0)),
                     F.col("__an") - F.coalesce(F.col("__tn"), F.lit(0)))
    enc = (s_out + s * g_out) / (n_out + s)
    return j.withColumn(out, F.when(n_out > 0, enc).otherwise(g_out)) \
        .drop("__fn", "__fs", "__ln", "__ls", "__tn", "__ts", "__an", "__as")


# L13
def polynomial_columns(cols: Sequence[str], degree: int = 2, interaction_only: bool = False) -> dict[str, Column]:
    """All monomials of degree 1..degree (no bias), as column products."""
    from itertools import combinations, combinations_with_replacement
    out: dict[str, Column] = {}
    for d in range(1, degree + 1):
        combos = combinations(cols, d) if interaction_only else combinations_with_replacement(cols, d)
        for combo in combos:
            expr = F.lit(1.0)
            for c in combo:
                expr = expr * F.col(c)
            out["*".join(combo)] = expr
    return out


# L14
def bspline_columns(x: Column, knots: Sequence[float], degree: int = 3, prefix: str = "bs") -> dict[str, Column]:
    """B-spline basis of ``x`` by the Cox-de Boor recursion written as
    column expressions.  ``knots`` are the interior+boundary knots; the
    boundary knots are repeated ``degree`` times (clamped spline).  Outside
    the boundary the value is clipped to it."""
    k = list(knots)
    t = [k[0]] * degree + k + [k[-1]] * degree
    xc = F.least(F.greatest(x, F.lit(float(k[0]))), F.lit(float(k[-1])))
    m = len(t) - 1
    basis = []
    for i in range(m):
        if t[i] == t[i + 1]:
            basis.append(F.lit(0.0))
            continue
        is_last = (t[i + 1] == t[-1])
        cond = (xc >= F.lit(t[i])) & ((xc <= F.lit(t[i + 1])) if is_last else (xc < F.lit(t[i + 1])))
        basis.append(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))
    for d in range(1, degree + 1):
        nxt = []
        for i in range(m - d):
            left = F.lit(0.0) if t[i + d] == t[i] else (xc - F.lit(t[i])) / F.lit(t[i + d] - t[i]) * basis[i]
            right = F.lit(0.0) if t[i + d + 1] == t[i + 1] else \
                (F.lit(t[i + d + 1]) - xc) / F.lit(t[i + d + 1] - t[i + 1]) * basis[i + 1]
            nxt.append(left + right)
        basis = nxt
    return {f"{prefix}_{i}": b for i, b in enumerate(basis)}


# L23-L24
def f_scores(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Univariate F statistic of each feature against the target:
    F = r^2 / (1 - r^2) * (n - 2), in one aggregate."""
    agg = df.agg(F.count(F.lit(1)).alias("n"), *[F.corr(c, target).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = agg.selectExpr("n", f"stack({len(cols)}, {stack}) as (feature, r)")
    return long.withColumn("f_score", F.pow("r", 2) / (1 - F.pow("r", 2)) * (F.col("n") - 2))


def binned_mutual_information(df: DataFrame, x_bin: Column, y_bin: Column) -> DataFrame:
    """Mutual information (nats) from joint counts of two binned variables.
    A plug-in estimator on bins, not the k-NN estimator: documented."""
    j = df.select(x_bin.alias("xb"), y_bin.alias("yb")).where("xb IS NOT NULL AND yb IS NOT NULL")
    joint = j.groupBy("xb", "yb").agg(F.count(F.lit(1)).alias("nxy"))
    px = joint.groupBy("xb").agg(F.sum("nxy").alias("nx"))
    py = joint.groupBy("yb").agg(F.sum("nxy").alias("ny"))
    tot = joint.agg(F.sum("nxy").alias("n"))
    t = joint.join(px, "xb").join(py, "yb").crossJoin(F.broadcast(tot))
    return t.agg(F.sum(F.col("nxy") / F.col("n") * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny"))))
                 .alias("mutual_info"))

