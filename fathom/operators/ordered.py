"""Exact running sums and row numbers without a single-task window.

A ``Window.orderBy`` with no partition moves every row to one task, and
``Window.partitionBy(g)`` moves a whole group to one task, which breaks when
one group holds a third of the data.  ``running_totals`` instead:

1. range-partitions on (group keys, order keys), which splits hot groups
   across tasks (the range bounds are sampled from the data);
2. computes running sums inside each (partition, group) slice;
   The partitioned rows are checkpointed once so both uses below see
   the same partitioning;
3. aggregates per-slice totals (<= partitions + groups rows) and turns them
   into offsets for the groups that began in an earlier partition.  Only the
   first group of a partition can continue from the previous one, so the
   offset table has at most ``num_partitions`` rows: broadcasting it is safe
   whatever the data size;
4. adds the offsets back.

The order keys must make the order total (add a unique key as the last
order column) for row numbers to be deterministic.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.session import cut_lineage


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def running_totals(df: DataFrame, order_cols: Sequence[str], sums: Mapping[str, Column],
                   group_cols: Sequence[str] = (), num_partitions: int | None = None,
                   inclusive: bool = True) -> DataFrame:
    """Add one column per entry of ``sums``: the running sum of that
    expression over rows of the same group in ``order_cols`` order
    (``inclusive`` includes the current row)."""
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    n = _partitions(df, num_partitions)
    names = list(sums)
    base = df.select("*", *[sums[k].alias(f"__v_{k}") for k in names])
    part = base.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in group_cols + order_cols]) \
        .withColumn("__pid", F.spark_partition_id())
    # The range bounds are sampled per shuffle, so two branches reading
    # ``part`` would each draw their own bounds.  A reliable checkpoint fixes
    # one partitioning for both branches and cuts the lineage (it survives
    # executor loss; localCheckpoint would not).
    part = cut_lineage(part)
    frame_end = Window.currentRow if inclusive else -1
    w = Window.partitionBy("__pid", *group_cols).orderBy(*order_cols) \
        .rowsBetween(Window.unboundedPreceding, frame_end)
    local = part.select("*", *[F.coalesce(F.sum(f"__v_{k}").over(w), F.lit(0)).alias(f"__l_{k}")
                               for k in names])
    totals = part.groupBy("__pid", *group_cols).agg(
        *[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in names])
    wo = Window.partitionBy(*group_cols).orderBy("__pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__pid", *group_cols,
        F.count(F.lit(1)).over(wo).alias("__earlier"),
        *[F.coalesce(F.sum(f"__t_{k}").over(wo), F.lit(0)).alias(f"__o_{k}") for k in names],
    ).where(F.col("__earlier") > 0).drop("__earlier")
    offsets = offsets.select(*[F.col(c).alias(f"__g_{c}") for c in ["__pid", *group_cols]],
                             *[f"__o_{k}" for k in names])
    cond = None
    for c in ["__pid", *group_cols]:
        e = local[c].eqNullSafe(offsets[f"__g_{c}"])  # NULL group keys keep their offsets
        cond = e if cond is None else cond & e
    joined = local.join(F.broadcast(offsets), cond, "left")
    out = joined.select(
        *[local[c] for c in df.columns],
        *[(F.col(f"__l_{k}") + F.coalesce(F.col(f"__o_{k}"), F.lit(0))).alias(k) for k in names],
    )
    return out


def row_numbers(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                name: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """1-based row number within ``group_cols`` in ``order_cols`` order."""
    return running_totals(df, order_cols, {name: F.lit(1).cast("long")}, group_cols,
                          num_partitions=num_partitions)


def ntile_of(rn: Column, n: Column, k: int) -> Column:
    """SQL ``ntile(k)`` from a 1-based row number and the group size: the
    first ``n % k`` tiles hold one extra row."""
    q = (n / F.lit(k)).cast("long")
    r = n % F.lit(k)
    big = r * (q + 1)
    return F.when(rn <= big, ((rn - 1) / (q + 1)).cast("long") + 1) \
        .otherwise(r + ((rn - big - 1) / F.greatest(q, F.lit(1))).cast("long") + 1).cast("int")


# A group's ranks are cut into this many buckets, the join key between needed
# ranks and running counts.
RANK_BUCKETS = 512


def exact_quantiles(long: DataFrame, value: str, probs: Sequence[float], group_cols: Sequence[str] = (),
                    out: str = "quantiles") -> DataFrame:
    """Exact quantiles with linear interpolation (``percentile`` /
    ``quantile_cont`` semantics) that never gather a column's distinct
    values in one task: counts per distinct value, running counts from
    ``running_totals``, then the needed ranks floor/ceil(p (n - 1)) meet the
    count interval that holds them.  Ranks and intervals are joined on
    (group, rank bucket): an interval lies in one bucket unless the value is
    very frequent, and there are at most 2 x len(probs) ranks per group, so
    the work per distinct value is one hash lookup.  Returns one row per
    group with the array column ``out``."""
    group_cols = list(group_cols)
    probs = [float(p) for p in probs]
    v = long.where(F.col(value).isNotNull()).groupBy(*group_cols, F.col(value).alias("__x")) \
        .agg(F.count(F.lit(1)).alias("__c"))
    cum = running_totals(v, ["__x"], {"__cum": F.col("__c")}, group_cols)
    # the inclusive running count peaks at the group size: no second pass over the values
    n = cum.groupBy(*group_cols).agg(F.max("__cum").alias("__n"))
    width = F.greatest(F.floor(F.col("__n") / RANK_BUCKETS), F.lit(1))
    sized = n.select(*[F.col(c).alias(f"__k_{c}") for c in group_cols], "__n", width.alias("__w"))
    parr = F.array(*[F.lit(p) for p in probs])
    needed = F.array_distinct(F.flatten(F.transform(
        parr, lambda p: F.array(F.floor(p * (F.col("__n") - 1)), F.ceil(p * (F.col("__n") - 1))))))
    ranks = sized.select(*[f"__k_{c}" for c in group_cols], "__w", F.explode(needed).alias("__rank")) \
        .select(*[F.col(f"__k_{c}").alias(f"__r_{c}") for c in group_cols], "__rank",
                F.floor(F.col("__rank") / F.col("__w")).alias("__b"))

    def same(prefix):
        cond = F.lit(True)
        for c in group_cols:
            cond = cond & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
        return cond

    first = F.col("__cum") - F.col("__c")
    spans = (cum.join(sized, same("__k_")) if group_cols else cum.crossJoin(F.broadcast(sized))) \
        .select(*group_cols, "__x", "__c", "__cum", F.explode(F.sequence(
            F.floor(first / F.col("__w")), F.floor((F.col("__cum") - 1) / F.col("__w")))).alias("__s"))
    hits = spans.join(ranks, (F.col("__s") == F.col("__b")) & same("__r_")) \
        .where((F.col("__rank") >= F.col("__cum") - F.col("__c")) & (F.col("__rank") < F.col("__cum"))) \
        .select(*group_cols, "__rank", "__x")
    per_group = hits.groupBy(*group_cols).agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__x"))).alias("__m"))
    k = (per_group.join(sized, same("__k_")) if group_cols else per_group.crossJoin(sized)) \
        .select(*group_cols, "__m", "__n")

    def interp(p):
        pos = p * (F.col("__n") - 1)
        lo = F.element_at("__m", F.floor(pos)).cast("double")
        hi = F.element_at("__m", F.ceil(pos)).cast("double")
        return lo + (pos - F.floor(pos)) * (hi - lo)
    return k.where("__m IS NOT NULL AND __n IS NOT NULL") \
        .select(*group_cols, F.col("__n").alias("n_values"), F.transform(parr, interp).alias(out))


quantiles = exact_quantiles


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group_cols: Sequence[str] = (),
                     out: str = "quantiles") -> DataFrame:
    """Exact quantiles of several columns (per group) in one plan: the
    columns are unpivoted to (column_name, value) and summarised by
    ``exact_quantiles``.  Returns (*group_cols, column_name, n_values, out);
    a column or group without values has no row."""
    group_cols = list(group_cols)
    long = df.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("__v")) for c in cols])).alias("__p")) \
        .select(*group_cols, "__p.column_name", "__p.__v")
    return exact_quantiles(long, "__v", probs, [*group_cols, "column_name"], out)


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float], prefix: str = "q_") -> DataFrame:
    """One-row state ``{prefix}{col}`` = array of exact quantiles per column
    (NULL for a column without values), from ``column_quantiles``."""
    q = column_quantiles(df, cols, probs)
    return q.agg(*[F.first(F.when(F.col("column_name") == c, F.col("quantiles")), ignorenulls=True).alias(f"{prefix}{c}")
                   for c in cols])
