"""Neighbouring rows of an ordered table: lags and last-N sums without a
single-task window (J12, D6).

``lag(x, 48)`` over one ordered series is one partition for Spark, so one
task.  ``with_halo`` cuts the series into range partitions instead and gives
each partition copies of the ``n`` rows that come before it, from as many
earlier partitions as hold them.  A window inside a partition then sees all
it needs.  Copied rows are few: at most ``n`` a partition, since only the
first group of a partition can have begun in an earlier one; the table of
such beginnings has at most one row a partition and is broadcast by that
bound.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.operators.ordered import _partitions
from fathom.session import cut_lineage

SLICE, NUMBER, COPY = "__slice", "__number", "__copy"


def with_halo(df: DataFrame, order_cols: Sequence[str], n: int, group_cols: Sequence[str] = (),
              num_partitions: int | None = None) -> DataFrame:
    """Rows of df with their 1-based ``__number`` in the group, the
    ``__slice`` they belong to and ``__copy`` false, and copies (``__copy``
    true) of the up to ``n`` rows of the group before each slice's first.

    The order columns must make the order total.  NULL is a group of its
    own and sorts first, as in a window."""
    groups = list(group_cols)
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    ranged = df.repartitionByRange(_partitions(df, num_partitions), *[F.col(c).asc_nulls_first() for c in groups], *order)
    # the sampled bounds differ from run to run: fixed once for the three reads below
    part = cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))
    inside = Window.partitionBy(SLICE, *groups)
    sizes = part.groupBy(SLICE, *groups).agg(F.count(F.lit(1)).alias("__size"))
    earlier = F.sum("__size").over(Window.partitionBy(*groups).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1))
    begun = sizes.select(F.col(SLICE).alias("__into"), *[F.col(c).alias(f"__g{i}") for i, c in enumerate(groups)],
                         earlier.alias("__earlier")).where("__earlier > 0")
    same = F.lit(True)
    for i, c in enumerate(groups):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    numbered = part.withColumn("__at", F.row_number().over(inside.orderBy(*order))) \
        .join(F.broadcast(begun), (F.col(SLICE) == F.col("__into")) & same, "left") \
        .withColumn(NUMBER, F.col("__at") + F.coalesce("__earlier", F.lit(0)))
    own = numbered.select(*df.columns, SLICE, NUMBER, F.lit(False).alias(COPY))
    tails = numbered.withColumn("__size", F.count(F.lit(1)).over(inside)).where(F.col("__at") > F.col("__size") - n) \
        .select(*df.columns, F.col(SLICE).alias("__from"), NUMBER)
    reached = (F.col("__into") > F.col("__from")) & F.col(NUMBER).between(F.col("__earlier") - (n - 1), F.col("__earlier"))
    copies = tails.join(F.broadcast(begun), reached & same) \
        .select(*df.columns, F.col("__into").alias(SLICE), NUMBER, F.lit(True).alias(COPY))
    return own.unionByName(copies)


def _window(groups: Sequence[str]):
    return Window.partitionBy(SLICE, *groups).orderBy(NUMBER)


def lagged(df: DataFrame, order_cols: Sequence[str], value: str, lags: Sequence[int], group_cols: Sequence[str] = (),
           prefix: str = "lag_", num_partitions: int | None = None) -> DataFrame:
    """df with ``{prefix}{k}``: ``value`` k rows before in the group."""
    near = with_halo(df, order_cols, max(lags), group_cols, num_partitions)
    w = _window(group_cols)
    cols = [F.lag(value, k).over(w).alias(f"{prefix}{k}") for k in lags]
    return near.select(*df.columns, COPY, *cols).where(~F.col(COPY)).drop(COPY)


def last_sums(df: DataFrame, order_cols: Sequence[str], sums: Mapping[str, Column], n: int,
              group_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """df with the sum of each expression over the last ``n`` rows of the
    group (fewer at its start), and ``n_rows``, how many those are.

    A running sum minus the running sum n rows before: constant work a row
    whatever n.  The expressions should be whole numbers (counts), whose
    differences are exact."""
    base = df.select("*", *[e.alias(f"__s_{k}") for k, e in sums.items()])
    near = with_halo(base, order_cols, n, group_cols, num_partitions)
    w = _window(group_cols)
    run = near.select("*", *[F.sum(F.coalesce(F.col(f"__s_{k}"), F.lit(0))).over(w).alias(f"__r_{k}") for k in sums])
    out = run.select(*df.columns, COPY, F.least(F.col(NUMBER), F.lit(n)).cast("int").alias("n_rows"),
                     *[(F.col(f"__r_{k}") - F.coalesce(F.lag(f"__r_{k}", n).over(w), F.lit(0))).alias(k) for k in sums])
    return out.where(~F.col(COPY)).drop(COPY)


def autocorrelation(df: DataFrame, order_cols: Sequence[str], value: str, max_lag: int = 48,
                    num_partitions: int | None = None) -> DataFrame:
    """(lag, acf) for lags 1 to ``max_lag`` of the centred series:
    sum r_t r_(t-k) over sum r_t^2, NULL for a constant series.  Rows
    without a value are left out before the lags are taken."""
    mean = df.agg(F.avg(value).alias("__mean"))
    r = df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(mean)) \
        .select(*order_cols, (F.col(value) - F.col("__mean")).alias("__r"))
    lags = range(1, max_lag + 1)
    rows = lagged(r, order_cols, "__r", lags, num_partitions=num_partitions)
    total = rows.agg(F.sum(F.col("__r") * F.col("__r")).alias("__t"),
                     *[F.coalesce(F.sum(F.col("__r") * F.col(f"lag_{k}")), F.lit(0.0)).alias(f"__p{k}") for k in lags])
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"__p{k}"), F.col("__t")).alias("acf"))
                                for k in lags]))
    return total.select(pairs.alias("p")).select("p.lag", "p.acf")
