"""Frames learnt on one table and applied to others (P2, L20, L21), row
filters (P9), side-by-side results (J3), short overviews (A11) and version
records (Q22, Q23)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.numeric import clean_double
from fathom.operators.ordered import exact_quantiles, quantile_row


def numeric_shares(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, n_nonnull, n_parsed) of text columns, from one aggregate."""
    parts = [F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n_nonnull"), F.count(F.col(c).try_cast("double")).alias("n_parsed"))
             for c in cols]
    return df.agg(F.array(*parts).alias("a")).select(F.explode("a").alias("s")).select("s.*")


def adaptive_cast(df: DataFrame, cols: Sequence[str], share: float = 0.8) -> DataFrame:
    """Df in which every text column of ``cols`` with more than ``share``
    of its values parsing is numeric (others NULL); the rest stay text."""
    parsed = [r["column_name"] for r in numeric_shares(df, cols).where(F.col("n_parsed") > share * F.col("n_nonnull")).collect()]
    return df.withColumns({c: clean_double(F.col(c).try_cast("double")) for c in parsed})


def within_fences(df: DataFrame, value: Column, k: float = 1.5) -> DataFrame:
    """Rows whose value lies within its quartile fences, with ``lower``
    and ``upper``; the value may be a target or its logarithm.  Rows without
    a value are left out."""
    q = exact_quantiles(df.select(value.alias("__v")), "__v", [0.25, 0.75], out="__q")
    fence = q.select((F.col("__q")[0] - k * (F.col("__q")[1] - F.col("__q")[0])).alias("lower"),
                     (F.col("__q")[1] + k * (F.col("__q")[1] - F.col("__q")[0])).alias("upper"))    # one row
    return df.withColumn("__v", value).crossJoin(F.broadcast(fence)).where(F.col("__v").between(F.col("lower"), F.col("upper"))).drop("__v")


@dataclass(frozen=True)
class Frame:
    """What was learnt from a table: numeric columns with centre and scale, category levels in order."""

    numeric: Mapping[str, tuple[float, float]]
    levels: Mapping[str, tuple]

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.levels]

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` and the columns of the fit, whatever others df has: numbers
        as (x - median) / IQR, NULL or a missing column as 0; categories as
        their place among the levels, -1 for NULL, unknown or a missing
        column.  The result has the same columns for every table."""
        none = F.lit(None).cast("double")
        made = {}
        for c, (centre, scale) in self.numeric.items():
            x = clean_double(F.col(c).try_cast("double") if dict(df.dtypes)[c] == "string" else F.col(c)) if c in df.columns else none
            made[c] = F.coalesce((x - F.lit(centre)) / F.lit(scale), F.lit(0.0))
        for c, levels in self.levels.items():
            place = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(c)) - 1 if c in df.columns and levels else F.lit(-1)
            made[c] = F.coalesce(place.cast("int"), F.lit(-1))
        return df.select(*keep, *[e.alias(c) for c, e in made.items()])


def fit_frame(train: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] = (), most_levels: int = 1000) -> Frame:
    """Numeric columns (all found if not named) with median and
    interquartile range (1 where it is 0; columns without a value are left
    out), and the sorted levels of categories.  More than ``most_levels``
    levels is an error: such a column needs an encoding joined by key."""
    from fathom.operators.profile import numeric_columns
    numeric = list(numeric if numeric is not None else numeric_columns(train))
    q = quantile_row(train, numeric, [0.25, 0.5, 0.75], prefix="").first() if numeric else {}
    stats = {c: (float(q[c][1]), float(q[c][2] - q[c][0]) or 1.0) for c in numeric if q[c] is not None}
    levels = {}
    for c in categorical:
        found = [r[0] for r in train.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c).limit(most_levels + 1).collect()]
        if len(found) > most_levels:
            raise ValueError(f"{c} has more than {most_levels} levels")
        levels[c] = tuple(found)
    return Frame(stats, levels)


def side_by_side(key: Sequence[str], tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per key with a column per table (frame, its value column):
    labels, features and predictions aligned by row key instead of by
    position; a key missing in a table has NULL there."""
    parts = [f.select(*key, F.col(c).alias(name)) for name, (f, c) in tables.items()]
    return reduce(lambda a, b: a.join(b, list(key), "full"), parts)


def overview(df: DataFrame, lat: str, lon: str, capped: str, columns: Sequence[str], top: int = 8) -> DataFrame:
    """(section, name, value): coordinate ranges, share of rows at the
    largest value of ``capped``, and the ``top`` column pairs by absolute
    correlation, all from two aggregates."""
    pairs = list(combinations(columns, 2))
    first = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in (lat, lon) for n, f in (("min", F.min), ("max", F.max))],
                   F.max(capped).alias("__cap"), *[F.corr(a, b).alias(f"{a}~{b}") for a, b in pairs])
    share = df.select(F.col(capped)).crossJoin(F.broadcast(first.select("__cap"))).agg(
        F.avg((F.col(capped) == F.col("__cap")).cast("double")).alias("v"))
    long = lambda section, names: first.select(F.explode(F.array(*[F.struct(
        F.lit(section).alias("section"), F.lit(n).alias("name"), F.col(f"`{n}`").alias("value")) for n in names])).alias("s")).select("s.*")
    ranges = long("range", [f"{n}_{c}" for c in (lat, lon) for n in ("min", "max")])
    best = long("correlation", [f"{a}~{b}" for a, b in pairs]).where("value IS NOT NULL") \
        .orderBy(F.desc(F.abs("value")), "name").limit(top)
    return ranges.unionByName(share.select(F.lit("cap_share").alias("section"), F.lit(capped).alias("name"), F.col("v").alias("value"))) \
        .unionByName(best)


def append_version(record: DataFrame, path: str, identity: Sequence[str]) -> int:
    """Q22, Q23: append a small record table to the versions under ``path`` as
    the next version, unless the latest has the same values in the columns
    ``identity``; returns the version number.  A version is a folder of its
    own, so appending it again overwrites nothing else."""
    spark = record.sparkSession
    record = record.coalesce(1)
    try:
        old = spark.read.parquet(path)
        latest = old.agg(F.max("version")).first()[0]
    except AnalysisException:      # no versions yet
        latest = None
    if latest is not None:
        before = old.where(F.col("version") == latest).select(*identity)
        if before.exceptAll(record.select(*identity)).isEmpty() and record.select(*identity).exceptAll(before).isEmpty():
            return int(latest)
    version = 1 if latest is None else int(latest) + 1
    record.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={version}")
    return version
