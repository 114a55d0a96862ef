"""Time-window operators over batch tables (T5 batch twin)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "2000-01-01 00:00:00"


def trailing_counts(df: DataFrame, key: str, ts: str, seconds: int = 60, bucket_seconds: int = 3600,
                    name: str = "trailing_n") -> DataFrame:
    """Per row, the number of rows of the same key in [ts - seconds, ts]
    (peers at the same instant included).  Rows are grouped by (key, time
    bucket) instead of by key alone, so one hot key is spread over many
    tasks; each row is also copied, as context only, into the next bucket
    when it lies in the last ``seconds`` of its own."""
    us = F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(ts))
    width = bucket_seconds * 1_000_000
    span = seconds * 1_000_000
    base = df.withColumn("__us", us).withColumn("__b", F.floor(F.col("__us") / width).cast("long"))
    own = base.withColumn("__own", F.lit(True))
    ctx = base.where(F.col("__us") >= (F.col("__b") + 1) * width - span) \
        .withColumn("__b", F.col("__b") + 1).withColumn("__own", F.lit(False))
    both = own.unionByName(ctx)
    w = Window.partitionBy(key, "__b").orderBy("__us").rangeBetween(-span, 0)
    out = both.withColumn(name, F.count(F.lit(1)).over(w)).where(F.col("__own"))
    return out.drop("__us", "__b", "__own")
