"""Structured Streaming monitors (T1-T4, T6-T8, S8); those that need rows in
event-time order are in ``in_order`` (D6, T5, M11).

Each monitor is a function from a streaming DataFrame to a streaming
DataFrame, so it runs the same way on a file, Kafka or table source; the
batch twins in ``fathom.plans.streams`` compute the same numbers with the
batch API and are checked against DuckDB.  Event time is the ``ts`` column
cast to TIMESTAMP (the watermark requires it); late rows beyond the
watermark are dropped by Spark's usual rule.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.session import ensure_checkpoint_dir


def event_stream(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of scored rows from a file source, with an ``event_time``
    TIMESTAMP column derived from ``ts``."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if not _is_folder(spark, path):  # a single file: stream its folder filtered to that file name
        folder, _, name = path.rpartition("/")
        reader, path = reader.option("pathGlobFilter", name), folder
    s = reader.parquet(path)
    return s.withColumn("event_time", F.col("ts").cast("timestamp"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    """Asked of the file system that the path names, not of the driver's own disk."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def counters(stream: DataFrame, label: str, window: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Counts by label per tumbling window."""
    return stream.withWatermark("event_time", watermark) \
        .groupBy(F.window("event_time", window).alias("w"), label).agg(F.count(F.lit(1)).alias("n"))


def value_counts(stream: DataFrame, value: str, window: str = "1 hour", watermark: str = "2 hours",
                 slide: str | None = None) -> DataFrame:
    """T2 input: rows per (sliding) window and value, ``value_n``; NULL values are left out."""
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    return stream.withWatermark("event_time", watermark).where(F.col(value).isNotNull()) \
        .groupBy(w.alias("w"), value).agg(F.count(F.lit(1)).alias("value_n"))


def latency_of_counts(counts: DataFrame, value: str, probs: Sequence[float]) -> DataFrame:
    """N, mean and exact quantiles (array ``q``: the smallest value that
    at least the share p of the rows do not exceed) of each window, from its
    counts per value.  Running counts are range-partitioned, so a window's
    values never meet in one task."""
    from fathom.operators.ordered import running_totals
    cum = running_totals(counts.select("w", value, "value_n"), [value], {"__cum": F.col("value_n")}, ["w"])
    totals = counts.groupBy("w").agg(F.sum("value_n").alias("n"), (F.sum(F.col(value) * F.col("value_n")) / F.sum("value_n")).alias("mean"))
    at = [F.min(F.when(F.col("__cum") >= F.ceil(F.lit(p) * F.col("n")), F.col(value))) for p in probs]
    q = cum.join(totals.select(F.col("w").alias("__w"), "n"), F.col("w") == F.col("__w")).groupBy("w").agg(F.array(*at).alias("q"))
    return totals.join(q, "w")


def bucket_histogram(stream: DataFrame, value: str, edges: Sequence[float], window: str = "1 hour",
                     watermark: str = "2 hours") -> DataFrame:
    """T4: fixed-bucket counts per window (cumulate downstream over the
    few buckets)."""
    x = F.col(value)
    b = None
    for i in range(len(edges) - 1):
        cond = (x >= edges[i]) & ((x <= edges[i + 1]) if i == len(edges) - 2 else (x < edges[i + 1]))
        b = F.when(cond, F.lit(i)) if b is None else b.when(cond, F.lit(i))
    return stream.withWatermark("event_time", watermark).where(b.isNotNull()) \
        .groupBy(F.window("event_time", window).alias("w"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def window_bin_counts(stream: DataFrame, value: str, lo: float, hi: float, bins: int = 10,
                      window: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """T1 input: equal-width bin counts of the incoming values per event-time
    window (the reference bins come from the training profile); PSI per
    window is computed from these counts (see ``psi_from_counts``)."""
    x = F.col(value)
    width = (hi - lo) / bins
    b = F.when((x < lo) | (x > hi), F.lit(-1)).when(x == hi, F.lit(bins - 1)) \
        .otherwise(F.floor((x - lo) / width).cast("int"))
    return stream.withWatermark("event_time", watermark).where(x.isNotNull()) \
        .groupBy(F.window("event_time", window).alias("w"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def psi_from_counts(counts: DataFrame, reference_shares: DataFrame, bins: int = 10, eps: float = 1e-8) -> DataFrame:
    """PSI per window from (w, bin, n) counts and (bin, share) reference
    shares; bin -1 (outside the reference range) stays in the denominator."""
    tot = counts.groupBy("w").agg(F.sum("n").alias("__tot"))
    grid = tot.select("w", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    j = grid.join(counts, ["w", "bin"], "left").join(tot, "w").join(F.broadcast(reference_shares), "bin")
    a = F.coalesce(F.col("n"), F.lit(0)) / F.col("__tot") + eps
    e = F.col("share") + eps
    return j.groupBy("w").agg(F.sum((a - e) * F.log(a / e)).alias("psi"), F.first("__tot").alias("n_current"))


def run_available_now(df: DataFrame, name: str, keys: Sequence[str] = (), base: str | None = None) -> DataFrame:
    """Run a streaming DataFrame over everything available now into a
    parquet sink under the checkpoint folder, then read the sink back as a
    batch DataFrame.  Results never go through the driver.

    Without ``keys`` rows are appended.  With ``keys`` (an aggregate's
    grouping columns) the query runs in update mode, which also emits the
    groups that the watermark has not closed: each epoch's rows go to a
    folder of their own (a retried epoch overwrites it) and the latest epoch
    of a key counts, an upsert."""
    spark = df.sparkSession
    root = base or f"{ensure_checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex[:8]}"

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}")
    q = (df.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/chk")
         .outputMode("update" if keys else "append").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    if not keys:
        return out.drop("epoch")
    rest = [c for c in df.columns if c not in keys]
    return out.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("__r")).select(*keys, "__r.*")


def validation_sinks(stream: DataFrame, bad: F.Column, root: str) -> object:
    """One stream split into accepted and quarantine parquet sinks in
    each micro-batch (foreachBatch), so both see the same rows.  A batch has
    a folder of its own in each sink (column ``epoch``), which a retried
    batch overwrites, so no row is written twice."""
    def sink(batch: DataFrame, epoch: int) -> None:
        flagged = batch.withColumn("__bad", F.coalesce(bad, F.lit(True)))
        for name, rows in (("accepted", ~F.col("__bad")), ("quarantine", F.col("__bad"))):
            flagged.where(rows).drop("__bad").write.mode("overwrite").parquet(f"{root}/{name}/epoch={epoch}")
    return (stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/chk")
            .trigger(availableNow=True).start())


def incremental_fit(stream: DataFrame, x: str, y: str, root: str) -> object:
    """Running least-squares line updated per micro-batch from
    sufficient statistics (n, sums, cross-products), one table per epoch; RMSE of
    the line so far on each new batch before it is absorbed, in ``root``/log."""
    sums = ["n", "sx", "sy", "sxx", "sxy"]

    def sink(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        b = batch.agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
                      F.sum(F.col(x) * F.col(x)).alias("sxx"), F.sum(F.col(x) * F.col(y)).alias("sxy"))
        # state after an epoch = state after the one before plus this batch: a replay writes the same again
        if epoch:
            prev = spark.read.parquet(f"{root}/stats/epoch={epoch - 1}").select(*sums)
            den = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
            slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), den)
            line = prev.select(F.coalesce(slope, F.lit(0.0)).alias("__b"), "n", "sx", "sy").select(
                "__b", F.try_divide(F.col("sy") - F.col("__b") * F.col("sx"), "n").alias("__a"))
            err = F.col(y) - (F.col("__a") + F.col("__b") * F.col(x))
            batch.crossJoin(F.broadcast(line)).agg(F.count(F.lit(1)).alias("n_batch"), F.sqrt(F.avg(err * err)).alias("rmse")) \
                .write.mode("overwrite").parquet(f"{root}/log/epoch={epoch}")
            b = prev.unionByName(b).agg(*[F.sum(c).alias(c) for c in sums])
        b.write.mode("overwrite").parquet(f"{root}/stats/epoch={epoch}")
    return (stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/chk")
            .trigger(availableNow=True).start())
