"""Intermediate tables and connected components, both kept in the shared
checkpoint folder so that no later step depends on an executor's memory."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name for one table under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written as Parquet and read again: cuts the lineage, computes it once."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, what: str, bins: int, kinds: tuple[str, ...] = ()) -> DataFrame:
    """df as a table bucketed by its column ``bucket``, in a folder for each of ``kinds``: grouping or joining
    it by bucket needs no further shuffle."""
    spark = df.sparkSession
    name = f"{what}_{uuid.uuid4().hex}"
    out = df.write.bucketBy(bins, "bucket").format("parquet").option("path", scratch(spark, what))
    (out.partitionBy(*kinds) if kinds else out).saveAsTable(name)
    return spark.table(name).select(*df.columns)


def components(edges: DataFrame, limit: int = 100) -> DataFrame:
    """node, label (the smallest node that can be reached) for edges (a, b) of longs.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so chains shorten by doubling and stars end at once.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("label")), "labels")
    for _ in range(limit):
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        nxt = stored(step.join(jump, "new").select("node", F.least("new", "far").alias("label"),
                                                   (F.least("new", "far") < F.col("label")).alias("moved")), "labels")
        labels = nxt.select("node", "label")
        if not nxt.filter("moved").limit(1).count():
            return labels
    raise RuntimeError("components did not settle")
