"""Session helpers.

The library never creates a cluster layout of its own: on a cluster the
session comes from the launcher.  ``get_spark`` is for tests, the bench and
local use; ``ensure_checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
session; a scratch folder of its own is made only for a single-process local
master, and on any other master a missing setting is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "fathom") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    parts = shuffle_partitions or int(os.environ.get("FATHOM_SHUFFLE_PARTITIONS", "8"))
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("FATHOM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, honouring ``spark.checkpoint.dir``.

    On a cluster this must be a shared folder named by the cluster config;
    a machine-local fallback is only created when the setting is absent and
    the master is local (tests and local runs).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="fathom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint (never localCheckpoint): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, what: str) -> DataFrame:
    """df as Parquet in the checkpoint folder, computed once: later passes read only the columns they need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A fitted state table for a join: computed once (reliable checkpoint)
    and counted; broadcast when it has at most ``max_rows`` rows, joined by a
    shuffle when it has more."""
    kept = cut_lineage(df)
    return F.broadcast(kept) if kept.count() <= max_rows else kept
