"""Session set-up and the few cluster-level helpers the operators share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds for an explicit broadcast: a side is hinted only when its measured
# row count and bytes are both within them.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
# Rows of one task's hash tables, where the rows can be counted before.
TASK_ROWS = 1 << 20


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lexisieve") -> SparkSession:
    """Session with AQE (coalescing, skew-join splitting) switched on.

    On a cluster the master and ``spark.checkpoint.dir`` come from the
    submitter; locally (tests, bench) we fill in what is missing.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions or (master or "").startswith("local"):
        # Locally: one shuffle partition per core. On a cluster the submitter's
        # setting stays (size it for the data; AQE coalesces small ones).
        cores = os.cpu_count() or 8
        parts = shuffle_partitions or int(os.environ.get("LEXISIEVE_SHUFFLE_PARTITIONS", cores))
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    if (master or "").startswith("local"):
        # Small local inputs: split scans finer than the 128 MB default so
        # every core gets work (a stored index is many small bucket files).
        split = os.environ.get("LEXISIEVE_MAX_PARTITION_BYTES", str(4 * 1024 * 1024))
        builder = builder.config("spark.sql.files.maxPartitionBytes", split)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEXISIEVE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    Read from ``spark.checkpoint.dir``; only a local-mode session without the
    setting gets a fresh folder under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for cluster runs")
        conf_dir = tempfile.mkdtemp(prefix="lexisieve-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint directory."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the rows and bytes of ``df`` (string bytes plus 8 per other
    column, per row) are within the bounds of a broadcast, by one job."""
    from pyspark.sql import types as T

    width = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        else:
            width = width + F.lit(8)
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    rows, size = r["n"], r["b"] or 0
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint behind a measured size check (``is_small``). Otherwise
    the join stays a shuffle join, where AQE can still demote it to a broadcast
    from run-time sizes or split skewed partitions. ``df`` is computed for the
    check and again for the join: pass what is cheap, or materialized.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a narrow scan over the cluster before per-row heavy work.

    A table stored as few large Parquet row groups scans as few tasks, and
    tokenising whole texts would then run on few cores. When the scan has
    fewer partitions than the default parallelism, rows are hash-partitioned
    on ``keys`` (chosen unique, e.g. (path, seq), so a hot path cannot skew
    it); a wide scan is left alone, costing no shuffle.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)


def deal(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` hash-partitioned on ``keys`` before an aggregate on them or more
    columns, into so many partitions that one holds about TASK_ROWS of its
    (at most ``rows``) rows. The aggregate then needs no other exchange: its
    hash tables hold one such partition, not all that a task makes of its
    share of a scan."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.repartition(n, *keys)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` once as Parquet to a fresh folder under
    the shared checkpoint directory and reading it back. One job (an eager
    ``checkpoint()`` computes its plan twice), columnar on disk, and a lost
    executor later re-reads the files instead of recomputing the plan."""
    location = scratch_path(df.sparkSession, name)
    df.write.parquet(location)
    return df.sparkSession.read.schema(df.schema).parquet(location)
