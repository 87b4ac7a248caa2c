"""SparkSession construction and shared-storage locations."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings every job relies on. AQE re-plans joins (runtime broadcast when a side turns
# out small, skew-join splitting) and coalesces shuffle partitions; ANSI stays on, so
# all parsing goes through try_cast.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # Partition values (load dates, days) are strings; never guess them as numbers.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
}


def get_session(
    app_name: str = "learnmetrics",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the library defaults.

    On a cluster leave ``master`` unset and let spark-submit decide. Locally pass
    e.g. ``master="local[8]", shuffle_partitions=8``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ensure_parallelism(df, min_partitions: int | None = None):
    """Round-robin repartition ``df`` when it has fewer partitions than ``min_partitions``
    (default: the cluster's default parallelism).

    Meant for inputs stored as a few large, unsplittable units (one Parquet row group, one
    gzip file) that feed heavy per-row work before the first shuffle. On large inputs,
    which already have many splits, it returns ``df`` unchanged and adds no shuffle.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        # Hash on all columns rather than round-robin: equally even, and deterministic on
        # retry without the per-partition sort round-robin needs.
        return df.repartition(target, *df.columns)
    return df


def spread_rows(df, min_partitions: int | None = None):
    """As :func:`ensure_parallelism`, by the partitions that hold rows: a Parquet file of one row
    group is planned as several splits, and all its rows come out of one of them. Counting them
    reads no columns of a Parquet table."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    held = df.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    filled, rows, most = held.agg(F.count("p"), F.sum("n"), F.max("n")).first()
    # Few full partitions, or one with far more than its share.
    if filled and (filled < target or most > 4 * rows / filled) and rows > 1:
        return df.repartition(max(target, filled), *df.columns)
    return df


# Largest static lookup side (rows) hinted for broadcast where AQE cannot decide at run
# time (streaming). ~2M narrow rows is tens of MB per executor.
BROADCAST_MAX_ROWS = 2_000_000


def broadcast_if_small(df, max_rows: int | None = None, extra_rows: int = 0):
    """Hint ``df`` for broadcast only after counting it: returns ``(df, broadcast?)``.

    For static lookup tables joined to a stream, where AQE cannot switch a shuffle join
    to a broadcast join at run time. The count is one small job on the lookup table at
    start-up; ``extra_rows`` adds a known bound on growth (e.g. exploded range blocks).
    Above ``max_rows`` the table is left to an ordinary shuffle join.
    """
    if max_rows is None:
        max_rows = BROADCAST_MAX_ROWS
    n = df.count()
    if n + extra_rows <= max_rows:
        return F.broadcast(df), True
    return df, False


# Largest lookup table (rows) whose join is left to the planner, which may broadcast it.
PLANNED_MAX_ROWS = 250_000


def merge_if_large(df, max_rows: int | None = None):
    """Hint a sort-merge join for ``df`` when it counts more than ``max_rows`` rows.

    The planner broadcasts by the size of files, which tells little about memory: compressed
    columns and generated rows can be a hundred times larger in a hash table, and that table
    lies whole on the driver and on every executor. The count reads no columns of a Parquet
    table. A smaller table is left to the optimizer.
    """
    limit = PLANNED_MAX_ROWS if max_rows is None else max_rows
    return df.hint("merge") if df.count() > limit else df


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and lineage-cutting tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared location). Only when it is
    unset (tests, a laptop) a folder below the warehouse, which is shared too, stands in;
    the setting itself is left alone, a running session refuses to change it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the checkpoint root (for one run of a job)."""
    return "/".join([checkpoint_root(spark), *parts, uuid.uuid4().hex])


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that needs a plain local path (tests only)."""
    return path[len("file:"):] if path.startswith("file:") else os.fspath(path)
