"""Table writers: dynamic partition overwrite, snapshot directories, text output."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LATEST_POINTER = "_latest_snapshot"


def write_table(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] | list[str] = (),
    mode: str = "overwrite",
    files: int | None = None,
    fmt: str = "parquet",
    compression: str = "snappy",
) -> None:
    """Write ``df`` to ``path``.

    With ``partition_by`` and mode ``overwrite`` only the partitions present in ``df``
    are replaced (dynamic partition overwrite), so re-running one load date is idempotent
    and other dates are kept. ``files`` caps the number of output files per task set via
    ``coalesce``; leave it unset for large tables (AQE sizes the final stage), since
    ``coalesce(1)`` funnels the whole last stage through one task.
    """
    if files:
        df = df.coalesce(files)
    w = df.write.mode(mode).format(fmt).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.save(path)


def write_partition(df: DataFrame, path: str, column: str, value: str, files: int | None = None) -> None:
    """Replace the one partition ``column=value`` of the table at ``path`` by ``df``.

    Unlike a dynamic overwrite this also replaces it by nothing: a re-run that has no rows
    leaves none of the earlier run.
    """
    df = df.drop(column)
    if files:
        df = df.coalesce(files)
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={value}")


def write_text(df: DataFrame, path: str, files: int | None = None, compression: str | None = None) -> None:
    """Write a single string column as text lines."""
    if files:
        df = df.coalesce(files)
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def new_snapshot_id(day: str) -> str:
    """Snapshot ids sort by write time (then day), so the latest written is the greatest,
    also when an older day is re-run."""
    now = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{now}_{day}"


def publish_snapshot(spark: SparkSession, base: str, snapshot_id: str) -> None:
    """Make ``snapshot_id`` the current version of the table at ``base``.

    Appends one small pointer file; nothing is deleted or rewritten, so a crash leaves
    either the old or the new version current, never none. The greatest id wins.
    """
    spark.createDataFrame([(snapshot_id,)], "value string").coalesce(1).write.mode("append").text(
        f"{base}/{LATEST_POINTER}"
    )


def write_snapshot(df: DataFrame, base: str, snapshot_id: str, files: int | None = None) -> str:
    """Write a table version to ``base/snapshot=<id>``, then publish it.

    Readers follow the pointer, so a job that reads the current version and writes the
    next one never overwrites its own input; a failed write publishes nothing.
    """
    path = f"{base}/snapshot={snapshot_id}"
    write_table(df, path, files=files)
    publish_snapshot(df.sparkSession, base, snapshot_id)
    return path


def latest_snapshot_path(spark: SparkSession, base: str) -> str | None:
    """Path of the latest published snapshot, or None when the table has none yet."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.text(f"{base}/{LATEST_POINTER}").agg(F.max("value").alias("v")).first()
    except AnalysisException:  # no pointer yet: first run
        return None
    return f"{base}/snapshot={row.v}" if row and row.v else None


def read_latest_snapshot(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    path = latest_snapshot_path(spark, base)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def upsert_changelog_batch(df: DataFrame, batch_id: int, path: str, files: int | None = None) -> None:
    """Write one micro-batch of changed keys to ``path/batch_id=N`` (idempotent on replay).

    ``files`` caps the files per batch (``coalesce``): a batch holds only the keys that
    changed, so a few files avoid thousands of tiny ones per day; compaction folds them.
    """
    if files:
        df = df.coalesce(files)
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


COMPACTED = "_compacted"  # below the log path; names starting with "_" are not scanned as data


def _latest(log: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    latest = F.max_by(F.struct(*[F.col(v) for v in values]), F.col("batch_id").cast("bigint")).alias("_v")
    return log.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def _since_compaction(spark: SparkSession, path: str, log: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The log with every batch folded into the latest snapshot replaced by that snapshot."""
    snap = latest_snapshot_path(spark, f"{path}/{COMPACTED}")
    if snap is None:
        return log
    upto = _newest_batch(snap)
    base = spark.read.parquet(snap).withColumn("batch_id", F.lit(upto).cast("bigint"))
    newer = log.where(F.col("batch_id").cast("bigint") > upto)  # partition pruning
    return newer.select(*keys, *values, F.col("batch_id").cast("bigint")).unionByName(base.select(*keys, *values, "batch_id"))


def _read_log(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def read_changelog(
    spark: SparkSession, path: str, keys: list[str], values: list[str], schema: StructType | None = None
) -> DataFrame:
    """Current table of an upserted change log: the last value per key (``max_by`` batch).

    After :func:`compact_changelog`, the latest snapshot stands for every batch up to its
    id and only newer ``batch_id`` partitions are read. Pass ``schema`` (including
    ``batch_id``) so that a log without any rows yet reads as empty.
    """
    log = _read_log(spark, path, schema)
    return _latest(_since_compaction(spark, path, log, keys, values), keys, values)


def compact_changelog(
    spark: SparkSession, path: str, keys: list[str], values: list[str], schema: StructType | None = None
) -> str | None:
    """Fold the change log up to its newest batch into a snapshot.

    A batch job that can run while the stream keeps appending: batches written after the
    newest one seen here are left to the next compaction. Readers then skip the folded
    partitions, so the current-table view stays proportional to the live keys plus recent
    batches. Returns the snapshot path, or None for an empty log.
    """
    log = _read_log(spark, path, schema)
    newest = log.select(F.max(F.col("batch_id").cast("bigint")).alias("m")).first()["m"]
    if newest is None:
        return None
    upto_newest = log.where(F.col("batch_id").cast("bigint") <= newest)
    current = _latest(_since_compaction(spark, path, upto_newest, keys, values), keys, values)
    # A name of its own for every compaction: one in use is never written again.
    return write_snapshot(current, f"{path}/{COMPACTED}", f"{newest:020d}_{uuid.uuid4().hex}")


def clean_changelog(spark: SparkSession, path: str) -> list[str]:
    """Remove the batches that the latest compaction holds, and older compactions. To be run
    while no reader is still at work on them. Returns what went."""
    snap = latest_snapshot_path(spark, f"{path}/{COMPACTED}")
    if snap is None:
        return []
    newest = _newest_batch(snap)
    gone = remove_others(spark, path, "batch_id=", None, lambda name: int(name) > newest)
    return gone + remove_others(spark, f"{path}/{COMPACTED}", "snapshot=", {snap.rsplit("snapshot=", 1)[1]})


def _newest_batch(snapshot_path: str) -> int:
    return int(snapshot_path.rsplit("=", 1)[1].split("_")[0])


def remove_others(spark: SparkSession, folder: str, prefix: str, keep: set[str] | None, stays=None) -> list[str]:
    """Delete the subfolders ``prefix<name>`` of ``folder`` but those in ``keep`` (or for which
    ``stays(name)``), through Hadoop's file system, whichever that is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    gone = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            own = name[len(prefix) :]
            if not (own in keep if keep is not None else stays(own)):
                fs.delete(status.getPath(), True)
                gone.append(name)
    return gone
