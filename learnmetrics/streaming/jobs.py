"""The two streaming jobs, as transformations plus a start function.

Both read behaviour lines (column ``value``) from Kafka or files, use event time (field 16,
epoch seconds) with a watermark, and write through :func:`start_upsert_stream`, which
stores each micro-batch's changed keys under ``batch_id=N``; the current table is the
last value per key. A replayed batch overwrites its own partition, so output and
checkpointed offsets stay consistent after a failure (exactly-once per key).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from learnmetrics.functions import columns as C
from learnmetrics.operators import behaviour as B
from learnmetrics.operators.geo import lookup_region, size_checked_ranges
from learnmetrics.sinks.writers import compact_changelog, read_changelog, upsert_changelog_batch
from learnmetrics.sources.lookups import vip_user_ids

# Reference cadence: 15 s micro-batches; sliding window 4x, slide 2x the interval.
DEFAULT_TRIGGER = "15 seconds"

VIP_KEYS = ["dt", "province"]
UNPAID_KEYS = ["uid", "window_start", "window_end"]


def event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_ts", F.timestamp_seconds(F.col("event_time")))


def _day_window_start(tz_offset_hours: int) -> str:
    return f"{(24 - tz_offset_hours) % 24} hours"


# --- new VIPs per day and region ------------------------------------------------

def vip_increments(
    lines: DataFrame,
    ip_ranges: DataFrame,
    tz_offset_hours: int = 8,
    watermark: str | None = "2 days",
    with_last_event: bool = False,
    broadcast_ranges: bool | None = None,
) -> DataFrame:
    """completeOrder events -> running count per (local day, region).

    Days are windows aligned to local midnight at ``tz_offset_hours``. The watermark
    (default 2 days) lets Spark drop the state of old days; ``None`` keeps every day's
    state forever (unbounded). Output: ``dt`` (yyyy-MM-dd), ``province``, ``cnt``, and with
    ``with_last_event`` the latest ``event_time`` of the group (``last_event_time``).

    For a stream (no AQE) the range table is counted once and broadcast when its exploded
    size is bounded under the limit; otherwise each micro-batch uses a shuffle join.
    ``broadcast_ranges`` overrides the decision.
    """
    if broadcast_ranges is None:
        broadcast_ranges = lines.isStreaming and size_checked_ranges(ip_ranges)[1]
    ev = B.parse_lines(lines, tz_offset_hours=tz_offset_hours).where(F.col("event_key") == B.COMPLETE_ORDER)
    ev = ev.select("event_time", C.ipv4_to_long("ip").alias("ip_num"))
    ev = event_time(lookup_region(ev, "ip_num", ip_ranges, region_col="province", broadcast=broadcast_ranges))
    if watermark:
        ev = ev.withWatermark("event_ts", watermark)
    day = F.window("event_ts", "1 day", "1 day", _day_window_start(tz_offset_hours))
    aggs = [F.count(F.lit(1)).alias("cnt")] + ([F.max("event_time").alias("last_event_time")] if with_last_event else [])
    agg = ev.groupBy(day.alias("w"), "province").agg(*aggs)
    return agg.select(
        C.epoch_to_day(F.unix_seconds(F.col("w.start")), tz_offset_hours).alias("dt"),
        "province",
        F.col("cnt").cast("bigint").alias("cnt"),
        *(["last_event_time"] if with_last_event else []),
    )


def recent_days(totals: DataFrame, reference_epoch, retention_days: int = 2, tz_offset_hours: int = 8) -> DataFrame:
    """Keep per-day totals whose day ends after ``reference - retention`` (the state a
    ``retention_days`` watermark keeps). ``reference_epoch`` is a Column or int (seconds)."""
    ref = reference_epoch if not isinstance(reference_epoch, int) else F.lit(reference_epoch)
    day_start = F.unix_date(F.to_date("dt")).cast("bigint") * 86400 - F.lit(tz_offset_hours * 3600)
    return totals.where(day_start + F.lit(86400) > ref - F.lit(retention_days * 86400))


# --- repeat order-page visitors who did not pay ------------------------------------

def unpaid_visitors(
    lines: DataFrame,
    vip_users: DataFrame | None,
    window: str = "60 seconds",
    slide: str = "30 seconds",
    watermark: str | None = "10 minutes",
    min_visits: int = 3,
    time_col: str | None = None,
) -> DataFrame:
    """Users who opened the order page ``min_visits`` times in a sliding window and are
    not VIP. ``vip_users`` needs a ``uid`` column; it is anti-joined before the window
    aggregation (VIP status is per user). In a stream that would fix the VIP users at its
    start: pass None there, and take them out of every micro-batch with :func:`without_vip`.
    Windows are on event time (field 16) by default; ``time_col`` names a timestamp
    column of ``lines`` to window on instead, e.g. the Kafka arrival time ``kafka_ts``
    (the reference's arrival-time windows).
    Output: ``uid, window_start, window_end`` (epoch seconds), ``cnt``.
    """
    keep = [time_col] if time_col else []
    ev = B.parse_lines(lines, keep_columns=keep).where(F.col("event_key") == B.ENTER_ORDER_PAGE)
    ev = ev.select("uid", "event_time", *keep)
    if vip_users is not None:
        ev = ev.join(vip_user_ids(vip_users), "uid", "left_anti")
    ev = ev.withColumn("event_ts", F.col(time_col).cast("timestamp")) if time_col else event_time(ev)
    if watermark:
        ev = ev.withWatermark("event_ts", watermark)
    agg = ev.groupBy(F.window("event_ts", window, slide).alias("w"), "uid").agg(F.count(F.lit(1)).alias("cnt"))
    return agg.where(F.col("cnt") >= min_visits).select(
        "uid",
        F.unix_seconds(F.col("w.start")).alias("window_start"),
        F.unix_seconds(F.col("w.end")).alias("window_end"),
        F.col("cnt").cast("bigint").alias("cnt"),
    )


def _seconds(interval: str) -> int:
    """Length of an interval of fixed units, e.g. ``24 hours``, in seconds."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    count, unit = interval.split()
    return int(count) * units[unit.rstrip("s")]


def unpaid_visitors_by_panes(
    lines: DataFrame,
    vip_users: DataFrame | None,
    window: str = "60 seconds",
    slide: str = "30 seconds",
    watermark: str | None = "10 minutes",
    min_visits: int = 3,
    time_col: str | None = None,
) -> DataFrame:
    """:func:`unpaid_visitors` in two steps: visits are counted once, per user and pane (a slide
    long), then panes are added up to windows. An event is never expanded into the windows it
    falls in; only the panes are, of which a user has few.

    In a stream the steps are two chained stateful aggregates, so it runs in append mode: a
    window comes out once, when the watermark has passed its end. ``window`` must be a
    multiple of ``slide``.
    """
    if _seconds(window) % _seconds(slide):
        raise ValueError("the window must be a multiple of the slide")
    keep = [time_col] if time_col else []
    ev = B.parse_lines(lines, keep_columns=keep).where(F.col("event_key") == B.ENTER_ORDER_PAGE)
    ev = ev.select("uid", "event_time", *keep)
    if vip_users is not None:
        ev = ev.join(vip_user_ids(vip_users), "uid", "left_anti")
    ev = ev.withColumn("event_ts", F.col(time_col).cast("timestamp")) if time_col else event_time(ev)
    if watermark:
        ev = ev.withWatermark("event_ts", watermark)
    panes = ev.groupBy(F.window("event_ts", slide).alias("pane"), "uid").agg(F.count(F.lit(1)).alias("visits"))
    windows = F.window(F.window_time("pane"), window, slide).alias("w")
    agg = panes.groupBy(windows, "uid").agg(F.sum("visits").alias("cnt"))
    return agg.where(F.col("cnt") >= min_visits).select(
        "uid",
        F.unix_seconds(F.col("w.start")).alias("window_start"),
        F.unix_seconds(F.col("w.end")).alias("window_end"),
        F.col("cnt").cast("bigint").alias("cnt"),
    )


def without_vip(visitors: DataFrame, vip_users: DataFrame) -> DataFrame:
    """``visitors`` who are not VIP by a lookup opened for this micro-batch. The batch is an
    ordinary frame, so the join is planned on the lookup's size of the moment."""
    return visitors.join(vip_user_ids(vip_users), "uid", "left_anti").select(*visitors.columns)


# --- running a job --------------------------------------------------------------------

def start_upsert_stream(
    agg: DataFrame,
    sink_path: str,
    checkpoint_path: str,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    query_name: str | None = None,
    state_partitions: int | None = None,
    sink_files: int | None = None,
    per_batch: Callable[[DataFrame], DataFrame] | None = None,
    output_mode: str = "update",
) -> StreamingQuery:
    """Run ``agg`` in update mode (or ``output_mode``) into a change log at ``sink_path``.

    The checkpoint holds source offsets and aggregation state; restarting with the same
    ``checkpoint_path`` resumes. A fresh checkpoint needs a fresh ``sink_path``.
    ``state_partitions`` fixes the number of state-store partitions (the shuffle
    partitions of the stateful step), which is recorded in the checkpoint at the first
    start and cannot change later; size it to the state, not to one batch. By default the
    session's ``spark.sql.shuffle.partitions`` is used. ``sink_files`` caps the files
    written per micro-batch. ``per_batch`` is applied to every micro-batch's output before it
    is written.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        upsert_changelog_batch(per_batch(df) if per_batch else df, batch_id, sink_path, sink_files)

    w = (
        agg.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(write)
    )
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    if state_partitions is None:
        return w.start()
    # The stream takes a copy of the session conf when it starts; restore ours right after.
    spark = agg.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return w.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


VIP_LOG_SCHEMA = StructType(
    [StructField("dt", StringType()), StructField("province", StringType()), StructField("cnt", LongType()),
     StructField("batch_id", LongType())]
)
UNPAID_LOG_SCHEMA = StructType(
    [StructField(c, LongType()) for c in ("uid", "window_start", "window_end", "cnt", "batch_id")]
)


def read_vip_increments(spark: SparkSession, sink_path: str) -> DataFrame:
    return read_changelog(spark, sink_path, VIP_KEYS, ["cnt"], schema=VIP_LOG_SCHEMA)


def read_unpaid_visitors(spark: SparkSession, sink_path: str) -> DataFrame:
    return read_changelog(spark, sink_path, UNPAID_KEYS, ["cnt"], schema=UNPAID_LOG_SCHEMA)


def unpaid_users(windows: DataFrame) -> DataFrame:
    """One row per flagged user (the reference keeps a set of uids): the first window in
    which the user reached the threshold and the most visits in any window."""
    return windows.groupBy("uid").agg(
        F.min("window_start").alias("first_window_start"), F.max("cnt").alias("max_visits")
    )


def read_unpaid_users(spark: SparkSession, sink_path: str) -> DataFrame:
    return unpaid_users(read_unpaid_visitors(spark, sink_path))


def compact_vip_increments(spark: SparkSession, sink_path: str) -> str | None:
    """Periodic batch job: fold the VIP change log into a snapshot."""
    return compact_changelog(spark, sink_path, VIP_KEYS, ["cnt"], schema=VIP_LOG_SCHEMA)


def compact_unpaid_visitors(spark: SparkSession, sink_path: str) -> str | None:
    return compact_changelog(spark, sink_path, UNPAID_KEYS, ["cnt"], schema=UNPAID_LOG_SCHEMA)


# --- sources ---------------------------------------------------------------------------

def kafka_lines(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Kafka topic -> ``value`` (string) and ``kafka_ts``; needs the Kafka connector jar.

    ``starting_offsets`` takes "earliest", "latest" or a JSON offset map; it applies to
    the first start only, afterwards the checkpoint decides.
    """
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "true")
    )
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("kafka_ts"))


def file_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files arriving in a directory -> ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def stop_gracefully(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Finish the data already available, then stop. Offsets and state are in the
    checkpoint, so the next start continues exactly after the last committed batch."""
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    if timeout_s is not None:
        query.awaitTermination(timeout_s)
