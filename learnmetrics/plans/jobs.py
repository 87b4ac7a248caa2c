"""Batch and streaming jobs over a layered Parquet warehouse.

Layers: ``bdl`` (cleaned detail tables), ``idl`` (wide member table, zipper history),
``adl`` (reports), ``dwd`` (behaviour events), ``tmp`` (daily video users). Each job is a
function taking a SparkSession; ``python -m learnmetrics.plans.jobs <job> ...`` runs one
from the command line. Every write is a full overwrite of a derived table or a dynamic
overwrite of the partitions it produces, so any job can be re-run after a failure.
"""

from __future__ import annotations

import argparse
import hashlib
import re
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnmetrics.operators import behaviour as B
from learnmetrics.operators import distinct_users as U
from learnmetrics.operators import reports as R
from learnmetrics.operators.geo import flatten_ranges
from learnmetrics.operators.wide import build_wide
from learnmetrics.operators.zipper import close_out, day_increment, zipper_schema
from learnmetrics.session import get_session
from learnmetrics.sinks.writers import (
    clean_changelog,
    read_latest_snapshot,
    write_partition,
    write_snapshot,
    write_table,
    write_text,
    new_snapshot_id,
)
from learnmetrics.sources import ingest as I
from learnmetrics.sources import tables as T
from learnmetrics.streaming import jobs as S

# Raw file name per detail table (fixed names of the site's log exports).
RAW_FILES = {
    "bdl_base_ad": "baseadlog.log",
    "bdl_base_website": "baswewebsite.log",
    "bdl_member_regtype": "memberRegtype.log",
    "bdl_pcentermempaymoney": "pcentermempaymoney.log",
    "bdl_vip_level": "PcenterMemViplevel.log",
    "bdl_member": "Member.log",
    "bdl_wxtype": "WxType.log",
    "bdl_member_wxbound": "memberwxbound.log",
}
# The loaders the daily ETL runs; the WeChat binding loader exists but is opt-in.
DEFAULT_INGEST = [t for t in RAW_FILES if t != "bdl_member_wxbound"]


class JobArgumentError(ValueError):
    pass


def check_day(day: str) -> str:
    """A load date must be 8 digits, yyyyMMdd."""
    if not isinstance(day, str) or not re.fullmatch(r"[0-9]{8}", day):
        raise JobArgumentError(f"expected a date like 20190402, got {day!r}")
    return day


@dataclass(frozen=True)
class Layout:
    """Where each table lives below the warehouse root."""

    root: str

    def __post_init__(self):
        object.__setattr__(self, "wh", T.Warehouse(self.root))

    def bdl(self, table: str) -> str:
        return self.wh.path("bdl", table)

    def rejects(self, table: str) -> str:
        return self.wh.path("bdl_rejects", table)

    def idl(self, table: str) -> str:
        return self.wh.path("idl", table)

    def adl(self, table: str) -> str:
        return self.wh.path("adl", table)

    def dwd(self, table: str) -> str:
        return self.wh.path("dwd", table)

    def tmp(self, table: str) -> str:
        return self.wh.path("tmp", table)


# --- J1: raw JSON -> detail tables -----------------------------------------------

def ingest_table(
    spark: SparkSession, layout: Layout, raw_dir: str, table: str, dt: str, files: int | None = None
) -> dict[str, int]:
    """One loader: text scan, parse once, write rows and rejects. Returns the number of rows and of
    rejects per reason, counted by the writes.

    Append tables get (or replace) the ``time=dt`` partition; the others are full refreshes.
    The parsed lines are persisted (memory, spilling to disk) for the two writes, so the raw
    text is scanned and parsed once; a lost executor's share is recomputed from the text.
    """
    from pyspark import StorageLevel

    check_day(dt)
    spec = I.SPECS[table]
    res = I.ingest_json(I.without_blank_lines(I.read_lines(spark, f"{raw_dir.rstrip('/')}/{RAW_FILES[table]}")), spec, dt)
    res, counts = I.counted(res, spec)
    res.staged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if tuple(spec.partition_by) == ("time",):
            write_partition(res.rows, layout.bdl(table), "time", dt, files=files)
        else:
            write_table(res.rows, layout.bdl(table), partition_by=spec.partition_by, files=files)
        write_partition(res.rejects, layout.rejects(table), "time", dt, files=files)
    finally:
        res.staged.unpersist()
    return counts.result()


def run_ingest(
    spark, layout: Layout, raw_dir: str, dt: str, tables: list[str] | None = None, files=None
) -> dict[str, dict[str, int]]:
    """The loaders of a day; rows and rejects of each, counted while they were written."""
    return {table: ingest_table(spark, layout, raw_dir, table, dt, files) for table in tables or DEFAULT_INGEST}


# --- J2/J3: wide member table -----------------------------------------------------

def read_bdl(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    return I.SPECS[table].read(spark, layout.bdl(table))


def wide_from_warehouse(spark: SparkSession, layout: Layout, fanout: str = "safe", money_default=None) -> DataFrame:
    def read(t):
        return read_bdl(spark, layout, t)

    return build_wide(
        T.member_columns(read("bdl_member")),
        T.regtype_columns(read("bdl_member_regtype")),
        T.ad_columns(read("bdl_base_ad")),
        T.site_columns(read("bdl_base_website")),
        T.payment_columns(read("bdl_pcentermempaymoney")),
        T.vip_columns(read("bdl_vip_level")),
        fanout=fanout,
        money_default=money_default,
    )


def run_wide_member(spark, layout: Layout, fanout: str = "safe", money_default=None, files=None):
    """Full refresh of idl_member (the load date of the wide table is not used)."""
    write_table(wide_from_warehouse(spark, layout, fanout, money_default), layout.idl("idl_member"), files=files)


# --- J4: zipper history ---------------------------------------------------------------

def run_zipper(spark, layout: Layout, dt: str, close: str = "all", files=None) -> str:
    """Merge day ``dt`` into the payment/VIP history; returns the new snapshot path.

    Reads the latest snapshot and writes a new one, so the job never overwrites its input.
    """
    check_day(dt)
    payment = read_bdl(spark, layout, "bdl_pcentermempaymoney")  # pruned to time=dt
    vip = read_bdl(spark, layout, "bdl_vip_level")
    uid_type = payment.schema["uid"].dataType
    history = read_latest_snapshot(spark, layout.idl("idl_member_zipper"), zipper_schema(uid_type))
    inc = day_increment(payment, vip, day=dt)
    merged = close_out(history, inc, close=close, days=[f"{dt[:4]}-{dt[4:6]}-{dt[6:]}"])
    return write_snapshot(merged, layout.idl("idl_member_zipper"), new_snapshot_id(dt), files=files)


def read_zipper(spark, layout: Layout, uid_type=None) -> DataFrame:
    return read_latest_snapshot(spark, layout.idl("idl_member_zipper"), zipper_schema(uid_type))


# --- J4, incremental layout ---------------------------------------------------------------
# Closed intervals never change on a normal day, so they live in append-only parts
# ``closed/part=<version>/end_day=<day>``; the open interval of each key is kept as snapshots
# ``open/``. Each version has a manifest naming the part that holds each end day, and one
# pointer publishes snapshot and manifest together: what no published manifest names is
# invisible. A day reads only the open rows (one per key) and that day's payments.

ZIPPER_INC = "idl_member_zipper_inc"
_STATE = "_state"


def _zipper_inc_paths(layout: Layout) -> tuple[str, str]:
    base = layout.idl(ZIPPER_INC)
    return f"{base}/open", f"{base}/closed"


def _with_column(schema, name: str):
    from pyspark.sql.types import StringType, StructField, StructType

    return StructType(list(schema.fields) + [StructField(name, StringType())])


def _manifest(spark, layout: Layout) -> dict[str, str]:
    """End day -> part of the current version (a row per end day)."""
    from learnmetrics.sinks.writers import latest_snapshot_path

    base = layout.idl(ZIPPER_INC)
    snap = latest_snapshot_path(spark, f"{base}/open")
    if snap is None:
        return {}
    version = snap.rsplit("snapshot=", 1)[1]
    rows = spark.read.schema("end_day string, part string").parquet(f"{base}/manifests/version={version}").collect()
    return {r["end_day"]: r["part"] for r in rows}


def _write_manifest(spark, layout: Layout, version: str, parts: dict[str, str]) -> None:
    rows = spark.createDataFrame(sorted(parts.items()), "end_day string, part string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{layout.idl(ZIPPER_INC)}/manifests/version={version}")


def _read_closed(spark, closed_path: str, schema, parts: dict[str, str]) -> DataFrame:
    """The closed rows that ``parts`` names; only their folders are listed and read."""
    paths = [f"{closed_path}/part={part}/end_day={day}" for day, part in sorted(parts.items())]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def _read_open(spark, open_path: str, schema) -> DataFrame:
    from learnmetrics.sinks.writers import latest_snapshot_path

    snap = latest_snapshot_path(spark, open_path)
    if snap is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(_with_column(schema, _STATE)).parquet(snap).where(F.col(_STATE) == "open").select(*schema.fieldNames())


def read_zipper_inc(spark, layout: Layout, uid_type=None) -> DataFrame:
    """The whole history in the incremental layout: the published closed parts + the open snapshot."""
    schema = zipper_schema(uid_type)
    open_path, closed_path = _zipper_inc_paths(layout)
    parts = _manifest(spark, layout)
    return _read_open(spark, open_path, schema).unionByName(_read_closed(spark, closed_path, schema, parts))


def run_zipper_daily(spark, layout: Layout, dt: str, files=None) -> str:
    """Apply day ``dt`` to the incremental zipper; idempotent for the latest day.

    Steps: (1) write the open rows as a new snapshot, (2) write the day's closed rows as a
    part of that version, (3) write its manifest, (4) move the pointer. A failure before (4)
    leaves the previous version as it was. A day older than an open interval (a late day)
    is refused: run :func:`run_zipper_rebuild`.
    """
    from learnmetrics.functions.columns import OPEN_END
    from learnmetrics.operators.zipper import advance_open
    from learnmetrics.sinks.writers import publish_snapshot

    check_day(dt)
    payment = read_bdl(spark, layout, "bdl_pcentermempaymoney")
    vip = read_bdl(spark, layout, "bdl_vip_level")
    schema = zipper_schema(payment.schema["uid"].dataType)
    open_path, closed_path = _zipper_inc_paths(layout)
    day = f"{dt[:4]}-{dt[4:6]}-{dt[6:]}"

    open_rows = _read_open(spark, open_path, schema)
    if open_rows.where(F.col("start_time") > day).limit(1).count():
        raise JobArgumentError(f"{dt} is older than an open interval; rebuild the history instead")
    parts = _manifest(spark, layout)
    reopened = _read_closed(spark, closed_path, schema, {day: parts[day]}) if day in parts else None

    rows = advance_open(open_rows, day_increment(payment, vip, day=dt), reopened)
    staged = rows.withColumn(_STATE, F.when(F.col("end_time") == OPEN_END, "open").otherwise("closed"))
    snap_id = new_snapshot_id(dt)
    snap = f"{open_path}/snapshot={snap_id}"
    write_table(staged, snap, partition_by=(_STATE,), files=files)
    done = spark.read.schema(_with_column(schema, _STATE)).parquet(snap)
    closed_now = done.where(F.col(_STATE) == "closed").select(*schema.fieldNames())
    write_table(closed_now, f"{closed_path}/part={snap_id}/end_day={day}", files=files)
    _write_manifest(spark, layout, snap_id, parts | {day: snap_id})
    publish_snapshot(spark, open_path, snap_id)
    return snap


def clean_zipper(spark, layout: Layout) -> list[str]:
    """Remove snapshots, parts and manifests that the current version doesn't use (run it
    while no daily job or reader of an older version is at work). Returns what went."""
    from learnmetrics.sinks.writers import latest_snapshot_path, remove_others

    base = layout.idl(ZIPPER_INC)
    snap = latest_snapshot_path(spark, f"{base}/open")
    if snap is None:
        return []
    version = snap.rsplit("snapshot=", 1)[1]
    gone = remove_others(spark, f"{base}/open", "snapshot=", {version})
    gone += remove_others(spark, f"{base}/closed", "part=", set(_manifest(spark, layout).values()))
    return gone + remove_others(spark, f"{base}/manifests", "version=", {version})


def run_zipper_rebuild(spark, layout: Layout, files=None) -> None:
    """Recompute the incremental zipper from every loaded day (late days, repairs)."""
    from learnmetrics.functions.columns import OPEN_END
    from learnmetrics.sinks.writers import publish_snapshot

    payment = read_bdl(spark, layout, "bdl_pcentermempaymoney")
    vip = read_bdl(spark, layout, "bdl_vip_level")
    open_path, closed_path = _zipper_inc_paths(layout)
    rows = close_out(day_increment(payment, vip))
    staged = rows.withColumn(_STATE, F.when(F.col("end_time") == OPEN_END, "open").otherwise("closed"))
    snap_id = new_snapshot_id("rebuild")
    snap = f"{open_path}/snapshot={snap_id}"
    write_table(staged, snap, partition_by=(_STATE,), files=files)
    schema = zipper_schema(payment.schema["uid"].dataType)
    done = spark.read.schema(_with_column(schema, _STATE)).parquet(snap)
    closed = done.where(F.col(_STATE) == "closed").select(*schema.fieldNames()).withColumn("end_day", F.col("end_time"))
    # Dealt by day: a file per day, instead of one per day and task.
    write_table(closed.repartition("end_day"), f"{closed_path}/part={snap_id}", partition_by=("end_day",))
    days = [r[0] for r in closed.select("end_day").distinct().collect()]  # a row per day
    _write_manifest(spark, layout, snap_id, {d: snap_id for d in days})
    publish_snapshot(spark, open_path, snap_id)


# --- J5/J6: reports ----------------------------------------------------------------------

def run_reports(spark, layout: Layout, n: int = 3, ascending: bool = False, files=None):
    """Head-counts (one pass, then one table per dimension) and top-n payers."""
    wide = T.wide_for_reports(spark.read.parquet(layout.idl("idl_member")))
    write_table(R.headcounts_all(wide), layout.adl("headcounts"), partition_by=("dimension",), files=files)
    counts = spark.read.schema(R.HEADCOUNTS_SCHEMA).parquet(layout.adl("headcounts"))
    for dim in R.HEADCOUNT_DIMENSIONS:
        one = counts.where(F.col("dimension") == dim).select(
            F.col("value").alias(dim), "num", "website"
        )
        write_table(one, layout.adl(f"{dim.replace('_', '')}_num"), files=files)
    write_table(R.top_payers(wide, n=n, ascending=ascending), layout.adl("topmemberpay"), files=files)


# --- J7: behaviour-log cleaner -----------------------------------------------------------

def run_clean_behaviour(spark, input_path: str, output_path: str, files: int | None = None):
    lines = I.read_lines(spark, input_path)
    write_text(B.clean_lines(lines), output_path, files=files)


def run_load_behaviour(
    spark, layout: Layout, input_path: str, tz_offset_hours: int = 8, files=None, load_id: str | None = None
):
    """Cleaned lines -> dwd.user_behavior, stored as ``load=<id>/dt=<day>``.

    A load adds to the days it holds, whatever other loads have of them; running the same
    load again (same ``load_id``, by default the input path's digest) replaces what it wrote.
    Readers see the union of all loads, and a filter on ``dt`` prunes inside each.
    """
    load_id = load_id or hashlib.sha256(input_path.encode()).hexdigest()[:16]
    parsed = B.parse_lines(B.clean_lines(I.read_lines(spark, input_path)), tz_offset_hours=tz_offset_hours)
    parsed = parsed.coalesce(files) if files else parsed
    target = f"{layout.dwd('user_behavior')}/load={load_id}"
    parsed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("dt").parquet(target)


# --- J8: daily video users -------------------------------------------------------------------

def run_daily_video_users(spark, layout: Layout, day: str, files=None) -> DataFrame:
    """Counts for one day from dwd.user_behavior (partition-pruned to ``dt = day``)."""
    check_day(day)
    beh = spark.read.schema(B.BEHAVIOUR_SCHEMA).parquet(layout.dwd("user_behavior"))
    out = B.daily_video_users(beh, day=day)
    write_partition(out, layout.tmp("app_course_study_analysis"), "dt", day, files=files)
    return out


def run_daily_video_spans(spark, layout: Layout, day: str) -> None:
    """The day's mergeable tables of distinct users (exact and sketched); a re-run replaces them."""
    check_day(day)
    beh = spark.read.schema(B.BEHAVIOUR_SCHEMA).parquet(layout.dwd("user_behavior"))
    write_partition(U.daily_bitmaps(beh, day), layout.tmp("video_user_bitmaps"), "dt", day)
    write_partition(U.daily_sketches(beh, day), layout.tmp("video_user_sketches"), "dt", day)


def read_video_users(
    spark, layout: Layout, first: str | None = None, last: str | None = None, span: str | None = None, exact: bool = True
) -> DataFrame:
    """Distinct video users from ``first`` to ``last`` (or per ``span`` in it), merged from the days'
    tables: the events aren't read again, and only the days asked for are read at all."""
    table, schema, merge = (
        ("video_user_bitmaps", U.BITMAP_SCHEMA, U.exact_users) if exact else ("video_user_sketches", U.SKETCH_SCHEMA, U.estimated_users)
    )
    return merge(U.between(spark.read.schema(schema).parquet(layout.tmp(table)), first, last), span)


# --- J9/J10: streaming -------------------------------------------------------------------------

def stream_lines(spark: SparkSession, kafka_servers: str | None, topic: str | None, file_dir: str | None,
                 starting_offsets: str = "latest") -> DataFrame:
    """Behaviour lines from Kafka (``value``, ``kafka_ts``) or from files arriving in a folder."""
    if kafka_servers:
        return S.kafka_lines(spark, kafka_servers, topic, starting_offsets)
    if file_dir:
        return S.file_lines(spark, file_dir)
    raise JobArgumentError("give --kafka-servers and --topic, or --file-dir")


def stream_paths(
    spark: SparkSession, name: str, sink: str | None, checkpoint: str | None, root: str | None = None
) -> tuple[str, str]:
    """Sink and checkpoint locations: those given, or folders below ``root`` (by default
    ``spark.checkpoint.dir``), the same at every start. Without either the job refuses to
    start: a stream whose state lies in a new folder each time would lose its offsets and
    its results."""
    if root is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not (sink and checkpoint):
        raise JobArgumentError("give --sink and --checkpoint, or set spark.checkpoint.dir to a shared folder")
    paths = sink or f"{root.rstrip('/')}/streams/{name}/sink", checkpoint or f"{root.rstrip('/')}/streams/{name}/checkpoint"
    if not spark.sparkContext.master.startswith("local") and any(re.match(r"(file:|/)", p) for p in paths):
        raise JobArgumentError(f"on a cluster the sink and checkpoint must be on shared storage, not {paths}")
    return paths


def start_vip_increment(
    spark, lines: DataFrame, ip_ranges: DataFrame, sink_path: str, checkpoint: str, **kw
):
    agg = S.vip_increments(lines, ip_ranges, **{k: v for k, v in kw.items() if k in ("tz_offset_hours", "watermark")})
    return S.start_upsert_stream(
        agg, sink_path, checkpoint, trigger=kw.get("trigger", S.DEFAULT_TRIGGER),
        available_now=kw.get("available_now", False), state_partitions=kw.get("state_partitions"),
        sink_files=kw.get("sink_files"),
    )


def start_unpaid_visitors(
    spark, lines: DataFrame, vip_users: Callable[[SparkSession], DataFrame], sink_path: str, checkpoint: str, **kw
):
    """``vip_users(spark)`` opens the VIP table; it is called anew for every micro-batch, so a
    user who became VIP in between is not flagged."""
    opts = {k: v for k, v in kw.items() if k in ("window", "slide", "watermark", "min_visits", "time_col")}
    agg = S.unpaid_visitors(lines, None, **opts)
    return S.start_upsert_stream(
        agg, sink_path, checkpoint, trigger=kw.get("trigger", S.DEFAULT_TRIGGER),
        available_now=kw.get("available_now", False), state_partitions=kw.get("state_partitions"),
        sink_files=kw.get("sink_files"),
        per_batch=lambda df: S.without_vip(df, vip_users(df.sparkSession)),
    )


# --- command line -------------------------------------------------------------------------------

def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="learnmetrics.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("ingest")
    p.add_argument("warehouse")
    p.add_argument("raw_dir")
    p.add_argument("dt")
    p.add_argument("--tables", nargs="*")
    p = sub.add_parser("wide")
    p.add_argument("warehouse")
    p.add_argument("--fanout", default="safe", choices=["safe", "reference"])
    p.add_argument("--money-default", type=int, help="money of members without payments")
    p = sub.add_parser("zipper")
    p.add_argument("warehouse")
    p.add_argument("dt")
    p.add_argument("--close", default="all", choices=["all", "last"])
    p = sub.add_parser("zipper-daily")
    p.add_argument("warehouse")
    p.add_argument("dt")
    p = sub.add_parser("zipper-rebuild")
    p.add_argument("warehouse")
    p = sub.add_parser("zipper-clean")
    p.add_argument("warehouse")
    p = sub.add_parser("reports")
    p.add_argument("warehouse")
    p.add_argument("--n", type=int, default=3, help="payers per member level")
    p.add_argument("--ascending", action="store_true", help="the smallest payers")
    p = sub.add_parser("clean")
    p.add_argument("input_path")
    p.add_argument("output_path")
    p = sub.add_parser("load-behaviour")
    p.add_argument("warehouse")
    p.add_argument("input_path")
    p.add_argument("--load-id", help="the same id replaces what an earlier run of the load wrote")
    p.add_argument("--tz-offset-hours", type=int, default=8)
    p = sub.add_parser("video")
    p.add_argument("warehouse")
    p.add_argument("day")
    for name in ("vip-stream", "unpaid-stream"):
        p = sub.add_parser(name)
        p.add_argument("--kafka-servers")
        p.add_argument("--topic")
        p.add_argument("--starting-offsets", default="latest", help='"earliest", "latest" or a JSON offset map')
        p.add_argument("--file-dir")
        p.add_argument("--sink")
        p.add_argument("--checkpoint")
        p.add_argument("--trigger", default=S.DEFAULT_TRIGGER)
        p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
        p.add_argument("--state-partitions", type=int)
        p.add_argument("--sink-files", type=int, help="files per micro-batch in the change log")
        p.add_argument("--watermark")
    p = sub.choices["vip-stream"]
    p.add_argument("--ip-ranges", required=True, help="CSV with header lo,hi,region")
    p.add_argument("--dotted", action="store_true", help="lo/hi are dotted IPv4 text")
    p.add_argument("--nested-ranges", action="store_true", help="ranges may lie inside and across each other; the narrowest counts")
    p.add_argument("--tz-offset-hours", type=int, default=8)
    p = sub.choices["unpaid-stream"]
    p.add_argument("--vip-users", required=True, help="Parquet table with a uid column")
    p.add_argument("--window", default="60 seconds")
    p.add_argument("--slide", default="30 seconds")
    p.add_argument("--min-visits", type=int, default=3)
    p.add_argument("--arrival-time", action="store_true", help="window on the Kafka arrival time")
    p = sub.add_parser("compact")
    p.add_argument("stream", choices=["vip-stream", "unpaid-stream"])
    p.add_argument("--clean", action="store_true", help="remove folded batches and older snapshots afterwards")
    p.add_argument("--sink")
    for name in ("ingest", "wide", "zipper", "reports", "clean", "load-behaviour", "video"):
        sub.choices[name].add_argument("--files", type=int, help="output files of each write")
    a = ap.parse_args(argv)

    spark = get_session(f"learnmetrics-{a.job}")
    if a.job == "ingest":
        run_ingest(spark, Layout(a.warehouse), a.raw_dir, check_day(a.dt), a.tables, files=a.files)
    elif a.job == "wide":
        run_wide_member(spark, Layout(a.warehouse), a.fanout, a.money_default, files=a.files)
    elif a.job == "zipper":
        run_zipper(spark, Layout(a.warehouse), check_day(a.dt), a.close, files=a.files)
    elif a.job == "zipper-daily":
        run_zipper_daily(spark, Layout(a.warehouse), check_day(a.dt))
    elif a.job == "zipper-rebuild":
        run_zipper_rebuild(spark, Layout(a.warehouse))
    elif a.job == "zipper-clean":
        clean_zipper(spark, Layout(a.warehouse))
    elif a.job == "reports":
        run_reports(spark, Layout(a.warehouse), n=a.n, ascending=a.ascending, files=a.files)
    elif a.job == "clean":
        run_clean_behaviour(spark, a.input_path, a.output_path, files=a.files)
    elif a.job == "load-behaviour":
        run_load_behaviour(spark, Layout(a.warehouse), a.input_path, a.tz_offset_hours, a.files, a.load_id)
    elif a.job == "video":
        run_daily_video_users(spark, Layout(a.warehouse), check_day(a.day), files=a.files)
        run_daily_video_spans(spark, Layout(a.warehouse), a.day)
    elif a.job in ("vip-stream", "unpaid-stream"):
        from learnmetrics.sources.lookups import check_ip_ranges, read_ip_ranges

        lines = stream_lines(spark, a.kafka_servers, a.topic, a.file_dir, a.starting_offsets)
        sink, ckpt = stream_paths(spark, a.job, a.sink, a.checkpoint)
        kw = dict(trigger=a.trigger, available_now=a.available_now, state_partitions=a.state_partitions,
                  sink_files=a.sink_files)
        if a.watermark:
            kw["watermark"] = a.watermark
        if a.job == "vip-stream":
            ranges = read_ip_ranges(spark, a.ip_ranges, dotted=a.dotted)
            if a.nested_ranges:
                ranges = flatten_ranges(ranges)
            else:
                check_ip_ranges(ranges)
            q = start_vip_increment(spark, lines, ranges, sink, ckpt, tz_offset_hours=a.tz_offset_hours, **kw)
        else:
            kw.update(window=a.window, slide=a.slide, min_visits=a.min_visits)
            if a.arrival_time:
                kw["time_col"] = "kafka_ts"
            q = start_unpaid_visitors(spark, lines, lambda s: s.read.parquet(a.vip_users), sink, ckpt, **kw)
        q.awaitTermination()
    elif a.job == "compact":
        sink, _ = stream_paths(spark, a.stream, a.sink, None)
        if a.stream == "vip-stream":
            S.compact_vip_increments(spark, sink)
        else:
            S.compact_unpaid_visitors(spark, sink)
        if a.clean:
            clean_changelog(spark, sink)
    return 0


if __name__ == "__main__":
    sys.exit(main())
