"""Running totals whose keys expire one by one.

:func:`learnmetrics.streaming.jobs.vip_increments` keeps its totals in a windowed aggregate:
one watermark drops them. Here each (day, region) has a state of its own with a clock of its
own, and totals of an earlier run can seed it:

* ``expiry="event_time"``: a timer at the end of the key's day plus the retention. When the
  watermark passes it the state goes, and a row marked ``expired`` says so downstream;
* ``expiry="processing_time"``: a time to live, counted from the key's last update by the wall
  clock, as where the age of a day is judged by the system time.
  Such a stream always has a next micro-batch, which looks for what has expired: run it with a
  trigger interval and stop it, since "available now" would not end.

Spark offers this kind of state to Python only through Python workers (Arrow batches, one
value state per key), with RocksDB as the state store; everything before it (parsing, the
region join) stays in the JVM, and only days, regions and event times travel to the workers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from learnmetrics.functions import columns as C
from learnmetrics.operators import behaviour as B
from learnmetrics.operators.geo import lookup_region, size_checked_ranges
from learnmetrics.sinks.writers import read_changelog, upsert_changelog_batch
from learnmetrics.streaming.jobs import VIP_KEYS, event_time, start_upsert_stream

# The processor travels to the Python workers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_S = 86400
TOTAL_COLUMNS = ["dt", "province", "cnt", "last_event_time", "expired"]
TOTAL_SCHEMA = "dt string, province string, cnt long, last_event_time long, expired boolean"
LOG_SCHEMA = "dt string, province string, cnt long, last_event_time long, expired boolean, batch_id long"


def expiry_epoch(dt: str, retention_days: int, tz_offset_hours: int) -> int:
    """End of the local day ``dt`` plus the retention, in epoch seconds."""
    start = int(pd.Timestamp(dt, tz="UTC").timestamp()) - tz_offset_hours * 3600
    return start + (1 + retention_days) * DAY_S


class _Totals(StatefulProcessor):
    """One total per key; see the module's text for when it goes."""

    def __init__(self, retention_days: int, tz_offset_hours: int, expiry: str):
        self.retention_days, self.tz_offset_hours, self.expiry = retention_days, tz_offset_hours, expiry

    def init(self, handle) -> None:
        self.handle = handle
        ttl = self.retention_days * DAY_S * 1000 if self.expiry == "processing_time" else None
        self.total = handle.getValueState("total", "cnt long, last_event_time long", ttl)

    def _put(self, key, cnt: int, last: int) -> None:
        if self.expiry == "event_time" and not self.total.exists():
            self.handle.registerTimer(expiry_epoch(key[0], self.retention_days, self.tz_offset_hours) * 1000)
        self.total.update((cnt, last))

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        # A seed table should have a row per key; where it has several, they add up.
        cnt, last = self.total.get() if self.total.exists() else (0, 0)
        seen = initialState["last_event_time"].fillna(0)
        self._put(key, int(cnt) + int(initialState["cnt"].sum()), max(int(last), int(seen.max())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        cnt, last = self.total.get() if self.total.exists() else (0, 0)
        for part in rows:
            cnt, last = cnt + len(part), max(last, int(part["event_time"].max()))
        self._put(key, int(cnt), int(last))
        yield self._row(key, int(cnt), int(last), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.total.exists():
            cnt, last = self.total.get()
            self.total.clear()
            yield self._row(key, int(cnt), int(last), True)

    def _row(self, key, cnt: int, last: int, expired: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, cnt, last, expired)], columns=TOTAL_COLUMNS)


def vip_totals(
    lines: DataFrame,
    ip_ranges: DataFrame,
    retention_days: int = 2,
    initial: DataFrame | None = None,
    expiry: str = "event_time",
    delay: str = "0 seconds",
    tz_offset_hours: int = 8,
    broadcast_ranges: bool | None = None,
) -> DataFrame:
    """completeOrder events of a stream -> changed totals per (local day, region): ``dt, province,
    cnt, last_event_time, expired``.

    ``initial`` (dt, province, cnt, last_event_time) seeds the state at the first start, and is
    ignored by a restart, whose state is in the checkpoint. ``delay`` is how far events may be
    late (event time only): the watermark is the latest event time less the delay. Rows behind
    the watermark are dropped and counted in the stream's progress.
    """
    if expiry not in ("event_time", "processing_time"):
        raise ValueError("expiry must be 'event_time' or 'processing_time'")
    if broadcast_ranges is None:
        broadcast_ranges = size_checked_ranges(ip_ranges)[1]
    ev = B.parse_lines(lines, tz_offset_hours=tz_offset_hours).where(F.col("event_key") == B.COMPLETE_ORDER)
    ev = ev.where(F.col("event_time").isNotNull()).select("event_time", C.ipv4_to_long("ip").alias("ip_num"))
    ev = event_time(lookup_region(ev, "ip_num", ip_ranges, region_col="province", broadcast=broadcast_ranges))
    ev = ev.select(C.epoch_to_day("event_time", tz_offset_hours).alias("dt"), "province", "event_time", "event_ts")
    by_event = expiry == "event_time"
    if by_event:
        ev = ev.withWatermark("event_ts", delay)
    seed = None if initial is None else initial.select("dt", "province", "cnt", "last_event_time").groupBy(*VIP_KEYS)
    return ev.groupBy(*VIP_KEYS).transformWithStateInPandas(
        _Totals(retention_days, tz_offset_hours, expiry), TOTAL_SCHEMA, "Update",
        "EventTime" if by_event else "ProcessingTime", seed,
    )


def _last_of_batch(df: DataFrame) -> DataFrame:
    """A key updated and expired in one micro-batch is expired."""
    last = F.max(F.struct("expired", "cnt", "last_event_time")).alias("v")
    return df.groupBy(*VIP_KEYS).agg(last).select(*VIP_KEYS, "v.cnt", "v.last_event_time", "v.expired")


def start_vip_totals(
    totals: DataFrame, sink_path: str, checkpoint_path: str, initial: DataFrame | None = None, **options
) -> StreamingQuery:
    """Run :func:`vip_totals` into a change log (options as of ``start_upsert_stream``).

    State can be seeded silently only, so the log begins with the seeds of ``initial`` as batch -1:
    keys without a new event keep theirs until their timer marks them as expired.
    """
    if initial is not None:
        seeds = initial.groupBy(*VIP_KEYS).agg(F.sum("cnt").alias("cnt"), F.max("last_event_time").alias("last_event_time"))
        upsert_changelog_batch(seeds.withColumn("expired", F.lit(False)), -1, sink_path)
    conf = totals.sparkSession.conf
    key = "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, ROCKSDB)  # the stream takes a copy of the settings when it starts
    try:
        return start_upsert_stream(totals, sink_path, checkpoint_path, per_batch=_last_of_batch, **options)
    finally:
        conf.set(key, before)


def read_vip_totals(spark: SparkSession, sink_path: str, with_expired: bool = False) -> DataFrame:
    """The totals that are still kept; with ``with_expired`` also the last ones of those that went."""
    now = read_changelog(spark, sink_path, VIP_KEYS, ["cnt", "last_event_time", "expired"], schema=LOG_SCHEMA)
    return now if with_expired else now.where(~F.col("expired")).drop("expired")
