"""Distinct video users over any span of days, from small daily tables that merge.

A day's events are read once; what is stored of the day can be merged with other days without
reading events again:

* **bitmaps** (exact): per day and metric, one bitmap of 32,768 bits per block of user ids.
  Days are or-ed block by block and the bits counted. Made for dense ids (a block with a single
  user still takes 4 KB), which user ids counted up from 1 are.
* **sketches** (approximate): per day and metric one HyperLogLog sketch of at most a few KB,
  whatever the number of users or how sparse their ids. The relative standard error is about
  0.8 / sqrt(2^lg_k): 1.3 % for the default 12.

Both reduce map-side before the shuffle, by (day, metric, block) and (day, metric).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnmetrics.operators import behaviour as B

WATCH, COMPLETE = "watch", "complete"
METRIC_COLUMNS = {WATCH: "watch_video_count", COMPLETE: "complete_video_count"}
LG_K = 12
BITMAP_SCHEMA = "metric string, block long, bits binary, dt string"
SKETCH_SCHEMA = "metric string, sketch binary, dt string"
SPANS = ("day", "week", "month", "quarter", "year")


def relative_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a sketch's count (it grows a little when sketches are merged)."""
    return 1.04 / 2 ** (lg_k / 2)


def _video_users(behaviour: DataFrame, day: str | None) -> DataFrame:
    """(dt, metric, uid) of every event that counts for a metric (an event counts for one at most)."""
    b = behaviour.where(F.col("event_key").isin(B.START_VIDEO, B.END_VIDEO) & F.col("uid").isNotNull() & F.col("dt").isNotNull())
    if day is not None:
        b = b.where(F.col("dt") == day)
    watched = F.col("end_video_time") - F.col("start_video_time") >= F.col("video_length")
    metric = F.when(F.col("event_key") == B.START_VIDEO, F.lit(WATCH)).when(watched, F.lit(COMPLETE))
    return b.select("dt", metric.alias("metric"), "uid").where(F.col("metric").isNotNull())


def daily_bitmaps(behaviour: DataFrame, day: str | None = None) -> DataFrame:
    """``metric, block, bits, dt``: users of every day (or of ``day``, pruned)."""
    users = _video_users(behaviour, day)
    block = F.bitmap_bucket_number("uid").alias("block")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("uid")).alias("bits")
    return users.groupBy("dt", "metric", block).agg(bits).select("metric", "block", "bits", "dt")


def daily_sketches(behaviour: DataFrame, day: str | None = None, lg_k: int = LG_K) -> DataFrame:
    """``metric, sketch, dt``: users of every day (or of ``day``, pruned)."""
    users = _video_users(behaviour, day)
    return users.groupBy("dt", "metric").agg(F.hll_sketch_agg("uid", lg_k).alias("sketch")).select("metric", "sketch", "dt")


def _day(dt: str) -> _dt.date:
    return _dt.datetime.strptime(dt, "%Y%m%d").date()


def between(days: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """The rows of ``first`` to ``last`` (yyyyMMdd, both included); prunes partitions by ``dt``."""
    if first is not None:
        days = days.where(F.col("dt") >= _day(first).strftime("%Y%m%d"))
    if last is not None:
        days = days.where(F.col("dt") <= _day(last).strftime("%Y%m%d"))
    return days


def _span_start(span: str) -> Column:
    if span not in SPANS:
        raise ValueError(f"span must be one of {SPANS}")
    return F.date_trunc(span, F.to_timestamp("dt", "yyyyMMdd")).cast("date").cast("string")


def _as_columns(counts: DataFrame, keys: list[str]) -> DataFrame:
    """One column per metric; a span without users of a metric has 0."""
    each = [F.coalesce(F.max(F.when(F.col("metric") == m, F.col("users"))), F.lit(0)).cast("bigint").alias(c) for m, c in METRIC_COLUMNS.items()]
    return counts.groupBy(*keys).agg(*each)


def exact_users(bitmaps: DataFrame, span: str | None = None) -> DataFrame:
    """Distinct users of each ``span`` (``span_start`` yyyy-MM-dd), or without one of all days given:
    ``watch_video_count, complete_video_count``."""
    keys = ["span_start"] if span else []
    rows = bitmaps.withColumn("span_start", _span_start(span)) if span else bitmaps
    merged = rows.groupBy(*keys, "metric", "block").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return _as_columns(merged.groupBy(*keys, "metric").agg(F.sum("n").alias("users")), keys)


def estimated_users(sketches: DataFrame, span: str | None = None) -> DataFrame:
    """As :func:`exact_users`, estimated from merged sketches."""
    keys = ["span_start"] if span else []
    rows = sketches.withColumn("span_start", _span_start(span)) if span else sketches
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("users")
    return _as_columns(rows.groupBy(*keys, "metric").agg(merged), keys)
