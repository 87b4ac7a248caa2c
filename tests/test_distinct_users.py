"""Distinct users merged over spans of days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from learnmetrics.operators import behaviour as B
from learnmetrics.operators import distinct_users as U

from conftest import rows


def _behaviour(spark, n_days=40, users=3000):
    """Deterministic events: every user starts videos on some days, watches some to the end."""
    day = F.expr("date_format(date_add(date'2024-01-25', cast(id % {} as int)), 'yyyyMMdd')".format(n_days))
    uid = F.expr(f"(id * 7919) % {users} - 5")  # a few ids are negative, one is 0
    key = F.when(F.col("id") % 3 == 0, F.lit(B.START_VIDEO)).when(F.col("id") % 3 == 1, F.lit(B.END_VIDEO)).otherwise(F.lit("startApp"))
    return spark.range(20_000).select(
        uid.alias("uid"), key.alias("event_key"), F.lit(0).cast("long").alias("start_video_time"), (F.col("id") % 10).alias("end_video_time"),
        F.lit(5).cast("long").alias("video_length"), day.alias("dt"),
    )


def _exact(behaviour, start):
    start_uid = F.when(F.col("event_key") == B.START_VIDEO, F.col("uid"))
    end_uid = F.when((F.col("event_key") == B.END_VIDEO) & (F.col("end_video_time") - F.col("start_video_time") >= F.col("video_length")), F.col("uid"))
    return rows(behaviour.groupBy(start.alias("span_start")).agg(F.count_distinct(start_uid).alias("w"), F.count_distinct(end_uid).alias("c")))


@pytest.mark.parametrize("span", ["day", "week", "month"])
def test_bitmaps_equal_count_distinct(spark, span):
    behaviour = _behaviour(spark)
    start = F.date_trunc(span, F.to_timestamp("dt", "yyyyMMdd")).cast("date").cast("string")
    assert rows(U.exact_users(U.daily_bitmaps(behaviour), span)) == _exact(behaviour, start)


def test_any_span_of_stored_days(spark, tmp_path):
    behaviour = _behaviour(spark)
    U.daily_bitmaps(behaviour).write.partitionBy("dt").parquet(f"{tmp_path}/b")
    stored = spark.read.schema(U.BITMAP_SCHEMA).parquet(f"{tmp_path}/b")
    for first, last in (("20240201", "20240213"), ("20240125", "20240304"), ("20240210", "20240210"), (None, "20240131")):
        days = U.between(stored, first, last)
        want = _exact(U.between(behaviour, first, last), F.lit("x"))
        assert [("x", *r) for r in rows(U.exact_users(days))] == want
    plan = U.between(stored, "20240210", "20240211")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert rows(U.exact_users(stored.limit(0))) in ([], [(0, 0)])


def test_sketches_stay_within_their_error(spark):
    behaviour = _behaviour(spark, users=9000)
    sketches, bitmaps = U.daily_sketches(behaviour), U.daily_bitmaps(behaviour)
    for span in ("week", "month", None):
        exact, about = rows(U.exact_users(bitmaps, span)), rows(U.estimated_users(sketches, span))
        assert len(exact) == len(about) > 0
        for e, a in zip(exact, about, strict=True):
            for x, y in zip(e[-2:], a[-2:], strict=True):
                assert abs(x - y) <= max(1, 4 * U.relative_error() * x)
    assert U.relative_error(12) == pytest.approx(0.01625)
    assert sketches.select(F.max(F.length("sketch"))).first()[0] < 5000


def test_one_day_and_odd_rows(spark):
    odd = spark.createDataFrame(
        [(None, B.START_VIDEO, 0, 9, 1, "20240101"), (1, B.START_VIDEO, 0, 9, 1, None), (1, B.END_VIDEO, None, 9, 1, "20240101"),
         (2, B.END_VIDEO, 0, 9, 9, "20240101"), (2, B.END_VIDEO, 0, 9, 9, "20240101"), (3, None, 0, 9, 1, "20240101"), (4, B.START_VIDEO, 0, 0, 0, "20240102")],
        "uid long, event_key string, start_video_time long, end_video_time long, video_length long, dt string",
    )
    assert rows(U.exact_users(U.daily_bitmaps(odd), "day")) == [("2024-01-01", 0, 1), ("2024-01-02", 1, 0)]
    assert rows(U.exact_users(U.daily_bitmaps(odd, day="20240101"), "day")) == [("2024-01-01", 0, 1)]
    assert rows(U.estimated_users(U.daily_sketches(odd), "day")) == [("2024-01-01", 0, 1), ("2024-01-02", 1, 0)]
    assert U.between(odd, str(dt.date(2024, 1, 2)).replace("-", "")).count() == 1
    with pytest.raises(ValueError):
        U.exact_users(U.daily_bitmaps(odd), "fortnight")
