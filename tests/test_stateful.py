"""Per-key expiring totals, windows by panes, the offset ledger."""

import json
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from learnmetrics.streaming import jobs as S
from learnmetrics.streaming import ledger as G
from learnmetrics.streaming import stateful as K

from conftest import rows
from test_streaming import DAY, ip_ranges, line, write_lines

H = 3600


def _run(spark, src, out, initial=None, **kw):
    totals = K.vip_totals(S.file_lines(spark, src), ip_ranges(spark), initial=initial, **kw)
    q = K.start_vip_totals(totals, f"{out}/sink", f"{out}/ckpt", initial, available_now=True, state_partitions=2)
    q.awaitTermination()
    return {(r.dt, r.province): (r.cnt, r.expired) for r in K.read_vip_totals(spark, f"{out}/sink", with_expired=True).collect()}


def test_totals_expire_key_by_key_and_survive_a_restart(spark):
    src, out = tempfile.mkdtemp(prefix="lm-src-"), tempfile.mkdtemp(prefix="lm-out-")
    write_lines(src, "a.txt", [line(1, "completeOrder", DAY + 60), line(2, "completeOrder", DAY + 60, ip="0.1.0.1"), line(3, "startVideo", DAY)])
    assert _run(spark, src, out, retention_days=1) == {("2019-04-02", "north"): (1, False), ("2019-04-02", "south"): (1, False)}
    # A restart goes on with the stored totals; the second day does not touch the first one's clock.
    write_lines(src, "b.txt", [line(4, "completeOrder", DAY + 7 * H), line(5, "completeOrder", DAY + 30 * H), line(5, "completeOrder", None), "bad"])
    assert _run(spark, src, out, retention_days=1) == {
        ("2019-04-02", "north"): (2, False), ("2019-04-02", "south"): (1, False), ("2019-04-03", "north"): (1, False),
    }
    # The watermark passes the end of the first day plus a day: its keys go, the second day's stays.
    write_lines(src, "c.txt", [line(6, "completeOrder", DAY + 2 * 86400 + 5)])
    assert _run(spark, src, out, retention_days=1) == {
        ("2019-04-02", "north"): (2, True), ("2019-04-02", "south"): (1, True), ("2019-04-03", "north"): (1, False), ("2019-04-04", "north"): (1, False),
    }
    assert {r.dt for r in K.read_vip_totals(spark, f"{out}/sink").collect()} == {"2019-04-03", "2019-04-04"}


def test_totals_equal_the_batch_totals_of_the_last_two_days(spark):
    src, out = tempfile.mkdtemp(prefix="lm-src-"), tempfile.mkdtemp(prefix="lm-out-")
    items = [line(i, "completeOrder", DAY + i * 5 * H, ip=f"0.{i % 3}.0.1") for i in range(40)]
    write_lines(src, "a.txt", items)
    _run(spark, src, out, retention_days=2)
    batch = S.vip_increments(spark.createDataFrame([(x,) for x in items], "value string"), ip_ranges(spark), with_last_event=True)
    recent = S.recent_days(batch, DAY + 39 * 5 * H, retention_days=2)
    assert rows(K.read_vip_totals(spark, f"{out}/sink"), "dt", "province", "cnt") == rows(recent, "dt", "province", "cnt") != []


def test_totals_seeded_by_an_earlier_table(spark):
    src, out = tempfile.mkdtemp(prefix="lm-src-"), tempfile.mkdtemp(prefix="lm-out-")
    seed = [("2019-04-02", "north", 10, DAY + 5), ("2019-04-02", "north", 2, None), ("2019-03-01", "south", 7, DAY - 32 * 86400)]
    initial = spark.createDataFrame(seed, "dt string, province string, cnt long, last_event_time long")
    write_lines(src, "a.txt", [line(1, "completeOrder", DAY + 60), line(2, "completeOrder", DAY + 61, ip="9.9.9.9")])
    want = {("2019-04-02", "north"): (13, False), ("2019-04-02", "未知"): (1, False), ("2019-03-01", "south"): (7, True)}
    assert _run(spark, src, out, initial=initial, retention_days=2) == want
    # The seed counts at the first start only.
    write_lines(src, "b.txt", [line(3, "completeOrder", DAY + 62)])
    assert _run(spark, src, out, initial=initial, retention_days=2) == want | {("2019-04-02", "north"): (14, False)}


def test_time_to_live_by_the_wall_clock(spark, monkeypatch):
    monkeypatch.setattr(K, "DAY_S", 1)  # retention in seconds
    src, out = tempfile.mkdtemp(prefix="lm-src-"), tempfile.mkdtemp(prefix="lm-out-")

    def after(last: int) -> int:
        """The count once the event at ``last`` has been read."""
        totals = K.vip_totals(S.file_lines(spark, src), ip_ranges(spark), retention_days=4, expiry="processing_time")
        q = K.start_vip_totals(totals, f"{out}/sink", f"{out}/ckpt", trigger="1 second", state_partitions=1)
        try:
            for _ in range(120):
                time.sleep(0.5)
                if q.recentProgress:
                    found = [r.cnt for r in K.read_vip_totals(spark, f"{out}/sink").collect() if r.last_event_time == last]
                    if found:
                        return found[0]
        finally:
            q.stop()

    write_lines(src, "a.txt", [line(1, "completeOrder", DAY + 60)])
    assert after(DAY + 60) == 1
    time.sleep(6)
    write_lines(src, "b.txt", [line(2, "completeOrder", DAY + 61)])
    assert after(DAY + 61) == 1  # the first one's total is gone
    with pytest.raises(ValueError):
        K.vip_totals(S.file_lines(spark, src), ip_ranges(spark), expiry="never")


def _pane_items():
    items = [line(u, "enterOrderPage", DAY + (7 * u + 13 * i) % 400) for u in range(1, 9) for i in range(12)]
    return items + [line(1, "completeOrder", DAY + 5), line(99, "enterOrderPage", DAY + 4000)]


@pytest.mark.parametrize("window,slide", [("60 seconds", "30 seconds"), ("90 seconds", "30 seconds"), ("60 seconds", "60 seconds"), ("4 minutes", "1 minutes")])
def test_panes_equal_expanded_windows(spark, window, slide):
    df = spark.createDataFrame([(x,) for x in _pane_items()], "value string")
    vip = spark.createDataFrame([(1, "3")], "id int, uid string")
    whole = S.unpaid_visitors(df, vip, window, slide, watermark=None)
    panes = S.unpaid_visitors_by_panes(df, vip, window, slide, watermark=None)
    assert rows(panes) == rows(whole) != []


def test_pane_stream_puts_out_closed_windows_once_and_shuffles_less(spark):
    src, out = tempfile.mkdtemp(prefix="lm-src-"), tempfile.mkdtemp(prefix="lm-out-")
    write_lines(src, "a.txt", _pane_items())
    agg = S.unpaid_visitors_by_panes(S.file_lines(spark, src), None, "4 minutes", "30 seconds", watermark="10 seconds")
    q = S.start_upsert_stream(agg, f"{out}/sink", f"{out}/ckpt", available_now=True, output_mode="append", state_partitions=2)
    q.awaitTermination()
    log = spark.read.schema(S.UNPAID_LOG_SCHEMA).parquet(f"{out}/sink")
    df = spark.createDataFrame([(x,) for x in _pane_items()], "value string")
    whole = S.unpaid_visitors(df, None, "4 minutes", "30 seconds", watermark=None)
    closed = whole.where(F.col("window_end") <= DAY + 4000 - 10)
    assert rows(log.drop("batch_id")) == rows(closed) != []
    # Events are expanded eight times by the one, not at all by the other.
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    by_panes = plan(S.unpaid_visitors_by_panes(df, None, "4 minutes", "30 seconds", watermark=None))
    assert "Expand" in by_panes.split("Aggregate")[1] and "Expand" not in by_panes.split("Aggregate")[2]
    assert "Expand" in plan(S.unpaid_visitors(df, None, "4 minutes", "30 seconds", watermark=None)).split("Aggregate")[1]
    with pytest.raises(ValueError):
        S.unpaid_visitors_by_panes(df, None, "50 seconds", "30 seconds")


def test_ledger_follows_batches_over_a_restart(spark):
    src, out = tempfile.mkdtemp(prefix="lm-src-"), tempfile.mkdtemp(prefix="lm-out-")
    ledger = G.OffsetLedger(spark, f"{out}/ledger", only={"followed"}).attach()
    try:
        for turn, days in enumerate(((0, 10), (0, 10, 11))):
            for i, day in enumerate(days):
                write_lines(src, f"{turn}{i}.txt", [line(i, "completeOrder", DAY + day * 86400 + 60), "bad"])
            for name in ("followed", "other"):
                lines = S.file_lines(spark, src, max_files_per_trigger=1)
                agg = S.vip_increments(lines, ip_ranges(spark), watermark="1 hour")
                S.start_upsert_stream(agg, f"{out}/{name}/sink", f"{out}/{name}/ckpt", available_now=True, query_name=name, state_partitions=2).awaitTermination()
    finally:
        ledger.detach()
    told = G.read_ledger(spark, f"{out}/ledger")
    total = G.totals(told).collect()
    assert len(total) == 1 and total[0].input_rows == 10 and total[0].late_rows == 1 and total[0].batches >= 5
    assert G.gaps(told).count() == 0 and told.select("run_id").distinct().count() == 2
    assert [json.loads(r.end_offset)["logOffset"] for r in G.last_offsets(told).collect()] == [4]
    # A lost entry shows as a gap, and so does one that begins elsewhere.
    assert G.gaps(told.where("batch_id <> 2")).count() == 1
    moved = told.withColumn("start_offset", F.when(F.col("batch_id") == 1, F.lit('{"logOffset":7}')).otherwise(F.col("start_offset")))
    assert G.gaps(moved).count() == 1


def test_ledger_entries_of_progress_reports():
    source = {"description": "Kafka", "startOffset": {"t": {"1": 5, "0": 3}}, "endOffset": '{"t":{"0":9,"1":5}}', "numInputRows": 6}
    progress = {"id": "q", "runId": "r", "name": None, "batchId": 4, "timestamp": "x", "sources": [source, source | {"startOffset": None}],
                "stateOperators": [{"numRowsDroppedByWatermark": 2}, {}], "durationMs": {"addBatch": 1}}
    one, two = G.entries(progress)
    assert one["start_offset"] == '{"t":{"0":3,"1":5}}' and one["end_offset"] == '{"t":{"0":9,"1":5}}'
    assert (one["rows"], one["late_rows"], two["late_rows"], two["start_offset"]) == (6, 2, 0, None)
    assert G.entries(progress | {"durationMs": {"triggerExecution": 1}}) == []  # no micro-batch ran
