import os
import tempfile

from pyspark.sql.types import LongType, StructField, StructType

from learnmetrics.sinks.writers import read_changelog, upsert_changelog_batch
from learnmetrics.streaming import jobs as S

from conftest import rows

B = 65536
DAY = 1554134400  # 2019-04-02 00:00 at +8


def line(uid, key, t, ip="0.0.0.5"):
    f = [str(uid), f"u{uid}", "F", "1", "0", "ios", "auto", "wifi", ip, "18735100001", "1", "300", "0", "0", "1.0", key, str(t)]
    return "\t".join(f)


def write_lines(d, name, items):
    with open(os.path.join(d, name), "w") as fh:
        fh.write("\n".join(items) + "\n")


def ip_ranges(spark):
    return spark.createDataFrame([(0, 99, "north"), (B, 2 * B, "south")], "lo long, hi long, region string")


def run(spark, agg, sink, ckpt, keys):
    q = S.start_upsert_stream(agg, sink, ckpt, available_now=True)
    q.awaitTermination()
    schema = StructType(list(agg.schema.fields) + [StructField("batch_id", LongType())])
    return read_changelog(spark, sink, keys, ["cnt"], schema=schema)


def test_vip_stream_equals_batch_and_survives_restart(spark):
    d = tempfile.mkdtemp(prefix="lm-src-")
    out = tempfile.mkdtemp(prefix="lm-out-")
    first = [line(1, "completeOrder", DAY + 60), line(2, "completeOrder", DAY + 120, ip="0.1.0.1"),
             line(3, "completeOrder", DAY + 86400 + 5, ip="9.9.9.9"), line(4, "startVideo", DAY), "bad line"]
    write_lines(d, "a.txt", first)
    src = S.file_lines(spark, d)
    agg = S.vip_increments(src, ip_ranges(spark), watermark=None)
    got = run(spark, agg, f"{out}/sink", f"{out}/ckpt", S.VIP_KEYS)
    assert rows(got) == [("2019-04-02", "north", 1), ("2019-04-02", "south", 1), ("2019-04-03", "未知", 1)]

    # more data arrives; restart from the same checkpoint continues the running totals
    second = [line(5, "completeOrder", DAY + 300), line(6, "completeOrder", DAY + 86400 + 9, ip="9.9.9.9")]
    write_lines(d, "b.txt", second)
    agg2 = S.vip_increments(S.file_lines(spark, d), ip_ranges(spark), watermark=None)
    got2 = run(spark, agg2, f"{out}/sink", f"{out}/ckpt", S.VIP_KEYS)
    batch = S.vip_increments(spark.createDataFrame([(x,) for x in first + second], "value string"), ip_ranges(spark))
    assert rows(got2) == rows(batch) == [("2019-04-02", "north", 2), ("2019-04-02", "south", 1), ("2019-04-03", "未知", 2)]


def test_changelog_replay_is_idempotent(spark):
    out = tempfile.mkdtemp(prefix="lm-log-")
    df1 = spark.createDataFrame([("d", "r", 1)], "dt string, province string, cnt long")
    df2 = spark.createDataFrame([("d", "r", 3), ("d", "s", 1)], "dt string, province string, cnt long")
    upsert_changelog_batch(df1, 0, out)
    upsert_changelog_batch(df2, 1, out)
    upsert_changelog_batch(df2, 1, out)  # replay of batch 1 after a failure
    assert rows(read_changelog(spark, out, ["dt", "province"], ["cnt"])) == [("d", "r", 3), ("d", "s", 1)]


def test_unpaid_visitors_stream_excludes_vips_and_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="lm-src-")
    out = tempfile.mkdtemp(prefix="lm-out-")
    t0 = DAY
    items = [line(1, "enterOrderPage", t0 + i) for i in (1, 10, 20)]          # 3 visits within a minute
    items += [line(2, "enterOrderPage", t0 + i) for i in (1, 10, 20, 25)]     # VIP
    items += [line(3, "enterOrderPage", t0 + i) for i in (1, 200)]            # too few
    items += [line(1, "completeOrder", t0 + 5)]
    write_lines(d, "a.txt", items)
    vip = spark.createDataFrame([(1, "2")], "id int, uid string")
    agg = S.unpaid_visitors(S.file_lines(spark, d), vip)
    got = rows(run(spark, agg, f"{out}/sink", f"{out}/ckpt", S.UNPAID_KEYS))
    batch = rows(S.unpaid_visitors(spark.createDataFrame([(x,) for x in items], "value string"), vip, watermark=None))
    assert got == batch
    assert {r[0] for r in got} == {1}
    assert all(r[3] >= 3 and r[2] - r[1] == 60 for r in got)


def test_recent_days_keeps_state_inside_retention(spark):
    totals = spark.createDataFrame(
        [("2019-04-01", "r", 1), ("2019-04-02", "r", 1), ("2019-04-03", "r", 1), ("2019-04-04", "r", 1)],
        "dt string, province string, cnt long",
    )
    ref = DAY + 2 * 86400 + 3600  # 2019-04-04 01:00 at +8
    got = [r.dt for r in S.recent_days(totals, ref, retention_days=2).orderBy("dt").collect()]
    # the watermark is 2019-04-02 01:00; only days that ended before it are dropped
    assert got == ["2019-04-02", "2019-04-03", "2019-04-04"]


def test_stream_plan_has_no_python(spark):
    d = tempfile.mkdtemp(prefix="lm-src-")
    write_lines(d, "a.txt", [line(1, "completeOrder", DAY)])
    agg = S.vip_increments(S.file_lines(spark, d), ip_ranges(spark))
    assert agg.isStreaming
    text = agg._jdf.queryExecution().analyzed().toString()
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_unpaid_visitors_on_arrival_time_column(spark):
    import datetime as dt

    base = dt.datetime(2019, 4, 2, 0, 0, 0)
    # event times are far apart, arrival times close together: only arrival windows count 3
    data = [(line(9, "enterOrderPage", DAY + i * 10000), base + dt.timedelta(seconds=i)) for i in range(3)]
    df = spark.createDataFrame(data, "value string, kafka_ts timestamp")
    vip = spark.createDataFrame([], "id int, uid string")
    assert S.unpaid_visitors(df, vip, watermark=None).count() == 0
    got = S.unpaid_visitors(df, vip, watermark=None, time_col="kafka_ts").collect()
    assert {r.uid for r in got} == {9} and all(r.cnt == 3 for r in got)


def test_changelog_compaction_keeps_current_table(spark):
    from learnmetrics.sinks.writers import compact_changelog

    out = tempfile.mkdtemp(prefix="lm-log-")
    keys, vals = ["dt", "province"], ["cnt"]
    b = lambda rows: spark.createDataFrame(rows, "dt string, province string, cnt long")
    upsert_changelog_batch(b([("d", "r", 1), ("d", "s", 5)]), 0, out)
    upsert_changelog_batch(b([("d", "r", 2)]), 1, out)
    before = rows(read_changelog(spark, out, keys, vals))
    assert "snapshot=00000000000000000001_" in compact_changelog(spark, out, keys, vals)
    assert rows(read_changelog(spark, out, keys, vals)) == before == [("d", "r", 2), ("d", "s", 5)]
    upsert_changelog_batch(b([("d", "s", 7), ("e", "r", 1)]), 2, out)
    upsert_changelog_batch(b([("d", "s", 7), ("e", "r", 1)]), 2, out)  # replay
    assert rows(read_changelog(spark, out, keys, vals)) == [("d", "r", 2), ("d", "s", 7), ("e", "r", 1)]
    compact_changelog(spark, out, keys, vals)
    assert rows(read_changelog(spark, out, keys, vals)) == [("d", "r", 2), ("d", "s", 7), ("e", "r", 1)]


def test_vip_lookup_is_current_in_every_batch(spark):
    d, out = tempfile.mkdtemp(prefix="lm-src-"), tempfile.mkdtemp(prefix="lm-out-")
    vip_path = f"{out}/vip"
    spark.createDataFrame([], "id int, uid string").write.parquet(vip_path)

    def start():
        agg = S.unpaid_visitors(S.file_lines(spark, d), None)
        q = S.start_upsert_stream(
            agg, f"{out}/sink", f"{out}/ckpt", available_now=True,
            per_batch=lambda df: S.without_vip(df, df.sparkSession.read.parquet(vip_path)),
        )
        q.awaitTermination()
        return {r.uid for r in S.read_unpaid_visitors(spark, f"{out}/sink").collect()}

    write_lines(d, "a.txt", [line(1, "enterOrderPage", DAY + i) for i in (1, 10, 20)])
    assert start() == {1}
    spark.createDataFrame([(1, "7")], "id int, uid string").write.mode("append").parquet(vip_path)
    write_lines(d, "b.txt", [line(u, "enterOrderPage", DAY + i) for u in (7, 8) for i in (1, 10, 20)])
    assert start() == {1, 8}


def test_streams_read_a_table_of_many_files(spark):
    import shutil

    from learnmetrics.plans import catalog as Q

    from conftest import SF_SMALL

    root = tempfile.mkdtemp(prefix="lm-sf-")
    for t in ("customer", "nation"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{root}/{t}.parquet")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5).write.parquet(f"{root}/events.parquet")
    for name in ("vip_increment_stream", "unpaid_visitors_stream"):
        assert rows(Q.queries()[name](spark, root)) == rows(Q.queries()[name](spark, SF_SMALL)), name


def test_late_rows_behind_the_watermark_are_dropped_and_reported(spark):
    d, out = tempfile.mkdtemp(prefix="lm-src-"), tempfile.mkdtemp(prefix="lm-out-")

    def start():
        agg = S.vip_increments(S.file_lines(spark, d), ip_ranges(spark), watermark="1 hour")
        q = S.start_upsert_stream(agg, f"{out}/sink", f"{out}/ckpt", available_now=True)
        q.awaitTermination()
        return sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])

    write_lines(d, "a.txt", [line(1, "completeOrder", DAY + 60), line(2, "completeOrder", DAY + 10 * 86400)])
    assert start() == 0
    write_lines(d, "b.txt", [line(3, "completeOrder", DAY + 120), line(4, "completeOrder", DAY + 10 * 86400 + 5)])
    assert start() == 1
    got = {r.dt: r.cnt for r in S.read_vip_increments(spark, f"{out}/sink").collect()}
    assert sum(got.values()) == 3


def test_graceful_stop_and_processing_time_trigger(spark):
    d, out = tempfile.mkdtemp(prefix="lm-src-"), tempfile.mkdtemp(prefix="lm-out-")
    write_lines(d, "a.txt", [line(1, "completeOrder", DAY + 60)])
    agg = S.vip_increments(S.file_lines(spark, d), ip_ranges(spark))
    q = S.start_upsert_stream(agg, f"{out}/sink", f"{out}/ckpt", trigger="1 second")
    S.stop_gracefully(q, timeout_s=30)
    assert not q.isActive and S.read_vip_increments(spark, f"{out}/sink").count() == 1


def test_compaction_never_rewrites_and_clean_up_keeps_the_table(spark):
    from learnmetrics.sinks.writers import clean_changelog, compact_changelog

    out = tempfile.mkdtemp(prefix="lm-log-")
    keys, vals = ["dt", "province"], ["cnt"]
    for batch, n in enumerate((1, 2, 3)):
        upsert_changelog_batch(spark.createDataFrame([("d", "r", n)], "dt string, province string, cnt long"), batch, out)
    one, two = compact_changelog(spark, out, keys, vals), compact_changelog(spark, out, keys, vals)
    assert one != two and spark.read.parquet(one).count() == 1
    upsert_changelog_batch(spark.createDataFrame([("e", "r", 9)], "dt string, province string, cnt long"), 3, out)
    before = rows(read_changelog(spark, out, keys, vals))
    gone = clean_changelog(spark, out)
    assert {"batch_id=0", "batch_id=1", "batch_id=2"} <= set(gone) and len(gone) == 4
    assert rows(read_changelog(spark, out, keys, vals)) == before == [("d", "r", 3), ("e", "r", 9)]
