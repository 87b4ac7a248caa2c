import json
import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from learnmetrics.plans import jobs as J

from conftest import rows


def write(d, name, items):
    with open(os.path.join(d, name), "w") as fh:
        fh.write("\n".join(json.dumps(x) if isinstance(x, dict) else x for x in items) + "\n")


def raw_day(d, pays):
    write(d, "baseadlog.log", [{"adid": 1, "adname": "ad1", "dn": "A"}, "bad"])
    write(d, "baswewebsite.log", [{"siteid": 5, "sitename": "s5", "siteurl": "u", "delete": 0, "dn": "A"}])
    write(d, "memberRegtype.log", [{"uid": 1, "appregurl": "http://a_b", "regsource": "1", "websiteid": 5, "dn": "A"},
                                   {"uid": 2, "appregurl": "http://c", "regsource": "3", "websiteid": 5, "dn": "A"}])
    write(d, "pcentermempaymoney.log", pays)
    write(d, "PcenterMemViplevel.log", [{"vip_id": 1, "vip_level": "gold", "start_time": "2019-01-01", "dn": "A"},
                                        {"vip_id": 2, "vip_level": "silver", "start_time": "2019-01-01", "dn": "A"}])
    write(d, "Member.log", [{"uid": 1, "ad_id": 1, "fullname": "Li", "phone": "13812345678", "memberlevel": "1", "dn": "A"},
                            {"uid": 2, "ad_id": "x", "dn": "A"},
                            {"uid": 3, "ad_id": 1, "fullname": "Wu", "phone": "13800000000", "memberlevel": "1", "dn": "A"}])
    write(d, "WxType.log", [{"app_id": "a", "bind_source": 1, "creator": "c", "dn": "A"}])


def test_daily_pipeline_end_to_end_and_rerun(spark):
    root = tempfile.mkdtemp(prefix="lm-wh-")
    layout = J.Layout(root)
    d1, d2 = tempfile.mkdtemp(), tempfile.mkdtemp()
    raw_day(d1, [{"uid": 1, "paymoney": "10.5", "vip_id": 1, "dn": "A"}, {"uid": 3, "paymoney": "2", "vip_id": 2, "dn": "A"}])
    raw_day(d2, [{"uid": 1, "paymoney": "4", "vip_id": 2, "dn": "A"}])

    J.run_ingest(spark, layout, d1, "20190711")
    J.run_zipper(spark, layout, "20190711")
    J.run_ingest(spark, layout, d2, "20190712")
    J.run_ingest(spark, layout, d2, "20190712")  # re-run of a day: partition replaced, not appended
    pay = J.read_bdl(spark, layout, "bdl_pcentermempaymoney")
    assert rows(pay.groupBy("time").count()) == [("20190711", 2), ("20190712", 1)]
    rej = spark.read.parquet(layout.rejects("bdl_member"))
    assert rows(rej, "reason", "time") == [("bad_int:ad_id", "20190711"), ("bad_int:ad_id", "20190712")]

    J.run_zipper(spark, layout, "20190712")
    J.run_zipper(spark, layout, "20190712")  # idempotent: same result as one run
    z = rows(J.read_zipper(spark, layout), "uid", "vip_level", "start_time", "end_time")
    assert z == [(1, "gold", "2019-07-11", "2019-07-12"), (1, "silver", "2019-07-12", "9999-12-31"),
                 (3, "silver", "2019-07-11", "9999-12-31")]

    J.run_wide_member(spark, layout)
    wide = spark.read.parquet(layout.idl("idl_member"))
    assert wide.count() == 2  # uid 2 was rejected at ingest
    one = wide.where(F.col("uid") == 1).first()
    assert (float(one.paymoney), one.fullname, one.phone, one.sitename, one.adname) == (14.5, "Lxx", "138*****5678", "s5", "ad1")

    J.run_reports(spark, layout)
    assert rows(spark.read.parquet(layout.adl("memberlevel_num"))) == [("1", 2, "A")]
    top = rows(spark.read.parquet(layout.adl("topmemberpay")), "uid", "rownum")
    assert top == [(1, 1), (3, 2)]


def test_behaviour_jobs(spark):
    root = tempfile.mkdtemp(prefix="lm-wh-")
    layout = J.Layout(root)
    src = tempfile.mkdtemp()
    day = 1554134400
    f = lambda uid, key, s, e: "\t".join([str(uid), "u", "F", "1", "0", "ios", "a", "wifi", "1.1.1.1", "18735100001", "1", "300", str(s), str(e), "1.0", key, str(day)])
    with open(os.path.join(src, "log.txt"), "w") as fh:
        fh.write("\n".join([f(1, "startVideo", 0, 0), f(1, "endVideo", 0, 300), f(2, "endVideo", 0, 10), "short\tline"]) + "\n")
    out = os.path.join(tempfile.mkdtemp(), "clean")
    J.run_clean_behaviour(spark, src, out, files=1)
    cleaned = [r.value for r in spark.read.text(out).collect()]
    assert len(cleaned) == 3 and all("187xxxx0001" in x for x in cleaned)
    J.run_load_behaviour(spark, layout, src)
    res = J.run_daily_video_users(spark, layout, "20190402")
    assert rows(res) == [(1, 1, "20190402")]
    plan = spark.read.schema(J.B.BEHAVIOUR_SCHEMA).parquet(layout.dwd("user_behavior")).where(F.col("dt") == "20190402")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_day_argument_checked(spark):
    with pytest.raises(J.JobArgumentError):
        J.check_day("2019-07-12")
    with pytest.raises(J.JobArgumentError):
        J.check_day("")


def test_zipper_day_read_is_partition_pruned_and_cli_runs(spark):
    from learnmetrics.operators.zipper import day_increment

    root = tempfile.mkdtemp(prefix="lm-wh-")
    layout = J.Layout(root)
    d1 = tempfile.mkdtemp()
    raw_day(d1, [{"uid": 1, "paymoney": "3", "vip_id": 1, "dn": "A"}])
    assert J.main(["ingest", root, d1, "20190711"]) == 0
    pay = J.read_bdl(spark, layout, "bdl_pcentermempaymoney")
    vip = J.read_bdl(spark, layout, "bdl_vip_level")
    plan = day_increment(pay, vip, day="20190711")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(time" in plan and "(time" in plan
    assert J.main(["zipper", root, "20190711"]) == 0
    assert rows(J.read_zipper(spark, layout), "uid", "start_time") == [(1, "2019-07-11")]
    with pytest.raises(J.JobArgumentError):
        J.main(["zipper", root, "2019-07-11"])


def test_stream_jobs_from_command_line(spark):
    from learnmetrics.streaming import jobs as S

    src, out = tempfile.mkdtemp(), tempfile.mkdtemp()
    day = 1554134400
    f = lambda uid, key, t, ip: "\t".join([str(uid), "u", "F", "1", "0", "ios", "a", "wifi", ip, "18735100001", "1", "300", "0", "0", "1.0", key, str(t)])
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("\n".join([f(1, "completeOrder", day + 5, "1.0.0.9"), f(2, "completeOrder", day + 9, "9.9.9.9")]
                           + [f(3, "enterOrderPage", day + i, "1.1.1.1") for i in (1, 2, 3)]) + "\n")
    with open(os.path.join(out, "ranges.csv"), "w") as fh:
        fh.write("lo,hi,region\n1.0.0.0,1.0.255.255,east\n")
    vip_path = os.path.join(out, "vip")
    spark.createDataFrame([(1, "2")], "id int, uid string").write.parquet(vip_path)
    common = ["--file-dir", src, "--available-now", "--state-partitions", "2", "--sink-files", "1"]
    assert J.main(["vip-stream", *common, "--sink", f"{out}/vs", "--checkpoint", f"{out}/vc",
                   "--ip-ranges", f"{out}/ranges.csv", "--dotted"]) == 0
    assert rows(S.read_vip_increments(spark, f"{out}/vs")) == [("2019-04-02", "east", 1), ("2019-04-02", "未知", 1)]
    assert J.main(["unpaid-stream", *common, "--sink", f"{out}/us", "--checkpoint", f"{out}/uc",
                   "--vip-users", vip_path]) == 0
    assert {r.uid for r in S.read_unpaid_visitors(spark, f"{out}/us").collect()} == {3}
    users = S.read_unpaid_users(spark, f"{out}/us").collect()
    assert [(u.uid, u.max_visits) for u in users] == [(3, 3)]
    assert J.main(["compact", "vip-stream", "--sink", f"{out}/vs"]) == 0
    assert rows(S.read_vip_increments(spark, f"{out}/vs")) == [("2019-04-02", "east", 1), ("2019-04-02", "未知", 1)]


def test_incremental_zipper_equals_full_recompute_with_rerun_and_late_day(spark):
    from learnmetrics.operators.zipper import close_out, day_increment

    root = tempfile.mkdtemp(prefix="lm-wh-")
    layout = J.Layout(root)
    days = {
        "20190710": [{"uid": 1, "paymoney": "5", "vip_id": 1, "dn": "A"}, {"uid": 2, "paymoney": "1", "vip_id": 1, "dn": "A"}],
        "20190711": [{"uid": 1, "paymoney": "3", "vip_id": 2, "dn": "A"}],
        "20190712": [{"uid": 1, "paymoney": "4", "vip_id": 1, "dn": "A"}, {"uid": 2, "paymoney": "2", "vip_id": 2, "dn": "A"},
                     {"uid": 3, "paymoney": "9", "vip_id": 2, "dn": "A"}],
    }

    def full():
        pay = J.read_bdl(spark, layout, "bdl_pcentermempaymoney")
        vip = J.read_bdl(spark, layout, "bdl_vip_level")
        return rows(close_out(day_increment(pay, vip)))

    for dt, pays in days.items():
        d = tempfile.mkdtemp()
        raw_day(d, pays)
        J.run_ingest(spark, layout, d, dt, tables=["bdl_pcentermempaymoney", "bdl_vip_level"])
        J.run_zipper_daily(spark, layout, dt)
        assert rows(J.read_zipper_inc(spark, layout)) == full(), dt

    # re-run the latest day with different payments: uid 1 and 2 no longer pay that day
    d = tempfile.mkdtemp()
    raw_day(d, [{"uid": 3, "paymoney": "9", "vip_id": 2, "dn": "A"}])
    J.run_ingest(spark, layout, d, "20190712", tables=["bdl_pcentermempaymoney"])
    J.run_zipper_daily(spark, layout, "20190712")
    J.run_zipper_daily(spark, layout, "20190712")
    assert rows(J.read_zipper_inc(spark, layout)) == full()
    opened = [r for r in J.read_zipper_inc(spark, layout).collect() if r.end_time == "9999-12-31"]
    assert sorted((r.uid, r.start_time) for r in opened) == [(1, "2019-07-11"), (2, "2019-07-10"), (3, "2019-07-12")]

    # a late day is refused by the daily job and handled by the rebuild
    d = tempfile.mkdtemp()
    raw_day(d, [{"uid": 2, "paymoney": "6", "vip_id": 1, "dn": "A"}])
    J.run_ingest(spark, layout, d, "20190709", tables=["bdl_pcentermempaymoney"])
    with pytest.raises(J.JobArgumentError):
        J.run_zipper_daily(spark, layout, "20190709")
    J.run_zipper_rebuild(spark, layout)
    assert rows(J.read_zipper_inc(spark, layout)) == full()


def test_snapshot_publication_survives_an_unpublished_write(spark):
    from learnmetrics.sinks.writers import latest_snapshot_path, new_snapshot_id, write_snapshot, write_table

    base = tempfile.mkdtemp(prefix="lm-snap-")
    assert latest_snapshot_path(spark, base) is None
    first = write_snapshot(spark.range(3), base, new_snapshot_id("20190701"))
    # a run that wrote its data but crashed before publishing changes nothing
    write_table(spark.range(5), f"{base}/snapshot={new_snapshot_id('20190702')}")
    assert latest_snapshot_path(spark, base) == first
    # a later re-run of an older day still becomes current (ids sort by write time)
    second = write_snapshot(spark.range(7), base, new_snapshot_id("20190601"))
    assert latest_snapshot_path(spark, base) == second
    assert spark.read.parquet(latest_snapshot_path(spark, base)).count() == 7


BEHAVIOUR_DAY = 1554134400


def behaviour_line(uid, key, start=0, end=300, day=BEHAVIOUR_DAY):
    return "\t".join([str(uid), "u", "F", "1", "0", "ios", "a", "wifi", "1.1.1.1", "18735100001", "1", "300", str(start), str(end), "1.0", key, str(day)])


def test_a_second_load_adds_to_a_day_and_a_repeated_one_does_not(spark):
    root = tempfile.mkdtemp(prefix="lm-wh-")
    layout = J.Layout(root)
    one, two = tempfile.mkdtemp(), tempfile.mkdtemp()
    for d, uids in ((one, range(5)), (two, [7])):
        with open(os.path.join(d, "log.txt"), "w") as fh:
            fh.write("\n".join(behaviour_line(u, "startVideo") for u in uids) + "\n")
    for src in (one, two, one):
        assert J.main(["load-behaviour", root, src]) == 0
    assert J.main(["video", root, "20190402"]) == 0
    out = spark.read.parquet(layout.tmp("app_course_study_analysis"))
    assert [r.watch_video_count for r in out.collect()] == [6]


def test_a_rerun_without_rows_leaves_none(spark):
    root = tempfile.mkdtemp(prefix="lm-wh-")
    layout = J.Layout(root)
    bad, clean, empty = (tempfile.mkdtemp() for _ in range(3))
    raw_day(bad, [{"uid": 1, "paymoney": "3", "vip_id": 1, "dn": "A"}])
    with open(os.path.join(bad, "pcentermempaymoney.log"), "a") as fh:
        fh.write("not json\n")
    raw_day(clean, [{"uid": 1, "paymoney": "3", "vip_id": 1, "dn": "A"}])
    raw_day(empty, [])
    count = lambda path: spark.read.option("recursiveFileLookup", "true").parquet(path).count()
    table = "bdl_pcentermempaymoney"
    J.ingest_table(spark, layout, bad, table, "20190711")
    assert (count(layout.bdl(table)), count(layout.rejects(table))) == (1, 1)
    J.ingest_table(spark, layout, clean, table, "20190711")
    assert (count(layout.bdl(table)), count(layout.rejects(table))) == (1, 0)
    J.ingest_table(spark, layout, empty, table, "20190711")
    assert (count(layout.bdl(table)), count(layout.rejects(table))) == (0, 0)


def test_stream_paths_need_a_shared_place(spark):
    assert J.stream_paths(spark, "x", "/s", "/c", root="") == ("/s", "/c")
    assert J.stream_paths(spark, "x", None, None)[0] == J.stream_paths(spark, "x", None, None)[0]
    assert J.stream_paths(spark, "x", None, "/c", root="/shared/") == ("/shared/streams/x/sink", "/c")
    with pytest.raises(J.JobArgumentError):
        J.stream_paths(spark, "x", "/s", None, root="")


def test_without_a_checkpoint_setting_the_warehouse_stands_in(tmp_path):
    """A session of its own, since a running one refuses to change the setting."""
    script = f"""
from learnmetrics.session import get_session, scratch_path
from learnmetrics.plans import catalog
spark = get_session("bare", master="local[2]", shuffle_partitions=2, extra_conf={{"spark.sql.warehouse.dir": "{tmp_path}/wh"}})
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert scratch_path(spark, "a").split(":")[-1].startswith("{tmp_path}/wh/_checkpoints/a/")
spark.range(3).checkpoint().count()
print("ROWS", catalog.zipper_advance_open(spark, "/root/testdata/sf0.001").count())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}  # no defaults file that sets it
    done = subprocess.run([sys.executable, "-c", script], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "ROWS" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("step", ["_write_manifest", "publish_snapshot"])
def test_a_crash_before_the_pointer_leaves_the_old_zipper(spark, monkeypatch, step):
    import learnmetrics.sinks.writers as W

    layout = J.Layout(tempfile.mkdtemp(prefix="lm-wh-"))
    for dt in ("20190710", "20190711", "20190712"):
        d = tempfile.mkdtemp()
        raw_day(d, [{"uid": 1, "paymoney": "3", "vip_id": 1, "dn": "A"}, {"uid": int(dt[-1]), "paymoney": "1", "vip_id": 1, "dn": "A"}])
        J.run_ingest(spark, layout, d, dt)
    J.run_zipper_daily(spark, layout, "20190710")
    J.run_zipper_daily(spark, layout, "20190711")
    before = rows(J.read_zipper_inc(spark, layout))

    def crash(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(J if step == "_write_manifest" else W, step, crash)
        for job in (lambda: J.run_zipper_daily(spark, layout, "20190712"), lambda: J.run_zipper_rebuild(spark, layout)):
            with pytest.raises(RuntimeError):
                job()
            assert rows(J.read_zipper_inc(spark, layout)) == before
    J.run_zipper_daily(spark, layout, "20190712")
    after = rows(J.read_zipper_inc(spark, layout))
    J.run_zipper_rebuild(spark, layout)
    assert rows(J.read_zipper_inc(spark, layout)) == after != before
    assert J.clean_zipper(spark, layout)
    assert rows(J.read_zipper_inc(spark, layout)) == after
