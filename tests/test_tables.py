"""SQL functions, variant staging, catalog tables, sized files, counted writes, as-of lookup."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from learnmetrics.functions import columns as C
from learnmetrics.functions import sql as Q
from learnmetrics.operators.zipper import close_out, day_increment, lookup_as_of
from learnmetrics.plans import catalog
from learnmetrics.plans import jobs as J
from learnmetrics.plans import views as V
from learnmetrics.sinks import catalog as KC
from learnmetrics.sources import ingest as I
from learnmetrics.sources import variant as VA

from conftest import SF_SMALL, rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- functions for SQL text

TEXTS = [None, "", "a", "Ünal", "13812345678", "1381234567", "138123456789", "1", "2", "9", "20190712", "20190231", "2019071", "12.5", "-7", "x9",
         "1.2.3.4", " 255.0.0.1 ", "1.2.3", "1.2.3.256", "1.2.3.4.5", '{"a": 1, "b": {"c": 2}}', "{'a': 'x'}", "[1]"]


def test_sql_functions_equal_the_column_functions(spark):
    Q.register(spark)
    assert Q.register(spark) == list(Q.FUNCTIONS)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, s string")
    pairs = {
        "lm_mask_name(s)": C.mask_name("s"), "lm_mask_phone(s)": C.mask_phone("s"), "lm_mask_phone_with(s, 'xxxx')": C.mask_phone("s", "xxxx"),
        "lm_regsource_name(s)": C.regsource_name("s"), "lm_password_mask()": C.password_mask(), "lm_money(s)": C.money("s"),
        "lm_iso_day(s)": C.yyyymmdd_to_iso("s"), "lm_ipv4_to_long(s)": C.ipv4_to_long("s"), "to_json(lm_json(s))": F.to_json(C.parse_json_object("s")),
        "lm_epoch_day(i * 100000000L - 7, 8)": C.epoch_to_day(F.col("i") * F.lit(100000000).cast("long") - 7, 8),
        "lm_long_to_ipv4(i * 123456789L)": C.long_to_ipv4(F.col("i") * F.lit(123456789).cast("long")),
    }
    for text, column in pairs.items():
        assert rows(df.selectExpr("i", f"{text} AS v")) == rows(df.select("i", column.alias("v"))), text


def test_sql_functions_are_inlined(spark):
    p = catalog.mask_members_sql(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "lm_mask" not in p and "Python" not in p and "CASE WHEN" in p and p.count("Relation") == 1


def test_sql_table_functions(spark):
    Q.register(spark)
    history = spark.createDataFrame(
        [(1, 5, "gold", "2020-01-01", "2020-02-01", "A"), (1, 7, "silver", "2020-02-01", C.OPEN_END, "A"), (2, 1, "gold", "2020-03-01", C.OPEN_END, "B")],
        "uid long, paymoney long, vip_level string, start_time string, end_time string, website string",
    )
    Q.register_zipper(spark, history)
    assert rows(spark.sql("SELECT uid, vip_level FROM lm_zipper_on('2020-01-31')")) == [(1, "gold")]
    assert rows(spark.sql("SELECT uid, vip_level FROM lm_zipper_on('2020-03-01')")) == [(1, "silver"), (2, "gold")]
    Q.register_ranges(spark, spark.createDataFrame([(16777216, 16842751, "a")], "lo long, hi long, region string"))
    assert rows(spark.sql("SELECT region FROM lm_region_of('1.0.3.4')")) == [("a",)] and rows(spark.sql("SELECT * FROM lm_region_of('9.9.9.9')")) == []


# --- one parse for many readers

def test_staged_variants_give_all_eight_tables(spark, tmp_path):
    makers = {
        "bdl_member": V.member_json, "bdl_member_regtype": V.regtype_json, "bdl_pcentermempaymoney": V.payment_json, "bdl_wxtype": V.wxtype_json,
        "bdl_vip_level": V.vip_level_json, "bdl_base_ad": V.base_ad_json, "bdl_base_website": V.base_website_json, "bdl_member_wxbound": V.wxbound_json,
    }
    assert set(makers) == set(I.SPECS)
    for table, make in makers.items():
        lines = make(spark, SF_SMALL).unionByName(spark.createDataFrame([("",), (" \t",), ("[1]",), ("7",), (None,)], "value string"))
        VA.write_staged(lines, f"{tmp_path}/{table}")
        got = VA.ingest_staged(VA.read_staged(spark, f"{tmp_path}/{table}"), I.SPECS[table], "20190712")
        want = I.ingest_json(lines, I.SPECS[table], "20190712")
        assert rows(got.rows) == rows(want.rows) != [] and rows(got.rejects) == rows(want.rejects) != [], table
        assert "from_json" not in plan(got.rows)


def test_variant_fields_keep_their_text(spark):
    spec = I.IngestSpec("t", (I.I("n"), I.S("s", ("s", "other")), I.S("odd", "it's a \\ key")))
    texts = ['{"n": 3, "s": "x"}', '{"n": "4", "s": null, "other": "y"}', '{"n": "", "s": {"a": [1, 2]}}', '{"n": " 5 ", "s": true}', '{"n": 1.5}',
             '{"n": null, "s": ""}', '{"n": "x"}', '{"s": [1, {"b": "c"}], "it\'s a \\\\ key": "z"}', '{"n": 99999999999}', '{"n": -1, "s": "é\\n"}', "{", "{}"]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    got, want = VA.ingest_staged(VA.stage(lines), spec), I.ingest_json(lines, spec)
    assert rows(got.rows) == rows(want.rows) and rows(got.rejects) == rows(want.rejects)


def test_staged_lines_are_spread_by_their_rows(spark, tmp_path):
    lines = [(f'{{"uid": {i}, "dn": "A"}}',) for i in range(400)]
    # One row group, planned as several splits: all rows come out of one of them.
    spark.createDataFrame(lines, "value string").coalesce(1).write.parquet(f"{tmp_path}/one")
    size = os.path.getsize(glob.glob(f"{tmp_path}/one/*.parquet")[0])
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in kept:
            spark.conf.set(k, str(size // 8))
        one = spark.read.parquet(f"{tmp_path}/one")
        assert one.rdd.getNumPartitions() >= 8
        VA.write_staged(one, f"{tmp_path}/staged")
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    filled = [f for f in glob.glob(f"{tmp_path}/staged/*.parquet") if spark.read.parquet(f).count()]
    assert len(filled) == 4 and VA.read_staged(spark, f"{tmp_path}/staged").count() == 400
    VA.write_staged(spark.createDataFrame([], "value string"), f"{tmp_path}/none")
    assert VA.read_staged(spark, f"{tmp_path}/none").count() == 0


def test_fields_are_read_once(spark):
    lines = spark.createDataFrame([('{"uid": 1, "dn": "A"}',), ("{",)], "value string")
    for res, parse in ((VA.ingest_staged(VA.stage(lines), I.MEMBER, "20190712"), "try_variant_get("), (I.ingest_json(lines, I.MEMBER, "20190712"), "from_json(")):
        for df in (res.rows, res.rejects):
            assert plan(df).lower().count(parse) == 1


# --- counts taken while writing

def test_counts_are_taken_by_the_writes(spark, tmp_path):
    lines = V.member_json(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        res, counts = I.counted(I.ingest_json(lines, I.MEMBER, "20190712"), I.MEMBER)
        res.rows.write.parquet(f"{tmp_path}/rows")
        res.rejects.write.parquet(f"{tmp_path}/rejects")
        before = len(tracker.getJobIdsForGroup("counted"))
        found = counts.result()
        assert len(tracker.getJobIdsForGroup("counted")) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found["rows"] == spark.read.parquet(f"{tmp_path}/rows").count()
    by_reason = dict(rows(spark.read.parquet(f"{tmp_path}/rejects").groupBy("reason").count()))
    assert {k: n for k, n in found.items() if k != "rows" and n} == by_reason and set(found) == {"rows", *I.reasons(I.MEMBER)}


def test_loaders_return_their_counts(spark):
    raw, layout = tempfile.mkdtemp(), J.Layout(tempfile.mkdtemp(prefix="lm-wh-"))
    with open(os.path.join(raw, "baseadlog.log"), "w") as fh:
        fh.write('{"adid": 1, "adname": "x", "dn": "A"}\n\n{"adid": "y"}\nbad\n')
    with open(os.path.join(raw, "WxType.log"), "w") as fh:
        fh.write("\n")
    got = J.run_ingest(spark, layout, raw, "20190712", ["bdl_base_ad", "bdl_wxtype"])
    assert got == {"bdl_base_ad": {"rows": 1, "not_a_json_object": 1, "bad_int:adid": 1}, "bdl_wxtype": {"rows": 0, "not_a_json_object": 0, "bad_int:bind_source": 0}}


# --- tables by position, bucketed

def test_insert_by_position_checks_and_replaces_partitions(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("uid long, money decimal(20,4), name string, dt string")
    KC.create_table(spark, "lm_test_positions", schema, f"{tmp_path}/t", partition_by=["dt"])
    KC.create_table(spark, "lm_test_positions", schema, f"{tmp_path}/t", partition_by=["dt"])  # there already
    day = lambda items: spark.createDataFrame(items, "a int, b int, c string, d string").withColumn("b", F.col("b").cast("decimal(10,2)"))
    KC.insert_by_position(day([(1, 1, "x", "1"), (2, 2, None, "1"), (3, 3, "y", "2")]), "lm_test_positions")
    KC.insert_by_position(day([(9, 9, "z", "2")]), "lm_test_positions")  # that day anew
    assert [r[0] for r in rows(spark.table("lm_test_positions"))] == [1, 2, 9]
    KC.insert_by_position(day([(9, 9, "z", "2")]), "lm_test_positions", overwrite=False)
    assert [r[0] for r in rows(spark.table("lm_test_positions"))] == [1, 2, 9, 9]
    for wrong in (day([(1, 1, "x", "1")]).drop("c"), day([(1, 1, "x", "1")]).select("c", "b", "a", "d"),
                  day([(2, 1, "x", "1")]).withColumn("a", F.lit(2.5)), day([(1, 1, "x", "1")]).withColumn("b", F.col("b").cast("decimal(30,2)"))):
        with pytest.raises(KC.ColumnMismatch):
            KC.insert_by_position(wrong, "lm_test_positions")
    assert spark.table("lm_test_positions").count() == 4


def _exchanges(df) -> list[str]:
    """Exchanges on the member key in the plan as made before it runs, without broadcasts."""
    return [x for x in df._jdf.queryExecution().sparkPlan().toString().split("\n") + plan(df).split("\n") if "Exchange hashpartitioning(uid" in x]


def test_bucketed_members_need_no_exchange(spark):
    wide = catalog.wide_member_bucketed(spark, SF_SMALL)
    zipper = catalog.zipper_close_out_bucketed(spark, SF_SMALL)
    assert _exchanges(zipper) == [] and _exchanges(wide) == []
    assert _exchanges(catalog.zipper_close_out(spark, SF_SMALL)) != [] and _exchanges(catalog.wide_member(spark, SF_SMALL)) != []
    assert rows(wide) == rows(catalog.wide_member(spark, SF_SMALL))
    assert rows(zipper) == rows(catalog.zipper_close_out(spark, SF_SMALL))


# --- files by size

def test_files_of_about_the_wanted_size(spark, tmp_path):
    df = spark.range(0, 400_000, 1, 40).selectExpr("xxhash64(id) as v", "if(id % 100 < 90, 'hot', concat('p', id % 7)) as part")
    target = 256 << 10
    KC.write_sized(df, f"{tmp_path}/t", ["part"], target)
    sizes = {p: [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/t/part={p}/*.parquet")] for p in ("hot", "p1")}
    assert len(sizes["hot"]) >= 6 and max(sizes["hot"]) <= 2 * target and sorted(sizes["hot"])[len(sizes["hot"]) // 2] >= target / 4
    assert len(sizes["p1"]) <= 2
    assert rows(spark.read.parquet(f"{tmp_path}/t").groupBy("part").count()) == rows(df.groupBy("part").count())
    KC.write_sized(df.where("part = 'p1'").limit(5), f"{tmp_path}/t", ["part"], target)  # that partition anew
    assert spark.read.parquet(f"{tmp_path}/t").where("part = 'p1'").count() == 5


# --- the zipper on a day

def _brute_as_of(facts, history):
    out = []
    for f in facts:
        hit = [h for h in history if h[0] == f[1] and h[5] == f[2] and None not in (f[1], f[2], f[3]) and h[3] <= f[3] < h[4]]
        out.append((*f, hit[0][2] if hit else None, hit[0][3] if hit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("salts", [1, 5])
def test_lookup_as_of_a_day(spark, salts):
    history = [(1, 5, "gold", "2020-01-01", "2020-02-01", "A"), (1, 7, "silver", "2020-02-01", "2020-03-01", "A"), (1, 7, "late", "2020-04-01", C.OPEN_END, "A"),
               (1, 2, "other", "2020-01-15", C.OPEN_END, "B"), (2, 1, "gold", "2020-03-01", C.OPEN_END, "A")]
    days = ["2019-12-31", "2020-01-01", "2020-01-31", "2020-02-01", "2020-03-05", "2020-04-01", "2031-01-01", None]
    facts = [(i, u, w, d) for i, (u, w, d) in enumerate((u, w, d) for u in (1, 2, 3, None) for w in ("A", "B", None) for d in days)] * 2
    h = spark.createDataFrame(history, "uid long, paymoney long, vip_level string, start_time string, end_time string, website string")
    f = spark.createDataFrame(facts, "id int, uid long, website string, day string")
    got = lookup_as_of(f, h, "day", ["vip_level", "start_time"], salts)
    p = plan(got)
    assert "Join" not in p and p.count("Exchange hashpartitioning") == 1
    assert got.columns == ["id", "uid", "website", "day", "valid_vip_level", "valid_start_time"]
    assert rows(got) == _brute_as_of(facts, history)


def test_lookup_as_of_equals_the_range_join(spark):
    history = close_out(day_increment(V.payment(spark, SF_SMALL), V.vip_level(spark, SF_SMALL)))
    facts = V.payment(spark, SF_SMALL).select("uid", "website", C.yyyymmdd_to_iso("time").alias("day")).distinct()
    got = lookup_as_of(facts, history, "day", ["vip_level"])
    h = history.withColumnsRenamed({"uid": "u", "website": "w"})
    cond = (F.col("uid") == F.col("u")) & (F.col("website") == F.col("w")) & (F.col("start_time") <= F.col("day")) & (F.col("day") < F.col("end_time"))
    assert rows(got) == rows(facts.join(h, cond, "left").select("uid", "website", "day", "vip_level"))


# --- options of the adapters

class _Recorder:
    """Stands in for a reader: keeps what it was told."""

    def __init__(self):
        self.options, self.kind = {}, None

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self

    def select(self, *columns):
        return self


class _Session:
    def __init__(self):
        self.readStream = self.read = _Recorder()


def test_kafka_and_jdbc_options():
    from learnmetrics.sources.lookups import jdbc_table
    from learnmetrics.streaming.jobs import kafka_lines

    offsets = '{"t":{"0":23,"1":-2}}'
    k = kafka_lines(_Session(), "h:9092", "t", offsets, max_offsets_per_trigger=100)
    assert k.kind == "kafka" and k.options == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": offsets, "failOnDataLoss": "true", "maxOffsetsPerTrigger": "100",
    }
    j = jdbc_table(_Session(), "jdbc:x", "vip_user", {"user": "u"}, "id", 0, 1000, 4)
    assert j.kind == "jdbc" and j.options == {
        "url": "jdbc:x", "dbtable": "vip_user", "user": "u", "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "4",
    }
    assert "partitionColumn" not in jdbc_table(_Session(), "jdbc:x", "t").options


def test_compression_of_tables(spark, tmp_path):
    from learnmetrics.sinks.writers import write_table, write_text

    df = spark.range(1000).selectExpr("id", "cast(id as string) as value")
    for codec in ("snappy", "zstd", "gzip"):
        write_table(df, f"{tmp_path}/{codec}", compression=codec)
        assert all(f".{'gz' if codec == 'gzip' else codec}.parquet" in f for f in glob.glob(f"{tmp_path}/{codec}/*.parquet"))
    write_text(df.select("value"), f"{tmp_path}/text", compression="gzip")
    assert glob.glob(f"{tmp_path}/text/*.txt.gz") and spark.read.text(f"{tmp_path}/text").count() == 1000


def test_daily_spans_of_the_warehouse(spark):
    from test_streaming import DAY, line, write_lines

    raw, layout = tempfile.mkdtemp(), J.Layout(tempfile.mkdtemp(prefix="lm-wh-"))
    write_lines(raw, "a.txt", [line(u, "startVideo", DAY + d * 86400) for d, users in enumerate(((1, 2), (2, 3), (4,))) for u in users])
    J.run_load_behaviour(spark, layout, raw)
    for day in ("20190402", "20190403", "20190404", "20190403"):
        J.run_daily_video_spans(spark, layout, day)
    for exact in (True, False):
        assert rows(J.read_video_users(spark, layout, exact=exact)) == [(4, 0)]
        assert rows(J.read_video_users(spark, layout, "20190402", "20190403", exact=exact)) == [(3, 0)]
        assert rows(J.read_video_users(spark, layout, span="day", exact=exact)) == [("2019-04-02", 2, 0), ("2019-04-03", 2, 0), ("2019-04-04", 1, 0)]
