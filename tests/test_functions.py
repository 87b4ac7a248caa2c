from decimal import Decimal

from pyspark.sql import functions as F

from learnmetrics.functions import columns as C


def one(spark, expr, schema="v string", value=None):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("out")).first()["out"]


def test_parse_json_object_accepts_only_objects(spark):
    lines = ["{\"a\": \"1\"}", "bad", "[1]", "", "{}", "{a:1}", "{'a':1}", "{\"n\": {\"x\": 1}}"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [r.m for r in df.select(C.parse_json_object("value").alias("m")).collect()]
    assert got[0] == {"a": "1"}
    assert got[1] is None and got[2] is None and got[3] is None
    assert got[4] == {}
    assert got[5] == {"a": "1"} and got[6] == {"a": "1"}
    assert got[7] == {"n": "{\"x\":1}"}


def test_json_int_missing_empty_quoted_and_bad(spark):
    df = spark.createDataFrame(
        [('{"k": 12}',), ('{"k": "12"}',), ('{"k": ""}',), ("{}",), ('{"k": "x"}',), ('{"k": 12.7}',)], "value string"
    )
    m = C.parse_json_object("value")
    got = df.select(C.json_int(m, "k").alias("v"), C.json_int_is_bad(m, "k").alias("bad")).collect()
    assert [(r.v, r.bad) for r in got] == [(12, False), (12, False), (0, False), (0, False), (None, True), (None, True)]


def test_json_str_alternative_keys(spark):
    df = spark.createDataFrame([('{"b": "2"}',), ('{"a": "1", "b": "2"}',)], "value string")
    m = C.parse_json_object("value")
    assert [r.v for r in df.select(C.json_str(m, ("a", "b")).alias("v")).collect()] == ["2", "1"]


def test_regsource_labels(spark):
    df = spark.createDataFrame([(x,) for x in ["1", "2", "3", "4", "5", None, "x"]], "v string")
    got = [r.o for r in df.select(C.regsource_name("v").alias("o")).collect()]
    assert got == ["PC", "Mobile", "App", "WeChat", "other", "other", "other"]


def test_masks(spark):
    df = spark.createDataFrame([("13812345678", "Alice"), ("12345", ""), ("", None), (None, "B")], "p string, n string")
    got = df.select(
        C.mask_phone("p").alias("a"), C.mask_phone("p", "xxxx").alias("b"), C.mask_name("n").alias("n")
    ).collect()
    assert (got[0].a, got[0].b, got[0].n) == ("138*****5678", "138xxxx5678", "Axx")
    assert (got[1].a, got[1].n) == ("*****", "xx")
    assert (got[2].a, got[2].n) == ("", None)
    assert (got[3].a, got[3].n) == (None, "Bxx")


def test_money_and_dates(spark):
    df = spark.createDataFrame([("12.5", "20190712"), ("1500000", "20190230"), ("x", None)], "m string, d string")
    got = df.select(C.money("m").alias("m"), C.yyyymmdd_to_iso("d").alias("d"), C.is_bad_money("m").alias("b")).collect()
    assert [r.b for r in got] == [False, False, True]
    assert got[0].m == Decimal("12.5000") and got[0].d == "2019-07-12"
    assert got[1].m == Decimal("1500000") and got[1].d is None
    assert got[2].m is None and got[2].d is None


def test_epoch_to_day_uses_fixed_offset(spark):
    # 2019-04-01 16:00:00 UTC is 2019-04-02 00:00 at +8.
    df = spark.createDataFrame([(1554134400,), (1554134399,)], "e long")
    got = [r.d for r in df.select(C.epoch_to_day("e", 8).alias("d")).collect()]
    assert got == ["2019-04-02", "2019-04-01"]
    assert df.select(C.epoch_to_yyyymmdd("e", 0).alias("d")).first().d == "20190401"


def test_split_tsv_drops_trailing_empty_fields_like_jvm(spark):
    df = spark.createDataFrame([("a\tb\t\t",), ("a\t\tb",)], "v string")
    got = [r.n for r in df.select(F.size(C.split_tsv("v")).alias("n")).collect()]
    assert got == [2, 3]
    kept = df.select(F.size(C.split_tsv("v", keep_trailing_empty=True)).alias("n")).first().n
    assert kept == 4


def test_ipv4_round_trip_and_invalid(spark):
    df = spark.createDataFrame([("42.86.6.0",), ("255.255.255.255",), ("1.2.3",), ("1.2.3.256",), ("a.b.c.d",)], "ip string")
    got = [r.n for r in df.select(C.ipv4_to_long("ip").alias("n")).collect()]
    assert got == [42 * 2**24 + 86 * 2**16 + 6 * 2**8, 2**32 - 1, None, None, None]
    back = df.limit(2).select(C.long_to_ipv4(C.ipv4_to_long("ip")).alias("ip")).collect()
    assert [r.ip for r in back] == ["42.86.6.0", "255.255.255.255"]
