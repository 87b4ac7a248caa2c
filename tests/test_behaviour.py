from pyspark.sql import functions as F

from learnmetrics.operators import behaviour as B

from conftest import rows


def line(uid=1, name="user1", phone="18735100001", key="startVideo", start=1000, end=1300, length=300, t=1554134400, version="1.0"):
    f = [str(uid), name, "F", "1", "0", "ios", "auto", "wifi", "42.86.6.0", phone, "1", str(length), str(start), str(end), version, key, str(t)]
    return "\t".join(f)


def df(spark, items):
    return spark.createDataFrame([(x,) for x in items], "value string")


def test_clean_filters_masks_and_repairs(spark):
    good = line()
    newline = line(uid=2, name="us\ner2")
    empty_phone = line(uid=3, phone="")
    short_phone = line(uid=4, phone="12345")
    sixteen = "\t".join(line().split("\t")[:16])
    eighteen = line() + "\textra"
    out = [r.value.split("\t") for r in B.clean_lines(df(spark, [good, newline, empty_phone, short_phone, sixteen, eighteen])).collect()]
    assert len(out) == 4
    by_uid = {f[0]: f for f in out}
    assert by_uid["1"][9] == "187xxxx0001"
    assert by_uid["2"][1] == "user2"
    assert by_uid["3"][9] == ""
    assert by_uid["4"][9] == "*****"
    rej = rows(B.rejected_lines(df(spark, [sixteen, eighteen, good])), "n_fields")
    assert rej == [(16,), (18,)]


def test_trailing_empty_fields_rejected_by_default_kept_on_request(spark):
    f = line().split("\t")
    f[16] = ""
    raw = "\t".join(f)
    assert B.clean_lines(df(spark, [raw])).count() == 0
    assert B.clean_lines(df(spark, [raw]), keep_trailing_empty=True).count() == 1


def test_parse_and_daily_video_users(spark):
    day1 = 1554134400  # 2019-04-02 00:00 at +8
    items = [
        line(uid=1, key="startVideo", t=day1),
        line(uid=1, key="startVideo", t=day1 + 10),
        line(uid=2, key="startVideo", t=day1),
        line(uid=1, key="endVideo", start=0, end=300, length=300, t=day1),   # complete
        line(uid=2, key="endVideo", start=0, end=100, length=300, t=day1),   # not complete
        line(uid=3, key="endVideo", start=0, end=500, length=300, t=day1 + 86400),  # next day, complete
        line(uid=4, key="completeOrder", t=day1),
    ]
    beh = B.parse_lines(df(spark, items))
    assert beh.where(F.col("uid") == 1).first().dt == "20190402"
    got = sorted(rows(B.daily_video_users(beh)), key=lambda r: r[2])
    assert got == [(2, 1, "20190402"), (0, 1, "20190403")]
    assert rows(B.daily_video_users(beh, day="20190402")) == [(2, 1, "20190402")]
