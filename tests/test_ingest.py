import json

from learnmetrics.sources import ingest as I

from conftest import rows


def lines(spark, items):
    return spark.createDataFrame([(x,) for x in items], "value string")


def test_member_spec_masks_and_routes_rejects(spark):
    good = {"uid": 7, "ad_id": "12", "fullname": "Wang", "phone": "13812345678", "password": "p", "dn": "webA"}
    data = [
        json.dumps(good),
        json.dumps({"uid": 8, "fullname": None, "phone": "12345", "dn": "webB"}),
        json.dumps({"uid": 9, "ad_id": "x", "dn": "webA"}),
        "bad",
        "[1]",
        "",
        "{}",
    ]
    res = I.ingest_json(lines(spark, data), I.MEMBER, "20190712")
    got = {r.uid: r for r in res.rows.collect()}
    assert set(got) == {7, 8, 0}
    assert (got[7].ad_id, got[7].fullname, got[7].phone, got[7].password) == (12, "Wxx", "138*****5678", "******")
    assert (got[8].ad_id, got[8].fullname, got[8].phone, got[8].website) == (0, None, "*****", "webB")
    assert got[0].website is None and got[0].time == "20190712"
    assert res.rows.columns == I.MEMBER.columns
    rej = rows(res.rejects, "reason")
    assert rej == [("bad_int:ad_id",), ("not_a_json_object",), ("not_a_json_object",), ("not_a_json_object",)]


def test_regtype_labels_and_renamed_key(spark):
    data = [json.dumps({"uid": i, "regsource": str(i), "webA": "d", "dn": "w"}) for i in range(1, 6)]
    data.append(json.dumps({"uid": 6, "dn": "w"}))
    res = I.ingest_json(lines(spark, data), I.MEMBER_REGTYPE, "20190712")
    got = rows(res.rows, "uid", "regsourcename", "domain")
    assert got == [(1, "PC", "d"), (2, "Mobile", "d"), (3, "App", "d"), (4, "WeChat", "d"), (5, "other", "d"), (6, "other", None)]


def test_every_spec_has_website_and_load_date_where_partitioned(spark):
    for spec in I.SPECS.values():
        assert spec.columns[-1] == "website"
        if spec.partition_by:
            assert "time" in spec.columns


def test_wxbound_spec_parses(spark):
    data = [json.dumps({"uid": 1, "bindsource": "2", "openid": "o", "dn": "w"})]
    res = I.ingest_json(lines(spark, data), I.MEMBER_WXBOUND, "20190712")
    r = res.rows.first()
    assert (r.uid, r.bindsource, r.openid, r.time, r.website) == (1, 2, "o", "20190712", "w")


def test_missing_load_date_is_an_error(spark):
    import pytest

    with pytest.raises(ValueError):
        I.ingest_json(lines(spark, ["{}"]), I.PAYMONEY)


def test_rows_and_rejects_share_one_parse_when_staged_is_persisted(spark):
    data = [json.dumps({"uid": 1, "dn": "w"}), "bad"]
    res = I.ingest_json(lines(spark, data), I.BASE_AD, "20190712")
    res.staged.persist()
    try:
        for df in (res.rows, res.rejects):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "InMemoryTableScan" in plan
        assert res.rows.count() == 1 and rows(res.rejects, "reason") == [("not_a_json_object",)]
        # the raw text is kept only for rejected lines
        assert res.staged.where("_raw is not null").count() == 1
    finally:
        res.staged.unpersist()
