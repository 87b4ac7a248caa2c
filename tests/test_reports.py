from decimal import Decimal

from learnmetrics.operators.reports import HEADCOUNT_DIMENSIONS, headcount, headcounts_all, top_payers

from conftest import rows

WIDE = "uid int, ad_id int, memberlevel string, register string, appregurl string, regsource string, regsourcename string, adname string, siteid int, sitename string, vip_level string, paymoney decimal(20,4), website string"


def wide(spark):
    data = []
    for uid, m, level, web, url in [
        (1, "5", "1", "A", "http://a_b"), (2, "9", "1", "A", "http://a_b"), (3, "9", "1", "A", None),
        (4, "1", "1", "A", "u"), (5, None, "1", "A", "u"), (6, "3", "2", "A", "u"), (7, "2", "1", "B", "u"),
    ]:
        data.append((uid, 0, level, "r", url, "1", "PC", "ad", 1, "s", "gold", Decimal(m) if m else None, web))
    return spark.createDataFrame(data, WIDE)


def test_headcount_keeps_underscore_and_null_groups(spark):
    got = rows(headcount(wide(spark), "appregurl"))
    assert set(got) == {(None, 1, "A"), ("http://a_b", 2, "A"), ("u", 3, "A"), ("u", 1, "B")}


def test_headcounts_all_equals_separate_counts_and_sums_to_members(spark):
    w = wide(spark)
    allc = headcounts_all(w)
    for d in HEADCOUNT_DIMENSIONS:
        one = rows(allc.where(allc.dimension == d).select("value", "num", "website"))
        sep = rows(headcount(w, d).selectExpr(f"cast({d} as string)", "num", "website"))
        assert one == sep
        assert sum(r[1] for r in one) == w.count()


def test_top3_desc_ties_by_uid_nulls_last(spark):
    got = rows(top_payers(wide(spark), n=3), "uid", "memberlevel", "rownum", "website")
    assert sorted(got) == [(1, "1", 3, "A"), (2, "1", 1, "A"), (3, "1", 2, "A"), (6, "2", 1, "A"), (7, "1", 1, "B")]


def test_bottom3_ascending_nulls_first(spark):
    got = rows(top_payers(wide(spark), n=3, ascending=True), "uid", "rownum")
    assert [u for u, r in sorted(got, key=lambda x: x[1]) if u not in (6, 7)][:3] == [5, 4, 1]


def test_top_n_plan_has_map_side_group_limit(spark):
    plan = top_payers(wide(spark), n=3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
