"""Plan-shape checks: the properties the scale design relies on."""

from pyspark.sql import functions as F

from learnmetrics.plans import catalog as Q
from learnmetrics.session import broadcast_if_small, ensure_parallelism

from conftest import SF_SMALL, rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_filtered(spark):
    p = plan(Q.ingest_base_ad(spark, SF_SMALL))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_size:int>" in p


def scans(df) -> list[str]:
    """The scan lines of the optimized plan, one per use of a table."""
    text = df._jdf.queryExecution().sparkPlan().toString()
    return [x for x in text.split("\n") if "FileScan" in x]


def test_dimension_scans_have_no_key_filter(spark):
    for name in ("wide_member", "wide_member_reference", "headcount_all", "top3_payers", "zipper_day_increment"):
        for line in scans(Q.queries()[name](spark, SF_SMALL)):
            if any(k in line for k in ("p_partkey", "n_nationkey", "r_regionkey")):
                assert "LessThan" not in line and "GreaterThan" not in line, (name, line)


def test_wide_scans_each_table_once_and_collects_nothing(spark):
    df = Q.wide_member(spark, SF_SMALL)
    lines = scans(df)
    for table in ("part.parquet", "nation.parquet", "region.parquet", "orders.parquet"):
        assert sum(table in x for x in lines) == 1, table
    assert "collect_list" not in df._jdf.queryExecution().sparkPlan().toString()


def test_zipper_queries_scan_the_payments_once(spark, monkeypatch):
    calls = []
    real = Q.day_increment
    monkeypatch.setattr(Q, "day_increment", lambda *a, **k: calls.append(1) or real(*a, **k))
    for name in ("zipper_incremental", "zipper_close_last", "zipper_advance_open"):
        calls.clear()
        df = Q.queries()[name](spark, SF_SMALL)
        assert len(calls) == 1 and not any("orders.parquet" in x for x in scans(df)), name


def test_payment_aggregate_is_hash_based(spark):
    from learnmetrics.operators.wide import _pay_one
    from learnmetrics.plans import views as V
    from learnmetrics.sources import tables as T

    vip = T.vip_columns(V.vip_level(spark, SF_SMALL)).withColumnRenamed("vip_id", "vip_id_dim")
    pay = T.payment_columns(V.payment(spark, SF_SMALL))
    p = _pay_one(pay, vip)._jdf.queryExecution().sparkPlan().toString()
    # The payments themselves: one row per key and level before anything else.
    assert "HashAggregate(keys=[uid" in p and "vip_id" in p.split("HashAggregate(keys=[uid")[1].split("]")[0]


def test_ensure_parallelism_only_spreads_small_inputs(spark):
    one = spark.range(0, 100, numPartitions=1)
    assert ensure_parallelism(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(0, 100, numPartitions=8)
    assert ensure_parallelism(many, 4) is many


def test_broadcast_only_below_counted_limit(spark):
    df = spark.range(10)
    _, ok = broadcast_if_small(df, max_rows=100)
    assert ok
    _, ok = broadcast_if_small(df, max_rows=5)
    assert not ok
    hinted, _ = broadcast_if_small(df, max_rows=100)
    joined = spark.range(1000).join(hinted, "id")
    assert "BroadcastHashJoin" in plan(joined)


def test_fallbacks_above_broadcast_limit_give_same_results(spark, monkeypatch):
    import learnmetrics.session as session

    names = ["ip_region_join"]
    before = {n: rows(Q.queries()[n](spark, SF_SMALL)) for n in names}
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 0)
    for n in names:
        df = Q.queries()[n](spark, SF_SMALL)
        assert rows(df) == before[n], n
