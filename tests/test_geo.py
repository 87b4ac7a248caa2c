from learnmetrics.functions.columns import UNKNOWN_REGION
from learnmetrics.operators.geo import lookup_region, overlapping_ranges

from conftest import rows

B = 65536


def ranges(spark):
    # adjacent ranges, a gap, a range over several blocks, edges inside blocks
    return spark.createDataFrame(
        [(0, 99, "r0"), (100, 3 * B + 5, "r1"), (3 * B + 100, 3 * B + 200, "r2"), (10 * B, 20 * B - 1, "wide")],
        "lo long, hi long, region string",
    )


def test_lookup_edges_gaps_and_default(spark):
    ips = [0, 99, 100, 3 * B + 5, 3 * B + 6, 3 * B + 100, 3 * B + 201, 15 * B + 7, 20 * B, None]
    ev = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id int, ip long")
    got = [r.region for r in sorted(lookup_region(ev, "ip", ranges(spark)).collect(), key=lambda r: r.id)]
    assert got == ["r0", "r0", "r1", "r1", UNKNOWN_REGION, "r2", UNKNOWN_REGION, "wide", UNKNOWN_REGION, UNKNOWN_REGION]


def test_lookup_keeps_every_row_and_is_an_equi_join(spark):
    ev = spark.range(0, 2000).selectExpr("id", "id * 7919 as ip")
    out = lookup_region(ev, "ip", ranges(spark))
    assert out.count() == 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_overlap_check(spark):
    assert overlapping_ranges(ranges(spark)).count() == 0
    bad = ranges(spark).union(spark.createDataFrame([(3 * B + 150, 4 * B, "x")], "lo long, hi long, region string"))
    got = rows(overlapping_ranges(bad), "region_a", "region_b")
    assert got == [("r2", "x")]


def test_ip_range_loader_and_check(spark, tmp_path):
    import pytest

    from learnmetrics.sources.lookups import check_ip_ranges, read_ip_ranges, vip_user_ids

    p = tmp_path / "ranges.csv"
    p.write_text("lo,hi,region\n1.0.0.0,1.0.255.255,a\n2.0.0.0,2.0.0.9,b\n")
    r = read_ip_ranges(spark, str(p), dotted=True)
    assert rows(r) == [(16777216, 16842751, "a"), (33554432, 33554441, "b")]
    check_ip_ranges(r)
    with pytest.raises(ValueError):
        check_ip_ranges(r.union(spark.createDataFrame([(16777300, 16777400, "x")], "lo long, hi long, region string")))
    vip = spark.createDataFrame([(1, "7"), (2, "7"), (3, None), (4, "x")], "id int, uid string")
    assert rows(vip_user_ids(vip)) == [(7,), (7,)]


def _narrowest(ranges, ip):
    best = min(((hi - lo, lo, region) for lo, hi, region in ranges if lo <= ip <= hi), default=None)
    return best and best[2]


NESTED = [
    (0, 2**32 - 1, "world"), (B, 40 * B - 1, "country"), (3 * B + 7, 3 * B + 900, "city"), (3 * B + 100, 3 * B + 200, "street"),
    (3 * B + 150, 3 * B + 1000, "across"), (5 * B, 6 * B - 1, "block"), (5 * B, 6 * B - 1, "alike"), (9 * B + 1, 9 * B + 1, "one"),
    (2**32 - 3, 2**32 - 1, "last"), (0, 0, "first"), (30 * B - 1, 50 * B, "long"), (12 * B, 11 * B, "inverted"), (20 * B, None, "open"),
]


def test_nested_ranges_are_flattened(spark):
    from learnmetrics.operators.geo import flatten_ranges

    flat = flatten_ranges(spark.createDataFrame(NESTED, "lo long, hi long, region string"))
    pieces = rows(flat)
    assert overlapping_ranges(flat).count() == 0 and sum(hi - lo + 1 for lo, hi, _ in pieces) == 2**32
    real = [r for r in NESTED if r[1] is not None and r[0] <= r[1]]
    edges = sorted({e + d for lo, hi, _ in real for e in (lo, hi) for d in (-1, 0, 1)} | {7 * B, 3 * B + 160, 35 * B})
    ips = [ip for ip in edges if 0 <= ip < 2**32]
    got = {}
    for ip in ips:
        held = [region for lo, hi, region in pieces if lo <= ip <= hi]
        assert len(held) == 1
        got[ip] = held[0]
    assert got == {ip: _narrowest(real, ip) for ip in ips}
    asked = spark.createDataFrame([(ip,) for ip in ips], "ip long")
    plan = lookup_region(asked, "ip", flat)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_flattening_random_ranges_and_gaps(spark):
    import random

    from learnmetrics.operators.geo import flatten_ranges

    rnd = random.Random(4)
    many = []
    for i in range(150):
        lo = rnd.randrange(0, 20 * B)
        many.append((lo, lo + rnd.choice([0, 3, 500, B, 5 * B]), f"r{i % 40}"))
    flat = flatten_ranges(spark.createDataFrame(many, "lo long, hi long, region string"))
    ips = [rnd.randrange(0, 27 * B) for _ in range(1500)]
    asked = spark.createDataFrame(list(enumerate(ips)), "id int, ip long")
    got = {r.id: r.region for r in lookup_region(asked, "ip", flat, default=None).collect()}
    assert got == {i: _narrowest(many, ip) for i, ip in enumerate(ips)}
    assert flatten_ranges(spark.createDataFrame([], "lo long, hi long, region string")).count() == 0
    again = flatten_ranges(flat)
    assert rows(again) == rows(flat)  # disjoint ranges stay as they are, but for block ends
