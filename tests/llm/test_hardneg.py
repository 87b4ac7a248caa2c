"""Hard-negative mining."""

import duckdb
import numpy as np
import pytest

from learnmetrics.llm import hardneg

VECTORS = "vec_id long, embedding array<float>, label int"


def _brute(rows, is_anchor, positives=5, negatives=10):
    good = {(i, lab, tuple(v)) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    good = [(i, lab, [int(x) for x in np.floor(256 * np.array(v, dtype=np.float32).astype(np.float64))]) for i, lab, v in good]
    out = []
    for a, lab, v in good:
        if not is_anchor(a):
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), i, m == lab) for i, m, w in good if i != a and len(w) == len(v)]
        for p, pid, _ in sorted(s for s in scores if s[2])[:positives]:
            wanted = [s for s in scores if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(a, pid, r + 1, i, -p, -n) for r, (n, i, _) in enumerate(sorted(wanted)[:negatives])]
    return sorted(out)


def _rows(spark, rows, is_anchor="vec_id % 100 = 0", **more):
    vectors = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as block", "'x' as positive_id", "2 as dim")
    out = hardneg.hard_negatives(vectors, vectors.where(is_anchor), **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def test_odd_rows_match_brute_force(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [2.0, 0.5], 1), (200, [1.0, 1.0], None), (300, None, 1), (400, [nan, 1.0], 1),
        (500, [inf, 1.0], 2), (600, [], 1), (700, [1.0], 1), (800, [1.0, None], 1), (None, [1.0, 1.0], 1), (900, [0.0, 0.0], 2),
        (1, [1.0, 1.5], 1), (2, [1.0, 1.5], 1), (2**53, [0.5, 0.5], 1), (2**53 + 1, [0.5, 0.5], 1), (3, [0.5, 0.6], 2), (4, [0.5, 0.6], 2),
        (4, [0.5, 0.6], 2), (5, [0.9, 0.9], 3), (6, [-1.0, -1.0], 2), (7, [0.3, 0.3], 2), (8, [1.0], 2), (9, [0.0, 0.0], 1),
    ]
    got = _rows(spark, rows, positives=4, negatives=3)
    assert got == _brute(rows, lambda i: i % 100 == 0, 4, 3) and len(got) > 10
    assert _rows(spark, [(0, [1.0], 1)]) == []
    none = spark.createDataFrame([], VECTORS)
    assert hardneg.hard_negatives(none, none).count() == 0


@pytest.mark.parametrize("step,few", [(1, 0), (5, 3), (100, 32)])
def test_pruning_loses_nothing(step, few, monkeypatch):
    monkeypatch.setattr(hardneg, "STEP", step)
    monkeypatch.setattr(hardneg, "FEW", few)
    rng = np.random.default_rng(step)
    for shape in ((1, 40), (1, 1), (50, 1)):
        scale = rng.choice(shape, size=(23, 1))
        columns = np.floor(rng.normal(size=(23, 500)) * 20 * scale)
        columns[:, 60:90] = columns[:, :1]
        ids, labels = rng.permutation(500), rng.integers(0, 3, 500)
        block = hardneg.Block(ids, labels, columns)
        for a in range(25):
            score = (columns[:, a] @ columns).astype(int)
            same = [x for x in np.lexsort((ids, -score)) if labels[x] == labels[a] and x != a]
            where, got = hardneg.positives_of(block, ids[a], labels[a], columns[:, a], 5)
            assert where.tolist() == same[:5] and got.tolist() == score[same[:5]].tolist()
            wanted = hardneg.windows([int(s) for s in got] + [0, -7])
            for (low, high), (found, reached) in zip(wanted, hardneg.negatives_of(block, ids[a], labels[a], columns[:, a], wanted, 10)):
                right = [x for x in np.lexsort((ids, -score)) if labels[x] != labels[a] and low <= score[x] <= high][:10]
                assert found.tolist() == right and reached.tolist() == score[right].tolist()


def test_pruning_reads_less():
    """Of a block with a few dimensions that matter, most candidates leave the bitmap early."""
    rng = np.random.default_rng(1)
    columns = np.floor(rng.normal(size=(64, 4000)) * np.geomspace(4000, 1, 64)[:, None])
    block = hardneg.Block(np.arange(4000), rng.integers(0, 10, 4000), columns)
    left = []
    steps = block.ranges(columns[:, 0], np.flatnonzero(block.labels == block.labels[0]))
    alive, low, high, done = next(steps)
    while not done:
        left.append(len(alive))
        alive, low, high, done = steps.send(high >= hardneg._nth_best(low, 5))
    assert left[-1] < left[0] / 4


def test_windows_are_exact_integers():
    for p in (*range(-120, 121), 2**62, 2**62 + 1):
        (low, high), = hardneg.windows([p])
        assert 100 * low >= 30 * p > 100 * (low - 1) and 100 * high <= 90 * p < 100 * (high + 1)


def test_huge_components_stay_exact(spark):
    rows = [(0, [1e12, -3.0], 1), (1, [1e12, 5.0], 1), (2, [2e11, 1.0], 2), (3, [5e11, 1.0], 2), (4, [1e30, 1.0], 2)]
    big = int(np.floor(256 * float(np.float32(1e12))))
    score = min(2**63 - 1, big * big + -768 * 1280)
    got = _rows(spark, rows)
    assert got == [] and score == 2**63 - 1  # both are beyond 64 bits, so no score is 90 % of the other or less
    rows = [(0, [1e6, -3.0], 1), (1, [1e6, 5.0], 1), (2, [2e5, 1.0], 2), (3, [5e5, 1.0], 2), (4, [1e30, 1.0], 2)]
    assert _rows(spark, rows) == _brute(rows, lambda i: i == 0) != []


def test_registered_rows_match_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    out = hardneg.op13_hard_negatives(spark, sf)
    want = con.execute(hardneg.OP13_SQL)
    assert [d[0] for d in want.description] == out.columns
    assert sorted(tuple(r) for r in out.collect()) == sorted(want.fetchall())
