"""Exact top-k and approximate nearest neighbours."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from learnmetrics.llm import nndescent, topk

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>"
ODD = [
    (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [9.0, -1.0]), (5, [1.0]),
    (50, [3.0, None]), (100, []), (None, [1.0, 1.0]), (6, [1.0, 2.0]), (7, [0.0, 0.0]), (8, [float("inf"), 0.0]), (20, [-1.0, 0.5]),
]


def _brute(rows, asked, top, to_int, zero_ok):
    good = []
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or (not zero_ok and not any(v)):
            continue
        good.append((i, np.floor(256 * np.array(v)) if to_int else np.array(v)))
    out = {}
    for q, qv in good:
        if not asked(q):
            continue
        scores = out.setdefault(q, {})
        for i, v in good:
            if i != q and len(v) == len(qv):
                scores[i] = max(scores.get(i, -np.inf), float(v @ qv))
    return {
        (q, r + 1, i, s) for q, scores in out.items() for r, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:top])
    }


def test_exact_top_k_matches_brute_force_on_odd_rows(spark):
    vectors = spark.createDataFrame(ODD, VECTORS).selectExpr("*", "1 as block", "'x' as score")
    out = topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), 3).collect()
    assert {tuple(r) for r in out} == _brute(ODD, lambda i: i % 50 == 0, 3, True, True)
    assert topk.exact_top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_neighbouring_huge_ids_stay_apart(spark):
    big = 2**53
    rows = [(0, [1.0, 1.0]), (big, [1.0, 2.0]), (big + 1, [1.0, 2.0]), (5, [0.5, 0.5]), (5, [0.5, 0.5]), (5, [2.0, 2.0])]
    vectors = spark.createDataFrame(rows, VECTORS)
    out = topk.exact_top_k(vectors, vectors.where("vec_id = 0"), 5).orderBy("rank").collect()
    assert [r.vec_id for r in out] == [5, big, big + 1] and out[0].score == 2 * 256 * 512


@pytest.mark.parametrize("step", [3, 8, 100])
def test_pruning_loses_nothing(step, monkeypatch):
    monkeypatch.setattr(topk, "STEP", step)
    rng = np.random.default_rng(step)
    columns, queries = (np.floor(rng.normal(size=(37, n)) * rng.choice([1, 40], size=(37, 1))) for n in (700, 20))
    columns[:, 100:130] = columns[:, :1]  # ties
    ids, asked = rng.permutation(700), np.arange(20)
    q, found, score = topk.search_block(ids, columns, asked, queries, 5)
    for i in range(20):
        exact = queries[:, i] @ columns
        want = [x for x in np.lexsort((ids, -exact)) if ids[x] != i][:5]
        assert found[q == i].tolist() == ids[want].tolist() and score[q == i].tolist() == exact[want].tolist()


def test_huge_components_stay_exact(spark):
    rows = [(0, [1e12, -3.0]), (1, [1e12, 5.0]), (2, [2.0, 1.0]), (3, [1e30, 1.0])]
    vectors = spark.createDataFrame(rows, VECTORS)
    out = {r.vec_id: r.score for r in topk.exact_top_k(vectors, vectors.where("vec_id = 0"), 3).collect()}
    big = int(np.floor(256 * float(np.float32(1e12))))
    assert out == {3: 2**63 - 1, 1: 2**63 - 1, 2: big * 512 - 768 * 256}


def test_queries_are_copied_to_groups_without_a_broadcast(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(5).normal(size=(3000, 4)))]
    vectors = spark.createDataFrame(rows, VECTORS)
    out = topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"))
    assert len(out.collect()) == 300
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan


def test_copies_of_the_queries_do_not_outgrow_the_candidates():
    for rows in (10, 2_000, 120_000, 720_000, 5_000_000):
        groups = topk._group_count(rows, rows * 64, rows // 50, 12, 200)
        assert groups * (rows // 50) <= max(rows, 24 * (rows // 50)) and groups <= max(1, rows / 1000)
    assert topk._group_count(0, 0, 0, 12, 200) == 1
    # Memory comes first: long vectors, and more rows than the cores' groups hold.
    assert topk._group_count(1000, 1000 * 2**20, 1000, 2, 4) == 125
    assert topk._group_count(10**8, 64 * 10**8, 10**8, 12, 200) == 763


@pytest.mark.parametrize("cells", [64, 1500, 1 << 23])
def test_groups_and_blocks_of_any_size_give_the_same(spark, monkeypatch, cells):
    for name, value in (("GROUP_CELLS", cells), ("CANDIDATE_ROWS", 7), ("QUERY_ROWS", 3)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(6)
    rows = [(int(i), rng.integers(-3, 4, d).astype(float).tolist()) for i, d in zip(rng.integers(0, 150, 400), rng.choice([1, 9, 17], 400), strict=True)]
    vectors = spark.createDataFrame(rows, VECTORS).repartition(3)
    out = topk.exact_top_k(vectors, vectors.where("vec_id % 10 = 0"), 4).collect()
    assert sorted(tuple(r) for r in out) == sorted(_brute(rows, lambda i: i % 10 == 0, 4, True, True))


def test_many_vectors_of_one_id_hide_no_other(spark):
    rows = [(0, [1.0, 0.0]), *((7, [9.0, float(i)]) for i in range(12)), (8, [3.0, 0.0]), (9, [2.0, 0.0])]
    vectors = spark.createDataFrame(rows, VECTORS)
    out = topk.exact_top_k(vectors, vectors.where("vec_id = 0"), 3).collect()
    assert sorted((r["rank"], r.vec_id) for r in out) == [(1, 7), (2, 8), (3, 9)]


def test_least_scores_come_last():
    place, ids, score = topk._best(np.zeros(4, np.int64), np.array([1, 2, 3, 2]), np.array([-(2**63), 5, 7, 6]), 2)
    assert ids.tolist() == [3, 2] and score.tolist() == [7, 6]


def test_nearest_odd_rows(spark):
    vectors = spark.createDataFrame(ODD, VECTORS).selectExpr("*", "1 as node", "'x' as code")
    out = nndescent.approximate_top_k(vectors, vectors.where("vec_id % 20 = 0")).collect()
    assert {tuple(r) for r in out} == _brute(ODD, lambda i: i % 20 == 0, 20, False, False)
    assert nndescent.approximate_top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_nearest_recall_scores_and_ties(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(1500, 16)).astype(np.float32)
    base[300:360] = base[300]  # one vector many times
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    vectors = spark.createDataFrame(rows, VECTORS)
    out = nndescent.approximate_top_k(vectors, vectors.where("vec_id % 20 = 0")).toPandas()
    exact = base.astype(np.float64)
    hits = 0
    for q, part in out.groupby("query_id"):
        scores = exact @ exact[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(1500), -scores))[:20]
        hits += len(set(best) & set(part.vec_id))
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21)) and np.allclose(scores[part.vec_id], part.score, rtol=0, atol=1e-9)
        assert part.score.is_monotonic_decreasing
    assert hits / (20 * 75) >= 0.9
    same = out[(out.query_id == 320) & (out["rank"] <= 20)].sort_values("rank").vec_id.tolist()
    if (exact @ exact[320]).argmax() in range(300, 360):
        assert same[:5] == [300, 301, 302, 303, 304]


def test_outside_queries_start_somewhere(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)))]
    vectors = spark.createDataFrame(rows, VECTORS)
    asked = spark.createDataFrame([(10_000, rng.normal(size=8).tolist())], VECTORS)
    assert nndescent.approximate_top_k(vectors, asked).count() == 20


def test_recall_on_the_table(spark):
    out = nndescent.op8_nearest(spark, SF).toPandas()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("embedding")).toPandas()
    x = np.stack(table.embedding).astype(np.float64)
    hits = 0
    for q, part in out.groupby("query_id"):
        scores = x @ x[table.vec_id == q][0]
        scores[table.vec_id == q] = -np.inf
        hits += len(set(table.vec_id[np.argsort(-scores, kind="stable")[:20]]) & set(part.vec_id))
    assert hits / len(out) >= 0.9


def test_best_edges_take_one_exchange(spark):
    rows = [(1, 2, 0.5, 1), (1, 2, 0.7, 0), (1, 3, 0.1, 1), (1, 4, 0.6, 1), (2, 1, 0.5, 1)]
    edges = spark.createDataFrame(rows, "node long, near long, sim float, flag int")
    best = nndescent._best(edges, "node", "near", 2, F.min("flag"))
    assert best._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert sorted((r.node, r.near, r.flag) for r in best.collect()) == [(1, 2, 0), (1, 4, 1), (2, 1, 1)]
