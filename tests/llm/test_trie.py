"""Conversation prefix trie."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

from learnmetrics.llm import prefixtrie

TURNS = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _brute(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c - np.fmod(c, 20))
        built[c] = tuple(own.get(base, [])[:h] + v[h:])
    nodes = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes.setdefault(v[:d], []).append(c)
    out = []
    for node, members in nodes.items():
        under = [m for m in nodes if m[: len(node)] == node]
        children = [m for m in under if len(m) == len(node) + 1]
        leaves = [m for m in under if not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in nodes)]
        saved = sum((len(nodes[m]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1])) if m else 0) for m in under)
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(node))))
        parent = min(nodes[node[:-1]]) if node else None
        out.append((min(members), len(node), parent, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _odd_rows():
    rnd = np.random.default_rng(5)
    rows = [(c, t, ["user", None, "x"][rnd.integers(3)], ["hi there you", "", None, "a\tb\x0bc d"][rnd.integers(4)]) for c in range(90) for t in range(rnd.integers(1, 5))]
    rows += [(c, t, "user", "same words") for c in range(200, 330) for t in range(3)]  # a very common conversation
    rows += [(None, 1, "user", "x"), (-7, 1, "u", "v"), (-7, 2, "u", "v"), (-45, None, None, None), (-40, 1, "u", "z")]
    rows += [(400, None, "b", "x"), (400, None, "a", "y"), (400, 1, "a", "y"), (400, 1, "a", "y"), (2**60, 3, "u", "w " * 5000)]
    rows += [(500 + i, t, "u", "long") for i in range(3) for t in range(23)]
    rows += [(41, 9, "only", "one turn")]
    return rows


@pytest.mark.parametrize("more", [{}, {"shard_rows": 60, "id_block": 4}, {"shard_rows": 60, "segment": 2}, {"segment": 5, "shard_rows": 10_000}])
def test_trie_matches_brute_force(spark, more):
    rows = _odd_rows()
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as depth", "'q' as conv", "2 as x1")
    out = prefixtrie.prefix_trie(turns, **more)
    assert out.columns == COLUMNS
    assert sorted([tuple(r) for r in out.collect()], key=repr) == _brute(rows)


def test_empty_and_turnless(spark):
    none = spark.createDataFrame([], TURNS)
    assert prefixtrie.prefix_trie(none).count() == 0
    # Conversations whose own turns are all replaced by those of a family start that isn't there.
    gone = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4][:5]
    rows = [(c, 1, "u", "x") for c in gone]
    got = prefixtrie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()
    assert [tuple(r) for r in got] == _brute(rows) and len(got) == 1


def test_slots_are_minimal_and_perfect_and_refuse_others():
    rng = np.random.default_rng(3)
    x1, x2 = rng.integers(0, 2**63, (2, 20_000)).astype(np.uint64)
    x1[:5000] = 7  # many digests share a lane
    slots = prefixtrie.SlotTable(x1, x2)
    assert sorted(slots.slots(x1, x2).tolist()) == list(range(20_000))
    assert (slots.slots(x1, x2 ^ np.uint64(1)) == -1).all()
    assert len(prefixtrie.SlotTable(x1[:0], x2[:0]).slots(x1, x2)) == 20_000
    with pytest.raises(ValueError):
        prefixtrie.SlotTable(np.array([1, 1], np.uint64), np.array([2, 2], np.uint64))


def test_accumulation_by_parents():
    depth, parent = np.array([2, 0, 1, 2, 1]), np.array([2, -1, 1, 2, 1])
    total = prefixtrie.accumulate(depth, parent, np.array([[1, 10, 100, 1000, 10_000]]))
    assert total.tolist() == [[1, 11_111, 1101, 1000, 10_000]]


def test_registered_rows_match_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    want = con.execute(prefixtrie.OP12_SQL)
    out = prefixtrie.op12_prefix_trie(spark, sf)
    assert [d[0] for d in want.description] == out.columns
    got = sorted([tuple(r) for r in out.collect()], key=repr)
    assert got == sorted(want.fetchall(), key=repr)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == _brute(rows)
    odd = pd.DataFrame(_odd_rows(), columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("odd", odd)
    con.execute("CREATE OR REPLACE VIEW conversations AS SELECT * FROM odd")
    assert sorted(con.execute(prefixtrie.OP12_SQL).fetchall(), key=repr) == _brute(_odd_rows())
