"""Line deduplication and near-duplicate grouping."""

import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from learnmetrics.llm import linededup, neardup
from learnmetrics.llm.shingles import shingle_sets

SF = "/root/testdata/sf0.01"


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _brute_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: _lower(line.strip(linededup.BLANKS))
    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and doc is not None:
                held.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < min_docs or doc == max(held[key(x)])]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


LINE_ROWS = [
    (1, "a common line of many words\nown\n  A Common Line of MANY words\t"),
    (2, "a common line of many words\n\nÉTÉ a common line of many words"),
    (3, "x\na common line of many words\nété a common line of many words"),
    (3, "a common line of many words"),  # the same document once more
    (4, "ÉtÉ a common line of many words\nnineteen characters\r\nnineteen characters"),
    (5, None), (6, ""), (7, "\n\n"), (None, "a common line of many words\nz"),
    (8, "été a common line of many words\r\nété a common line of many words"),
    (9, "\n".join(["a common line of many words", "unique"] * 3000)),
]


def test_lines_match_brute_force(spark):
    docs = spark.createDataFrame(LINE_ROWS, "doc_id long, text string").selectExpr("*", "'k' as h1", "0 as n_lines", "1 as pos")
    out = linededup.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "h1", "pos", "n_lines", "n_dropped"]
    got = sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()], key=repr)
    assert got == _brute_lines(LINE_ROWS)
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_line_columns_of_any_name_pass_through(spark):
    docs = spark.createDataFrame(LINE_ROWS, "doc_id long, text string").selectExpr("*", "7 as _text", "8 as _DROPPED", "9 as d", "'x' as t")
    out = linededup.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "_text", "_DROPPED", "d", "t", "n_lines", "n_dropped"]
    rows = out.collect()
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in rows], key=repr) == _brute_lines(LINE_ROWS)
    assert {(r["_text"], r["_DROPPED"], r["d"], r["t"]) for r in rows} == {(7, 8, 9, "x")}


def test_shingles_of_few_words():
    for n in range(8):
        for texts in ([" ".join("abcdefgh"[:n])], [None], [" ".join("abcdefgh"[:n]), "x y"]):
            sets, bounds = shingle_sets(pa.array([t or "" for t in texts], pa.string()))
            assert np.diff(bounds).tolist() == [len(_brute_shingles(t)) for t in texts]


def test_line_plan_is_native(spark):
    plan = linededup.op3_line_dedup(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval"))


def test_repeated_rows_are_cleaned_alike(spark):
    rows = LINE_ROWS + LINE_ROWS
    out = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()], key=repr) == _brute_lines(rows)


def _brute_shingles(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def _brute_groups(rows):
    nodes = {}
    for doc, text in rows:
        if doc is not None:
            nodes.setdefault(doc, []).append(_brute_shingles(text))
    parent = {d: d for d in nodes}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(nodes)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            near = any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in nodes[a] for y in nodes[b])
            if near and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    out = [(d, len(_brute_shingles(t)), None if d is None else find(d), d is None or d == find(d)) for d, t in rows]
    return sorted(out, key=repr)


def test_shingle_sets_match_brute_force():
    texts = ["", "  ", "a", "a b c d", "A b C d e", "a b c d e f g " * 2, "é à\tb\n c d e é à b c d", "x " * 50, "q" * 300, "w", ""]
    values, bounds = shingle_sets(pa.array(texts))
    sets = [set(values[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    brute = [_brute_shingles(t) for t in texts]
    for i in range(len(texts)):
        assert len(sets[i]) == len(brute[i])
        for j in range(len(texts)):
            assert len(sets[i] & sets[j]) == len(brute[i] & brute[j]), (texts[i], texts[j])


def test_superminhash_estimates_with_less_variance_than_independent_slots():
    rng = np.random.default_rng(0)
    for n in (3, 40, 400):
        found = []
        for _ in range(60):
            x = rng.integers(0, 2**63, n, dtype=np.uint64)
            y = np.concatenate((x[: n * 3 // 4], rng.integers(0, 2**63, n - n * 3 // 4, dtype=np.uint64)))
            s = neardup.superminhash(np.concatenate((x, y)), np.array([0, n, 2 * n]), 160)
            assert (s != neardup._UNSET).all()
            found.append((s[0] == s[1]).mean())
        true = (n * 3 // 4) / (2 * n - n * 3 // 4)
        assert abs(np.mean(found) - true) < 0.02
        assert np.std(found) < 1.1 * (true * (1 - true) / 160) ** 0.5


def _corpus(seed=1):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghijklmnop") + str(rnd.randrange(500))
    rows, doc = [], 0
    for size, copies, edits in ((60, 40, 1), (80, 30, 3), (120, 25, 5), (30, 10, 2), (3, 4, 0), (300, 12, 8)):
        base = [word() for _ in range(size)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.randint(0, edits)):
                text[rnd.randrange(size)] = word()
            rows.append((doc, rnd.choice([" ", "\n", "  "]).join(text)))
            doc += 1
    rows += [(doc + i, " ".join(word() for _ in range(rnd.randint(1, 80)))) for i in range(60)]
    rnd.shuffle(rows)
    return rows


def test_groups_match_brute_force(spark, monkeypatch):
    rows = _corpus() + [(9001, None), (9002, ""), (9003, " \n"), (None, "x y z"), (9004, "one two"), (9004, "other text here"), (9005, "ONE  two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as node", "'b' as bands")
    expected = _brute_groups(rows)
    for rounds in (2, 0, 3):  # with 0, all pairs that share a bucket are listed at once
        monkeypatch.setattr(neardup, "STAR_ROUNDS", rounds)
        out = neardup.near_duplicates(docs)
        assert sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()], key=repr) == expected
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 200)]
    out = neardup.components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.comp for r in out.collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}


def test_line_digest_of_the_query(spark):
    row = linededup.op3_line_dedup(spark, SF).where(F.col("n_dropped") == 0).orderBy("doc_id").first()
    text = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id") == row.doc_id).first().text
    assert row.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bitmaps_exclude_pairs_of_a_bucket_without_losing_links(spark):
    """a bucket of sets that only look alike by their sizes made all its pairs."""
    rnd = random.Random(4)
    base = [rnd.getrandbits(63) for _ in range(100)]
    sets = {i: base[:50] + [rnd.getrandbits(63) for _ in range(50)] for i in range(60)} | {i: base[:98] + [i, i + 100] for i in range(60, 63)}
    text = spark.createDataFrame([(i, " ".join(map(str, x))) for i, x in sets.items()], "doc long, text string")
    full = neardup._full_sets(text, 1)
    members = spark.createDataFrame([(1, i, 100, 100, i) for i in sets], "bucket long, node long, n long, able long, comp long")
    pairs = neardup._crossing(members, full, 75)
    assert sorted(map(tuple, pairs.collect())) == [(60, 61), (60, 62), (61, 62)]
    links = neardup._verified(pairs, full, 75)
    assert links.count() == 3


def test_linking_starts_without_python_rows(spark):
    """empty tables made of Python rows started workers of their own, which stayed."""
    members = spark.createDataFrame([(1, 1, 5), (1, 2, 5)], "bucket long, node long, n long").where("n > 9")
    sets = spark.createDataFrame([], "node long, items array<long>, bits array<long>")
    found = neardup._join_members(members, sets, 75)
    assert found.columns == ["node", "comp"] and found.isEmpty()
    assert "ExistingRDD" not in found._jdf.queryExecution().toString()


def test_pairs_of_a_bucket_are_tried_in_compiled_code(spark):
    """The bounds tried for each pair of a large bucket were a method too long to be compiled."""
    members = spark.createDataFrame([(1, 1, 5, 5, 1), (1, 2, 5, 5, 2)], "bucket long, node long, n long, able long, comp long")
    sets = spark.createDataFrame([(i, [1, 2, 3, 4, 5], [31] + 15 * [0]) for i in (1, 2)], "node long, items array<long>, bits array<long>")
    began = time.time()
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, rows in (("members", members), ("sets", sets)):
        rows.createOrReplaceGlobalTempView(f"crossing_{name}")
    pairs = neardup._crossing(session.table("global_temp.crossing_members"), session.table("global_temp.crossing_sets"), 75)
    plan = pairs._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    assert time.time() - began < 30  # of planning
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert len(sizes) > 2 and max(sizes) < 8000, sizes
    assert pairs.collect() == [(1, 2)]


def test_copies_of_a_row_do_not_weaken_its_bound(spark):
    """Shingles of a repeated row that no other component has were subtracted once for each copy."""
    members = spark.createDataFrame([(1, i, 100, 100, i) for i in (1, 2)], "bucket long, node long, n long, able long, comp long")
    rows = [(1, list(range(100))), (1, list(range(100))), (2, list(range(12, 112)))]
    sets = spark.createDataFrame(rows, "node long, items array<long>")
    able = {r.node: r.able for r in neardup._with_shared_items(members, sets).collect()}
    assert able[1] >= 88 and able[2] == 88
    both = [(1, " ".join(map(str, range(100)))), (1, " ".join(map(str, range(100)))), (2, " ".join(map(str, range(12, 112))))]
    docs = spark.createDataFrame(both, "doc_id long, text string")
    assert {r.component_id for r in neardup.near_duplicates(docs, width=1).collect()} == {1}
