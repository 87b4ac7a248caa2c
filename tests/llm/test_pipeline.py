"""The pipeline's stages and its registration."""

from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from learnmetrics.llm import packing
from learnmetrics.llm.common import stored, table
from learnmetrics.llm.wordbpe import load_tokenizer
from test_dedup import _brute_groups, _brute_lines

SF = "/root/testdata/sf0.001"


def test_stages_in_order_match_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "language_id", "line_dedup", "near_dedup", "packing"]
    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), name)
        kept[name] = docs
        if name in ("quality_classifier", "language_id"):
            assert docs.exceptAll(before).isEmpty() and docs.count() > 0.8 * before.count()
        if name == "line_dedup":
            want = _brute_lines([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()])
            assert sorted([(r.doc_id, r.text) for r in docs.collect()], key=repr) == sorted([(d, t) for d, t, _, _ in want], key=repr)
            assert docs.where(F.col("n_chars") != F.char_length("text")).isEmpty()
        if name == "near_dedup":
            want = _brute_groups([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()])
            assert sorted(r.doc_id for r in docs.collect()) == [d for d, _, _, keep in sorted(want) if keep]
        if name != "packing":
            assert docs.columns == before.columns
    tokenizer = load_tokenizer(__import__("public_tokenizers").path(packing.VOCABULARY))
    texts = {r.doc_id: r.text for r in kept["near_dedup"].collect()}
    held = {}
    for r in sorted(docs.collect(), key=lambda r: r.start):
        held.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert held == {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for d, t in texts.items()}


def test_bad_documents_go(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    out = corpus_pipeline.quality_classifier(spark, docs, "/root/testdata/sf0.01").join(labels, "doc_id").toPandas()
    assert (out.quality == 0).sum() <= 3 and (out.quality == 1).sum() >= 0.98 * labels.where("quality = 1").count()


def test_odd_rows_pass_through_every_stage(spark):
    own = ["_lang", "_share", "_quality", "_good", "_LINES", "_dropped", "_text", "_kept"]
    fields = "doc_id long, text string, lang string, source string, n_chars long, score int, " + ", ".join(f"{c} int" for c in own)
    texts = [(1, None, None), (2, "", "en"), (2, "a b c", None), (3, "a b", "en"), (3, "a b", "en"), (None, "x " * 20_000, "en")]
    odd = [(d, t, lang, "s", 0, *[i] * 9) for i, (d, t, lang) in enumerate(texts)]
    docs = spark.createDataFrame(odd, fields)
    alone = spark.createDataFrame(spark.sparkContext.parallelize(odd, len(odd)), fields)  # one row a partition
    for frame in (docs, docs.limit(0), alone):
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == frame.columns
            for r in out.collect():
                assert all(r[c] == r["score"] for c in own)
        corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
    none = spark.createDataFrame([], docs.schema)
    assert corpus_pipeline.STAGES[0][1](spark, none, SF).count() == 0


#: Queries without SQL, and the test that holds their rows against brute force.
TESTED = {
    "op1_language_id": "test_registered_language_rows", "op2_quality": "test_registered_quality_rows",
    "op4_license_scan": "test_registered_licence_rows", "op6_training_order": "test_training_order_holds_every_document",
    "op7_byte_bpe": "test_registered_bpe_rows", "op8_nearest": "test_recall_on_the_table",
    "op9_packing": "test_registered_packing_rows", "op11_token_counts": "test_registered_token_count_rows",
    "pipeline": "test_stages_in_order_match_brute_force",
}


def test_queries_without_sql_have_a_test():
    here = Path(__file__).parent
    tests = "".join(p.read_text() for p in here.glob("test_*.py"))
    llm = {n for n in entry.queries() if n.startswith("op") or n == "pipeline"}
    assert llm - set(entry.oracle_sql()) <= set(TESTED)
    assert all(f"def {t}" in tests for t in TESTED.values())


def test_queries_are_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {"op3_line_dedup", "op5_near_dedup", "op10_exact_top_k", "op12_prefix_trie", "op13_hard_negatives"} <= set(entry.oracle_sql())
