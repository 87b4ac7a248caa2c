"""Token counts by overlap resynchronisation."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from learnmetrics.llm import tokencount

MODEL = public_tokenizers.path(tokencount.VOCABULARY)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ENCODER = tokencount.PieceEncoder(MODEL)
HARD = [
    "", " ", "   ", "a", "a" * 999, " " * 700, "ab" * 400, "\n" * 300, "= " * 300, "-" * 511, "日本語" * 200, "\U0001f600" * 150,
    "\U0001f469‍\U0001f4bb" * 90, "x▁y ▁ ▁▁" * 60, "the the the " * 80, "<s> </s> <unk> <0x0A>" * 30, "\x00\x01é" * 120,
    "supercalifragilistic" * 50, "0123456789" * 90, "aab" * 333, "  a" * 200 + "\t\t" * 50, "éé̂" * 120,
]


def _spliced(text, chunk, overlap):
    n, widened, ids = tokencount.encode_long(ENCODER, text, chunk, overlap, keep_ids=True)
    assert n == len(ids)
    return ids.tolist(), widened


@pytest.mark.parametrize("chunk,overlap", [(16, 1), (16, 4), (50, 7), (64, 32), (300, 20)])
def test_spliced_ids_equal_the_library(chunk, overlap):
    rnd = random.Random(chunk)
    texts = HARD + ["".join(rnd.choice("aeiostnr thT' \n1.,é日-") for _ in range(rnd.randint(0, 900))) for _ in range(60)]
    for text in texts:
        assert _spliced(text, chunk, overlap)[0] == LIBRARY.encode(text), text[:40]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200), st.integers(4, 40), st.integers(1, 3))
def test_spliced_ids_equal_the_library_on_any_text(text, chunk, overlap):
    text = text.encode("utf-8", "ignore").decode()
    assert _spliced(text, chunk, overlap)[0] == LIBRARY.encode(text)


def test_overlaps_are_widened_where_nothing_is_common():
    text = "a" * 4001 + " end of the run " + "word " * 500
    ids, widened = _spliced(text, 100, 5)
    assert ids == LIBRARY.encode(text) and widened > 0
    assert _spliced("the end of the word " * 200, 100, 30)[1] == 0


def test_a_model_that_changes_characters_is_refused(monkeypatch):
    class Folding:
        def __init__(self, **_):
            self.real = LIBRARY

        def encode(self, text, **_):
            return self.real.encode(text.replace("  ", " "))

        def __getattr__(self, name):
            return getattr(self.real, name)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Folding)
    with pytest.raises(ValueError):
        tokencount.PieceEncoder(MODEL)


def test_counts_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, "a b"), (None, "x " * 50_000), (3, "日" * 30_000), (3, "日" * 30_000), (4, "z" * 20_000), (5, "<s>")]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "doc_id long, text string").selectExpr("*", "1 as n_tokens", "'q' as n_bytes")
    out = tokencount.count_tokens(docs, limit=3, chunk=1000, overlap=16)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chars", "n_widened"]
    want = [(d, len((t or "").encode()), len(LIBRARY.encode(t or "")), len(LIBRARY.encode(t or "")) > 3) for d, t in rows]
    assert sorted([tuple(r)[:4] for r in out.collect()], key=repr) == sorted(want, key=repr)
    assert tokencount.count_tokens(docs.limit(0)).count() == 0


def test_registered_token_count_rows(spark):
    sf = "/root/testdata/sf0.01"
    out = tokencount.op11_token_counts(spark, sf)
    assert dict(out.dtypes)["over_limit"] == "boolean" and {dict(out.dtypes)[c] for c in ("doc_id", "n_bytes", "n_tokens")} == {"bigint"}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    counts = [len(x) for x in LIBRARY.encode([r.text or "" for r in docs])]
    want = sorted((r.doc_id, len((r.text or "").encode()), n, n > 4096) for r, n in zip(docs, counts, strict=True))
    assert sorted(tuple(r)[:4] for r in out.collect()) == want
    assert np.max(counts) > 4096
