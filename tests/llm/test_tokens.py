"""Byte-level BPE, packing, training order."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from learnmetrics.llm import bpe, packing, trainorder, wordbpe
from learnmetrics.llm.wordbpe import WordEncoder, load_tokenizer

SF = "/root/testdata/sf0.01"
RANKS = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
MERGES = bpe.merge_table(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
WORDS = public_tokenizers.path(packing.VOCABULARY)
LETTER_ENCODER = WordEncoder(WORDS)
ODD = [
    "", " ", "  ", "a  b", "a   b", " a", "a ", "a\n b", "x\n\n  b", "\t", "it's 're we'll'd", "a" * 1000, "日本語 テスト",
    "\U0001f600 \U0001f600", "a\x1c b", "a  b", "ab" * 500, " " * 100, "1234567 89 0", "é é", "<|endoftext|> x",
    "a<|endoftext|>b it's!", "-" * 300, "\r\n \r\n x", "İ.I", "K, Ångström!", "x—!y", "don't. O'REILLY", "ΣΑΣ ΟΔΟΣ, Σ.",
]


def _bpe_ids(texts, merges=MERGES):
    ids, bounds = bpe.encode_texts(merges, regex.compile(public_tokenizers.PATTERN), pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_replay_equals_the_library():
    rnd = random.Random(3)
    mixed = ["".join(rnd.choice("aeiostnr tTh'\n e12.,é日  ") for _ in range(rnd.randint(0, 60))) for _ in range(5000)]
    texts = ODD + mixed
    assert _bpe_ids(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_a_task_replays_each_word_once(monkeypatch):
    """words of earlier slices keep their ids, also beyond the limit of what is kept."""
    replayed = []

    def replay(merges, data, bounds, plain=bpe.replay):
        replayed.extend(data[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:]))
        return plain(merges, data, bounds)

    monkeypatch.setattr(bpe, "replay", replay)
    rnd = random.Random(8)
    slices = [["".join(rnd.choice("aeio tn'\n1é") for _ in range(40)) for _ in range(200)] + ODD for _ in range(4)]
    for limit in (1 << 19, 300):
        known, pattern = bpe.KnownWords(MERGES, limit), regex.compile(public_tokenizers.PATTERN)
        replayed.clear()
        for texts in slices:
            ids, bounds = bpe.encode_texts(MERGES, pattern, pa.array(texts, pa.string()), known)
            assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [LIBRARY.encode_ordinary(t) for t in texts]
        if limit > 300:
            assert len(replayed) == len(set(replayed)) == len(known.words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_replay_equals_the_library_on_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + ["x"]
    assert _bpe_ids(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_word_whose_merges_are_out_of_rank_order_is_exact():
    """A made-up vocabulary in which a later token is part of an earlier one."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"abc": 257, b"ab": 258, b"cab": 259, b"abca": 260, b"bcab": 261}
    ranks[b"aab"] = 255 + 8
    library = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14))) for _ in range(2000)]
    assert _bpe_ids(texts, bpe.merge_table(ranks)) == [library.encode_ordinary(t) for t in texts]


def test_encode_decode_round_trip(spark):
    rows = list(enumerate(ODD)) + [(0, None), (None, "x"), (5, "a  b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as ids", "1 as decoded")
    out = bpe.decode(bpe.encode(docs)).collect()
    assert sorted(bytes(r.decoded) for r in out) == sorted((t or "").encode() for _, t in rows)
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0


def test_word_encoder_equals_the_library():
    tokenizer = load_tokenizer(WORDS)
    encoder = WordEncoder(WORDS, limit=30)  # forgets between slices
    for texts in (ODD, ODD[::-1], ["a b. c!"], []):
        ids, bounds = encoder.encode(pa.array(texts, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_words_go_to_the_model_alone(monkeypatch):
    """op9_packing's CPU seconds: only pieces that aren't lower-case letters take all of the library's steps."""
    listed = []

    def encode_list(tokenizer, texts, plain=wordbpe._encode_list):
        listed.extend(texts.to_pylist())
        return plain(tokenizer, texts)

    monkeypatch.setattr(wordbpe, "_encode_list", encode_list)
    texts = ["The straße, élan 12 naïve", "σας όλος ς", "ёлка съезд", "élan dž ŉ ſ µ ÿ x́y É 日本 élan don't <b> x" + "y" * 700]
    tokenizer = load_tokenizer(WORDS)
    ids, bounds = WordEncoder(WORDS).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert {"É", "日本", "12"} <= set(listed)
    assert not {"the", "straße", "élan", "naïve", "σας", "όλος", "ς", "ёлка", "съезд", "ÿ"} & set(listed)


def test_other_tokenizers_have_no_plain_letters():
    from tokenizers import normalizers, pre_tokenizers

    tokenizer = load_tokenizer(WORDS)
    letters = wordbpe.plain_letters(tokenizer)
    assert set("abcxyzßéÿςё") <= set(letters) and not set("AÉ1' .İ\u0301日") & set(letters)
    keeps = tokenizer.pre_tokenizer
    for split in (pre_tokenizers.Metaspace(), pre_tokenizers.Sequence([pre_tokenizers.Split("aa", "isolated"), keeps])):
        tokenizer.pre_tokenizer = split
        assert wordbpe.plain_letters(tokenizer) == {}
    tokenizer.pre_tokenizer, tokenizer.normalizer = keeps, normalizers.Prepend("x")
    assert wordbpe.plain_letters(tokenizer) == {}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(wordbpe._LETTERS), st.sampled_from(" .'AÉ\u0301İſ1"), st.characters()), max_size=40), max_size=6))
def test_word_encoder_equals_the_library_on_letters(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, bounds = LETTER_ENCODER.encode(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == [LETTER_ENCODER.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.lists(st.integers(0, 20_000), max_size=20))
@settings(max_examples=100, deadline=None)
def test_decomposition_covers_each_document_by_powers_of_two(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    doc, start, size = packing.decompose(lengths)
    assert all(s & (s - 1) == 0 and s <= packing.MAX_TOKENS for s in size.tolist())
    for d, n in enumerate(lengths.tolist()):
        own = [(a, s) for e, a, s in zip(doc.tolist(), start.tolist(), size.tolist()) if e == d]
        assert [a for a, _ in own] == np.cumsum([0, *[s for _, s in own]])[:-1].tolist() and sum(s for _, s in own) == n
        assert [s for _, s in own] == sorted((s for _, s in own), reverse=True)


def test_packing_matches_the_library(spark):
    rows = list(enumerate(ODD)) + [(100, None), (None, "x y"), (3, "again"), (101, "word. " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' as ids", "3 as length")
    tokenizer = load_tokenizer(WORDS)
    want = sorted(tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for _, t in rows)
    pieces = sorted(packing.pack(docs).collect(), key=lambda r: r.sequence_id)
    assert len({r.sequence_id for r in pieces}) == len(pieces) and {r.offset for r in pieces} == {0}
    got, held = [], []
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.start == len(held)
        held += ids
        if len(held) == r.doc_tokens:
            got.append(tuple(held))
            held = []
    assert sorted(got) == want and not held
    crc = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in packing.digests(packing.pack(docs)).collect()}
    assert crc == {(r.doc_id, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in pieces}
    assert packing.pack(docs.limit(0)).count() == 0


def test_buckets_on_disk_hold_equal_lengths(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "x")], "doc_id long, text string")
    packing.write_buckets(packing.pack(docs), f"file:{tmp_path}/b")
    stored = spark.read.parquet(f"file:{tmp_path}/b").collect()
    assert all(len(r.ids) == 4 * int(r.length) for r in stored) and {int(r.length) for r in stored} == {2, 4}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 17, 1000, 4097])
def test_feistel_is_a_permutation(size):
    one, two = trainorder.feistel(np.arange(size), size), trainorder.feistel(np.arange(size), size, key=5)
    assert sorted(one.tolist()) == list(range(size)) == sorted(two.tolist())
    if size > 100:
        assert (one != two).mean() > 0.9 and abs(np.corrcoef(one, np.arange(size))[0, 1]) < 0.15


def test_training_order_round_trip_and_resume(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trainorder, "SHARD_SLOTS", 8)
    rows = [(1, None), (2, ""), (None, "x y"), (2, "z " * 3000), (3, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "'q' as record")
    records = trainorder.cut(bpe.encode(docs), length=16)
    stride = trainorder.record_type(16, 2).itemsize
    trainorder.materialise(records, f"file:{tmp_path}/o", stride, slots=8)
    out = sorted(trainorder.read(spark, f"file:{tmp_path}/o", 16).collect(), key=lambda r: r.slot)
    assert [r.slot for r in out] == list(range(len(out)))
    assert all(r.shard == r.slot // 8 and r.byte_offset == r.slot % 8 * stride for r in out)
    held = {}
    for r in sorted(out, key=lambda r: r.start):
        held.setdefault((r.doc_id, r.n_tokens if r.doc_id == 2 and r.start == 0 and r.n_tokens == 1 else -1), []).extend(np.frombuffer(r.ids, "<u2").tolist())
    end = [trainorder.END_ID]
    assert held[(2, 1)] == end and held[(1, -1)] == end
    assert held[(2, -1)] == LIBRARY.encode_ordinary("z " * 3000) + end
    assert held[(None, -1)] == LIBRARY.encode_ordinary("x y") + end
    rest = trainorder.read(spark, f"file:{tmp_path}/o", 16, from_slot=11)
    assert sorted(r.slot for r in rest.collect()) == list(range(11, len(out)))
    assert "GreaterThanOrEqual(shard,1)" in rest._jdf.queryExecution().toString()
    trainorder.materialise(records.limit(0), f"file:{tmp_path}/e", stride)
    assert trainorder.read(spark, f"file:{tmp_path}/e", 16).count() == 0


def test_training_order_holds_every_document(spark):
    out = trainorder.op6_training_order(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas()
    want = {}
    for r in docs.itertuples():
        ids = np.array(LIBRARY.encode_ordinary(r.text) + [trainorder.END_ID], dtype="<u2")
        for at in range(0, len(ids), 512):
            want[(r.doc_id, at)] = (len(ids[at : at + 512]), zlib.crc32(ids[at : at + 512].tobytes()))
    assert {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in out.itertuples()} == want
    assert sorted(out.slot) == list(range(len(want)))


def test_registered_bpe_rows(spark):
    out = bpe.op7_byte_bpe(spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = LIBRARY.encode_ordinary(r.text or "")
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        want.append((r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(tuple(r) for r in out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == sorted(want)


def test_registered_packing_rows(spark):
    out = packing.op9_packing(spark, SF)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.columns == [*columns, *packing.PLACE] and set(dict(out.dtypes).values()) == {"bigint"}
    tokenizer = load_tokenizer(WORDS)
    ids = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = out.collect()
    at = dict.fromkeys(ids, 0)
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == at[r.doc_id] and r.length == len(piece) and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(piece, dtype="<u4").tobytes())
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 4096 and r.bucket == r.length
        at[r.doc_id] += r.length
    assert at == {d: len(x) for d, x in ids.items()} and len({r.sequence_id for r in got}) == len(got)
    shards = {}
    for r in got:
        shards.setdefault((r.bucket, r.bucket_shard), []).append(r.bucket_place)
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())


def test_ids_too_large_for_their_width_are_an_error(spark):
    wide = spark.createDataFrame([(1, np.array([70_000], "<u4").tobytes())], "doc_id long, ids binary")
    with pytest.raises(Exception, match="doesn't fit in 2 bytes"):
        trainorder.cut(wide, width=2).collect()
    assert trainorder.cut(wide, width=4).count() == 1


def test_owners_grow_with_the_shards(spark, tmp_path, monkeypatch):
    """More shards than shuffle partitions can hold: more tasks, the same training order."""
    docs = spark.createDataFrame([(i, "word " * (i % 7)) for i in range(300)], "doc_id long, text string")
    monkeypatch.setattr(trainorder, "SHARD_SLOTS", 8)
    records = trainorder.cut(bpe.encode(docs))
    stride = trainorder.record_type(trainorder.SEQUENCE_TOKENS, 2).itemsize
    read = {}
    for most in (64, 2):
        monkeypatch.setattr(trainorder, "SHARDS_PER_TASK", most)
        trainorder.materialise(records, f"file:{tmp_path}/{most}", stride, slots=8)
        read[most] = [tuple(r) for r in trainorder.read(spark, f"file:{tmp_path}/{most}").orderBy("slot").collect()]
    assert read[64] == read[2] and len(read[2]) == 300 and [r[0] for r in read[2]] == list(range(300))
