"""Byte-level BPE encoding by corpus-level merge replay, and decoding.

The distinct words of a stretch of the corpus (a task's texts, 8 MB at a time; words met
before in the task keep their ids) are laid out as one long row of byte tokens. An inverted index leads from a merge's rank to the
places where its pair stands; the merges are replayed in rank order over all words at once,
and each one updates only the pairs next to what it touched. Texts are then put together
from the ids of their words.

A word whose merge brings up a pair of lower rank than the one just replayed (the order of
ranks is then not the order of merges inside that word) is encoded on its own, pair by pair.

Defined results
* null or empty text: no ids; decodes to empty bytes;
* rows sharing an id are encoded row by row; other columns aren't read; an empty table
  gives an empty table;
* decoding fails on ids outside the vocabulary; null ids decode to null.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm.common import binary_array, offsets_of, spans, split_encoded, table, text_slices
from learnmetrics.llm.shingles import text_bytes

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Bytes of text whose distinct words are replayed together.
CORPUS_BYTES = 8 << 20
#: Documents decoded at once.
DECODED_ROWS = 512
_NONE = np.int32(2**31 - 1)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_table(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """Arrays for replaying: id of each byte, sorted pair keys with the id of their merge, and
    the bytes of every token for decoding."""
    size = max(ranks.values()) + 1
    keys, values = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                keys.append(left * size + right)
                values.append(rank)
    order = np.argsort(np.array(keys))
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    return {
        "size": np.int64(size),
        "byte": np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32),
        "keys": np.array(keys, dtype=np.int64)[order],
        "values": np.array(values, dtype=np.int32)[order],
        "bytes": np.frombuffer(b"".join(tokens), dtype=np.uint8),
        "bounds": offsets_of(np.array([len(t) for t in tokens])),
    }


def _pair_rank(m: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    key = left.astype(np.int64) * m["size"] + right
    at = np.minimum(np.searchsorted(m["keys"], key), len(m["keys"]) - 1)
    return np.where(m["keys"][at] == key, m["values"][at], _NONE)


def _word_ids(m: dict, word: bytes) -> list[int]:
    """Lowest-ranked, leftmost pair first, one merge at a time."""
    tokens = m["byte"][np.frombuffer(word, dtype=np.uint8)].tolist()
    while len(tokens) > 1:
        ranks = _pair_rank(m, np.array(tokens[:-1]), np.array(tokens[1:]))
        at = int(ranks.argmin())
        if ranks[at] == _NONE:
            break
        tokens[at : at + 2] = [int(ranks[at])]
    return tokens


def replay(m: dict, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, offset of every word); words are non-empty."""
    n = len(data)
    token = m["byte"][data]
    after = np.arange(1, n + 1)
    after[bounds[1:] - 1] = -1
    before = np.arange(-1, n - 1)
    before[bounds[:-1]] = -1
    byte_pairs = _pair_rank(m, np.repeat(m["byte"], 256), np.tile(m["byte"], 256))
    rank = np.full(n, _NONE, dtype=np.int32)
    inner = np.flatnonzero(after >= 0)
    rank[inner] = byte_pairs[data[inner].astype(np.int64) * 256 + data[inner + 1]]
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(places: np.ndarray, ranks: np.ndarray) -> None:
        """Puts places into the index under the rank of the pair that starts there."""
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist(), len(ranks)]
        for r, lo, hi in zip(ranks[starts[:-1]].tolist(), starts[:-1], starts[1:], strict=True):
            held = index.get(r)
            if held is None:
                index[r] = [places[lo:hi]]
                heapq.heappush(queue, r)
            else:
                held.append(places[lo:hi])

    found = np.flatnonzero(rank != _NONE)
    if len(found):
        enter(found, rank[found])
    odd: list[np.ndarray] = []
    while queue:
        r = heapq.heappop(queue)
        held = index.pop(r)
        places = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
        places = places[rank[places] == r]
        if len(held) == 1 and len(places) > 1 and (places[1:] <= places[:-1]).any():
            places = np.unique(places)
        if not len(places):
            continue
        chained = after[places[:-1]] == places[1:]
        if chained.any():  # overlapping pairs: every other one of a run, from its left
            position = np.arange(len(places))
            head = np.concatenate(([True], ~chained))
            places = places[(position - np.maximum.accumulate(np.where(head, position, 0))) % 2 == 0]
        second = after[places]
        third = after[second]
        right = np.flatnonzero(third >= 0)
        follow = third[right]
        behind = token[follow]
        token[places] = r
        # A pair with what is merged itself just now; the others are among those looked up below.
        chain = np.flatnonzero(token[follow] != behind)
        if len(chain):
            early = _pair_rank(m, np.full(len(chain), r), behind[chain])
            if (early < r).any():
                odd.append(places[right[chain[early < r]]])
        rank[places] = _NONE
        rank[second] = _NONE
        token[second] = -1
        after[places] = third
        before[follow] = places[right]
        left = before[places]
        left = left[left >= 0]
        touched = np.concatenate((places[right], left))
        if not len(touched):
            continue
        fresh = _pair_rank(m, token[touched], token[after[touched]])
        rank[touched] = fresh
        if (fresh < r).any():
            odd.append(touched[fresh < r])
        some = fresh != _NONE
        if some.any():
            enter(touched[some], fresh[some])
    alive = token >= 0
    ids, starts = token[alive].astype(np.uint32), offsets_of(alive)[bounds]
    if not odd:
        return ids, starts
    words = np.unique(np.searchsorted(bounds, np.concatenate(odd), "right") - 1)
    each = [_word_ids(m, data[bounds[w] : bounds[w + 1]].tobytes()) for w in words.tolist()]
    sizes, first = np.diff(starts), starts[:-1].copy()
    sizes[words] = [len(x) for x in each]
    first[words] = len(ids) + offsets_of(sizes[words])[:-1]
    ids = np.concatenate((ids, np.array([i for x in each for i in x], dtype=np.uint32)))
    return ids[spans(first, sizes)], offsets_of(sizes)


#: Pieces of these characters are split by Arrow's expression, which equals the vocabulary's
#: pattern where no two white-space characters meet; other pieces by the pattern itself.
_SIMPLE = r"^[ \n\x{21}-\x{7E}\x{A1}-\x{24F}]*$"
_ARROW_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\pL+| ?\pN+| ?[^\s\pL\pN]+|\s"
_CUT = "\x00"


def pieces_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct pieces, piece of every place, offsets of texts).

    Texts are cut before single spaces and after line feeds, where words of the pattern
    always end. A text with two white-space characters in a row stays in one piece.
    """
    whole = pc.match_substring_regex(texts, r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}|\x00").to_numpy(zero_copy_only=False)
    easy = pc.if_else(pa.array(whole), "", texts) if whole.any() else texts
    lines = pc.split_pattern(pc.replace_substring(easy, "\n", "\n" + _CUT), _CUT)
    codes, pieces, line_bounds = split_encoded(lines.flatten())
    bounds = line_bounds[offsets_of(pc.list_value_length(lines).to_numpy(zero_copy_only=False))]
    key = codes.astype(np.int64) + len(pieces)
    key[line_bounds[:-1]] -= len(pieces)  # a line's first piece follows no space
    used = np.zeros(2 * len(pieces), dtype=bool)
    used[key] = True
    spaced = pc.binary_join_element_wise(pa.scalar(" "), pieces, "")
    distinct = pa.concat_arrays([pieces, spaced]).take(pa.array(np.flatnonzero(used)))
    place = (np.cumsum(used) - 1)[key]
    rows = np.flatnonzero(whole)
    place[bounds[:-1][rows]] = len(distinct) + np.arange(len(rows))
    return pa.concat_arrays([distinct, texts.take(pa.array(rows))]), place, bounds


def words_of(pieces: pa.Array, pattern) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, word of every place, first place and number of words of every piece)."""
    simple = np.zeros(len(pieces), dtype=bool)
    if pattern.pattern == public_tokenizers.PATTERN:
        plain = pc.and_(pc.match_substring_regex(pieces, _SIMPLE), pc.invert(pc.match_substring_regex(pieces, r"[ \n]{2}")))
        simple = plain.to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(simple)
    split = pc.split_pattern(pc.replace_substring_regex(pieces.take(pa.array(rows)), _ARROW_PATTERN, r"\0" + _CUT), _CUT)
    flat = split.flatten()
    count = np.zeros(len(pieces), dtype=np.int64)
    count[rows] = pc.list_value_length(split).to_numpy(zero_copy_only=False) - 1  # behind the last cut stands nothing
    flat = flat.filter(pa.array(pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0))
    others = np.flatnonzero(~simple)
    found = [pattern.findall(p) for p in pieces.take(pa.array(others)).to_pylist()]
    count[others] = [len(f) for f in found]
    first = np.zeros(len(pieces), dtype=np.int64)
    first[rows] = offsets_of(count[rows])[:-1]
    first[others] = len(flat) + offsets_of(count[others])[:-1]
    words = pa.concat_arrays([flat, pa.array([w for f in found for w in f], pa.string())]).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), first, count


class KnownWords:
    """Ids of the distinct words that a task has met, in Arrow form, up to ``limit`` words and
    ``limit_bytes`` of them: the merges are replayed over words that are new to the task only."""

    def __init__(self, merges: dict, limit: int = 1 << 19, limit_bytes: int = 16 << 20):
        self.merges, self.limit, self.limit_bytes = merges, limit, limit_bytes
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def rows(self, words: pa.Array) -> np.ndarray:
        """Row of each of some distinct words; its ids are ``ids[starts[row] : starts[row + 1]]``."""
        if len(self.words) + len(words) > self.limit or self.words.nbytes + words.nbytes > self.limit_bytes:
            self._forget()
        found = pc.index_in(words, value_set=self.words)
        fresh = pc.is_null(found).to_numpy(zero_copy_only=False)
        row = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        row[fresh] = len(self.words) + np.arange(int(fresh.sum()))
        new = words.filter(pa.array(fresh))
        ids, starts = replay(self.merges, *text_bytes(new))
        self.words = pa.concat_arrays([self.words, new])
        self.starts = np.concatenate((self.starts, len(self.ids) + starts[1:]))
        self.ids = np.concatenate((self.ids, ids))
        return row


def encode_texts(merges: dict, pattern, texts: pa.Array, known: KnownWords | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, offset of every text); ``known`` goes from slice to slice."""
    known = KnownWords(merges) if known is None else known
    pieces, place, bounds = pieces_of(texts)
    words, word, first, count = words_of(pieces, pattern)
    word = known.rows(words)[word]
    ids, starts = known.ids, known.starts
    size = np.diff(starts)[word]
    piece_ids = ids[spans(starts[word], size)]
    at = offsets_of(size)
    piece_start, piece_size = at[first], at[first + count] - at[first]
    lengths = piece_size[place]
    return piece_ids[spans(piece_start[place], lengths)], offsets_of(lengths)[bounds]


def encode(docs: DataFrame, text: str = "text", doc: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc, ids): the token ids of every whole text as little-endian unsigned 32-bit integers.

    No shuffle: tasks replay the merges over the words of their own texts, each word once.
    """
    merges = merge_table(load_ranks(path or public_tokenizers.path(VOCABULARY)))
    pattern = pattern or public_tokenizers.PATTERN

    def run(batches):
        compiled, known = regex.compile(pattern), KnownWords(merges)
        for batch, texts in text_slices(batches, "text", CORPUS_BYTES):
            ids, bounds = encode_texts(merges, compiled, texts, known)
            yield pa.RecordBatch.from_arrays([batch.column(0), binary_array(ids, bounds)], names=[doc, "ids"])

    schema = T.StructType([T.StructField(doc, docs.schema[doc].dataType), T.StructField("ids", T.BinaryType())])
    return docs.select(F.col(doc), F.col(text).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of the ids."""
    merges = merge_table(load_ranks(path or public_tokenizers.path(VOCABULARY)))
    step = 1 << 18

    def run(batches):
        for batch in (b.slice(lo, DECODED_ROWS) for b in batches for lo in range(0, max(1, b.num_rows), DECODED_ROWS)):
            column = batch.column(batch.schema.get_field_index(ids))
            out = []
            for value in column:
                if not value.is_valid:
                    out.append(None)
                    continue
                found = np.frombuffer(value.as_buffer(), dtype="<u4").astype(np.int64)
                parts = []
                for lo in range(0, len(found), step):
                    some = found[lo : lo + step]
                    starts = merges["bounds"][some]
                    parts.append(merges["bytes"][spans(starts, merges["bounds"][some + 1] - starts)].tobytes())
                out.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    base = encoded.drop("decoded")
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("decoded", T.BinaryType())]))


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    found = decode(encode(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
