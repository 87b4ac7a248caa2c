"""Token ids of whole texts under a word-level BPE vocabulary of the ``tokenizers`` library.

Words repeat far more often than texts do, so a slice of texts is cut at spaces, each
distinct piece is encoded once, and the ids are gathered back in text order. Cutting is
exact for a vocabulary that normalises and splits inside white-space-free runs, as
``word_bpe_49k.json`` does; texts holding ``<|`` (special-token strings) take the plain
route through the library.

Most distinct pieces are words of lower-case letters, which that vocabulary neither
normalises nor splits; they go straight to the library's model (:func:`plain_letters`), the
others through all of its steps.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from learnmetrics.llm.common import offsets_of, spans, split_encoded

#: A Latin letter followed by ASCII punctuation: always a boundary between two words of the
#: vocabulary (but for U+0130, whose lower case ends in a combining mark).
_EDGE = r"([a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([!-/:-@\[-`{-~])"


def load_tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Lower-case Latin, Greek and Cyrillic letters in composed form. None of them combines with
#: another, so that a run of them is as composed and as lower-case as each letter is.
_LETTERS = "".join(c for c in map(chr, range(0x530)) if unicodedata.category(c) == "Ll" and unicodedata.is_normalized("NFC", c))

#: Steps that keep a run of letters as it is, if they keep each letter: they look at letters one by
#: one (given composed ones), and a run of letters is one word.
_STEPS = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
)


def plain_letters(tokenizer) -> dict[str, str]:
    """The letters that the tokenizer keeps as they are, each with what the model reads for it; none
    for a tokenizer of other steps than ``word_bpe_49k.json`` has."""
    normal, split = tokenizer.normalizer, tokenizer.pre_tokenizer
    if normal is None or split is None or tuple(json.loads(x.__getstate__()) for x in (normal, split)) != _STEPS:
        return {}
    letters = {c: split.pre_tokenize_str(c)[0][0] for c in _LETTERS if normal.normalize_str(c) == c}
    return letters if len(split.pre_tokenize_str("".join(letters))) == 1 else {}


def _encode_words(tokenizer, letters: dict[int, str], words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Like :func:`_encode_list`, for words of plain letters only. The library's tokens are freed word
    by word: holding them for a whole batch took twice the time."""
    ids, counts = [np.zeros(0, np.uint32)], []
    tokenize = tokenizer.model.tokenize
    for at in range(0, len(words), 4096):
        found = []
        for word in words.slice(at, 4096).to_pylist():
            tokens = [t.id for t in tokenize(word if word.isascii() else word.translate(letters))]
            found += tokens
            counts.append(len(tokens))
        ids.append(np.array(found, dtype=np.uint32))
    return np.concatenate(ids), np.array(counts, dtype=np.int32)


def _encode_list(tokenizer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids of each)."""
    ids, counts = [np.zeros(0, np.uint32)], []
    for at in range(0, len(texts), 4096):
        found = [e.ids for e in tokenizer.encode_batch(texts.slice(at, 4096).to_pylist(), add_special_tokens=False)]
        counts += map(len, found)
        ids.append(np.fromiter(chain.from_iterable(found), dtype=np.uint32))
    return np.concatenate(ids), np.array(counts, dtype=np.int32)


class WordEncoder:
    """Encodes slices of texts; keeps the ids of distinct pieces between slices, in Arrow form,
    up to ``limit`` pieces and ``limit_bytes`` of them."""

    def __init__(self, path: str, limit: int = 1 << 19, limit_bytes: int = 16 << 20):
        self.tokenizer = load_tokenizer(path)
        letters = plain_letters(self.tokenizer)
        self.word = f"^[{''.join(letters)}]+$" if letters else None
        self.letters = str.maketrans(letters)
        self.limit, self.limit_bytes = limit, limit_bytes
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids = np.zeros(0, np.uint32)
        self.counts = np.zeros(0, np.int32)

    def _rows(self, pieces: pa.Array) -> np.ndarray:
        """Row of each distinct piece in the table of known ids."""
        if len(self.known) + len(pieces) > self.limit or self.known.nbytes + pieces.nbytes > self.limit_bytes:
            self._forget()
        found = pc.index_in(pieces, value_set=self.known)
        fresh = pc.is_null(found).to_numpy(zero_copy_only=False)
        row = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        new = pieces.filter(pa.array(fresh)).cast(pa.string())
        word = pc.match_substring_regex(new, self.word).to_numpy(zero_copy_only=False) if self.word else np.zeros(len(new), bool)
        row[fresh] = len(self.known) + np.where(word, np.cumsum(word) - 1, word.sum() + np.cumsum(~word) - 1)
        words, others = new.filter(pa.array(word)), new.filter(pa.array(~word))
        (ids, counts), (more, sizes) = _encode_words(self.tokenizer, self.letters, words), _encode_list(self.tokenizer, others)
        self.known = pa.concat_arrays([self.known, words, others])
        self.ids = np.concatenate((self.ids, ids, more))
        self.counts = np.concatenate((self.counts, counts, sizes))
        return row

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offset of every text)."""
        plain = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        easy = pc.if_else(pa.array(plain), "", texts) if plain.any() else texts
        easy = pc.replace_substring_regex(pc.replace_substring(easy, "\n", " "), _EDGE, r"\1 \2")
        codes, pieces, bounds = split_encoded(pc.ascii_lower(easy))
        row = self._rows(pieces)[codes]
        lengths = self.counts[row]
        flat = self.ids[spans(offsets_of(self.counts)[row], lengths)]
        offsets = offsets_of(lengths)[bounds]
        if not plain.any():
            return flat, offsets
        rows = np.flatnonzero(plain)
        more, sizes = _encode_list(self.tokenizer, texts.take(pa.array(rows)))
        size = np.diff(offsets)
        starts = offsets[:-1].copy()
        starts[rows] = len(flat) + offsets_of(sizes)[:-1]
        size[rows] = sizes
        return np.concatenate((flat, more))[spans(starts, size)], offsets_of(size)
