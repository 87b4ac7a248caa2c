"""Word shingles of whole texts as 64-bit hashes, computed over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from learnmetrics.llm.common import mix64, offsets_of

_BASE = 0x9E3779B97F4A7C15 | 1


def _byte_codes() -> np.ndarray:
    """A random-looking 64-bit code per byte; A-Z share those of a-z."""
    codes = mix64(np.arange(256, dtype=np.uint64), 7)
    codes[65:91] = codes[97:123]
    return codes


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64. They are made anew for every
    slice of texts: kept, the largest slice's would stay with the worker for its life."""
    out = []
    with np.errstate(over="ignore"):
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            step = np.full(n, base, dtype=np.uint64)
            step[0] = 1
            out.append(np.cumprod(step, out=step))
    return out[0], out[1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offset of every text)."""
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or bounds[0] == bounds[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_bounds(data: np.ndarray, bounds: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and end of every word, offset of every text's first word); ``in_word`` tells
    for each of the 256 byte values whether it belongs to words."""
    mask = np.zeros(len(data) + 1, dtype=bool)
    mask[:-1] = in_word[data]
    head = mask.copy()
    head[1:] &= ~mask[:-1]
    first = bounds[:-1][np.diff(bounds) > 0]
    head[first] = mask[first]
    starts = np.flatnonzero(head)
    tail = mask[:-1] & (~mask[1:] | head[1:])
    if len(data):
        last = bounds[1:][np.diff(bounds) > 0] - 1
        tail[last] = mask[last]
    return starts, np.flatnonzero(tail) + 1, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, A-Z in lower case."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)  # an empty word may start behind the last byte
    with np.errstate(over="ignore"):
        running = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_byte_codes()[data] * up[:-1], out=running[1:])
        return mix64((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


WHITE = np.ones(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = False


def shingle_sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of every text one after the other, offsets).

    Words are maximal runs without ``[\\x20\\x09-\\x0D]``, A-Z in lower case. A text of fewer
    than ``width`` words is one shingle; a text without words has none.
    """
    data, bounds = text_bytes(texts)
    starts, ends, first = word_bounds(data, bounds, WHITE)
    hashes = word_hashes(data, starts, ends)
    words = np.diff(first)
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(hashes), dtype=np.uint64)
        for j in range(width):
            factor = mix64(np.array([j], np.uint64), 11)[0] | np.uint64(1)
            reach = max(0, len(hashes) - j)
            rolled[:reach] += hashes[j:] * factor
        # What would reach into the next text is cut; a short text keeps its one partial sum.
        place = np.arange(len(hashes)) - np.repeat(first[:-1], words)
        keep = place <= np.repeat(np.maximum(words - width, 0), words)
        for row in np.flatnonzero((words > 0) & (words < width)):
            part = hashes[first[row] : first[row + 1]]
            factors = mix64(np.arange(len(part), dtype=np.uint64), 11) | np.uint64(1)
            rolled[first[row]] = (part * factors).sum() + np.uint64(len(part))
    values = mix64(rolled[keep], 3)
    bounds = offsets_of(np.where(words >= width, words - width + 1, (words > 0).astype(np.int64)))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[lo:hi].sort()
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    fresh[bounds[:-1][np.diff(bounds) > 0]] = True
    return values[fresh], offsets_of(fresh)[bounds]
