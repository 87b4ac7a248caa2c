"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Each passage is encoded from hashed words, word
shapes and how recently a word stood before, by learned embeddings; gated attention, learned
from document labels alone, weighs the passages; the weighted representation gives the score.
A few bad passages can thus decide about a long document.

Defined results
* null or empty text: no passage; the score is the model's bias alone;
* a very long text is scored whole, all its passages weighed together; rows sharing an id are
  scored row by row; in learning, repeated rows count once;
* every input column is returned; ``score`` and ``predicted`` replace columns of that name;
* rows without a label, and rows outside the learning fold, teach nothing; without any
  labelled row every score is 0.5; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm.common import (
    is_training_row, mix64, offsets_of, spans, split_encoded, stored, table, text_slices, with_columns_schema,
)
from learnmetrics.llm.shingles import text_bytes, word_hashes
from learnmetrics.llm.training import Adam, bounded_sample, mixed

PASSAGE_WORDS = 64
THRESHOLD = 0.7
#: Labelled rows learned from, at most so many per label value.
SAMPLE_PER_LABEL = 1500
WORDS, SHAPES, DIM, GATES = 4096, 1024, 16, 8
#: A word's distance to its last place in the document: 1, to 4, to 16, to 64, more, none.
RECENT = (1, 4, 16, 64)
ROUNDS, EPOCHS, BATCH, RATE = 3, 4, 16, 0.02


def _shape_bytes() -> np.ndarray:
    """Byte classes: lower case, upper case, digit, non-ASCII; punctuation stands for itself."""
    classes = np.arange(256, dtype=np.uint8)
    classes[97:123] = 97
    classes[65:91] = 1
    classes[48:58] = 2
    classes[128:] = 3
    return classes


def recency(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Class of the distance from every place to the last one of the same word in its text."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = owner * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.full(len(codes), len(RECENT) + 1, dtype=np.int8)
    out[order[1:][same]] = np.searchsorted(RECENT, np.diff(order)[same])
    return out


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word feature, shape feature of every distinct word; word and recency of every place;
    offsets of texts).

    Words are split at spaces and line feeds; the empty ones between two of them are left out.
    """
    codes, pieces, bounds = split_encoded(pc.replace_substring(texts, "\n", " "))
    data, at = text_bytes(pieces)
    word = (word_hashes(data, at[:-1], at[1:]) % np.uint64(WORDS)).astype(np.int32)
    classes = _shape_bytes()[data]
    fresh = np.ones(len(classes), dtype=bool)
    fresh[1:] = classes[1:] != classes[:-1]
    fresh[at[:-1][np.diff(at) > 0]] = True
    runs = offsets_of(fresh)[at]
    shape = (mix64(word_hashes(classes[fresh], runs[:-1], runs[1:]), 5) % np.uint64(SHAPES)).astype(np.int32)
    real = (np.diff(at) > 0)[codes]
    codes, bounds = codes[real], offsets_of(real)[bounds]
    return word, shape, codes, recency(codes, bounds), bounds


def passages(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word of every passage, offsets of the documents' passages); words in all: bounds[-1]."""
    counts = -(-np.diff(bounds) // PASSAGE_WORDS)
    first = spans(np.zeros_like(counts), counts) * PASSAGE_WORDS + np.repeat(bounds[:-1], counts)
    return first, offsets_of(counts)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sum_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the rows between bounds; empty stretches give 0."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), dtype=values.dtype)
    full = np.diff(bounds) > 0
    if full.any():
        out[full] = np.add.reduceat(values, bounds[:-1][full])
    return out


def forward(p: dict, encoded: np.ndarray, bags: np.ndarray) -> dict:
    """Attention over passages (rows of ``encoded``, before the tanh) in bags between offsets."""
    h = np.tanh(encoded + p["bias"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    s = (t * g) @ p["w"]
    owner = np.repeat(np.arange(len(bags) - 1), np.diff(bags))
    top = np.full(len(bags) - 1, -np.inf, dtype=np.float32)
    np.maximum.at(top, owner, s)
    e = np.exp(s - top[owner])
    a = e / _sum_by(e, bags)[owner]
    z = _sum_by(a[:, None] * h, bags)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "owner": owner, "p": _sigmoid(z @ p["c"] + p["b"][0])}


def start_parameters(seed: int = 3) -> dict:
    rng = np.random.default_rng(seed)
    shape = {"Ew": (WORDS, DIM), "Es": (SHAPES, DIM), "Er": (len(RECENT) + 2, DIM), "V": (DIM, GATES), "U": (DIM, GATES), "w": (GATES,), "c": (DIM,)}
    p = {k: rng.normal(0, 0.3, size=v).astype(np.float32) for k, v in shape.items()}
    return p | {"bias": np.zeros(DIM, np.float32), "b": np.zeros(1, np.float32)}


def fit(p: dict, rows, turn: int) -> dict:
    """A few epochs of Adam on one shard."""
    rng = np.random.default_rng(turn)
    word, shape, place, recent, bounds = features(pa.array(rows["text"].fillna("").tolist(), pa.string()))
    truth = rows["label"].to_numpy().astype(np.float32)
    weight = np.where(truth > 0, 1 / max(1, truth.sum()), 1 / max(1, (1 - truth).sum())).astype(np.float32) * len(truth) / 2
    opt = Adam(p, RATE)
    for _ in range(EPOCHS):
        order = rng.permutation(len(truth))
        for lo in range(0, len(order), BATCH):
            docs = order[lo : lo + BATCH]
            size = np.diff(bounds)[docs]
            picked = spans(bounds[:-1][docs], size)
            at, ago = place[picked], recent[picked]
            own = offsets_of(size)
            first, bags = passages(own)
            if not len(first):
                continue
            edges = np.append(first, own[-1])
            count = np.diff(edges).astype(np.float32)[:, None]
            encoded = _sum_by(p["Ew"][word[at]] + p["Es"][shape[at]] + p["Er"][ago], edges) / count
            f = forward(p, encoded, bags)
            d = (f["p"] - truth[docs]) * weight[docs] / len(docs)
            dz = d[:, None] * p["c"]
            da = (f["h"] * dz[f["owner"]]).sum(axis=1)
            ds = f["a"] * (da - _sum_by(f["a"] * da, bags)[f["owner"]])
            dt = ds[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2)
            dg = ds[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
            dh = f["a"][:, None] * dz[f["owner"]] + dt @ p["V"].T + dg @ p["U"].T
            pre = dh * (1 - f["h"] ** 2)
            spread = np.repeat(pre / count, np.diff(edges), axis=0)
            grad = {
                "Ew": np.zeros_like(p["Ew"]), "Es": np.zeros_like(p["Es"]), "Er": np.zeros_like(p["Er"]), "bias": pre.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": ds @ (f["t"] * f["g"]), "c": d @ f["z"], "b": np.array([d.sum()], np.float32),
            }
            np.add.at(grad["Ew"], word[at], spread)
            np.add.at(grad["Es"], shape[at], spread)
            np.add.at(grad["Er"], ago, spread)
            opt.step(grad)
    return p


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc: str = "doc_id", label: str = "quality") -> dict | None:
    """Parameters learned from the labelled rows of the learning fold, None without any."""
    known = labels.where(is_training_row(doc)).select(F.col(doc).alias("doc"), F.col(label).cast("int").alias("label"))
    sample = bounded_sample(docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")), known.where("label in (0, 1)"), SAMPLE_PER_LABEL)
    return mixed(sample, start_parameters(), fit, ROUNDS)


def score(
    docs: DataFrame, model: dict | None, text: str = "text", threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on), under ``names``."""
    docs = docs.drop(*names)
    fields = [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())]
    if model is None:
        model = {k: np.zeros_like(v) for k, v in start_parameters().items()}

    def run(batches):
        for batch, texts in text_slices(batches, text):
            word, shape, place, recent, bounds = features(texts)
            first, bags = passages(bounds)
            vectors = model["Ew"][word] + model["Es"][shape]
            encoded = np.zeros((len(first), DIM), dtype=np.float32)
            for lo in range(0, len(first), 4096):  # bounds the gathered vectors
                edges = np.append(first[lo : lo + 4096], first[lo + 4096] if lo + 4096 < len(first) else bounds[-1])
                part = vectors[place[edges[0] : edges[-1]]] + model["Er"][recent[edges[0] : edges[-1]]]
                encoded[lo : lo + 4096] = np.add.reduceat(part, edges[:-1] - edges[0]) / np.diff(edges)[:, None]
            value = forward(model, encoded, bags)["p"].astype(np.float64)
            flag = (value >= threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value), pa.array(flag)], names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, with_columns_schema(docs, fields))


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (~is_training_row()).alias("held_out"), "score", "predicted")
