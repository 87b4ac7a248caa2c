"""Language identification by a linear-chain conditional random field over words.

Every word gets a label; features are its affixes, inner character n-grams and its entry in
a lexicon, transitions are learned. Training sequences are code-switched: passages of
documents of several languages are chained, each word carrying the language of its
document. A text is labelled by forward-backward; the language with the largest mean
posterior over its words is the document's.

Defined results
* null text, or text without a letter: ``und`` with score 0;
* ties between languages go to the one that sorts first;
* every row is labelled on its own, also where rows share an id; in learning, repeated rows
  count once and rows of one id keep the language of their own row; only the 256 most
  frequent languages are learned; a very long text is labelled whole, in bounded memory;
* every input column is returned; ``lang_pred`` and ``score`` replace columns of that name;
* without any labelled row of the learning fold every text is ``und``; an empty table gives
  an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm.common import (
    is_training_row, mix64, offsets_of, spans, split_encoded, table, text_slices, with_columns_schema,
)
from learnmetrics.llm.training import Adam, bounded_sample, mixed

UNKNOWN = "und"
#: Labelled documents learned from, at most so many per language; words in the lexicon.
SAMPLE_PER_LANGUAGE = 400
LEXICON_WORDS = 20_000
HASHED = 1 << 15
NGRAMS = (1, 2, 3, 4)
ROUNDS, EPOCHS, RATE = 3, 3, 0.05
#: Words in a training passage, passages in a training sequence.
PASSAGE, CHAIN = 24, 8
#: Padded places that forward-backward holds at once; distinct words whose features stand at once.
PLACES = 1 << 18
FEATURED = 1 << 13
START, END, GAP = 2, 3, "\x03\x02"


def letter_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(word of every place, distinct words, offsets of texts): runs of letters, lower case."""
    spaced = pc.replace_substring_regex(pc.utf8_lower(texts), r"\PL+", " ")
    codes, pieces, bounds = split_encoded(spaced)
    real = (pc.binary_length(pieces).to_numpy(zero_copy_only=False) > 0)[codes]
    return codes[real], pieces, offsets_of(real)[bounds]


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids of all words, offset of each word's first).

    Affixes are the n-grams that hold a word's start or end mark; the last feature is the
    lexicon entry (entry 0 for words outside it).
    """
    marked = chr(START) + GAP.join(words) + chr(END)
    chars = np.frombuffer(marked.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    ends = np.repeat(np.cumsum(length), length)
    owner = np.repeat(np.arange(len(words)), length)
    ids, of = [], []
    rolled = np.zeros(len(chars), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for n in NGRAMS:
            if n > len(chars):
                break
            factor = mix64(np.array([n], np.uint64), 17)[0] | np.uint64(1)
            rolled[: len(chars) - n + 1] += chars[n - 1 :] * factor
            inside = np.flatnonzero(np.arange(len(chars)) + n <= ends)
            ids.append((mix64(rolled[inside], n) % np.uint64(HASHED)).astype(np.int64))
            of.append(owner[inside])
    ids.append(HASHED + np.fromiter((lexicon.get(w, 0) for w in words), dtype=np.int64, count=len(words)))
    of.append(np.arange(len(words)))
    ids, of = np.concatenate(ids), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return ids[order], offsets_of(np.bincount(of, minlength=len(words)))


def emissions(weights: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Summed weights of each word's features (every word has some)."""
    if len(bounds) < 2:
        return np.zeros((0, weights.shape[1]), np.float32)
    return np.add.reduceat(weights[ids], bounds[:-1])


def forward_backward(
    scores: np.ndarray, transition: np.ndarray, start: np.ndarray, learn: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of every place and, to ``learn`` from, expected transitions.

    ``scores`` (places x sequences x labels) is padded with NaN behind a sequence's end.
    """
    places, count, labels = scores.shape
    open_ = ~np.isnan(scores[:, :, 0])
    local = np.where(open_[:, :, None], scores, 0)
    local = np.exp(local - local.max(axis=2, keepdims=True))
    step = np.exp(transition - transition.max())
    alpha = np.empty_like(local)
    a = np.exp(start - start.max()) * local[0]
    alpha[0] = a / a.sum(axis=1, keepdims=True)
    for t in range(1, places):
        a = (alpha[t - 1] @ step) * local[t]
        a /= a.sum(axis=1, keepdims=True)
        alpha[t] = a
    beta = np.ones((count, labels), dtype=local.dtype)
    expected = np.zeros((labels, labels))
    gamma = alpha  # overwritten from the end on
    for t in range(places - 1, 0, -1):
        go = open_[t][:, None]
        inner = beta * local[t]
        if learn:
            pair = alpha[t - 1][:, :, None] * step * inner[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            expected += pair[open_[t]].sum(axis=0)
        b = inner @ step.T
        b /= b.sum(axis=1, keepdims=True)
        g = alpha[t] * beta
        gamma[t] = g / g.sum(axis=1, keepdims=True)
        beta = np.where(go, b, 1)
    g = alpha[0] * beta
    gamma[0] = g / g.sum(axis=1, keepdims=True)
    return gamma, expected


def _padded(emission: np.ndarray, codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    out = np.full((int(size.max()), len(size), emission.shape[1]), np.nan, dtype=np.float32)
    place = spans(np.zeros_like(size), size)
    out[place, np.repeat(np.arange(len(size)), size)] = emission[codes[spans(first, size)]]
    return out


def chains(codes: np.ndarray, bounds: np.ndarray, labels: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code-switched sequences: passages of all documents in random order, chained. Returns
    (words, labels, offsets of sequences)."""
    counts = -(-np.diff(bounds) // PASSAGE)
    first = spans(np.zeros_like(counts), counts) * PASSAGE + np.repeat(bounds[:-1], counts)
    size = np.minimum(PASSAGE, np.repeat(bounds[1:], counts) - first)
    label = np.repeat(labels, counts)
    order = rng.permutation(len(first))
    first, size, label = first[order], size[order], label[order]
    ends = offsets_of(size)[np.unique(np.append(np.arange(0, len(size), CHAIN), len(size)))]
    return codes[spans(first, size)], np.repeat(label, size), ends


def fit(p: dict, rows, turn: int, languages: list[str], lexicon: dict[str, int]) -> dict:
    """A few epochs of Adam on one shard."""
    rng = np.random.default_rng(turn)
    codes, pieces, bounds = letter_words(pa.array(rows["text"].fillna("").tolist(), pa.string()))
    ids, at = word_features(pieces.to_pylist(), lexicon)
    truth = rows["label"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    opt = Adam(p, RATE)
    for _ in range(EPOCHS):
        words, labels, ends = chains(codes, bounds, truth, rng)
        for lo in range(0, len(ends) - 1, 64):
            cut = ends[lo : lo + 65]
            size = np.diff(cut)
            size, first = size[size > 0], cut[:-1][size > 0]
            if not len(size):
                continue
            local = words[cut[0] : cut[-1]]
            used, local = np.unique(local, return_inverse=True)
            feature = ids[spans(at[used], at[used + 1] - at[used])]
            span = offsets_of(at[used + 1] - at[used])
            scores = _padded(emissions(p["W"], feature, span), local, first - cut[0], size)
            gamma, expected = forward_backward(scores, p["T"], p["S"])
            place = spans(np.zeros_like(size), size)
            g = gamma[place, np.repeat(np.arange(len(size)), size)]
            y = labels[cut[0] : cut[-1]]
            g[np.arange(len(y)), y] -= 1
            n = np.float32(len(y))
            per_word = np.zeros((len(used), len(languages)), dtype=np.float32)
            np.add.at(per_word, local, g / n)
            grad = {k: np.zeros_like(v) for k, v in p.items()}
            np.add.at(grad["W"], feature, np.repeat(per_word, np.diff(span), axis=0))
            inner = np.ones(len(y), dtype=bool)
            inner[first - cut[0]] = False
            seen = np.zeros((len(languages), len(languages)))
            after = np.flatnonzero(inner)
            np.add.at(seen, (y[after - 1], y[after]), 1)
            grad["T"] += ((expected - seen) / n).astype(np.float32)
            grad["S"] += (g[first - cut[0]].sum(axis=0) / n).astype(np.float32)
            opt.step(grad)
    return p


def train(docs: DataFrame, text: str = "text", doc: str = "doc_id", lang: str = "lang") -> dict | None:
    """The model learned from the learning fold's rows with a language, None without any."""
    base = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"), F.col(lang).alias("label"))
    base = base.where(is_training_row("doc"))
    sample = bounded_sample(base, base.select("doc", "label"), SAMPLE_PER_LANGUAGE)
    languages = [r["label"] for r in sample.select("label").distinct().orderBy("label").collect()]
    if not languages:
        return None
    counted = (
        sample.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"))).alias("w"))
        .groupBy("w").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "w").limit(LEXICON_WORDS).collect()
    )
    lexicon = {r["w"]: i + 1 for i, r in enumerate(counted)}
    k = len(languages)
    start = {
        "W": np.zeros((HASHED + 1 + len(lexicon), k), np.float32),
        "T": np.zeros((k, k), np.float32), "S": np.zeros(k, np.float32),
    }
    found = mixed(sample, start, lambda p, rows, turn: fit(p, rows, turn, languages, lexicon), ROUNDS)
    return found | {"languages": languages, "lexicon": lexicon}


def posteriors(model: dict, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of every word, offsets of texts)."""
    codes, pieces, bounds = letter_words(texts)
    emission = np.concatenate(
        [np.zeros((0, len(model["languages"])), np.float32)]
        + [emissions(model["W"], *word_features(pieces[lo : lo + FEATURED].to_pylist(), model["lexicon"])) for lo in range(0, len(pieces), FEATURED)]
    )
    out = np.zeros((len(codes), emission.shape[1]), dtype=np.float32)
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 0]
    lo = 0
    while lo < len(order):  # texts of like length together: little padding, bounded memory
        hi = lo + max(1, int(PLACES // size[order[lo]]))
        part = order[lo:hi]
        gamma, _ = forward_backward(_padded(emission, codes, bounds[:-1][part], size[part]), model["T"], model["S"], learn=False)
        place = spans(np.zeros_like(size[part]), size[part])
        out[spans(bounds[:-1][part], size[part])] = gamma[place, np.repeat(np.arange(len(part)), size[part])]
        lo = hi
    return out, bounds


def identify(
    docs: DataFrame, model: dict | None, text: str = "text", segments: bool = False, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, under ``names``; with ``segments`` also the
    runs of words of one language, as (lang, words) in text order."""
    docs = docs.drop(*names, *(["segments"] if segments else []))
    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    run_type = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("words", T.IntegerType())]))
    if segments:
        fields.append(T.StructField("segments", run_type))

    def run(batches):
        for batch, texts in text_slices(batches, text):
            langs, scores, runs = [UNKNOWN] * len(texts), np.zeros(len(texts)), [[] for _ in range(len(texts))]
            if model is not None:
                each, bounds = posteriors(model, texts)
                rows = np.flatnonzero(np.diff(bounds))
                if len(rows):
                    mean = np.add.reduceat(each.astype(np.float64), bounds[:-1][rows]) / np.diff(bounds)[rows][:, None]
                    best = mean.argmax(axis=1)
                    scores[rows] = np.clip(mean[np.arange(len(rows)), best], 0, 1)
                    for r, b in zip(rows.tolist(), best.tolist(), strict=True):
                        langs[r] = model["languages"][b]
                if segments:
                    for r in rows.tolist():
                        label = each[bounds[r] : bounds[r + 1]].argmax(axis=1)
                        cut = np.flatnonzero(np.diff(label, prepend=-1))
                        runs[r] = [
                            {"lang": model["languages"][label[c]], "words": int(n)}
                            for c, n in zip(cut, np.diff(np.append(cut, len(label))), strict=True)
                        ]
            more = [pa.array(langs, pa.string()), pa.array(scores)]
            if segments:
                more.append(pa.array(runs, pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *[f.name for f in fields]])

    return docs.mapInArrow(run, with_columns_schema(docs, fields))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", (~is_training_row()).alias("held_out"), "lang_pred", "score")
