"""The corpus pipeline: quality classifier, language identification, line deduplication,
near-duplicate removal, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that ``run`` writes as Parquet to the shared folder and reads again as the next
one's ``docs``. All stages but the last return the columns of ``docs``; packing returns the
pieces with their ids, checksums and places in the buckets of equal length.

Defined results
* a stage learns only from its own input (and ``labels``), and only from the learning fold;
* where nothing labelled is left to learn from, the filtering stages reject only what needs
  no model (language: texts without a letter);
* rows sharing a ``doc_id`` are one document for the near-duplicate stage: they stay or go
  together; rows with a null id stay; repeated rows are repeated in the result;
* columns of any other name pass through unchanged, whatever they are called;
* ``n_chars`` follows the text that line deduplication leaves, where that column is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnmetrics.llm import langid, linededup, neardup, packing, quality
from learnmetrics.llm.common import fresh, stored, table

#: A text whose best language has a smaller mean posterior is rejected as mixed.
MIN_LANGUAGE_SCORE = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality 1."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if model is None:
        return docs
    score, good = fresh(docs.columns, "_quality", "_good")
    return quality.score(docs, model, names=(score, good)).where(F.col(good) == 1).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, and with one language that most of the words speak for."""
    model = langid.train(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, share = fresh(docs.columns, "_lang", "_share")
    found = langid.identify(docs, model, names=(lang, share))
    good = (F.col(lang) != langid.UNKNOWN) & (F.col(share) >= MIN_LANGUAGE_SCORE)
    return found.where(good).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share."""
    names = fresh(docs.columns, "_lines", "_dropped")
    clean = linededup.dedup_lines(docs, names=(names[0], names[1])).select(*docs.columns)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    kept = neardup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in power-of-two pieces."""
    pieces = packing.pack(docs)
    return packing.digests(pieces, extra=["ids"])


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", pack),
]

#: Learned models, signatures and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
