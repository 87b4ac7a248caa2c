"""Line deduplication across documents, in DataFrame functions only.

Every line is normalised and hashed; documents are counted per hash; lines whose hash
occurs in too many documents are dropped everywhere but in the largest ``doc_id`` that
holds them; the rest is put together again by position.

Defined results
* null or empty text is one empty line; it is never dropped (too short to be a key);
* rows that share a ``doc_id`` count as one document for the threshold, and each row is
  cleaned on its own; null ids count as no document and their lines are dropped whenever
  the key is over the threshold;
* an equal line repeated inside its keeper document stays every time;
* every input column is returned; ``n_lines`` and ``n_dropped`` replace columns of the
  same name, columns of any other name pass through; very long texts are split like others,
  only their ids, positions and hashes are shuffled line by line; an empty table gives an
  empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnmetrics.llm.common import fresh

MIN_CHARS = 20
MIN_DOCS = 3
#: ``[\x20\x09-\x0D]``
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    key = F.trim(line, F.lit(BLANKS))
    # lower() equals the A-Z mapping where every character is one byte, and is much cheaper.
    return F.when(F.octet_length(key) == F.char_length(key), F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def common_lines(docs: DataFrame, doc: str, text: str, min_chars: int, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(every long line's place and key, keys over the threshold with their keeper)."""
    lines = (
        docs.select(
            F.col(doc).alias("d"),
            F.xxhash64(text).alias("t"),
            F.posexplode(F.split(text, "\n")).alias("pos", "line"),
        )
        .where(F.char_length("line") >= min_chars)
        .withColumn("key", line_key(F.col("line")))
        .where(F.char_length("key") >= min_chars)
        # 128 bits: at 10^12 distinct lines 64 bits alone would collide.
        .select("d", "t", "pos", F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))
    )
    common = (
        lines.where(F.col("d").isNotNull())
        .groupBy("h1", "h2", "d").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("d").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    return lines, common


def dedup_lines(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    names: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with ``text`` cleaned, plus ``n_lines`` and ``n_dropped`` under ``names``.

    The line table carries ids, positions and hashes only; a key held by a third of all
    documents is pre-aggregated per task, and its rows are split by the skew join. The
    text moves once, to meet its dropped positions.
    """
    columns = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    whole, gone = fresh([*columns, *names], "_text", "_dropped")
    base = docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias(whole))
    lines, common = common_lines(base, doc, whole, min_chars, min_docs)
    dropped = (
        lines.join(common, ["h1", "h2"])
        .where(F.col("d").isNull() | (F.col("d") != F.col("keeper")))
        .groupBy("d", "t").agg(F.collect_set("pos").alias(gone))
    )
    joined = base.join(
        dropped,
        base[doc].eqNullSafe(dropped["d"]) & (F.xxhash64(base[whole]) == dropped["t"]),
        "left",
    )
    # The lines are bound once to a lambda variable, so they are not split again per position.
    kept = F.transform(
        F.array(F.split(whole, "\n")),
        lambda split: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(1), F.size(split)), F.transform(gone, lambda p: p + 1)),
                lambda i: F.element_at(split, i),
            ),
            "\n",
        ),
    )[0]
    return joined.select(
        *[(F.when(F.col(gone).isNull(), F.col(whole)).otherwise(kept).alias(c) if c == text else base[c]) for c in columns],
        (F.octet_length(whole) - F.octet_length(F.translate(whole, "\n", "")) + 1).cast("long").alias(names[0]),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(names[1]),
    )


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")
    )


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(generate_series(1, len(l))) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone
  FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
