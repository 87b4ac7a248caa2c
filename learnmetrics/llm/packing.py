"""Packing by power-of-two decomposition.

Every document's ids, closed by an end id, are cut into pieces whose lengths are powers of
two: as many of the full length as fit, then the binary digits of the rest, largest first.
Pieces of equal length form a bucket, and each piece is a training sequence of its bucket:
no sequence crosses documents and none needs padding. Every piece has its place: ``bucket``
(its length), ``bucket_shard`` (the task that made it) and ``bucket_place``, gapless from 0 in
the shard's bucket. A batch is a run of places of one bucket's shard; ``write_buckets`` stores
them so, ``read_bucket`` gives one bucket in that order.

Defined results
* null or empty text: the end id alone, one piece of length 1; a very long text is encoded
  whole and cut into as many pieces of the full length as it fills;
* rows sharing a ``doc_id``, and rows with a null id, are packed row by row;
* other input columns are not read, so their names can't clash; an empty table packs to
  an empty table.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm.common import binary_array, offsets_of, release, spans, table, text_slices
from learnmetrics.llm.wordbpe import WordEncoder

MAX_TOKENS = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Where a piece stands among those of its length.
PLACE = ["bucket", "bucket_shard", "bucket_place"]


def decompose(lengths: np.ndarray, longest: int = MAX_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document index, start, length) of the power-of-two pieces of documents of the given
    lengths, in document and start order. ``longest`` is a power of two."""
    bits = longest.bit_length() - 1
    full = lengths >> bits
    doc = [np.repeat(np.arange(len(lengths)), full)]
    start = [spans(np.zeros_like(full), full) << bits]
    size = [np.full(len(doc[0]), longest)]
    for bit in range(bits - 1, -1, -1):
        has = np.flatnonzero((lengths >> bit) & 1)
        doc.append(has)
        start.append((lengths[has] >> (bit + 1)) << (bit + 1))
        size.append(np.full(len(has), 1 << bit))
    doc, start, size = map(np.concatenate, (doc, start, size))
    order = np.lexsort((start, doc))
    return doc[order], start[order], size[order]


def places(lengths: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Place of every piece in its bucket, going on from ``filled`` (by bit), which is moved on."""
    bit = np.log2(lengths).astype(np.int64)
    order = np.argsort(bit, kind="stable")
    counts = np.bincount(bit, minlength=len(filled))
    out = np.empty(len(lengths), dtype=np.int64)
    out[order] = spans(filled, counts)
    filled += counts
    return out


def pack(
    docs: DataFrame,
    text: str = "text",
    doc: str = "doc_id",
    tokenizer_path: str | None = None,
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces: ``doc``, start, length, ids (little-endian unsigned 32-bit), doc_tokens, bucket,
    bucket_shard, bucket_place, sequence_id, offset.

    One pass over the texts, no shuffle: a piece needs nothing but its document, and its
    sequence number is unique by partition and place, the same at every retry of a task.
    ``write_buckets`` stores the pieces bucket by bucket.
    """
    path = tokenizer_path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        encoder = WordEncoder(path)
        shard = TaskContext.get().partitionId()
        filled = np.zeros(max_tokens.bit_length(), dtype=np.int64)
        for batch, texts in text_slices(batches, "text"):
            ids, offsets = encoder.encode(texts)
            count = np.diff(offsets)
            closed = np.full(len(ids) + len(count), end_id, dtype=np.uint32)
            closed[spans(offsets[:-1] + np.arange(len(count)), count)] = ids
            count = count + 1
            row, start, length = decompose(count, max_tokens)
            place = places(length, filled)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int64)),
                    binary_array(closed, offsets_of(length)),
                    pa.array(count[row]),
                    pa.array(length.astype(np.int64)),
                    pa.array(np.full(len(row), shard, dtype=np.int64)),
                    pa.array(place),
                ],
                names=[doc, "start", "length", "ids", "doc_tokens", *PLACE],
            )
        del encoder
        release()

    schema = T.StructType(
        [T.StructField(doc, docs.schema[doc].dataType), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
         T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()), *(T.StructField(c, T.LongType()) for c in PLACE)]
    )
    pieces = docs.select(F.col(doc), F.col(text).alias("text")).mapInArrow(run, schema)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store the pieces as one folder per bucket, for bucket-wise reading."""
    pieces.write.partitionBy("bucket").parquet(path)


def read_bucket(spark, path: str, bucket: int) -> DataFrame:
    """The pieces of one bucket in the order of their shards and places; only its folder is read."""
    return spark.read.parquet(path).where(F.col("bucket") == bucket).orderBy("bucket_shard", "bucket_place")


def digests(pieces: DataFrame, doc: str = "doc_id", extra: list[str] | None = None) -> DataFrame:
    """The pieces with a checksum in place of their ids, and ``extra`` columns."""
    ids = F.crc32("ids").alias("ids_crc32")
    return pieces.select(doc, "start", "length", ids, "doc_tokens", "sequence_id", "offset", *PLACE, *(extra or []))


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return digests(pack(table(spark, sf_dir, "documents")))
