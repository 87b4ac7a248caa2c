"""Training-order materialisation of token sequences.

Documents' ids are cut into sequences of fixed length; sequences are numbered without gaps;
a keyed Feistel permutation with cycle-walking gives every number its global slot, so the
training order is a random-looking permutation that needs no sort key in memory. Slots are
dealt to tasks by range, and each task writes its shards: blobs of fixed-stride records, so
that slot s stands in shard s // slots at byte (s % slots) * stride. A reader goes through
the shards in order, and resumes at any slot without reading what lies before it.

A record is: id, start (64-bit), tokens, 1 for a null id (32-bit), then the ids (16- or
32-bit), all little-endian; ids beyond ``tokens`` are padding (0).

Defined results
* null or empty text: one sequence holding the end id alone; a very long text is cut into as
  many sequences as it fills; ids too large for ``width`` bytes are an error;
* rows sharing an id, and rows with null ids, are cut row by row; other columns aren't read;
* an empty table gives no shards and reads as an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm import bpe
from learnmetrics.llm.common import mix64, offsets_of, spans, table
from learnmetrics.session import scratch_path

SEQUENCE_TOKENS = 512
#: The id closing a document: free in the byte-level vocabulary.
END_ID = 50256
#: Records per shard (a shard of 512 16-bit ids has 4.3 MB).
SHARD_SLOTS = 4096
#: Most shards that one task sorts and writes (about 280 MB).
SHARDS_PER_TASK = 64
KEY = 20240613
FEISTEL_ROUNDS = 4


def record_type(length: int, width: int) -> np.dtype:
    return np.dtype([("doc", "<i8"), ("start", "<i8"), ("tokens", "<u4"), ("null", "<u4"), ("ids", f"<u{width}", (length,))])


def feistel(numbers: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """Slots of numbers below ``size``: a keyed permutation of [0, size).

    The network permutes the smallest domain of an even number of bits that holds ``size``;
    what falls outside walks on along its cycle until it is back inside.
    """
    half = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> np.uint64(half), out[walking] & mask
        for turn in range(FEISTEL_ROUNDS):
            left, right = right, left ^ (mix64(right ^ np.uint64((key * 0x9E3779B97F4A7C15) & (2**64 - 1)), turn + 1) & mask)
        out[walking] = (left << np.uint64(half)) | right
        walking = walking[out[walking] >= np.uint64(size)]
    return out.astype(np.int64)


def cut(encoded: DataFrame, doc: str = "doc_id", ids: str = "ids", length: int = SEQUENCE_TOKENS, end_id: int = END_ID, width: int = 2) -> DataFrame:
    """(number, record): the fixed-stride records of all documents; number is unique, growing
    by task and place. ``width`` bytes hold an id."""
    kind = record_type(length, width)

    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            null = keys.is_null().to_numpy(zero_copy_only=False)
            docs = keys.fill_null(0).to_numpy(zero_copy_only=False)
            values = [np.frombuffer(v.as_buffer(), dtype="<u4") if v.is_valid else np.zeros(0, "<u4") for v in batch.column(1)]
            lo = 0
            while lo < len(values):  # some MB of ids at a time
                hi, held = lo, 0
                while hi < len(values) and (hi == lo or held < 1 << 21):
                    held += len(values[hi])
                    hi += 1
                count = np.fromiter(map(len, values[lo:hi]), dtype=np.int64, count=hi - lo) + 1
                flat = np.concatenate([x for v in values[lo:hi] for x in (v, np.array([end_id], "<u4"))])
                if int(flat.max()) >> (8 * width):
                    raise ValueError(f"id {int(flat.max())} doesn't fit in {width} bytes")
                pieces = -(-count // length)
                row = np.repeat(np.arange(hi - lo), pieces)
                start = spans(np.zeros_like(pieces), pieces) * length
                tokens = np.minimum(length, count[row] - start)
                records = np.zeros(len(row), dtype=kind)
                records["doc"], records["start"], records["tokens"], records["null"] = docs[lo:hi][row], start, tokens, null[lo:hi][row]
                ids = np.zeros(len(row) * length, dtype=f"<u{width}")  # a document's records follow each other
                ids[spans(offsets_of(pieces)[:-1] * length, count)] = flat
                records["ids"] = ids.reshape(-1, length)
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(kind.itemsize), len(records), [None, pa.py_buffer(records)])
                yield pa.RecordBatch.from_arrays([raw.cast(pa.binary())], names=["record"])
                lo = hi

    rows = encoded.select(F.col(doc).cast("long"), ids).mapInArrow(run, T.StructType([T.StructField("record", T.BinaryType())]))
    return rows.select(F.monotonically_increasing_id().alias("number"), "record")


def materialise(records: DataFrame, path: str, stride: int, slots: int = SHARD_SLOTS, key: int = KEY) -> None:
    """Write the records in training order below ``path``: ``shards`` and a one-row ``manifest``.

    The records are written once in input order, which fixes their numbers; a row count per
    writing task turns those into numbers without gaps. One shuffle brings each record to the
    task that owns its range of slots; nothing is sampled, since slots are even by design.
    """
    spark = records.sparkSession
    staged = scratch_path(spark, "llm", "sequences")
    records.write.option("compression", "zstd").parquet(staged)
    staged = spark.read.schema(records.schema).parquet(staged)
    task = F.shiftright("number", 33)
    counts = sorted(staged.groupBy(task.alias("task")).count().collect())  # a row per writing task
    starts = offsets_of(np.array([r["count"] for r in counts], dtype=np.int64))
    total = int(starts[-1])
    shards = -(-total // slots)
    writers = np.array([r["task"] for r in counts], dtype=np.int64)

    def place(batches):
        for batch in batches:
            number = batch.column(0).to_numpy()
            base = starts[np.searchsorted(writers, number >> 33)]
            slot = feistel(base + (number & ((1 << 33) - 1)), total, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot), batch.column(1)], names=["slot", "record"])

    def blobs(batches):
        held, first_slot = [], None
        for batch in batches:
            slot, column = batch.column(0).to_numpy(), batch.column(1)
            for lo, hi in _shard_runs(slot, slots):
                if first_slot is not None and slot[lo] // slots != first_slot // slots:
                    yield _blob(first_slot, held, slots, stride)
                    held, first_slot = [], None
                first_slot = int(slot[lo]) if first_slot is None else first_slot
                held += column.slice(lo, hi - lo).to_pylist()
        if held:
            yield _blob(first_slot, held, slots, stride)

    # As many owners as the session has shuffle partitions, and more where that would give an owner
    # over SHARDS_PER_TASK shards: a task's data stay bounded at any size of the corpus.
    tasks = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-shards // SHARDS_PER_TASK))
    placed = staged.mapInArrow(place, "slot long, record binary")
    owner = (F.floor(F.col("slot") / slots) * tasks / max(shards, 1)).cast("int")
    ordered = placed.repartitionById(tasks, owner).sortWithinPartitions("slot")
    written = ordered.mapInArrow(blobs, "shard long, first_slot long, slots long, data binary")
    written.write.option("compression", "zstd").parquet(f"{path}/shards")
    manifest = [(total, stride, slots, shards, key)]
    spark.createDataFrame(manifest, "records long, stride long, slots long, shards long, key long").coalesce(1).write.parquet(f"{path}/manifest")


def _shard_runs(slot: np.ndarray, slots: int):
    """(from, to) of the rows of each shard in ascending slots."""
    edges = np.flatnonzero(np.diff(slot // slots)) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), len(slot)], strict=True) if len(slot) else ()


def _blob(first_slot: int, held: list[bytes], slots: int, stride: int) -> pa.RecordBatch:
    data = b"".join(held)
    if len(data) != len(held) * stride or first_slot % slots:
        raise ValueError(f"shard at slot {first_slot} is incomplete")
    values = [[first_slot // slots], [first_slot], [len(held)]]
    return pa.RecordBatch.from_arrays([*(pa.array(v, pa.int64()) for v in values), pa.array([data], pa.binary())], names=["shard", "first_slot", "slots", "data"])


def read(spark: SparkSession, path: str, length: int = SEQUENCE_TOKENS, width: int = 2, from_slot: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, doc_id, start, n_tokens, ids) of all records from ``from_slot`` on.

    Shards before it are skipped by the readers (a filter on ``shard`` reaches the scan).
    """
    kind = record_type(length, width)
    manifest = spark.read.parquet(f"{path}/manifest").first()
    slots = manifest["slots"]

    def run(batches):
        for batch in batches:
            for shard, first, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                records = np.frombuffer(data.as_buffer(), dtype=kind)
                slot = first.as_py() + np.arange(len(records))
                keep = slot >= from_slot
                records, slot = records[keep], slot[keep]
                ids = [r[:n].tobytes() for r, n in zip(records["ids"], records["tokens"], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(slot),
                        pa.array(np.full(len(slot), shard.as_py())),
                        pa.array((slot % slots) * kind.itemsize),
                        pa.array(records["doc"].copy(), mask=records["null"] > 0),
                        pa.array(records["start"].copy()),
                        pa.array(records["tokens"].astype(np.int64)),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["slot", "shard", "byte_offset", "doc_id", "start", "n_tokens", "ids"],
                )

    shards = spark.read.parquet(f"{path}/shards").where(F.col("shard") >= from_slot // slots).select("shard", "first_slot", "data")
    return shards.mapInArrow(run, "slot long, shard long, byte_offset long, doc_id long, start long, n_tokens long, ids binary")


def training_order(docs: DataFrame, path: str, text: str = "text", doc: str = "doc_id", length: int = SEQUENCE_TOKENS) -> DataFrame:
    """Encode, cut and materialise ``docs`` below ``path``; the records read back in slot ranges."""
    materialise(cut(bpe.encode(docs, text, doc), doc, length=length), path, record_type(length, 2).itemsize)
    return read(docs.sparkSession, path, length)


def op6_training_order(spark, sf_dir: str) -> DataFrame:
    found = training_order(table(spark, sf_dir, "documents"), scratch_path(spark, "llm", "training_order"))
    return found.select("slot", "shard", "byte_offset", "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
