"""Helpers shared by the operators: table access, shared storage, Arrow text batches."""

from __future__ import annotations

import ctypes
import time
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.session import checkpoint_root, scratch_path

#: Bytes of text handled at once inside a task (one row may be larger).
TEXT_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage: what was written survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_stored(spark: SparkSession, hours: float = 24) -> list[str]:
    """Remove tables of :func:`stored` whose folder is older than ``hours``; returns what went.

    A query's tables must outlive its function, since its result is read from them; so a
    periodic job (or the end of a session, with ``hours=0``) clears what no run needs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/llm")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    before = (time.time() - hours * 3600) * 1000
    old = [run for label in fs.listStatus(path) for run in fs.listStatus(label.getPath()) if run.getModificationTime() <= before]
    for run in old:
        fs.delete(run.getPath(), True)
    return [run.getPath().toString() for run in old]


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """``names``, each changed until it differs from all of ``taken`` (case does not count)."""
    used, out = {x.lower() for x in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def is_training_row(doc: str = "doc_id"):
    """The learning fold: crc32 of the id as text, modulo 4, is not 2 (null ids: held out)."""
    return F.coalesce(F.crc32(F.encode(F.col(doc).cast("string"), "UTF-8")) % 4 != 2, F.lit(False))


def with_columns_schema(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    """Schema of ``df`` followed by ``fields``."""
    return T.StructType(list(df.schema.fields) + fields)


def release() -> None:
    """Give memory that was freed back to the system: the worker process stays for other tasks, and
    what it keeps counts with its executor's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = TEXT_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of every batch holding about ``limit`` bytes of text, with the text column
    (nulls as empty text)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = pc.fill_null(batch.column(batch.schema.get_field_index(column)), "")
        block = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // limit
        cuts = np.flatnonzero(np.diff(block)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(lo, hi - lo), texts.slice(lo, hi - lo)
    release()


def split_encoded(texts: pa.Array, separator: str = " ") -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Pieces of every text between ``separator``: code of each piece, the distinct pieces,
    and the offset of every text's first piece."""
    parts = pc.split_pattern(texts, separator)
    flat = parts.flatten().dictionary_encode()
    offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False)))).astype(np.int64)
    return flat.indices.to_numpy(zero_copy_only=False), flat.dictionary, offsets


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every span, one span after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Slices ``data[offsets[i]:offsets[i+1]]`` as binary values (little-endian items)."""
    step = data.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer((offsets * step).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    ).cast(pa.binary())


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an unsigned array."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
