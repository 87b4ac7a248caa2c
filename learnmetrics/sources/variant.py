"""One parse of raw JSON lines for many readers.

:func:`stage` turns lines into a VARIANT column next to the text, stored once
(:func:`write_staged`); every detail table then reads its fields from the stored variant
(:func:`ingest_staged`) instead of parsing the text again. Rows and rejects are those of
:func:`learnmetrics.sources.ingest.ingest_json`, for lines that hold one JSON object in
standard syntax without repeated keys (that parser also takes unquoted and single-quoted
keys, which a variant does not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnmetrics.session import spread_rows
from learnmetrics.sources.ingest import IngestResult, IngestSpec, ingest_parsed

STAGED_SCHEMA = "value string, v variant"


def stage(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``value`` and ``v`` of every line; ``v`` is null for text that isn't JSON."""
    return lines.select(F.col(value_col).alias("value"), F.try_parse_json(F.col(value_col)).alias("v"))


def write_staged(lines: DataFrame, path: str, value_col: str = "value") -> None:
    """Lines that lie in few tasks are spread first: every task writes a file, and the readers
    have as many tasks as there are files (a small file is one row group, which no reader splits)."""
    stage(spread_rows(lines), value_col).write.mode("overwrite").parquet(path)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STAGED_SCHEMA).parquet(path)


def fields_of(v: Column) -> Column:
    """``map<string,string>`` of an object's fields, null unless ``v`` is an object. Nested values
    are JSON text, others their value. One pass over the object, however many fields are read."""
    return F.try_variant_get(v, "$", "map<string,string>")


def ingest_staged(staged: DataFrame, spec: IngestSpec, load_date: str | None = None) -> IngestResult:
    """Rows and rejects of ``spec`` from staged lines, without parsing the text again."""
    parsed = staged.select(F.col("value").alias("_line"), fields_of(F.col("v")).alias("_m"))
    return ingest_parsed(parsed, spec, load_date)
