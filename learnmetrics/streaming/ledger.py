"""A ledger of what every micro-batch of a stream read.

A listener writes one entry per finished micro-batch: query, batch, each source's start and
end offset, rows read, and rows dropped as late. An entry is a small JSON file named by query
and batch, written through Hadoop's file system when Spark reports the batch's progress (no
Spark job runs in the listener); a batch that is run again after a failure replaces its entry.
:func:`read_ledger` gives the entries as a table, :func:`gaps` the places where a batch did not
begin where the one before ended, :func:`last_offsets` what a new stream would start from.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType

LEDGER_SCHEMA = StructType(
    [StructField("query_id", StringType()), StructField("run_id", StringType()), StructField("query_name", StringType()),
     StructField("batch_id", LongType()), StructField("finished_at", StringType()), StructField("source", LongType()),
     StructField("description", StringType()), StructField("start_offset", StringType()), StructField("end_offset", StringType()),
     StructField("rows", LongType()), StructField("late_rows", LongType())]
)


def _text(offset) -> str | None:
    """An offset as one line of JSON with sorted keys, whichever way Spark reports it."""
    if offset is None or offset == "null":
        return None
    try:
        value = json.loads(offset) if isinstance(offset, str) else offset
    except ValueError:
        return str(offset)
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def entries(progress: dict) -> list[dict]:
    """Ledger entries (one per source) of a progress report, none if it ran no micro-batch."""
    if "addBatch" not in progress.get("durationMs", {}):
        return []
    late = sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in progress.get("stateOperators", []))
    return [
        {
            "query_id": progress["id"], "run_id": progress["runId"], "query_name": progress.get("name"), "batch_id": int(progress["batchId"]),
            "finished_at": progress["timestamp"], "source": i, "description": s["description"], "start_offset": _text(s.get("startOffset")),
            "end_offset": _text(s.get("endOffset")), "rows": int(s["numInputRows"]), "late_rows": late if i == 0 else 0,
        }
        for i, s in enumerate(progress["sources"])
    ]


class OffsetLedger(StreamingQueryListener):
    """Writes the entries of every query of the session (or of those named) below ``path``.

    >>> ledger = OffsetLedger(spark, path).attach()      # before the stream starts
    >>> ledger.detach()                                  # after it ended; waits for its events
    """

    def __init__(self, spark: SparkSession, path: str, only: set[str] | None = None):
        self.spark, self.path, self.only = spark, path.rstrip("/"), only

    def attach(self) -> OffsetLedger:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = json.loads(event.progress.json)
        if self.only is None or progress.get("name") in self.only:
            self.write(entries(progress))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def write(self, rows: list[dict]) -> None:
        if not rows:
            return
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{rows[0]['query_id']}/{rows[0]['batch_id']:012d}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray("".join(json.dumps(r) + "\n" for r in rows).encode()))
        finally:
            out.close()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).json(f"{path.rstrip('/')}/*/*.json")


def gaps(ledger: DataFrame) -> DataFrame:
    """Entries that do not begin where their source's entry before them ended: another offset, or
    a batch number left out."""
    before = Window.partitionBy("query_id", "source").orderBy("batch_id")
    told = ledger.withColumns({"expected_offset": F.lag("end_offset").over(before), "batch_before": F.lag("batch_id").over(before)})
    first = F.col("batch_before").isNull()
    right = F.when(first, F.col("batch_id") == 0).otherwise(
        F.col("start_offset").eqNullSafe(F.col("expected_offset")) & (F.col("batch_id") == F.col("batch_before") + 1)
    )
    return told.where(~right).select("query_id", "source", "batch_id", "batch_before", "expected_offset", "start_offset")


def last_offsets(ledger: DataFrame) -> DataFrame:
    """The end offset each source has reached: for Kafka the JSON map that ``startingOffsets`` takes,
    for a stream that goes on elsewhere without this one's checkpoint."""
    last = F.max_by(F.struct("end_offset", "description"), "batch_id").alias("v")
    return ledger.groupBy("query_id", "source").agg(F.max("batch_id").alias("batch_id"), last).select(
        "query_id", "source", "batch_id", "v.description", "v.end_offset"
    )


def totals(ledger: DataFrame) -> DataFrame:
    """Batches, rows read and late rows of every query."""
    return ledger.groupBy("query_id").agg(
        F.count_distinct("batch_id").alias("batches"), F.sum("rows").alias("input_rows"), F.sum("late_rows").alias("late_rows")
    )
