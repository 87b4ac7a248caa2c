"""Lookup tables used by the streaming jobs: VIP users and IP ranges.

The IP ranges are a static frame joined to the stream; a file table's listing is fixed when
the stream starts. The VIP users are opened anew for every micro-batch
(``start_upsert_stream(per_batch=...)``). No per-key queries are issued.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from learnmetrics.functions import columns as C
from learnmetrics.operators.geo import overlapping_ranges

IP_RANGE_SCHEMA = StructType(
    [StructField("lo", LongType()), StructField("hi", LongType()), StructField("region", StringType())]
)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A database table as a DataFrame (e.g. ``vip_user(id, uid)``); the JDBC driver jar
    must be on the classpath. Give a numeric ``partition_column`` with bounds to read it
    in parallel instead of through a single connection."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    return r.load()


def vip_user_ids(vip_user: DataFrame) -> DataFrame:
    """``uid`` of VIP users (bigint, non-null), ready for a left-anti join (which needs no
    de-duplication, so none is done: that would cost a shuffle per micro-batch)."""
    return vip_user.select(F.col("uid").try_cast("bigint").alias("uid")).where(F.col("uid").isNotNull())


def read_ip_ranges(spark: SparkSession, path: str, fmt: str = "csv", dotted: bool = False) -> DataFrame:
    """Load ``lo, hi, region`` ranges; with ``dotted=True`` lo/hi are IPv4 text."""
    if fmt == "csv":
        if dotted:
            raw = spark.read.schema("lo string, hi string, region string").option("header", "true").csv(path)
            return raw.select(C.ipv4_to_long("lo").alias("lo"), C.ipv4_to_long("hi").alias("hi"), "region")
        return spark.read.schema(IP_RANGE_SCHEMA).option("header", "true").csv(path)
    return spark.read.schema(IP_RANGE_SCHEMA).format(fmt).load(path)


def check_ip_ranges(ranges: DataFrame, sample: int = 5) -> None:
    """Raise if any two ranges overlap or a range is inverted (each address must map to
    at most one region for the range join to keep one row per event)."""
    inverted = ranges.where(F.col("lo") > F.col("hi")).limit(sample).collect()
    overlaps = overlapping_ranges(ranges).limit(sample).collect()
    if inverted or overlaps:
        raise ValueError(f"invalid IP ranges: inverted={inverted} overlapping={overlaps}")
