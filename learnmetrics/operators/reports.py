"""Report layer: member head-counts per dimension and top-N payers per level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# The six head-count dimensions, in the order the report layer writes them.
HEADCOUNT_DIMENSIONS = ["appregurl", "sitename", "regsourcename", "adname", "memberlevel", "vip_level"]

HEADCOUNTS_SCHEMA = StructType(
    [StructField("value", StringType()), StructField("num", LongType()), StructField("website", StringType()),
     StructField("dimension", StringType())]
)

# Column names in their order (fixed values).
TOP_PAYER_COLUMNS = [
    "uid", "memberlevel", "register", "appregurl", "regsourcename", "adname", "sitename",
    "vip_level", "paymoney", "rownum", "website",
]


def headcount(wide: DataFrame, dimension: str) -> DataFrame:
    """Members per (dimension value, website): ``dimension, num, website``.

    A null dimension value is its own group (not the text "null"), and values may contain
    any character: the key is the column pair, never a joined string.
    """
    return wide.groupBy(dimension, "website").agg(F.count("uid").alias("num")).select(dimension, "num", "website")


def headcounts_all(wide: DataFrame, dimensions: list[str] | None = None) -> DataFrame:
    """All head-counts in one scan and one shuffle: ``dimension, value, num, website``.

    Each row is unpivoted into one row per dimension with ``stack`` and the partial
    aggregate runs right after, in the same stage, so the shuffle carries only
    (dimension, value, website) partial counts.
    """
    dims = dimensions or HEADCOUNT_DIMENSIONS
    stack_args = ", ".join(f"'{d}', cast(`{d}` as string)" for d in dims)
    long = wide.select(
        F.expr(f"stack({len(dims)}, {stack_args}) as (dimension, value)"), "uid", "website"
    )
    return long.groupBy("dimension", "value", "website").agg(F.count("uid").alias("num")).select(
        "dimension", "value", "num", "website"
    )


def top_payers(
    wide: DataFrame,
    n: int = 3,
    ascending: bool = False,
    partition_by: tuple[str, ...] = ("website", "memberlevel"),
    order_col: str = "paymoney",
    tie_breaker: str = "uid",
    sort_output: bool = True,
) -> DataFrame:
    """Top ``n`` members by money per (website, memberlevel); ``ascending=True`` gives the bottom n.

    Descending puts members without money last, ascending puts them first. Ties on money
    are broken by ``uid`` so the result is deterministic. ``row_number() <= n`` lets
    Spark insert a map-side WindowGroupLimit, so each task ships at most n rows per
    group to the shuffle however large a group is.
    """
    order = F.col(order_col).asc_nulls_first() if ascending else F.col(order_col).desc_nulls_last()
    w = Window.partitionBy(*partition_by).orderBy(order, F.col(tie_breaker).asc())
    ranked = wide.withColumn("rownum", F.row_number().over(w)).where(F.col("rownum") <= n)
    out = ranked.select(*TOP_PAYER_COLUMNS)
    return out.orderBy("memberlevel", "rownum", "website") if sort_output else out
