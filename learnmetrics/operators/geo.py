"""IP -> region lookup as a bucketed range join.

A plain ``ip BETWEEN lo AND hi`` join has no equality key, so Spark can only plan it as a
nested-loop join. Instead every range is listed once per /16 block (``bucket``) it
touches, and the join condition is ``bucket equal AND ip BETWEEN lo AND hi``: a hash or
sort-merge equi-join with a residual. For non-overlapping ranges the exploded table has
at most ``#ranges + #blocks`` rows (each block adds at most one partial range at each
edge), so its size is bounded by the range table plus 65,536 and does not grow with the
event data. Hot blocks on the event side are split by AQE's skew-join handling.

The range condition sits inside the join condition, not in a later filter, so an event
whose block is only partly covered still keeps its row (with the default region).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learnmetrics.functions import columns as C

BUCKET_BITS = 16


def explode_ranges(ranges: DataFrame, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """``lo, hi, region`` -> one row per (range, block) with column ``_bucket``."""
    return ranges.select(
        F.explode(F.sequence(F.shiftright("lo", bucket_bits), F.shiftright("hi", bucket_bits))).alias("_bucket"),
        F.col("lo").alias("_lo"),
        F.col("hi").alias("_hi"),
        F.col("region").alias("_region"),
    )


def lookup_region(
    df: DataFrame,
    ip_col: str,
    ranges: DataFrame,
    region_col: str = "region",
    default: str | None = C.UNKNOWN_REGION,
    bucket_bits: int = BUCKET_BITS,
    broadcast: bool = False,
) -> DataFrame:
    """Left range join of ``df.ip_col`` (integer address) onto ``ranges(lo, hi, region)``.

    Every row of ``df`` is kept; an address in no range (or null) gets ``default``.
    Works for batch and for a stream joined with a static range table. ``broadcast=True``
    hints the exploded ranges for broadcast; use it only when their size was checked
    (see :func:`size_checked_ranges`). Otherwise Spark decides from statistics and AQE.
    """
    r = explode_ranges(ranges, bucket_bits)
    if broadcast:
        r = F.broadcast(r)
    ip = F.col(ip_col)
    left = df.withColumn("_ip_bucket", F.shiftright(ip, bucket_bits))
    cond = (left["_ip_bucket"] == r["_bucket"]) & ip.between(r["_lo"], r["_hi"])
    joined = left.join(r, cond, "left")
    region = F.col("_region") if default is None else F.coalesce(F.col("_region"), F.lit(default))
    return joined.withColumn(region_col, region).drop("_ip_bucket", "_bucket", "_lo", "_hi", "_region")


def _tree_nodes(ranges: DataFrame, bits: int) -> DataFrame:
    """The aligned blocks (``level``: 2^level addresses, ``prefix``: their number) that make up each
    range, at most two of a level: a segment tree over the addresses, without building one."""
    levels = ranges.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(bits))))
    size = F.expr("shiftleft(1L, level)")
    levels = levels.withColumns({"a": F.expr("shiftright(lo + shiftleft(1L, level) - 1, level)"), "e": F.floor((F.col("hi") + 1) / size)})
    left = F.when((F.col("a") % 2 == 1) & (F.col("a") < F.col("e")), F.col("a"))
    right = F.when((F.col("e") % 2 == 1) & (F.col("a") + F.col("a") % 2 < F.col("e")), F.col("e") - 1)
    prefixes = levels.withColumn("prefix", F.explode(F.array(left, right)))
    return prefixes.where(F.col("prefix").isNotNull()).select("level", "prefix", "lo", "hi", "region")


def flatten_ranges(ranges: DataFrame, bucket_bits: int = BUCKET_BITS, address_bits: int = 32) -> DataFrame:
    """Nested and overlapping ``lo, hi, region`` -> disjoint pieces of the same columns.

    An address belongs to the narrowest range that holds it (of equally wide ones the one that
    starts first, then the region that sorts first), as a city's range inside its country's.
    Inverted ranges and ranges with a null end hold nothing.

    Every end of a range, and every block's start, begins a piece; no range begins or ends
    inside one, so its first address decides. Ranges are broken into aligned blocks of powers of
    two, and the best range of each such block is kept; a piece looks up the ``address_bits`` + 1
    blocks its first address lies in. That is an equi-join of (2 * ranges + blocks) * 33 rows
    at most, however deep the ranges are nested. Pieces are found block by block (a bounded
    number of addresses), never in one global sort.
    """
    r = ranges.where("lo <= hi").select(F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"), "region")
    best = F.min(F.struct((F.col("hi") - F.col("lo")).alias("width"), F.col("lo").alias("from"), "region")).alias("best")
    nodes = _tree_nodes(r, address_bits).groupBy("level", "prefix").agg(best)

    spark = ranges.sparkSession
    blocks = spark.range(1 << (address_bits - bucket_bits)).select(F.expr(f"shiftleft(id, {bucket_bits})").alias("lo"))
    starts = r.select("lo").unionByName(r.select((F.col("hi") + 1).alias("lo"))).unionByName(blocks)
    starts = starts.where(F.col("lo") < F.lit(1 << address_bits)).distinct().withColumn("block", F.shiftright("lo", bucket_bits))
    in_block = Window.partitionBy("block").orderBy("lo")
    end = F.coalesce(F.lead("lo").over(in_block) - 1, F.expr(f"shiftleft(block + 1, {bucket_bits}) - 1"))
    pieces = starts.withColumn("hi", end)

    asked = pieces.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(address_bits))))
    asked = asked.withColumn("prefix", F.expr("shiftright(lo, level)"))
    owned = asked.join(nodes, ["level", "prefix"]).groupBy("block", "lo", "hi").agg(F.min("best").alias("best"))
    # Neighbours of one owner are one piece again.
    same = F.lag("best").over(in_block).eqNullSafe(F.col("best")) & (F.lag("hi").over(in_block) + 1).eqNullSafe(F.col("lo"))
    runs = owned.withColumn("new", (~same).cast("int")).withColumn("run", F.sum("new").over(in_block))
    merged = runs.groupBy("block", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("best").alias("best"))
    return merged.select("lo", "hi", F.col("best.region").alias("region"))


def size_checked_ranges(ranges: DataFrame, bucket_bits: int = BUCKET_BITS) -> tuple[DataFrame, bool]:
    """Count the ranges once and say whether their exploded form may be broadcast: with
    non-overlapping ranges it has at most ``#ranges + 2**(32 - bucket_bits)`` rows."""
    from learnmetrics.session import broadcast_if_small

    _, ok = broadcast_if_small(ranges, extra_rows=2 ** (32 - bucket_bits))
    return ranges, ok


def overlapping_ranges(ranges: DataFrame, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """Pairs of ranges that overlap (empty for a valid table).

    Checked per block, so the work is spread over blocks rather than one global sort:
    two ranges that share an address share that address's block, and within a block an
    overlap shows up between neighbours ordered by ``lo``.
    """
    r = explode_ranges(ranges, bucket_bits)
    w = Window.partitionBy("_bucket").orderBy("_lo", "_hi")
    with_prev = r.select(
        "_lo", "_hi", "_region",
        F.lag("_lo").over(w).alias("prev_lo"),
        F.lag("_hi").over(w).alias("prev_hi"),
        F.lag("_region").over(w).alias("prev_region"),
    )
    return (
        with_prev.where(F.col("prev_hi") >= F.col("_lo"))
        .select(
            F.col("prev_lo").alias("lo_a"), F.col("prev_hi").alias("hi_a"), F.col("prev_region").alias("region_a"),
            F.col("_lo").alias("lo_b"), F.col("_hi").alias("hi_b"), F.col("_region").alias("region_b"),
        )
        .distinct()
    )
