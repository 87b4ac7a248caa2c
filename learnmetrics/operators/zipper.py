"""Payment / VIP history as a zipper table (slowly changing dimension, type 2).

One row per (uid, website, start_time day): the day's money and highest VIP level, valid
from ``start_time`` to ``end_time`` (exclusive); the open row ends at '9999-12-31'.

A key holds at most one row per day (same-day rows are replaced, not added), so the
per-key window that closes intervals is bounded by the number of days in the history,
not by the data volume; the money itself is pre-aggregated map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from learnmetrics.functions import columns as C

KEY = ["uid", "website"]
ZIPPER_COLUMNS = ["uid", "paymoney", "vip_level", "start_time", "end_time", "website"]


def zipper_schema(uid_type=None) -> StructType:
    from pyspark.sql.types import LongType

    return StructType(
        [
            StructField("uid", uid_type or LongType()),
            StructField("paymoney", DecimalType(20, 4)),
            StructField("vip_level", StringType()),
            StructField("start_time", StringType()),
            StructField("end_time", StringType()),
            StructField("website", StringType()),
        ]
    )


def day_increment(payment: DataFrame, vip: DataFrame, day: str | None = None) -> DataFrame:
    """Per (uid, website, load day): summed money and the highest VIP level.

    ``payment``: uid, paymoney (text or number), vip_id, time (yyyyMMdd), website.
    ``vip``: vip_id, vip_level, website. Payments whose level is unknown are dropped
    (inner join). Money text that is no amount adds nothing; :func:`money_rejects` lists it. ``day`` restricts to one load date (partition pruning on ``time``);
    without it every day is computed at once, which is how a history is backfilled.
    """
    p = payment.select("uid", "paymoney", "vip_id", "time", "website")
    if day is not None:
        p = p.where(F.col("time") == day)
    keys = ["uid", "website", "time"]
    # The payments are reduced to one row per key and level first (a hash aggregate, partial
    # before the shuffle); only that meets the level table and takes the maximum of strings.
    per_level = p.groupBy(*keys, "vip_id").agg(F.sum(C.money("paymoney")).alias("paymoney"))
    levels = vip.groupBy("vip_id", "website").agg(F.max("vip_level").alias("vip_level"))
    agg = per_level.join(levels, ["vip_id", "website"], "inner").groupBy(*keys).agg(
        F.sum("paymoney").cast("decimal(20,4)").alias("paymoney"), F.max("vip_level").alias("vip_level")
    )
    return agg.select(
        "uid",
        "paymoney",
        "vip_level",
        C.yyyymmdd_to_iso("time").alias("start_time"),
        F.lit(C.OPEN_END).alias("end_time"),
        "website",
    )


def money_rejects(payment: DataFrame) -> DataFrame:
    """Payments whose money is there but can't be read as an amount."""
    return payment.select("uid", "paymoney", "vip_id", "time", "website").where(C.is_bad_money("paymoney"))


def close_out(
    history: DataFrame, increment: DataFrame | None = None, close: str = "all", days: list[str] | None = None
) -> DataFrame:
    """Merge a day increment into the history and recompute interval ends.

    Rows of the history that start on a day present in the increment are replaced, so a
    re-run of a day is idempotent and a late day slots in between its neighbours.
    ``close="all"`` sets every row's end to the next row's start (open row: 9999-12-31);
    ``close="last"`` only closes the second-newest row, trusting older rows as stored.
    ``days``, where the caller knows the increment's start days, saves finding them.
    """
    rows = history.select(*ZIPPER_COLUMNS)
    if increment is not None:
        inc = increment.select(*ZIPPER_COLUMNS)
        if days is not None:
            rows = rows.where(~F.col("start_time").isin(days) if days else F.lit(True))
        else:
            rows = rows.join(inc.select("start_time").distinct(), "start_time", "left_anti").select(*ZIPPER_COLUMNS)
        rows = rows.unionByName(inc)
    w = Window.partitionBy(*KEY).orderBy("start_time")
    nxt = F.lead("start_time").over(w)
    if close == "all":
        end = F.coalesce(nxt, F.lit(C.OPEN_END))
    elif close == "last":
        second_newest = nxt.isNotNull() & F.lead("start_time", 2).over(w).isNull()
        end = F.when(second_newest, nxt).otherwise(F.col("end_time"))
    else:
        raise ValueError("close must be 'all' or 'last'")
    return rows.withColumn("end_time", end).select(*ZIPPER_COLUMNS)


def lookup_as_of(facts: DataFrame, history: DataFrame, day: str, columns: list[str] | None = None, salts: int = 1) -> DataFrame:
    """``facts`` (uid, website, and a column ``day``, yyyy-MM-dd) with ``columns`` of the interval of
    ``history`` that holds on their day; null where none does, or a key or day is null.

    Facts and interval starts are united and sorted per key; the last start is carried forward.
    That is one shuffle and one sorted pass, where a join on ``start <= day < end`` would pair
    every fact of a key with all its intervals. ``salts`` > 1 spreads the facts of a key over so
    many groups, each with a copy of the key's intervals (one a day at most), for keys with a
    large share of all facts.
    """
    columns = columns or ["paymoney", "vip_level", "start_time"]
    key = [F.col(c).alias(f"_{c}") for c in KEY]
    kept = history.select(*key, F.col("start_time").alias("_at"), F.struct("end_time", *columns).alias("_v"), F.lit(None).cast(facts.schema.simpleString()).alias("_f"))
    kept = kept.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(salts)).cast("int")
    asked = facts.select(
        *key, F.col(day).cast("string").alias("_at"), F.lit(None).cast(kept.schema["_v"].dataType).alias("_v"), F.struct(*facts.columns).alias("_f"),
        spread.alias("_salt"),
    )
    # On one day the start comes first: an interval holds from its first day on.
    path = Window.partitionBy(*[f"_{c}" for c in KEY], "_salt").orderBy(F.col("_at").asc_nulls_first(), F.col("_f").isNotNull())
    last = F.last("_v", ignorenulls=True).over(path.rowsBetween(Window.unboundedPreceding, 0))
    found = kept.unionByName(asked).withColumn("_last", last).where(F.col("_f").isNotNull())
    there = F.col("_at").isNotNull() & (F.col("_at") < F.col("_last.end_time"))
    for c in KEY:
        there = there & F.col(f"_{c}").isNotNull()
    return found.select("_f.*", *[F.when(there, F.col(f"_last.{c}")).alias(f"valid_{c}") for c in columns])


def advance_open(open_rows: DataFrame, increment: DataFrame, reopened: DataFrame | None = None) -> DataFrame:
    """One day of the zipper on its open rows only.

    ``open_rows``: the open interval of every key (one row per key). ``increment``: the
    day's rows (all start on that day). ``reopened``: rows earlier closed on that day (a
    re-run), which become open again before the day is re-applied. Returns the new open
    rows and the rows closed by this day (``end_time`` = the day); closed intervals of
    earlier days are untouched, so the work is proportional to the keys, not the history.
    """
    base = open_rows.select(*ZIPPER_COLUMNS)
    if reopened is not None:
        base = base.unionByName(reopened.select(*ZIPPER_COLUMNS).withColumn("end_time", F.lit(C.OPEN_END)))
    # A re-run after a partial write can see a row both as open and as closed-then-reopened.
    base = base.dropDuplicates(["uid", "website", "start_time"])
    return close_out(base, increment)
