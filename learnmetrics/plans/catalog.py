"""Registered queries: one per operator family, each over whole benchmark tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame whose column names and
types match the SQL in :mod:`learnmetrics.plans.oracle` (money as double).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from learnmetrics.functions import sql as Q
from learnmetrics.operators import behaviour as B
from learnmetrics.operators import distinct_users as U
from learnmetrics.operators.geo import flatten_ranges, lookup_region
from learnmetrics.operators.reports import HEADCOUNT_DIMENSIONS, headcount, headcounts_all, top_payers
from learnmetrics.operators.wide import build_wide
from learnmetrics.operators.zipper import close_out, day_increment, lookup_as_of, money_rejects
from learnmetrics.plans import jobs as J
from learnmetrics.plans import views as V
from learnmetrics.session import scratch_path
from learnmetrics.sinks import catalog as KC
from learnmetrics.sinks import writers as W
from learnmetrics.sinks.writers import read_changelog
from learnmetrics.sources import ingest as I
from learnmetrics.sources import tables as T
from learnmetrics.sources import variant as VA
from learnmetrics.streaming import jobs as S
from learnmetrics.streaming import ledger as G
from learnmetrics.streaming import stateful as K

Query = Callable[[SparkSession, str], DataFrame]


def _double(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


# --- ingest ----------------------------------------------------------------------------

def ingest_member(spark, sf):
    return I.ingest_json(V.member_json(spark, sf), I.MEMBER, V.LOAD_DATE).rows


def ingest_member_rejects(spark, sf):
    rej = I.ingest_json(V.member_json(spark, sf), I.MEMBER, V.LOAD_DATE).rejects
    return rej.groupBy("reason", "time").agg(F.count(F.lit(1)).alias("n")).select("reason", "n", "time")


def ingest_regtype(spark, sf):
    return I.ingest_json(V.regtype_json(spark, sf), I.MEMBER_REGTYPE, V.LOAD_DATE).rows


def ingest_payment(spark, sf):
    return I.ingest_json(V.payment_json(spark, sf), I.PAYMONEY, V.LOAD_DATE).rows


def ingest_wxtype(spark, sf):
    return I.ingest_json(V.wxtype_json(spark, sf), I.WX_TYPE).rows


def ingest_vip_level(spark, sf):
    return I.ingest_json(V.vip_level_json(spark, sf), I.VIP_LEVEL).rows


def ingest_base_ad(spark, sf):
    return I.ingest_json(V.base_ad_json(spark, sf), I.BASE_AD).rows


def ingest_base_ad_rejects(spark, sf):
    rej = I.ingest_json(V.base_ad_json(spark, sf), I.BASE_AD).rejects
    return rej.select("value", "reason")


def ingest_base_website(spark, sf):
    return I.ingest_json(V.base_website_json(spark, sf), I.BASE_WEBSITE).rows


def ingest_wxbound(spark, sf):
    return I.ingest_json(V.wxbound_json(spark, sf), I.MEMBER_WXBOUND, V.LOAD_DATE).rows


def mask_members(spark, sf):
    """The masking and label functions on every member: name, both phone masks, password,
    registration-source label."""
    from learnmetrics.functions import columns as C

    c = V.table(spark, sf, "customer")
    raw = V.raw_phone(F.col("c_custkey"))
    return c.select(
        F.col("c_custkey").alias("uid"),
        C.mask_name("c_name").alias("fullname"),
        C.mask_phone(raw).alias("phone"),
        C.mask_phone(raw, C.PHONE_MASK_BEHAVIOUR).alias("phone_behaviour"),
        C.password_mask().alias("password"),
        C.regsource_name((F.col("c_custkey") % 6).cast("string")).alias("regsourcename"),
        F.col("c_mktsegment").alias("website"),
    )


# --- wide table and reports ---------------------------------------------------------------

def wide_table(spark: SparkSession, sf: str, fanout: str = "safe", columns=None, form: str = "sql") -> DataFrame:
    return build_wide(
        T.member_columns(V.member(spark, sf)),
        T.regtype_columns(V.regtype(spark, sf)),
        T.ad_columns(V.base_ad(spark, sf)),
        T.site_columns(V.base_website(spark, sf)),
        T.payment_columns(V.payment(spark, sf)),
        T.vip_columns(V.vip_level(spark, sf)),
        fanout=fanout,
        columns=columns,
        form=form,
    )


def wide_member(spark, sf):
    return _double(wide_table(spark, sf), "paymoney")


def wide_member_reference(spark, sf):
    return _double(wide_table(spark, sf, fanout="reference"), "paymoney")


def wide_member_api(spark, sf):
    return _double(wide_table(spark, sf, form="api"), "paymoney")


def _report_input(spark, sf):
    return T.wide_for_reports(wide_table(spark, sf, columns=T.REPORT_COLUMNS))


def _headcount_query(dim: str) -> Query:
    def q(spark, sf):
        # Only the sources the dimension comes from are joined.
        return headcount(wide_table(spark, sf, columns=["uid", dim, "website"]), dim)

    q.__name__ = f"headcount_{dim.replace('_', '')}"
    return q


def headcount_all(spark, sf):
    return headcounts_all(_report_input(spark, sf))


def top3_payers(spark, sf):
    return _double(top_payers(_report_input(spark, sf), n=3), "paymoney")


def bottom3_payers(spark, sf):
    return _double(top_payers(_report_input(spark, sf), n=3, ascending=True), "paymoney")


def top3_payers_legacy_money(spark, sf):
    """Top 3 with money read as decimal(10,4), as the reference reads it (totals of
    1,000,000 or more become null and sort last)."""
    wide = T.wide_for_reports(wide_table(spark, sf), money_type="decimal(10,4)")
    return _double(top_payers(wide, n=3), "paymoney")


# --- zipper ---------------------------------------------------------------------------------

def zipper_day_increment(spark, sf):
    return _double(day_increment(V.payment(spark, sf), V.vip_level(spark, sf)), "paymoney")


def zipper_close_out(spark, sf):
    inc = day_increment(V.payment(spark, sf), V.vip_level(spark, sf))
    return _double(close_out(inc), "paymoney")


def payment_money_rejects(spark, sf):
    return money_rejects(V.payment(spark, sf))


def _increments(spark, sf) -> DataFrame:
    """The increments of all days, stored once as the daily job stores them: one scan of the
    payments, whatever is then split off by day."""
    path = scratch_path(spark, "zipper", "increments")
    inc = day_increment(V.payment(spark, sf), V.vip_level(spark, sf))
    inc.write.parquet(path)
    return spark.read.schema(inc.schema).parquet(path)


def zipper_incremental(spark, sf, close: str = "all"):
    """History of the days up to the middle one; the middle day again and all later days
    merged in as one increment, so that many keys have rows on both sides."""
    inc = _increments(spark, sf)
    first, last = F.min("start_time").cast("date"), F.max("start_time").cast("date")
    middle = inc.agg(F.date_add(first, F.floor(F.datediff(last, first) / 2).cast("int")).cast("string")).first()[0]
    history = close_out(inc.where(F.col("start_time") <= F.lit(middle)))
    return _double(close_out(history, inc.where(F.col("start_time") >= F.lit(middle)), close=close), "paymoney")


def zipper_advance_open(spark, sf):
    """The incremental layout's step: history of every day but the latest, split into
    closed and open rows; only the open rows are advanced by the latest day."""
    from learnmetrics.functions.columns import OPEN_END
    from learnmetrics.operators.zipper import advance_open

    inc = _increments(spark, sf)
    latest = inc.agg(F.max("start_time")).first()[0]
    history = close_out(inc.where(F.col("start_time") < F.lit(latest)))
    open_rows = history.where(F.col("end_time") == OPEN_END)
    closed = history.where(F.col("end_time") != OPEN_END)
    advanced = advance_open(open_rows, inc.where(F.col("start_time") == F.lit(latest)))
    return _double(closed.unionByName(advanced), "paymoney")


def zipper_close_last(spark, sf):
    """As :func:`zipper_incremental` with the reference's close-out (second-newest row only)."""
    return zipper_incremental(spark, sf, close="last")


# --- behaviour -------------------------------------------------------------------------------

def _lines(spark, sf):
    return V.behaviour_lines(V.table(spark, sf, "events", spread=True))


def clean_events(spark, sf):
    return B.clean_lines(_lines(spark, sf))


def clean_events_rejects(spark, sf):
    rej = B.rejected_lines(_lines(spark, sf))
    return rej.groupBy("n_fields").agg(F.count(F.lit(1)).alias("n")).select("n_fields", "n")


def daily_video_users(spark, sf):
    return B.daily_video_users(V.behaviour(spark, sf))


def ip_region_join(spark, sf):
    ev = V.table(spark, sf, "events").select("event_id", "user_id", V.user_ip(F.col("user_id")).alias("ip_num"))
    return lookup_region(ev, "ip_num", V.ip_ranges(spark, sf)).select("event_id", "user_id", "ip_num", "region")


# --- streaming -----------------------------------------------------------------------------------

def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = V.table(spark, sf, "events").schema
    # The table's own path: one file, or a folder of any number of part files. Written as a
    # pattern (of one match), since a file source takes a plain path for a folder.
    return spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/events.parque[t]")


def _run_to_table(
    spark: SparkSession, name: str, agg: DataFrame, keys: list[str], values: list[str], per_batch=None, output_mode: str = "update"
) -> DataFrame:
    """Run a streaming aggregate over everything available, then read its current table."""
    base = scratch_path(spark, "streams", name)
    # One state partition per core: the state here is a few thousand keys.
    parts = spark.sparkContext.defaultParallelism
    q = S.start_upsert_stream(
        agg, f"{base}/sink", f"{base}/checkpoint", available_now=True, state_partitions=parts, per_batch=per_batch, output_mode=output_mode
    )
    q.awaitTermination()
    schema = StructType(list(agg.schema.fields) + [StructField("batch_id", LongType())])
    return read_changelog(spark, f"{base}/sink", keys, values, schema=schema)


def vip_increment_stream(spark, sf):
    lines = V.behaviour_lines(_events_stream(spark, sf))
    agg = S.vip_increments(lines, V.ip_ranges(spark, sf))
    return _run_to_table(spark, "vip_increment", agg, S.VIP_KEYS, ["cnt"])


def vip_increment_recent(spark, sf):
    totals = S.vip_increments(_lines(spark, sf), V.ip_ranges(spark, sf), with_last_event=True)
    # The reference time comes from the (small) aggregated totals; Spark reuses their
    # shuffle for the subquery instead of scanning the events again.
    ref = totals.select(F.max("last_event_time")).scalar()
    return S.recent_days(totals, ref, retention_days=2).drop("last_event_time")


UNPAID_WINDOW = ("24 hours", "12 hours")


def unpaid_visitors_stream(spark, sf):
    lines = V.behaviour_lines(_events_stream(spark, sf))
    agg = S.unpaid_visitors(lines, None, *UNPAID_WINDOW, watermark="1 day")
    return _run_to_table(
        spark, "unpaid_visitors", agg, S.UNPAID_KEYS, ["cnt"],
        per_batch=lambda df: S.without_vip(df, V.vip_users(df.sparkSession, sf)),
    )


def unpaid_visitors_batch(spark, sf):
    return S.unpaid_visitors(_lines(spark, sf), V.vip_users(spark, sf), *UNPAID_WINDOW, watermark=None)


def unpaid_users_batch(spark, sf):
    return S.unpaid_users(unpaid_visitors_batch(spark, sf))


def ip_region_nested(spark, sf):
    """Every event's narrowest range, of ranges that lie inside and across each other."""
    ev = V.table(spark, sf, "events").select("event_id", "user_id", V.user_ip(F.col("user_id")).alias("ip_num"))
    ranges = flatten_ranges(V.nested_ip_ranges(spark, sf))
    return lookup_region(ev, "ip_num", ranges).select("event_id", "user_id", "ip_num", "region")


# --- distinct users over spans of days --------------------------------------------------------------

def _daily(spark, name: str, daily: DataFrame) -> DataFrame:
    """A daily table, stored by day as the daily job does."""
    path = scratch_path(spark, "spans", name)
    daily.write.partitionBy("dt").parquet(path)
    return spark.read.schema(daily.schema).parquet(path)


def video_users_by_span(spark, sf):
    """Distinct users per week and per month, exact, merged from the stored days."""
    days = _daily(spark, "bitmaps", U.daily_bitmaps(V.behaviour(spark, sf)))
    spans = [U.exact_users(days, span).withColumn("span", F.lit(span)) for span in ("week", "month")]
    return spans[0].unionByName(spans[1]).select("span", "span_start", *U.METRIC_COLUMNS.values())


def video_users_sketched(spark, sf):
    """Estimates per week and per month against the exact figures: within four standard errors?"""
    behaviour = V.behaviour(spark, sf)
    sketches, bitmaps = _daily(spark, "sketches", U.daily_sketches(behaviour)), _daily(spark, "bitmaps", U.daily_bitmaps(behaviour))
    out = None
    for span in ("week", "month"):
        about = U.estimated_users(sketches, span).withColumnsRenamed({c: f"about_{c}" for c in U.METRIC_COLUMNS.values()})
        both = U.exact_users(bitmaps, span).join(about, "span_start")
        near = [
            (F.abs(F.col(f"about_{c}") - F.col(c)) <= F.greatest(F.lit(1.0), 4 * U.relative_error() * F.col(c))).alias(f"{m}_within")
            for m, c in U.METRIC_COLUMNS.items()
        ]
        rows = both.select(F.lit(span).alias("span"), "span_start", *U.METRIC_COLUMNS.values(), *near)
        out = rows if out is None else out.unionByName(rows)
    return out


# --- streams with state of their own ------------------------------------------------------------------

def _run_totals(spark, name: str, totals: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    base = scratch_path(spark, "streams", name)
    parts = spark.sparkContext.defaultParallelism
    q = K.start_vip_totals(totals, f"{base}/sink", f"{base}/checkpoint", initial, available_now=True, state_partitions=parts)
    q.awaitTermination()
    return K.read_vip_totals(spark, f"{base}/sink").select("dt", "province", "cnt")


def vip_totals_stream(spark, sf):
    """Totals per (day, region), each with a timer of its own: those of the last two days are left."""
    lines = V.behaviour_lines(_events_stream(spark, sf))
    return _run_totals(spark, "vip_totals", K.vip_totals(lines, V.ip_ranges(spark, sf), retention_days=2))


def vip_totals_seeded_stream(spark, sf):
    """Totals of the first half of the time, computed as a batch, seed the stream of the rest."""
    events = V.table(spark, sf, "events")
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = F.lit(span["a"] + (span["b"] - span["a"]) / 2 if span["a"] else None).cast(events.schema["ts"].dataType)
    ranges = V.ip_ranges(spark, sf)
    earlier = S.vip_increments(V.behaviour_lines(events.where(F.col("ts") < middle)), ranges, watermark=None, with_last_event=True)
    lines = V.behaviour_lines(_events_stream(spark, sf).where(F.col("ts") >= middle))
    return _run_totals(spark, "vip_seeded", K.vip_totals(lines, ranges, retention_days=36500, initial=earlier), earlier)


def unpaid_visitors_panes_stream(spark, sf):
    """Windows that the watermark has closed, added up from panes in a second stateful step."""
    lines = V.behaviour_lines(_events_stream(spark, sf))
    agg = S.unpaid_visitors_by_panes(lines, None, *UNPAID_WINDOW, watermark="0 seconds")
    return _run_to_table(
        spark, "unpaid_panes", agg, S.UNPAID_KEYS, ["cnt"], output_mode="append",
        per_batch=lambda df: S.without_vip(df, V.vip_users(df.sparkSession, sf)),
    )


def unpaid_visitors_panes_batch(spark, sf):
    return S.unpaid_visitors_by_panes(_lines(spark, sf), V.vip_users(spark, sf), *UNPAID_WINDOW, watermark=None)


def stream_offset_ledger(spark, sf):
    """A stream over the events, restarted once in between: what its ledger says of it. The events
    arrive as the table's rows of the first and of the second half of the time."""
    events = V.table(spark, sf, "events")
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = F.lit(span["a"] + (span["b"] - span["a"]) / 2 if span["a"] else None).cast(events.schema["ts"].dataType)
    base = scratch_path(spark, "streams", "ledger")
    ledger = G.OffsetLedger(spark, f"{base}/ledger", only={f"ledger-{base[-32:]}"}).attach()
    try:
        for part in (events.where(F.col("ts") < middle), events.where(~(F.col("ts") < middle) | F.col("ts").isNull())):
            part.write.mode("append").parquet(f"{base}/arrived")
            lines = V.behaviour_lines(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "4").parquet(f"{base}/arrived"))
            agg = S.vip_increments(lines, V.ip_ranges(spark, sf), watermark="3650 days")
            q = S.start_upsert_stream(
                agg, f"{base}/sink", f"{base}/checkpoint", available_now=True, query_name=f"ledger-{base[-32:]}",
                state_partitions=spark.sparkContext.defaultParallelism,
            )
            q.awaitTermination()
    finally:
        ledger.detach()
    told = G.read_ledger(spark, f"{base}/ledger")
    broken = G.gaps(told).groupBy("query_id").agg(F.count(F.lit(1)).alias("gaps"))
    total = G.totals(told).join(broken, "query_id", "left")
    return total.select("input_rows", "late_rows", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"))


# --- other ways to the same tables ---------------------------------------------------------------------

def ingest_member_variant(spark, sf):
    """The member loader from a VARIANT column that is parsed once and stored."""
    path = scratch_path(spark, "staged", "member")
    VA.write_staged(V.member_json(spark, sf), path)
    return VA.ingest_staged(VA.read_staged(spark, path), I.MEMBER, V.LOAD_DATE).rows


def ingest_base_ad_variant_rejects(spark, sf):
    path = scratch_path(spark, "staged", "base_ad")
    VA.write_staged(V.base_ad_json(spark, sf), path)
    return VA.ingest_staged(VA.read_staged(spark, path), I.BASE_AD).rejects.select("value", "reason")


def ingest_member_counts(spark, sf):
    """Rows and rejects per reason, as counted by the two writes of the member loader."""
    path = scratch_path(spark, "counted", "member")
    res, counts = I.counted(I.ingest_json(V.member_json(spark, sf), I.MEMBER, V.LOAD_DATE), I.MEMBER)
    res.rows.write.parquet(f"{path}/rows")
    res.rejects.write.parquet(f"{path}/rejects")
    found = [(k, n) for k, n in counts.result().items() if n]  # one per reason
    return spark.createDataFrame(found, "reason string, n long")


def mask_members_sql(spark, sf):
    """:func:`mask_members` as SQL text, with the library's SQL functions."""
    Q.register(spark)
    V.table(spark, sf, "customer").createOrReplaceTempView("lm_customer")
    return spark.sql("""
        SELECT c_custkey AS uid, lm_mask_name(c_name) AS fullname, lm_mask_phone(phone) AS phone,
               lm_mask_phone_with(phone, 'xxxx') AS phone_behaviour, lm_password_mask() AS password,
               lm_regsource_name(CAST(c_custkey % 6 AS STRING)) AS regsourcename, c_mktsegment AS website
        FROM (SELECT *, concat('138', lpad(CAST(c_custkey AS STRING), 8, '0')) AS phone FROM lm_customer)""")


def _bucketed(spark, name: str, df: DataFrame, run: str) -> DataFrame:
    """``df`` as a catalog table bucketed and sorted by the member key, filled by position."""
    table = f"lm_{run}_{name}"
    df = df.select(*[c for c in df.columns if c not in KC.MEMBER_KEY], *KC.MEMBER_KEY)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    KC.create_table(spark, table, df.schema, scratch_path(spark, "bucketed", name), bucket_by=KC.MEMBER_KEY, buckets=buckets)
    KC.insert_by_position(df, table)
    return spark.table(table)


def wide_member_bucketed(spark, sf):
    """The wide table over members, registrations and payments that lie bucketed by member: they are
    grouped and joined without an exchange."""
    run = uuid.uuid4().hex[:12]
    wide = build_wide(
        T.member_columns(_bucketed(spark, "member", V.member(spark, sf), run)),
        T.regtype_columns(_bucketed(spark, "regtype", V.regtype(spark, sf), run)),
        T.ad_columns(V.base_ad(spark, sf)),
        T.site_columns(V.base_website(spark, sf)),
        T.payment_columns(_bucketed(spark, "payment", V.payment(spark, sf), run)),
        T.vip_columns(V.vip_level(spark, sf)),
    )
    return _double(wide, "paymoney")


def zipper_close_out_bucketed(spark, sf):
    payment = _bucketed(spark, "payment", V.payment(spark, sf), uuid.uuid4().hex[:12])
    return _double(close_out(day_increment(payment, V.vip_level(spark, sf))), "paymoney")


def order_vip_level_as_of(spark, sf):
    """Every order with its member's VIP level some days before or after, from the zipper."""
    history = close_out(_increments(spark, sf))
    o, c = V.table(spark, sf, "orders"), V.table(spark, sf, "customer")
    facts = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        "o_orderkey", F.col("o_custkey").alias("uid"), F.col("c_mktsegment").alias("website"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 60 - 30).cast("int")).cast("string").alias("day"),
    )
    return lookup_as_of(facts, history, "day", ["vip_level", "start_time"], salts=4)


def payments_sized_files(spark, sf):
    """Payments written by level in files of a wanted size, read back: rows of each level, and whether
    none of its files is over twice that size."""
    path, target = scratch_path(spark, "sized", "payment"), 64 << 10
    KC.write_sized(V.payment(spark, sf).withColumn("level", F.coalesce("vip_id", F.lit(-1))), path, ["level"], target)
    back = spark.read.parquet(path).withColumn("size", F.col("_metadata.file_size"))
    return back.groupBy(F.col("level").cast("int").alias("level")).agg(
        F.count(F.lit(1)).alias("n"), (F.max("size") <= 2 * target).alias("sized")
    )


def job_ingest_rerun(spark, sf):
    """The payment loader over lines of text, run twice for a day, and the stored table read back."""
    root = scratch_path(spark, "jobs", "ingest")
    layout = J.Layout(f"{root}/warehouse")
    V.payment_json(spark, sf).write.text(f"{root}/raw/{J.RAW_FILES['bdl_pcentermempaymoney']}")
    for _ in range(2):
        J.ingest_table(spark, layout, f"{root}/raw", "bdl_pcentermempaymoney", V.LOAD_DATE)
    return J.read_bdl(spark, layout, "bdl_pcentermempaymoney").select(*I.PAYMONEY.columns)


def job_zipper_layers(spark, sf):
    """The incremental zipper over stored layers, loaded once a month: built from all loads, then the
    latest load run again (only its partition and the open intervals are read), and the published
    version read back."""
    layout = J.Layout(scratch_path(spark, "jobs", "zipper"))
    monthly = V.payment(spark, sf).withColumn("time", F.concat(F.substring("time", 1, 6), F.lit("01")))
    for table, df in (("bdl_pcentermempaymoney", monthly.repartition("time")), ("bdl_vip_level", V.vip_level(spark, sf))):
        spec = I.SPECS[table]
        typed = df.select(*[F.col(f.name).cast("int" if f.kind == "int" else "string").alias(f.name) for f in spec.fields])
        W.write_table(typed, layout.bdl(table), spec.partition_by)
    J.run_zipper_rebuild(spark, layout)
    latest = J.read_zipper_inc(spark, layout).agg(F.date_format(F.max("start_time"), "yyyyMMdd").alias("d")).first()["d"]
    if latest:
        J.run_zipper_daily(spark, layout, latest)
    return _double(J.read_zipper_inc(spark, layout), "paymoney")


def job_behaviour_days(spark, sf):
    """Behaviour lines loaded as text twice, cleaned, stored by day; then the daily job of the first and of
    the last day (each reads its own partition), and what they wrote read back."""
    root = scratch_path(spark, "jobs", "behaviour")
    layout = J.Layout(f"{root}/warehouse")
    # A line feed inside a name would end the line in a text file.
    lines = _lines(spark, sf).select(F.regexp_replace("value", "\n", "").alias("value"))
    lines.write.text(f"{root}/raw")
    for _ in range(2):
        J.run_load_behaviour(spark, layout, f"{root}/raw")
    stored = spark.read.schema(B.BEHAVIOUR_SCHEMA).parquet(layout.dwd("user_behavior"))
    days = stored.agg(F.min("dt").alias("a"), F.max("dt").alias("b")).first()
    for day in sorted({days["a"], days["b"]} - {None}):
        J.run_daily_video_users(spark, layout, day)
    out = "watch_video_count long, complete_video_count long, dt string"
    return spark.read.schema(out).parquet(layout.tmp("app_course_study_analysis"))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "ingest_member": ingest_member,
        "ingest_member_rejects": ingest_member_rejects,
        "ingest_regtype": ingest_regtype,
        "ingest_payment": ingest_payment,
        "ingest_wxtype": ingest_wxtype,
        "ingest_vip_level": ingest_vip_level,
        "ingest_base_ad": ingest_base_ad,
        "ingest_base_ad_rejects": ingest_base_ad_rejects,
        "ingest_base_website": ingest_base_website,
        "ingest_wxbound": ingest_wxbound,
        "mask_members": mask_members,
        "wide_member": wide_member,
        "wide_member_reference": wide_member_reference,
        "wide_member_api": wide_member_api,
    }
    for dim in HEADCOUNT_DIMENSIONS:
        f = _headcount_query(dim)
        q[f.__name__] = f
    q.update(
        {
            "headcount_all": headcount_all,
            "top3_payers": top3_payers,
            "bottom3_payers": bottom3_payers,
            "top3_payers_legacy_money": top3_payers_legacy_money,
            "payment_money_rejects": payment_money_rejects,
            "zipper_day_increment": zipper_day_increment,
            "zipper_close_out": zipper_close_out,
            "zipper_incremental": zipper_incremental,
            "zipper_close_last": zipper_close_last,
            "zipper_advance_open": zipper_advance_open,
            "clean_events": clean_events,
            "clean_events_rejects": clean_events_rejects,
            "daily_video_users": daily_video_users,
            "ip_region_join": ip_region_join,
            "vip_increment_stream": vip_increment_stream,
            "vip_increment_recent": vip_increment_recent,
            "unpaid_visitors_stream": unpaid_visitors_stream,
            "unpaid_visitors_batch": unpaid_visitors_batch,
            "unpaid_users_batch": unpaid_users_batch,
            "vip_totals_stream": vip_totals_stream,
            "vip_totals_seeded_stream": vip_totals_seeded_stream,
            "unpaid_visitors_panes_stream": unpaid_visitors_panes_stream,
            "unpaid_visitors_panes_batch": unpaid_visitors_panes_batch,
            "stream_offset_ledger": stream_offset_ledger,
            "video_users_by_span": video_users_by_span,
            "video_users_sketched": video_users_sketched,
            "ip_region_nested": ip_region_nested,
            "ingest_member_variant": ingest_member_variant,
            "ingest_base_ad_variant_rejects": ingest_base_ad_variant_rejects,
            "ingest_member_counts": ingest_member_counts,
            "mask_members_sql": mask_members_sql,
            "wide_member_bucketed": wide_member_bucketed,
            "zipper_close_out_bucketed": zipper_close_out_bucketed,
            "order_vip_level_as_of": order_vip_level_as_of,
            "payments_sized_files": payments_sized_files,
            "job_ingest_rerun": job_ingest_rerun,
            "job_zipper_layers": job_zipper_layers,
            "job_behaviour_days": job_behaviour_days,
        }
    )
    return q
