"""Reference-shaped inputs derived from the benchmark tables (customer, orders, part,
nation, region, supplier, events).

The site's raw data is not available, so the driver queries build the member-analytics
tables from the TPC-H-like tables with column expressions only: every view is a
projection (plus, for payments, one join) of a whole table, so its size grows with the
input. :mod:`learnmetrics.plans.oracle` defines the same views in SQL for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnmetrics.functions import columns as C
from learnmetrics.session import ensure_parallelism

# The five TPC-H market segments, used as the site code ("website") of the
# dimension tables, which exist once per site.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
LOAD_DATE = "20190712"
LOAD_DAY = "2019-07-12"

# Event type of the benchmark's events table -> behaviour event key.
EVENT_KEYS = {
    "view": "startVideo",
    "click": "endVideo",
    "signup": "enterOrderPage",
    "purchase": "completeOrder",
    "error": "startApp",
}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A benchmark table; ``spread=True`` for inputs feeding heavy per-row string work
    (see :func:`learnmetrics.session.ensure_parallelism`)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if spread else df


def _per_site(df: DataFrame) -> DataFrame:
    # One copy per site: a generator over a fixed 5-element list, not a join.
    return df.withColumn("website", F.explode(F.array(*[F.lit(s) for s in SEGMENTS])))


def _str(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def raw_phone(custkey: Column) -> Column:
    return F.concat(F.lit("138"), F.lpad(_str(custkey), 8, "0"))


def ad_id(custkey: Column, balance: Column) -> Column:
    """Ad of a member: spread over the whole part key range (four parts for three
    customers); members with a negative balance name an ad that isn't there."""
    return F.when(balance < 0, -1 - custkey).otherwise(F.floor(custkey * 4 / 3))


# --- detail tables (post-ingest shape) -------------------------------------------

def member(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    null = F.lit(None).cast("string")
    return c.select(
        k.alias("uid"),
        ad_id(k, F.col("c_acctbal")).alias("ad_id"),
        null.alias("birthday"),
        F.concat(F.lit("u"), _str(k), F.lit("@mail.example")).alias("email"),
        C.mask_name("c_name").alias("fullname"),
        F.concat(F.lit("http://icon.example/"), _str(k)).alias("iconurl"),
        null.alias("lastlogin"),
        null.alias("mailaddr"),
        _str(k % 8 + 1).alias("memberlevel"),
        C.password_mask().alias("password"),
        null.alias("paymoney"),
        C.mask_phone(raw_phone(k)).alias("phone"),
        null.alias("qq"),
        _str(F.date_add(F.lit("2019-01-01").cast("date"), (k % 365).cast("int"))).alias("register"),
        null.alias("regupdatetime"),
        null.alias("unitname"),
        null.alias("userip"),
        null.alias("zipcode"),
        F.lit(LOAD_DATE).alias("time"),
        F.col("c_mktsegment").alias("website"),
    )


def regtype(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    null = F.lit(None).cast("string")
    regsource = _str(k % 6)
    balance = F.col("c_acctbal")
    return c.select(
        # Registrations without a member, and members without a registration.
        F.when(balance <= 9000, k).alias("uid"),
        null.alias("appkey"),
        F.concat(F.lit("http://reg_"), _str(k % 10)).alias("appregurl"),
        null.alias("bdp_uuid"),
        F.lit(LOAD_DAY).alias("createtime"),
        null.alias("domain"),
        null.alias("isranreg"),
        regsource.alias("regsource"),
        C.regsource_name(regsource).alias("regsourcename"),
        (F.col("c_nationkey") + F.when(balance > 8000, 100).otherwise(0)).alias("websiteid"),
        F.lit(LOAD_DATE).alias("time"),
        F.col("c_mktsegment").alias("website"),
    )


# The ad, site and VIP-level dimensions are whole tables; the data refers to ids outside
# them (negative ads, sites over 100, levels over 10), so the joins meet unmatched keys.


def base_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return _per_site(p.select(F.col("p_partkey").alias("adid"), F.col("p_name").alias("adname")))


def base_website(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return _per_site(
        n.select(
            F.col("n_nationkey").alias("siteid"),
            F.col("n_name").alias("sitename"),
            F.concat(F.lit("www."), F.lower("n_name"), F.lit(".com")).alias("siteurl"),
            F.lit(0).alias("delete"),
            F.lit(LOAD_DAY).alias("createtime"),
            F.lit("admin").alias("creator"),
        )
    )


def vip_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    v = F.col("r_regionkey") + 1
    return _per_site(
        r.select(
            v.alias("vip_id"),
            F.col("r_name").alias("vip_level"),
            F.concat(F.lit("2019-0"), _str(v), F.lit("-01")).alias("start_time"),
            F.concat(F.lit("2020-0"), _str(v), F.lit("-01")).alias("end_time"),
            F.concat(F.lit("2019-1"), _str(v), F.lit("-01")).alias("last_modify_time"),
            _str(v * 10).alias("max_free"),
            _str(v).alias("min_free"),
            F.concat(F.lit("L"), _str(v + 1)).alias("next_level"),
            F.concat(F.lit("op"), _str(v)).alias("operator"),
        )
    )


def payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", spread=True).select(
        "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    # Amounts over a million, and text that is no amount; levels outside the level table.
    price = F.col("o_totalprice").cast("decimal(12,2)")
    amount = F.when(price < 5000, F.lit("n/a")).when(price > 400000, _str(price * 10)).otherwise(_str(price))
    level = F.substring("o_orderpriority", 1, 1).try_cast("int")
    return j.select(
        F.col("o_custkey").alias("uid"),
        amount.alias("paymoney"),
        F.col("c_nationkey").alias("siteid"),
        F.when(F.col("o_orderstatus") == "P", level + 10).otherwise(level).alias("vip_id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("time"),
        F.col("c_mktsegment").alias("website"),
    )


def vip_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_mktsegment") == "AUTOMOBILE").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("uid")
    )


# --- IP ranges ----------------------------------------------------------------------

IP_SLOT = 171798691  # 2^32 / 25, one slot per nation


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One non-overlapping range per nation, edges off block boundaries, gaps between."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("bigint")
    lo = k * IP_SLOT + k * 7919
    hi = lo + 100000000 + k * 1000003
    return n.select(lo.alias("lo"), hi.alias("hi"), F.col("n_name").alias("region"))


def nested_ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations' ranges with narrower ones of the suppliers: inside a nation's, across its end,
    inside and across each other, in the gaps."""
    k = F.col("s_suppkey").cast("bigint")
    lo = F.pmod(k * 1640531527, F.lit(4294967296))
    hi = F.least(lo + 40000 + (k % 13) * (k % 13) * (k % 13) * 30000, F.lit(4294967295))
    s = table(spark, sf_dir, "supplier")
    return ip_ranges(spark, sf_dir).unionByName(s.select(lo.alias("lo"), hi.alias("hi"), F.col("s_name").alias("region")))


def user_ip(user_id: Column) -> Column:
    """A stable address per user, spread over the whole IPv4 space."""
    return F.pmod(user_id.cast("bigint") * F.lit(2654435761), F.lit(4294967296))


# --- behaviour lines ---------------------------------------------------------------

def behaviour_lines(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """events -> 17-field tab-separated lines (column ``value``).

    Works on a batch or a streaming ``events`` frame. Data-driven edge cases:
    ``error`` events lose their version field (16 fields, rejected); users whose id ends
    in 7 have a line feed in the user name; events with value under 1 have an empty phone
    and those under 2 a 5-character phone.
    """
    uid = F.col("user_id")
    epoch = C.epoch_seconds("ts")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    key = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(v)) for t, v in EVENT_KEYS.items()])
    username = F.when(uid % 10 == 7, F.concat(F.lit("user\n"), _str(uid))).otherwise(
        F.concat(F.lit("user"), _str(uid))
    )
    phone = (
        F.when(F.col("value") < 1, F.lit(""))
        .when(F.col("value") < 2, F.substring(raw_phone(uid), 1, 5))
        .otherwise(raw_phone(uid))
    )
    fields = [
        _str(uid),
        username,
        F.when(uid % 2 == 0, F.lit("F")).otherwise(F.lit("M")),
        _str(uid % 2 + 1),
        F.lit("0"),
        F.when(uid % 3 == 0, F.lit("ios")).otherwise(F.lit("android")),
        F.lit("toutiao"),
        F.lit("wifi"),
        C.long_to_ipv4(user_ip(uid)),
        phone,
        _str(k % 2),
        _str(k),
        _str(epoch),
        _str(epoch + F.floor("value").cast("bigint")),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.lit("1.0")),
        key,
        _str(epoch),
    ]
    # concat_ws skips the null version of error events, leaving 16 fields.
    return events.select(*(keep or []), F.concat_ws("\t", *fields).alias("value"))


def behaviour(spark: SparkSession, sf_dir: str, tz_offset_hours: int = 8) -> DataFrame:
    from learnmetrics.operators.behaviour import parse_lines

    return parse_lines(behaviour_lines(table(spark, sf_dir, "events", spread=True)), tz_offset_hours=tz_offset_hours)


# --- raw JSON lines (ingest inputs) ---------------------------------------------------

def _json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row; null fields are left out, as a missing key."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def member_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member.log lines from customer. Negative balances are truncated (not JSON);
    nation 24 has a non-numeric ad_id, 23 a quoted numeric one, 22 none; nation 21 has a
    5-character phone; nation 20 no name."""
    c = table(spark, sf_dir, "customer")
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    ad = F.floor(k * 4 / 3).cast("string")
    rows = c.select(
        k.alias("uid"),
        F.when(n == 24, F.concat(F.lit("x"), ad)).when(n == 23, ad).when(n == 22, F.lit(None)).otherwise(
            ad
        ).alias("ad_id"),
        F.concat(F.lit("u"), _str(k), F.lit("@mail.example")).alias("email"),
        F.when(n == 20, F.lit(None)).otherwise(F.col("c_name")).alias("fullname"),
        _str(k % 8 + 1).alias("memberlevel"),
        F.lit("secret").alias("password"),
        F.when(n == 21, F.substring(raw_phone(k), 1, 5)).otherwise(raw_phone(k)).alias("phone"),
        F.col("c_mktsegment").alias("dn"),
        (F.col("c_acctbal") < 0).alias("_broken"),
    )
    payload = rows.drop("_broken")
    js = F.to_json(F.struct(*[F.col(c) for c in payload.columns]))
    line = F.when(F.col("_broken"), F.expr("substring(_js, 1, length(_js) - 1)")).otherwise(F.col("_js"))
    return rows.withColumn("_js", js).select(line.alias("value"))


def regtype_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """memberRegtype.log lines from customer; regsource is 0..5, missing for nation 0."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return _json_lines(
        c.select(
            k.alias("uid"),
            F.concat(F.lit("http://reg_"), _str(k % 10)).alias("appregurl"),
            F.lit(LOAD_DAY).alias("createtime"),
            F.concat(F.lit("www.site"), _str(F.col("c_nationkey")), F.lit(".com")).alias("webA"),
            F.when(F.col("c_nationkey") == 0, F.lit(None)).otherwise(_str(k % 6)).alias("regsource"),
            F.col("c_nationkey").alias("websiteid"),
            F.col("c_mktsegment").alias("dn"),
        )
    )


def payment_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pcentermempaymoney.log lines from orders (site code from the order status)."""
    o = table(spark, sf_dir, "orders", spread=True)
    return _json_lines(
        o.select(
            F.col("o_custkey").alias("uid"),
            _str(F.col("o_totalprice").cast("decimal(12,2)")).alias("paymoney"),
            F.substring("o_orderpriority", 1, 1).alias("vip_id"),
            (F.col("o_orderkey") % 25).alias("siteid"),
            F.col("o_orderstatus").alias("dn"),
        )
    )


def wxtype_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WxType.log lines from supplier."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return _json_lines(
        s.select(
            F.concat(F.lit("wx"), _str(k)).alias("app_id"),
            (k % 3).alias("bind_source"),
            F.lit(LOAD_DAY).alias("createtime"),
            F.lit("admin").alias("creator"),
            _str(F.col("s_nationkey") % 5).alias("dn"),
            F.concat(F.lit("t"), _str(k)).alias("token_secret"),
            F.col("s_name").alias("wx_name"),
            _str(F.col("s_nationkey")).alias("wx_no"),
        )
    )


def vip_level_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PcenterMemViplevel.log lines from region (one per site); ``discountval`` is read and dropped."""
    r = table(spark, sf_dir, "region")
    v = F.col("r_regionkey") + 1
    return _json_lines(
        _per_site(
            r.select(
                _str(v).alias("vip_id"),
                F.col("r_name").alias("vip_level"),
                F.concat(F.lit("2019-0"), _str(v), F.lit("-01")).alias("start_time"),
                F.concat(F.lit("2020-0"), _str(v), F.lit("-01")).alias("end_time"),
                F.lit("0.9").alias("discountval"),
                F.concat(F.lit("L"), _str(v + 1)).alias("next_level"),
            )
        ).withColumnRenamed("website", "dn")
    )


def base_ad_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """baseadlog.log lines from part; parts with size over 45 carry a non-numeric id."""
    p = table(spark, sf_dir, "part")
    adid = F.when(F.col("p_size") > 45, F.concat(F.lit("ad"), _str("p_partkey"))).otherwise(_str("p_partkey"))
    return _json_lines(p.select(adid.alias("adid"), F.col("p_name").alias("adname"), F.col("p_brand").alias("dn")))


def base_website_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """baswewebsite.log lines from nation; nation 0 has no ``delete`` key."""
    n = table(spark, sf_dir, "nation")
    return _json_lines(
        n.select(
            F.col("n_nationkey").alias("siteid"),
            F.col("n_name").alias("sitename"),
            F.concat(F.lit("www."), F.lower("n_name"), F.lit(".com")).alias("siteurl"),
            F.when(F.col("n_nationkey") != 0, F.col("n_regionkey") % 2).alias("delete"),
            F.lit(LOAD_DAY).alias("createtime"),
            F.lit("admin").alias("creator"),
            _str(F.col("n_regionkey")).alias("dn"),
        )
    )


def wxbound_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """memberwxbound.log lines from customer."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return _json_lines(
        c.select(
            k.alias("uid"),
            F.concat(F.lit("un"), _str(k)).alias("unionid"),
            F.concat(F.lit("op"), _str(k)).alias("openid"),
            F.col("c_name").alias("nickname"),
            _str(k % 2).alias("isdefault"),
            _str(k % 3).alias("bindsource"),
            F.col("c_mktsegment").alias("dn"),
        )
    )
