"""One wide row per member (uid, website) from six detail tables.

Inputs are the renamed projections from :mod:`learnmetrics.sources.tables`.

Aggregation rules per (uid, website): money is summed, ``vip_level``, ``vip_end_time``,
``vip_last_modify_time`` and ``vip_next_level`` take the maximum, ``vip_start_time`` the
minimum. Every other column is a "first" value, made deterministic:

* member columns come from the member row with the latest load date ``time``;
* registration (and the site it points to) from the registration row that is least by
  ``(reg_createtime, appregurl, ...)``;
* ``vip_id``, ``vip_max_free``, ``vip_min_free``, ``vip_operator`` from the matched VIP level
  with the smallest ``vip_id`` (unmatched payments last).

That is the SQL form. The API form (``form="api"``) joins on shared column names, so ``siteid``
is the registration's and ``vip_id`` the payment's also where no site or level has it, and
``vip_next_level`` is a "first" value of the same row as ``vip_id``; members without payments
have money 0.

``fanout="safe"`` (default) reduces each source to one row per key *before* joining, so
several registration rows cannot multiply payments, and every aggregate is a partial
(map-side) aggregate, which keeps a very hot uid from landing whole in one task. The three
uid-keyed inputs are joined on the same keys, so their shuffles are shared. The payment
aggregate, over the largest input, sums money per level as a hash aggregate; the level table
joins what is left of it. ``fanout="reference"`` joins first and aggregates after, which reproduces the inflated money of a
member with several registration rows; both modes agree when registrations are unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnmetrics.session import merge_if_large

KEY = ["uid", "website"]

MEMBER_FIRST = [
    "ad_id", "fullname", "iconurl", "lastlogin", "mailaddr", "memberlevel", "password", "phone",
    "qq", "register", "regupdatetime", "unitname", "userip", "zipcode", "time",
]
REG_FIRST = [
    "reg_createtime", "appregurl", "appkey", "bdp_uuid", "domain", "isranreg", "regsource",
    "regsourcename", "reg_siteid",
]
SITE_FIRST = ["siteid", "sitename", "siteurl", "site_delete", "site_createtime", "site_creator"]
VIP_FIRST = ["vip_id", "vip_max_free", "vip_min_free", "vip_operator"]
VIP_MAX = ["vip_level", "vip_end_time", "vip_last_modify_time", "vip_next_level"]
VIP_MIN = ["vip_start_time"]

# Column names of the wide table in their order (fixed values).
WIDE_COLUMNS = [
    "uid", "ad_id", "fullname", "iconurl", "lastlogin", "mailaddr", "memberlevel", "password",
    "paymoney", "phone", "qq", "register", "regupdatetime", "unitname", "userip", "zipcode", "time",
    "appkey", "appregurl", "bdp_uuid", "reg_createtime", "domain", "isranreg", "regsource",
    "regsourcename", "adname", "siteid", "sitename", "siteurl", "site_delete", "site_createtime",
    "site_creator", "vip_id", "vip_level", "vip_start_time", "vip_end_time", "vip_last_modify_time",
    "vip_max_free", "vip_min_free", "vip_next_level", "vip_operator", "website",
]


def _pick(agg_fn, order_cols: list[str], cols: list[str], alias: str):
    """max/min of a struct whose leading fields are the order: a deterministic 'first'."""
    fields = [F.col(c) for c in order_cols] + [F.col(c) for c in cols if c not in order_cols]
    return agg_fn(F.struct(*fields)).alias(alias)


def _firsts(form: str) -> list[str]:
    """The level columns that come from one row, in the order that chooses it."""
    return VIP_FIRST if form == "sql" else [VIP_FIRST[0], "vip_next_level", *VIP_FIRST[1:]]


def _vip_aggs(form: str):
    first = F.min(F.struct("_unmatched", *_firsts(form))).alias("_vip")
    most = [F.max(c).alias(c) for c in VIP_MAX if c not in _firsts(form)]
    return [*most, *[F.min(c).alias(c) for c in VIP_MIN], first]


def _level_columns(form: str) -> list:
    """Columns of a payment (p) joined to its level (v)."""
    level_id = F.col("v.vip_id_dim") if form == "sql" else F.col("p.vip_id")
    return [
        "p.uid", "p.website", "p.paymoney", level_id.alias("vip_id"), F.col("v.vip_id_dim").isNull().alias("_unmatched"),
        *[F.col(f"v.{c}") for c in VIP_MAX + VIP_MIN + VIP_FIRST[1:]],
    ]


def _unpack(df: DataFrame, struct_col: str, cols: list[str]) -> DataFrame:
    return df.select("*", *[F.col(f"{struct_col}.{c}").alias(c) for c in cols]).drop(struct_col)


PAY_COLUMNS = {"paymoney", *VIP_FIRST, *VIP_MAX, *VIP_MIN}
REG_COLUMNS = {"appkey", "appregurl", "bdp_uuid", "reg_createtime", "domain", "isranreg", "regsource", "regsourcename"}


def build_wide(
    member: DataFrame,
    regtype: DataFrame,
    ad: DataFrame,
    site: DataFrame,
    payment: DataFrame,
    vip: DataFrame,
    fanout: str = "safe",
    money_default: float | int | None = None,
    columns: list[str] | None = None,
    form: str = "sql",
) -> DataFrame:
    """Wide member table with :data:`WIDE_COLUMNS` (or the subset ``columns``); ``paymoney``
    is decimal.

    With ``columns`` the safe build joins only the sources those columns come from: every
    source is reduced to one row per member first, so dropping an unused left join leaves
    the rows unchanged. (Catalyst cannot do this itself: it does not know the joined side
    is unique per key.)
    """
    if form not in ("sql", "api"):
        raise ValueError("form must be 'sql' or 'api'")
    if form == "api" and money_default is None:
        money_default = 0
    cols = list(columns or WIDE_COLUMNS)
    need = set(cols)
    if fanout == "reference" or money_default is not None:
        need |= set(WIDE_COLUMNS)
    regtype = regtype.withColumnRenamed("siteid", "reg_siteid")
    vip = vip.withColumnRenamed("vip_id", "vip_id_dim")
    # The dimension joins are left to the optimizer: what turns out small at run time is
    # broadcast, skewed keys of a large one are split. Ads can be as many as members: above a
    # counted limit they are merged, whatever the size of their files.
    ad = ad if "adname" in need else None
    site = site if need & set(SITE_FIRST) else None
    vip = vip if need & PAY_COLUMNS else None
    use_reg = site is not None or bool(need & REG_COLUMNS)
    if fanout == "safe":
        wide = _build_safe(member, regtype if use_reg else None, ad, site, payment if vip is not None else None, vip, form)
    elif fanout == "reference":
        wide = _build_reference(member, regtype, ad, site, payment, vip, form)
    else:
        raise ValueError("fanout must be 'safe' or 'reference'")
    if form == "api" and "reg_siteid" in wide.columns:
        wide = wide.withColumn("siteid", F.col("reg_siteid"))
    if money_default is not None:
        wide = wide.withColumn("paymoney", F.coalesce("paymoney", F.lit(money_default).cast("decimal(20,4)")))
    return wide.select(*cols)


def _payments_with_vip(payment: DataFrame, vip: DataFrame, form: str) -> DataFrame:
    # The VIP dimension is joined on the payment side's keys; in the SQL form its own vip_id is
    # kept, so it is null when a payment names an unknown level.
    p, v = payment.alias("p"), vip.alias("v")
    return p.join(
        v, (F.col("p.vip_id") == F.col("v.vip_id_dim")) & (F.col("p.website") == F.col("v.website")), "left"
    ).select(*_level_columns(form))


def _join_dims(df: DataFrame, ad: DataFrame | None, site: DataFrame | None) -> DataFrame:
    if ad is not None:
        df = df.join(merge_if_large(ad), ["ad_id", "website"], "left")
    if site is None:
        return df
    s = site.withColumnRenamed("website", "site_website")
    return df.join(
        s, (df["reg_siteid"] == s["siteid"]) & (df["website"] == s["site_website"]), "left"
    ).drop("site_website")


def _pay_one(payment: DataFrame, vip: DataFrame, form: str = "sql") -> DataFrame:
    """Per (uid, website): money and VIP attributes.

    The payments, the largest input, are reduced to one row per key and level by a hash
    aggregate, partial before its shuffle. Only those rows meet the level table, itself
    reduced to one row per level so that it can't multiply money, and take the maxima of
    strings. Null levels match nothing. The same plan serves a level table of any size; a
    small one is broadcast at run time.
    """
    per_level = payment.groupBy(*KEY, "vip_id").agg(F.sum("paymoney").alias("paymoney")).alias("p")
    level = vip.groupBy("vip_id_dim", "website").agg(
        *[F.max(c).alias(c) for c in VIP_MAX],
        *[F.min(c).alias(c) for c in VIP_MIN],
        F.min(F.struct(*VIP_FIRST[1:])).alias("_own"),
    )
    level = level.select("vip_id_dim", "website", *VIP_MAX, *VIP_MIN, *[f"_own.{c}" for c in VIP_FIRST[1:]]).alias("v")
    pay = per_level.join(
        level, (F.col("p.vip_id") == F.col("v.vip_id_dim")) & (F.col("p.website") == F.col("v.website")), "left"
    ).select(*_level_columns(form))
    money = F.sum("paymoney").cast("decimal(20,4)").alias("paymoney")
    return _unpack(pay.groupBy(*KEY).agg(money, *_vip_aggs(form)), "_vip", _firsts(form))


def _build_safe(member, regtype, ad, site, payment, vip, form) -> DataFrame:
    member_one = _unpack(
        member.groupBy(*KEY).agg(_pick(F.max, ["time"], MEMBER_FIRST, "_m")), "_m", MEMBER_FIRST
    )
    wide = member_one
    if regtype is not None:
        reg_one = _unpack(
            regtype.groupBy(*KEY).agg(_pick(F.min, ["reg_createtime", "appregurl"], REG_FIRST, "_r")),
            "_r",
            REG_FIRST,
        )
        wide = wide.join(reg_one, KEY, "left")
    if payment is None:
        return _join_dims(wide, ad, site)
    pay_one = _pay_one(payment, vip, form)
    # uid-keyed joins first: all three sides are hash-partitioned on (uid, website) by their
    # aggregations, so the sort-merge joins need no further exchange.
    wide = wide.join(pay_one, KEY, "left")
    return _join_dims(wide, ad, site)


def _build_reference(member, regtype, ad, site, payment, vip, form) -> DataFrame:
    pay = _payments_with_vip(payment, vip, form)
    joined = _join_dims(member.join(regtype, KEY, "left"), ad, site).join(pay, KEY, "left")
    member_cols = MEMBER_FIRST + ["adname"]
    reg_cols = REG_FIRST + SITE_FIRST
    agg = joined.groupBy(*KEY).agg(
        _pick(F.max, ["time"], member_cols, "_m"),
        _pick(F.min, ["reg_createtime", "appregurl"], reg_cols, "_r"),
        F.sum("paymoney").cast("decimal(20,4)").alias("paymoney"),
        *_vip_aggs(form),
    )
    return _unpack(_unpack(_unpack(agg, "_m", member_cols), "_r", reg_cols), "_vip", _firsts(form))
