"""Layered table locations and the column projections each consumer reads.

The projections keep only the columns a job needs, so Parquet scans are pruned to them,
and apply the renames the wide-table build expects.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnmetrics.functions import columns as C


@dataclass(frozen=True)
class Warehouse:
    """Parquet tables below one root: ``<root>/<layer>/<table>``."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.read.parquet(self.path(layer, table))


# --- detail-table readers used by the wide-table build ----------------------------

# Column names in their order (fixed values).
MEMBER_COLUMNS = [
    "uid", "ad_id", "email", "fullname", "iconurl", "lastlogin", "mailaddr", "memberlevel",
    "password", "phone", "qq", "register", "regupdatetime", "unitname", "userip", "zipcode",
    "time", "website",
]


def member_columns(member: DataFrame) -> DataFrame:
    return member.select(*MEMBER_COLUMNS)


def regtype_columns(regtype: DataFrame) -> DataFrame:
    return regtype.select(
        "uid", "appkey", "appregurl", "bdp_uuid", F.col("createtime").alias("reg_createtime"),
        "domain", "isranreg", "regsource", "regsourcename", F.col("websiteid").alias("siteid"),
        "website",
    )


def ad_columns(ad: DataFrame) -> DataFrame:
    return ad.select(F.col("adid").alias("ad_id"), "adname", "website")


def site_columns(site: DataFrame) -> DataFrame:
    return site.select(
        "siteid", "sitename", "siteurl", F.col("delete").alias("site_delete"),
        F.col("createtime").alias("site_createtime"), F.col("creator").alias("site_creator"),
        "website",
    )


def vip_columns(vip: DataFrame) -> DataFrame:
    return vip.select(
        "vip_id", "vip_level", F.col("start_time").alias("vip_start_time"),
        F.col("end_time").alias("vip_end_time"), F.col("last_modify_time").alias("vip_last_modify_time"),
        F.col("max_free").alias("vip_max_free"), F.col("min_free").alias("vip_min_free"),
        F.col("next_level").alias("vip_next_level"), F.col("operator").alias("vip_operator"),
        "website",
    )


def payment_columns(payment: DataFrame) -> DataFrame:
    return payment.select("uid", C.money("paymoney").alias("paymoney"), "vip_id", "website")


# --- wide-table reader used by the reports --------------------------------------

REPORT_COLUMNS = [
    "uid", "ad_id", "memberlevel", "register", "appregurl", "regsource", "regsourcename",
    "adname", "siteid", "sitename", "vip_level", "paymoney", "website",
]


def wide_for_reports(wide: DataFrame, money_type: str = "decimal(20,4)") -> DataFrame:
    """The 13 columns the reports read.

    Money is read as decimal(20,4), the type of the wide table's sum. (Reading it as
    decimal(10,4), as detail money is, would turn every member total of 1,000,000 or more
    into null; pass ``money_type="decimal(10,4)"`` to get that behaviour.)
    """
    return wide.select(
        *[F.col(c).try_cast(money_type).alias(c) if c == "paymoney" else F.col(c) for c in REPORT_COLUMNS]
    )
