"""Declarative ingest of raw JSON lines into typed detail tables, with reject routing.

One :class:`IngestSpec` per target table lists its columns in order; each column is a JSON
key read as string or int, a load-date constant, or an expression over earlier columns.
A line is parsed once (``from_json`` to ``map<string,string>``). Lines that are not one
JSON object, or whose int fields hold non-numeric text, go to a rejects frame with a
reason instead of failing the job. Missing or empty int fields become 0. The job loader drops
the blank lines of a raw file (:func:`without_blank_lines`): they hold no record.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from learnmetrics.functions import columns as C

REJECT_NOT_OBJECT = "not_a_json_object"
REJECT_BAD_INT = "bad_int:"


@dataclass(frozen=True)
class Field:
    """One output column.

    kind: ``"string"`` / ``"int"`` read JSON ``key`` (default: the column name; a tuple
    lists alternative keys, first present wins), ``"load_date"`` is the job's ``dt``,
    ``"const"`` is ``value``, ``"derived"`` is ``derive(columns_so_far)``.
    ``transform`` is applied to the extracted value (masks etc.).
    """

    name: str
    kind: str = "string"
    key: str | tuple[str, ...] | None = None
    transform: Callable[[Column], Column] | None = None
    derive: Callable[[dict[str, Column]], Column] | None = None
    value: object = None

    @property
    def json_key(self) -> str | tuple[str, ...]:
        return self.key if self.key is not None else self.name


@dataclass(frozen=True)
class IngestSpec:
    table: str
    fields: tuple[Field, ...]
    # "overwrite" tables are full refreshes; "append" tables get one `time` partition per
    # load date, overwritten dynamically so a re-run of the same date is idempotent.
    write_mode: str = "overwrite"
    partition_by: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def int_fields(self) -> list[Field]:
        return [f for f in self.fields if f.kind == "int"]

    @property
    def schema(self) -> StructType:
        """Declared table schema; read partitioned tables with it so ``time`` stays a string."""
        return StructType(
            [StructField(f.name, IntegerType() if f.kind == "int" else StringType()) for f in self.fields]
        )

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(self.schema).parquet(path)


def S(name: str, key: str | tuple[str, ...] | None = None, transform=None) -> Field:
    return Field(name, "string", key, transform)


def I(name: str, key: str | tuple[str, ...] | None = None) -> Field:  # noqa: E743
    return Field(name, "int", key)


WEBSITE = S("website", "dn")
LOAD_DATE = Field("time", "load_date")

# --- the eight detail-table specs ---------------------------------------------

BASE_AD = IngestSpec("bdl_base_ad", (I("adid"), S("adname"), WEBSITE))

BASE_WEBSITE = IngestSpec(
    "bdl_base_website",
    (I("siteid"), S("sitename"), S("siteurl"), I("delete"), S("createtime"), S("creator"), WEBSITE),
)

MEMBER_REGTYPE = IngestSpec(
    "bdl_member_regtype",
    (
        I("uid"), S("appkey"), S("appregurl"), S("bdp_uuid"), S("createtime"),
        S("domain", "webA"), S("isranreg"), S("regsource"),
        Field("regsourcename", "derived", derive=lambda c: C.regsource_name(c["regsource"])),
        I("websiteid"), LOAD_DATE, WEBSITE,
    ),
    write_mode="append",
    partition_by=("time",),
)

PAYMONEY = IngestSpec(
    "bdl_pcentermempaymoney",
    (I("uid"), S("paymoney"), I("siteid"), I("vip_id"), LOAD_DATE, WEBSITE),
    write_mode="append",
    partition_by=("time",),
)

VIP_LEVEL = IngestSpec(
    "bdl_vip_level",
    (
        I("vip_id"), S("vip_level"), S("start_time"), S("end_time"), S("last_modify_time"),
        S("max_free"), S("min_free"), S("next_level"), S("operator"), WEBSITE,
    ),
)

MEMBER = IngestSpec(
    "bdl_member",
    (
        I("uid"), I("ad_id"), S("birthday"), S("email"), S("fullname", transform=C.mask_name),
        S("iconurl"), S("lastlogin"), S("mailaddr"), S("memberlevel"),
        Field("password", "const", value=C.PASSWORD_MASK), S("paymoney"),
        S("phone", transform=C.mask_phone), S("qq"), S("register"), S("regupdatetime"),
        S("unitname"), S("userip"), S("zipcode"), LOAD_DATE, WEBSITE,
    ),
    write_mode="append",
    partition_by=("time",),
)

WX_TYPE = IngestSpec(
    "bdl_wxtype",
    (
        I("bind_source"), S("app_id"), S("token_secret"), S("wx_name"), S("wx_no"),
        S("creator"), S("createtime"), WEBSITE,
    ),
)

MEMBER_WXBOUND = IngestSpec(
    "bdl_member_wxbound",
    (
        I("uid"), S("unionid"), S("openid"), S("nickname"), S("isdefault"), S("headimgurl"),
        S("boundtime"), I("bindsource"), LOAD_DATE, WEBSITE,
    ),
    write_mode="append",
    partition_by=("time",),
)

SPECS: dict[str, IngestSpec] = {
    s.table: s
    for s in (BASE_AD, BASE_WEBSITE, MEMBER_REGTYPE, PAYMONEY, VIP_LEVEL, MEMBER, WX_TYPE, MEMBER_WXBOUND)
}


@dataclass
class IngestResult:
    rows: DataFrame
    rejects: DataFrame
    # Every line once: the typed columns, ``_reason`` (null when good) and ``_raw`` (the
    # text, kept only for rejected lines). ``rows`` and ``rejects`` are filters of it, so
    # persisting it lets both be written from one scan and one parse.
    staged: DataFrame


def _field_columns(spec: IngestSpec, m: Column, load_date: str | None) -> dict[str, Column]:
    cols: dict[str, Column] = {}
    for f in spec.fields:
        if f.kind == "int":
            c = C.json_int(m, f.json_key, default=0)
        elif f.kind == "string":
            c = C.json_str(m, f.json_key)
        elif f.kind == "load_date":
            c = F.lit(load_date).cast("string")
        elif f.kind == "const":
            c = F.lit(f.value)
        elif f.kind == "derived":
            c = f.derive(cols)
        else:
            raise ValueError(f"unknown field kind {f.kind!r} in {spec.table}.{f.name}")
        if f.transform is not None:
            c = f.transform(c)
        cols[f.name] = c
    return cols


def reject_reason(spec: IngestSpec, m: Column) -> Column:
    """Null for a good line, else the first reason it is rejected."""
    reason = F.when(m.isNull(), F.lit(REJECT_NOT_OBJECT))
    for f in spec.int_fields:
        reason = reason.when(C.json_int_is_bad(m, f.json_key), F.lit(REJECT_BAD_INT + f.name))
    return reason


def without_blank_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines of a raw file without those of white space only (a null line isn't blank)."""
    return lines.where(~F.coalesce(F.trim(F.col(value_col), F.lit(" \t\r\n")) == "", F.lit(False)))


def ingest_json(
    lines: DataFrame,
    spec: IngestSpec,
    load_date: str | None = None,
    value_col: str = "value",
) -> IngestResult:
    """Raw JSON lines -> (typed rows in ``spec`` order, rejects with ``value, reason``)."""
    return ingest_parsed(lines.select(F.col(value_col).alias("_line"), C.parse_json_object(value_col).alias("_m")), spec, load_date)


def ingest_parsed(parsed: DataFrame, spec: IngestSpec, load_date: str | None = None) -> IngestResult:
    """As :func:`ingest_json`, from lines (``_line``) and their fields (``_m``, null: no object)."""
    if any(f.kind == "load_date" for f in spec.fields) and load_date is None:
        raise ValueError(f"{spec.table} needs a load date (yyyyMMdd)")
    m = F.col("_m")
    cols = _field_columns(spec, m, load_date)
    # The fields come out of a generator of one row: a filter on the reason would otherwise be
    # pushed down with the whole parse in place of every use of ``_m``.
    parsed = parsed.select("_line", F.explode(F.array("_m")).alias("_m"))
    with_reason = parsed.withColumn("_reason", reject_reason(spec, m))
    staged = with_reason.select(
        *[F.when(F.col("_reason").isNull(), cols[n]).alias(n) for n in spec.columns],
        "_reason",
        F.when(F.col("_reason").isNotNull(), F.col("_line")).alias("_raw"),
    )
    rows = staged.where(F.col("_reason").isNull()).select(*spec.columns)
    rejects = staged.where(F.col("_reason").isNotNull()).select(
        F.col("_raw").alias("value"),
        F.col("_reason").alias("reason"),
        F.lit(load_date).cast("string").alias("time"),
    )
    return IngestResult(rows, rejects, staged)


def reasons(spec: IngestSpec) -> list[str]:
    """The reasons a line can be rejected for."""
    return [REJECT_NOT_OBJECT, *(REJECT_BAD_INT + f.name for f in spec.int_fields)]


@dataclass
class WriteCounts:
    """Rows and rejects by reason, counted by the two writes themselves (:func:`counted`)."""

    rows: Observation
    rejects: Observation

    def result(self) -> dict[str, int]:
        """Number of rows (key ``rows``) and of rejects per reason; waits for both writes."""
        return {"rows": self.rows.get["rows"]} | {k: v or 0 for k, v in self.rejects.get.items()}


def counted(res: IngestResult, spec: IngestSpec) -> tuple[IngestResult, WriteCounts]:
    """``res`` with counts that are taken while its rows and its rejects are written: no job of
    their own, no other pass over the data."""
    counts = WriteCounts(Observation(), Observation())
    rows = res.rows.observe(counts.rows, F.count(F.lit(1)).alias("rows"))
    each = [F.sum((F.col("reason") == r).cast("long")).alias(r) for r in reasons(spec)]
    return IngestResult(rows, res.rejects.observe(counts.rejects, *each), res.staged), counts


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text scan: one row per line, column ``value``."""
    return spark.read.text(path)
