"""Behaviour log: 17 tab-separated fields per event.

Cleaning keeps lines with exactly 17 fields, masks the phone (field 9) and removes line
feeds from the user name (field 1). Parsing turns a line into typed columns that the
batch reports and both streaming jobs share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from learnmetrics.functions import columns as C

# Field order of a behaviour line (indices 0..16).
BEHAVIOUR_FIELDS = [
    "uid", "username", "gender", "level", "is_vip", "os", "channel", "net", "ip", "phone",
    "video_id", "video_length", "start_video_time", "end_video_time", "version", "event_key",
    "event_time",
]
_BIGINT_FIELDS = {"uid", "video_id", "video_length", "start_video_time", "end_video_time", "event_time"}
# Schema of parsed events (and of the dwd.user_behavior table, partitioned by dt).
BEHAVIOUR_SCHEMA = StructType(
    [StructField(n, LongType() if n in _BIGINT_FIELDS else StringType()) for n in BEHAVIOUR_FIELDS]
    + [StructField("dt", StringType())]
)
USERNAME_IDX = BEHAVIOUR_FIELDS.index("username")
PHONE_IDX = BEHAVIOUR_FIELDS.index("phone")

# Event keys.
START_VIDEO = "startVideo"
END_VIDEO = "endVideo"
ENTER_ORDER_PAGE = "enterOrderPage"
COMPLETE_ORDER = "completeOrder"


def _fields(value_col: str, keep_trailing_empty: bool):
    return C.split_tsv(value_col, keep_trailing_empty)


def _split_once(lines: DataFrame, value_col: str, keep_trailing_empty: bool, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``_f``, the line split into fields.

    The array is produced by a generator (``explode`` of a one-element array) because
    filters are not pushed below a generator: several field tests then read one split
    instead of each re-splitting (and re-deriving) the line.
    """
    arr = F.array(_fields(value_col, keep_trailing_empty))
    return lines.select(*keep, F.explode(arr).alias("_f"))


def is_valid_line(value_col: str = "value", keep_trailing_empty: bool = False):
    return F.size(_fields(value_col, keep_trailing_empty)) == C.BEHAVIOUR_FIELD_COUNT


def clean_lines(
    lines: DataFrame,
    value_col: str = "value",
    keep_trailing_empty: bool = False,
    phone_fill: str = C.PHONE_MASK_BEHAVIOUR,
) -> DataFrame:
    """Valid lines only, phone masked, user name without line feeds; column ``value``."""
    split = _split_once(lines, value_col, keep_trailing_empty, [])
    f = F.col("_f")
    fixed = F.transform(
        f,
        lambda x, i: F.when(i == USERNAME_IDX, C.strip_newlines(x))
        .when(i == PHONE_IDX, C.mask_phone(x, phone_fill))
        .otherwise(x),
    )
    return split.where(F.size(f) == C.BEHAVIOUR_FIELD_COUNT).select(C.join_tsv(fixed).alias("value"))


def rejected_lines(lines: DataFrame, value_col: str = "value", keep_trailing_empty: bool = False) -> DataFrame:
    """Lines that do not have 17 fields, with their field count."""
    n = F.size(_fields(value_col, keep_trailing_empty))
    return lines.where(n != C.BEHAVIOUR_FIELD_COUNT).select(F.col(value_col).alias("value"), n.alias("n_fields"))


def parse_lines(
    lines: DataFrame,
    value_col: str = "value",
    tz_offset_hours: int = 8,
    keep_columns: list[str] | None = None,
) -> DataFrame:
    """Valid lines -> typed columns named by :data:`BEHAVIOUR_FIELDS` plus ``dt`` (yyyyMMdd).

    Numeric fields are ``try_cast`` to bigint (bad text -> null). ``keep_columns`` passes
    other columns of ``lines`` through (e.g. a Kafka timestamp). The line is split once.
    """
    keep = keep_columns or []
    split = _split_once(lines, value_col, False, keep)
    f = F.col("_f")
    cols = []
    for i, name in enumerate(BEHAVIOUR_FIELDS):
        c = f.getItem(i)
        cols.append((c.try_cast("bigint") if name in _BIGINT_FIELDS else c).alias(name))
    parsed = split.where(F.size(f) == C.BEHAVIOUR_FIELD_COUNT).select(*keep, *cols)
    return parsed.withColumn("dt", C.epoch_to_yyyymmdd("event_time", tz_offset_hours))


def daily_video_users(behaviour: DataFrame, day: str | None = None) -> DataFrame:
    """Per day: users who started a video, and users who watched one to the end.

    ``behaviour`` needs uid, event_key, start_video_time, end_video_time, video_length, dt.
    Watched to the end: an endVideo event with (end - start) >= video_length.
    Both distinct counts come from one scan: rows are first reduced to one flag pair per
    (dt, uid) by a partial aggregate, then summed per day; no row is expanded.
    """
    b = behaviour.where(F.col("event_key").isin(START_VIDEO, END_VIDEO) & F.col("uid").isNotNull())
    if day is not None:
        b = b.where(F.col("dt") == day)
    watched = (F.col("event_key") == START_VIDEO).cast("int")
    completed = (
        (F.col("event_key") == END_VIDEO)
        & ((F.col("end_video_time") - F.col("start_video_time")) >= F.col("video_length"))
    ).cast("int")
    per_user = b.groupBy("dt", "uid").agg(
        F.max(watched).alias("w"), F.coalesce(F.max(completed), F.lit(0)).alias("c")
    )
    return per_user.groupBy("dt").agg(
        F.sum("w").cast("bigint").alias("watch_video_count"),
        F.sum("c").cast("bigint").alias("complete_video_count"),
    ).select("watch_video_count", "complete_video_count", "dt")
