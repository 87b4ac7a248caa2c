"""Scalar column functions (JSON fields, masks, dates, TSV, IPv4).

Every function takes and returns ``Column`` objects built from ``pyspark.sql.functions``;
nothing here runs Python per row, so all of it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical output.
# ---------------------------------------------------------------------------
# Registration-source code -> label (codes not listed map to "other").
REGSOURCE_LABELS = {"1": "PC", "2": "Mobile", "3": "App", "4": "WeChat"}
REGSOURCE_OTHER = "other"
# Replacement for the password column.
PASSWORD_MASK = "******"
# Suffix that replaces everything after the first character of a full name.
NAME_MASK_SUFFIX = "xx"
# Middle part of a masked phone in the member loader, and in the behaviour cleaner.
PHONE_MASK_MEMBER = "*****"
PHONE_MASK_BEHAVIOUR = "xxxx"
# End date of an open SCD-2 interval.
OPEN_END = "9999-12-31"
# Region name used when an IP is in no known range ("unknown").
UNKNOWN_REGION = "未知"
# Number of tab-separated fields in a valid behaviour line.
BEHAVIOUR_FIELD_COUNT = 17


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- JSON -----------------------------------------------------------------

def parse_json_object(c: ColumnOrName) -> Column:
    """JSON text -> ``map<string,string>``; null unless the text is one JSON object.

    Arrays, scalars, empty strings and malformed text give null; nested values are
    kept as their JSON text. Unquoted and single-quoted keys are accepted.
    """
    return F.from_json(
        _col(c),
        "map<string,string>",
        {"mode": "PERMISSIVE", "allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"},
    )


def json_str(m: ColumnOrName, key: str | tuple[str, ...]) -> Column:
    """A key of a parsed JSON map as string; with several keys the first present wins."""
    keys = (key,) if isinstance(key, str) else key
    vals = [_col(m).getItem(k) for k in keys]
    return vals[0] if len(vals) == 1 else F.coalesce(*vals)


def json_int_raw(m: ColumnOrName, key: str | tuple[str, ...]) -> Column:
    """The text of an int field, trimmed; null when the key is missing or empty."""
    s = F.trim(json_str(m, key))
    return F.when(s != "", s)


def json_int(m: ColumnOrName, key: str | tuple[str, ...], default: int | None = 0) -> Column:
    """A key as int; missing or empty -> ``default``, non-numeric text -> null.

    Use :func:`json_int_is_bad` to route rows whose text is present but not an int.
    """
    raw = json_int_raw(m, key)
    v = raw.try_cast("int")
    return v if default is None else F.when(raw.isNull(), F.lit(default)).otherwise(v)


def json_int_is_bad(m: ColumnOrName, key: str | tuple[str, ...]) -> Column:
    """True when the key holds text that is not a 32-bit integer."""
    raw = json_int_raw(m, key)
    return raw.isNotNull() & raw.try_cast("int").isNull()


# --- labels and masks --------------------------------------------------------

def regsource_name(c: ColumnOrName) -> Column:
    """Registration-source code -> label; unknown codes and null -> "other"."""
    c = _col(c)
    expr = F.when(F.lit(False), F.lit(None))
    for code, label in REGSOURCE_LABELS.items():
        expr = expr.when(c == code, F.lit(label))
    return expr.otherwise(F.lit(REGSOURCE_OTHER))


def mask_name(c: ColumnOrName) -> Column:
    """First character plus "xx"; null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.concat(F.substring(c, 1, 1), F.lit(NAME_MASK_SUFFIX)))


def mask_phone(c: ColumnOrName, fill: str = PHONE_MASK_MEMBER) -> Column:
    """First 3 characters + ``fill`` + characters 8 to 11.

    Null and empty values are returned unchanged; a phone shorter than 11 characters is
    replaced by stars of the same length (the row is kept).
    """
    c = _col(c)
    masked = F.concat(F.substring(c, 1, 3), F.lit(fill), F.substring(c, 8, 4))
    return (
        F.when(c.isNull() | (c == ""), c)
        .when(F.length(c) < 11, F.repeat(F.lit("*"), F.length(c)))
        .otherwise(masked)
    )


def password_mask() -> Column:
    return F.lit(PASSWORD_MASK)


# --- money, dates -------------------------------------------------------------

def money(c: ColumnOrName) -> Column:
    """Money text or number -> decimal(20,4); unparsable -> null (see :func:`is_bad_money`)."""
    return _col(c).try_cast("decimal(20,4)")


def is_bad_money(c: ColumnOrName) -> Column:
    """The value is there but is no amount that :func:`money` can hold."""
    return _col(c).isNotNull() & money(c).isNull()


def yyyymmdd_to_iso(c: ColumnOrName) -> Column:
    """'20190712' -> '2019-07-12'; anything that is not 8 digits, or no such day -> null."""
    c = _col(c)
    iso = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(c.rlike("^[0-9]{8}$") & iso.try_cast("date").isNotNull(), iso)


def epoch_seconds(c: ColumnOrName) -> Column:
    """Epoch seconds (bigint) of a timestamp or timestamp_ntz (ntz is read as UTC)."""
    return F.unix_timestamp(_col(c))


def epoch_to_day(epoch: ColumnOrName, tz_offset_hours: int = 8) -> Column:
    """Epoch seconds -> 'yyyy-MM-dd' at a fixed UTC offset, independent of session time zone."""
    shifted = _col(epoch).cast("bigint") + F.lit(tz_offset_hours * 3600)
    day_no = F.floor(shifted / F.lit(86400)).cast("int")
    return F.date_from_unix_date(day_no).cast("string")


def epoch_to_yyyymmdd(epoch: ColumnOrName, tz_offset_hours: int = 8) -> Column:
    return F.regexp_replace(epoch_to_day(epoch, tz_offset_hours), "-", "")


# --- tab-separated lines ------------------------------------------------------

def split_tsv(c: ColumnOrName, keep_trailing_empty: bool = False) -> Column:
    """Split a line on tabs.

    By default trailing empty fields are dropped first, as the JVM ``String.split`` does,
    so a line that ends in empty fields counts fewer fields.
    """
    c = _col(c)
    if not keep_trailing_empty:
        c = F.regexp_replace(c, "\t+$", "")
    return F.split(c, "\t")


def join_tsv(arr: ColumnOrName) -> Column:
    return F.array_join(_col(arr), "\t")


def strip_newlines(c: ColumnOrName) -> Column:
    """Remove line feeds; null and empty values pass unchanged."""
    c = _col(c)
    return F.when(c.isNull() | (c == ""), c).otherwise(F.regexp_replace(c, "\n", ""))


# --- IPv4 ---------------------------------------------------------------------

def ipv4_to_long(c: ColumnOrName) -> Column:
    """Dotted IPv4 text -> integer address (bigint); anything else -> null."""
    parts = F.split(F.trim(_col(c)), r"\.")
    octets = F.transform(parts, lambda x: x.try_cast("bigint"))
    valid = (F.size(parts) == 4) & F.forall(octets, lambda x: x.isNotNull() & (x >= 0) & (x <= 255))
    value = F.aggregate(octets, F.lit(0).cast("bigint"), lambda acc, x: acc * 256 + x)
    return F.when(valid, value)


def long_to_ipv4(c: ColumnOrName) -> Column:
    """Integer address -> dotted text."""
    c = _col(c).cast("bigint")
    return F.concat_ws(
        ".",
        F.shiftright(c, 24).bitwiseAND(255).cast("string"),
        F.shiftright(c, 16).bitwiseAND(255).cast("string"),
        F.shiftright(c, 8).bitwiseAND(255).cast("string"),
        c.bitwiseAND(255).cast("string"),
    )


__all__ = [
    "parse_json_object",
    "json_str",
    "json_int_raw",
    "json_int",
    "json_int_is_bad",
    "regsource_name",
    "mask_name",
    "mask_phone",
    "password_mask",
    "money",
    "yyyymmdd_to_iso",
    "epoch_seconds",
    "epoch_to_day",
    "epoch_to_yyyymmdd",
    "split_tsv",
    "join_tsv",
    "strip_newlines",
    "ipv4_to_long",
    "long_to_ipv4",
    "REGSOURCE_LABELS",
    "REGSOURCE_OTHER",
    "PASSWORD_MASK",
    "NAME_MASK_SUFFIX",
    "PHONE_MASK_MEMBER",
    "PHONE_MASK_BEHAVIOUR",
    "OPEN_END",
    "UNKNOWN_REGION",
    "BEHAVIOUR_FIELD_COUNT",
]
