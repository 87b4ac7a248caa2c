"""The library's functions for SQL text, as temporary SQL functions of a session.

:func:`register` defines them with ``CREATE FUNCTION ... RETURN <expression>``: they are bodies
in SQL, which the analyzer puts in place of each call, so a query written with them is
optimised like one with the expressions written out (no Python, no call per row). They give
what the column functions in :mod:`learnmetrics.functions.columns` give.

Scalar functions: ``lm_mask_name``, ``lm_mask_phone``, ``lm_mask_phone_with``,
``lm_regsource_name``, ``lm_password_mask``, ``lm_money``, ``lm_iso_day``, ``lm_epoch_day``,
``lm_ipv4_to_long``, ``lm_long_to_ipv4``, ``lm_json``. Table functions, over the views that
:func:`register_zipper` and :func:`register_ranges` are given: ``lm_zipper_on(day)``,
``lm_region_of(address)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from learnmetrics.functions import columns as C

_LABELS = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in C.REGSOURCE_LABELS.items())
_OCTETS = "transform(split(trim(a), '[.]'), x -> try_cast(x AS BIGINT))"

#: name -> (parameters, type, body)
FUNCTIONS = {
    "lm_mask_name": ("s STRING", "STRING", f"CASE WHEN s IS NOT NULL THEN concat(substring(s, 1, 1), '{C.NAME_MASK_SUFFIX}') END"),
    "lm_mask_phone_with": (
        "s STRING, fill STRING", "STRING",
        "CASE WHEN s IS NULL OR s = '' THEN s WHEN length(s) < 11 THEN repeat('*', length(s)) "
        "ELSE concat(substring(s, 1, 3), fill, substring(s, 8, 4)) END",
    ),
    "lm_mask_phone": ("s STRING", "STRING", f"lm_mask_phone_with(s, '{C.PHONE_MASK_MEMBER}')"),
    "lm_regsource_name": ("code STRING", "STRING", f"CASE code {_LABELS} ELSE '{C.REGSOURCE_OTHER}' END"),
    "lm_password_mask": ("", "STRING", f"'{C.PASSWORD_MASK}'"),
    "lm_money": ("s STRING", "DECIMAL(20,4)", "try_cast(s AS DECIMAL(20,4))"),
    "lm_iso_day": (
        "s STRING", "STRING",
        "CASE WHEN rlike(s, '^[0-9]{8}$') AND try_cast(concat_ws('-', left(s, 4), substring(s, 5, 2), right(s, 2)) AS DATE) IS NOT NULL "
        "THEN concat_ws('-', left(s, 4), substring(s, 5, 2), right(s, 2)) END",
    ),
    "lm_epoch_day": (
        "epoch BIGINT, offset_hours INT", "STRING",
        "CAST(date_from_unix_date(CAST(floor((epoch + offset_hours * 3600) / 86400) AS INT)) AS STRING)",
    ),
    "lm_ipv4_to_long": (
        "a STRING", "BIGINT",
        f"CASE WHEN size({_OCTETS}) = 4 AND forall({_OCTETS}, x -> x IS NOT NULL AND x BETWEEN 0 AND 255) "
        f"THEN aggregate({_OCTETS}, 0L, (acc, x) -> acc * 256 + x) END",
    ),
    "lm_long_to_ipv4": (
        "a BIGINT", "STRING",
        "concat_ws('.', CAST(a >> 24 & 255 AS STRING), CAST(a >> 16 & 255 AS STRING), CAST(a >> 8 & 255 AS STRING), CAST(a & 255 AS STRING))",
    ),
    "lm_json": (
        "line STRING", "MAP<STRING, STRING>",
        "from_json(line, 'map<string,string>', map('mode', 'PERMISSIVE', 'allowUnquotedFieldNames', 'true', 'allowSingleQuotes', 'true'))",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Define (or define anew) the scalar functions in the session; returns their names."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)


def register_zipper(spark: SparkSession, history: DataFrame, name: str = "lm_zipper_on") -> None:
    """Table function ``name(day)``: the members' intervals of ``history`` that hold on a day (yyyy-MM-dd)."""
    history.createOrReplaceTempView(f"{name}_history")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(day STRING)
        RETURNS TABLE (uid BIGINT, website STRING, paymoney DECIMAL(20,4), vip_level STRING, start_time STRING, end_time STRING)
        RETURN SELECT CAST(uid AS BIGINT), website, CAST(paymoney AS DECIMAL(20,4)), vip_level, start_time, end_time
               FROM {name}_history WHERE start_time <= day AND day < end_time""")


def register_ranges(spark: SparkSession, ranges: DataFrame, name: str = "lm_region_of") -> None:
    """Table function ``name(address)``: the disjoint range of ``ranges`` that an address lies in. Meant for
    single addresses; tables of addresses are joined by :func:`learnmetrics.operators.geo.lookup_region`."""
    ranges.createOrReplaceTempView(f"{name}_ranges")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(address STRING) RETURNS TABLE (lo BIGINT, hi BIGINT, region STRING)
        RETURN SELECT lo, hi, region FROM {name}_ranges WHERE lm_ipv4_to_long(address) BETWEEN lo AND hi""")
