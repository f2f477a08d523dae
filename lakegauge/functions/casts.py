"""Casts from a JSON value to a mapper column type.

They follow what sensor software usually does with loose JSON: text that spells
a number is a number, true is 1, and truthiness decides a bool. NULL means the
value cannot be cast; the caller turns that into a rejection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakegauge.functions.isotime import iso_ts
from lakegauge.functions.strict_json import once

_BLANK = r"(?U)^[\s\x1c-\x1f]*|[\s\x1c-\x1f]*\z"
_DIGITS = r"\d+(?:_\d+)*"
_INT_TEXT = rf"^[+-]?{_DIGITS}\z"
_FLOAT_TEXT = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\z"
_INF_TEXT = r"(?i)^[+-]?inf(?:inity)?\z"
_NAN_TEXT = r"(?i)^[+-]?nan\z"


def number_text(value: Column) -> Column:
    """A JSON number as text: integers in full, others in their shortest form (21.0, 1e-07)."""

    def by_type(schema: Column) -> Column:
        whole = (schema == "BIGINT") | schema.rlike(r"^DECIMAL\((?:19|2\d|3\d),0\)\z")
        return F.when(whole, F.try_variant_get(value, "$", "string")).otherwise(
            once(F.try_variant_get(value, "$", "double"), _shortest)
        )

    return once(F.schema_of_variant(value), by_type)


def _shortest(number: Column) -> Column:
    java = number.cast("string")
    size = F.abs(number)
    plain = F.regexp_replace(java.try_cast("decimal(38,20)").cast("string"), r"0+\z", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.split(java, "E")[0], r"\.0\z", "")
    power = F.split(java, "E")[1].try_cast("int")
    digits = F.abs(power).cast("string")
    scientific = F.concat(
        mantissa, F.when(power < 0, "e-").otherwise("e+"), F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    )
    return (
        F.when(java == "Infinity", "inf")
        .when(java == "-Infinity", "-inf")
        .when((size == 0) | ((size >= 1e-4) & (size < 1e16)), F.when(java.contains("E"), plain).otherwise(java))
        .otherwise(scientific)
    )


def as_text(value: Column, value_kind: Column) -> Column:
    """Text form of any non-null value; containers give their JSON text."""
    return (
        F.when(value_kind == "string", F.try_variant_get(value, "$", "string"))
        .when(value_kind == "number", number_text(value))
        .when(value_kind == "bool", F.when(F.try_variant_get(value, "$", "boolean"), "True").otherwise("False"))
        .when(value_kind.isin("array", "object"), F.to_json(value))
    )


def _trimmed(value: Column) -> Column:
    return F.regexp_replace(F.try_variant_get(value, "$", "string"), _BLANK, "")


def as_double(value: Column, value_kind: Column) -> Column:
    def spelled(text: Column) -> Column:
        return (
            F.when(text.rlike(_FLOAT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
            .when(text.rlike(_INF_TEXT), F.when(text.startswith("-"), float("-inf")).otherwise(float("inf")))
            .when(text.rlike(_NAN_TEXT), float("nan"))
        )

    return (
        F.when(value_kind == "number", F.try_variant_get(value, "$", "double"))
        .when(value_kind == "bool", F.when(F.try_variant_get(value, "$", "boolean"), 1.0).otherwise(0.0))
        .when(value_kind == "string", once(_trimmed(value), spelled))
    )


def as_long(value: Column, value_kind: Column) -> Column:
    """Numbers are cut toward zero; text must spell an integer; beyond 64 bits is NULL."""
    def cut(number: Column) -> Column:
        return F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).try_cast("bigint")

    def spelled(text: Column) -> Column:
        digits = F.replace(text, F.lit("_"), F.lit(""))
        return F.when(text.rlike(_INT_TEXT), digits.try_cast("decimal(38,0)").try_cast("bigint"))

    return (
        F.when(
            value_kind == "number",
            F.coalesce(
                F.try_variant_get(value, "$", "bigint"), once(F.try_variant_get(value, "$", "decimal(38,10)"), cut)
            ),
        )
        .when(value_kind == "bool", F.when(F.try_variant_get(value, "$", "boolean"), 1).otherwise(0))
        .when(value_kind == "string", once(_trimmed(value), spelled))
    )


def as_bool(value: Column, value_kind: Column) -> Column:
    """Truthiness: zero, empty text and empty containers are false, the rest true."""
    return (
        F.when(value_kind == "bool", F.try_variant_get(value, "$", "boolean"))
        .when(value_kind == "number", F.try_variant_get(value, "$", "double") != 0)
        .when(value_kind == "string", F.try_variant_get(value, "$", "string") != "")
        .when(value_kind.isin("array", "object"), ~F.to_json(value).isin("[]", "{}"))
    )


def as_timestamp(value: Column, value_kind: Column) -> Column:
    text = F.try_variant_get(value, "$", "string")
    # the only number that reads as a date is a whole one of eight digits, yyyymmdd
    eight = (F.schema_of_variant(value) == "BIGINT") & text.rlike(r"^\d{8}\z")
    return F.when(value_kind == "string", iso_ts(text)).when(
        (value_kind == "number") & eight, F.try_to_timestamp(text, F.lit("yyyyMMdd"))
    )
