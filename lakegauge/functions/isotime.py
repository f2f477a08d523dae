"""ISO-8601 text to a UTC timestamp, NULL for anything else.

Spark's own cast is too generous for sensor text (``08:14:22`` becomes today,
``2026`` becomes new year) and too strict elsewhere (basic and week dates,
offsets beyond 18 hours). Common extended forms take a direct cast behind a
guard; other ISO forms are taken apart and rebuilt.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakegauge.functions.strict_json import once

_COMMON = (
    r"^(?!0000|0001|9999)\d{4}-\d{2}-\d{2}[T ](?:[01]\d|2[0-3]):\d{2}:\d{2}(?:\.\d{1,6})?"
    r"(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)?\z"
)
_HAS_ZONE = r"(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?|[T ]\d{2}(?::?\d{2}){0,2}[+-]\d{2})\z"

_DATE = r"(?!0000)(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2})|-W(\d{2})(?:-(\d))?|W(\d{2})(\d)?)"
_CLOCK = r"(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?|(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)?"
_ZONE = r"(?:Z|([+-](?:[01]\d|2[0-3]))(?::([0-5]\d)(?::([0-5]\d))?|([0-5]\d)([0-5]\d)?)?)"
_ANY = rf"^{_DATE}(?:[^0-9]{_CLOCK}{_ZONE}?)?\z"

# How the pieces of _ANY are put back; an absent piece leaves its place empty.
_TO_DAY = "$1-$2$4-$3$5"
_TO_WEEK = "$1 $6$8 $7$9"
_TO_CLOCK = "$10:$11$14:$12$15.$13$16" + "000000"
_TO_OFFSET = "$17:$18$20:$19$21"
_EMPTY_PLACE = r"(?<=^|:)(?=:|\.|\z)"


def iso_ts(text: Column) -> Column:
    """Naive text is taken as UTC; an offset is converted, not relabelled."""
    return once(text, _parsed)


def _parsed(text: Column) -> Column:
    zoned = text.endswith("Z") | F.substring(text, -6, 1).isin("+", "-")
    return (
        F.when(text.rlike(_COMMON), F.when(zoned, text).otherwise(F.concat(text, F.lit("Z"))).try_cast("timestamp"))
        .when(text.rlike(_ANY), _rebuilt(text))
    )


def has_zone(text: Column) -> Column:
    """True if ISO text names its zone, so it is an instant rather than a wall clock."""
    return text.rlike(_HAS_ZONE)


def _rebuilt(text: Column) -> Column:
    def piece(layout: str) -> Column:
        return F.regexp_replace(text, _ANY, layout)

    clock = F.regexp_replace(F.regexp_replace(piece(_TO_CLOCK), _EMPTY_PLACE, "00"), r"(\.\d{6})\d*\z", "$1")
    day = F.when(text.rlike(r"^\d{4}-?W"), _week_day(F.split(piece(_TO_WEEK), " "))).otherwise(piece(_TO_DAY))
    # 24:00 is midnight at the end of the day
    def instant(time: Column) -> Column:
        end_of_day = time == "24:00:00.000000"
        local = F.concat(
            day, F.lit(" "), F.when(end_of_day, "00:00:00.000000").otherwise(time), F.lit("Z")
        ).try_cast("timestamp")
        offset = F.regexp_replace(piece(_TO_OFFSET), _EMPTY_PLACE, "00").try_cast("interval hour to second")
        return F.timestamp_add("DAY", F.when(end_of_day, 1).otherwise(0), local) - offset

    first, last = (F.lit(t).cast("timestamp") for t in ("0001-01-01 00:00:00Z", "9999-12-31 23:59:59.999999Z"))
    return once(once(clock, instant), lambda t: F.when(t.between(first, last), t))


def _week_day(fields: Column) -> Column:
    """Year, ISO week and weekday (Monday if absent) as yyyy-MM-dd, NULL if there is no such week."""
    week = fields[1].try_cast("int")
    weekday = F.coalesce(fields[2].try_cast("int"), F.lit(1))
    jan4 = F.concat(fields[0], F.lit("-01-04")).try_cast("date")
    day = F.date_add(F.trunc(jan4, "week"), (week - 1) * 7 + weekday - 1)
    return F.when(weekday.between(1, 7) & (F.weekofyear(day) == week), day.cast("string"))
