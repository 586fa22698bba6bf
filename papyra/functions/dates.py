"""Date rules as column expressions. All of them need the session zone set to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout of a version time, e.g. "Mon, 2 Apr 2007 19:18:42 GMT", and the two
# fragments looked for in otherwise unreadable text. The weekday is not checked; zones other
# than GMT and UTC are refused because their names are ambiguous.
VERSION_TIME = r"^[A-Za-z]{3}, (\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) (?:GMT|UTC)$"
VERSION_TIME_FORMAT = "d MMM yyyy HH:mm:ss"
ISO_FRAGMENT = r"(\d{4}-\d{2}-\d{2})"
DAY_MONTH_FRAGMENT = r"(\d{2} \w{3} \d{4})"
DAY_MONTH_FORMAT = "dd MMM yyyy"

_ISO_TIME = r"([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?\s*$"
ISO_TEXT = r"^\s*\d{4}-\d{2}-\d{2}" + _ISO_TIME
BASIC_ISO_TEXT = r"^\s*\d{8}" + _ISO_TIME

MICROS_PER_DAY = 86_400_000_000


def version_time(text: Column) -> Column:
    """Strict reading of a version time; null when the text has any other shape."""
    return F.try_to_timestamp(
        F.regexp_extract(text, VERSION_TIME, 1), F.lit(VERSION_TIME_FORMAT)
    )


def iso_date(text: Column) -> Column:
    """A whole ISO text: date, optional time and zone, with or without hyphens; else null."""
    basic = F.try_to_timestamp(F.substring(F.trim(text), 1, 8), F.lit("yyyyMMdd")).cast("date")
    return F.when(text.rlike(ISO_TEXT), text.try_cast("date")).when(text.rlike(BASIC_ISO_TEXT), basic)


def lenient_time(text: Column) -> Column:
    """ISO text, then a version time, then a date fragment anywhere in the text."""
    iso = F.when(text.rlike(r"^\s*\d{4}"), text.try_cast("timestamp"))
    fragment = F.when(
        text.rlike(ISO_FRAGMENT),
        F.regexp_extract(text, ISO_FRAGMENT, 1).try_cast("timestamp"),
    ).otherwise(
        F.try_to_timestamp(
            F.regexp_extract(text, DAY_MONTH_FRAGMENT, 1), F.lit(DAY_MONTH_FORMAT)
        )
    )
    return F.coalesce(iso, version_time(text), fragment)


def mean_gap_days(times: Column) -> Column:
    """Days between first and last time over the number of gaps; null below two times."""
    span = F.unix_micros(F.array_max(times)) - F.unix_micros(F.array_min(times))
    n = F.size(times)
    return F.when(n > 1, span / F.lit(float(MICROS_PER_DAY)) / (n - 1))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("double")


def partition_fields(day: Column) -> list[Column]:
    return [
        F.coalesce(F.date_format(day, pattern), F.lit(missing)).alias(name)
        for name, pattern, missing in (
            ("year", "yyyy", "unknown"), ("month", "MM", "00"), ("day", "dd", "00"),
        )
    ]
