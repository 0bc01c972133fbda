"""Datetime parsing and arithmetic as column expressions. Bad text gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _timestamp(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def parse_by_length(value: Column) -> Column:
    """23, 22 and 21 characters carry a fraction, 27 a fraction and zone; else the date at midnight."""
    text = F.regexp_replace(value, "T", " ")
    size = F.length(value)
    day = _timestamp(F.substring(value, 1, 10), "yyyy-MM-dd")
    return (
        F.when(size == 23, _timestamp(text, "yyyy-MM-dd HH:mm:ss.SSS"))
        .when(size == 22, _timestamp(text, "yyyy-MM-dd HH:mm:ss.SS"))
        .when(size == 21, _timestamp(text, "yyyy-MM-dd HH:mm:ss.S"))
        .when(size == 27, _timestamp(text, "yyyy-MM-dd HH:mm:ss.SSSSSSX"))
        .otherwise(day)
    )


def parse_prefix19(value: Column) -> Column:
    """First 19 characters with ``T`` or a space; shorter text is a date."""
    text = F.regexp_replace(F.substring(value, 1, 19), "T", " ")
    return F.when(F.length(value) >= 19, _timestamp(text, "yyyy-MM-dd HH:mm:ss")).otherwise(
        _timestamp(F.substring(value, 1, 10), "yyyy-MM-dd")
    )


def parse_whole_second(value: Column) -> Column:
    """Plain UTC text or ISO text with offset, cut to whole seconds."""
    # The offset form needs a zone, so text without one stays null.
    zoned = F.when(
        value.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2}(:\d{2})?)$"),
        value.try_cast("timestamp"),
    )
    plain = F.when(
        value.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), _timestamp(value, "yyyy-MM-dd HH:mm:ss")
    )
    return F.date_trunc("second", F.coalesce(plain, zoned))


def parse_day_first(value: Column) -> Column:
    """``dd/MM/yyyy`` text to an ISO date text."""
    return F.date_format(_timestamp(value, "dd/MM/yyyy"), "yyyy-MM-dd")


# Time units of a ttl.
TTL_MONTHS = {"MONTH": 1, "MONTHS": 1, "YEAR": 12, "YEARS": 12}
TTL_SECONDS = {
    "SECOND": 1, "SECONDS": 1, "MINUTE": 60, "MINUTES": 60, "HOUR": 3600, "HOURS": 3600,
    "DAY": 86400, "DAYS": 86400, "WEEK": 604800, "WEEKS": 604800,
}


def add_ttl(start: Column, amount: Column, unit: Column) -> Column:
    """``start`` plus ``amount`` units; an unknown unit gives null."""
    word = F.upper(unit)
    months = F.create_map(*[F.lit(x) for pair in TTL_MONTHS.items() for x in pair])
    seconds = F.create_map(*[F.lit(x) for pair in TTL_SECONDS.items() for x in pair])
    by_month = start + F.make_ym_interval(F.lit(0), amount.cast("int") * months[word])
    by_second = F.timestamp_micros(
        F.unix_micros(start) + amount.cast("bigint") * seconds[word].cast("bigint") * F.lit(1_000_000)
    )
    return F.when(months[word].isNotNull(), by_month).when(seconds[word].isNotNull(), by_second)


def whole_hours(earlier: Column, later: Column) -> Column:
    return F.timestamp_diff("HOUR", earlier, later)


def local_date(utc: Column, zone: str) -> Column:
    """UTC time moved to a zone before the date is taken."""
    return F.date_format(F.from_utc_timestamp(utc, zone), "yyyy-MM-dd")


def newer_than(value: Column, as_of: Column, seconds: int) -> Column:
    """Instant distance: ``value`` lies strictly after ``as_of`` minus ``seconds``."""
    return F.unix_micros(value.cast("timestamp")) > F.unix_micros(as_of.cast("timestamp")) - F.lit(seconds * 1_000_000)
