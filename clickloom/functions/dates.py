"""Date and time helpers. Text patterns are fixed values; zones follow the session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats used in tables and keys.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_FORMAT = "yyyyMMddHHmm"


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def format_time(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def format_date(ts: Column) -> Column:
    return F.date_format(ts, DATE_FORMAT)


def format_date_key(ts: Column) -> Column:
    return F.date_format(ts, DATE_KEY_FORMAT)


def parse_date_key(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(DATE_KEY_FORMAT)).cast("date")


def format_minute(ts: Column) -> Column:
    return F.date_format(ts, MINUTE_FORMAT)


def before(a: Column, b: Column) -> Column:
    """True when time text ``a`` is before ``b``; unreadable text is never before."""
    return F.coalesce(parse_time(a) < parse_time(b), F.lit(False))


def after(a: Column, b: Column) -> Column:
    return F.coalesce(parse_time(a) > parse_time(b), F.lit(False))


def minus_seconds(a: Column, b: Column) -> Column:
    """Seconds from ``b`` to ``a``; 0 when either cannot be read."""
    return F.coalesce(F.unix_seconds(parse_time(a)) - F.unix_seconds(parse_time(b)), F.lit(0))


def date_hour(ts: Column) -> Column:
    """``yyyy-MM-dd_HH`` of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd_HH")


def today() -> Column:
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)
