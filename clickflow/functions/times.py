"""Date and time helpers on wall-clock values."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats. The parse pattern also accepts one-digit parts.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
PARSE_FORMAT = "yyyy-M-d H:m:s"


def parse_time(col: Column) -> Column:
    """Text to timestamp; text that does not parse gives null."""
    return F.try_to_timestamp(col, F.lit(PARSE_FORMAT)).cast("timestamp_ntz")


def parse_time_strict(col: Column) -> Column:
    """Text to timestamp; text that does not parse raises."""
    return F.to_timestamp_ntz(col, F.lit(PARSE_FORMAT))


def format_date(col: Column) -> Column:
    """``yyyy-MM-dd`` text; no zone is involved for wall-clock values."""
    return col.cast("date").cast("string")


def format_time(col: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text, fractions of a second cut off."""
    return F.substring(col.cast("string"), 1, len(TIME_FORMAT))


def before(first: Column, second: Column) -> Column:
    """Whether time text ``first`` precedes ``second``; false if either is malformed."""
    return F.coalesce(parse_time(first) < parse_time(second), F.lit(False))


def after(first: Column, second: Column) -> Column:
    return F.coalesce(parse_time(first) > parse_time(second), F.lit(False))


def seconds_between(end: Column, start: Column) -> Column:
    """Whole seconds from ``start`` to ``end`` for timestamps."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minus(first: Column, second: Column) -> Column:
    """``first - second`` of two time texts in whole seconds; 0 if either is malformed."""
    gap = seconds_between(parse_time(first), parse_time(second))
    return F.coalesce(gap, F.lit(0)).cast("int")


def date_hour(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to ``yyyy-MM-dd_HH``, textually."""
    clock = F.split_part(text, F.lit(" "), F.lit(2))
    return F.concat(
        F.split_part(text, F.lit(" "), F.lit(1)),
        F.lit("_"),
        F.split_part(clock, F.lit(":"), F.lit(1)),
    )


def today(day: Column = None) -> Column:
    """Current date as text; ``day`` replaces the clock."""
    return format_date(F.current_date() if day is None else day)


def yesterday(day: Column = None) -> Column:
    return format_date(F.date_sub(F.current_date() if day is None else day, 1))


def as_date(value):
    """``yyyy-MM-dd`` text or a date to a date; None stays None."""
    if value is None or isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)
