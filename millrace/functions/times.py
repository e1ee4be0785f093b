"""Event-time expressions. Every look-back takes an explicit ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_date(text: str | dt.date) -> dt.date:
    """A date from YYYY-MM-DD; anything else is a ValueError."""
    if isinstance(text, dt.date):
        return text
    return dt.datetime.strptime(text, "%Y-%m-%d").date()


def as_column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def event_time(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds or any timestamp flavour -> timestamp."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.timestamp_millis(F.col(name).cast("long"))
    return F.col(name).cast("timestamp")


# A whole date, a time of hours and minutes at least, and a zone if any.
ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text with a full date, with or without time and zone; else null.

    A cast alone would take a bare time for today, and a bare year for a date.
    """
    plain = F.trim(text)
    return F.when(plain.rlike(ISO_TIME), plain.try_cast("timestamp"))


def wall_time(ts: Column) -> Column:
    """Timestamp as it reads in UTC, without a zone."""
    return ts.cast("timestamp_ntz")


def on_day(ts: Column, day: str | dt.date) -> Column:
    """Half-open day range: a plain comparison the Parquet scan can use."""
    start = parse_date(day)
    end = start + dt.timedelta(days=1)
    return (ts >= F.lit(start.isoformat()).cast("timestamp")) & (
        ts < F.lit(end.isoformat()).cast("timestamp")
    )


def between_dates(column: Column, start: str | dt.date, end: str | dt.date) -> Column:
    """Inclusive date range."""
    first, last = parse_date(start), parse_date(end)
    if first > last:
        raise ValueError("start date must not be after end date")
    return column.between(F.lit(first), F.lit(last))


def last_days(column: Column, as_of: object, days: int) -> Column:
    return column >= as_column(as_of).cast("date") - F.make_dt_interval(F.lit(days))


def last_hours(column: Column, as_of: object, hours: int) -> Column:
    return column >= as_column(as_of).cast("timestamp") - F.make_dt_interval(
        F.lit(0), F.lit(hours)
    )


def minutes_before(as_of: object, minutes: int) -> Column:
    return as_column(as_of).cast("timestamp") - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(minutes)
    )


def window_minutes(start: Column, end: Column) -> Column:
    """Span in minutes, two digits, half away from zero."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    exact = micros.cast("decimal(18,0)") / F.lit(60_000_000).cast("decimal(8,0)")
    return F.round(exact, 2).cast("double")


def floor_minutes(ts: Column, minutes: int) -> Column:
    """Start of the N-minute bucket a timestamp falls in."""
    step = minutes * 60_000_000
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step)))


def rebase(ts: Column, target: str | dt.date) -> Column:
    """Keep the time of day, move to another date."""
    midnight = F.lit(parse_date(target).isoformat()).cast("timestamp")
    return midnight + (ts - F.date_trunc("day", ts))
