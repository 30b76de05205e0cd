"""Timestamps: parsing, formatting, and range predicates that reach the scan.

`utc` may be TIMESTAMP (an instant) or TIMESTAMP_NTZ (UTC wall clock); both are accepted.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ISO-8601 with an offset; the fraction is optional.
ISO = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"
ISO_WALL = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
INDIA = "Asia/Kolkata"
INDIA_OFFSET = "+05:30"
INDIA_SHIFT = "INTERVAL '05:30' HOUR TO MINUTE"
INDIA_SECONDS = 19_800
HOUR_SECONDS = 3_600
DAY_SECONDS = 86_400


def parse_instant(text: Column, pattern: str = ISO) -> Column:
    """ISO text to TIMESTAMP; text that does not parse gives NULL instead of failing the job."""
    return F.try_to_timestamp(text, F.lit(pattern))


def utc_text(wall: Column) -> Column:
    """UTC wall clock as ISO text."""
    return F.concat(F.date_format(wall, ISO_WALL), F.lit("+00:00"))


def india_text(wall: Column) -> Column:
    """The same instant written in Indian local time."""
    return F.concat(F.date_format(to_india(wall), ISO_WALL), F.lit(INDIA_OFFSET))


def to_india(wall: Column) -> Column:
    return wall + F.expr(INDIA_SHIFT)


def from_india(wall: Column) -> Column:
    return wall - F.expr(INDIA_SHIFT)


def utc_day(df: DataFrame, column: str) -> Column:
    """The UTC calendar day of the column, whatever the session time zone is."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.col(column).cast("date")
    return F.date_from_unix_date(F.floor(F.unix_seconds(column) / DAY_SECONDS).cast("int"))


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since 1970 in UTC; plain arithmetic, whatever the session time zone is."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        days = F.unix_date(F.col(column).cast("date")).cast("long")
        clock = F.hour(column) * HOUR_SECONDS + F.minute(column) * 60 + F.second(column)
        return days * DAY_SECONDS + clock
    return F.unix_seconds(column)


def wall_of_epoch(seconds: Column) -> Column:
    """Seconds since 1970 as UTC wall clock."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def unix_round_trip(text: Column, pattern: str = ISO) -> Column:
    """Text to epoch seconds and back to text in the session time zone."""
    return F.from_unixtime(F.unix_timestamp(text, pattern))


def midnight(day: date, tz: str = "UTC") -> datetime:
    return datetime.combine(day, time.min, tzinfo=ZoneInfo(tz))


def moment(instant: datetime, data_type: T.DataType) -> Column:
    """A constant of the column's own type.

    A constant of another type would make Spark cast the column, and a cast column is not
    pushed to the scan.
    """
    wall = instant.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(wall).cast("timestamp_ntz")
    return F.lit(f"{wall}+00:00").cast("timestamp")


def half_open(df: DataFrame, column: str, start: datetime, end: datetime | None = None) -> Column:
    """start <= column < end, on the bare column."""
    data_type = df.schema[column].dataType
    inside = F.col(column) >= moment(start, data_type)
    if end is not None:
        inside = inside & (F.col(column) < moment(end, data_type))
    return inside


def year_bounds(as_of: date, years: int = 2, tz: str = "UTC") -> tuple[datetime, datetime]:
    """First instant of the oldest kept calendar year and of the year after `as_of`."""
    return (
        midnight(date(as_of.year - years + 1, 1, 1), tz),
        midnight(date(as_of.year + 1, 1, 1), tz),
    )


def days_before(as_of: date, days: int, tz: str = "UTC") -> datetime:
    return midnight(as_of - timedelta(days=days), tz)
