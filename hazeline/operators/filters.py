"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.timestamps import (
    DAY_SECONDS,
    HOUR_SECONDS,
    INDIA,
    INDIA_SECONDS,
    days_before,
    epoch_seconds,
    half_open,
    moment,
    utc_day,
    year_bounds,
)
from hazeline.schemas import DAY

RETENTION_DAYS = 730
REFERENCE = "reference"
COMMUNITY = "community"


def recent_years(
    df: DataFrame, column: str, as_of: date, years: int = 2, tz: str = "UTC"
) -> DataFrame:
    """Rows of the last `years` calendar years up to the one of `as_of`.

    Written as a range on the bare column, so the scan skips what lies outside; a frame with
    the warehouse's day partition is pruned to the days of the range as well.
    """
    start, end = year_bounds(as_of, years, tz)
    return in_range(df, column, start, end)


def recent_years_by_year(df: DataFrame, column: str, as_of: date, years: int = 2) -> DataFrame:
    """The same rows asked for by `year(column)`; the scan cannot use this form to skip."""
    newest = F.lit(as_of.year)
    return df.filter(F.year(column).between(newest - (years - 1), newest))


def in_range(df: DataFrame, column: str, start: datetime, end: datetime | None = None) -> DataFrame:
    """start <= column < end, pruning the day partition where there is one."""
    kept = df.filter(half_open(df, column, start, end))
    if DAY in df.columns and column != DAY:
        kept = kept.filter(F.col(DAY) >= F.lit(start.astimezone(timezone.utc).date()))
        if end is not None:
            last = end - timedelta(microseconds=1)
            kept = kept.filter(F.col(DAY) <= F.lit(last.astimezone(timezone.utc).date()))
    return kept


def india_window(df: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    """Rows of a half-open window given in Indian wall-clock time."""
    zone = ZoneInfo(INDIA)
    return in_range(df, column, start.replace(tzinfo=zone), end.replace(tzinfo=zone))


def kept_by_age(
    df: DataFrame, column: str, as_of: date, days: int = RETENTION_DAYS, *, undated: bool = False
) -> DataFrame:
    """Rows at most `days` calendar days old on `as_of`; with `undated` also those without a time,
    which a table that is rewritten by this rule would lose otherwise."""
    if not undated:
        return in_range(df, column, days_before(as_of, days))
    return df.filter(half_open(df, column, days_before(as_of, days)) | F.col(column).isNull())


def expired_by_age(df: DataFrame, column: str, as_of: date, days: int = RETENTION_DAYS) -> DataFrame:
    """The complement of `kept_by_age` over rows with a timestamp."""
    cutoff = days_before(as_of, days)
    expired = df.filter(F.col(column) < moment(cutoff, df.schema[column].dataType))
    if DAY in df.columns and column != DAY:
        expired = expired.filter(F.col(DAY) < F.lit(cutoff.date()))
    return expired


def age_in_days(df: DataFrame, column: str, as_of: date) -> Column:
    return F.date_diff(F.lit(as_of), utc_day(df, column))


def sensor_class(location: Column, reference_ids: Iterable[int]) -> Column:
    """Reference-grade or community, by a fixed set of ids."""
    return F.when(location.isin(list(reference_ids)), REFERENCE).otherwise(COMMUNITY)


def india_hour(df: DataFrame, column: str) -> Column:
    """Hour of the Indian day a row falls in."""
    second_of_day = F.pmod(epoch_seconds(df, column) + INDIA_SECONDS, F.lit(DAY_SECONDS))
    return F.floor(second_of_day / HOUR_SECONDS).cast("int")
