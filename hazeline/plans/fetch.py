"""What to fetch next: day spines, slices, and the plan per sensor."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.paths import landing_path, request_text
from hazeline.functions.timestamps import from_india
from hazeline.operators.filters import REFERENCE

# Community sensors are asked for 21:00 to midnight, or in 3-hour slices.
EVENING_HOUR = 21
SLICE_HOURS = 3


def _days(start: date, end: date) -> Column:
    # A sequence that runs backwards is an error or a surprise, so it never gets the chance.
    last = max(start, end - timedelta(days=1))
    return F.sequence(F.lit(start), F.lit(last), F.expr("INTERVAL 1 DAY"))


def _with_days(df: DataFrame, start: date, end: date) -> DataFrame:
    """Every row once per day of [start, end); no rows when nothing is owed."""
    return df.filter(F.lit(start < end)).withColumn("day", F.explode(_days(start, end)))


def day_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Consecutive (date_from, date_to) pairs from `start` up to, but without, `end`."""
    days = _with_days(spark.range(1), start, end)
    return days.select(
        F.col("day").alias("date_from"), F.date_add("day", 1).alias("date_to")
    )


def slice_spine(spark: SparkSession, start: date, end: date, hours: int = SLICE_HOURS) -> DataFrame:
    """Every day of [start, end) cut into slices of `hours`."""
    return _with_slices(_with_days(spark.range(1), start, end), hours).select(
        "slice_from", (F.col("slice_from") + F.make_dt_interval(hours=F.lit(hours))).alias("slice_to")
    )


def checked_hours(hours: int) -> int:
    if not 0 < hours <= 24 or 24 % hours:
        raise ValueError(f"slices of {hours} hours do not divide a day")
    return hours


def _spread(registry: DataFrame, tasks: int | None) -> DataFrame:
    # A registry is small enough to end up in a few tasks, and its expansion is not. A plain
    # count, because partitions by key may be merged again when they are small.
    return registry if tasks is None else registry.repartition(tasks)


def _with_slices(days: DataFrame, hours: int) -> DataFrame:
    hours = checked_hours(hours)
    midnight = F.col("day").cast("timestamp_ntz")
    slices = F.sequence(
        midnight,
        midnight + F.make_dt_interval(hours=F.lit(24 - hours)),
        F.make_dt_interval(hours=F.lit(hours)),
    )
    return days.withColumn("slice_from", F.explode(slices))


def fetch_start(
    high_water: date | None, bootstrap_start: date, lookback_days: int = 0
) -> date:
    """First day owed: the last loaded day again, earlier with a lookback for late rows."""
    if high_water is None:
        return bootstrap_start
    return high_water - timedelta(days=lookback_days)


def daily_plan(
    registry: DataFrame, start: date, end: date, *, tasks: int | None = None
) -> DataFrame:
    """One fetch per sensor, parameter and Indian day of [start, end).

    Reference-grade sensors get the whole day, community sensors its last three hours. Each
    registry row is expanded in place, so there is no join. `tasks` spreads a large registry
    over that many tasks before a long range multiplies it.
    """
    planned = _with_days(_spread(registry, tasks), start, end)
    midnight = F.col("day").cast("timestamp_ntz")
    opening = F.when(F.col("sensor_class") == REFERENCE, 0).otherwise(EVENING_HOUR)
    return _as_plan(
        planned.withColumn("local_from", midnight + F.make_dt_interval(hours=opening)).withColumn(
            "local_to", F.date_add("day", 1).cast("timestamp_ntz")
        )
    )


def sliced_plan(
    registry: DataFrame,
    start: date,
    end: date,
    hours: int = SLICE_HOURS,
    *,
    tasks: int | None = None,
) -> DataFrame:
    """As `daily_plan`, with community sensors asked for all day in slices."""
    planned = _with_days(_spread(registry, tasks), start, end)
    hours = checked_hours(hours)
    whole = F.array(F.lit(0))
    cut = F.array(*[F.lit(hour) for hour in range(0, 24, hours)])
    is_reference = F.col("sensor_class") == REFERENCE
    opened = planned.withColumn("opening", F.explode(F.when(is_reference, whole).otherwise(cut)))
    midnight = F.col("day").cast("timestamp_ntz")
    length = F.when(is_reference, 24).otherwise(hours)
    return _as_plan(
        opened.withColumn("local_from", midnight + F.make_dt_interval(hours="opening"))
        .withColumn("local_to", F.col("local_from") + F.make_dt_interval(hours=length))
        .drop("opening")
    )


def _as_plan(planned: DataFrame) -> DataFrame:
    return planned.withColumn("from_utc", from_india(F.col("local_from"))).withColumn(
        "to_utc", from_india(F.col("local_to"))
    )


def with_requests(plan: DataFrame) -> DataFrame:
    """The plan with the query string of each fetch and the file its result lands in."""
    return plan.withColumn(
        "request",
        request_text(
            F.col("locationId"), F.col("parameter"), F.col("local_from"), F.col("local_to")
        ),
    ).withColumn("path", landing_path(F.col("day"), F.col("locationId"), F.col("parameter")))
