"""Completeness: planned fetch cells against the rows that arrived."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.functions.timestamps import (
    DAY_SECONDS,
    HOUR_SECONDS,
    INDIA_SECONDS,
    epoch_seconds,
    wall_of_epoch,
)
from hazeline.operators.filters import REFERENCE, sensor_class
from hazeline.plans.fetch import EVENING_HOUR, SLICE_HOURS, checked_hours

CELL = ["locationId", "parameter", "from_utc"]


def filled_cells(
    measurements: DataFrame, reference_ids: Iterable[int], *, sliced: bool = False
) -> DataFrame:
    """The fetch cells that have at least one row.

    Each row computes the start of the cell it falls in, so the comparison with the plan is
    an equality on the cell and never a range join. Community rows outside the evening
    window belong to no daily cell.
    """
    local = epoch_seconds(measurements, "utc") + INDIA_SECONDS
    second_of_day = F.pmod(local, F.lit(DAY_SECONDS))
    day = local - second_of_day
    if sliced:
        community = local - F.pmod(local, F.lit(SLICE_HOURS * HOUR_SECONDS))
    else:
        evening = EVENING_HOUR * HOUR_SECONDS
        community = F.when(second_of_day >= evening, day + evening)
    is_reference = sensor_class(F.col("locationId"), reference_ids) == REFERENCE
    start = F.when(is_reference, day).otherwise(community) - INDIA_SECONDS
    # Whole numbers until the cells are distinct; few are left to turn into timestamps.
    cells = (
        measurements.select("locationId", "parameter", start.alias("start"))
        .filter(F.col("start").isNotNull())
        .distinct()
    )
    return cells.select("locationId", "parameter", wall_of_epoch(F.col("start")).alias("from_utc"))


def gap_cells(plan: DataFrame, filled: DataFrame) -> DataFrame:
    """Planned cells without a single row."""
    return plan.join(filled, CELL, "left_anti")


def completeness(plan: DataFrame, filled: DataFrame) -> DataFrame:
    """Planned and filled cells per sensor, and the filled share."""
    marked = plan.join(filled.withColumn("has_rows", F.lit(1)), CELL, "left")
    return (
        marked.groupBy("locationId", "parameter")
        .agg(
            F.count(F.lit(1)).alias("planned"),
            F.count("has_rows").alias("filled"),
        )
        .withColumn("share", F.col("filled") / F.col("planned"))
    )


def gap_runs(
    measurements: DataFrame, sensors: DataFrame, start: date, end: date, hours: int = SLICE_HOURS
) -> DataFrame:
    """Unbroken runs of cells without a row, for sensors expected around the clock.

    Cells are `hours` wide and lie in the Indian days of [start, end); a run is one row however
    long it is: locationId, parameter, from_utc, to_utc, cells. No plan is expanded: the distinct
    filled cells of a sensor, and one before the range and one after it, are put in order, and
    where two neighbours are not next to each other there is a run between them. A sensor without
    rows is one run. Cells are made distinct before they are sorted, so a sensor with many rows
    has no more of them than the range has cells.
    """
    width = checked_hours(hours) * HOUR_SECONDS
    epoch = date(1970, 1, 1)
    low, high = ((day - epoch).days * DAY_SECONDS // width for day in (start, end))
    pair = ["locationId", "parameter"]
    cell = F.floor((epoch_seconds(measurements, "utc") + INDIA_SECONDS) / width).cast("long")
    filled = (
        measurements.select(*pair, cell.alias("cell"))
        .filter((F.col("cell") >= low) & (F.col("cell") < high))
        .distinct()
        .join(sensors.select(*pair).distinct(), pair, "left_semi")
    )
    edges = sensors.select(*pair, F.explode(F.array(F.lit(low - 1), F.lit(high)).cast("array<long>")).alias("cell"))
    in_order = Window.partitionBy(*pair).orderBy("cell")
    following = F.lead("cell").over(in_order)
    marks = filled.union(edges).distinct().filter(F.lit(low < high))
    runs = marks.withColumn("next", following).filter(F.col("next") > F.col("cell") + 1)
    return runs.select(
        *pair,
        wall_of_epoch((F.col("cell") + 1) * width - INDIA_SECONDS).alias("from_utc"),
        wall_of_epoch(F.col("next") * width - INDIA_SECONDS).alias("to_utc"),
        (F.col("next") - F.col("cell") - 1).alias("cells"),
    )
