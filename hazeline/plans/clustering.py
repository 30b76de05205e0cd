"""Compaction along a curve over sensor and hour, so that files can be passed over by either."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.plans.warehouse import SWAP, day_files, finish_swap, read_warehouse, swap_ready
from hazeline.schemas import DAY, KEY, WAREHOUSE

# Steps of each axis as a power of two: 32 groups of sensors by 32 parts of a day.
AXIS_BITS = 5


def sensor_bounds(rows: DataFrame, bits: int = AXIS_BITS) -> list[int]:
    """Bounds between groups of sensors with about as many rows each, at most 2 ** bits - 1.

    A sensor with very many rows is a group of its own; the parts of the day still split it.
    """
    steps = 1 << bits
    shares = [step / steps for step in range(1, steps)]
    bounds = rows.agg(F.percentile_approx("locationId", shares)).first()[0]
    return sorted(set(bounds or []))


def curve_key(bounds: list[int], bits: int = AXIS_BITS) -> Column:
    """Sensor group and part of the day with their bits interleaved, the sensor's bit first.

    Rows near each other on the curve share most leading bits of both, so a stretch of it is a
    few sensors over a few hours. Without a sensor, or a time, a row is in the first group.
    """
    above = [(F.col("locationId") > bound).cast("int") for bound in bounds]
    sensor = F.coalesce(reduce(add, above, F.lit(0)), F.lit(0))
    second = F.unix_micros("utc") % 86_400_000_000
    part = F.coalesce((F.pmod(second, F.lit(86_400_000_000)) * (1 << bits) / 86_400_000_000).cast("int"), F.lit(0))
    pieces = [
        F.shiftleft(F.shiftright(axis, bit).bitwiseAND(F.lit(1)), 2 * bit + place)
        for bit in range(bits)
        for axis, place in ((part, 0), (sensor, 1))
    ]
    return reduce(add, pieces)


def _by_month(days: list[date]) -> Iterator[list[date]]:
    months: dict[tuple[int, int], list[date]] = {}
    for day in sorted(days):
        months.setdefault((day.year, day.month), []).append(day)
    yield from months.values()


def compact_clustered(
    spark: SparkSession, path: str, days: list[date], *, target_bytes: int = 128 << 20
) -> None:
    """Rewrite days into files of about `target_bytes` along the curve, rows unchanged; a month
    at a time, each put in place by a swap that the next load finishes if it dies.

    Files are cut by ranges of day, curve and key. As the key is part of the range, neither a
    hot sensor nor a hot hour is left in one task.
    """
    finish_swap(spark, path)
    for listed in _by_month(days):
        size = day_files(spark, path).filter(F.col(DAY).isin(listed)).agg(F.sum("bytes")).first()[0]
        if not size:
            continue
        stored = read_warehouse(spark, path).filter(F.col(DAY).isin(listed))
        keyed = stored.withColumn("curve", curve_key(sensor_bounds(stored)))
        order = [DAY, "curve", *KEY]
        (
            keyed.repartitionByRange(-(-size // target_bytes), *order)
            .sortWithinPartitions(*order)
            .select(*WAREHOUSE.names)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(DAY)
            .orc(f"{path}/{SWAP}")
        )
        swap_ready(spark, path, keep_files=True)
        finish_swap(spark, path)


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    """What each file spans: path, day, rows, first and last sensor and instant. A reader of a
    sensor and a time opens the files whose spans hold both."""
    stored = read_warehouse(spark, path).select("*", F.col("_metadata.file_path").alias("path"))
    return stored.groupBy("path", DAY).agg(
        F.count(F.lit(1)).alias("readings"),
        F.min("locationId").alias("first_sensor"),
        F.max("locationId").alias("last_sensor"),
        F.min("utc").alias("first_utc"),
        F.max("utc").alias("last_utc"),
    )
