"""Aggregates kept next to the warehouse and refreshed by day.

The state is one row per sensor, parameter and 3-hour window: count, sum and greatest value, all
of which merge. It lies in day folders like the warehouse, so a load refreshes the folders of the
days it touched and no others. Days, years and whole series are sums over the state, without
reading a measurement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.operators.aggregates import tumbling
from hazeline.plans.warehouse import read_warehouse, touched
from hazeline.schemas import DAY
from hazeline.sources.files import read_orc

SENSOR = ["locationId", "parameter"]
STATE = T.StructType(
    [
        T.StructField("locationId", T.LongType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("readings", T.LongType()),
        T.StructField("valued", T.LongType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("greatest", T.DoubleType()),
        T.StructField("newest", T.TimestampType()),
        T.StructField(DAY, T.DateType()),
    ]
)


def state_of(stored: DataFrame) -> DataFrame:
    """The state of warehouse rows. NULL values are readings without a value."""
    windows = tumbling(
        stored, "utc", "3 hours", [*SENSOR, DAY],
        F.count(F.lit(1)).alias("readings"),
        F.count("value").alias("valued"),
        F.sum("value").alias("total"),
        F.max("value").alias("greatest"),
        F.max("utc").alias("newest"),
    )
    return windows.select(*STATE.names)


def refresh(spark: SparkSession, warehouse: str, path: str, batch: DataFrame | None = None) -> None:
    """Bring the state up to the warehouse for the days a loaded batch has rows in, or for all.

    `batch` is evaluated more than once, so pass a staged table. Days are replaced as a whole, so
    a refresh that is repeated changes nothing.
    """
    stored = read_warehouse(spark, warehouse)
    rows = stored if batch is None else touched(stored, batch)
    if rows is None:
        return
    (
        state_of(rows)
        .hint("rebalance", F.col(DAY))
        .sortWithinPartitions(DAY, *SENSOR, "window_start")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if batch is None else "dynamic")
        .partitionBy(DAY)
        .orc(path)
    )


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return read_orc(spark, path, STATE)


def merged() -> list[Column]:
    """State columns of a coarser level; the mean comes from sums, never from means."""
    return [
        F.sum("readings").alias("readings"),
        F.sum("total").alias("total"),
        (F.sum("total") / F.nullif(F.sum("valued"), F.lit(0))).alias("mean"),
        F.max("greatest").alias("greatest"),
        F.max("newest").alias("newest"),
    ]


def by_day(state: DataFrame) -> DataFrame:
    return state.groupBy(*SENSOR, DAY).agg(*merged())


def by_year(state: DataFrame) -> DataFrame:
    return state.groupBy(*SENSOR, F.year(DAY).alias("year")).agg(*merged())


def newest(state: DataFrame) -> DataFrame:
    """The newest instant and year of all, from the state alone."""
    return state.agg(F.max("newest").alias("max_utc"), F.year(F.max("newest")).alias("max_year"))
