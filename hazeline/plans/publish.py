"""Extracts of the warehouse for readers outside Spark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.timestamps import year_bounds
from hazeline.operators.filters import in_range, recent_years
from hazeline.schemas import DAY, WAREHOUSE
from hazeline.scratch import discard, exists, mark, subfolders
from hazeline.sources.files import CSV_OPTIONS, read_csv, write_csv
from hazeline.sources.landing import read_or_empty


def latest_extract(stored: DataFrame, as_of: date, years: int = 2) -> DataFrame:
    """The rolling calendar-year extract in its published columns."""
    return recent_years(stored, "utc", as_of, years).drop(DAY)


def publish_copies(
    df: DataFrame, targets: Sequence[str], *, header: bool = True, staged: str | None = None
) -> None:
    """The same rows to several folders.

    A filtered scan is cheaper to run again than to keep on the executors, and one frame
    reads the same files each time. A frame with shuffles behind it is worth a `staged`
    path: its rows are written there once and every copy is made from them.
    """
    source = df
    if staged is not None:
        df.write.mode("overwrite").orc(staged)
        source = df.sparkSession.read.schema(df.schema).orc(staged)
    for target in targets:
        write_csv(source, target, header=header)


def publish_days(rows: DataFrame, path: str, as_of: date, years: int = 2) -> None:
    """Publish whole days of the rolling range: each day in `rows` replaces that day in the
    extract, and day folders that have left the range are removed."""
    (
        in_range(rows, "utc", *year_bounds(as_of, years))
        .hint("rebalance", F.col(DAY))
        .sortWithinPartitions(DAY)
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy(DAY)
        .csv(path)
    )
    first, end = (bound.date() for bound in year_bounds(as_of, years))
    for folder in subfolders(rows.sparkSession, path):
        day = folder.removeprefix(f"{DAY}=")
        if folder != day and not str(first) <= day < str(end):
            discard(rows.sparkSession, f"{path}/{folder}")


def read_published_days(spark: SparkSession, path: str) -> DataFrame:
    """The extract by day folders."""
    return read_or_empty(lambda: read_csv(spark, path, WAREHOUSE, header=True), spark, WAREHOUSE)


# Stands in a target once every stored day was published there; readers pass over it.
WHOLE = "_published"


def publish_touched(stored: DataFrame, touched: DataFrame | None, path: str, as_of: date, years: int = 2) -> None:
    """Publish the touched days; all stored ones where the target was never published whole.

    `touched` are the stored rows of those days, None where there are none; then only days that
    have left the range go.
    """
    spark = stored.sparkSession
    if not exists(spark, f"{path}/{WHOLE}"):
        publish_days(stored, path, as_of, years)
        mark(spark, f"{path}/{WHOLE}")
    else:
        publish_days(stored.limit(0) if touched is None else touched, path, as_of, years)
