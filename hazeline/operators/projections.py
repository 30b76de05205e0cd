"""Projections of nested measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.timestamps import parse_instant


def canonical(records: DataFrame) -> DataFrame:
    """The four kept columns; `utc` is still text."""
    return records.select("locationId", "date.utc", "parameter", "value")


def local_with_unit(records: DataFrame) -> DataFrame:
    """The older five columns, local time still text."""
    return records.select("location", "date.local", "parameter", "unit", "value")


def local_parsed(records: DataFrame) -> DataFrame:
    """The older five columns with the local time as an instant."""
    return records.withColumn("local_time", parse_instant(F.col("date.local"))).select(
        "location", "local_time", "parameter", "unit", "value"
    )


def flattened(records: DataFrame, drop: tuple[str, ...] = ("country", "city")) -> DataFrame:
    """Struct fields as columns of their own, without the structs and the unneeded columns."""
    return (
        records.withColumn("local_timestamp", F.col("date.local"))
        .withColumn("latitude", F.col("coordinates.latitude"))
        .withColumn("longitude", F.col("coordinates.longitude"))
        .drop("date", "coordinates", *drop)
    )
