"""Aggregations and de-duplication. All of them combine on the map side first."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_date(df: DataFrame, column: str = "utc", name: str = "max_date") -> DataFrame:
    return df.agg(F.max(column).cast("date").alias(name))


def max_value(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.max(column).alias(name))


def min_value(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.min(column).alias(name))


def scalar(one_row: DataFrame):
    """The single value of a one-row, one-column frame, on the driver."""
    return one_row.first()[0]


def as_of_date(df: DataFrame, column: str) -> date:
    """The newest date in the data, for runs that must not depend on the clock."""
    return scalar(max_date(df, column))


def value_counts(df: DataFrame, columns: Sequence[str], name: str = "count") -> DataFrame:
    """How often each combination occurs, most frequent first."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.col(name).desc(), *columns)


def parameter_catalogue(df: DataFrame, location: str = "locationId", parameter: str = "parameter") -> DataFrame:
    """The parameters each location reports, as sorted text.

    The set holds parameter names only, so it is as small as the catalogue of parameters
    however many rows a location has.
    """
    names = F.array_sort(F.collect_set(parameter))
    return df.groupBy(location).agg(F.array_join(names, ",").alias("parameters"))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest `order` columns, then the greatest rest.

    An aggregate rather than a window, because it combines before the shuffle: a key that
    holds a third of all rows reaches the final task as one row per map task. Comparing the
    whole row makes the choice the same on every run.
    """
    rest = [name for name in df.columns if name not in key and name not in order]
    if len(order) == 1 and not rest:
        # A plain maximum aggregates in a hash table; a struct has to be sorted.
        return df.groupBy(*key).agg(F.max(*order).alias(*order)).select(*df.columns)
    best = F.max(F.struct(*order, *rest)).alias("best")
    return df.groupBy(*key).agg(best).select(
        *[F.col(name) if name in key else F.col(f"best.{name}").alias(name) for name in df.columns]
    )


def tumbling(
    df: DataFrame,
    column: str,
    width: str,
    keys: Sequence[str],
    *aggregates: Column,
) -> DataFrame:
    """Aggregates per fixed window and key; batch and streaming alike."""
    grouped = df.groupBy(F.window(column, width), *keys).agg(*aggregates)
    return grouped.withColumn("window_start", F.col("window.start")).drop("window")


def reading_summary(value: str = "value") -> list[Column]:
    return [
        F.count(F.lit(1)).alias("readings"),
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
    ]
