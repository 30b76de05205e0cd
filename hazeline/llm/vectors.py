"""Vectors of whole numbers out of float embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def whole(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * c) of every component c, taken as a double; -0.0 becomes 0."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint"))


def usable(vector: str) -> Column:
    """Whether a vector and all its components are there and finite."""
    bad = F.exists(
        vector,
        lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf"))),
    )
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def whole_vectors(rows: DataFrame, vector: str, key: str, scale: int = SCALE) -> DataFrame:
    """key and x, for the rows whose vector is usable."""
    return rows.filter(usable(vector)).select(F.col(key).cast("bigint").alias("key"), whole(vector, scale).alias("x"))
