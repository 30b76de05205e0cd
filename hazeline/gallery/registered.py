"""Registration: a Spark query next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The tables hold UTC wall-clock times; casting them needs the session in UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return wall_clock(query(spark, sf_dir))

        _QUERIES[query.__name__] = run
        if sql is not None:
            _SQL[query.__name__] = sql
        return run

    return register


def wall_clock(df: DataFrame) -> DataFrame:
    """Instants back to the tables' own UTC wall-clock type."""
    return df.select(
        *[
            F.col(field.name).cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else F.col(field.name)
            for field in df.schema
        ]
    )


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
