"""Named tables and views over the pipeline's files."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hazeline.functions.timestamps import ISO
from hazeline.schemas import ddl_columns
from hazeline.sources.files import CSV_OPTIONS, read_delimited


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _instant(column: str) -> str:
    # NULL, not a failed job, for text that is not a timestamp.
    return f"try_to_timestamp({column}, {_quoted(ISO)})"


def external_csv_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str, *, header: bool = True
) -> DataFrame:
    """External table over a CSV folder, with the columns that were really published.

    A header line is declared, so it is not read as data.
    """
    options = {**CSV_OPTIONS, "header": str(header).lower()}
    return _external_table(spark, name, schema, location, "csv", options)


def external_json_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str
) -> DataFrame:
    """External table over JSON lines, nested columns included; malformed lines are ignored."""
    return _external_table(spark, name, schema, location, "json", {"mode": "DROPMALFORMED"})


def _external_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    source: str,
    options: dict[str, str],
) -> DataFrame:
    listed = ", ".join(f"{_quoted(key)} = {_quoted(value)}" for key, value in options.items())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({ddl_columns(schema)}) USING {source} "
        f"OPTIONS ({listed}) LOCATION {_quoted(location)}"
    )
    return spark.table(name)


def delimited_view(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    *,
    separator: str = ",",
    item_separator: str = "|",
) -> DataFrame:
    """View over delimited text with array columns, which the CSV source itself does not have."""
    rows = read_delimited(
        spark, location, schema, separator=separator, item_separator=item_separator
    )
    rows.createOrReplaceTempView(name)
    return spark.table(name)


def orc_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str | None = None
) -> DataFrame:
    """ORC table, made if it is not there yet; a filled one stays as it is.

    Without a location it is managed and lives in the warehouse folder.
    """
    place = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns(schema)}) USING orc{place}")
    return spark.table(name)


def insert_readings(spark: SparkSession, target: str, staging: str) -> None:
    """Fill a (city, local_date, parameter, unit, reading) table, turning ISO text into TIMESTAMP."""
    spark.sql(
        f"INSERT INTO {target} "
        f"SELECT city, timestamp_seconds(unix_timestamp({_instant('local_date')})) AS local_date, "
        f"parameter, unit, reading FROM {staging}"
    )


def max_year_view(
    spark: SparkSession, name: str, staging: str, *, persistent: bool = False
) -> DataFrame:
    """View holding the newest year of a table whose `local_date` is ISO text.

    A persistent view outlives the session and needs a stored table to look at.
    """
    kind = "" if persistent else "TEMPORARY "
    spark.sql(
        f"CREATE OR REPLACE {kind}VIEW {name} AS "
        f"SELECT max(year(from_unixtime(unix_timestamp({_instant('local_date')})))) AS max_year "
        f"FROM {staging}"
    )
    return spark.table(name)


def save_table(df: DataFrame, name: str, location: str | None = None) -> DataFrame:
    """Save a frame as a table, replacing it; also the refresh of a materialized extract.

    The rows are written to a new folder below `location` (by default, of the warehouse
    folder) before the name is turned to them: a write that fails leaves the old table.
    """
    spark = df.sparkSession
    base = location or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}_versions"
    version = f"{base}/{uuid4().hex}"
    df.write.orc(version)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({ddl_columns(df.schema)}) USING orc LOCATION {_quoted(version)}")
    return spark.table(name)


def create_table_as(
    spark: SparkSession, name: str, query: str, location: str | None = None
) -> DataFrame:
    """A stored query result, refreshed by running it again; as `save_table` replaces it."""
    return save_table(spark.sql(query), name, location)
