"""Sources, sinks and tables: what is written must come back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.paths import level_key
from hazeline.functions.timestamps import parse_instant
from hazeline.gallery.adapters import (
    M_SQL,
    RECORDS_SQL,
    dated_records,
    events,
    instants,
    measurements,
    records,
)
from hazeline.gallery.registered import registered
from hazeline.operators import aggregates
from hazeline.operators.filters import kept_by_age
from hazeline.plans.publish import latest_extract, publish_copies
from hazeline.plans.warehouse import read_warehouse, write_days
from hazeline.schemas import MEASUREMENT, RECORD
from hazeline.scratch import new_dir
from hazeline.sources import files, landing, tables

_M = f"WITH {M_SQL} SELECT * FROM m"
_M_WITHOUT_DAMAGED = f"WITH {M_SQL} SELECT * FROM m WHERE parameter <> 'error'"
READING_TABLE = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("local_date", T.TimestampType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("reading", T.DoubleType()),
    ]
)


def _canonical(read: DataFrame) -> DataFrame:
    return read.select("locationId", parse_instant(F.col("date.utc")).alias("utc"), "parameter", "value")


@registered(
    f"""WITH {RECORDS_SQL}
SELECT "locationId", location, parameter, value, ts AS utc, local_text AS "local", unit,
  CAST(latitude AS DOUBLE) AS latitude FROM r"""
)
def scan_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "nested")
    landing.write_array_files(records(spark, sf_dir), path)
    return landing.read_records(spark, path, glob="part-*").select(
        "locationId",
        "location",
        "parameter",
        "value",
        parse_instant(F.col("date.utc")).alias("utc"),
        "date.local",
        "unit",
        "coordinates.latitude",
    )


@registered(
    f"""WITH {M_SQL}
SELECT strftime(utc, '%Y') AS yr, strftime(utc, '%m') AS mnt, strftime(utc, '%d') AS dy,
  parameter AS par, "locationId", count(*) AS readings, round(sum(value), 2) AS total
FROM m GROUP BY ALL"""
)
def scan_landing_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "tree")
    levels = ["yr", "mnt", "dy", "par"]
    landing.write_landing(dated_records(events(spark, sf_dir)), path, "day", levels)
    read = landing.read_records(spark, path, array_files=False)
    keyed = read.select(
        "locationId",
        "value",
        *[level_key(F.col("source_file"), name).alias(name) for name in levels],
    )
    return keyed.groupBy(*levels, "locationId").agg(
        F.count(F.lit(1)).alias("readings"), F.round(F.sum("value"), 2).alias("total")
    )


@registered(
    f"""WITH {M_SQL}
SELECT strftime(utc, '%Y') AS yr, strftime(utc, '%m') AS mnt, strftime(utc, '%d') AS dy,
  count(*) AS readings FROM m GROUP BY ALL"""
)
def landing_partitioned_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "tree")
    levels = ["yr", "mnt", "dy"]
    landing.write_landing(dated_records(events(spark, sf_dir)), path, "day", levels)
    # Declared as text, the folder names keep their leading zeros.
    schema = T.StructType([*RECORD.fields, *[T.StructField(name, T.StringType()) for name in levels]])
    read = spark.read.schema(schema).json(path)
    return read.groupBy(*levels).agg(F.count("locationId").alias("readings"))


@registered(_M)
def roundtrip_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "orc")
    files.write_orc(instants(measurements(spark, sf_dir)).drop("utc_date"), path)
    return files.read_orc(spark, path, MEASUREMENT)


@registered(_M)
def roundtrip_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "csv")
    files.write_csv(instants(measurements(spark, sf_dir)).drop("utc_date"), path)
    text = files.read_csv_text(spark, path)
    return text.select(*[F.col(field.name).cast(field.dataType) for field in MEASUREMENT])


@registered(
    f"WITH {RECORDS_SQL} SELECT location AS city, ts AS local_time, parameter, unit, value FROM r"
)
def roundtrip_csv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "csv")
    rows = records(spark, sf_dir).select(
        F.col("location").alias("city"),
        parse_instant(F.col("date.local")).alias("local_time"),
        "parameter",
        "unit",
        "value",
    )
    files.write_csv(rows, path, header=False, mode="append")
    ddl = "city STRING, local_time TIMESTAMP, parameter STRING, unit STRING, value DOUBLE"
    return files.read_csv(spark, path, ddl)


@registered(_M)
def external_table_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "latest")
    files.write_csv(instants(measurements(spark, sf_dir)).drop("utc_date"), path)
    return tables.external_csv_table(spark, "hazeline_latest", MEASUREMENT, path)


def _staging_view(spark: SparkSession, sf_dir: str) -> str:
    staging = records(spark, sf_dir).select(
        F.col("location").alias("city"),
        F.col("date.local").alias("local_date"),
        "parameter",
        "unit",
        F.col("value").alias("reading"),
    )
    staging.createOrReplaceTempView("hazeline_staging")
    return "hazeline_staging"


@registered(
    f"""WITH {RECORDS_SQL}
SELECT location AS city, date_trunc('second', ts) AS local_date, parameter, unit, value AS reading
FROM r"""
)
def insert_select_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"hazeline_data_{uuid4().hex}"
    tables.orc_table(spark, name, READING_TABLE, new_dir(spark, "data"))
    tables.insert_readings(spark, name, _staging_view(spark, sf_dir))
    return spark.table(name)


_DATASET = "SELECT city, parameter, count(*) AS readings, max(local_date) AS newest"


@registered(
    f"""WITH {RECORDS_SQL}
SELECT location AS city, parameter, count(*) AS readings, max(local_text) AS newest
FROM r GROUP BY ALL"""
)
def table_ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = f"{_DATASET} FROM {_staging_view(spark, sf_dir)} GROUP BY city, parameter"
    return tables.create_table_as(spark, "hazeline_dataset", query, new_dir(spark, "dataset"))


@registered(_M)
def table_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instants(measurements(spark, sf_dir)).drop("utc_date")
    return tables.save_table(rows, "hazeline_recent", new_dir(spark, "recent"))


@registered(
    """SELECT token, count(*) AS parts FROM (
  SELECT unnest(string_split(p_name, ' ')) AS token FROM part
) GROUP BY token"""
)
def delimited_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "delimited")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", F.split("p_name", " ").alias("tokens")
    )
    files.write_delimited(part, path)
    tables.delimited_view(spark, "hazeline_tokens", part.schema, path)
    return spark.sql(
        "SELECT token, count(*) AS parts FROM hazeline_tokens "
        "LATERAL VIEW explode(tokens) AS token GROUP BY token"
    )


@registered(_M)
def json_explode_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "arrays")
    landing.bounded_arrays(records(spark, sf_dir)).withColumnRenamed("records", "data").write.json(path)
    schema = T.StructType([T.StructField("data", T.ArrayType(RECORD))])
    read = landing.read_records(
        spark, path, array_files=False, mode="DROPMALFORMED", schema=schema
    )
    return _canonical(read.select(F.inline("data")))


@registered(
    f"""WITH {RECORDS_SQL}
SELECT "locationId", parameter, unit, local_text AS "local", value FROM r"""
)
def external_table_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "arrays")
    landing.bounded_arrays(records(spark, sf_dir)).withColumnRenamed("records", "data").write.json(path)
    schema = T.StructType([T.StructField("data", T.ArrayType(RECORD))])
    tables.external_json_table(spark, "hazeline_staging_json", schema, path)
    return spark.sql(
        "SELECT m.locationId, m.parameter, m.unit, m.date.local, m.value "
        "FROM hazeline_staging_json LATERAL VIEW explode(data) AS m"
    )


def _damaged_lines(spark: SparkSession, sf_dir: str) -> str:
    """One record per line; those of `error` events are cut off before their end."""
    path = new_dir(spark, "lines")
    rows = records(spark, sf_dir)
    line = F.to_json(F.struct(*rows.columns))
    cut = F.substring(line, F.lit(1), F.length(line) - 20)
    rows.select(
        F.when(F.col("parameter") == "error", cut).otherwise(line).alias("value")
    ).write.text(path)
    return path


@registered(_M_WITHOUT_DAMAGED)
def json_drop_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _damaged_lines(spark, sf_dir)
    return _canonical(
        landing.read_records(spark, path, array_files=False, mode="DROPMALFORMED", glob="part-*")
    )


def _staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "staged")
    lines = _damaged_lines(spark, sf_dir)
    landing.stage(landing.read_records(spark, lines, array_files=False, glob="part-*"), path)
    return landing.read_staged(spark, path)


@registered(_M_WITHOUT_DAMAGED)
def quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.good_rows(_staged_lines(spark, sf_dir)).drop("utc_date")


@registered(
    f"""WITH {RECORDS_SQL}
SELECT 'malformed' AS reason, CAST("locationId" AS VARCHAR) AS location_text, utc_text
FROM r WHERE parameter = 'error'"""
)
def quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.bad_rows(_staged_lines(spark, sf_dir)).select(
        "reason",
        F.regexp_extract("raw", r'"locationId":(\d+)', 1).alias("location_text"),
        F.regexp_extract("raw", r'"utc":"([^"]+)"', 1).alias("utc_text"),
    )


@registered(
    f"""WITH {M_SQL}
SELECT sink, CAST(utc AS DATE) AS utc_date, count(*) AS readings
FROM m CROSS JOIN (VALUES ('first'), ('second')) AS s(sink)
WHERE year(utc) BETWEEN (SELECT year(max(utc)) - 1 FROM m) AND (SELECT year(max(utc)) FROM m)
GROUP BY ALL"""
)
def publish_dual(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measurements(spark, sf_dir)
    warehouse = new_dir(spark, "warehouse")
    write_days(instants(rows), warehouse)
    extract = latest_extract(read_warehouse(spark, warehouse), aggregates.as_of_date(rows, "utc"))
    sinks = {"first": new_dir(spark, "latest"), "second": new_dir(spark, "latest")}
    publish_copies(extract, list(sinks.values()))
    first, second = (
        files.read_csv(spark, path, MEASUREMENT, header=True).withColumn("sink", F.lit(sink))
        for sink, path in sinks.items()
    )
    return (
        first.unionByName(second)
        .groupBy("sink", F.col("utc").cast("date").alias("utc_date"))
        .agg(F.count(F.lit(1)).alias("readings"))
    )


@registered(
    f"""WITH {M_SQL}, d AS (SELECT CAST(max(utc) AS DATE) AS as_of FROM m)
SELECT m.* FROM m, d WHERE date_diff('day', CAST(utc AS DATE), as_of) <= 15"""
)
def rewrite_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measurements(spark, sf_dir)
    as_of = aggregates.as_of_date(rows, "utc")
    path = new_dir(spark, "csv")
    files.write_csv(instants(rows).drop("utc_date"), path, header=False)
    files.rewrite_csv(
        spark, path, MEASUREMENT, lambda stored: kept_by_age(stored, "utc", as_of, days=15)
    )
    return files.read_csv(spark, path, MEASUREMENT)
