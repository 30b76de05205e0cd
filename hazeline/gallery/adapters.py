"""The test tables in the shape of sensor measurements, in Spark and in SQL."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.timestamps import half_open, india_text, midnight, utc_text
from hazeline.operators.aggregates import as_of_date
from hazeline.operators.filters import sensor_class
from hazeline.plans.warehouse import with_day
from hazeline.schemas import RECORD
from hazeline.scratch import new_dir

# User ids that stand for reference-grade stations.
REFERENCE_USERS = (1, 2, 3, 7, 8)
REFERENCE_SQL = "(1, 2, 3, 7, 8)"

# The stored part ends, and the batch begins, this many days before the newest row's day.
BATCH_DAYS = 11

M_SQL = """m AS (
  SELECT user_id AS "locationId", ts AS utc, event_type AS parameter, value FROM events
)"""

# The batch starts on the last stored day, which both parts hold.
SPLIT_SQL = f"""{M_SQL},
d AS (SELECT CAST(max(utc) AS DATE) AS as_of, CAST(max(utc) AS DATE) - {BATCH_DAYS} AS cut FROM m),
stored AS (SELECT m.* FROM m, d WHERE utc < cut + 1),
batch AS (SELECT m.* FROM m, d WHERE utc >= cut)"""

REGISTRY_SQL = f"""registry AS (
  SELECT DISTINCT "locationId", parameter,
    CASE WHEN "locationId" IN {REFERENCE_SQL} THEN 'reference' ELSE 'community' END AS sensor_class
  FROM m
)"""

RECORDS_SQL = r"""r AS (
  SELECT user_id AS "locationId", 'site-' || user_id AS location, event_type AS parameter, value,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS utc_text,
    strftime(ts + INTERVAL '5 hours 30 minutes', '%Y-%m-%dT%H:%M:%S.%f') || '+05:30' AS local_text,
    'µg/m³ ' || regexp_extract(props, '[0-9]+') AS unit,
    user_id * 0.25 AS latitude, user_id * 0.5 AS longitude, ts
  FROM events
)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as measurements, `utc` in the table's own type."""
    return events(spark, sf_dir).select(
        F.col("user_id").alias("locationId"),
        F.col("ts").alias("utc"),
        F.col("event_type").alias("parameter"),
        "value",
    )


def instants(rows: DataFrame) -> DataFrame:
    """The same rows in the warehouse's types, with the day partition."""
    return with_day(rows.withColumn("utc", F.col("utc").cast("timestamp")))


def split(rows: DataFrame, column: str = "utc") -> tuple[DataFrame, DataFrame]:
    """The stored part and a later batch; the batch repeats the last stored day."""
    cut = as_of_date(rows, column) - timedelta(days=BATCH_DAYS)
    stored = rows.filter(~half_open(rows, column, midnight(cut + timedelta(days=1))))
    batch = rows.filter(half_open(rows, column, midnight(cut)))
    return stored, batch


def corrected(batch: DataFrame) -> DataFrame:
    """A re-fetch that brings other values."""
    return batch.withColumn("value", F.col("value") + 1)


def to_records(rows: DataFrame) -> DataFrame:
    """Event rows as nested landing records."""
    klass = sensor_class(F.col("user_id"), REFERENCE_USERS)
    by_name = {
        "locationId": F.col("user_id"),
        "location": F.concat(F.lit("site-"), F.col("user_id").cast("string")),
        "parameter": F.col("event_type"),
        "value": F.col("value"),
        "date": F.struct(utc_text(F.col("ts")).alias("utc"), india_text(F.col("ts")).alias("local")),
        "unit": F.concat(F.lit("µg/m³ "), F.get_json_object("props", "$.k")),
        "coordinates": F.struct(
            (F.col("user_id") * F.lit(0.25)).alias("latitude"),
            (F.col("user_id") * F.lit(0.5)).alias("longitude"),
        ),
        "country": F.lit("IN"),
        "city": F.lit(None).cast("string"),
        "isMobile": F.lit(False),
        "isAnalysis": F.lit(None).cast("boolean"),
        "entity": F.when(klass == "reference", "Governmental").otherwise("Community Organization"),
        "sensorType": F.when(klass == "reference", "reference grade").otherwise("low-cost sensor"),
    }
    return rows.select(*[by_name[name].alias(name) for name in RECORD.names])


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_records(events(spark, sf_dir))


def dated_records(rows: DataFrame) -> DataFrame:
    """Records with the UTC day they belong to, for landing folders by day."""
    return to_records(rows).withColumn("day", F.to_date(F.substring("date.utc", 1, 10)))


def staged(rows: DataFrame, label: str = "batch") -> DataFrame:
    """Rows written once, for loads that read their batch more than once."""
    spark = rows.sparkSession
    path = new_dir(spark, label)
    rows.write.orc(path)
    return spark.read.schema(T.StructType(rows.schema.fields)).orc(path)
