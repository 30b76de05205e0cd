"""Projections, scalar functions, filters and plain aggregates."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.paths import day_parts, landing_path, request_text, tree_keys
from hazeline.functions.timestamps import (
    ISO,
    india_text,
    parse_instant,
    to_india,
    unix_round_trip,
    utc_text,
)
from hazeline.gallery.adapters import (
    M_SQL,
    RECORDS_SQL,
    REFERENCE_SQL,
    REFERENCE_USERS,
    measurements,
    orders,
    records,
)
from hazeline.gallery.registered import registered
from hazeline.operators import aggregates, filters, projections
from hazeline.sources.tables import max_year_view as create_max_year_view


@registered(
    f'WITH {RECORDS_SQL} SELECT "locationId", utc_text AS utc, parameter, value FROM r'
)
def project_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.canonical(records(spark, sf_dir))


@registered(
    f'WITH {RECORDS_SQL} SELECT location, local_text AS "local", parameter, unit, value FROM r'
)
def project_local_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.local_with_unit(records(spark, sf_dir))


@registered(
    f"WITH {RECORDS_SQL} SELECT location, ts AS local_time, parameter, unit, value FROM r"
)
def parse_local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.local_parsed(records(spark, sf_dir))


@registered(
    f"""WITH {RECORDS_SQL}
SELECT "locationId", location, parameter, value, unit, false AS "isMobile",
  CASE WHEN "locationId" IN {REFERENCE_SQL} THEN 'Governmental'
    ELSE 'Community Organization' END AS entity,
  CASE WHEN "locationId" IN {REFERENCE_SQL} THEN 'reference grade'
    ELSE 'low-cost sensor' END AS "sensorType",
  local_text AS local_timestamp, CAST(latitude AS DOUBLE) AS latitude,
  CAST(longitude AS DOUBLE) AS longitude
FROM r"""
)
def flatten_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.flattened(records(spark, sf_dir), drop=("country", "city", "isAnalysis"))


@registered(
    f"""WITH {M_SQL}
SELECT "locationId", parameter, CAST(epoch_us(utc) // 1000000 AS BIGINT) AS epoch,
  strftime(utc, '%Y-%m-%d %H:%M:%S') AS round_trip
FROM m"""
)
def unix_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = india_text(F.col("utc"))
    return measurements(spark, sf_dir).select(
        "locationId",
        "parameter",
        F.unix_timestamp(text, ISO).alias("epoch"),
        unix_round_trip(text).alias("round_trip"),
    )


@registered("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")
def scalar_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select("o_orderkey", F.year("o_orderdate").alias("order_year"))


@registered(
    f"""WITH {M_SQL},
p AS (
  SELECT *, CAST(utc + INTERVAL '5 hours 30 minutes' AS DATE) AS day FROM m
)
SELECT "locationId", parameter, utc,
  strftime(day, '%Y/%m/%d/') || "locationId" || '/' || parameter || '.json' AS path,
  'location_id=' || "locationId" || '&parameter=' || parameter
    || '&date_from=' || strftime(day, '%Y-%m-%d') || 'T00:00:00+05:30&date_to='
    || strftime(day + INTERVAL '1 day', '%Y-%m-%d') || 'T00:00:00+05:30' AS request,
  strftime(day, '%Y') AS yr, strftime(day, '%m') AS mnt, strftime(day, '%d') AS dy,
  CAST("locationId" AS VARCHAR) AS loc, parameter AS par,
  strftime(day, '%Y%m%d') AS folder
FROM p"""
)
def landing_path_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("day")
    built = measurements(spark, sf_dir).withColumn("day", to_india(F.col("utc")).cast("date"))
    built = built.select(
        "locationId",
        "parameter",
        "utc",
        landing_path(day, F.col("locationId"), F.col("parameter")).alias("path"),
        request_text(
            F.col("locationId"),
            F.col("parameter"),
            day.cast("timestamp_ntz"),
            F.date_add(day, 1).cast("timestamp_ntz"),
        ).alias("request"),
        F.concat(*day_parts(day).values()).alias("folder"),
    )
    keys = tree_keys(F.col("path"))
    return built.select("*", *[column.alias(name) for name, column in keys.items()])


@registered(
    f"""WITH {M_SQL}
SELECT "locationId", parameter, utc, strftime(utc, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS utc_text,
  utc AS parsed
FROM m"""
)
def iso_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = measurements(spark, sf_dir).withColumn("utc_text", utc_text(F.col("utc")))
    return text.select(
        "locationId", "parameter", "utc", "utc_text", parse_instant(F.col("utc_text")).alias("parsed")
    )


_TWO_YEARS = """WITH d AS (SELECT CAST(max(o_orderdate) AS DATE) AS as_of FROM orders)
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders, d
WHERE year(o_orderdate) BETWEEN year(as_of) - 1 AND year(as_of)"""


@registered(_TWO_YEARS)
def latest_two_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_totalprice")
    as_of = aggregates.as_of_date(rows, "o_orderdate")
    return filters.recent_years_by_year(rows, "o_orderdate", as_of)


@registered(_TWO_YEARS)
def latest_two_years_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_totalprice")
    as_of = aggregates.as_of_date(rows, "o_orderdate")
    return filters.recent_years(rows, "o_orderdate", as_of)


def _aged(condition: str) -> str:
    return f"""WITH d AS (SELECT CAST(max(o_orderdate) AS DATE) AS as_of FROM orders)
SELECT o_orderkey, o_orderdate,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), as_of) AS INTEGER) AS age
FROM orders, d WHERE date_diff('day', CAST(o_orderdate AS DATE), as_of) {condition}"""


@registered(_aged("<= 730"))
def retention_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    as_of = aggregates.as_of_date(rows, "o_orderdate")
    kept = filters.kept_by_age(rows, "o_orderdate", as_of)
    return kept.withColumn("age", filters.age_in_days(kept, "o_orderdate", as_of))


@registered(_aged("> 730"))
def retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    as_of = aggregates.as_of_date(rows, "o_orderdate")
    expired = filters.expired_by_age(rows, "o_orderdate", as_of)
    return expired.withColumn("age", filters.age_in_days(expired, "o_orderdate", as_of))


@registered(
    f"""WITH {M_SQL}
SELECT "locationId", parameter, utc,
  CASE WHEN "locationId" IN {REFERENCE_SQL} THEN 'reference' ELSE 'community' END AS sensor_class
FROM m"""
)
def sensor_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements(spark, sf_dir).select(
        "locationId",
        "parameter",
        "utc",
        filters.sensor_class(F.col("locationId"), REFERENCE_USERS).alias("sensor_class"),
    )


@registered(
    f"""WITH {M_SQL}, d AS (SELECT CAST(max(utc) AS DATE) AS as_of FROM m)
SELECT "locationId", utc, parameter, value,
  CAST(hour(utc + INTERVAL '5 hours 30 minutes') AS INTEGER) AS india_hour FROM m, d
WHERE utc + INTERVAL '5 hours 30 minutes' >= CAST(as_of - 1 AS TIMESTAMP)
  AND utc + INTERVAL '5 hours 30 minutes' < CAST(as_of AS TIMESTAMP)"""
)
def window_slice_ist(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measurements(spark, sf_dir)
    end = datetime.combine(aggregates.as_of_date(rows, "utc"), time.min)
    inside = filters.india_window(rows, "utc", end - timedelta(days=1), end)
    return inside.withColumn("india_hour", filters.india_hour(inside, "utc"))


@registered(f"WITH {M_SQL} SELECT CAST(max(utc) AS DATE) AS max_date FROM m")
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.max_date(measurements(spark, sf_dir))


@registered(f"WITH {M_SQL} SELECT max(utc) AS max_utc FROM m")
def max_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.max_value(measurements(spark, sf_dir), "utc", "max_utc")


@registered(f"WITH {RECORDS_SQL} SELECT min(local_text) AS min_local FROM r")
def min_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = records(spark, sf_dir).select("date.local")
    return aggregates.min_value(local, "local", "min_local")


@registered("SELECT CAST(max(year(ts)) AS INTEGER) AS max_year FROM events")
def max_year_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = records(spark, sf_dir).select(F.col("date.utc").alias("local_date"))
    staging.createOrReplaceTempView("hazeline_staging")
    return create_max_year_view(spark, "hazeline_max_year", "hazeline_staging")


@registered(
    f"""WITH {RECORDS_SQL}
SELECT location, parameter, count(*) AS "count" FROM r GROUP BY location, parameter"""
)
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.value_counts(records(spark, sf_dir), ["location", "parameter"])


@registered(
    f"""WITH {M_SQL}
SELECT "locationId", string_agg(DISTINCT parameter, ',' ORDER BY parameter) AS parameters
FROM m GROUP BY "locationId\""""
)
def parameter_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.parameter_catalogue(measurements(spark, sf_dir))


@registered(
    f"""WITH {M_SQL}
SELECT time_bucket(INTERVAL '3 hours', utc) AS window_start, "locationId", parameter,
  count(*) AS readings, round(sum(value), 2) AS total, round(sum(value), 2) / count(*) AS mean
FROM m GROUP BY ALL"""
)
def tumbling_3h(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = aggregates.tumbling(
        measurements(spark, sf_dir),
        "utc",
        "3 hours",
        ["locationId", "parameter"],
        *aggregates.reading_summary(),
    )
    return rounded_summary(windows)


def rounded_summary(windows: DataFrame) -> DataFrame:
    """Totals without the last bits, which depend on the order of adding."""
    total = F.round("total", 2)
    return windows.withColumn("mean", total / F.col("readings")).withColumn("total", total)
