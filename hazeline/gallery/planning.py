"""Registry, spines, fetch plans and gaps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.gallery.adapters import (
    M_SQL,
    REFERENCE_USERS,
    REGISTRY_SQL,
    SPLIT_SQL,
    measurements,
    split,
    staged,
)
from hazeline.gallery.registered import registered
from hazeline.operators import aggregates, gaps, registry
from hazeline.plans import fetch

_SPAN_SQL = """span AS (SELECT CAST(min(utc) AS DATE) AS first_day, CAST(max(utc) AS DATE) AS as_of FROM m)"""

_DAYS_SQL = """days AS (
  SELECT CAST(unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(as_of - 1 AS TIMESTAMP),
    INTERVAL '1 day')) AS DATE) AS day FROM span
)"""

_HOURS_SQL = "hours AS (SELECT unnest(range(0, 24, 3)) AS opening)"


def _plan_sql(days: str) -> str:
    return f"""plan AS (
  SELECT "locationId", parameter, sensor_class, day,
    CAST(day AS TIMESTAMP) + to_hours(CASE sensor_class WHEN 'reference' THEN 0 ELSE 21 END) AS local_from,
    CAST(day + 1 AS TIMESTAMP) AS local_to
  FROM registry, {days}
)"""


def _sliced_sql(days: str) -> str:
    return f"""plan AS (
  SELECT "locationId", parameter, sensor_class, day,
    CAST(day AS TIMESTAMP) + to_hours(CAST(opening AS INTEGER)) AS local_from,
    CAST(day AS TIMESTAMP) + to_hours(CAST(opening AS INTEGER)
      + CASE sensor_class WHEN 'reference' THEN 24 ELSE 3 END) AS local_to
  FROM registry, {days}, hours WHERE sensor_class = 'community' OR opening = 0
)"""


_REQUEST_SQL = """SELECT "locationId", parameter, sensor_class, day,
  local_from - INTERVAL '5 hours 30 minutes' AS from_utc,
  local_to - INTERVAL '5 hours 30 minutes' AS to_utc,
  'location_id=' || "locationId" || '&parameter=' || parameter
    || '&date_from=' || strftime(local_from, '%Y-%m-%dT%H:%M:%S') || '+05:30&date_to='
    || strftime(local_to, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS request,
  strftime(day, '%Y/%m/%d/') || "locationId" || '/' || parameter || '.json' AS path
FROM plan"""

# Where the stored part ends, the plan begins.
_OWED_SQL = f"""{SPLIT_SQL}, {REGISTRY_SQL},
span AS (
  SELECT (SELECT CAST(max(utc) AS DATE) FROM stored) AS first_day, as_of FROM d
), {_DAYS_SQL}"""

_FILLED = """filled AS (
  SELECT DISTINCT "locationId", parameter, {start} AS local_from
  FROM (
    SELECT *, utc + INTERVAL '5 hours 30 minutes' AS local_time FROM m
  ) {where}
)"""

_REFERENCE = '"locationId" IN (1, 2, 3, 7, 8)'

_FILLED_SQL = _FILLED.format(
    start=f"""date_trunc('day', local_time)
    + to_hours(CASE WHEN {_REFERENCE} THEN 0 ELSE 21 END)""",
    where=f"WHERE {_REFERENCE} OR hour(local_time) >= 21",
)

_FILLED_SLICED_SQL = _FILLED.format(
    start=f"""date_trunc('day', local_time)
    + to_hours(CAST(CASE WHEN {_REFERENCE} THEN 0 ELSE hour(local_time) // 3 * 3 END AS INTEGER))""",
    where="",
)


def _span(rows: DataFrame) -> tuple[date, date]:
    """First and last day of the rows."""
    return tuple(rows.agg(F.min("utc").cast("date"), F.max("utc").cast("date")).first())


@registered(
    f"""WITH {M_SQL}, {_SPAN_SQL}, {_DAYS_SQL}
SELECT day AS date_from, day + 1 AS date_to FROM days"""
)
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.day_spine(spark, *_span(measurements(spark, sf_dir)))


@registered(
    f"""WITH {M_SQL}, {_SPAN_SQL}, {_DAYS_SQL}, {_HOURS_SQL}
SELECT CAST(day AS TIMESTAMP) + to_hours(CAST(opening AS INTEGER)) AS slice_from,
  CAST(day AS TIMESTAMP) + to_hours(CAST(opening AS INTEGER) + 3) AS slice_to
FROM days, hours"""
)
def three_hour_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.slice_spine(spark, *_span(measurements(spark, sf_dir)))


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _owed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, date, date]:
    rows = measurements(spark, sf_dir)
    stored, _ = split(rows)
    start = fetch.fetch_start(aggregates.as_of_date(stored, "utc"), date.min)
    sensors = registry.registry_from(rows, REFERENCE_USERS)
    return sensors, start, aggregates.as_of_date(rows, "utc")


@registered(f"WITH {_OWED_SQL}, {_plan_sql('days')} {_REQUEST_SQL}")
def fetch_plan_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = fetch.with_requests(fetch.daily_plan(*_owed(spark, sf_dir), tasks=_tasks(spark)))
    return plan.drop("local_from", "local_to")


@registered(f"WITH {_OWED_SQL}, {_HOURS_SQL}, {_sliced_sql('days')} {_REQUEST_SQL}")
def fetch_plan_3h(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = fetch.with_requests(fetch.sliced_plan(*_owed(spark, sf_dir), tasks=_tasks(spark)))
    return plan.drop("local_from", "local_to")


@registered(
    f"""WITH {M_SQL}, {REGISTRY_SQL}, {_SPAN_SQL}, {_DAYS_SQL}, {_plan_sql('days')}, {_FILLED_SQL}
SELECT "locationId", parameter, day, local_from - INTERVAL '5 hours 30 minutes' AS from_utc
FROM plan p WHERE NOT EXISTS (
  SELECT 1 FROM filled f WHERE f."locationId" = p."locationId"
    AND f.parameter = p.parameter AND f.local_from = p.local_from
)"""
)
def gap_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measurements(spark, sf_dir)
    sensors = registry.registry_from(rows, REFERENCE_USERS)
    plan = fetch.daily_plan(sensors, *_span(rows), tasks=_tasks(spark))
    missing = gaps.gap_cells(plan, gaps.filled_cells(rows, REFERENCE_USERS))
    return missing.select("locationId", "parameter", "day", "from_utc")


_COMPLETENESS_SQL = """SELECT p."locationId", p.parameter, count(*) AS planned,
  count(f.local_from) AS filled, count(f.local_from) / count(*) AS share
FROM plan p LEFT JOIN filled f ON f."locationId" = p."locationId"
  AND f.parameter = p.parameter AND f.local_from = p.local_from
GROUP BY ALL"""


@registered(
    f"""WITH {M_SQL}, {REGISTRY_SQL}, {_SPAN_SQL}, {_DAYS_SQL}, {_plan_sql('days')}, {_FILLED_SQL}
{_COMPLETENESS_SQL}"""
)
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measurements(spark, sf_dir)
    sensors = registry.registry_from(rows, REFERENCE_USERS)
    plan = fetch.daily_plan(sensors, *_span(rows), tasks=_tasks(spark))
    return gaps.completeness(plan, gaps.filled_cells(rows, REFERENCE_USERS))


@registered(
    f"""WITH {M_SQL}, {REGISTRY_SQL}, {_SPAN_SQL}, {_DAYS_SQL}, {_HOURS_SQL},
{_sliced_sql('days')}, {_FILLED_SLICED_SQL} {_COMPLETENESS_SQL}"""
)
def completeness_3h(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measurements(spark, sf_dir)
    sensors = registry.registry_from(rows, REFERENCE_USERS)
    plan = fetch.sliced_plan(sensors, *_span(rows), tasks=_tasks(spark))
    return gaps.completeness(plan, gaps.filled_cells(rows, REFERENCE_USERS, sliced=True))


@registered(
    f"""WITH {SPLIT_SQL}, known AS (
  SELECT DISTINCT "locationId", parameter,
    CASE WHEN "locationId" IN (1, 2, 3, 7, 8) THEN 'reference' ELSE 'community' END AS sensor_class
  FROM stored
)
SELECT m."locationId", m.utc, m.parameter, m.value, k.sensor_class, n.n_name AS nation
FROM m LEFT JOIN known k ON k."locationId" = m."locationId" AND k.parameter = m.parameter
  LEFT JOIN nation n ON n.n_nationkey = m."locationId" % 25"""
)
def enrich_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measurements(spark, sf_dir)
    stored, _ = split(rows)
    sensors = staged(registry.registry_from(stored, REFERENCE_USERS), "registry")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.col("n_nationkey").cast("long").alias("nation_key"), F.col("n_name").alias("nation")
    )
    enriched = registry.enrich(rows, sensors).withColumn("nation_key", F.col("locationId") % 25)
    return enriched.join(nation, "nation_key", "left").drop("nation_key")


# A listing with the faults hand-kept ones have: `signup` is listed twice, `purchase` and
# `view` are run together.
_LISTING_SQL = """listing AS (
  SELECT "locationId",
    CASE parameter WHEN 'purchase' THEN 'purchaseview' ELSE parameter END AS parameter
  FROM registry
  UNION ALL
  SELECT "locationId", parameter FROM registry WHERE parameter = 'signup'
)"""


def _faulty_listing(rows: DataFrame) -> DataFrame:
    pairs = rows.select("locationId", "parameter").distinct()
    repeats = F.when(F.col("parameter") == "signup", 2).otherwise(1)
    glued = F.when(F.col("parameter") == "purchase", "purchaseview").otherwise(F.col("parameter"))
    return (
        pairs.withColumn("copy", F.explode(F.array_repeat(F.lit(0), repeats)))
        .withColumn("parameter", glued)
        .drop("copy")
    )


@registered(
    f"""WITH {M_SQL}, {REGISTRY_SQL}, {_LISTING_SQL}
SELECT "locationId", parameter, count(*) AS listed FROM listing
GROUP BY ALL HAVING count(*) > 1"""
)
def registry_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.duplicates(_faulty_listing(measurements(spark, sf_dir)))


@registered(
    f"""WITH {M_SQL}, {REGISTRY_SQL}, {_LISTING_SQL}
SELECT parameter, "locationId" FROM listing
WHERE parameter NOT IN (SELECT parameter FROM m)"""
)
def registry_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measurements(spark, sf_dir)
    catalogue = rows.select("parameter").distinct()
    return registry.unknown_parameters(_faulty_listing(rows), catalogue)
