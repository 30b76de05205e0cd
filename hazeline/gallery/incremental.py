"""Loading batches into a warehouse that already holds rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.gallery.adapters import (
    REFERENCE_USERS,
    SPLIT_SQL,
    M_SQL,
    corrected,
    events,
    instants,
    measurements,
    split,
    staged,
    to_records,
)
from hazeline.gallery.registered import registered
from hazeline.operators import aggregates
from hazeline.plans import warehouse as wh
from hazeline.plans.clustering import compact_clustered
from hazeline.plans.cycle import build_latest, ingest
from hazeline.plans.publish import publish_days, read_published_days
from hazeline.schemas import DAY, KEY, MEASUREMENT
from hazeline.scratch import new_dir
from hazeline.sources import files

_BOTH = """SELECT CAST(utc AS DATE) AS utc_date, count(*) AS readings FROM (
  SELECT * FROM stored UNION ALL SELECT * FROM batch
) GROUP BY ALL"""

_KEPT_FIRST = """SELECT * FROM stored UNION ALL
SELECT "locationId", utc, parameter, value + 1 AS value FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM stored s
  WHERE s."locationId" = b."locationId" AND s.parameter = b.parameter AND s.utc = b.utc
)"""

_KEPT_LAST = """SELECT "locationId", utc, parameter, value FROM (
  SELECT *, 1 AS batch_no FROM stored
  UNION ALL
  SELECT "locationId", utc, parameter, value + 1 AS value, 2 AS batch_no FROM batch
) QUALIFY row_number() OVER (
  PARTITION BY "locationId", parameter, utc ORDER BY batch_no DESC, value DESC
) = 1"""


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    stored, batch = split(measurements(spark, sf_dir))
    return instants(stored), instants(batch)


def _loaded(spark: SparkSession, rows: DataFrame) -> str:
    path = new_dir(spark, "warehouse")
    wh.write_days(rows, path)
    return path


@registered(f"WITH {SPLIT_SQL} {_BOTH}")
def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = _parts(spark, sf_dir)
    path = _loaded(spark, stored)
    wh.write_days(batch, path)
    return wh.read_warehouse(spark, path).groupBy(DAY).agg(F.count(F.lit(1)).alias("readings"))


@registered(f"WITH {SPLIT_SQL} SELECT * FROM stored UNION SELECT * FROM batch")
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = split(measurements(spark, sf_dir))
    return aggregates.distinct_rows(stored.unionByName(batch))


@registered(f"WITH {SPLIT_SQL} {_KEPT_FIRST}")
def append_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = _parts(spark, sf_dir)
    path = _loaded(spark, stored)
    wh.append_new(staged(corrected(batch)), path)
    return wh.read_warehouse(spark, path).drop(DAY)


@registered(f"WITH {SPLIT_SQL} {_KEPT_LAST}")
def keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = split(measurements(spark, sf_dir))
    numbered = stored.withColumn("batch_no", F.lit(1)).unionByName(
        corrected(batch).withColumn("batch_no", F.lit(2))
    )
    return aggregates.latest_per_key(numbered, KEY, ["batch_no"]).drop("batch_no")


@registered(f"WITH {SPLIT_SQL} {_KEPT_LAST}")
def upsert_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = _parts(spark, sf_dir)
    path = _loaded(spark, stored)
    wh.upsert(staged(corrected(batch)), path)
    return wh.read_warehouse(spark, path).drop(DAY)


@registered(
    f"""WITH {SPLIT_SQL}
SELECT CAST(utc AS DATE) AS utc_date, count(*) AS readings, round(sum(value), 2) AS total
FROM ({_KEPT_LAST}) GROUP BY ALL"""
)
def publish_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = _parts(spark, sf_dir)
    path, published = _loaded(spark, stored), new_dir(spark, "published")
    fresh = staged(corrected(batch))
    as_of = aggregates.as_of_date(fresh, DAY)
    publish_days(wh.read_warehouse(spark, path), published, as_of)
    wh.upsert(fresh, path)
    publish_days(wh.touched(wh.read_warehouse(spark, path), fresh), published, as_of)
    return (
        read_published_days(spark, published)
        .groupBy(DAY)
        .agg(F.count(F.lit(1)).alias("readings"), F.round(F.sum("value"), 2).alias("total"))
    )


@registered(
    f"""WITH {M_SQL}
SELECT CAST(utc AS DATE) AS utc_date, count(*) AS readings, round(sum(value), 2) AS total
FROM m GROUP BY ALL"""
)
def compact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instants(measurements(spark, sf_dir))
    is_reference = F.col("locationId").isin(list(REFERENCE_USERS))
    path = _loaded(spark, rows.filter(is_reference))
    wh.write_days(rows.filter(~is_reference), path)
    wh.compact(spark, path, wh.fragmented_days(spark, path, min_files=2))
    return (
        wh.read_warehouse(spark, path)
        .groupBy(DAY)
        .agg(F.count(F.lit(1)).alias("readings"), F.round(F.sum("value"), 2).alias("total"))
    )


@registered(
    f"""WITH {M_SQL}
SELECT CAST(utc AS DATE) AS utc_date, "locationId", count(*) AS readings, round(sum(value), 2) AS total
FROM m WHERE hour(utc) BETWEEN 6 AND 8 GROUP BY ALL"""
)
def compact_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of sensors, read from days compacted along the curve."""
    path = _loaded(spark, instants(measurements(spark, sf_dir)))
    days = [row[0] for row in wh.day_files(spark, path).select(DAY).collect()]
    compact_clustered(spark, path, days, target_bytes=64 << 10)
    return (
        wh.read_warehouse(spark, path)
        .filter(F.hour("utc").between(6, 8))
        .groupBy(DAY, "locationId")
        .agg(F.count(F.lit(1)).alias("readings"), F.round(F.sum("value"), 2).alias("total"))
    )


@registered(f"WITH {SPLIT_SQL} {_KEPT_LAST}")
def daily_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over landing files, the second re-fetching the last day, then the extract."""
    rows = events(spark, sf_dir)
    stored, batch = split(rows, "ts")
    path, target = new_dir(spark, "warehouse"), new_dir(spark, "latest")
    for drop in (stored, corrected(batch)):
        landed = new_dir(spark, "landing")
        to_records(drop).write.json(landed)
        ingest(spark, landed, path, array_files=False)
    build_latest(spark, path, [target], as_of=aggregates.as_of_date(rows, "ts"))
    return files.read_csv(spark, target, MEASUREMENT, header=True)
