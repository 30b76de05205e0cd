"""The landing files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.gallery.adapters import M_SQL, SPLIT_SQL, corrected, events, records, split, to_records
from hazeline.gallery.basics import rounded_summary
from hazeline.gallery.incremental import _KEPT_LAST
from hazeline.gallery.registered import registered
from hazeline.plans import rollups
from hazeline.plans.warehouse import read_warehouse
from hazeline.schemas import MEASUREMENT
from hazeline.scratch import new_dir
from hazeline.streaming import ingest

_DISTINCT = f"WITH {SPLIT_SQL} SELECT * FROM stored UNION SELECT * FROM batch"


@registered(_DISTINCT)
def stream_ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, warehouse = new_dir(spark, "landing"), new_dir(spark, "warehouse")
    staging, checkpoint = new_dir(spark, "staging"), new_dir(spark, "stream")
    for drop in split(events(spark, sf_dir), "ts"):
        to_records(drop).write.mode("append").json(landing)
        stream = ingest.record_stream(spark, landing, array_files=False)
        ingest.ingest_stream(stream, warehouse, staging, checkpoint).awaitTermination()
    return read_warehouse(spark, warehouse).drop("utc_date")


@registered(_DISTINCT)
def stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, path, checkpoint = (new_dir(spark, name) for name in ("landing", "sink", "stream"))
    for drop in split(events(spark, sf_dir), "ts"):
        to_records(drop).write.mode("append").json(landing)
        rows = ingest.measurement_stream(ingest.record_stream(spark, landing, array_files=False))
        ingest.drain_to_files(ingest.first_per_key(rows, "2 days"), path, checkpoint)
    return spark.read.schema(MEASUREMENT).orc(path)


@registered(
    f"""WITH {M_SQL}, w AS (
  SELECT time_bucket(INTERVAL '3 hours', utc) AS window_start, "locationId", parameter,
    count(*) AS readings, round(sum(value), 2) AS total, round(sum(value), 2) / count(*) AS mean
  FROM m GROUP BY ALL
)
SELECT * FROM w WHERE window_start + INTERVAL '3 hours'
  <= (SELECT date_trunc('milliseconds', max(utc)) FROM m) - INTERVAL '1 hour'"""
)
def stream_tumbling_3h(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, path, checkpoint = (new_dir(spark, name) for name in ("landing", "sink", "stream"))
    records(spark, sf_dir).write.json(landing)
    rows = ingest.measurement_stream(ingest.record_stream(spark, landing, array_files=False))
    windows = ingest.window_readings(rows, "1 hour")
    schema = windows.schema
    ingest.drain_to_files(windows, path, checkpoint)
    return rounded_summary(spark.read.schema(schema).orc(path))


@registered(
    f"""WITH {SPLIT_SQL}
SELECT "locationId", parameter, time_bucket(INTERVAL '3 hours', utc) AS window_start, count(*) AS readings,
  round(sum(value), 2) AS total, max(value) AS greatest, max(utc) AS newest
FROM ({_KEPT_LAST}) GROUP BY ALL"""
)
def stream_corrected_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows kept by a stream; a later file corrects the last stored day and adds newer ones."""
    landing, warehouse, windows = (new_dir(spark, name) for name in ("landing", "warehouse", "windows"))
    staging, checkpoint = new_dir(spark, "staging"), new_dir(spark, "stream")
    stored, batch = split(events(spark, sf_dir), "ts")
    for drop in (stored, corrected(batch)):
        to_records(drop).write.mode("append").json(landing)
        stream = ingest.record_stream(spark, landing, array_files=False)
        ingest.corrected_windows(stream, warehouse, windows, staging, checkpoint).awaitTermination()
    state = rollups.read_state(spark, windows)
    return state.withColumn("total", F.round("total", 2)).drop("valued", "utc_date")
