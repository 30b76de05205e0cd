"""Keeping a warehouse: daily runs by ledger, files of all shapes, gaps, rollups, snapshots."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.paths import landing_day
from hazeline.gallery.adapters import (
    M_SQL,
    REFERENCE_SQL,
    REFERENCE_USERS,
    REGISTRY_SQL,
    SPLIT_SQL,
    corrected,
    dated_records,
    events,
    instants,
    measurements,
    records,
    split,
    staged,
    to_records,
)
from hazeline.gallery.incremental import _KEPT_LAST
from hazeline.gallery.registered import registered
from hazeline.operators import aggregates, gaps, history, registry
from hazeline.operators.filters import kept_by_age
from hazeline.plans import replay, rollups, snapshots
from hazeline.plans import warehouse as wh
from hazeline.plans.cycle import owed, read_quarantine, run_daily
from hazeline.plans.publish import latest_extract, read_published_days
from hazeline.schemas import DAY, MEASUREMENT
from hazeline.scratch import new_dir
from hazeline.sources import files, landing

_LEVELS = ["yr", "mnt", "dy"]


class _Runs:
    """A landing tree and the daily runs over it."""

    def __init__(self, spark: SparkSession, rows: DataFrame):
        self.spark = spark
        names = ("tree", "warehouse", "quarantine", "latest", "ledger")
        self.tree, self.warehouse, self.quarantine, self.latest, self.ledger = (new_dir(spark, n) for n in names)
        newest = aggregates.as_of_date(rows, "ts")
        self.as_of, self.start = newest + timedelta(days=1), aggregates.scalar(rows.agg(F.min("ts").cast("date")))

    def land(self, rows: DataFrame) -> None:
        landing.write_landing(dated_records(rows), self.tree, "day", _LEVELS)

    def run(self) -> int:
        return run_daily(
            self.spark, self.tree, self.warehouse, self.quarantine, [self.latest],
            as_of=self.as_of, bootstrap_start=self.start, ledger=self.ledger,
        )

    def published(self) -> DataFrame:
        return files.read_csv(self.spark, self.latest, MEASUREMENT, header=True)


@registered(f"WITH {SPLIT_SQL} {_KEPT_LAST}")
def daily_run_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs over one tree, the second with the last day fetched again; then a third
    that finds nothing new."""
    rows = events(spark, sf_dir)
    stored, batch = split(rows, "ts")
    runs = _Runs(spark, rows)
    for drop in (stored, corrected(batch)):
        runs.land(drop)
        runs.run()
    if runs.run():
        raise RuntimeError("loaded files are loaded again")
    return runs.published()


@registered(
    f"""WITH {SPLIT_SQL}
SELECT "locationId", utc, parameter, value FROM m"""
)
def late_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest days land first; files that come late to older folders are loaded too."""
    rows = events(spark, sf_dir)
    older, newer = split(rows, "ts")
    runs = _Runs(spark, rows)
    for drop in (newer, older):
        runs.land(drop)
        runs.run()
    return wh.read_warehouse(spark, runs.warehouse).drop(DAY)


@registered(
    f"""WITH {M_SQL}
SELECT "locationId", utc, parameter, value, 'good' AS outcome FROM m"""
)
def arrays_and_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree with large arrays, small arrays and lines, told apart by the file; files above
    64 KB are read by ranges."""
    rows = records(spark, sf_dir).withColumn("kind", F.pmod("locationId", F.lit(3)))
    path = new_dir(spark, "mixed")
    kinds = [rows.filter(F.col("kind") == kind).drop("kind") for kind in range(3)]
    landing.write_array_files(kinds[0], f"{path}/large", bits=20)
    landing.write_array_files(kinds[1], f"{path}/small", bits=6)
    kinds[2].write.json(f"{path}/lines")
    found = landing.parsed(landing.landed_records(spark, path, whole_bytes=64 << 10, glob="part-*"))
    return found.select("locationId", "utc", "parameter", "value", "outcome")


@registered(
    f"""WITH {M_SQL},
d AS (SELECT max(utc) AS newest FROM m),
bad AS (SELECT * FROM m WHERE "locationId" % 7 = 3)
SELECT 'value' AS reason, count(*) AS listed, (SELECT count(*) FROM m) - count(*) AS stored FROM bad"""
)
def daily_run_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What daily runs set aside, and what they store of the same files."""
    rows = events(spark, sf_dir)
    runs = _Runs(spark, rows)
    spoilt = F.when(F.col("locationId") % 7 == 3, "n/a").otherwise(F.col("value").cast("string"))
    landing.write_landing(dated_records(rows).withColumn("value", spoilt), runs.tree, "day", _LEVELS)
    runs.run()
    runs.run()
    stored = wh.read_warehouse(spark, runs.warehouse).count()
    bad = read_quarantine(spark, runs.quarantine).groupBy("reason").agg(F.count(F.lit(1)).alias("listed"))
    return bad.withColumn("stored", F.lit(stored).cast("bigint"))


@registered(
    f"""WITH {SPLIT_SQL}, {REGISTRY_SQL},
days AS (SELECT unnest(generate_series((SELECT max(CAST(utc AS DATE)) FROM stored),
  (SELECT as_of FROM d), INTERVAL 1 DAY)) AS day)
SELECT "locationId", parameter, CAST(day AS DATE) AS day, 'location_id=' || "locationId" || '&parameter=' || parameter
  || '&date_from=' || strftime(day + w.a, '%Y-%m-%dT%H:%M:%S') || '+05:30&date_to='
  || strftime(day + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS request
FROM registry, days,
  LATERAL (SELECT CASE WHEN "locationId" IN {REFERENCE_SQL} THEN INTERVAL 0 HOUR ELSE INTERVAL 21 HOUR END AS a) w"""
)
def owed_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetches due after a load, from a registry that lists every pair twice."""
    rows = measurements(spark, sf_dir)
    stored, _ = split(rows)
    path = new_dir(spark, "warehouse")
    wh.write_days(instants(stored), path)
    listed = registry.registry_from(rows, REFERENCE_USERS)
    newest = aggregates.as_of_date(rows, "utc")
    plan = owed(
        spark, listed.union(listed), path, as_of=newest + timedelta(days=1), bootstrap_start=newest
    )
    return plan.select("locationId", "parameter", "day", "request")


@registered(f"WITH {M_SQL} SELECT * FROM m")
def migrate_text_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older ORC folder whose times are text, loaded into a warehouse."""
    old, path = new_dir(spark, "old"), new_dir(spark, "warehouse")
    flat = to_records(events(spark, sf_dir)).select("locationId", "date.utc", "parameter", "value")
    files.write_orc(flat, old)
    wh.migrate_text_orc(spark, old, path)
    return wh.read_warehouse(spark, path).drop(DAY)


def _gap_sql(hours: int) -> str:
    return f"""SELECT {hours} AS hours, "locationId", parameter,
  make_timestamp((min(c) * {hours * 3600} - 19800) * 1000000) AS from_utc,
  make_timestamp(((max(c) + 1) * {hours * 3600} - 19800) * 1000000) AS to_utc, count(*) AS cells
FROM (
  SELECT *, c - row_number() OVER (PARTITION BY "locationId", parameter ORDER BY c) AS run FROM (
    SELECT "locationId", parameter,
      unnest(range((SELECT epoch(low) // {hours * 3600} FROM b)::BIGINT, (SELECT epoch(high) // {hours * 3600} FROM b)::BIGINT)) AS c
    FROM registry
    EXCEPT
    SELECT "locationId", parameter, CAST(floor((epoch(utc) + 19800) / {hours * 3600}) AS BIGINT) FROM m
  )
) GROUP BY "locationId", parameter, run"""


@registered(
    f"""WITH {M_SQL}, {REGISTRY_SQL},
b AS (SELECT CAST(min(utc) AS DATE)::TIMESTAMP AS low, (CAST(max(utc) AS DATE) + 2)::TIMESTAMP AS high FROM m)
{" UNION ALL ".join(_gap_sql(hours) for hours in (2, 4, 6))}"""
)
def gap_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unbroken gaps per sensor for cells of 2, 4 and 6 hours."""
    rows = measurements(spark, sf_dir)
    sensors = staged(rows.select("locationId", "parameter").distinct(), "registry")
    first = aggregates.scalar(rows.agg(F.min("utc").cast("date")))
    last = aggregates.as_of_date(rows, "utc") + timedelta(days=2)
    runs = [
        gaps.gap_runs(rows, sensors, first, last, hours).select(F.lit(hours).alias("hours"), "*")
        for hours in (2, 4, 6)
    ]
    return runs[0].union(runs[1]).union(runs[2])


def _rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State built before a load, refreshed after it for the days it touched."""
    stored, batch = split(measurements(spark, sf_dir))
    path, state = new_dir(spark, "warehouse"), new_dir(spark, "rollup")
    wh.write_days(instants(stored), path)
    rollups.refresh(spark, path, state)
    fresh = staged(corrected(instants(batch)))
    wh.upsert(fresh, path)
    rollups.refresh(spark, path, state, fresh)
    return rollups.read_state(spark, state)


_ROLLED = """"locationId", parameter, {level}, count(*) AS readings, round(sum(value), 2) AS total,
  round(avg(value), 6) AS mean, max(value) AS greatest, max(utc) AS newest"""


def _rounded(rolled: DataFrame) -> DataFrame:
    return rolled.withColumn("total", F.round("total", 2)).withColumn("mean", F.round("mean", 6))


@registered(
    f"WITH {SPLIT_SQL} SELECT {_ROLLED.format(level='CAST(utc AS DATE) AS utc_date')} FROM ({_KEPT_LAST}) GROUP BY ALL"
)
def rollup_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollups.by_day(_rolled(spark, sf_dir)))


@registered(
    f"WITH {SPLIT_SQL} SELECT {_ROLLED.format(level='CAST(year(utc) AS INTEGER) AS year')} FROM ({_KEPT_LAST}) GROUP BY ALL"
)
def rollup_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollups.by_year(_rolled(spark, sf_dir)))


@registered(
    f"WITH {SPLIT_SQL} SELECT max(utc) AS max_utc, CAST(year(max(utc)) AS INTEGER) AS max_year FROM ({_KEPT_LAST})"
)
def rollup_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.newest(_rolled(spark, sf_dir))


@registered(
    f"""WITH {SPLIT_SQL}
SELECT "locationId", utc, parameter, value, copy FROM ({_KEPT_LAST}), (SELECT unnest([1, 2]) AS copy)"""
)
def publish_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two places, published before and after a load."""
    stored, batch = split(measurements(spark, sf_dir))
    path = new_dir(spark, "warehouse")
    roots = [new_dir(spark, "snapshots") for _ in range(2)]
    wh.write_days(instants(stored), path)
    as_of = aggregates.as_of_date(batch, "utc")
    snapshots.publish_snapshots(latest_extract(wh.read_warehouse(spark, path), as_of), roots)
    wh.upsert(staged(corrected(instants(batch))), path)
    snapshots.publish_snapshots(latest_extract(wh.read_warehouse(spark, path), as_of), roots)
    copies = [
        snapshots.read_snapshot(spark, root, MEASUREMENT).withColumn("copy", F.lit(number))
        for number, root in enumerate(roots, start=1)
    ]
    return copies[0].union(copies[1])


@registered(f"WITH {SPLIT_SQL} {_KEPT_LAST}")
def daily_run_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily runs that publish the days they touched; the last day is fetched again."""
    rows = events(spark, sf_dir)
    stored, batch = split(rows, "ts")
    runs = _Runs(spark, rows)
    for drop in (stored, corrected(batch)):
        runs.land(drop)
        run_daily(
            spark, runs.tree, runs.warehouse, runs.quarantine, [runs.latest], as_of=runs.as_of,
            bootstrap_start=runs.start, ledger=runs.ledger, by_day=True,
        )
    return read_published_days(spark, runs.latest).drop(DAY)


_HISTORY_SQL = """h AS (
  SELECT DISTINCT "locationId", parameter, 'first' AS label, CAST(NULL AS VARCHAR) AS note,
    (SELECT CAST(min(utc) AS DATE) + 1 FROM m)::TIMESTAMP AS valid_from FROM m WHERE "locationId" % 5 <> 4
  UNION ALL
  SELECT "locationId", parameter, 'from row ' || CAST(value AS INTEGER), parameter, utc FROM m WHERE event_no % 7 = 0
)"""


@registered(
    f"""WITH m AS (
  SELECT event_id AS event_no, user_id AS "locationId", ts AS utc, event_type AS parameter, round(value) AS value FROM events
), {_HISTORY_SQL}, v AS (
  SELECT "locationId", parameter, valid_from, max((label, note)) AS one FROM h GROUP BY ALL
)
SELECT m.*, (one)[1] AS label, (one)[2] AS note FROM m ASOF LEFT JOIN v
  ON m."locationId" = v."locationId" AND m.parameter = v.parameter AND m.utc >= v.valid_from"""
)
def enrich_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensors that change their label: at a day's begin and at a seventh of their own readings."""
    rows = events(spark, sf_dir).select(
        F.col("event_id").alias("event_no"), F.col("user_id").alias("locationId"), F.col("ts").alias("utc"),
        F.col("event_type").alias("parameter"), F.round("value").alias("value"),
    )
    start = aggregates.scalar(rows.agg(F.min("utc").cast("date"))) + timedelta(days=1)
    sensors = rows.filter(F.col("locationId") % 5 != 4).select("locationId", "parameter").distinct()
    begun = sensors.select(
        "*", F.lit("first").alias("label"), F.lit(None).cast("string").alias("note"),
        F.lit(start).cast("timestamp_ntz").alias("valid_from"),
    )
    changed = rows.filter(F.col("event_no") % 7 == 0).select(
        "locationId", "parameter",
        F.concat(F.lit("from row "), F.col("value").cast("int").cast("string")).alias("label"),
        F.col("parameter").alias("note"), F.col("utc").alias("valid_from"),
    )
    return history.enrich_as_of(rows, begun.unionByName(changed))


@registered(
    f"""WITH {M_SQL}, bad AS (SELECT * FROM m WHERE "locationId" % 7 = 3)
SELECT "locationId", utc, parameter, value, (SELECT count(*) FROM bad) AS resolved FROM m"""
)
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with a decimal comma are set aside, repaired and loaded; a second replay finds none."""
    rows = events(spark, sf_dir)
    runs = _Runs(spark, rows)
    text = F.col("value").cast("string")
    spoilt = F.when(F.col("locationId") % 7 == 3, F.replace(text, F.lit("."), F.lit(","))).otherwise(text)
    landing.write_landing(dated_records(rows).withColumn("value", spoilt), runs.tree, "day", _LEVELS)
    runs.run()
    resolved = new_dir(spark, "resolved")
    repairs = {"value": F.replace("value", F.lit(","), F.lit("."))}
    count = replay.replay(spark, runs.quarantine, resolved, runs.warehouse, repairs)
    if replay.replay(spark, runs.quarantine, resolved, runs.warehouse, repairs):
        raise RuntimeError("resolved rows are loaded again")
    stored = wh.read_warehouse(spark, runs.warehouse).drop(DAY)
    return stored.withColumn("resolved", F.lit(count).cast("bigint"))


_SITES_SQL = """SELECT s_suppkey AS "locationId", 'zone' || s_nationkey AS parameter,
  CAST(DATE '2024-01-28' + s_nationkey AS DATE) AS day FROM supplier"""


def _site_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return suppliers.select(
        F.col("s_suppkey").alias("locationId"),
        F.concat(F.lit("zone"), F.col("s_nationkey").cast("string")).alias("parameter"),
        F.col("s_acctbal").alias("value"),
        F.date_add(F.lit("2024-01-28").cast("date"), "s_nationkey").alias("day"),
    )


def _sites(spark: SparkSession, sf_dir: str) -> str:
    """A landing tree with a folder for each sensor and parameter: one for each supplier."""
    path = new_dir(spark, "sites")
    landing.write_landing(_site_records(spark, sf_dir), path, "day")
    return path


@registered(_SITES_SQL)
def landed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days, sensors and parameters that have landed, from the names of the files alone."""
    cells = landing.landed_cells(spark, _sites(spark, sf_dir))
    return cells.select("locationId", "parameter", "day")


@registered(f"SELECT day, count(*) AS files, true AS filled FROM ({_SITES_SQL}) GROUP BY day")
def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each landing day, listed without opening any."""
    found = landing.file_inventory(spark, _sites(spark, sf_dir), "*.json")
    return found.groupBy(landing_day(F.col("path")).alias("day")).agg(
        F.count(F.lit(1)).alias("files"), F.every(F.col("length") > 0).alias("filled")
    )


@registered(
    f"""WITH {M_SQL}, d AS (SELECT CAST(max(utc) AS DATE) AS newest FROM m)
SELECT max(utc) AS max_utc, newest AS mark,
  (SELECT max(CAST(utc AS DATE)) FROM m, d WHERE CAST(utc AS DATE) <= newest - 3) AS resume
FROM m, d GROUP BY newest"""
)
def stored_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the warehouse says of itself: newest instant, high-water mark, and the day that a run
    three days earlier goes on from."""
    rows = measurements(spark, sf_dir)
    path = new_dir(spark, "warehouse")
    wh.write_days(instants(rows), path)
    newest = aggregates.as_of_date(rows, "utc")
    return wh.newest_instant(spark, path, newest).select(
        "max_utc",
        F.lit(wh.high_water_date(spark, path, newest)).alias("mark"),
        F.lit(wh.resume_date(spark, path, newest - timedelta(days=3))).alias("resume"),
    )


@registered(
    """WITH m AS (
  SELECT user_id AS "locationId", CASE WHEN event_id % 11 <> 0 THEN ts END AS utc, event_type AS parameter, value FROM events
), d AS (SELECT CAST(max(utc) AS DATE) AS as_of FROM m)
SELECT m.* FROM m, d WHERE utc IS NULL OR date_diff('day', CAST(utc AS DATE), as_of) <= 15"""
)
def rewrite_keeps_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV rewritten by age in place; rows whose time is missing stay."""
    rows = events(spark, sf_dir).select(
        F.col("user_id").alias("locationId"),
        F.when(F.col("event_id") % 11 != 0, F.col("ts").cast("timestamp")).alias("utc"),
        F.col("event_type").alias("parameter"),
        "value",
    )
    path = new_dir(spark, "aged")
    files.write_csv(rows, path, header=True)
    as_of = aggregates.as_of_date(rows, "utc")
    files.rewrite_csv(
        spark, path, MEASUREMENT,
        lambda stored: kept_by_age(stored, "utc", as_of, days=15, undated=True), header=True,
    )
    return files.read_csv(spark, path, MEASUREMENT, header=True)


@registered(
    f"""SELECT s.*, x.s_acctbal + 1 AS value,
  strftime(day, '%Y/%m/%d/') || "locationId" || '/' || parameter || '.json' AS file
FROM ({_SITES_SQL}) s JOIN supplier x ON x.s_suppkey = s."locationId" """
)
def landing_file_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each day, sensor and parameter, each fetched twice: the later values stand there."""
    path = new_dir(spark, "files")
    sites = _site_records(spark, sf_dir).withColumn("date", F.struct(F.lit("").alias("utc")))
    for fetched in (sites, corrected(sites)):
        landing.write_landing_files(fetched, path, "day")
    found = landing.landed_records(spark, path)
    return found.select(
        F.col("locationId").cast("long").alias("locationId"),
        "parameter",
        landing_day(F.col("source_file")).alias("day"),
        F.col("value").cast("double").alias("value"),
        F.substring_index("source_file", "/", -5).alias("file"),
    )
