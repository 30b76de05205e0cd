from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from hazeline.plans import warehouse as wh
from hazeline.plans.clustering import compact_clustered, curve_key, file_ranges, sensor_bounds
from hazeline.schemas import DAY, WAREHOUSE
from shapes import plain, rows

FEB3, FEB4 = "2024-02-03T06:30:00", "2024-02-04T06:30:00"


def readings(spark):
    """Forty sensors, a row every three minutes of one day; sensor 7 has a third of all rows."""
    grid = spark.range(40 * 480).select((F.col("id") % 40).alias("sensor"), (F.col("id") / 40).cast("long").alias("step"))
    hot = spark.range(9600).select(F.lit(7).cast("long").alias("sensor"), (F.col("id") / 20.0).alias("step"))
    every = grid.select("sensor", F.col("step").cast("double").alias("step")).unionByName(hot)
    plain_rows = every.select(
        F.col("sensor").alias("locationId"),
        F.timestamp_micros((F.lit(1_706_918_400_000_000) + F.col("step") * 180_000_000).cast("long")).alias("utc"),
        F.lit("pm1").alias("parameter"),
        F.xxhash64("sensor", "step").cast("double").alias("value"),
    )
    return wh.with_day(plain_rows).select(*WAREHOUSE.names)


def opened(ranges, *, sensor=None, hours=None):
    found = 0
    for row in ranges:
        by_sensor = sensor is None or row.first_sensor <= sensor <= row.last_sensor
        by_hour = hours is None or (row.first_hour < hours[1] and row.last_hour >= hours[0])
        found += by_sensor and by_hour
    return found


def spans(spark, path):
    hour = [F.hour(name).alias(name.replace("utc", "hour")) for name in ("first_utc", "last_utc")]
    return file_ranges(spark, path).select("first_sensor", "last_sensor", "readings", *hour).collect()


def test_files_are_passed_over_by_sensor_and_by_hour(spark, tmp_path):
    path = str(tmp_path / "warehouse")
    readings(spark).repartition(6).write.partitionBy(DAY).orc(path)
    before = wh.read_warehouse(spark, path)
    total = before.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*WAREHOUSE.names) % 1000)).first()
    size = wh.day_files(spark, path).first().bytes
    assert opened(spans(spark, path), sensor=3, hours=(6, 8)) == 6
    compact_clustered(spark, path, [date(2024, 2, 3)], target_bytes=size // 16)
    files = spans(spark, path)
    assert 12 <= len(files) <= 20
    # The hot sensor is not left in one file.
    assert max(row.readings for row in files) < 28_800 / 4
    assert opened(files, sensor=3) <= len(files) / 2
    assert opened(files, hours=(6, 8)) <= len(files) / 2
    assert opened(files, sensor=3, hours=(6, 8)) <= 3
    after = wh.read_warehouse(spark, path)
    assert after.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*WAREHOUSE.names) % 1000)).first() == total


def test_a_cut_off_swap_keeps_its_files(spark, tmp_path, monkeypatch):
    from hazeline.plans import clustering

    path = str(tmp_path / "warehouse")
    batch = rows(spark, *[(number, FEB3, "pm1", 1.0) for number in range(8)], (1, FEB4, "pm1", 2.0))
    wh.append_new(batch, path)
    before = plain(wh.read_warehouse(spark, path))
    calls = []

    def dies(spark, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        wh.finish_swap(spark, path)

    monkeypatch.setattr(clustering, "finish_swap", dies)
    try:
        compact_clustered(spark, path, [date(2024, 2, 3)], target_bytes=1 << 7)
    except RuntimeError:
        pass
    assert plain(wh.read_warehouse(spark, path)) == before
    wh.append_new(rows(spark, (1, FEB4, "pm1", 9.0)), path)
    assert plain(wh.read_warehouse(spark, path)) == before
    counts = {row[DAY]: row.files for row in wh.day_files(spark, path).collect()}
    assert counts[date(2024, 2, 3)] > 1 and counts[date(2024, 2, 4)] == 1
    # A plain compaction after it gathers them again.
    wh.compact(spark, path, [date(2024, 2, 3)])
    counts = {row[DAY]: row.files for row in wh.day_files(spark, path).collect()}
    assert counts[date(2024, 2, 3)] == 1
    assert plain(wh.read_warehouse(spark, path)) == before


def test_days_without_rows_and_an_empty_warehouse(spark, tmp_path):
    path = str(tmp_path / "warehouse")
    compact_clustered(spark, path, [date(2024, 2, 3)])
    wh.append_new(rows(spark, (1, FEB4, "pm1", None)), path)
    compact_clustered(spark, path, [date(2024, 2, 3), date(2024, 2, 4)])
    assert plain(wh.read_warehouse(spark, path)) == [(1, FEB4, "pm1", None)]


def test_the_curve_interleaves_both_axes(spark):
    table = rows(spark, (0, "2024-02-03T00:00:00", "p", 1.0), (0, "2024-02-03T23:59:00", "p", 1.0), (9, "2024-02-03T00:00:00", "p", 1.0), (9, "2024-02-03T23:59:00", "p", 1.0))
    bounds = sensor_bounds(table)
    assert bounds == [0, 9]
    keys = [row[0] for row in table.orderBy("locationId", "utc").select(curve_key([0, 5, 8])).collect()]
    assert keys == [0, 0b0101010101, 0b1010, 0b0101011111]
    assert sensor_bounds(table.limit(0)) == []
