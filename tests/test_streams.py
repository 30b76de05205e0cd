from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators.aggregates import reading_summary, tumbling
from hazeline.plans import warehouse as wh
from hazeline.schemas import MEASUREMENT
from hazeline.sources.landing import bad_rows, read_records, read_staged
from hazeline.streaming import ingest
from shapes import plain, record, write_file


def test_stream_loads_each_key_once_and_nothing_is_too_late(spark, tmp_path):
    landing, warehouse, staging, checkpoint = (
        str(tmp_path / name) for name in ("data", "warehouse", "staging", "checkpoint")
    )

    def drain():
        records = ingest.record_stream(spark, landing)
        ingest.ingest_stream(records, warehouse, staging, checkpoint).awaitTermination()

    root = tmp_path / "data/2024/02"
    write_file(root / "03/8039/pm25.json", [record(value=1.0), record(value=1.0)])
    drain()
    write_file(
        root / "04/8039/pm25.json",
        [record(value=9.0), record(utc="2020-01-01T00:00:00+00:00"), record(utc="never")],
    )
    write_file(root / "04/8118/pm25.json", "[{")
    drain()
    drain()
    assert plain(wh.read_warehouse(spark, warehouse)) == [
        (8039, "2020-01-01T00:00:00", "pm25", 1.5),
        (8039, "2024-02-03T06:30:00", "pm25", 1.0),
    ]
    reasons = [row.reason for row in bad_rows(read_staged(spark, f"{staging}/batch=1")).collect()]
    assert sorted(reasons) == ["malformed", "utc"]


def test_repeated_micro_batch_adds_nothing(spark, tmp_path):
    landing, warehouse, staging = (str(tmp_path / name) for name in ("data", "warehouse", "staging"))
    write_file(tmp_path / "data/2024/02/03/8039/pm25.json", [record()])
    # A lost checkpoint replays every file.
    for run in ("a", "b"):
        records = ingest.record_stream(spark, landing, max_files_per_trigger=1)
        ingest.ingest_stream(records, warehouse, staging, str(tmp_path / run)).awaitTermination()
    assert wh.read_warehouse(spark, warehouse).count() == 1


def test_watermarked_copies_are_dropped(spark, tmp_path):
    landing, sink, checkpoint = (str(tmp_path / name) for name in ("data", "sink", "checkpoint"))
    for day in ("03", "04"):
        write_file(tmp_path / f"data/2024/02/{day}/8039/pm25.json", [record(), record()])
        rows = ingest.measurement_stream(ingest.record_stream(spark, landing))
        ingest.drain_to_files(ingest.first_per_key(rows, "2 days"), sink, checkpoint)
    assert spark.read.schema(MEASUREMENT).orc(sink).count() == 1


def test_closed_windows_equal_the_batch_result(spark, tmp_path):
    landing, sink, checkpoint = (str(tmp_path / name) for name in ("data", "sink", "checkpoint"))
    write_file(
        tmp_path / "data/2024/02/03/8039/pm25.json",
        [
            record(value=float(hour), utc=f"2024-02-03T{hour:02}:{minute}:00+00:00")
            for hour in range(0, 24)
            for minute in ("00", "59")
        ],
    )
    windows = ingest.window_readings(
        ingest.measurement_stream(ingest.record_stream(spark, landing)), "1 hour"
    )
    schema = windows.schema
    ingest.drain_to_files(windows, sink, checkpoint)
    batch = tumbling(
        ingest.measurement_stream(read_records(spark, landing)),
        "utc",
        "3 hours",
        ["locationId", "parameter"],
        *reading_summary(),
    )
    # The watermark is 22:59, so only the window that ends at midnight stays open.
    closed = batch.filter(F.col("window_start") < F.lit("2024-02-03T21:00:00Z").cast("timestamp"))
    streamed = spark.read.schema(schema).orc(sink)
    order = sorted(streamed.columns)
    found = sorted(map(str, streamed.select(order).collect()))
    assert found == sorted(map(str, closed.select(order).collect()))
    assert len(found) == 7
