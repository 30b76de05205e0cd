from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazeline.functions.timestamps import (
    epoch_seconds,
    india_text,
    parse_instant,
    unix_round_trip,
    utc_day,
    wall_of_epoch,
)
from hazeline.operators import filters
from hazeline.operators.projections import flattened, local_parsed
from hazeline.schemas import RECORD
from shapes import plan_of, record


def walls(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "text string").select(
        F.col("text").cast("timestamp_ntz").alias("utc")
    )


def kept(df):
    return sorted(str(row["utc"]) for row in df.select(F.col("utc").cast("string").alias("utc")).collect())


def test_parse_instant(spark):
    texts = [
        ("2024-02-03T06:30:00+00:00", "2024-02-03 06:30:00"),
        ("2024-02-03T12:00:00+05:30", "2024-02-03 06:30:00"),
        ("2024-02-03T06:30:00Z", "2024-02-03 06:30:00"),
        ("2024-02-03T06:30:00.25+00:00", "2024-02-03 06:30:00.25"),
        ("2024-02-30T06:30:00+00:00", None),
        ("2024-02-03 06:30:00", None),
        ("junk", None),
        (None, None),
    ]
    df = spark.createDataFrame(texts, "text string, wanted string")
    parsed = df.select(parse_instant(F.col("text")).cast("string").alias("got"), "wanted")
    assert [row.got for row in parsed.collect()] == [wanted for _, wanted in texts]


def test_unix_round_trip_is_in_the_session_zone(spark):
    df = spark.createDataFrame([("2024-02-03T12:00:00+05:30",)], "text string")
    assert df.select(unix_round_trip(F.col("text"))).first()[0] == "2024-02-03 06:30:00"


def test_utc_day_and_clock_in_another_session_zone(spark):
    df = spark.createDataFrame(
        [(datetime(2023, 12, 31, 20, 30, tzinfo=timezone.utc),)], "utc timestamp"
    )
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        row = df.select(
            utc_day(df, "utc").alias("day"),
            wall_of_epoch(epoch_seconds(df, "utc")).alias("wall"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.day == date(2023, 12, 31)
    assert row.wall == datetime(2023, 12, 31, 20, 30)


def test_epoch_seconds_of_both_types(spark):
    texts = ["1969-12-31 23:59:59.5", "1970-01-01", "2024-02-29 23:59:59.999999"]
    df = walls(spark, *texts).withColumn("instant", F.col("utc").cast("timestamp"))
    wanted = [-1, 0, 1709251199]
    for column in ("utc", "instant"):
        seconds = df.select(epoch_seconds(df, column).alias("seconds"))
        assert [row.seconds for row in seconds.collect()] == wanted
    back = df.select(wall_of_epoch(epoch_seconds(df, "utc")).cast("string").alias("wall"))
    assert back.collect()[-1].wall == "2024-02-29 23:59:59"


def test_years_are_utc_years_unless_asked_otherwise(spark):
    df = walls(spark, "2023-12-31 20:30:00", "2022-12-31 18:29:59", "2022-12-31 18:30:00")
    as_of = date(2024, 5, 1)
    assert kept(filters.recent_years(df, "utc", as_of)) == ["2023-12-31 20:30:00"]
    assert kept(filters.recent_years(df, "utc", as_of, tz="Asia/Kolkata")) == [
        "2022-12-31 18:30:00",
        "2023-12-31 20:30:00",
    ]
    assert kept(filters.recent_years(df, "utc", date(2022, 6, 1), tz="Asia/Kolkata")) == [
        "2022-12-31 18:29:59"
    ]


def test_both_year_forms_agree(spark):
    df = walls(
        spark, "2022-12-31 23:59:59.999999", "2023-01-01", "2024-12-31 23:59:59", "2025-01-01"
    )
    as_of = date(2024, 7, 7)
    by_range = kept(filters.recent_years(df, "utc", as_of))
    assert by_range == kept(filters.recent_years_by_year(df, "utc", as_of))
    assert len(by_range) == 2


def test_age_730_is_kept_and_731_is_not(spark):
    as_of = date(2024, 2, 10)
    df = walls(
        spark,
        str(as_of - timedelta(days=730)),
        str(as_of - timedelta(days=731)) + " 23:59:59.999999",
    )
    keep = filters.kept_by_age(df, "utc", as_of)
    gone = filters.expired_by_age(df, "utc", as_of)
    assert [row[0] for row in keep.select(filters.age_in_days(keep, "utc", as_of)).collect()] == [730]
    assert [row[0] for row in gone.select(filters.age_in_days(gone, "utc", as_of)).collect()] == [731]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.datetimes(datetime(2020, 1, 1), datetime(2025, 1, 1)), min_size=1, max_size=20),
    st.integers(0, 1500),
)
def test_kept_and_expired_split_the_rows(spark, times, days):
    df = walls(spark, *[time.isoformat(" ") for time in times])
    as_of = date(2024, 2, 10)
    keep = kept(filters.kept_by_age(df, "utc", as_of, days))
    gone = kept(filters.expired_by_age(df, "utc", as_of, days))
    assert sorted(keep + gone) == kept(df)
    assert len(keep) == sum((as_of - time.date()).days <= days for time in times)


def test_india_window_is_half_open(spark):
    df = walls(spark, "2024-02-02 18:29:59", "2024-02-02 18:30:00", "2024-02-03 18:30:00")
    inside = filters.india_window(df, "utc", datetime(2024, 2, 3), datetime(2024, 2, 4))
    assert kept(inside) == ["2024-02-02 18:30:00"]


def test_sensor_class(spark):
    df = spark.createDataFrame([(8039,), (220704,)], "locationId long")
    klass = filters.sensor_class(F.col("locationId"), [8039])
    assert [row[0] for row in df.select(klass).collect()] == ["reference", "community"]


@pytest.mark.parametrize("table, column", [("events", "ts"), ("orders", "o_orderdate")])
def test_year_range_reaches_the_scan(spark, table, column):
    df = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").select(column)
    plan = plan_of(filters.recent_years(df, column, date(2000, 1, 1)))
    assert f"GreaterThanOrEqual({column},1999-01-01T00:00)" in plan
    assert f"LessThan({column},2001-01-01T00:00)" in plan


def test_projections_of_nested_records(spark):
    records = spark.createDataFrame([record(utc="2024-02-03T06:30:00+00:00")], RECORD)
    flat = flattened(records).first()
    assert flat.local_timestamp == "2024-02-03T12:00:00+05:30"
    assert (flat.latitude, flat.longitude) == (19.07, 72.88)
    assert not {"date", "coordinates", "country", "city"} & set(flat.asDict())
    parsed = local_parsed(records).select(F.col("local_time").cast("string")).first()
    assert parsed[0] == "2024-02-03 06:30:00"


def test_india_text(spark):
    df = walls(spark, "2024-02-03 20:00:00")
    assert df.select(india_text(F.col("utc"))).first()[0] == "2024-02-04T01:30:00.000000+05:30"
