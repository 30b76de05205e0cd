from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from hazeline.operators import gaps, registry
from hazeline.plans import fetch
from shapes import plan_of, rows

D3, D4, D5 = date(2024, 2, 3), date(2024, 2, 4), date(2024, 2, 5)


def sensors(spark, *values):
    return spark.createDataFrame(
        list(values), "locationId long, parameter string, sensor_class string"
    )


SMALL = [(8039, "pm25", "reference"), (220704, "pm1", "community")]


def listed(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def test_day_spine_leaves_today_out(spark):
    assert listed(fetch.day_spine(spark, D3, D5), "date_from", "date_to") == [(D3, D4), (D4, D5)]


def test_nothing_owed(spark):
    assert fetch.day_spine(spark, D3, D3).count() == 0
    assert fetch.day_spine(spark, D5, D3).count() == 0
    assert fetch.slice_spine(spark, D5, D3).count() == 0
    assert fetch.daily_plan(sensors(spark, *SMALL), D5, D5).count() == 0
    assert fetch.sliced_plan(sensors(spark, *SMALL), D5, D3).count() == 0


def test_slices_of_a_day(spark):
    slices = listed(fetch.slice_spine(spark, D3, D4), "slice_from", "slice_to")
    assert len(slices) == 8
    assert slices[0] == (datetime(2024, 2, 3, 0), datetime(2024, 2, 3, 3))
    assert slices[-1] == (datetime(2024, 2, 3, 21), datetime(2024, 2, 4, 0))


def test_first_day_owed():
    assert fetch.fetch_start(None, D3) == D3
    assert fetch.fetch_start(D5, D3) == D5
    assert fetch.fetch_start(D5, D3, lookback_days=1) == D4


def test_daily_windows_by_class(spark):
    plan = fetch.with_requests(fetch.daily_plan(sensors(spark, *SMALL), D3, D4))
    assert listed(plan, "locationId", "from_utc", "to_utc") == [
        (8039, datetime(2024, 2, 2, 18, 30), datetime(2024, 2, 3, 18, 30)),
        (220704, datetime(2024, 2, 3, 15, 30), datetime(2024, 2, 3, 18, 30)),
    ]
    assert listed(plan, "request", "path") == [
        (
            "location_id=220704&parameter=pm1&date_from=2024-02-03T21:00:00+05:30"
            "&date_to=2024-02-04T00:00:00+05:30",
            "2024/02/03/220704/pm1.json",
        ),
        (
            "location_id=8039&parameter=pm25&date_from=2024-02-03T00:00:00+05:30"
            "&date_to=2024-02-04T00:00:00+05:30",
            "2024/02/03/8039/pm25.json",
        ),
    ]


def test_sliced_windows_by_class(spark):
    plan = fetch.sliced_plan(sensors(spark, *SMALL), D3, D4)
    counts = {row.locationId: row["count"] for row in plan.groupBy("locationId").count().collect()}
    assert counts == {8039: 1, 220704: 8}
    whole = plan.filter("locationId = 8039").first()
    assert (whole.to_utc - whole.from_utc).days == 1


def test_plan_needs_no_join_and_no_shuffle(spark):
    plan = plan_of(fetch.daily_plan(sensors(spark, *SMALL), D3, D5))
    assert "Join" not in plan and "Exchange" not in plan


def test_plan_is_filled_cells_and_gaps(spark):
    measured = rows(
        spark,
        (8039, "2024-02-02T18:30:00", "pm25", 1.0),  # first instant of the Indian day
        (220704, "2024-02-03T15:29:59", "pm1", 1.0),  # just before the evening window
        (220704, "2024-02-04T15:30:00", "pm1", 1.0),
        (220704, "2024-02-04T16:30:00", "pm1", 2.0),
        (1, "2024-02-03T16:00:00", "pm1", 2.0),  # not in the registry
    )
    plan = fetch.daily_plan(sensors(spark, *SMALL), D3, D5)
    filled = gaps.filled_cells(measured, [8039])
    missing = gaps.gap_cells(plan, filled)
    assert listed(missing, "locationId", "day") == [(8039, D4), (220704, D3)]
    present = plan.join(filled, gaps.CELL, "left_semi")
    assert listed(present.unionByName(missing), *gaps.CELL) == listed(plan, *gaps.CELL)
    assert present.join(missing, gaps.CELL).count() == 0
    shares = listed(gaps.completeness(plan, filled), "locationId", "planned", "filled", "share")
    assert shares == [(8039, 2, 1, 0.5), (220704, 2, 1, 0.5)]


def test_sliced_cells(spark):
    measured = rows(spark, (220704, "2024-02-03T15:29:59", "pm1", 1.0))
    plan = fetch.sliced_plan(sensors(spark, *SMALL), D3, D4)
    filled = gaps.filled_cells(measured, [8039], sliced=True)
    assert plan.join(filled, gaps.CELL).count() == 1
    assert gaps.gap_cells(plan, filled).count() == 8


def test_cells_do_not_depend_on_the_session_zone(spark):
    measured = rows(spark, (8039, "2024-02-03T20:00:00", "pm25", 1.0))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        cell = gaps.filled_cells(measured, [8039]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert cell.from_utc == datetime(2024, 2, 3, 18, 30)


def test_built_in_registry_is_clean(spark):
    network = registry.default_registry(spark)
    assert network.select("locationId").distinct().count() == 15
    assert registry.duplicates(network).count() == 0
    assert registry.unknown_parameters(network, registry.parameter_units(spark)).count() == 0
    classes = {
        row.sensor_class: row["count"]
        for row in network.groupBy("sensor_class").count().collect()
    }
    assert classes == {"reference": 5, "community": 117}


def test_faulty_listings_are_found(spark):
    listing = sensors(
        spark,
        (66673, "um003", "community"),
        (66673, "um003", "community"),
        (66673, "um010um100pressure", "community"),
        (67569, "pm10", "community"),
        (67569, "pm10", "community"),
    )
    assert listed(registry.duplicates(listing), "locationId", "parameter", "listed") == [
        (66673, "um003", 2),
        (67569, "pm10", 2),
    ]
    unknown = registry.unknown_parameters(listing, registry.parameter_units(spark))
    assert listed(unknown, "parameter") == [("um010um100pressure",)]
    assert listed(listing.distinct(), "locationId", "parameter") == [
        (66673, "um003"),
        (66673, "um010um100pressure"),
        (67569, "pm10"),
    ]


def test_unknown_sensors_stay_visible(spark):
    measured = rows(spark, (8039, "2024-02-03T06:30:00", "pm25", 1.0), (1, "2024-02-03T06:30:00", "pm1", 1.0))
    enriched = registry.enrich(measured, registry.default_registry(spark))
    assert listed(enriched, "locationId", F.coalesce("label", F.lit("?"))) == [(1, "?"), (8039, "Mumbai")]


def test_enrich_without_broadcast_gives_the_same(spark):
    measured = rows(spark, *[(8039, f"2024-02-03T06:{minute:02}:00", "pm25", 1.0) for minute in range(60)])
    network = registry.default_registry(spark)
    small = listed(registry.enrich(measured, network), "locationId", "label")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = registry.enrich(measured, network)
        assert "SortMergeJoin" in plan_of(large)
        assert listed(large, "locationId", "label") == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
