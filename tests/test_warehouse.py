from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazeline.operators.aggregates import as_of_date, latest_per_key
from hazeline.plans import warehouse as wh
from hazeline.schemas import DAY, KEY, WAREHOUSE
from hazeline.sources import files
from shapes import plain, plan_of, rows

FEB3, FEB4, FEB5 = "2024-02-03T06:30:00", "2024-02-04T06:30:00", "2024-02-05T06:30:00"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "warehouse")


@pytest.mark.parametrize("load", [wh.append_new, wh.upsert])
def test_loading_twice_is_loading_once(spark, path, load):
    batch = rows(spark, (1, FEB3, "pm1", 1.0), (1, FEB4, "pm1", 2.0), (1, FEB4, "pm1", 2.0))
    load(batch, path)
    once = plain(wh.read_warehouse(spark, path))
    load(batch, path)
    assert plain(wh.read_warehouse(spark, path)) == once
    assert len(once) == 2


def test_append_keeps_the_first_value_and_upsert_the_last(spark, path, tmp_path):
    first = rows(spark, (1, FEB3, "pm1", 1.0), (1, FEB5, "pm1", 5.0))
    fix = rows(spark, (1, FEB3, "pm1", 9.0), (1, FEB4, "pm1", 2.0))
    other = str(tmp_path / "other")
    for target, load in ((path, wh.append_new), (other, wh.upsert)):
        load(first, target)
        load(fix, target)
    assert [row[3] for row in plain(wh.read_warehouse(spark, path))] == [1.0, 2.0, 5.0]
    assert [row[3] for row in plain(wh.read_warehouse(spark, other))] == [9.0, 2.0, 5.0]


def test_a_correction_may_be_null(spark, path):
    wh.upsert(rows(spark, (1, FEB3, "pm1", 1.0)), path)
    wh.upsert(rows(spark, (1, FEB3, "pm1", None)), path)
    assert plain(wh.read_warehouse(spark, path)) == [(1, FEB3, "pm1", None)]


def test_empty_batch_changes_nothing(spark, path):
    none = spark.createDataFrame([], WAREHOUSE)
    wh.upsert(none, path)
    wh.append_new(none, path)
    assert wh.read_warehouse(spark, path).count() == 0
    wh.upsert(rows(spark, (1, FEB3, "pm1", 1.0)), path)
    wh.upsert(none, path)
    assert wh.read_warehouse(spark, path).count() == 1


def test_upsert_leaves_other_days_alone(spark, path, tmp_path):
    wh.upsert(rows(spark, (1, FEB3, "pm1", 1.0), (1, FEB4, "pm1", 2.0)), path)
    before = sorted(file.name for file in (tmp_path / "warehouse/utc_date=2024-02-03").iterdir())
    wh.upsert(rows(spark, (1, FEB4, "pm1", 3.0)), path)
    after = sorted(file.name for file in (tmp_path / "warehouse/utc_date=2024-02-03").iterdir())
    assert before == after


def test_touched_days_are_the_batch_days_and_prune_by_range(spark, path):
    wh.write_days(
        rows(spark, (1, FEB3, "pm1", 1.0), (1, FEB4, "pm1", 2.0), (1, FEB5, "pm1", 3.0)), path
    )
    stored = wh.read_warehouse(spark, path)
    ends = wh.touched(stored, rows(spark, (1, FEB3, "pm1", 1.0), (1, FEB5, "pm1", 2.0)))
    assert [row[1] for row in plain(ends)] == [FEB3, FEB5]
    assert "utc_date#" in plan_of(ends) and "<= 2024-02-05" in plan_of(ends)
    assert wh.touched(stored, spark.createDataFrame([], WAREHOUSE)) is None


def test_new_days_are_written_beside_a_swap(spark, path, tmp_path):
    wh.upsert(rows(spark, (1, FEB3, "pm1", 1.0)), path)
    wh.upsert(rows(spark, (1, FEB3, "pm1", 2.0), (1, FEB4, "pm1", 3.0)), path)
    assert plain(wh.read_warehouse(spark, path)) == [(1, FEB3, "pm1", 2.0), (1, FEB4, "pm1", 3.0)]
    assert not (tmp_path / "warehouse" / wh.SWAP).exists()


@pytest.mark.parametrize("load", [wh.append_new, wh.upsert])
def test_a_swap_that_died_is_finished_by_the_next_load(spark, path, tmp_path, load, monkeypatch):
    wh.upsert(rows(spark, (1, FEB3, "pm1", 1.0), (2, FEB3, "pm1", 5.0)), path)
    real, calls = wh.finish_swap, []

    def dies(spark, path):
        calls.append(path)
        if len(calls) > 1:
            # The day is deleted, and the new files never get to their place.
            for file in (tmp_path / "warehouse/utc_date=2024-02-03").iterdir():
                file.unlink()
            raise RuntimeError("lost")
        real(spark, path)

    monkeypatch.setattr(wh, "finish_swap", dies)
    with pytest.raises(RuntimeError):
        wh.upsert(rows(spark, (1, FEB3, "pm1", 2.0)), path)
    monkeypatch.setattr(wh, "finish_swap", real)
    load(rows(spark, (1, FEB4, "pm1", 3.0)), path)
    assert plain(wh.read_warehouse(spark, path)) == [
        (1, FEB3, "pm1", 2.0), (1, FEB4, "pm1", 3.0), (2, FEB3, "pm1", 5.0)
    ]


_VALUES = st.one_of(st.none(), st.integers(0, 5).map(float))
_ROWS = st.lists(
    st.tuples(st.integers(1, 2), st.sampled_from([FEB3, FEB4]), st.sampled_from(["a", "b"]), _VALUES),
    max_size=12,
)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(_ROWS, _ROWS)
def test_merge_and_new_rows_against_brute_force(spark, stored, batch):
    stored = list({row[:3]: row for row in stored}.values())
    greatest = defaultdict(list)
    for row in batch:
        greatest[row[:3]].append(row[3])
    incoming = {
        key: max((value for value in values if value is not None), default=None)
        for key, values in greatest.items()
    }
    held = {row[:3]: row[3] for row in stored}
    old, new = rows(spark, *stored), rows(spark, *batch)
    listed = lambda found: sorted(((*key, value) for key, value in found.items()), key=str)
    assert plain(wh.merged(old, new)) == listed({**held, **incoming})
    fresh = {key: value for key, value in incoming.items() if key not in held}
    assert plain(wh.new_rows(old, new)) == listed(fresh)


def test_copies_of_one_key_are_combined_before_the_shuffle(spark):
    # A third of the batch is one key.
    hot = spark.range(3000).select(
        F.when(F.col("id") < 1000, 1).otherwise(F.col("id")).cast("long").alias("locationId"),
        F.lit(datetime(2024, 2, 3, tzinfo=timezone.utc)).alias("utc"),
        F.lit("pm1").alias("parameter"),
        F.col("id").cast("double").alias("value"),
    )
    batch = wh.with_day(hot)
    loaded = wh.merged(spark.createDataFrame([], WAREHOUSE), batch)
    assert loaded.count() == 2001
    assert loaded.filter("locationId = 1").first()["value"] == 999.0
    plan = plan_of(wh.new_rows(batch, batch))
    above, below = plan.split("Exchange", 1)
    assert "HashAggregate" in above and "HashAggregate" in below and "Join" not in plan


def test_latest_per_key_takes_the_last_batch_whole(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0, "x"), (1, 2, 3.0, "y"), (1, 2, 3.0, "z"), (2, 1, None, "w")],
        "id int, batch_no int, value double, note string",
    )
    found = latest_per_key(df, ["id"], ["batch_no"]).collect()
    assert sorted(map(tuple, found)) == [(1, 2, 3.0, "z"), (2, 1, None, "w")]


def test_range_read_prunes_days(spark, path):
    wh.write_days(rows(spark, (1, FEB3, "pm1", 1.0), (1, FEB4, "pm1", 2.0)), path)
    start = datetime(2024, 2, 3, tzinfo=timezone.utc)
    end = datetime(2024, 2, 4, tzinfo=timezone.utc)
    part = wh.read_warehouse(spark, path, start, end)
    assert plain(part) == [(1, FEB3, "pm1", 1.0)]
    plan = plan_of(part)
    assert "(utc_date" in plan and "<= 2024-02-03)" in plan
    assert "GreaterThanOrEqual(utc," in plan and "LessThan(utc," in plan


def test_high_water_date(spark, path):
    as_of = date(2024, 2, 10)
    assert wh.high_water_date(spark, path, as_of) is None
    wh.write_days(rows(spark, (1, "2019-05-01T00:00:00", "pm1", 1.0)), path)
    assert wh.high_water_date(spark, path, as_of) == date(2019, 5, 1)
    wh.write_days(rows(spark, (1, "2023-12-01T00:00:00", "pm1", 1.0)), path)
    assert wh.high_water_date(spark, path, as_of) == date(2023, 12, 1)
    wh.write_days(rows(spark, (1, FEB3, "pm1", 1.0), (1, "2024-02-11T01:00:00", "pm1", 1.0)), path)
    assert wh.high_water_date(spark, path, as_of) == date(2024, 2, 11)
    newest = wh.newest_instant(spark, path, as_of).select(F.col("max_utc").cast("string"))
    assert newest.first()[0] == "2024-02-11 01:00:00"


def test_as_of_comes_from_the_data(spark):
    assert as_of_date(rows(spark, (1, FEB3, "pm1", 1.0)), "utc") == date(2024, 2, 3)


def test_compaction_keeps_rows_and_cuts_files(spark, path):
    for number in range(5):
        wh.write_days(rows(spark, (number, FEB3, "pm1", 1.0)), path)
    wh.write_days(rows(spark, (1, FEB4, "pm1", 1.0)), path)
    before = plain(wh.read_warehouse(spark, path))
    counts = {row[DAY]: row.files for row in wh.day_files(spark, path).collect()}
    assert counts == {date(2024, 2, 3): 5, date(2024, 2, 4): 1}
    days = wh.fragmented_days(spark, path)
    assert days == [date(2024, 2, 3)]
    wh.compact(spark, path, days)
    counts = {row[DAY]: row.files for row in wh.day_files(spark, path).collect()}
    assert counts == {date(2024, 2, 3): 1, date(2024, 2, 4): 1}
    assert plain(wh.read_warehouse(spark, path)) == before


def test_old_orc_with_text_times_is_migrated(spark, path, tmp_path):
    old = str(tmp_path / "old")
    files.write_orc(
        spark.createDataFrame(
            [(1, "2024-02-03T06:30:00+00:00", "pm1", 1.0), (1, "2024-02-04T12:00:00+05:30", "pm1", 2.0)],
            "locationId long, utc string, parameter string, value double",
        ),
        old,
    )
    wh.migrate_text_orc(spark, old, path)
    assert plain(wh.read_warehouse(spark, path)) == [(1, FEB3, "pm1", 1.0), (1, FEB4, "pm1", 2.0)]


def test_key_is_the_load_key():
    assert KEY == ["locationId", "parameter", "utc"]
