"""The ledger, the swap without Spark's marker, snapshots, rollups, gaps."""

from __future__ import annotations

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hazeline.operators.gaps import gap_runs
from hazeline.plans import ledger, rollups, snapshots
from hazeline.plans import warehouse as wh
from hazeline.plans.cycle import load_new_files, read_quarantine
from hazeline.schemas import MEASUREMENT
from hazeline.sources.landing import bad_rows, read_staged
from hazeline.streaming import ingest
from shapes import plain, record, rows, write_file

FEB3, FEB4 = "2024-02-03T06:30:00", "2024-02-04T06:30:00"
END = date(2024, 2, 10)


@pytest.fixture
def load(spark, tmp_path):
    def run(start=None, end=END, **options):
        paths = [str(tmp_path / name) for name in ("data", "warehouse", "quarantine", "ledger")]
        return load_new_files(spark, *paths, start=start, end=end, **options)

    run.stored = lambda: plain(wh.read_warehouse(spark, str(tmp_path / "warehouse")))
    run.bad = lambda: read_quarantine(spark, str(tmp_path / "quarantine")).collect()
    run.entered = lambda: ledger.read_ledger(spark, str(tmp_path / "ledger")).collect()
    return run


def test_late_and_rewritten_files_are_loaded_once(load, tmp_path):
    root = tmp_path / "data/2024/02"
    write_file(root / "05/1/pm1.json", [record(1, "pm1", 1.0, f"{FEB4}+00:00")])
    assert (load(), load()) == (1, 0)
    # Late, in an older folder, lines instead of an array, and a name that looks like a pattern.
    write_file(root / "03/2/pm{1,2}.json", '{"locationId": 2, "parameter": "pm1", "value": 2.0, "date": {"utc": "2024-02-03T06:30:00+00:00"}}\n' * 2)
    write_file(root / "05/1/pm1.json", [record(1, "pm1", 7.5, f"{FEB4}+00:00")])
    write_file(root / "20/1/pm1.json", [record(9)])  # not before the end
    assert (load(), load()) == (1, 0)
    assert load.stored() == [(1, FEB4, "pm1", 7.5), (2, FEB3, "pm1", 2.0)]
    assert sorted(row.day for row in load.entered()) == [date(2024, 2, 3), date(2024, 2, 5), date(2024, 2, 5)]
    assert load(start=date(2024, 2, 4)) == 0


def test_a_run_cut_off_goes_on_with_the_files_not_entered(load, tmp_path, monkeypatch):
    for day in range(1, 6):
        write_file(tmp_path / f"data/2024/02/0{day}/1/pm1.json", [record(day), record(day) | {"value": "x"}])
    entered = ledger.enter
    calls = []

    def fails_once(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        entered(*args)

    monkeypatch.setattr(ledger, "enter", fails_once)
    with pytest.raises(RuntimeError):
        load(load_files=1)
    assert len(load.entered()) == 2 and len(load.stored()) == 3  # stored, not entered
    assert load(load_files=1) == 3
    assert [row[0] for row in load.stored()] == [1, 2, 3, 4, 5]
    bad = load.bad()  # the repeated load's rows once
    assert sorted(row.loaded_from.day for row in bad) == [1, 2, 3, 4, 5] and {row.reason for row in bad} == {"value"}


def test_loads_are_bounded_and_in_landing_order(spark, load, tmp_path):
    for day in (3, 1, 2):
        for sensor in range(4):
            write_file(tmp_path / f"data/2024/02/0{day}/{sensor}/pm1.json", [record(sensor, "pm1", float(day))])
    files = ledger.landing_files(spark, str(tmp_path / "data"), None, END)
    size = files.first().length
    found = list(ledger.loads(files, load_files=5))
    assert [len(each.files) for each in found] == [5, 5, 2]
    days = [file[3] for each in found for file in each.files]
    assert days == sorted(days) and found[1].first_day == date(2024, 2, 2)
    assert [len(each.files) for each in ledger.loads(files, load_bytes=3 * size)] == [3, 3, 3, 3]
    assert len({each.id for each in found}) == 3 and found[0].id == next(ledger.loads(files, load_files=5)).id
    assert load(load_files=5) == 3
    assert load.stored() == [(sensor, FEB3, "pm1", 3.0) for sensor in range(4)]


def test_empty_tree_has_nothing_to_load(load, tmp_path):
    os.makedirs(tmp_path / "data")
    assert load() == 0


def test_days_are_swapped_where_spark_leaves_no_marker(spark, tmp_path):
    path, option = str(tmp_path / "warehouse"), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    spark.conf.set(option, "false")
    try:
        wh.upsert(rows(spark, (1, FEB3, "pm1", 9.0)), path)
        wh.upsert(rows(spark, (1, FEB3, "pm1", 1.0), (1, FEB4, "pm1", 2.0)), path)
        assert not (tmp_path / "warehouse/_SUCCESS").exists()
        assert plain(wh.read_warehouse(spark, path)) == [(1, FEB3, "pm1", 1.0), (1, FEB4, "pm1", 2.0)]
        wh.write_days(rows(spark, (2, FEB3, "pm1", 3.0)), path)
        wh.compact(spark, path, [date(2024, 2, 3)])
        assert len(plain(wh.read_warehouse(spark, path))) == 3
        # Staged in part only: no marker, so the stored day stands.
        wh.write_days(rows(spark, (5, FEB3, "pm1", 5.0)), f"{path}/{wh.SWAP}", replace_all=True)
        wh.finish_swap(spark, path)
        assert len(plain(wh.read_warehouse(spark, path))) == 3
        # Staged in full: the next load swaps it.
        wh.stage_swap(rows(spark, (5, FEB3, "pm1", 5.0)), path)
        wh.append_new(rows(spark, (6, FEB4, "pm1", 6.0)), path)
    finally:
        spark.conf.unset(option)
    assert [row[0] for row in plain(wh.read_warehouse(spark, path))] == [1, 5, 6]


def test_one_wrong_field_of_a_streamed_array_spoils_its_row(spark, tmp_path):
    names = ("data", "warehouse", "staging", "checkpoint")
    landing, warehouse, staging, checkpoint = (str(tmp_path / name) for name in names)
    hours = [f"2024-02-03T0{hour}:30:00+00:00" for hour in range(4)]
    good = [record(utc=hours[0]), record(utc=hours[1]), record(utc=hours[3], isMobile="perhaps")]
    write_file(tmp_path / "data/2024/02/03/8039/pm25.json", [*good, record(value="abc", utc=hours[2])])
    records = ingest.record_stream(spark, landing)
    ingest.ingest_stream(records, warehouse, staging, checkpoint).awaitTermination()
    assert wh.read_warehouse(spark, warehouse).count() == 3
    (bad,) = bad_rows(read_staged(spark, f"{staging}/batch=0")).collect()
    assert bad.reason == "value" and "abc" in bad.raw


def test_readers_see_whole_publications(spark, tmp_path, monkeypatch):
    one, two = (str(tmp_path / name) for name in ("one", "two"))
    extract = lambda value: rows(spark, (1, FEB3, "pm1", value)).drop("utc_date")
    assert snapshots.read_snapshot(spark, one, MEASUREMENT).count() == 0
    snapshots.publish_snapshots(extract(1.0), [one, two])
    marked = snapshots.mark

    def fails(spark, path):
        if path.startswith(two):
            raise OSError("disk full")
        marked(spark, path)

    monkeypatch.setattr(snapshots, "mark", fails)
    with pytest.raises(OSError):
        snapshots.publish_snapshots(extract(2.0), [one, two])
    monkeypatch.undo()
    values = [snapshots.read_snapshot(spark, root, MEASUREMENT).first()["value"] for root in (one, two)]
    assert values == [2.0, 1.0]
    reading = snapshots.read_snapshot(spark, one, MEASUREMENT)
    for value in (3.0, 4.0):
        snapshots.publish_snapshots(extract(value), [one, two])
        if value == 3.0:
            assert reading.first()["value"] == 2.0  # still there for who reads it
    assert [len(os.listdir(f"{root}/versions")) for root in (one, two)] == [2, 2]
    numbers = [number for number, _ in snapshots.markers(spark, one)]
    assert numbers == [3, 4] and snapshots.read_snapshot(spark, two, MEASUREMENT).first()["value"] == 4.0


def test_rollups_follow_touched_days_only(spark, tmp_path):
    path, state = str(tmp_path / "warehouse"), str(tmp_path / "rollup")
    rollups.refresh(spark, path, state)
    assert rollups.read_state(spark, state).count() == 0
    wh.upsert(rows(spark, (1, FEB3, "pm1", 1.0), (1, FEB4, "pm1", None), (1, "2023-12-31T23:59:00", "pm1", 5.0)), path)
    rollups.refresh(spark, path, state)
    old = {f: os.stat(f"{state}/utc_date=2024-02-04/{f}").st_mtime_ns for f in os.listdir(f"{state}/utc_date=2024-02-04")}
    batch = rows(spark, (1, FEB3, "pm1", 2.0), (1, "2024-02-03T07:00:00", "pm1", 4.0))
    wh.upsert(batch, path)
    rollups.refresh(spark, path, state, batch)
    rollups.refresh(spark, path, state, batch)
    assert {f: os.stat(f"{state}/utc_date=2024-02-04/{f}").st_mtime_ns for f in os.listdir(f"{state}/utc_date=2024-02-04")} == old
    held = rollups.read_state(spark, state)
    whole = rollups.state_of(wh.read_warehouse(spark, path))
    assert held.exceptAll(whole).count() == whole.exceptAll(held).count() == 0
    days = {r.utc_date: (r.readings, r.total, r["mean"], r.greatest) for r in rollups.by_day(held).collect()}
    assert days[date(2024, 2, 3)] == (2, 6.0, 3.0, 4.0) and days[date(2024, 2, 4)] == (1, None, None, None)
    years = {r.year: (r.readings, r.total, r["mean"]) for r in rollups.by_year(held).collect()}
    assert years == {2023: (1, 5.0, 5.0), 2024: (3, 6.0, 3.0)}
    assert rollups.newest(held).first()["max_year"] == 2024
    rollups.refresh(spark, path, state, batch.limit(0))
    assert rollups.read_state(spark, state).count() == held.count()


@pytest.mark.parametrize("hours", [1, 6, 24])
def test_gap_runs_equal_a_walk_over_the_cells(spark, hours):
    times = {("a", 1): ["2024-02-01T18:29:00", "2024-02-01T18:30:00", "2024-02-02T05:00:00", "2024-02-02T05:10:00"], ("a", 2): [], ("b", 1): ["2024-01-01T00:00:00"]}
    values = [(location, utc, parameter, 1.0) for (parameter, location), listed in times.items() for utc in listed]
    values.append((7, "2024-02-02T00:00:00", "a", 1.0))  # not in the registry
    sensors = spark.createDataFrame([(l, p) for p, l in times] * 2, "locationId long, parameter string")
    start, end = date(2024, 2, 2), date(2024, 2, 4)
    found = gap_runs(rows(spark, *values), sensors, start, end, hours).select(
        "locationId", "parameter", F.col("from_utc").cast("string"), F.col("to_utc").cast("string"), "cells"
    )
    opens = wh.datetime.combine(start, wh.datetime.min.time()) - timedelta(hours=5.5)
    expected = []
    for (parameter, location), listed in times.items():
        filled = {(wh.datetime.fromisoformat(t) - opens) // timedelta(hours=hours) for t in listed}
        run = None
        for cell in range(48 // hours + 1):
            if cell < 48 // hours and cell not in filled:
                run = cell if run is None else run
            elif run is not None:
                begin, finish = (opens + timedelta(hours=hours * c) for c in (run, cell))
                expected.append((location, parameter, str(begin), str(finish), cell - run))
                run = None
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert gap_runs(rows(spark, *values), sensors, end, start, hours).count() == 0


