"""Registry history, replay of rows set aside, corrected windows, publishing by touched days."""

from __future__ import annotations

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hazeline.operators.history import enrich_as_of
from hazeline.plans import cycle, replay, rollups
from hazeline.plans import warehouse as wh
from hazeline.plans.publish import read_published_days
from hazeline.streaming import ingest
from shapes import at, plain, plan_of, record, rows, write_file

DAY3, DAY4 = "2024-02-03", "2024-02-04"
HISTORY = "locationId long, parameter string, label string, grade int, valid_from timestamp"
READINGS = "locationId long, utc timestamp, parameter string, value double, side string, version int"


def _moment(draw):
    return at("2024-02-01T00:00:00") + timedelta(minutes=30 * draw.randrange(0, 48 * 6))


def _cases(seed):
    draw = random.Random(seed)
    sensors = [(1, "a"), (1, "b"), (2, "a"), (3, "a"), (None, "a"), (4, None)]
    readings = [(*draw.choice(sensors), _moment(draw) if draw.random() < 0.95 else None) for _ in range(300)]
    readings += [(1, "a", _moment(draw)) for _ in range(300)]  # a sensor with half of all rows
    readings += readings[:20]
    versions = [(*draw.choice(sensors[:3] + sensors[4:]), draw.choice(["x", "y", None]), draw.choice([1, 2, None]),
                 _moment(draw) if draw.random() < 0.9 else None) for _ in range(40)]
    return readings, versions + versions[:5]


def _holds(versions, location, parameter, utc):
    fits = [
        (valid, label is not None, label or "", grade is not None, grade or 0)
        for l, p, label, grade, valid in versions
        if None not in (l, p, valid, location, parameter, utc) and (l, p) == (location, parameter) and valid <= utc
    ]
    if not fits:
        return None, None
    _, labelled, label, graded, grade = max(fits)
    return (label if labelled else None), (grade if graded else None)


@pytest.mark.parametrize("hours", [1, 24, 24 * 365])
def test_enrichment_as_of_equals_a_search(spark, hours):
    readings, versions = _cases(hours)
    listed = [(l, u, p, float(i), "s", i) for i, (l, p, u) in enumerate(readings)]
    frame = spark.createDataFrame(listed, READINGS).repartition(5)
    out = enrich_as_of(frame, spark.createDataFrame(versions, HISTORY), cell_hours=hours)
    assert out.columns == [*frame.columns, "label", "grade"]
    found = {r.version: (r.label, r.grade) for r in out.collect()}
    assert len(found) == len(readings) == out.count()
    for i, (location, parameter, utc) in enumerate(readings):
        assert found[i] == _holds(versions, location, parameter, utc), readings[i]


def test_enrichment_without_rows_joins_or_clashes(spark):
    readings, versions = spark.createDataFrame([], READINGS), spark.createDataFrame([], HISTORY)
    one = spark.createDataFrame([(1, at("2024-02-03T00:00:00"), "a", 1.0, "s", 1)], READINGS)
    assert enrich_as_of(readings, versions).count() == 0
    assert [(r.label, r.value) for r in enrich_as_of(one, versions).collect()] == [(None, 1.0)]
    plan = plan_of(enrich_as_of(one, versions))
    assert "Join" not in plan and "CartesianProduct" not in plan
    with pytest.raises(ValueError, match="VALUE"):
        enrich_as_of(one, versions.withColumn("VALUE", F.lit(1)))


@pytest.fixture
def tree(spark, tmp_path):
    names = ("data", "warehouse", "quarantine", "ledger", "latest", "resolved")
    paths = {name: str(tmp_path / name) for name in names}

    def run(**options):
        return cycle.run_daily(
            spark, paths["data"], paths["warehouse"], paths["quarantine"], [paths["latest"]],
            as_of=date(2024, 2, 10), bootstrap_start=date(2024, 2, 1), ledger=paths["ledger"], **options,
        )

    run.paths = paths
    run.land = lambda day, name, *listed: write_file(tmp_path / f"data/2024/02/{day}/8039/{name}.json", list(listed))
    run.stored = lambda: plain(wh.read_warehouse(spark, paths["warehouse"]))
    run.published = lambda: plain(read_published_days(spark, paths["latest"]))
    run.replay = lambda **repairs: replay.replay(
        spark, paths["quarantine"], paths["resolved"], paths["warehouse"], repairs
    )
    run.open = lambda: replay.open_rows(spark, paths["quarantine"], paths["resolved"])
    return run


def _spoilt(tree):
    tree.land(
        "03", "pm25", record(utc=f"{DAY3}T01:00:00+00:00", value="1,5"), record(utc=f"{DAY3}T02:00:00+00:00", value="n/a"),
        record(utc="3 Feb", value=4.0), record(utc=f"{DAY3}T05:00:00+00:00", value=5.0),
    )
    tree()


def _comma():
    return F.replace(F.col("value"), F.lit(","), F.lit("."))


def test_replay_twice_equals_once(tree, spark):
    assert tree.replay(value=_comma()) == 0
    _spoilt(tree)
    assert tree.open().count() == 3
    assert tree.replay(value=_comma()) == 1
    once = tree.stored()
    assert [r[1:] for r in once] == [(f"{DAY3}T01:00:00", "pm25", 1.5), (f"{DAY3}T05:00:00", "pm25", 5.0)]
    assert tree.replay(value=_comma()) == 0 and tree.stored() == once
    (done,) = replay.read_resolved(spark, tree.paths["resolved"]).collect()
    assert done.reason == "value" and "1,5" in done.raw and done.source_file.endswith("pm25.json")
    assert sorted(r.reason for r in tree.open().collect()) == ["utc", "value"]
    # What no number can be made of may be a reading without a value; a time is put right by hand.
    blank = F.when(F.col("value") != "n/a", F.col("value"))
    when = F.when(F.col("utc") == "3 Feb", f"{DAY3}T06:00:00+00:00").otherwise(F.col("utc"))
    assert tree.replay(value=blank, utc=when) == 2 and tree.open().count() == 0
    assert [r[3] for r in tree.stored()] == [1.5, None, 5.0, 4.0]
    with pytest.raises(ValueError, match="unit"):
        tree.replay(unit=F.lit("x"))


def test_replay_cut_off_before_its_ledger_and_values_fetched_since(tree, spark, monkeypatch):
    _spoilt(tree)
    tree.land("04", "pm25", record(utc=f"{DAY3}T01:00:00+00:00", value=9.0))
    tree()
    monkeypatch.setattr(replay, "append_new", lambda rows, path: (wh.append_new(rows, path), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        tree.replay(value=_comma())
    monkeypatch.undo()
    assert tree.open().count() == 3
    assert tree.replay(value=_comma()) == 1
    assert [r[3] for r in tree.stored()] == [9.0, 5.0]


def test_one_row_set_aside_by_two_loads_is_one_open_row(tree, spark):
    _spoilt(tree)
    again = spark.read.orc(f"{tree.paths['quarantine']}").select("reason", "raw", "source_file")
    again.write.orc(f"{tree.paths['quarantine']}/loaded_from=2024-02-09/load=again")
    assert tree.open().count() == 3


def _written(path):
    return {
        f"{folder}/{name}": os.stat(f"{path}/{folder}/{name}").st_mtime_ns
        for folder in os.listdir(path) if folder.startswith("utc_date") for name in os.listdir(f"{path}/{folder}")
    }


def test_a_run_publishes_the_days_it_touched(tree):
    tree.land("03", "a", record(utc=f"{DAY3}T01:00:00+00:00", value=1.0))
    tree.land("04", "a", record(utc=f"{DAY4}T01:00:00+00:00", value=2.0))
    assert tree(by_day=True) == 1 and tree.published() == tree.stored()
    first = _written(tree.paths["latest"])
    assert tree(by_day=True) == 0 and _written(tree.paths["latest"]) == first
    tree.land("04", "b", record(utc=f"{DAY4}T01:00:00+00:00", value=3.0), record(utc=f"{DAY4}T02:00:00+00:00", value=4.0))
    assert tree(by_day=True) == 1
    now = _written(tree.paths["latest"])
    assert {k: v for k, v in now.items() if DAY3 in k} == {k: v for k, v in first.items() if DAY3 in k}
    assert tree.published() == tree.stored() and [r[3] for r in tree.published()] == [1.0, 3.0, 4.0]
    with pytest.raises(ValueError, match="ledger"):
        cycle.run_daily(None, "", "", "", [], as_of=date(2024, 2, 10), bootstrap_start=date(2024, 2, 1), by_day=True)


def test_a_run_cut_off_while_publishing_publishes_again(tree, monkeypatch):
    tree.land("03", "a", record(utc=f"{DAY3}T01:00:00+00:00", value=1.0))
    tree(by_day=True)
    tree.land("04", "a", record(utc=f"{DAY4}T01:00:00+00:00", value=2.0))
    real = cycle.publish_touched
    monkeypatch.setattr(cycle, "publish_touched", lambda *parts: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tree(by_day=True)
    monkeypatch.setattr(cycle, "publish_touched", real)
    assert len(tree.published()) == 1 and len(tree.stored()) == 2
    assert tree(by_day=True) == 1 and tree.published() == tree.stored()


def test_an_existing_warehouse_is_published_whole_at_first(tree, spark):
    wh.write_days(rows(spark, (1, f"{DAY3}T00:00:00", "pm1", 1.0), (1, "2020-02-03T00:00:00", "pm1", 1.0)), tree.paths["warehouse"])
    os.makedirs(tree.paths["data"])
    assert tree(by_day=True) == 0
    assert [r[1] for r in tree.published()] == [f"{DAY3}T00:00:00"]


def test_late_files_correct_windows(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("warehouse", "windows", "staging", "stream")]

    def drain():
        stream = ingest.record_stream(spark, str(tmp_path / "data"), max_files_per_trigger=1)
        ingest.corrected_windows(stream, *paths).awaitTermination()
        return {
            (r.locationId, r.window_start): (r.readings, r.total)
            for r in rollups.read_state(spark, paths[1]).withColumn("window_start", F.date_format("window_start", "dd HH")).collect()
        }

    write_file(tmp_path / "data/1.json", [record(1, value=1.0, utc=f"{DAY4}T00:10:00+00:00"), record(1, value=2.0, utc=f"{DAY4}T02:59:59+00:00")])
    assert drain() == {(1, "04 00"): (2, 3.0)}
    # Two days late, and a correction.
    write_file(tmp_path / "data/2.json", [record(1, value=5.0, utc="2024-02-02T04:00:00+00:00"), record(1, value=7.0, utc=f"{DAY4}T00:10:00+00:00")])
    write_file(tmp_path / "data/3.json", [record(1, value="bad", utc=f"{DAY4}T00:10:00+00:00"), record(2, value=1.0, utc=f"{DAY4}T03:00:00+00:00")])
    assert drain() == {(1, "04 00"): (2, 9.0), (1, "02 03"): (1, 5.0), (2, "04 03"): (1, 1.0)}
    held, whole = rollups.read_state(spark, paths[1]), rollups.state_of(wh.read_warehouse(spark, paths[0]))
    assert held.exceptAll(whole).count() == whole.exceptAll(held).count() == 0
