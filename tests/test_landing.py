from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hazeline.functions.paths import tree_keys
from hazeline.operators.aggregates import parameter_catalogue
from hazeline.schemas import RECORD
from hazeline.scratch import put_file
from hazeline.sources import landing
from shapes import plain, record, write_file


def staged(spark, root, tmp_path, **options):
    path = str(tmp_path / "staged")
    landing.stage(landing.read_records(spark, str(root), **options), path)
    return landing.read_staged(spark, path)


def test_array_files_of_all_conditions(spark, tmp_path):
    root = tmp_path / "data"
    day = root / "2024/02/03"
    write_file(day / "8039/pm25.json", [record(), record(utc="2024-02-03T07:30:00+00:00")])
    write_file(day / "8118/pm25.json", [])
    write_file(day / "8172/pm25.json", "")
    write_file(day / "8557/pm25.json", '[\n  {"locationId": 8557,\n  "param')
    rows = staged(spark, root, tmp_path)
    assert plain(landing.good_rows(rows)) == [
        (8039, "2024-02-03T06:30:00", "pm25", 1.5),
        (8039, "2024-02-03T07:30:00", "pm25", 1.5),
    ]
    (bad,) = landing.bad_rows(rows).collect()
    assert bad.reason == "malformed"
    assert bad.source_file.endswith("8557/pm25.json")
    assert '"param' in bad.raw


def test_missing_path_has_no_rows_and_other_errors_are_raised(spark, tmp_path):
    missing = landing.read_records(spark, str(tmp_path / "nowhere"))
    assert missing.count() == 0
    assert staged(spark, tmp_path / "nowhere", tmp_path).count() == 0
    with pytest.raises(AnalysisException):
        landing.read_records(spark, str(tmp_path), mode="PERMISSIVE").select("no_such_column")


def test_rows_without_time_or_key_are_set_aside(spark, tmp_path):
    root = tmp_path / "data"
    write_file(
        root / "2024/02/03/1/pm1.json",
        [
            record(1, "pm1", utc="yesterday"),
            record(None, "pm1"),
            record(1, None),
            record(1, "pm1", value=None),
        ],
    )
    rows = staged(spark, root, tmp_path)
    assert plain(landing.good_rows(rows)) == [(1, "2024-02-03T06:30:00", "pm1", None)]
    bad = landing.bad_rows(rows).collect()
    assert sorted(row.reason for row in bad) == ["key", "key", "utc"]
    assert any("yesterday" in row.raw for row in bad)


def test_day_is_the_rows_own_utc_day(spark, tmp_path):
    root = tmp_path / "data"
    write_file(
        root / "2024/02/03/8039/pm25.json",
        [record(utc="2024-02-04T04:30:00+00:00"), record(utc="2024-01-01T01:00:00+05:30")],
    )
    days = landing.good_rows(staged(spark, root, tmp_path)).select("utc_date").collect()
    assert sorted(row[0] for row in days) == [date(2023, 12, 31), date(2024, 2, 4)]


def test_day_does_not_depend_on_the_session_zone(spark, tmp_path):
    root = tmp_path / "data"
    write_file(root / "2024/02/03/8039/pm25.json", [record(utc="2024-02-03T22:00:00+00:00")])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        day = landing.good_rows(staged(spark, root, tmp_path)).first()["utc_date"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert day == date(2024, 2, 3)


def test_drop_malformed(spark, tmp_path):
    root = tmp_path / "lines"
    write_file(root / "a.json", '{"locationId": 1, "parameter": "pm1"}\n{"locationId": 2, "para\n')
    read = landing.read_records(spark, str(root), array_files=False, mode="DROPMALFORMED")
    assert [tuple(row) for row in read.select("locationId", "parameter").collect()] == [(1, "pm1")]


def test_keys_of_the_three_tree_shapes(spark):
    paths = [
        ("file:/data/2024/02/03/8039/pm25.json",),
        ("file:/data/2024/02/03/8039/pm25/T0000_T0300.json",),
        ("file:/data/yr=2024/mnt=02/dy=03/loc=8039/par=pm25/part-00000-1f.c000.json",),
        ("file:/data/india/2024/01/1/Mumbai.json",),
    ]
    df = spark.createDataFrame(paths, "path string")
    keys = df.select(*[column.alias(name) for name, column in tree_keys(F.col("path")).items()])
    found = [tuple(row) for row in keys.collect()]
    assert found[:3] == [("2024", "02", "03", "8039", "pm25")] * 3
    assert found[3] == (None,) * 5


def test_landed_cells_are_read_off_the_names(spark, tmp_path):
    day = tmp_path / "data/2024/02/03"
    write_file(day / "62543/pm1.json", "not even JSON")
    write_file(day / "62543/pm25/T0000_T0300.json", [])
    write_file(day / "62543/pm25/T0300_T0600.json", [])
    write_file(day / "8039/pm25.json", [])
    cells = landing.landed_cells(spark, landing.tree_folders(str(tmp_path / "data")))
    assert sorted(tuple(row) for row in cells.collect()) == [
        (date(2024, 2, 3), 8039, "pm25"),
        (date(2024, 2, 3), 62543, "pm1"),
        (date(2024, 2, 3), 62543, "pm25"),
    ]
    catalogue = parameter_catalogue(cells).collect()
    assert sorted(tuple(row) for row in catalogue) == [(8039, "pm25"), (62543, "pm1,pm25")]


def test_day_folders_skip_missing_days(spark, tmp_path):
    root = tmp_path / "data"
    write_file(root / "2024/02/03/1/pm1.json", [record(1, "pm1")])
    write_file(root / "2024/02/05/1/pm1.json", [record(2, "pm1")])
    write_file(root / "2024/02/06/1/pm1.json", [record(3, "pm1")])
    write_file(root / "2024/02/06/1/pm25/T0000_T0300.json", [record(4, "pm25")])

    def sensors(start, end):
        path = landing.day_folders(str(root), start, end)
        read = landing.read_records(spark, path).select("locationId").collect()
        return sorted(row[0] for row in read)

    assert sensors(date(2024, 2, 3), date(2024, 2, 6)) == [1, 2]
    assert sensors(date(2024, 2, 5), date(2024, 2, 6)) == [2]
    assert sensors(date(2024, 2, 6), date(2024, 2, 8)) == [3, 4]
    assert sensors(date(2025, 1, 1), date(2025, 1, 3)) == []
    whole = landing.read_records(spark, landing.tree_folders(str(root)))
    assert sorted(row[0] for row in whole.select("locationId").collect()) == [1, 2, 3, 4]


def test_written_tree_reads_back_whole(spark, tmp_path):
    path = str(tmp_path / "tree")
    records = spark.createDataFrame(
        [record(1, "pm1"), record(1, "pm25"), record(2, "pm1", value=None)], RECORD
    ).withColumn("day", F.lit(date(2024, 2, 3)))
    landing.write_landing(records, path, "day")
    read = landing.read_records(spark, path, array_files=False)
    assert sorted(map(str, read.select(*RECORD.names).collect())) == sorted(
        map(str, records.drop("day").collect())
    )
    cells = landing.landed_cells(spark, path).select("locationId", "parameter").collect()
    assert sorted(tuple(row) for row in cells) == [(1, "pm1"), (1, "pm25"), (2, "pm1")]


def test_nothing_to_land_leaves_no_cell(spark, tmp_path):
    path = str(tmp_path / "tree")
    none = spark.createDataFrame([], RECORD).withColumn("day", F.lit(date(2024, 2, 3)))
    landing.write_landing(none, path, "day")
    assert landing.landed_cells(spark, path).count() == 0


def test_arrays_stay_bounded_whatever_the_key(spark, tmp_path):
    # One sensor holds every row.
    records = spark.range(1000).select(F.lit(1).alias("locationId"), F.col("id").alias("value"))
    arrays = landing.bounded_arrays(records, bits=6)
    sizes = [row[0] for row in arrays.select(F.size("records")).collect()]
    assert sum(sizes) == 1000
    assert max(sizes) <= 64


def test_array_files_are_pretty_and_read_back(spark, tmp_path):
    path = tmp_path / "arrays"
    records = spark.createDataFrame([record(value=float(number)) for number in range(100)], RECORD)
    landing.write_array_files(records, str(path), bits=4)
    text = next(path.glob("part-*")).read_text(encoding="utf-8")
    assert text.startswith("[") and text.count("\n") > 16 and "µg/m³" in text
    read = landing.read_records(spark, str(path), glob="part-*")
    assert sorted(row[0] for row in read.select("value").collect()) == list(map(float, range(100)))


def test_a_file_read_twice_is_one_row_per_source(spark, tmp_path):
    root = tmp_path / "data"
    write_file(root / "2024/02/03/1/pm1.json", [record(1, "pm1"), record(1, "pm1")])
    write_file(root / "2024/02/04/1/pm1.json", [record(1, "pm1")])
    good = landing.good_rows(staged(spark, root, tmp_path))
    assert good.count() == 3
    assert good.dropDuplicates().count() == 1


def test_files_named_by_parameter_are_replaced(spark, tmp_path):
    schema = "locationId long, parameter string, value double, date struct<utc: string>, day date"
    day, utc = date(2024, 2, 3), "2024-02-03T06:30:00+00:00"
    listed = [(8039, "pm25", float(i), (utc,), day) for i in range(500)]  # one file with nearly all
    listed += [(8039, "pm1", None, (utc,), day), (1, "a/b:c", 1.0, (utc,), day), (None, "pm1", 2.0, (utc,), day)]
    listed += [(1, None, 3.0, (utc,), None), (1, "", 4.0, (utc,), day)]
    root = tmp_path / "data"
    frame = spark.createDataFrame(listed, schema).repartition(7)
    assert landing.write_landing_files(frame, str(root), "day") == 6
    names = sorted(str(file.relative_to(root)) for file in root.rglob("*.json"))
    assert names == [
        "2024/02/03/1/a%2Fb%3Ac.json", "2024/02/03/1/none.json", "2024/02/03/8039/pm1.json",
        "2024/02/03/8039/pm25.json", "2024/02/03/none/pm1.json", "none/none/none/1/none.json",
    ]
    found = landing.parsed(landing.landed_records(spark, str(root)))
    assert found.count() == len(listed)
    assert sorted(r.reason for r in found.filter("outcome = 'bad'").collect()) == ["key", "key"]
    again = [(8039, "pm25", 7.0, (utc,), day)]
    assert landing.write_landing_files(spark.createDataFrame(again, schema), str(root), "day") == 1
    rows = landing.landed_records(spark, str(root / "2024/02/03/8039/pm25.json")).collect()
    assert [r.value for r in rows] == ["7.0"]
    assert landing.write_landing_files(spark.createDataFrame([], schema), str(root), "day") == 0
    assert len(list(root.rglob("*.json"))) == 6


def test_long_arrays_are_written_record_by_record(spark, tmp_path):
    rows = [record(value=float(number)) for number in range(20_000)]
    frame = spark.createDataFrame(rows, RECORD).repartition(3)
    path = tmp_path / "arrays"
    landing.write_array_files(frame, str(path), bits=13)
    arrays = [json.loads(file.read_text(encoding="utf-8")) for file in path.glob("part-*")]
    assert sum(map(len, arrays)) == 20_000 and 4096 < max(map(len, arrays)) <= 1 << 13
    assert sorted(r["value"] for array in arrays for r in array) == list(map(float, range(20_000)))
    # A task's row is a record, however long its array.
    lines = landing._long_arrays(frame, 20, {"pretty": "true"}).agg(F.max(F.length("line")), F.count("line")).first()
    assert lines[0] < 2_000 and lines[1] == 20_000
    assert landing.write_array_files(frame.limit(0), str(tmp_path / "none"), bits=20) is None
    assert list((tmp_path / "none").glob("part-*")) == []


def test_folders_by_sensor_are_dealt_to_many_tasks(spark, tmp_path):
    """Not even Spark's least partition, 1 MB, is filled: still more than one task writes."""
    path = str(tmp_path / "tree")
    rows = [(number, "pm1", 1.0, date(2024, 2, 3)) for number in range(400)] * 2
    rows += [(None, "", None, date(2024, 2, 3)), (1, "a/b:c", 2.0, date(2024, 2, 4))]
    frame = spark.createDataFrame(rows, "locationId long, parameter string, value double, day date")
    landing.write_landing(frame, path, "day")
    files = [str(file.relative_to(path)) for file in (tmp_path / "tree").rglob("*.json")]
    assert len(files) == 402
    assert len({name.rsplit("part-", 1)[1][:5] for name in files}) > 1
    folders = {name.rsplit("/", 1)[0] for name in files}
    assert "yr=2024/mnt=02/dy=03/loc=__HIVE_DEFAULT_PARTITION__/par=__HIVE_DEFAULT_PARTITION__" in folders
    assert "yr=2024/mnt=02/dy=04/loc=1/par=a%2Fb%3Ac" in folders
    read = spark.read.json(path, schema="locationId long, parameter string, value double")
    assert sorted(map(str, read.select("locationId", "parameter", "value").collect())) == sorted(map(str, frame.drop("day").collect()))
    landing.write_landing(frame, path, "day")
    assert landing.read_records(spark, path, array_files=False).count() == 2 * len(rows)


def test_a_file_that_hadoop_summed_is_replaced(spark, tmp_path):
    root = str(tmp_path / "data")
    day = date(2024, 2, 3)
    schema = "locationId long, parameter string, value double, date struct<utc: string>, day date"
    old = f"{root}/2024/02/03/1/pm1.json"
    spark.range(3).select(F.to_json(F.struct("id")).alias("value")).coalesce(1).write.text(f"{root}/old")
    part = next((tmp_path / "data/old").glob("part-*"))
    put_file(spark, str(part), old)
    assert (tmp_path / "data/2024/02/03/1/.pm1.json.crc").exists()
    landing.write_landing_files(spark.createDataFrame([(1, "pm1", 5.0, ("x",), day)], schema), root, "day")
    assert [r.value for r in landing.landed_records(spark, old).collect()] == ["5.0"]
    assert not list((tmp_path / "data").glob("_staging*"))


def test_files_are_moved_by_tasks(spark, tmp_path, monkeypatch):
    schema = "locationId long, parameter string, value double, day date"
    rows = spark.createDataFrame([(number, "pm1", 1.0, date(2024, 2, 3)) for number in range(50)], schema)
    monkeypatch.setattr(landing, "put_file", lambda *_: pytest.fail("moved by the driver"))
    assert landing.write_landing_files(rows, str(tmp_path / "data"), "day") == 50


def test_an_unknown_file_system_is_written_by_spark(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "uri_of", lambda *_: None)
    schema = "locationId long, parameter string, value double, day date"
    rows = spark.createDataFrame([(number, "pm1", 1.0, date(2024, 2, 3)) for number in range(5)], schema)
    assert landing.write_landing_files(rows, str(tmp_path / "data"), "day") == 5
    landing.write_landing(rows, str(tmp_path / "tree"), "day")
    landing.write_array_files(rows, str(tmp_path / "short"), bits=1)
    landing.write_array_files(rows, str(tmp_path / "long"), bits=20)
    for name in ("tree", "short", "long"):
        assert landing.landed_records(spark, str(tmp_path / name), glob="part-*").count() == 5, name
