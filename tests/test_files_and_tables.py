from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.operators.filters import kept_by_age
from hazeline.plans import publish
from hazeline.plans import warehouse as wh
from hazeline.plans.cycle import build_latest, ingest, owed, read_quarantine, run_daily
from hazeline.operators.registry import default_registry
from hazeline.schemas import MEASUREMENT, READING, ddl_columns
from hazeline.sources import files, tables
from hazeline.sources.landing import read_records, write_landing
from shapes import plain, record, rows, write_file

MICROS = "2024-02-03T06:30:00.123456"


def readings(spark, *values):
    text = spark.createDataFrame(
        list(values), "city string, local_time string, parameter string, unit string, value double"
    )
    return text.withColumn("local_time", F.col("local_time").cast("timestamp"))


def same(left, right):
    order = sorted(left.columns)
    assert sorted(map(str, left.select(order).collect())) == sorted(
        map(str, right.select(order).collect())
    )


@pytest.mark.parametrize("header", [True, False])
def test_csv_keeps_microseconds_units_and_quotes(spark, tmp_path, header):
    path = str(tmp_path / "csv")
    df = readings(
        spark,
        ("New Delhi", MICROS, "pm25", "µg/m³", 1.5),
        ('Pride "Orchid", Whitefield', MICROS, "um003", "particles/cm³", None),
        (None, "2024-02-03T06:30:00", "humidity", "%", 2.0),
    )
    files.write_csv(df, path, header=header)
    same(files.read_csv(spark, path, READING, header=header), df)


def test_csv_with_header_as_text(spark, tmp_path):
    path = str(tmp_path / "csv")
    files.write_csv(rows(spark, (1, "2024-02-03T06:30:00", "pm1", 1.0)).drop("utc_date"), path)
    text = files.read_csv_text(spark, path)
    assert text.dtypes == [(name, "string") for name in MEASUREMENT.names]
    assert text.first()["utc"] == "2024-02-03T06:30:00.000000Z"


def test_headerless_append_adds_rows(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = readings(spark, ("Mumbai", MICROS, "pm25", "µg/m³", 1.5))
    files.write_csv(df, path, header=False, mode="append")
    files.write_csv(df, path, header=False, mode="append")
    assert files.read_csv(spark, path, READING).count() == 2


def test_orc_keeps_everything(spark, tmp_path):
    path = str(tmp_path / "orc")
    df = readings(spark, ("Mumbai", MICROS, "pm25", "µg/m³", None))
    files.write_orc(df, path)
    files.write_orc(df, path)
    same(files.read_orc(spark, path, READING), df.unionByName(df))
    assert files.read_orc(spark, str(tmp_path / "none"), READING).count() == 0


def test_csv_is_rewritten_from_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "csv")
    files.write_csv(
        rows(spark, (1, "2024-02-03T00:00:00", "pm1", 1.0), (2, "2020-01-01T00:00:00", "pm1", 2.0)).drop(
            "utc_date"
        ),
        path,
        header=False,
    )
    files.rewrite_csv(
        spark, path, MEASUREMENT, lambda stored: kept_by_age(stored, "utc", date(2024, 2, 10))
    )
    assert plain(files.read_csv(spark, path, MEASUREMENT)) == [(1, "2024-02-03T00:00:00", "pm1", 1.0)]


def test_delimited_arrays(spark, tmp_path):
    path = str(tmp_path / "delimited")
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("items", T.ArrayType(T.StringType()))]
    )
    df = spark.createDataFrame([(1, ["a", "b, c"]), (2, ["d"]), (3, None)], schema)
    files.write_delimited(df, path)
    same(files.read_delimited(spark, path, schema), df)


def test_external_table_skips_its_header(spark, tmp_path):
    path = str(tmp_path / "latest")
    df = rows(spark, (1, "2024-02-03T06:30:00", "pm1", 1.0)).drop("utc_date")
    files.write_csv(df, path)
    table = tables.external_csv_table(spark, "test_latest", df.schema, path)
    assert plain(table) == plain(df)
    again = tables.external_csv_table(spark, "test_latest", df.schema, path)
    assert plain(again) == plain(df)
    spark.sql("DROP TABLE test_latest")
    assert files.read_csv(spark, path, MEASUREMENT, header=True).count() == 1


def test_json_table_ignores_malformed_lines(spark, tmp_path):
    good = '{"data": [{"location": "Mumbai", "value": 1.5}, {"location": "Chennai", "value": 2.5}]}'
    write_file(tmp_path / "json/a.json", good + '\n{"data": [{"location": "Kol\n')
    schema = T.StructType.fromDDL("data array<struct<location: string, value: double>>")
    tables.external_json_table(spark, "test_json", schema, str(tmp_path / "json"))
    found = spark.sql("SELECT m.location, m.value FROM test_json LATERAL VIEW explode(data) AS m")
    assert sorted(map(tuple, found.collect())) == [("Chennai", 2.5), ("Mumbai", 1.5)]
    spark.sql("DROP TABLE test_json")


def test_delimited_view(spark, tmp_path):
    write_file(tmp_path / "text/a.csv", "1,pm1;pm25\n2,pm10\n")
    schema = T.StructType.fromDDL("id bigint, parameters array<string>")
    view = tables.delimited_view(
        spark, "test_delimited", schema, str(tmp_path / "text"), item_separator=";"
    )
    assert sorted(map(tuple, view.collect())) == [(1, ["pm1", "pm25"]), (2, ["pm10"])]


def test_insert_converts_text_times(spark, tmp_path):
    schema = T.StructType(
        [
            T.StructField("city", T.StringType()),
            T.StructField("local_date", T.TimestampType()),
            T.StructField("parameter", T.StringType()),
            T.StructField("unit", T.StringType()),
            T.StructField("reading", T.DoubleType()),
        ]
    )
    spark.createDataFrame(
        [
            ("Mumbai", "2024-02-03T12:00:00+05:30", "pm25", "µg/m³", 1.0),
            ("Mumbai", "soon", "pm25", "µg/m³", 2.0),
        ],
        "city string, local_date string, parameter string, unit string, reading double",
    ).createOrReplaceTempView("test_staging")
    tables.orc_table(spark, "test_data", schema, str(tmp_path / "data"))
    tables.insert_readings(spark, "test_data", "test_staging")
    found = spark.table("test_data").select(F.col("local_date").cast("string"), "reading").collect()
    assert sorted(map(tuple, found), key=str) == [("2024-02-03 06:30:00", 1.0), (None, 2.0)]
    for _ in range(2):
        assert tables.max_year_view(spark, "test_max_year", "test_staging").first()[0] == 2024
    spark.sql("DROP TABLE test_data")


def test_saved_and_selected_tables(spark, tmp_path):
    df = rows(spark, (1, "2024-02-03T06:30:00", "pm1", 1.0))
    saved = tables.save_table(df, "test_saved", str(tmp_path / "saved"))
    assert plain(saved) == plain(df)
    selected = tables.create_table_as(
        spark, "test_selected", "SELECT * FROM test_saved WHERE value > 0", str(tmp_path / "selected")
    )
    assert plain(selected) == plain(df)
    fails = df.withColumn("value", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        tables.save_table(fails, "test_saved", str(tmp_path / "saved"))
    assert plain(spark.table("test_saved")) == plain(df)
    spark.sql("DROP TABLE test_saved")
    spark.sql("DROP TABLE test_selected")


def test_table_columns_come_from_the_schema():
    assert ddl_columns(MEASUREMENT) == (
        "`locationId` bigint, `utc` timestamp, `parameter` string, `value` double"
    )


@pytest.mark.parametrize("staged", [False, True])
def test_every_copy_has_the_same_rows(spark, tmp_path, staged):
    df = rows(spark, (1, "2024-02-03T06:30:00", "pm1", 1.0), (2, "2024-02-03T06:30:00", "pm1", 2.0))
    targets = [str(tmp_path / "one"), str(tmp_path / "two")]
    for _ in range(2):
        publish.publish_copies(
            df.drop("utc_date"), targets, staged=str(tmp_path / "staged") if staged else None
        )
    for target in targets:
        assert plain(files.read_csv(spark, target, MEASUREMENT, header=True)) == plain(df)


def test_published_days_are_replaced_and_old_years_removed(spark, tmp_path):
    path = str(tmp_path / "latest")
    assert publish.read_published_days(spark, path).count() == 0
    publish.publish_days(
        rows(
            spark,
            (1, "2021-12-31T23:00:00", "pm1", 0.0),
            (1, "2022-12-31T23:00:00", "pm1", 0.5),
            (1, "2023-02-03T06:30:00", "pm1", 1.0),
            (1, "2023-02-04T06:30:00", "pm1", 2.0),
        ),
        path,
        date(2023, 2, 10),
    )
    assert sorted(folder.name for folder in (tmp_path / "latest").glob("utc*")) == [
        "utc_date=2022-12-31", "utc_date=2023-02-03", "utc_date=2023-02-04"
    ]
    publish.publish_days(rows(spark, (1, "2023-02-04T07:00:00", "pm1", 3.0)), path, date(2024, 2, 10))
    # Read as plain files, without the range.
    assert plain(publish.read_published_days(spark, path)) == [
        (1, "2023-02-03T06:30:00", "pm1", 1.0),
        (1, "2023-02-04T07:00:00", "pm1", 3.0),
    ]


def test_daily_runs(spark, tmp_path):
    names = ("data", "warehouse", "quarantine", "latest")
    landing, warehouse, quarantine, latest = (str(tmp_path / name) for name in names)
    root = tmp_path / "data/2024/02"
    write_file(root / "03/8039/pm25.json", [record(value=1.0), record(value=1.0)])
    bootstrap = date(2024, 2, 1)

    def run(as_of, **options):
        return run_daily(
            spark,
            landing,
            warehouse,
            quarantine,
            [latest],
            as_of=as_of,
            bootstrap_start=bootstrap,
            **options,
        )

    assert run(date(2024, 2, 4), days_per_load=2) == 2
    assert read_quarantine(spark, quarantine).count() == 0
    assert plain(files.read_csv(spark, latest, MEASUREMENT, header=True)) == [
        (8039, "2024-02-03T06:30:00", "pm25", 1.0)
    ]

    # The last day is fetched again and brings a correction, a late row and a damaged file.
    late = record(value=5.0, utc="2024-02-02T06:30:00+00:00")
    write_file(root / "03/8039/pm25.json", [record(value=2.0), late])
    write_file(root / "04/8118/pm25.json", [record(8118, utc="2024-02-04T06:30:00+00:00")])
    write_file(root / "04/8172/pm25.json", "[{")
    assert run(date(2024, 2, 5)) == 1
    (bad,) = read_quarantine(spark, quarantine).collect()
    assert (bad.reason, bad.loaded_from) == ("malformed", date(2024, 2, 3))
    expected = [
        (8039, "2024-02-02T06:30:00", "pm25", 5.0),
        (8039, "2024-02-03T06:30:00", "pm25", 2.0),
        (8118, "2024-02-04T06:30:00", "pm25", 1.5),
    ]
    assert plain(wh.read_warehouse(spark, warehouse)) == expected
    assert plain(files.read_csv(spark, latest, MEASUREMENT, header=True)) == expected

    # The warehouse holds today already: nothing is owed.
    assert run(date(2024, 2, 4)) == 0
    # Days fetched again are loaded again, and nothing is doubled, the quarantine included.
    assert run(date(2024, 2, 5), lookback_days=1) == 1
    assert plain(wh.read_warehouse(spark, warehouse)) == expected
    plan = owed(
        spark,
        default_registry(spark),
        warehouse,
        as_of=date(2024, 2, 6),
        bootstrap_start=bootstrap,
    )
    days = {row.day for row in plan.select("day").distinct().collect()}
    assert days == {date(2024, 2, 4), date(2024, 2, 5)}


def test_ingest_may_keep_first_values(spark, tmp_path):
    landing, warehouse = str(tmp_path / "data"), str(tmp_path / "warehouse")
    for value in (1.0, 2.0):
        write_file(tmp_path / "data/2024/02/03/8039/pm25.json", [record(value=value)])
        ingest(spark, landing, warehouse, keep_first=True)
    assert plain(wh.read_warehouse(spark, warehouse)) == [(8039, "2024-02-03T06:30:00", "pm25", 1.0)]
    build_latest(spark, warehouse, [str(tmp_path / "latest")], as_of=date(2026, 1, 1))
    assert files.read_csv(spark, str(tmp_path / "latest"), MEASUREMENT, header=True).count() == 0


def _lifecycle(spark, root, landing, **options):
    names = ("warehouse", "quarantine", "latest")
    warehouse, quarantine, latest = (str(root / name) for name in names)
    run_daily(
        spark, landing, warehouse, quarantine, [latest],
        as_of=date(2024, 2, 6), bootstrap_start=date(2024, 2, 1), **options,
    )
    return plain(wh.read_warehouse(spark, warehouse)), read_quarantine(spark, quarantine).collect()


def test_one_wrong_field_spoils_one_row(spark, tmp_path):
    good = record(utc="2024-02-03T07:30:00+00:00")
    odd = record(utc="2024-02-03T08:30:00+00:00", isMobile="perhaps", coordinates=7)
    wrong = [record(value="abc"), record(location="x1"), record() | {"date": 5}]
    write_file(tmp_path / "data/2024/02/03/8039/pm25.json", [good, *wrong, odd])
    write_file(tmp_path / "data/2024/02/03/8118/pm25.json", '[{"locationId": 1},\n {"val')
    stored, bad = _lifecycle(spark, tmp_path, str(tmp_path / "data"))
    assert [row[1] for row in stored] == ["2024-02-03T07:30:00", "2024-02-03T08:30:00"]
    assert sorted(row.reason for row in bad) == ["key", "malformed", "utc", "value"]
    (value,) = [row.raw for row in bad if row.reason == "value"]
    assert '"value":"abc"' in value and len(value) < 200


@pytest.mark.parametrize("days", [1, 7])
def test_the_later_landing_wins_whatever_the_load_size(spark, tmp_path, days):
    for day, value in (("03", 9.0), ("04", 1.0), ("05", 4.0)):
        write_file(tmp_path / f"data/2024/02/{day}/8039/pm25.json", [record(value=value)])
    stored, _ = _lifecycle(spark, tmp_path, str(tmp_path / "data"), days_per_load=days)
    assert stored == [(8039, "2024-02-03T06:30:00", "pm25", 4.0)]
    first = str(tmp_path / "first")
    ingest(spark, str(tmp_path / "data"), first, keep_first=True)
    assert plain(wh.read_warehouse(spark, first)) == [(8039, "2024-02-03T06:30:00", "pm25", 9.0)]


def test_a_run_over_its_own_landing_tree_and_lines(spark, tmp_path):
    write_file(tmp_path / "in.json", [record(number, utc=f"2024-02-0{number}T06:30:00+00:00") for number in (1, 2, 3)])
    rows = read_records(spark, str(tmp_path / "in.json")).drop("_corrupt_record", "source_file")
    landed = str(tmp_path / "tree")
    write_landing(rows.withColumn("day", F.to_date(F.substring("date.utc", 1, 10))), landed, "day")
    stored, bad = _lifecycle(spark, tmp_path, landed, array_files=False)
    assert [row[0] for row in stored] == [1, 2, 3] and bad == []


def test_missing_root_raises_and_a_future_row_holds_nothing_up(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        _lifecycle(spark, tmp_path, str(tmp_path / "nowhere"))
    write_file(tmp_path / "data/2024/02/03/1/pm25.json", [record(1), record(1, utc="2030-01-01T00:00:00+00:00")])
    _lifecycle(spark, tmp_path, str(tmp_path / "data"))
    write_file(tmp_path / "data/2024/02/04/2/pm25.json", [record(2)])
    stored, _ = _lifecycle(spark, tmp_path, str(tmp_path / "data"))
    assert [row[0] for row in stored] == [1, 1, 2]
