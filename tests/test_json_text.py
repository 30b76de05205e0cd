"""Arrays and lines told apart by the file, and large files read by many tasks."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from hazeline.schemas import CORRUPT, LANDED
from hazeline.sources import json_text
from hazeline.sources.landing import landed_records
from shapes import record, write_file

ODD = ['a "quoted" {brace}', "back\\slash}", "{[", "ends with \\", "\"}{", "é µg/m³ }", "tab\t\n{"]


def _records(count: int) -> list[dict]:
    return [
        record(number, ODD[number % len(ODD)], number / 4, f"2024-02-03T06:{number % 60:02d}:00+00:00", unit=ODD[-number % len(ODD)])
        for number in range(count)
    ]


def _read(spark, path, whole_bytes):
    rows = landed_records(spark, str(path), whole_bytes=whole_bytes).collect()
    good = sorted((int(r.locationId), r.parameter, r.unit) for r in rows if r[CORRUPT] is None)
    return good, [r[CORRUPT] for r in rows if r[CORRUPT] is not None]


def _expected(records):
    return sorted((r["locationId"], r["parameter"], r["unit"]) for r in records)


SHAPES = {
    "pretty": lambda records: json.dumps(records, indent=2),
    "one line": lambda records: json.dumps(records),
    "lines": lambda records: "\n".join(map(json.dumps, records)) + "\n",
    "lines of arrays": lambda records: "\n".join(json.dumps(records[i : i + 3]) for i in range(0, len(records), 3)),
    "no escapes": lambda records: json.dumps(records, ensure_ascii=False, indent=1),
    "blank lines": lambda records: "\n \n" + "\n\n".join(map(json.dumps, records)),
    "one object": lambda records: json.dumps(records[0], indent=2),
}


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("whole_bytes", [json_text.WHOLE_BYTES, 0])
def test_every_shape_is_read_whole(spark, tmp_path, small_ranges, whole_bytes):
    records = _records(40)
    for shape, text in SHAPES.items():
        write_file(tmp_path / shape / "a.json", text(records))
    rows = landed_records(spark, str(tmp_path), whole_bytes=whole_bytes)
    assert rows.filter(F.col(CORRUPT).isNotNull()).count() == 0
    found = rows.withColumn("shape", F.element_at(F.split("source_file", "/"), -2)).collect()
    for shape in SHAPES:
        got = sorted((int(r.locationId), r.parameter, r.unit) for r in found if r["shape"] == shape.replace(" ", "%20"))
        assert got == _expected(records[:1] if shape == "one object" else records), shape


def test_one_array_is_many_tasks(spark, tmp_path, small_ranges):
    write_file(tmp_path / "a.json", _records(40))
    texts = json_text._texts(spark, str(tmp_path), "*.json", lineSep="}")
    assert texts.rdd.getNumPartitions() > 5
    assert texts.select("block").distinct().count() > 5


@pytest.mark.parametrize("seed", [1, 2])
def test_large_and_small_files_mixed(spark, tmp_path, small_ranges, seed):
    draw = random.Random(seed)
    records = _records(120)
    draw.shuffle(records)
    at = 0
    for number in range(8):
        take = draw.choice([0, 1, 5, 40])
        part, at = records[at : at + take], at + take
        write_file(tmp_path / f"2024/02/03/{number}/pm25.json", draw.choice([*SHAPES.values()][:4])(part) if part else "[]")
    good, bad = _read(spark, tmp_path, 2500)
    assert (good, bad) == (_expected(records[:at]), [])


@pytest.mark.parametrize("whole_bytes", [json_text.WHOLE_BYTES, 0])
def test_faults_are_set_aside(spark, tmp_path, small_ranges, whole_bytes):
    whole = json.dumps(_records(30), indent=2)
    cuts = {"value": whole.rindex('"value"') + 4, "brace": whole.rindex("}"), "inner": whole.rindex('"utc"')}
    for name, cut in cuts.items():
        write_file(tmp_path / f"{name}/a.json", whole[:cut])
        good, bad = _read(spark, tmp_path / name, whole_bytes)
        # Read by ranges, what stands before the fault is good.
        assert (len(good), len(bad)) == ((29, 1) if whole_bytes == 0 else (0, 1)), name
    write_file(tmp_path / "extra/a.json", whole[:-1] + "}\n" + whole)
    good, bad = _read(spark, tmp_path / "extra", 0)
    assert len(good) == 30 and len(bad) == 1
    for name, text, faults in (("empty", "", 0), ("blank", " \n\n", 0), ("none", "[]", 0), ("number", "42", 1), ("elements", "[1]", 1)):
        write_file(tmp_path / f"{name}/a.json", text)
        good, bad = _read(spark, tmp_path / name, json_text.WHOLE_BYTES)
        assert (good, len(bad)) == ([], faults), name


def test_a_bad_line_spoils_itself_only(spark, tmp_path, small_ranges):
    lines = list(map(json.dumps, _records(12)))
    lines[5] = lines[5][: len(lines[5]) // 2]
    write_file(tmp_path / "a.json", "\n".join(lines))
    good, bad = _read(spark, tmp_path, json_text.WHOLE_BYTES)
    assert len(good) == 11 and len(bad) == 1


def test_fields_stay_text(spark, tmp_path):
    write_file(tmp_path / "a.json", [record(), record() | {"date": 5, "value": {"a": 1}}])
    rows = landed_records(spark, str(tmp_path)).orderBy("date").collect()
    assert set(rows[0].asDict()) == {*LANDED.names, "source_file", "arrived"}
    assert rows[0]["date"] == "5" and json.loads(rows[0]["value"]) == {"a": 1}
    assert json.loads(rows[1]["date"])["utc"] == "2024-02-03T06:30:00+00:00"


def test_large_files_of_lines_are_read_by_lines(spark, tmp_path, small_ranges, monkeypatch):
    """Only other shapes, and lines with a fault, are cut at braces."""
    records = _records(40)
    cut = []
    split = json_text.split_pieces
    monkeypatch.setattr(json_text, "split_pieces", lambda texts: cut.extend(
        row.file.split("/")[-2] for row in texts.select("file").distinct().collect()) or split(texts))
    for shape, text in SHAPES.items():
        write_file(tmp_path / shape.replace(" ", "_") / "a.json", text(records))
    write_file(tmp_path / "no_end/a.json", SHAPES["lines"](records)[:-1])
    write_file(tmp_path / "fault/a.json", SHAPES["lines"](records)[:-9])
    write_file(tmp_path / "two/a.json", SHAPES["lines"](records).replace("}\n{", "} {", 1))
    good, bad = _read(spark, tmp_path, 0)
    assert len(good) == 40 * (len(SHAPES) - 1) + 1 + 40 + 39 + 40 and len(bad) == 1
    assert sorted(cut) == ["fault", "lines_of_arrays", "no_escapes", "one_line", "one_object", "pretty", "two"]


def test_long_lines_are_not_one_row(spark, tmp_path, small_ranges, monkeypatch):
    monkeypatch.setitem(json_text._BY_LINES, "mapreduce.input.linerecordreader.line.maxlength", 2000)
    records = _records(100)
    write_file(tmp_path / "a.json", json.dumps(records))
    write_file(tmp_path / "b.json", json.dumps(records[0] | {"unit": "x" * 5000}) + "\n" + json.dumps(records[1]))
    texts = json_text._texts(spark, str(tmp_path), "*.json", **json_text._BY_LINES)
    assert (texts.agg(F.max(F.length("value"))).first()[0] or 0) <= 2003
    assert json_text.line_files(texts) == []
    good, bad = _read(spark, tmp_path, 0)
    assert len(good) == 102 and not bad


def test_many_inner_objects_do_not_nest_the_matcher(spark):
    line = '{"a": [' + ", ".join(['{"b": {"c": 1}}'] * 50_000) + "]}"
    rows = spark.createDataFrame([(line,), (line + "}",), ("[" + line,), ('{"a": 1} {"a": 2}',)], "value string")
    assert [r[0] for r in rows.select(F.col("value").rlike(json_text._ONE_OBJECT)).collect()] == [True, False, False, False]
