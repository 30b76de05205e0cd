from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazeline.operators.keysets import LEAST_BITS, MOST_BITS, key_bitmap, perhaps_in, place_bits
from hazeline.plans import warehouse as wh
from hazeline.schemas import KEY, WAREHOUSE
from shapes import plain, plan_of, rows

FEB3, FEB4, FEB5 = "2024-02-03T06:30:00", "2024-02-04T06:30:00", "2024-02-05T06:30:00"


def test_the_bitmap_is_bounded():
    assert place_bits(0) == place_bits(1) == LEAST_BITS
    assert place_bits(10**12) == MOST_BITS
    assert 16 * 100_000 <= 1 << place_bits(100_000)


@pytest.mark.parametrize("bits", [15, 17, 20])
def test_every_member_passes_and_few_others(spark, bits):
    numbers = spark.range(20_000).withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string")))
    members = numbers.filter("id % 20 = 0")
    passed = perhaps_in(numbers, key_bitmap(members, ["id", "name"], bits), ["id", "name"], bits)
    assert passed.columns == numbers.columns
    found = {row[0] for row in passed.collect()}
    assert found >= set(range(0, 20_000, 20))
    # A foreign key passes where one of 1,000 members took its place.
    assert len(found) - 1_000 < 3 * 19_000 * 1_000 / (1 << bits) + 20


def test_null_keys_and_repeated_rows(spark):
    table = spark.createDataFrame([(None, "a"), (1, None), (1, None), (2, "b")], "id long, name string")
    bits = place_bits(3)
    passed = perhaps_in(table, key_bitmap(table.filter("name is null or id is null"), ["id", "name"], bits), ["id", "name"], bits)
    assert sorted(passed.collect(), key=str) == sorted([(None, "a"), (1, None), (1, None)], key=str)
    none = key_bitmap(table.limit(0), ["id", "name"], bits)
    assert perhaps_in(table, none, ["id", "name"], bits).count() == 0


def test_append_reads_and_shuffles_what_may_match(spark, tmp_path):
    path = str(tmp_path / "warehouse")
    stored = spark.range(20_000).select(
        F.col("id").alias("locationId"),
        F.timestamp_micros(F.lit(1_706_942_000_000_000) + F.col("id") * 1_000_000).alias("utc"),
        F.lit("pm1").alias("parameter"),
        F.lit(1.0).alias("value"),
    )
    wh.append_new(wh.with_day(stored).select(*WAREHOUSE.names), path)
    batch = wh.with_day(stored.filter("locationId between 700 and 720 or locationId = 15000"))
    near = wh.stored_alike(wh.read_warehouse(spark, path), batch.select(*WAREHOUSE.names))
    plan = plan_of(near)
    assert "locationId,700" in plan and "locationId,15000" in plan
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert near.join(batch, KEY, "left_semi").count() == 22
    assert near.count() < 100


def test_append_of_an_old_and_a_new_day(spark, tmp_path):
    path = str(tmp_path / "warehouse")
    wh.append_new(rows(spark, (1, FEB3, "pm1", 1.0), (9, FEB5, "pm1", None)), path)
    wh.append_new(rows(spark, (1, FEB3, "pm1", 7.0), (1, FEB4, "pm1", 2.0), (9, FEB5, "pm1", 3.0)), path)
    assert plain(wh.read_warehouse(spark, path)) == [
        (1, FEB3, "pm1", 1.0),
        (1, FEB4, "pm1", 2.0),
        (9, FEB5, "pm1", None),
    ]


BATCHES = st.lists(
    st.lists(
        st.tuples(st.integers(1, 4), st.sampled_from([FEB3, FEB4, FEB5]), st.sampled_from(["pm1", "pm25"]), st.floats(0, 9)),
        min_size=1,
        max_size=6,
    ),
    min_size=1,
    max_size=3,
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(BATCHES)
def test_append_equals_the_rule(spark, tmp_path_factory, batches):
    path = str(tmp_path_factory.mktemp("append"))
    first: dict = {}
    for batch in batches:
        wh.append_new(rows(spark, *batch), path)
        best: dict = {}
        for *key, value in batch:
            best[tuple(key)] = max(value, best.get(tuple(key), value))
        first = {**best, **first}
    assert plain(wh.read_warehouse(spark, path)) == sorted((*key, value) for key, value in first.items())
