"""The warehouse: an ORC folder partitioned by the UTC day of each row."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.paths import level_key
from hazeline.functions.timestamps import parse_instant, utc_day
from hazeline.operators.aggregates import latest_per_key, scalar
from hazeline.operators.filters import in_range
from hazeline.operators.keysets import key_bitmap, perhaps_in, place_bits
from hazeline.schemas import ARRIVED, DAY, KEY, MEASUREMENT, WAREHOUSE
from hazeline.scratch import discard, exists, mark
from hazeline.session import settings
from hazeline.sources.files import read_orc
from hazeline.sources.landing import file_inventory

# New content of days, waiting below the warehouse to take their place. Spark passes over
# folders that begin with an underscore, so readers never see it.
SWAP = "_swap/staged"
# Stands there once all of it is staged. A file of our own: not every cluster has Spark write one.
READY = "_swap/ready"
# Stands there where each staged file is to stay a file of its own.
KEEP = "_swap/keep"
COLUMNS = MEASUREMENT.names


def read_warehouse(
    spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """The stored rows, or those of a half-open range of instants; only its days are read."""
    stored = read_orc(spark, path, WAREHOUSE)
    return stored if start is None else in_range(stored, "utc", start, end)


def with_day(measurements: DataFrame) -> DataFrame:
    return measurements.select(*COLUMNS, utc_day(measurements, "utc").alias(DAY))


def write_days(rows: DataFrame, path: str, *, replace_all: bool = False) -> None:
    """Write rows into their day folders, adding to what is there or replacing all of it.

    The rebalance gathers a day's rows into few files and splits a day that is too large for
    one task. Sorting by sensor inside a file lets ORC skip by location and compress better.
    """
    (
        rows.select(*WAREHOUSE.names)
        .hint("rebalance", F.col(DAY))
        .sortWithinPartitions(DAY, *KEY)
        .write.mode("overwrite" if replace_all else "append")
        .option("partitionOverwriteMode", "static")
        .partitionBy(DAY)
        .orc(path)
    )


def touched(stored: DataFrame, batch: DataFrame) -> DataFrame | None:
    """The stored rows of the days that a batch has rows in; None for an empty batch.

    The range from first to last day prunes folders when the plan is made; the semi-join then
    leaves exactly the batch's days, however many they are.
    """
    first, last = batch.agg(F.min(DAY), F.max(DAY)).first()
    if first is None:
        return None
    days = batch.select(DAY).distinct()
    return stored.filter(F.col(DAY).between(first, last)).join(days, DAY, "left_semi")


def stored_alike(stored: DataFrame, batch: DataFrame) -> DataFrame | None:
    """The stored rows that may share a key with the batch; None for an empty batch.

    Every stored row that does share one is there. The batch's ranges of day, instant and sensor
    go to the scan, which passes over folders and, as files are sorted by sensor, most of a file.
    A bitmap of the batch's keys then drops nearly all other rows where they are read, so what is
    shuffled grows with the batch and not with the days it touches.
    """
    instant = F.unix_micros("utc")
    first, last, earliest, latest, least, most, count = batch.agg(
        F.min(DAY),
        F.max(DAY),
        F.min(instant),
        F.max(instant),
        F.min("locationId"),
        F.max("locationId"),
        F.count(F.lit(1)),
    ).first()
    if count == 0:
        return None
    near = stored
    if first is not None:
        near = near.filter(F.col(DAY).between(first, last) | F.col(DAY).isNull())
    if earliest is not None:
        from_time, to_time = (F.timestamp_micros(F.lit(micros)) for micros in (earliest, latest))
        near = near.filter(F.col("utc").between(from_time, to_time) | F.col("utc").isNull())
    if least is not None:
        near = near.filter(F.col("locationId").between(least, most) | F.col("locationId").isNull())
    bits = place_bits(count)
    return perhaps_in(near, key_bitmap(batch, KEY, bits), KEY, bits)


def matched(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored and batch rows brought together by key: one row per key with both values.

    Written as an aggregate over the union, not as a join: each side combines its copies of
    a key before the shuffle, so a key that fills a third of a batch reaches its task as one
    row per map task, and plain maxima fit a hash table that spills. (An anti-join would be
    moved below the batch's de-duplication by the optimizer, ahead of the combining.) Of
    several batch values for one key the greatest is taken, so a repeated run gives the same.
    """
    keys = [*KEY, DAY]
    value, nothing = F.col("value"), F.lit(None).cast("double")
    sides = stored.select(
        *keys,
        F.lit(True).alias("in_store"),
        F.lit(False).alias("in_batch"),
        value.alias("stored_value"),
        nothing.alias("batch_value"),
    ).unionByName(
        batch.select(
            *keys,
            F.lit(False).alias("in_store"),
            F.lit(True).alias("in_batch"),
            nothing.alias("stored_value"),
            value.alias("batch_value"),
        )
    )
    flags = ["in_store", "in_batch", "stored_value", "batch_value"]
    return sides.groupBy(*keys).agg(*[F.max(name).alias(name) for name in flags])


def new_rows(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of the batch whose key is not stored yet, one per key."""
    fresh = matched(stored, batch).filter(~F.col("in_store"))
    return fresh.withColumnRenamed("batch_value", "value").select(*WAREHOUSE.names)


def merged(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored and batch rows, one per key; the batch's value replaces the stored one."""
    value = F.when(F.col("in_batch"), F.col("batch_value")).otherwise(F.col("stored_value"))
    return matched(stored, batch).withColumn("value", value).select(*WAREHOUSE.names)


def one_per_key(batch: DataFrame, *, last: bool) -> DataFrame:
    """The batch with one row per key: the last, or the first, in landing order.

    Rows that landed together give the greatest value; so does a batch without `arrived`,
    whose copies are settled later. Copies of a key are combined before the shuffle.
    """
    if ARRIVED not in batch.columns:
        return batch
    order = F.col(ARRIVED) if last else -F.col(ARRIVED)
    best = F.max(F.struct(order.alias("place"), F.col("value")))["value"]
    return batch.groupBy(*KEY, DAY).agg(best.alias("value")).select(*WAREHOUSE.names)


def append_new(batch: DataFrame, path: str) -> None:
    """Idempotent append: the first value of a key wins, loading a batch again adds nothing.

    First and last are by landing order where the batch has the `arrived` column. `batch` is
    evaluated more than once, so pass a staged table.
    """
    spark = batch.sparkSession
    finish_swap(spark, path)
    stored = stored_alike(read_warehouse(spark, path), batch)
    if stored is not None:
        write_days(new_rows(stored, one_per_key(batch, last=False)), path)


def upsert(batch: DataFrame, path: str) -> None:
    """Load a batch so that the last value of a key wins, by landing order where it has one.

    Days that are not stored yet are written once. Stored days that the batch touches get
    their new content staged first and then swapped in (see `finish_swap`). Other days are
    neither read nor written. `batch` is evaluated more than once, so pass a staged table.
    """
    spark = batch.sparkSession
    finish_swap(spark, path)
    stored = touched(read_warehouse(spark, path), batch)
    if stored is None:
        return
    batch = one_per_key(batch, last=True).select(*WAREHOUSE.names)
    known = stored.select(DAY).distinct()
    replaces = not known.isEmpty()
    if replaces:
        old = batch.join(known, DAY, "left_semi").select(*WAREHOUSE.names)
        stage_swap(merged(stored, old), path)
        batch = batch.join(known, DAY, "left_anti").select(*WAREHOUSE.names)
    write_days(latest_per_key(batch, [*KEY, DAY], ["value"]), path)
    if replaces:
        finish_swap(spark, path)


def stage_swap(rows: DataFrame, path: str) -> None:
    """Write the new content of whole days to wait for its swap."""
    write_days(rows, f"{path}/{SWAP}", replace_all=True)
    swap_ready(rows.sparkSession, path)


def swap_ready(spark: SparkSession, path: str, *, keep_files: bool = False) -> None:
    """All new content is staged: from now on the swap will be finished, whoever does it."""
    if keep_files:
        mark(spark, f"{path}/{KEEP}")
    else:
        discard(spark, f"{path}/{KEEP}")
    mark(spark, f"{path}/{READY}")


def finish_swap(spark: SparkSession, path: str) -> None:
    """Put completely staged days in the place of the stored ones; nothing to do without any.

    Every load and compaction begins with it. Replacing a day deletes its files before the new
    ones are renamed to their place, so a run that dies there leaves days partly gone; what was
    staged lies below the warehouse until the swap is done, and the next load repeats it.
    One writer at a time.
    """
    staged = f"{path}/{SWAP}"
    if exists(spark, f"{path}/{READY}"):
        # The staged files are already laid out by day; they are copied as they are. Small ones
        # share a task, unless an opening is made to cost as much as a task's bytes.
        per_task = spark.conf.get("spark.sql.files.maxPartitionBytes")
        alone = {"spark.sql.files.openCostInBytes": per_task} if exists(spark, f"{path}/{KEEP}") else {}
        with settings(spark, **alone):
            (
                spark.read.schema(WAREHOUSE)
                .orc(staged)
                .sortWithinPartitions(DAY, *KEY)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(DAY)
                .orc(path)
            )
        # First the sign that it is complete, then the rest.
        discard(spark, f"{path}/{READY}")
    discard(spark, staged)


def high_water_date(spark: SparkSession, path: str, as_of: date) -> date | None:
    """Day of the newest stored row; None for an empty warehouse.

    The day is the partition value, so no data column is read. The newest folders are tried
    first; a longer look back follows only where those hold nothing.
    """
    stored = read_warehouse(spark, path)
    for days in (31, 366):
        recent = stored.filter(F.col(DAY) >= F.lit(as_of - timedelta(days=days)))
        newest = scalar(recent.agg(F.max(DAY)))
        if newest is not None:
            return newest
    return scalar(stored.agg(F.max(DAY)))


def resume_date(spark: SparkSession, path: str, as_of: date) -> date | None:
    """The day a run goes on from: the newest stored one that is not after `as_of`.

    A row dated in the future is kept, and does not hold up what is still to be loaded.
    """
    past = read_warehouse(spark, path).filter(F.col(DAY) <= F.lit(as_of))
    for days in (31, 366):
        newest = scalar(past.filter(F.col(DAY) >= F.lit(as_of - timedelta(days=days))).agg(F.max(DAY)))
        if newest is not None:
            return newest
    return scalar(past.agg(F.max(DAY)))


def newest_instant(spark: SparkSession, path: str, as_of: date) -> DataFrame:
    """max(utc), read from the newest day alone."""
    stored = read_warehouse(spark, path)
    newest = high_water_date(spark, path, as_of)
    return stored.filter(F.col(DAY) == F.lit(newest)).agg(F.max("utc").alias("max_utc"))


def day_files(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per stored day, from the file listing alone."""
    files = file_inventory(spark, path, "*.orc")
    return (
        files.select(level_key(F.col("path"), DAY).cast("date").alias(DAY), "length")
        .groupBy(DAY)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def fragmented_days(
    spark: SparkSession, path: str, *, min_files: int = 4, target_bytes: int = 128 << 20
) -> list[date]:
    """Days kept in many files that would fit into a quarter as many."""
    few = F.col("files") >= min_files
    small = F.col("bytes") / F.col("files") < target_bytes / 4
    found = day_files(spark, path).filter(few & small).select(DAY).orderBy(DAY)
    return [row[0] for row in found.collect()]


def compact(spark: SparkSession, path: str, days: list[date]) -> None:
    """Rewrite days into few files, rows unchanged; a month at a time."""
    finish_swap(spark, path)
    months: dict[tuple[int, int], list[date]] = {}
    for day in days:
        months.setdefault((day.year, day.month), []).append(day)
    for listed in months.values():
        stored = read_warehouse(spark, path).filter(F.col(DAY).isin(listed))
        stage_swap(stored, path)
        finish_swap(spark, path)


def migrate_text_orc(spark: SparkSession, old_path: str, path: str) -> None:
    """Load an older unpartitioned ORC whose `utc` is ISO text.

    Reading that column as TIMESTAMP would give NULLs without an error, so it is read as the
    text it is, and parsed.
    """
    text_schema = T.StructType(
        [
            T.StructField(field.name, T.StringType() if field.name == "utc" else field.dataType)
            for field in MEASUREMENT
        ]
    )
    old = spark.read.schema(text_schema).orc(old_path)
    rows = with_day(old.withColumn("utc", parse_instant(F.col("utc"))))
    upsert(rows.filter(F.col("utc").isNotNull()), path)
