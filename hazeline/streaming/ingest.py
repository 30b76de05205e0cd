"""The landing tree as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazeline.operators.aggregates import reading_summary, tumbling
from hazeline.plans.rollups import refresh
from hazeline.plans.warehouse import append_new, upsert
from hazeline.schemas import CORRUPT, KEY, LANDED
from hazeline.scratch import discard
from hazeline.session import settings
from hazeline.sources.landing import name_source, ordered_rows, parsed, read_staged, stage

# Bytes of landing files in a micro-batch; all files are loaded, in as many batches as it takes.
BATCH_BYTES = 64 << 30

# How many tasks share the copies of one key before they are compared with each other.
SPREAD = 64

# Keys and windows live on the executors' disks, not on their heaps.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}


def record_stream(
    spark: SparkSession,
    landing: str,
    *,
    array_files: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New landing files as a stream of records, oldest file first; fields as text, so that a wrong
    one spoils its own row only."""
    reader = (
        spark.readStream.schema(LANDED)
        .option("multiLine", array_files)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        # By default files a week older than the newest are skipped; none may be.
        .option("maxFileAge", "36500d")
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", BATCH_BYTES)
    return name_source(reader.json(landing), arrival=True)


def measurement_stream(records: DataFrame) -> DataFrame:
    """Canonical measurements; rows without a usable key or time are left to the quarantine."""
    good = parsed(records).filter(F.col("outcome") == "good")
    return good.select("locationId", "utc", "parameter", "value").na.drop(subset=KEY)


def ingest_stream(
    records: DataFrame, warehouse: str, staging: str, checkpoint: str
) -> StreamingQuery:
    """Drain the files that are there into the warehouse, exactly once per key.

    The warehouse itself is the memory of what was loaded: each micro-batch is staged and
    appended by key, so nothing is too late and no state grows. A micro-batch that is
    repeated after a failure stages to the same path and finds its own rows stored. Good rows
    leave the staging folders once they are stored; bad ones stay, a folder per micro-batch.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        path = f"{staging}/batch={batch_id}"
        stage(batch, path)
        append_new(ordered_rows(read_staged(batch.sparkSession, path)), warehouse)
        discard(batch.sparkSession, f"{path}/outcome=good")

    return (
        records.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def corrected_windows(
    records: DataFrame, warehouse: str, windows: str, staging: str, checkpoint: str
) -> StreamingQuery:
    """Drain the files that are there; a later file's value replaces the stored one, and the 3-hour
    windows (see `rollups`) of the days it touches are brought up, however late it is.

    No watermark: windows are state in a table, so none is ever closed, and what a micro-batch
    costs is the days it touches. A micro-batch that is repeated after a failure stages to the
    same path, loads the same values and writes the same windows.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{staging}/batch={batch_id}"
        stage(batch, path)
        rows = ordered_rows(read_staged(spark, path))
        upsert(rows, warehouse)
        refresh(spark, warehouse, windows, rows)
        discard(spark, f"{path}/outcome=good")

    return (
        records.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_per_key(measurements: DataFrame, delay: str) -> DataFrame:
    """One row per key among rows that arrive within `delay` of each other.

    For sinks that cannot look up what they hold. A row later than `delay` behind the newest
    is dropped, so the delay has to cover the overlap of the fetches. Copies are dropped
    twice, first apart by the task that read them: a key that fills much of a batch is
    spread over `SPREAD` tasks, and the second step sees no more than `SPREAD` of its copies.
    """
    spread = F.pmod(F.spark_partition_id(), F.lit(SPREAD))
    marked = measurements.withWatermark("utc", delay).withColumn("spread", spread)
    thinned = marked.dropDuplicatesWithinWatermark([*KEY, "spread"]).drop("spread")
    return thinned.dropDuplicatesWithinWatermark(KEY)


def window_readings(measurements: DataFrame, delay: str, width: str = "3 hours") -> DataFrame:
    """Readings per sensor and window, emitted once the window is closed."""
    return tumbling(
        measurements.withWatermark("utc", delay),
        "utc",
        width,
        ["locationId", "parameter"],
        *reading_summary(),
    )


def drain_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what is available to an ORC folder, and wait for it."""
    with settings(stream.sparkSession, **STATE_STORE):
        query = (
            stream.writeStream.format("orc")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
