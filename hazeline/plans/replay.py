"""Rows that were set aside, repaired and loaded once.

A resolved row is entered in a ledger of its own with its reason and origin; the quarantine itself
is never rewritten, so a load that is repeated may replace its folder. A row's identity is what it
says and the file it came from, so a file that two loads set aside is repaired once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.timestamps import parse_instant
from hazeline.plans.cycle import read_quarantine
from hazeline.plans.warehouse import append_new, with_day
from hazeline.schemas import MEASUREMENT, WAREHOUSE
from hazeline.scratch import discard, new_dir
from hazeline.sources.files import read_orc

# The fields of a row set aside, as the text they were.
FIELDS = ("locationId", "utc", "parameter", "value")
RESOLVED = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("row_id", "reason", "source_file", "raw")]
)
_RAW = "locationId STRING, utc_text STRING, parameter STRING, value STRING, date STRUCT<utc: STRING>"


def read_resolved(spark: SparkSession, path: str) -> DataFrame:
    return read_orc(spark, path, RESOLVED)


def open_rows(spark: SparkSession, quarantine: str, resolved: str) -> DataFrame:
    """Rows set aside and not resolved yet: row_id, reason, source_file, raw, and the fields as text
    where `raw` is a JSON object; one row for each that says the same and comes from the same file.

    An anti-join on the ids' hashes; Spark broadcasts the ledger while it is small.
    """
    no_text = F.lit("")
    parts = [F.coalesce(F.col(name), no_text) for name in ("source_file", "reason", "raw")]
    listed = (
        read_quarantine(spark, quarantine)
        .select(F.sha2(F.to_json(F.array(*parts)), 256).alias("row_id"), "reason", "source_file", "raw")
        .dropDuplicates(["row_id"])
    )
    still = listed.join(read_resolved(spark, resolved).select("row_id").distinct(), "row_id", "left_anti")
    said = still.withColumn("said", F.from_json("raw", _RAW))
    return said.select(
        *RESOLVED.names,
        F.col("said.locationId").alias("locationId"),
        F.coalesce("said.utc_text", "said.date.utc").alias("utc"),
        F.col("said.parameter").alias("parameter"),
        F.col("said.value").alias("value"),
    )


def repaired(rows: DataFrame, repairs: Mapping[str, Column]) -> DataFrame:
    """Open rows that the repairs make whole, as warehouse rows next to their identity.

    `repairs` gives expressions over the text fields (and `reason`, `raw`, `source_file`); fields
    without one stay as they are. A row still without key or time, or with a value that is no
    number, is left out and stays open.
    """
    unknown = set(repairs) - set(FIELDS)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    texts = {name: repairs.get(name, F.col(name)).cast("string") for name in FIELDS}
    put = rows.select(*RESOLVED.names, *[texts[name].alias(f"{name}_text") for name in FIELDS])
    typed = put.select(
        *RESOLVED.names,
        F.col("locationId_text").try_cast("long").alias("locationId"),
        parse_instant(F.col("utc_text")).alias("utc"),
        F.col("parameter_text").alias("parameter"),
        F.col("value_text").try_cast("double").alias("value"),
        "value_text",
    )
    whole = F.col("locationId").isNotNull() & F.col("utc").isNotNull() & F.col("parameter").isNotNull()
    right = F.col("value").isNotNull() | F.col("value_text").isNull()
    return typed.filter(whole & right).drop("value_text")


def replay(
    spark: SparkSession, quarantine: str, resolved: str, warehouse: str, repairs: Mapping[str, Column]
) -> int:
    """Load what the repairs make whole, and enter it as resolved; returns the rows resolved.

    A stored value of the same key stays: it was fetched right. Rows are entered after they are
    loaded; a run that dies between loads the same rows again, which adds nothing. The repaired rows
    are staged once, so load and ledger see the same ones.
    """
    path = new_dir(spark, "repaired")
    found = repaired(open_rows(spark, quarantine, resolved), repairs)
    found.write.orc(path)
    staged = spark.read.schema(T.StructType([*RESOLVED.fields, *MEASUREMENT.fields])).orc(path)
    append_new(with_day(staged).select(*WAREHOUSE.names), warehouse)
    done = staged.select(*RESOLVED.names)
    count = done.count()
    if count:
        done.write.mode("append").orc(resolved)
    discard(spark, path)
    return count
