"""Which landing files were loaded: a ledger next to the warehouse, in place of a high-water mark.

A file is told by its path, time and length, so a file that comes late to an old folder, and one
that is written anew, are loaded by the next run, and a run that is cut off goes on with the
files it has not entered. A load is entered after its rows are stored; cut off in between, the
same files are loaded again, which changes nothing.

The ledger is ORC by landing day. Files are listed and compared with it by a distributed
anti-join; the new ones come to the driver in landing order, a load at a time, and a load is
bounded in bytes and in files.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.paths import landing_day
from hazeline.scratch import discard, new_dir
from hazeline.sources.files import read_orc
from hazeline.sources.landing import day_folders, file_inventory

LOAD_BYTES = 256 << 30
LOAD_FILES = 100_000

LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("load", T.StringType()),
        T.StructField("day", T.DateType()),
    ]
)
_FILE = ["path", "length", "modified"]


@dataclass(frozen=True)
class Load:
    """Files to be loaded together; the id is that of the files, so a repeated load has it again."""

    id: str
    files: list[tuple]  # path, length, modified, day

    @property
    def paths(self) -> list[str]:
        # Spark takes a path for a pattern.
        return [re.sub(r"([\\{}\[\]*?])", r"\\\1", file[0]) for file in self.files]

    @property
    def first_day(self) -> date | None:
        return min((file[3] for file in self.files if file[3] is not None), default=None)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_orc(spark, path, LEDGER)


def landing_files(spark: SparkSession, root: str, start: date | None, end: date) -> DataFrame:
    """path, length, modified, day of the JSON files in the day folders before `end`; those since
    `start`, or all of the tree, files outside day folders included."""
    found = file_inventory(spark, root if start is None else day_folders(root, start, end), "*.json")
    dated = found.withColumn("day", landing_day(F.col("path")))
    return dated.filter(F.col("day").isNull() | (F.col("day") < F.lit(end)))


def unloaded(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger doesn't hold as they are now."""
    return files.join(ledger.select(*_FILE), _FILE, "left_anti")


def loads(new: DataFrame, *, load_bytes: int = LOAD_BYTES, load_files: int = LOAD_FILES) -> Iterator[Load]:
    """The files in landing order, in loads of bounded size; one load is held at a time."""
    spark = new.sparkSession
    path = new_dir(spark, "pending")
    new.select(*_FILE, "day").write.orc(path)
    pending = spark.read.schema(new.select(*_FILE, "day").schema).orc(path)
    held: list[tuple] = []
    total = 0
    for row in pending.orderBy(F.col("day").asc_nulls_first(), "modified", "path").toLocalIterator():
        if held and (total + row.length > load_bytes or len(held) >= load_files):
            yield _load(held)
            held, total = [], 0
        held.append(tuple(row))
        total += row.length
    if held:
        yield _load(held)
    discard(spark, path)


def _load(files: list[tuple]) -> Load:
    told = hashlib.sha256(repr([(p, size, at.isoformat()) for p, size, at, _ in files]).encode())
    return Load(told.hexdigest()[:16], list(files))


def enter(spark: SparkSession, path: str, load: Load) -> None:
    """Enter a load's files; called once its rows are stored."""
    rows = [(p, size, at, load.id, day) for p, size, at, day in load.files]
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").partitionBy("day").orc(path)
