"""Publishing by snapshot: readers see one whole publication or the one before.

A publication is written to a folder of its own below `versions`. Only then a marker with the next
number and the folder's name is made below `current`; making an empty file is one step in every
file system. Readers take the folder of the greatest marker. A run that dies before its marker
leaves nothing that a reader would find, and the next publication goes on as if it had not been.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hazeline.scratch import discard, files_below, mark, subfolders
from hazeline.sources.files import read_csv, write_csv

KEPT = 2  # publications a reader may still be reading


def markers(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and version of all publications that are complete, oldest first."""
    found = (name.split("-", 1) for name in files_below(spark, f"{root}/current"))
    return sorted((int(number), version) for number, version in found)


def current(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest complete publication."""
    done = markers(spark, root)
    return f"{root}/versions/{done[-1][1]}" if done else None


def publish_snapshot(rows: DataFrame, root: str, *, header: bool = True, keep: int = KEPT) -> str:
    """Write a publication, show it to readers, and remove what is older than the last `keep`.

    One publisher at a time. Returns the publication's folder.
    """
    spark = rows.sparkSession
    version = uuid4().hex
    folder = f"{root}/versions/{version}"
    write_csv(rows, folder, header=header)
    done = markers(spark, root)
    number = done[-1][0] + 1 if done else 1
    mark(spark, f"{root}/current/{number:012d}-{version}")
    done.append((number, version))
    for old, _ in done[:-keep]:
        discard(spark, f"{root}/current/{old:012d}-{dict(done)[old]}")
    held = {name for _, name in done[-keep:]}
    for name in subfolders(spark, f"{root}/versions"):
        if name not in held:
            discard(spark, f"{root}/versions/{name}")
    return folder


def publish_snapshots(rows: DataFrame, roots: Sequence[str], *, header: bool = True) -> None:
    """The same rows to several places, each whole or not at all."""
    for root in roots:
        publish_snapshot(rows, root, header=header)


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType, *, header: bool = True) -> DataFrame:
    """The newest publication; no rows before the first."""
    folder = current(spark, root)
    if folder is None:
        return spark.createDataFrame([], schema)
    return read_csv(spark, folder, schema, header=header)
