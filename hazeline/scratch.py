"""Shared folder for staged tables and stream checkpoints.

A staged table cuts lineage in a way that outlives any executor, so it has to lie on
storage every node sees. The cluster names that place in `spark.checkpoint.dir`; only a
local session without the setting falls back to a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every node can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="hazeline-")
    return _LOCAL_ROOTS[context.applicationId]


def new_dir(spark: SparkSession, label: str) -> str:
    """A path nobody used before; Spark creates it with the first write."""
    return f"{scratch_root(spark)}/hazeline/{label}-{uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def make_folder(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jvm_path)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file that says something is done."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(jvm_path, True).close()


def _names(spark: SparkSession, path: str, *, folders: bool) -> list[str]:
    if not exists(spark, path):
        return []
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    below = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jvm_path)
    return [status.getPath().getName() for status in below if status.isDirectory() == folders]


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none where the path is not there."""
    return _names(spark, path, folders=True)


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below a path; none where the path is not there."""
    return _names(spark, path, folders=False)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table once what it was staged for is committed."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def put_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file to its place, instead of one that may be there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    old, new = jvm_path(source), jvm_path(target)
    system = new.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(new.getParent())
    system.delete(new, False)
    if not system.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")
