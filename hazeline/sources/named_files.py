"""Text files by names of our own, written and put in their place by tasks.

Spark's writers choose their files' names, open each by several calls of the file system, and move
them into place on the driver: little for large files, nearly all the time for a file of a few rows
in each of many folders. Here tasks write all files below the target first, and tasks of a second job
move them, so a job that fails in the first has put nothing there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from hazeline.scratch import discard, new_dir

_PUT = "staged string, name string"


def uri_of(spark: SparkSession, path: str) -> str | None:
    """The whole URI of a path where pyarrow knows its file system, else None."""
    from pyarrow import ArrowInvalid, fs

    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(jvm_path).toString()
    if uri.startswith("file:"):
        return uri.removeprefix("file:").replace("//", "/")
    try:
        fs.FileSystem.from_uri(uri)
    except (ArrowInvalid, NotImplementedError, OSError):
        return None
    return uri


def put_text_files(texts: DataFrame, uri: str, folders: Sequence[str], ending: str) -> int:
    """Rows of text to `uri`/<values of `folders`><ending>, lines in no order; returns the files' number.

    Rows come sorted by `folders` inside their partitions, the text in `line`. A folder is its head,
    a zero character and its value; characters that paths can't hold are escaped in values as Spark
    does. `ending` may hold `{part}`, the number of the task, and `{job}`, an id of this call; without
    the number a file's rows have to be in one partition. A file that is there is replaced.
    """
    spark = texts.sparkSession
    levels, staging, job = list(folders), f"{uri.rstrip('/')}/_staging-{uuid4().hex}", uuid4().hex

    # The functions of tasks go along by value, so they import what they use.
    def write(batches: Iterator) -> Iterator:
        import re
        from uuid import uuid4

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        unsafe = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")

        def safe(value: str) -> str:
            return unsafe.sub(lambda found: f"%{ord(found[0]):02X}", value)

        system = root = out = key = None
        done: list[tuple[str, str]] = []
        try:
            for batch in batches:
                if system is None and batch.num_rows:
                    system, root = fs.FileSystem.from_uri(staging)
                    system.create_dir(root, recursive=True)
                keys = zip(*[batch.column(name).to_pylist() for name in levels])
                for row, line in zip(keys, batch.column("line").to_pylist()):
                    if row != key:
                        if out is not None:
                            out.close()
                        key, staged = row, f"{root}/{uuid4().hex}"
                        out = system.open_output_stream(staged)
                        name = "/".join(head + safe(value) for head, value in (cell.split("\0", 1) for cell in row))
                        done.append((staged, name + ending.format(part=f"{part:05d}", job=job)))
                    out.write((line + "\n").encode())
                if len(done) >= 10_000:
                    # The last one is still open.
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done[:-1])], ["staged", "name"])
                    done = done[-1:]
        finally:
            if out is not None:
                out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], ["staged", "name"])

    def move(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(uri)
        made: set[str] = set()
        for batch in batches:
            for staged, name in zip(batch.column("staged").to_pylist(), batch.column("name").to_pylist()):
                target = f"{root}/{name}"
                folder, last = target.rsplit("/", 1)
                if system.get_file_info(staged).type == fs.FileType.NotFound:
                    # An earlier attempt of this task has moved it.
                    if system.get_file_info(target).type == fs.FileType.NotFound:
                        raise FileNotFoundError(staged)
                    continue
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                # Hadoop's sum of a file it wrote doesn't hold for another file of that name.
                stale = [f"{folder}/.{last}.crc"] if system.type_name == "local" else [target]
                for old in stale:
                    if system.get_file_info(old).type != fs.FileType.NotFound:
                        system.delete_file(old)
                system.move(staged, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["files"])

    names = new_dir(spark, "names")
    try:
        texts.select(*levels, "line").mapInArrow(write, _PUT).write.orc(names)
        moved = spark.read.schema(_PUT).orc(names).mapInArrow(move, "files long")
        return moved.groupBy().sum("files").first()[0] or 0
    finally:
        discard(spark, names)
        discard(spark, staging)
