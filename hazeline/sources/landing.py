"""Landing zone: nested JSON measurements, read and written in bulk."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.paths import day_parts, landing_day, tree_keys
from hazeline.functions.timestamps import parse_instant, utc_day
from hazeline.schemas import ARRIVED, CORRUPT, DAY, LANDED, RECORD, RECORD_OR_CORRUPT, STAGED, WAREHOUSE
from hazeline.scratch import discard, exists, make_folder, new_dir, put_file
from hazeline.session import listing, settings
from hazeline.sources.json_text import WHOLE_BYTES, read_any_records
from hazeline.sources.named_files import put_text_files, uri_of

# 2 ** 12 records per array keeps one array a few MB, whatever the data looks like.
ARRAY_BITS = 12


def read_or_empty(
    read: Callable[[], DataFrame], spark: SparkSession, schema: T.StructType
) -> DataFrame:
    """A path that is not there yet holds no rows; every other error is raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def tree_folders(root: str) -> str:
    """Every sensor folder of a landing tree (yr/mnt/dy/sensor) as one path.

    A path per sensor folder lets Spark list all of them in one distributed job; from the
    root it would walk the tree on the driver, with a job for every day.
    """
    return root + "/*/*/*/*"


def day_folders(root: str, start: date, end: date) -> str:
    """The sensor folders of the days in [start, end) as one path.

    A glob, because some days may have no folder; it keeps the listing to the days asked for.
    Days are plain folders, or `name=value` ones as `write_landing` makes them.
    """
    days = [start + timedelta(days=number) for number in range((end - start).days)]
    shapes = ("%Y/%m/%d", "yr=%Y/mnt=%m/dy=%d")
    folders = [day.strftime(shape) for shape in shapes for day in days]
    return root + "/{" + ",".join(folders) + "}/*"


def read_records(
    spark: SparkSession,
    path: str,
    *,
    array_files: bool = True,
    mode: str = "PERMISSIVE",
    schema: T.StructType | None = None,
    glob: str = "*.json",
    arrival: bool = False,
) -> DataFrame:
    """Every measurement below `path`, in one read.

    `array_files`: each file is one JSON array over many lines, the way fetched results are
    saved. Such a file is one task's work. Without it each line is a record or an array of
    records, and files split. Malformed text goes to the `_corrupt_record` column in
    PERMISSIVE mode and is left out in DROPMALFORMED mode. `source_file` names a row's file;
    with `arrival`, `arrived` is its landing order.
    """
    if schema is None:
        schema = RECORD_OR_CORRUPT if mode.upper() == "PERMISSIVE" else RECORD
    reader = (
        spark.read.schema(schema)
        .option("mode", mode)
        .option("multiLine", array_files)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
    )
    if CORRUPT in schema.names:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    added = [T.StructField("source_file", T.StringType())]
    if arrival:
        added.append(T.StructField(ARRIVED, T.LongType()))
    with_source = T.StructType([*schema.fields, *added])
    return read_or_empty(
        lambda: name_source(reader.json(path), arrival=arrival), spark, with_source
    )


def landed_records(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    array_files: bool | None = None,
    whole_bytes: int = WHOLE_BYTES,
    glob: str = "*.json",
) -> DataFrame:
    """Records as a load reads them: fields as text, source file, landing order.

    By default every file says itself whether it holds an array or lines, and files above
    `whole_bytes` are read by many tasks (see `json_text`). `array_files` says it for all.
    """
    if array_files is not None:
        return read_records(spark, path, array_files=array_files, schema=LANDED, glob=glob, arrival=True)
    with_source = T.StructType(
        [*LANDED.fields, T.StructField("source_file", T.StringType()), T.StructField(ARRIVED, T.LongType())]
    )
    return read_or_empty(lambda: _any_landed(spark, path, whole_bytes, glob), spark, with_source)


def _any_landed(spark: SparkSession, path: str | Sequence[str], whole_bytes: int, glob: str) -> DataFrame:
    records = read_any_records(spark, path, LANDED, CORRUPT, glob=glob, whole_bytes=whole_bytes)
    return records.select(
        *LANDED.names,
        F.col("file").alias("source_file"),
        _landing_order(F.col("file"), F.col("modified")).alias(ARRIVED),
    )


def _landing_order(path: Column, modified: Column) -> Column:
    """The landing day, then the file's time in milliseconds (42 bits), as one number; files
    outside day folders count as of the first day."""
    day = F.coalesce(F.unix_date(landing_day(path)), F.lit(0)).cast("long")
    return F.shiftleft(day, 42) + F.unix_millis(modified)


def name_source(records: DataFrame, *, arrival: bool = False) -> DataFrame:
    """Adds the file a record came from, and on demand its landing order."""
    path = F.col("_metadata.file_path")
    added = [path.alias("source_file")]
    if arrival:
        added.append(_landing_order(path, F.col("_metadata.file_modification_time")).alias(ARRIVED))
    return records.select("*", *added)


def bounded_arrays(records: DataFrame, bits: int = ARRAY_BITS) -> DataFrame:
    """Rows packed into arrays of at most 2**bits records each.

    Neighbouring rows of one task are packed together, so an array's size does not depend on
    how many rows share a key.
    """
    return (
        records.select(
            F.struct(*records.columns).alias("record"),
            F.shiftright(F.monotonically_increasing_id(), bits).alias("pack"),
        )
        .groupBy("pack")
        .agg(F.collect_list("record").alias("records"))
        .select("records")
    )


def write_array_files(records: DataFrame, path: str, bits: int = ARRAY_BITS) -> None:
    """Pretty-printed JSON arrays, one array per file. No rows, no file.

    Arrays of more than 2**ARRAY_BITS records are written record by record, so that no task holds
    one; where pyarrow doesn't know the file system each of those has a folder of its own.
    """
    spark = records.sparkSession
    uri = None if exists(spark, path) else uri_of(spark, path)
    pretty = {"pretty": "true"}
    if bits <= ARRAY_BITS:
        arrays = bounded_arrays(records, bits).select(F.to_json("records", pretty).alias("line"))
        number = F.monotonically_increasing_id().cast("string")
        named = arrays.select("line", F.concat(F.lit("part-\0"), number).alias("array"))
    else:
        named = _long_arrays(records, bits, pretty)
    # An array is one row of text, so fewer go to a task's Python at a time.
    few = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(max(1, (1 << 16) >> bits))} if bits <= ARRAY_BITS else {}
    with settings(spark, **few):
        if uri is not None:
            put_text_files(named, uri, ["array"], "-{job}.txt")
            make_folder(spark, path)
        elif bits <= ARRAY_BITS:
            named.select("line").write.option("maxRecordsPerFile", 1).text(path)
        else:
            named.withColumn("array", F.substring_index("array", "\0", -1)).write.partitionBy("array").text(path)


def _long_arrays(records: DataFrame, bits: int, pretty: dict[str, str]) -> DataFrame:
    """Records as the lines of their arrays: each array in one task, in order, brackets at its ends."""
    at = F.col("at")
    placed = records.select(F.struct(*records.columns).alias("record"), F.monotonically_increasing_id().alias("at"))
    packed = placed.withColumn("pack", F.shiftright(at, bits))
    last = F.lead("at").over(Window.partitionBy("pack").orderBy("at")).isNull()
    told = packed.withColumn("last", last).sortWithinPartitions("pack", "at")
    opens = F.when(at.bitwiseAND(F.lit((1 << bits) - 1)) == 0, "[ ").otherwise(", ")
    closes = F.when(F.col("last"), " ]").otherwise("")
    return told.select(
        F.concat(opens, F.to_json("record", pretty), closes).alias("line"),
        F.concat(F.lit("part-\0"), F.col("pack").cast("string")).alias("array"),
    )


def write_landing(
    records: DataFrame,
    path: str,
    day: str,
    levels: Sequence[str] = ("yr", "mnt", "dy", "loc", "par"),
    mode: str = "append",
) -> None:
    """Records as a JSON tree with one folder per level; a cell without rows gets no folder.

    The levels are extra columns, so the records in the files stay whole. Folders per sensor
    and parameter suit a small network; a large one keeps to the day levels, because the
    number of files is the number of folders at least. The rebalance brings a folder's rows
    together and splits a folder that is too large for one task. Below the day a folder costs more
    than its bytes, so there the rebalance keeps all its tasks, however few bytes each has.
    """
    spark = records.sparkSession
    parts = day_parts(F.col(day))
    parts["loc"] = F.col("locationId").cast("string")
    parts["par"] = F.col("parameter")
    leveled = records.select(
        *[name for name in records.columns if name != day],
        *[parts[name].alias(name) for name in levels],
    )
    if {"loc", "par"}.isdisjoint(levels):
        leveled.hint("rebalance", *levels).write.mode(mode).partitionBy(*levels).json(path)
        return
    uri = uri_of(spark, path) if mode == "append" else None
    with settings(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        if uri is None:
            leveled.hint("rebalance", *levels).write.mode(mode).partitionBy(*levels).json(path)
            return
        none = F.lit("__HIVE_DEFAULT_PARTITION__")
        named = {name: F.coalesce(F.nullif(parts[name], F.lit("")), none) for name in levels}
        _put_lines(
            _as_lines(records, day, {name: (f"{name}=", named[name]) for name in levels})
            .hint("rebalance", *levels),
            uri, levels, "/part-{part}-{job}.json",
        )
    make_folder(spark, path)


def write_landing_files(records: DataFrame, path: str, day: str) -> int:
    """Records as yr/mnt/dy/locationId/parameter.json, a file of lines each; returns their number.

    The layout that fetched results are saved in, for other tools that expect it. A file that is
    there is replaced, as a re-fetch does. Records without day, sensor or parameter go to `none`,
    where loads find and set them aside; characters that paths can't hold are escaped as Spark does.

    Tasks write all files below the path, one each, so the largest is one task's work; then tasks
    move them (see `named_files`). Where pyarrow doesn't know the file system the driver moves them
    one by one, for networks of some ten thousand files a call.
    A call that dies between has replaced some files whole and the others not; call it again.
    """
    spark = records.sparkSession
    parts = day_parts(F.col(day))
    parts["loc"] = F.col("locationId").cast("string")
    parts["par"] = F.nullif(F.col("parameter"), F.lit(""))
    levels = list(parts)
    named = {name: F.coalesce(part, F.lit("none")) for name, part in parts.items()}
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    uri = uri_of(spark, path)
    if uri is not None:
        lines = _as_lines(records, day, {name: ("", named[name]) for name in levels})
        return _put_lines(lines.repartition(tasks, *levels), uri, levels, ".json")
    staged = new_dir(spark, "tree")
    (
        records.select(
            *[name for name in records.columns if name != day],
            *[part.alias(name) for name, part in named.items()],
        )
        .repartition(tasks, *levels)
        .sortWithinPartitions(*levels)
        .write.option("maxRecordsPerFile", 0)
        .partitionBy(*levels)
        .json(staged)
    )
    count = 0
    for row in file_inventory(spark, staged, "part-*").select("path").toLocalIterator():
        names = [level.split("=", 1)[1] for level in row.path.split("/")[-1 - len(levels):-1]]
        put_file(spark, row.path, "/".join([path, *names]) + ".json")
        count += 1
    discard(spark, staged)
    return count


def _as_lines(records: DataFrame, day: str, folders: dict[str, tuple[str, Column]]) -> DataFrame:
    """Records without their day as JSON lines, next to their folders as `named_files` takes them."""
    parts = [F.concat(F.lit(f"{head}\0"), value).alias(name) for name, (head, value) in folders.items()]
    kept = [name for name in records.columns if name != day]
    return records.select(F.to_json(F.struct(*kept)).alias("line"), *parts)


def _put_lines(lines: DataFrame, uri: str, levels: Sequence[str], ending: str) -> int:
    return put_text_files(lines.sortWithinPartitions(*levels), uri, levels, ending)


def parsed(records: DataFrame) -> DataFrame:
    """Records in the staged shape: canonical columns, and the reason a row is no good.

    Takes typed records and those of `landed_records`, whose fields are text: there a field
    that is no number is a bad row with the field's name as reason.
    """
    as_text = isinstance(records.schema["date"].dataType, T.StringType)
    utc_text = F.get_json_object("date", "$.utc") if as_text else F.col("date.utc")
    arrived = F.col(ARRIVED) if ARRIVED in records.columns else F.lit(None).cast("long")
    canonical = records.select(
        F.col("locationId").try_cast("long").alias("locationId"),
        parse_instant(utc_text).alias("utc"),
        "parameter",
        F.col("value").try_cast("double").alias("value"),
        "unit",
        CORRUPT,
        "source_file",
        arrived.alias(ARRIVED),
        utc_text.alias("utc_text"),
        F.col("locationId").cast("string").alias("location_text"),
        F.col("value").cast("string").alias("value_text"),
    )
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), "malformed")
        .when(F.col("utc").isNull(), "utc")
        .when(F.col("locationId").isNull() | F.col("parameter").isNull(), "key")
        .when(F.col("value").isNull() & F.col("value_text").isNotNull(), "value")
    )
    value_json = F.when(F.col("value").isNull(), F.col("value_text"))
    typed = F.struct("locationId", "utc_text", "parameter", "value")
    spoilt = F.struct(
        F.col("location_text").alias("locationId"),
        "utc_text",
        "parameter",
        F.col("value_text").alias("value"),
    )
    is_spoilt = value_json.isNotNull() | (
        F.col("locationId").isNull() & F.col("location_text").isNotNull()
    )
    raw = F.coalesce(
        CORRUPT,
        F.when(reason.isNotNull(), F.when(is_spoilt, F.to_json(spoilt)).otherwise(F.to_json(typed))),
    )
    return canonical.select(
        "locationId",
        "utc",
        "parameter",
        "value",
        utc_day(canonical, "utc").alias(DAY),
        "unit",
        ARRIVED,
        raw.alias("raw"),
        reason.alias("reason"),
        "source_file",
        F.when(reason.isNull(), "good").otherwise("bad").alias("outcome"),
    )


def stage(records: DataFrame, path: str) -> None:
    """Parse once and write good and bad rows side by side, split by the `outcome` folder.

    One pass over the JSON serves both the load and the quarantine, and what follows reads
    columnar files that no longer depend on the landing zone. Two open writers per task
    stand in for sorting everything by outcome.
    """
    spark = records.sparkSession
    with settings(spark, **{"spark.sql.maxConcurrentOutputFileWriters": "2"}):
        parsed(records).write.mode("overwrite").partitionBy("outcome").orc(path)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(lambda: spark.read.schema(STAGED).orc(path), spark, STAGED)


def good_rows(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("outcome") == "good").select(
        "locationId", "utc", "parameter", "value", DAY
    )


def ordered_rows(staged: DataFrame) -> DataFrame:
    """The good rows with their landing order, as loads take them."""
    return staged.filter(F.col("outcome") == "good").select(*WAREHOUSE.names, ARRIVED)


def bad_rows(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("outcome") == "bad").select("reason", "raw", "source_file")


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per file below `path`, without opening any: path, length, modified."""
    schema = T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("length", T.LongType()),
            T.StructField("modificationTime", T.TimestampType()),
        ]
    )
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
    )
    with listing(spark):
        files = read_or_empty(lambda: reader.load(path), spark, schema)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def landed_cells(spark: SparkSession, path: str) -> DataFrame:
    """Which (day, sensor, parameter) files are there, read off the file names."""
    files = file_inventory(spark, path, "*.json")
    keys = tree_keys(F.col("path"))
    return (
        files.select(
            F.make_date(
                keys["yr"].cast("int"), keys["mnt"].cast("int"), keys["dy"].cast("int")
            ).alias("day"),
            keys["loc"].cast("long").alias("locationId"),
            keys["par"].alias("parameter"),
        )
        .filter(F.col("locationId").isNotNull())
        .distinct()
    )
