"""Records out of JSON text files of any size, arrays and lines told apart by the file.

Files up to `whole_bytes` are read whole, a row each. A file whose first line closes all it
opens holds lines, any other one array or object over many lines; both come out of one read.

Larger files are read by many tasks. The text is cut at every `}`, wherever byte ranges begin,
and each segment tells whether its quotes are odd in number and how many `{` it opens, once for
beginning outside a string and once for beginning inside. Per range these add up, and running
sums over a file's ranges, of quotes first and then of depths, say how each range begins. A
record ends where depth comes back to zero; segments up to the same end are one record. Arrays,
lines and lines of arrays are all read that way, since only braces count.

A large file with one whole object on each of its lines needs none of that: a pass that shuffles
a row per file tells such files, and they are read by lines.

Where a fault breaks a large file's structure, the records before it are good and all that
follows is set aside as one row, named by its first segment; a small file with such a fault is
set aside whole. Blank files hold no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.scratch import new_dir
from hazeline.session import listing

WHOLE_BYTES = 64 << 20
_BETWEEN = r"^[\s,\[\]\x{FEFF}]+"
_ESCAPED = r"\\."
_STRING = r'"[^"]*(?:"|$)'
# An object with no more than objects in objects in it, strings taken out; without backtracking.
_FLAT = r"\{[^{}]*+\}"
_NESTED = rf"\{{[^{{}}]*+(?:{_FLAT}[^{{}}]*+)*+\}}"
_ONE_OBJECT = rf"^\{{[^{{}}]*+(?:{_NESTED}[^{{}}]*+)*+\}}$"
# Longer lines are passed over, so that an array on one line is no task's work; such files
# then lack bytes and are not read by lines.
LINE_BYTES = 16 << 20
_BY_LINES = {"mapreduce.input.linerecordreader.line.maxlength": LINE_BYTES}


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _outside(text: Column) -> Column:
    """Text without its strings; escapes are gone already."""
    return F.regexp_replace(text, _STRING, "")


def _holds_lines(value: Column) -> Column:
    """Whether the first line that is not blank closes all it opens."""
    line = F.regexp_extract(value, r"^\s*([^\n]*)", 1)
    bare = _outside(F.regexp_replace(line, _ESCAPED, ""))
    return _count(bare, "{[") == _count(bare, "}]")


def _texts(spark: SparkSession, path: str | Sequence[str], glob: str, **options: object) -> DataFrame:
    reader = spark.read.options(**options).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    meta = F.col("_metadata")
    return reader.format("text").load([path] if isinstance(path, str) else list(path)).select(
        "value",
        meta["file_path"].alias("file"),
        meta["file_size"].alias("size"),
        meta["file_modification_time"].alias("modified"),
        meta["file_block_start"].alias("block"),
    )


def whole_pieces(texts: DataFrame) -> DataFrame:
    """piece, file, modified: JSON text with an array or an object in it."""
    value = F.expr("trim(LEADING '﻿' FROM value)")
    lines = F.when(_holds_lines(value), F.split(value, "\n")).otherwise(F.array(value))
    return texts.select(F.explode(lines).alias("piece"), "file", "modified").filter(~F.col("piece").rlike(r"^\s*$"))


def line_files(texts: DataFrame) -> list[str]:
    """Of files read by lines, those where every line is one whole object, or blank."""
    bare = _outside(F.regexp_replace("value", _ESCAPED, ""))
    # The ends tell most lines of an array apart, and cost little.
    ends = F.col("value").startswith("{") & F.col("value").endswith("}")
    whole = F.when(ends, bare.rlike(_ONE_OBJECT)).otherwise(F.col("value").rlike(r"^\s*$"))
    told = texts.groupBy("file").agg(
        F.every(whole).alias("whole"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.max("size").alias("size"),
    )
    # The last line may go without its end.
    found = told.filter(F.col("whole") & (F.col("bytes") - F.col("size")).between(0, 1))
    return [row.file for row in found.select("file").collect()]


def line_pieces(texts: DataFrame) -> DataFrame:
    """piece, file, modified: the lines that are not blank."""
    return texts.select(F.col("value").alias("piece"), "file", "modified").filter(~F.col("piece").rlike(r"^\s*$"))


def segments(texts: DataFrame) -> DataFrame:
    """Each segment with its place, whether its quotes are odd, what it opens if it begins outside
    a string (opens_0) or inside (opens_1), and the like sums over its range up to it."""
    bare = F.regexp_replace("value", _ESCAPED, "")
    told = texts.select(
        "*",
        F.monotonically_increasing_id().alias("at"),  # ascends inside a range
        F.pmod(_count(bare, '"'), F.lit(2)).alias("odd"),
        _count(_outside(bare), "{").alias("opens_0"),
        _count(_outside(F.concat(F.lit('"'), bare)), "{").alias("opens_1"),
    )
    place = Window.partitionBy("file", "block").orderBy("at")
    upto = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.pmod(F.sum("odd").over(upto) - F.col("odd"), F.lit(2))
    told = told.withColumn("parity", before)
    for start in (0, 1):
        inside = F.pmod(F.col("parity") + start, F.lit(2)) == 1
        closes = F.pmod(F.col("parity") + F.col("odd") + start, F.lit(2)) == 0
        step = F.when(inside, F.col("opens_1")).otherwise(F.col("opens_0")) - closes.cast("int")
        told = told.withColumn(f"depth_{start}", F.sum(step).over(upto))
    return told


def _ranges(segs: DataFrame) -> DataFrame:
    """How each byte range of a file begins: inside a string or not, and at which depth."""
    whole = segs.groupBy("file", "block").agg(
        F.sum("odd").alias("odds"),
        F.max_by("depth_0", "at").alias("sum_0"),
        F.max_by("depth_1", "at").alias("sum_1"),
        F.min("depth_0").alias("low_0"),
        F.min("depth_1").alias("low_1"),
        F.max("at").alias("last"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.max("size").alias("size"),
    )
    in_order = Window.partitionBy("file").orderBy("block")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    of_file = Window.partitionBy("file")
    begun = whole.withColumn("start", F.pmod(F.coalesce(F.sum("odds").over(earlier), F.lit(0)), F.lit(2)))
    outside = F.col("start") == 0
    grown = F.when(outside, F.col("sum_0")).otherwise(F.col("sum_1"))
    based = begun.withColumn("base", F.coalesce(F.sum(grown).over(earlier), F.lit(0)))
    lowest = F.col("base") + F.when(outside, F.col("low_0")).otherwise(F.col("low_1"))
    return based.select(
        "file",
        "block",
        "start",
        "base",
        # Once a brace closes what none opened, nothing that follows is a record.
        F.coalesce(F.min(lowest).over(earlier) >= 0, F.lit(True)).alias("sound"),
        # The last segment of a file that doesn't end with a brace is not closed.
        F.when(
            (F.col("block") == F.max("block").over(of_file)) & (F.sum("bytes").over(of_file) > F.col("size")),
            F.col("last"),
        ).alias("open_end"),
    )


def split_pieces(texts: DataFrame) -> DataFrame:
    """piece, file, modified: the records of large files, put together from their segments.

    The segments are written once: what follows reads them several times.
    """
    spark = texts.sparkSession
    path = new_dir(spark, "segments")
    segments(texts).write.orc(path)
    segs = spark.read.orc(path)
    key = ["file", "block"]
    depth = F.when(F.col("start") == 0, F.col("depth_0")).otherwise(F.col("depth_1")) + F.col("base")
    outside = F.pmod(F.col("start") + F.col("parity") + F.col("odd"), F.lit(2)) == 0
    closed = F.col("open_end").isNull() | (F.col("at") != F.col("open_end"))
    here = F.struct("block", "at")
    upto = Window.partitionBy(*key).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = segs.join(_ranges(segs), key).withColumn("depth", depth).select(
        *key, "at", "value", "modified",
        closed.alias("closed"),
        F.when(closed & outside & (F.col("depth") == 0) & F.col("sound") & (F.min("depth").over(upto) >= 0), here).alias("end"),
    )
    place = Window.partitionBy(*key).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    in_order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ended.groupBy(*key).agg(F.max("end").alias("last_end")).select(
        *key,
        F.last("last_end", ignorenulls=True).over(in_order).alias("prior"),
        F.max("last_end").over(Window.partitionBy("file")).alias("final"),
    )
    after = F.coalesce(F.last("end", ignorenulls=True).over(place), F.col("prior"))
    dealt = ended.join(ends, key).withColumn("after", after)
    rest = F.col("final").isNull() | F.coalesce(F.col("after") >= F.col("final"), F.lit(False))
    part = F.struct("block", "at", "value")
    done = (
        dealt.filter(~rest).groupBy("file", "modified", "after")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .select(F.concat(F.array_join("parts.value", "}"), F.lit("}")).alias("text"), "file", "modified")
    )
    spare = F.regexp_replace("value", _BETWEEN, "")
    broken = (
        dealt.filter(rest & (F.col("closed") | (F.length(spare) > 0))).groupBy("file", "modified")
        .agg(F.min(part).alias("first"))
        # Never a record: what is left of one, or a brace that nothing opened.
        .select(F.concat(F.col("first.value"), F.lit("…")).alias("piece"), "file", "modified")
    )
    pieces = done.select(F.regexp_replace("text", _BETWEEN, "").alias("piece"), "file", "modified")
    return pieces.unionByName(broken)


def parsed_pieces(pieces: DataFrame, schema: T.StructType, corrupt: str) -> DataFrame:
    """The records in the pieces, with file and modified; what is no record has its text in `corrupt`."""
    fields = [f for f in schema.fields if f.name != corrupt]
    several = pieces.withColumn("records", F.from_json("piece", T.ArrayType(T.StructType(fields))))
    none = F.col("records").isNull()
    found = several.select(
        "file", "modified",
        F.when(none, F.col("piece")).alias("bad"),
        F.explode(F.when(none, F.array(F.lit(None).cast(T.StructType(fields)))).otherwise(F.col("records"))).alias("r"),
    )
    # An element that is no object has no text of its own here.
    text = F.when(F.col("r").isNull(), F.coalesce("bad", F.lit("null")))
    columns = [text.alias(f.name) if f.name == corrupt else F.col("r")[f.name].alias(f.name) for f in schema.fields]
    return found.select(*columns, "file", "modified")


def read_any_records(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    corrupt: str,
    *,
    glob: str = "*.json",
    whole_bytes: int = WHOLE_BYTES,
) -> DataFrame:
    """Records of all files below the path or paths, whatever their shape and size.

    Each kind of file is listed for its own read, by its size, so a folder without large files
    costs no pass over segments.
    """
    with listing(spark):
        small = _texts(spark, path, glob, wholetext=True).filter(F.col("size") <= whole_bytes)
        # Lines are cut at braces; files are opened only if they are large.
        large = _texts(spark, path, glob, lineSep="}").filter(F.col("size") > whole_bytes)
    pieces = whole_pieces(small)
    if not large.limit(1).isEmpty():
        with listing(spark):
            by_lines = _texts(spark, path, glob, **_BY_LINES).filter(F.col("size") > whole_bytes)
        named = F.col("file").isin(line_files(by_lines))
        pieces = pieces.unionByName(line_pieces(by_lines.filter(named)))
        ragged = large.filter(~named)
        if not ragged.limit(1).isEmpty():
            pieces = pieces.unionByName(split_pieces(ragged))
    return parsed_pieces(pieces, schema, corrupt)
