"""Columnar and delimited files: explicit schemas in, lossless timestamps out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.scratch import discard, new_dir
from hazeline.sources.landing import read_or_empty

# The CSV default keeps milliseconds only; these keep microseconds. Doubled quotes, as
# other CSV tools write them.
CSV_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "quote": '"',
    "escape": '"',
}


def _csv(target: DataFrameReader | DataFrameWriter, header: bool, separator: str):
    return target.options(**CSV_OPTIONS).option("header", header).option("sep", separator)


def read_orc(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_or_empty(lambda: spark.read.schema(schema).orc(path), spark, schema)


def write_orc(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).orc(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    header: bool = False,
    separator: str = ",",
) -> DataFrame:
    return _csv(spark.read.schema(schema), header, separator).csv(path)


def read_csv_text(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """A CSV with a header, every column as text."""
    return _csv(spark.read, True, separator).option("inferSchema", False).csv(path)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    header: bool = True,
    mode: str = "overwrite",
    separator: str = ",",
) -> None:
    _csv(df.write.mode(mode), header, separator).csv(path)


def rewrite_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    change: Callable[[DataFrame], DataFrame],
    *,
    header: bool = False,
) -> None:
    """Replace a CSV folder by a change of its own rows.

    Overwriting a folder the same plan reads would empty it half-way, so the new rows are
    staged first and the folder is overwritten from the staged copy. The copy stays behind
    if the overwrite fails.
    """
    staged = new_dir(spark, "rewrite")
    changed = change(read_csv(spark, path, schema, header=header))
    changed.write.orc(staged)
    write_csv(spark.read.schema(changed.schema).orc(staged), path, header=header)
    discard(spark, staged)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    separator: str = ",",
    item_separator: str = "|",
) -> DataFrame:
    """Delimited text where an ARRAY<STRING> column holds items with their own separator."""
    flat = T.StructType(
        [
            T.StructField(
                field.name,
                T.StringType() if isinstance(field.dataType, T.ArrayType) else field.dataType,
            )
            for field in schema
        ]
    )
    rows = read_csv(spark, path, flat, separator=separator)
    literal_separator = "\\Q" + item_separator + "\\E"
    return rows.select(
        *[
            F.split(field.name, literal_separator).alias(field.name)
            if isinstance(field.dataType, T.ArrayType)
            else F.col(field.name)
            for field in schema
        ]
    )


def write_delimited(
    df: DataFrame, path: str, *, separator: str = ",", item_separator: str = "|"
) -> None:
    flat = df.select(
        *[
            F.array_join(field.name, item_separator).alias(field.name)
            if isinstance(field.dataType, T.ArrayType)
            else F.col(field.name)
            for field in df.schema
        ]
    )
    write_csv(flat, path, header=False, separator=separator)
