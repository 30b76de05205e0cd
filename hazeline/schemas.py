"""Explicit schemas; no production path infers one."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
# Landing order of a row: a later file has a greater number.
ARRIVED = "arrived"

# One measurement as it lands in JSON.
RECORD = T.StructType(
    [
        T.StructField("locationId", T.LongType()),
        T.StructField("location", T.StringType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField(
            "date",
            T.StructType(
                [
                    T.StructField("utc", T.StringType()),
                    T.StructField("local", T.StringType()),
                ]
            ),
        ),
        T.StructField("unit", T.StringType()),
        T.StructField(
            "coordinates",
            T.StructType(
                [
                    T.StructField("latitude", T.DoubleType()),
                    T.StructField("longitude", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("isMobile", T.BooleanType()),
        T.StructField("isAnalysis", T.BooleanType()),
        T.StructField("entity", T.StringType()),
        T.StructField("sensorType", T.StringType()),
    ]
)

# The fields a load keeps, as text: a field of the wrong type then spoils its own row, not
# the whole file. `date` is the text of its object.
LANDED = T.StructType(
    [
        T.StructField("locationId", T.StringType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

RECORD_OR_CORRUPT = T.StructType([*RECORD.fields, T.StructField(CORRUPT, T.StringType())])

# The warehouse: the four kept columns, and the row's own UTC day as partition.
KEY = ["locationId", "parameter", "utc"]
MEASUREMENT = T.StructType(
    [
        T.StructField("locationId", T.LongType()),
        T.StructField("utc", T.TimestampType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
DAY = "utc_date"
WAREHOUSE = T.StructType([*MEASUREMENT.fields, T.StructField(DAY, T.DateType())])

# Landing rows after parsing, good and bad side by side; `outcome` is the partition.
STAGED = T.StructType(
    [
        *WAREHOUSE.fields,
        T.StructField("unit", T.StringType()),
        T.StructField(ARRIVED, T.LongType()),
        T.StructField("raw", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("outcome", T.StringType()),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("loaded_from", T.DateType()),
        T.StructField("load", T.StringType()),
    ]
)

# The older five-column shape, still used by the CSV extracts and the SQL tables.
READING = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("local_time", T.TimestampType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("locationId", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("sensor_class", T.StringType()),
    ]
)


def ddl_columns(schema: T.StructType) -> str:
    """Column list of a CREATE TABLE."""
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
