"""Sensor registry: which parameters a location reports, and how it is classed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.operators.filters import sensor_class
from hazeline.schemas import REGISTRY

# The stations run by government agencies.
REFERENCE_IDS = (8039, 8118, 8172, 8557, 8558)

# Parameter and unit, as the stations report them.
PARAMETER_UNITS = {
    "humidity": "%",
    "pm1": "µg/m³",
    "pm10": "µg/m³",
    "pm25": "µg/m³",
    "pressure": "mb",
    "temperature": "f",
    "um003": "particles/cm³",
    "um005": "particles/cm³",
    "um010": "particles/cm³",
    "um025": "particles/cm³",
    "um050": "particles/cm³",
    "um100": "particles/cm³",
}
_ALL = tuple(PARAMETER_UNITS)
_NO_WEATHER = tuple(name for name in _ALL if name not in ("humidity", "pressure", "temperature"))

# Location, label and reported parameters.
SENSORS = {
    8039: ("Mumbai", ("pm25",)),
    8118: ("New Delhi", ("pm25",)),
    8172: ("Kolkata", ("pm25",)),
    8557: ("Hyderabad", ("pm25",)),
    8558: ("Chennai", ("pm25",)),
    62543: ("Greater Kailash 2", _ALL),
    63704: ("Madikeri, Karnataka", _ALL),
    64931: ("Bhatinda", _NO_WEATHER),
    66673: ("Hisar", _ALL),
    67569: ("Tarkeshwar, West Bengal", _ALL),
    220704: ("Kharagpur, West Bengal", _ALL),
    229138: ("Srinivaspur, Karnataka", _ALL),
    288233: ("Kalol, Gandhi Nagar", _ALL),
    362098: ("Greater Noida", _ALL),
    1667903: ("15 Oak Drive Outdoor", _ALL),
}


def default_registry(spark: SparkSession) -> DataFrame:
    """The built-in network, one row per location and parameter."""
    rows = [
        (location, label, parameter, "reference" if location in REFERENCE_IDS else "community")
        for location, (label, parameters) in SENSORS.items()
        for parameter in parameters
    ]
    return spark.createDataFrame(rows, REGISTRY)


def parameter_units(spark: SparkSession) -> DataFrame:
    schema = T.StructType(
        [T.StructField("parameter", T.StringType()), T.StructField("unit", T.StringType())]
    )
    return spark.createDataFrame(list(PARAMETER_UNITS.items()), schema)


def registry_from(measurements: DataFrame, reference_ids=REFERENCE_IDS) -> DataFrame:
    """The registry a body of measurements implies: every pair that ever reported."""
    pairs = measurements.select("locationId", "parameter").distinct()
    return pairs.withColumn("sensor_class", sensor_class(F.col("locationId"), reference_ids))


def one_row_each(registry: DataFrame) -> DataFrame:
    """One row for each sensor and parameter: the least of those listed, column by column."""
    others = [c for c in registry.columns if c not in ("locationId", "parameter")]
    if not others:
        return registry.select("locationId", "parameter").distinct().select(*registry.columns)
    least = registry.groupBy("locationId", "parameter").agg(*[F.min(c).alias(c) for c in others])
    return least.select(*registry.columns)


def enrich(measurements: DataFrame, registry: DataFrame) -> DataFrame:
    """Measurements with their registry row; sensors the registry lacks stay, with NULLs.

    No broadcast hint: Spark broadcasts the registry while its size is under the threshold
    and falls back to a shuffle join, with skewed sensors split, when it is not. Keep the
    registry as a stored table so that its size is known when the join is planned. A pair that
    is listed more than once counts once.
    """
    return measurements.join(one_row_each(registry), ["locationId", "parameter"], "left")


def duplicates(registry: DataFrame) -> DataFrame:
    """Pairs listed more than once."""
    return (
        registry.groupBy("locationId", "parameter")
        .agg(F.count(F.lit(1)).alias("listed"))
        .filter(F.col("listed") > 1)
    )


def unknown_parameters(registry: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Listed parameters that the catalogue does not have, such as names run together."""
    return registry.join(catalogue.select("parameter"), "parameter", "left_anti")
