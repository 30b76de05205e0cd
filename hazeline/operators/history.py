"""A registry with a history: measurements described as of their own time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SENSOR = ["locationId", "parameter"]
VALID_FROM = "valid_from"


def enrich_as_of(
    measurements: DataFrame, history: DataFrame, time: str = "utc", cell_hours: int = 24
) -> DataFrame:
    """Measurements with the registry row that held at their time.

    `history` has `valid_from` (of the type of `time`) next to the sensor's columns; a row holds
    from that instant until the sensor's next one. Measurements before the first row, of unknown
    sensors, or with a NULL key or time stay, with NULLs. Of rows that start together the greatest
    counts, columns compared in their order. Repeated measurements stay repeated.

    No join. Rows of both sides meet by sensor and cell of time, so a sensor that fills a third of
    the data is spread over its cells. What held when a cell began comes as one row: it is found
    among the cells, of which a sensor has one each `cell_hours` at most, however many rows it has.
    """
    described = [name for name in history.columns if name not in (*SENSOR, VALID_FROM)]
    taken = {name.lower() for name in measurements.columns}
    clashes = [name for name in described if name.lower() in taken]
    if clashes:
        raise ValueError(f"columns of both sides: {clashes}")

    micros = F.unix_micros(F.col(time).cast("timestamp"))
    cell_of = F.floor(F.col("at") / (cell_hours * 3_600_000_000)).alias("cell")
    usable = F.col(SENSOR[0]).isNotNull() & F.col(SENSOR[1]).isNotNull() & F.col(time).isNotNull()

    starts = F.col(VALID_FROM).cast("timestamp")
    versions = (
        history.filter(F.col(SENSOR[0]).isNotNull() & F.col(SENSOR[1]).isNotNull() & starts.isNotNull())
        .groupBy(*SENSOR, F.unix_micros(starts).alias("at"))
        .agg(F.max(F.struct(*described)).alias("version"))
        .select(*SENSOR, "at", cell_of, "version")
    )
    version_type = versions.schema["version"].dataType
    row_type = measurements.schema
    no_version, no_row = F.lit(None).cast(version_type), F.lit(None).cast(row_type)

    readings = measurements.filter(usable).select(
        *SENSOR, micros.alias("at"), F.struct(*measurements.columns).alias("row")
    ).select(*SENSOR, "at", cell_of, "row")

    held = F.struct("at", "version")
    cells = (
        versions.select(*SENSOR, "cell", held.alias("held"))
        .unionByName(
            measurements.filter(usable)
            .select(*SENSOR, micros.alias("at"))
            .select(*SENSOR, cell_of, F.lit(None).cast(versions.select(held).schema[0].dataType).alias("held"))
        )
        .groupBy(*SENSOR, "cell")
        .agg(F.max("held").alias("held"))
    )
    earlier = Window.partitionBy(*SENSOR).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = cells.select(*SENSOR, "cell", F.last("held", ignorenulls=True).over(earlier).alias("held"))

    def side(rows: DataFrame, number: int, version: Column, row: Column) -> DataFrame:
        return rows.select(
            *SENSOR, "cell", "at", F.lit(number).alias("side"), version.alias("version"), row.alias("row")
        )

    before = carried.filter(F.col("held").isNotNull()).select(*SENSOR, "cell", "held.at", "held.version")
    together = (
        side(before, 0, F.col("version"), no_row)
        .unionByName(side(versions, 0, F.col("version"), no_row))
        .unionByName(side(readings, 1, no_version, F.col("row")))
    )
    so_far = (
        Window.partitionBy(*SENSOR, "cell").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    )
    known = together.select("side", "row", F.last("version", ignorenulls=True).over(so_far).alias("version"))
    enriched = known.filter(F.col("side") == 1).select("row.*", *[F.col("version")[name].alias(name) for name in described])
    rest = measurements.filter(~usable).select(
        "*", *[F.lit(None).cast(history.schema[name].dataType).alias(name) for name in described]
    )
    return enriched.unionByName(rest)
