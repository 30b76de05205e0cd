"""Landing paths and request text, built and taken apart with string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: yr/mnt/dy/locationId/parameter, as `parameter.json`, as a folder of files,
# or with `name=` before each level as a partitioned write names them.
_TREE = (
    r"(?:yr=)?(\d{4})/(?:mnt=)?(\d{1,2})/(?:dy=)?(\d{1,2})"
    r"/(?:loc=)?(\d+)/(?:par=)?([^/]+?)(?:\.json|/[^/]*)$"
)
_DAY = r"/(?:yr=)?(\d{4})/(?:mnt=)?(\d{1,2})/(?:dy=)?(\d{1,2})/"
TREE_KEYS = ["yr", "mnt", "dy", "loc", "par"]


def tree_keys(path: Column) -> dict[str, Column]:
    """The five keys of a landing path; NULL where the path has another shape."""
    return {
        name: F.nullif(F.regexp_extract(path, _TREE, position), F.lit(""))
        for position, name in enumerate(TREE_KEYS, start=1)
    }


def landing_day(path: Column) -> Column:
    """Day of the folders yr/mnt/dy, plain or `name=value`; NULL where there are none."""
    found = [F.regexp_extract(path, _DAY, position) for position in (1, 2, 3)]
    return F.try_to_date(F.concat_ws("-", *found), "y-M-d")


def level_key(path: Column, name: str) -> Column:
    """One `name=value` level of a partitioned path."""
    return F.nullif(F.regexp_extract(path, f"/{name}=([^/]+)/", 1), F.lit(""))


def day_parts(day: Column) -> dict[str, Column]:
    """Zero-padded year, month and day folders, cut from the ISO date."""
    iso = day.cast("string")
    return {
        "yr": F.substring(iso, 1, 4),
        "mnt": F.substring(iso, 6, 2),
        "dy": F.substring(iso, 9, 2),
    }


def landing_path(day: Column, location: Column, parameter: Column) -> Column:
    parts = day_parts(day)
    folder = F.concat_ws("/", *parts.values(), location.cast("string"))
    return F.concat(folder, F.lit("/"), parameter, F.lit(".json"))


def request_text(location: Column, parameter: Column, from_local: Column, to_local: Column) -> Column:
    """Query string of one fetch; the bounds are Indian wall-clock times."""
    return F.concat(
        F.lit("location_id="),
        location.cast("string"),
        F.lit("&parameter="),
        parameter,
        F.lit("&date_from="),
        _india_bound(from_local),
        F.lit("&date_to="),
        _india_bound(to_local),
    )


def _india_bound(wall: Column) -> Column:
    # Cut from the cast rather than formatted: plans have many rows, and a cast is cheap.
    text = wall.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("+05:30"))
