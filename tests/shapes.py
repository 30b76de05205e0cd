"""Hand-made measurements."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

from hazeline.plans.warehouse import with_day
from hazeline.schemas import MEASUREMENT

UTC = timezone.utc


def record(location=8039, parameter="pm25", value=1.5, utc="2024-02-03T06:30:00+00:00", **other):
    local = ""
    try:
        moment = datetime.fromisoformat(utc).astimezone(timezone(timedelta(hours=5, minutes=30)))
        local = moment.isoformat()
    except ValueError:
        pass
    return {
        "locationId": location,
        "location": "Mumbai",
        "parameter": parameter,
        "value": value,
        "date": {"utc": utc, "local": local},
        "unit": "µg/m³",
        "coordinates": {"latitude": 19.07, "longitude": 72.88},
        "country": "IN",
        "city": None,
        "isMobile": False,
        "isAnalysis": None,
        "entity": "Governmental",
        "sensorType": "reference grade",
        **other,
    }


def write_file(path: Path, content) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content, indent=2)
    path.write_text(text, encoding="utf-8")


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def rows(spark, *values):
    """(location, utc text, parameter, value) tuples as warehouse rows."""
    listed = [(location, at(utc), parameter, value) for location, utc, parameter, value in values]
    return with_day(spark.createDataFrame(listed, MEASUREMENT))


def plain(df):
    """Warehouse rows as a sorted list of tuples, times as UTC text."""
    from pyspark.sql import functions as F

    text = df.select(
        "locationId", F.date_format("utc", "yyyy-MM-dd'T'HH:mm:ss").alias("utc"), "parameter", "value"
    )
    return sorted((tuple(row) for row in text.collect()), key=str)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
