"""The package on the executors: `--py-files`, done by the operators that run Python there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import hazeline

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application; executors fetch the archive from the driver."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(hazeline.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="hazeline-")) / "hazeline-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
