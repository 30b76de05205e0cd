"""Bulk landing ingest against one read-and-append per file, on the same landing tree.

The tree has one JSON file per day, sensor and parameter, written from the `events` table in
$BENCH_SF_DIR. The bulk ingest loads the whole tree; the loop handles $BENCH_LOOP_FILES files
of it, as many jobs as files, and is reported per file. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hazeline.gallery.adapters import dated_records, events  # noqa: E402
from hazeline.operators.projections import canonical  # noqa: E402
from hazeline.plans.cycle import ingest  # noqa: E402
from hazeline.plans.warehouse import read_warehouse  # noqa: E402
from hazeline.scratch import new_dir  # noqa: E402
from hazeline.session import build_session  # noqa: E402
from hazeline.sources.landing import file_inventory, tree_folders, write_landing  # noqa: E402


def jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.001").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    loop_files = int(os.environ.get("BENCH_LOOP_FILES", "100"))
    spark = build_session(
        "hazeline-bench-landing",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    tree = new_dir(spark, "tree")
    write_landing(dated_records(events(spark, sf_dir)), tree, "day")
    files = [row.path for row in file_inventory(spark, tree_folders(tree), "*.json").collect()]

    # Untimed, for the JVM's start.
    ingest(spark, tree_folders(tree), new_dir(spark, "warehouse"), array_files=False)

    warehouse = new_dir(spark, "warehouse")
    before, started = jobs(spark), time.perf_counter()
    ingest(spark, tree_folders(tree), warehouse, array_files=False)
    bulk_seconds, bulk_jobs = time.perf_counter() - started, jobs(spark) - before

    target = new_dir(spark, "loop")
    before, started = jobs(spark), time.perf_counter()
    for path in files[:loop_files]:
        rows = canonical(spark.read.json(path)).dropDuplicates()
        rows.write.mode("append").orc(target)
    loop_seconds, loop_jobs = time.perf_counter() - started, jobs(spark) - before

    line = {
        "metric": "bulk_ingest_seconds",
        "value": round(bulk_seconds, 3),
        "unit": "sec",
        "files": len(files),
        "rows": read_warehouse(spark, warehouse).count(),
        "bulk_jobs": bulk_jobs,
        "loop_files": min(loop_files, len(files)),
        "loop_seconds": round(loop_seconds, 3),
        "loop_jobs": loop_jobs,
        "loop_seconds_per_file": round(loop_seconds / min(loop_files, len(files)), 4),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
