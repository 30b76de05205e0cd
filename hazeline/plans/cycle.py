"""The daily run: landing files to warehouse, then the extract."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from hazeline.operators.registry import one_row_each
from hazeline.plans import ledger as books
from hazeline.plans.fetch import daily_plan, fetch_start, with_requests
from hazeline.plans.publish import latest_extract, publish_copies, publish_touched
from hazeline.plans.warehouse import append_new, read_warehouse, resume_date, touched, upsert
from hazeline.schemas import QUARANTINE
from hazeline.scratch import discard, exists, new_dir
from hazeline.sources.files import read_orc
from hazeline.sources.landing import (
    bad_rows,
    day_folders,
    landed_records,
    ordered_rows,
    read_staged,
    stage,
)


@dataclass(frozen=True)
class Staged:
    """The parsed rows of one ingest, good and bad, and where they lie."""

    rows: DataFrame
    path: str


def ingest(
    spark: SparkSession,
    landing: str | Sequence[str],
    warehouse: str,
    *,
    array_files: bool | None = None,
    keep_first: bool = False,
) -> Staged:
    """Load a landing tree, or the files given, in one pass; the staged rows are left to the caller.

    `keep_first` keeps the stored value of a known key; the default takes the new one. Files of
    arrays and of lines may be mixed; `array_files` says that all are of one kind.
    """
    path = new_dir(spark, "staged")
    stage(landed_records(spark, landing, array_files=array_files), path)
    rows = read_staged(spark, path)
    load = append_new if keep_first else upsert
    load(ordered_rows(rows), warehouse)
    return Staged(rows, path)


def owed(
    spark: SparkSession,
    registry: DataFrame,
    warehouse: str,
    *,
    as_of: date,
    bootstrap_start: date,
    lookback_days: int = 0,
) -> DataFrame:
    """The fetches due before `as_of`, with request text and landing path; a pair that the
    registry lists more than once is fetched once."""
    start = fetch_start(
        resume_date(spark, warehouse, as_of), bootstrap_start, lookback_days
    )
    return with_requests(daily_plan(one_row_each(registry), start, as_of))


def build_latest(
    spark: SparkSession, warehouse: str, targets: list[str], *, as_of: date, years: int = 2
) -> None:
    """Publish the rolling extract to every target."""
    publish_copies(latest_extract(read_warehouse(spark, warehouse), as_of, years), targets)


def _load(
    spark: SparkSession,
    landing: str | Sequence[str],
    warehouse: str,
    quarantine: str,
    array_files: bool | None,
    publish: Callable[[DataFrame | None], None] | None = None,
) -> None:
    """One load, and its bad rows to a folder that a repeated load replaces; `publish` gets the
    stored rows of the days it touched."""
    staged = ingest(spark, landing, warehouse, array_files=array_files)
    bad_rows(staged.rows).write.mode("overwrite").orc(quarantine)
    if publish is not None:
        publish(touched(read_warehouse(spark, warehouse), ordered_rows(staged.rows)))
    discard(spark, staged.path)


def load_new_files(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    quarantine: str,
    ledger: str,
    *,
    start: date | None,
    end: date,
    array_files: bool | None = None,
    load_bytes: int = books.LOAD_BYTES,
    load_files: int = books.LOAD_FILES,
    publish: Callable[[DataFrame | None], None] | None = None,
) -> int:
    """Load every landing file that the ledger doesn't hold; returns the number of loads.

    `publish` gets the stored rows of the days that a load touched, before its files are entered:
    a run that dies in between loads and publishes them again.

    Files go in landing order, but a file that comes late counts as the newest fetch: its values
    replace stored ones. `start` limits how far back folders are listed; None lists them all.
    """
    new = books.unloaded(books.landing_files(spark, landing, start, end), books.read_ledger(spark, ledger))
    done = 0
    for load in books.loads(new, load_bytes=load_bytes, load_files=load_files):
        folder = f"{quarantine}/loaded_from={load.first_day or end}/load={load.id}"
        _load(spark, load.paths, warehouse, folder, array_files, publish)
        books.enter(spark, ledger, load)
        done += 1
    return done


def run_daily(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    quarantine: str,
    targets: list[str],
    *,
    as_of: date,
    bootstrap_start: date,
    lookback_days: int = 0,
    days_per_load: int = 31,
    array_files: bool | None = None,
    ledger: str | None = None,
    by_day: bool = False,
) -> int:
    """Load the landing folders up to `as_of`, then publish; returns the number of loads.

    With a `ledger`, every file not loaded yet is loaded, however old its folder; `lookback_days`
    then limits how many days of folders are listed, and 0 lists them from `bootstrap_start`.

    Without, the days from the high-water mark on are loaded, a month at a time: a load shuffles
    that month only, and a run that is cut off goes on from the newest loaded day; files that come
    late to older folders are left. Bad rows go to a quarantine folder per load, which a repeated
    load replaces; a file set aside by two loads is listed by both. Arrays and lines may be mixed;
    `array_files` says that all files are of one kind. A landing root that is missing raises; the
    extract is published even when nothing is owed.

    `by_day`, with a ledger, publishes day folders: a run writes the days it loaded rows of and
    removes those that have left the range, instead of writing the whole extract.
    """
    if by_day and ledger is None:
        raise ValueError("publishing by day needs a ledger: it tells what was loaded and published")

    def publish(rows: DataFrame | None) -> None:
        stored = read_warehouse(spark, warehouse)
        for target in targets:
            publish_touched(stored, rows, target, as_of)

    if not exists(spark, landing):
        raise FileNotFoundError(landing)
    count = 0
    if ledger is not None:
        start = as_of - timedelta(days=lookback_days) if lookback_days else bootstrap_start
        count = load_new_files(
            spark, landing, warehouse, quarantine, ledger, start=start, end=as_of, array_files=array_files,
            publish=publish if by_day else None,
        )
    else:
        first = fetch_start(
            resume_date(spark, warehouse, as_of), bootstrap_start, lookback_days
        )
        while first < as_of:
            last = min(first + timedelta(days=days_per_load), as_of)
            folder = f"{quarantine}/loaded_from={first}/load=days"
            _load(spark, day_folders(landing, first, last), warehouse, folder, array_files)
            first, count = last, count + 1
    if by_day:
        publish(None)
    else:
        build_latest(spark, warehouse, targets, as_of=as_of)
    return count


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Every row set aside, with the first day of its load."""
    return read_orc(spark, path, QUARANTINE)
