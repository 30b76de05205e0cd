"""Session settings the pipeline is tuned for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution does the sizing: start from many shuffle partitions and let
# it merge small ones, split skewed ones and switch to broadcast joins by measured size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

# Where no master is given the session runs on a cluster; adaptive execution merges what a
# small run does not need.
CLUSTER = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192"}


def build_session(app: str = "hazeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the pipeline's defaults; on a cluster `master` comes from spark-submit.

    Dotted settings go in through `**{"spark.x.y": "z"}`.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    place = CLUSTER if master is None else {}
    for key, value in {**DEFAULTS, **place, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Hold runtime settings for the length of one eager action, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """While files are listed: a folder's subfolders are dealt to a few tasks a core, where Spark
    starts a task for each of them."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    with settings(spark, **{"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}):
        yield
