"""Connected components of links: forests worked out inside tasks, joined up by pointer jumps.

A link hangs its greater node on the lesser. Tasks turn the links they hold into forests, in which
each node hangs on the least one it reaches: before the shuffle by the greater node, so that a task
sends a node once for each lot of links, and behind it. Then nodes hang on the parent of their
parent, until each has one parent and no parent has one itself; the number of rounds grows with
the logarithm of the links. Links of a node with many others lie with the others, in many tasks.
Only ids are shuffled, and every round is written to the shared folder, so nothing is gathered and
a lost executor repeats one round at most. A round is two plans, whatever the links: the driver
keeps what each plan leaves behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.memory import released
from hazeline.llm.shipping import ship
from hazeline.scratch import discard, new_dir

HELD = 1_000_000  # links that a task makes into a forest at a time


def _stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """u, v: every linked node but the least of its component, and that least node."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    one, two = at[: len(u)], at[len(u) :]
    least = np.arange(len(ids))
    while len(one):
        low, high = np.minimum(least[one], least[two]), np.maximum(least[one], least[two])
        apart = low < high
        one, two = one[apart], two[apart]
        np.minimum.at(least, high[apart], low[apart])
        while not np.array_equal(further := least[least], least):
            least = further
    hung = np.flatnonzero(least < np.arange(len(ids)))
    return ids[hung], ids[least[hung]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of lots of links. The last link's node is taken along to the next lot, so that no
    node hangs on two where links come ordered by u."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def made(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    for batch in batches:
        held.append((batch.column("u").to_numpy(), batch.column("v").to_numpy()))
        if sum(len(u) for u, _ in held) >= HELD:
            last = held[-1][0][-1:]
            u, v = forest(*(np.concatenate(c) for c in zip(*held)))
            along = np.isin(u, last)
            yield made(u[~along], v[~along])
            held = [(u[along], v[along])]
    if held:
        yield made(*forest(*(np.concatenate(c) for c in zip(*held))))


def _hung(links: DataFrame) -> DataFrame:
    """Links as forests, all of one greater node in one task."""
    parts = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "u long, v long"
    met = links.mapInArrow(released(_forests), schema).repartition(parts, "u").sortWithinPartitions("u")
    return met.mapInArrow(released(_forests), schema)


def components(links: DataFrame) -> DataFrame:
    """u, v: every linked node but the least of its component, and that least node."""
    spark = links.sparkSession
    ship(spark)
    edges, path = _stored(
        _hung(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")), "links"
    )
    while True:
        ends = edges.select(F.col("u").alias("id"), F.col("v").alias("up"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
            edges.select("v", F.lit(None).cast("bigint"), F.lit(0), F.lit(1))
        )
        nodes = ends.groupBy("id").agg(F.min("up").alias("up"), F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
        # Nodes that hang on two, and parents that hang on another.
        loose, loose_path = _stored(nodes.filter("hangs > 1 OR hangs = 1 AND holds = 1").select("id", "up"), "loose")
        if loose.isEmpty():
            discard(spark, loose_path)
            return edges
        further = edges.join(loose, edges["v"] == loose["id"], "left").select("u", F.coalesce("up", "v").alias("v"))
        after, new_path = _stored(_hung(further), "links")
        for old in (path, loose_path):
            discard(spark, old)
        edges, path = after, new_path
