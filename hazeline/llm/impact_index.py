"""Exact top-k by inner product over an impact-ordered index, score at a time.

The rows are indexed in shards of some thousand. In a shard every dimension has posting
segments: the rows whose component falls in one step of a uniform grid. A step's impact is how
far it lies from zero, so the index stores a shard's segments by impact, all dimensions
together, next to the vectors themselves.

A query takes the segments of a shard by falling impact. A posting adds the middle of its step
times the query's component to the row's score, and the query's component to what the row has
seen. What a row can still gain or lose is then known: half a step for each dimension seen, the
impact reached for each that is not. Once few rows have an upper bound that reaches the k-th
greatest lower bound, nothing else can be among the k; those rows are scored exactly on their
vectors. There is no other way to stop than this proof or the end of the segments.

Queries come to the shards row by row: each is sent once to every slot, a slot holds about one
shard, and a task reads the shards of a slot first and then lets the queries pass. Memory is a
slot's shards, whatever the number of queries, and no side is broadcast. A shard passes on k
rows a query; the best k of these are the result.

Defined results: null vectors, and those with a null or non-finite component, take no part, nor
do rows without an id. Vectors of unequal length are compared over the dimensions both have. A
query's own id is never among its results. Repeated rows are candidates one by one; of
rows that repeat a query's id the least vector asks. An empty table gives no rows. Scores and
components have to fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeline.llm.chunked import expand
from hazeline.llm.memory import released
from hazeline.llm.shipping import ship
from hazeline.llm.vectors import SCALE, whole_vectors
from hazeline.scratch import new_dir

SHARD_ROWS = 8192
#: Steps in a standard deviation of the components: the grid of impacts.
STEPS = 4
#: A search of a shard may end when one row in so many is still possible.
FEW = 16

INDEX = "shard long, impact int, step long, segments binary, postings binary"
_VECTORS = -1  # in place of an impact: the shard's vectors


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All components of a column of lists, and the lists' sizes."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes.astype(np.int64)


def _ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and dimension of every component."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def shard_rows(shard: int, keys: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> list[tuple]:
    """The index of one shard: its vectors, and a row for each impact."""
    step = max(1, int(np.sqrt(np.mean(values.astype(float) ** 2)) / STEPS)) if len(values) else 1
    out = [(shard, _VECTORS, step, np.concatenate([keys, sizes]).tobytes(), values.tobytes())]
    row, dim = _ragged(sizes)
    level = values // step
    impact = np.where(level < 0, -level - 1, level)
    # A segment is told by its dimension, and ~dimension for the steps below zero.
    side = np.where(level < 0, ~dim, dim)
    order = np.lexsort((row, side, impact))
    row, side, impact = row[order], side[order], impact[order]
    fresh = np.flatnonzero(np.append(True, (np.diff(impact) != 0) | (np.diff(side) != 0))) if len(row) else np.zeros(0, np.int64)
    counts = np.diff(np.append(fresh, len(row)))
    for value in np.unique(impact).tolist():
        segments = np.flatnonzero(impact[fresh] == value)
        first, last = fresh[segments[0]], fresh[segments[-1]] + counts[segments[-1]]
        told = np.concatenate([side[fresh[segments]], counts[segments]])
        out.append((shard, value, step, told.tobytes(), row[first:last].astype("<u4").tobytes()))
    return out


def build(rows: DataFrame, path: str, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE, shard: int = SHARD_ROWS) -> None:
    """Write the index of all rows as Parquet."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = 0

        def closed() -> pa.RecordBatch:
            keys, values, sizes = (np.concatenate(c) for c in zip(*held))
            columns = zip(*shard_rows(number, keys, values, sizes))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["shard", "impact", "step", "segments", "postings"],
            )

        for batch in batches:
            for start in range(0, batch.num_rows, shard):
                part = batch.slice(start, shard)
                values, sizes = _lists(part.column("x"))
                if count + part.num_rows > shard:
                    yield closed()
                    held, count, number = [], 0, number + 1
                held.append((part.column("key").to_numpy().astype(np.int64), values, sizes))
                count += part.num_rows
        if held:
            yield closed()

    known = whole_vectors(rows.filter(F.col(key).isNotNull()), vector, key, scale)
    known.mapInArrow(released(run), INDEX).write.parquet(path)


class Shard:
    """One shard in a task's memory."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []  # impact, sides, counts, rows

    def add(self, impact: int, step: int, segments: bytes, postings: bytes) -> None:
        if impact == _VECTORS:
            self.step = step
            self.keys, self.sizes = np.frombuffer(segments, np.int64).reshape(2, -1)
            self.values = np.frombuffer(postings, np.int64)
            self.starts = np.cumsum(self.sizes) - self.sizes
        else:
            sides, counts = np.frombuffer(segments, np.int64).reshape(2, -1)
            self.levels.append((impact, sides, counts, np.frombuffer(postings, "<u4").astype(np.int64)))

    def ready(self) -> None:
        self.levels.sort(key=lambda level: -level[0])

    def exact(self, members: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Scores of some rows on their vectors."""
        sizes = self.sizes[members]
        _, dim = _ragged(sizes)
        terms = expand(self.values, self.starts[members], sizes) * np.where(dim < len(q), q[np.minimum(dim, len(q) - 1)], 0)
        sums = np.concatenate([[0], np.cumsum(terms)])
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]

    def possible(self, own: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """The rows that can be among the k: by segments, until the proof is there."""
        rows, step = len(self.keys), self.step
        others = np.flatnonzero(~own)
        most = max(int(self.sizes.max(initial=0)), 1)
        weight = np.zeros(most, np.int64)
        weight[: len(q)] = q[:most]
        size = np.abs(weight)
        total = int(size.sum())
        top = (self.levels[0][0] + 1) * step if self.levels else 0
        # Score (doubled, so that middles are whole) and weight seen share one sum.
        low_bits = total.bit_length()
        if len(others) <= k or 2 * top * total << low_bits >= 1 << 52:
            return others
        both = np.zeros(rows)
        for at, (impact, sides, counts, postings) in enumerate(self.levels):
            dims = np.where(sides < 0, ~sides, sides)
            level = np.where(sides < 0, -impact - 1, impact)
            add = ((2 * level * step + step - 1) * weight[dims] << low_bits) + size[dims]
            both += np.bincount(postings, np.repeat(add.astype(float), counts), rows)
            sums = both.astype(np.int64)
            seen = sums & ((1 << low_bits) - 1)
            score = sums >> low_bits
            unseen = 2 * impact * step  # of the impacts that follow, twice the greatest component
            slack = (step - 1) * seen + unseen * (total - seen)
            low = (score - slack)[others]
            bar = np.partition(low, len(low) - k)[len(low) - k]
            left = others[(score + slack)[others] >= bar]
            if len(left) <= max(rows // FEW, k) or at == len(self.levels) - 1:
                return left
        return others

    def best(self, key: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and scores of the k greatest scores, ties to the smaller key."""
        members = self.possible(self.keys == key, q, k)
        if not len(members):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        score = self.exact(members, q) if len(q) else np.zeros(len(members), np.int64)
        order = np.lexsort((self.keys[members], -score))[:k]
        return self.keys[members][order], score[order]


def _answered(k: int):
    """Shards of a slot come first and are held; queries pass and leave their k best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, shards = None, {}
        for batch in batches:
            found: list[tuple[int, np.ndarray, np.ndarray]] = []
            columns = [batch.column(name) for name in ("slot", "shard", "impact", "step", "segments", "postings", "key", "x")]
            for i in range(batch.num_rows):
                at = columns[0][i].as_py()
                if at != slot:
                    slot, shards, asked = at, {}, False
                if columns[1][i].is_valid:
                    number, impact, step, segments, postings = (c[i].as_py() for c in columns[1:6])
                    shards.setdefault(number, Shard()).add(impact, step, segments, postings)
                    continue
                if not asked:
                    asked = True
                    for shard in shards.values():
                        shard.ready()
                key = columns[6][i].as_py()
                q = columns[7][i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                found += [(key, *shard.best(key, q, k)) for shard in shards.values()]
            if found:
                sizes = [len(keys) for _, keys, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array([f[0] for f in found], np.int64), sizes)),
                        pa.array(np.concatenate([f[1] for f in found])),
                        pa.array(np.concatenate([f[2] for f in found])),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 5, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k greatest scores in the index."""
    ship(spark)
    index = spark.read.parquet(path)
    slots = max(1, index.filter(F.col("impact") == _VECTORS).count())
    nothing = {"shard": "bigint", "impact": "int", "step": "bigint", "segments": "binary", "postings": "binary"}
    asked = (
        whole_vectors(queries.filter(F.col(key).isNotNull()), vector, key, scale)
        .groupBy("key").agg(F.min("x").alias("x"))
        .select(
            F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()],
            "key", "x",
        )
    )
    shards = index.select(
        F.pmod(F.xxhash64("shard"), F.lit(slots)).cast("int").alias("slot"),
        *nothing,
        F.lit(None).cast("bigint").alias("key"),
        F.lit(None).cast("array<bigint>").alias("x"),
    )
    found = (
        shards.unionByName(asked)
        .repartition(slots, "slot")
        .sortWithinPartitions("slot", F.col("shard").asc_nulls_last())
        .mapInArrow(released(_answered(k)), "query_id long, vec_id long, score long")
    )
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """Index the rows in the shared folder, then search them."""
    path = new_dir(rows.sparkSession, "impact-index")
    build(rows, path, vector, key, scale)
    return search(rows.sparkSession, path, queries, k, vector, key, scale)
