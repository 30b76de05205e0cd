"""Whitening of embeddings by exact integer cross-products.

Components become whole numbers, and every distinct vector counts once. In blocks of some
thousand vectors each dimension is shifted to start at zero and its bits are scattered: one
plane for each bit, the rows side by side in 64-bit words. The number of rows that have both of
two bits is the popcount of the AND of two planes; weighted by the bits' values these counts
add up to the exact cross-products of the shifted dimensions, and the shifts are taken back in
whole numbers. The blocks' sums are added by Spark as decimals.

n times the cross-products less the products of the sums is the covariance times n squared,
centred and exact; only then it becomes doubles, for an eigendecomposition whose size is the
number of dimensions. Rows are projected on the leading components where they lie.

Defined results: rows with a null vector or a null or non-finite component are dropped; shorter
vectors count as padded with zeros; repeated rows are rows of their own, with a fit list that
holds their vector once; a null vec_id is kept as it is. Components whose eigenvalue is not
above 1e-12 of the greatest can't be whitened and are left out, so a table with one
distinct vector, like an empty one, gives no rows. A deviation that doesn't fit a long is null.
Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.memory import released
from hazeline.llm.shipping import ship
from hazeline.llm.vectors import SCALE, whole_vectors
from hazeline.scratch import new_dir

BLOCK_ROWS = 4096
COMPONENTS = 4
_LEAST = 1e-12


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def planes(u: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of a block of shifted rows: [bit, dimension, word]."""
    rows, dims = u.shape
    words = -(-rows // 64)
    out = np.zeros((bits, dims, words * 8), np.uint8)
    for bit in range(bits):
        packed = np.packbits(((u >> bit) & 1).astype(np.uint8), axis=0)
        out[bit, :, : len(packed)] = packed.T
    return out.view(np.uint64)


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a block's dimensions, and of all products of two, as exact whole numbers."""
    rows, dims = x.shape
    shift = x.min(axis=0)
    top = max(int(high) - int(low) for high, low in zip(x.max(axis=0), shift))
    bits = max(1, top.bit_length())
    # Wider numbers than a long can hold are added up as Python's.
    wide = object if 2 * bits + rows.bit_length() > 62 else np.int64
    held = planes((x - shift).view(np.uint64), bits)
    value = np.array([1 << bit for bit in range(bits)], wide)
    counts = np.bitwise_count(held).sum(axis=2, dtype=np.int64).astype(wide)
    sums = (value[:, None] * counts).sum(axis=0).astype(object)
    products = np.zeros((dims, dims), wide)
    for bit in range(bits):
        for dim in range(dims):
            both = np.bitwise_count(held[:, dim:] & held[bit, dim]).sum(axis=2, dtype=np.int64)
            products[dim, dim:] += int(value[bit]) * (value[:, None] * both.astype(wide)).sum(axis=0)
    low = shift.astype(object)
    exact = products.astype(object) + np.outer(low, sums) + np.outer(sums, low) + rows * np.outer(low, low)
    return sums + rows * low, exact


def sums_of(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S, and the cross-products, of the rows of x; dims * dims numbers reach the driver."""
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.column("x").slice(start, BLOCK_ROWS))
                s, p = cross_products(x)
                n, sums, products = n + len(x), sums + s, products + p
        first = [-2, *[-1] * dims, *upper[0].tolist()]
        second = [0, *range(dims), *upper[1].tolist()]
        values = [n, *sums.tolist(), *products[upper].tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))],
            names=["i", "j", "value"],
        )

    rows = fit.mapInArrow(released(run), "i int, j int, value decimal(38,0)").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    held = {(r["i"], r["j"]): int(r["value"]) for r in rows}
    products = np.zeros((dims, dims), object)
    for i, j in zip(*(side.tolist() for side in upper)):
        products[i, j] = products[j, i] = held.get((i, j), 0)
    return held.get((-2, 0), 0), [held.get((-1, j), 0) for j in range(dims)], products


def components(n: int, sums: list[int], products: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues and eigenvectors (as columns) of the covariance, greatest first, and its trace."""
    total = np.array(sums, object)
    centred = n * products - np.outer(total, total)
    covariance = (centred / (n * n)).astype(float)  # of whole numbers: each is the nearest double
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    keep = values > max(_LEAST * float(values[0]), 0.0) if len(values) else np.zeros(0, bool)
    return values[keep], vectors[:, keep], float(np.trace(covariance))


def _whitened(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return (x - mean) @ axes


def identity_error(fit: DataFrame, mean: np.ndarray, axes: np.ndarray) -> float:
    """How far the covariance of the whitened fit list is from the identity, entry by entry."""
    k = axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = _whitened(_matrix(batch.column("x")), mean, axes)
                n, sums, products = n + len(w), sums + w.sum(axis=0), products + w.T @ w
        values = [float(n), *sums.tolist(), *products.reshape(-1).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["at", "value"])

    rows = fit.mapInArrow(released(run), "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    held = np.array([r["value"] for r in sorted(rows, key=lambda r: r["at"])])
    n, middle = held[0], held[1 : 1 + k] / held[0]
    covariance = held[1 + k :].reshape(k, k) / n - np.outer(middle, middle)
    return float(np.abs(covariance - np.eye(k)).max())


def whitened(rows: DataFrame, most: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row."""
    spark = rows.sparkSession
    ship(spark)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    path = new_dir(spark, "whole")
    whole_vectors(rows, vector, key, scale).write.parquet(path)
    stored = spark.read.parquet(path)
    shortest, dims = stored.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if not dims:
        return spark.createDataFrame([], schema)
    if shortest < dims:
        zeros = F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("x"))
        stored = stored.withColumn("x", F.concat("x", zeros))
    path = new_dir(spark, "fit-list")
    stored.select("x").distinct().write.parquet(path)
    fit = spark.read.parquet(path)
    n, sums, products = sums_of(fit, dims)
    values, vectors, trace = components(n, sums, products, most)
    if not len(values):
        return spark.createDataFrame([], schema)
    mean = np.array([s / n for s in sums])
    axes = vectors / np.sqrt(values)
    error = identity_error(fit, mean, axes)
    explained = (values / trace).tolist()
    k = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.array(sums, object)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = _matrix(part.column("x"))
                far = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
                if far**2 * dims < 1 << 62:
                    deviation = ((n * x - total.astype(np.int64)) ** 2).sum(axis=1).tolist()
                else:
                    deviation = ((n * x.astype(object) - total) ** 2).sum(axis=1).tolist()
                deviation = [d if d < 1 << 63 else None for d in deviation]
                w = _whitened(x, mean, axes)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(pa.array(np.repeat(np.arange(len(x)), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(k * len(x), n)),
                        pa.array([d for d in deviation for _ in range(k)], pa.int64()),
                        pa.array(w.reshape(-1)),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(k * len(x), error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return stored.select("key", "x").mapInArrow(released(run), schema)
