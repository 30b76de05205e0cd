"""Token ids in binary files of patched frame-of-reference blocks.

A shard holds whole documents in ascending doc_id order. Its ids are cut into blocks of 256.
A block subtracts its least id and packs the rest at a width chosen among percentiles of its
bit lengths, whichever makes it smallest; ids that need more bits leave their low bits in
place and their whole value in the block's exception list. An index of block starts lets a
reader take any range of ids. Layout, little-endian:

    blocks:   base u32, width u8, exceptions u16, packed bits, places u8[], values u32[]
    index:    block starts u64[], doc ids i64[], known u8[], doc starts u64[]
    trailer:  ids u64, blocks u32, documents u32, index start u64, magic

Documents are dealt by ranges of doc_id, so shards follow each other without overlap. A task
writes shards under names of its own and reports them; the report is stored once, and only
shards in it are ever read, so repeated or lost tasks leave nothing that counts.

Defined results: a null text is empty and has the end id only; ties in doc_id are ordered by
text; a null doc_id sorts first; an empty table gives no shards and no rows; other columns
are left out.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeline.llm.chunked import library_encoder, slices
from hazeline.llm.shared_files import at, made
from hazeline.llm.shipping import ship
from hazeline.scratch import new_dir

BLOCK = 256
PERCENTILES = (50, 75, 90, 95, 100)
SHARD_IDS = 4_000_000
READ_IDS = 1_000_000
MAGIC = b"PFORIDS1"
_HEAD = struct.Struct("<IBH")
_TAIL = struct.Struct("<QIIQ8s")


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of each value."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64) * (values > 0)


def encode_blocks(ids: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The blocks' bytes, and where each starts."""
    if not len(ids):
        return [], np.zeros(0, np.uint64)
    count = -(-len(ids) // BLOCK)
    padded = np.full(count * BLOCK, ids[-1], np.uint32)
    padded[: len(ids)] = ids
    rows = padded.reshape(count, BLOCK)
    base = rows.min(axis=1)
    rest = rows - base[:, None]
    bits = _bits(rest)
    ranked = np.sort(bits, axis=1)
    best_cost = np.full(count, np.iinfo(np.int64).max)
    width = np.zeros(count, np.int64)
    for p in PERCENTILES:
        w = ranked[:, min(BLOCK - 1, BLOCK * p // 100)]
        cost = w * BLOCK // 8 + 5 * (bits > w[:, None]).sum(axis=1)
        width = np.where(cost < best_cost, w, width)
        best_cost = np.minimum(cost, best_cost)
    out: list[bytes] = [b""] * count
    for w in np.unique(width):
        for part in np.array_split(np.flatnonzero(width == w), -(-int((width == w).sum()) // 2048)):
            low = rest[part] & np.uint32((1 << int(w)) - 1)
            spread = (low[:, :, None] >> np.arange(int(w), dtype=np.uint32)).astype(np.uint8) & 1
            packed = np.packbits(spread.reshape(len(part), -1), axis=1, bitorder="little")
            over = bits[part] > w
            for k, row in enumerate(part):
                places = np.flatnonzero(over[k])
                out[row] = (
                    _HEAD.pack(int(base[row]), int(w), len(places)) + packed[k].tobytes()
                    + places.astype(np.uint8).tobytes() + rest[row, places].astype("<u4").tobytes()
                )
    sizes = np.fromiter(map(len, out), np.int64, count)
    return out, (np.cumsum(sizes) - sizes).astype(np.uint64)


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """All ids of the blocks that start at `starts` in `data`, padding included."""
    heads = [_HEAD.unpack_from(data, int(s)) for s in starts]
    width = np.array([h[1] for h in heads], np.int64)
    rest = np.zeros((len(heads), BLOCK), np.uint32)
    raw = np.frombuffer(data, np.uint8)
    for w in np.unique(width):
        if w == 0:
            continue
        size = int(w) * BLOCK // 8
        for part in np.array_split(np.flatnonzero(width == w), -(-int((width == w).sum()) // 2048)):
            at_ = starts[part].astype(np.int64)[:, None] + _HEAD.size + np.arange(size)
            spread = np.unpackbits(raw[at_], axis=1, bitorder="little").reshape(len(part), BLOCK, int(w))
            value = np.zeros((len(part), BLOCK), np.uint32)
            for b in range(int(w)):
                value |= spread[:, :, b].astype(np.uint32) << np.uint32(b)
            rest[part] = value
    for k, (_, w, n) in enumerate(heads):
        if n:
            place = int(starts[k]) + _HEAD.size + w * BLOCK // 8
            where = np.frombuffer(data, np.uint8, n, place)
            rest[k, where] = np.frombuffer(data, "<u4", n, place + n)
    return (rest + np.array([h[0] for h in heads], np.uint32)[:, None]).reshape(-1)


def write_shard(uri: str, ids: np.ndarray, doc_ids: list[int | None], doc_starts: np.ndarray) -> None:
    blocks, starts = encode_blocks(ids)
    body = b"".join(blocks)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    index = (
        starts.astype("<u8").tobytes()
        + np.array([d or 0 for d in doc_ids], "<i8").tobytes()
        + known.tobytes()
        + doc_starts.astype("<u8").tobytes()
    )
    system, path = at(uri)
    with system.open_output_stream(path) as out:
        out.write(body)
        out.write(index)
        out.write(_TAIL.pack(len(ids), len(blocks), len(doc_ids), len(body), MAGIC))


class Shard:
    """Reads a shard's index, and any range of its ids."""

    def __init__(self, uri: str):
        system, path = at(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        self.ids, blocks, docs, self.end, magic = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        index = self.file.read_at(size - _TAIL.size - self.end, self.end)
        self.starts = np.frombuffer(index, "<u8", blocks)
        self.doc_ids = np.frombuffer(index, "<i8", docs, 8 * blocks)
        self.known = np.frombuffer(index, np.uint8, docs, 8 * (blocks + docs)).astype(bool)
        self.doc_starts = np.append(np.frombuffer(index, "<u8", docs, 8 * blocks + 9 * docs), self.ids).astype(np.int64)

    def read(self, start: int, end: int) -> np.ndarray:
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (end - 1) // BLOCK
        begin = int(self.starts[first])
        stop = int(self.starts[last + 1]) if last + 1 < len(self.starts) else self.end
        data = self.file.read_at(stop - begin, begin)
        ids = decode_blocks(data, self.starts[first : last + 1].astype(np.int64) - begin)
        return ids[start - first * BLOCK : end - first * BLOCK]


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 2, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode and write every document; the stored report, a row for each shard:
    part, number (order inside the part), path, n_ids."""
    spark = docs.sparkSession
    ship(spark)
    folder = new_dir(spark, "token-shards")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        docs.select("doc_id", "text")
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = library_encoder(tokenizer)
        made(folder)
        held_ids: list[np.ndarray] = []
        held_docs: list[int | None] = []
        held_sizes: list[np.ndarray] = []
        report: list[tuple[int, int, str, int]] = []

        def close() -> None:
            ids, sizes = np.concatenate(held_ids), np.concatenate(held_sizes)
            uri = f"{folder}/{part:06d}-{len(report):06d}-{uuid4().hex}.ids"
            write_shard(uri, ids, held_docs, np.cumsum(sizes) - sizes)
            report.append((part, len(report), uri, len(ids)))
            held_ids.clear(), held_docs.clear(), held_sizes.clear()

        total = 0
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for start, data, offsets in slices(batch.column("text")):
                ids, sizes = encoder.encode(data, offsets)
                # The end id goes after each document.
                with_end = np.insert(ids, np.cumsum(sizes), end_id).astype(np.uint32)
                held_ids.append(with_end), held_sizes.append(sizes + 1)
                held_docs.extend(names[start : start + len(sizes)])
                total += len(with_end)
                if total >= shard_ids:
                    close()
                    total = 0
        if held_docs:
            close()
        if report:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*report)], names=["part", "number", "path", "n_ids"]
            )

    stored = new_dir(spark, "token-report")
    dealt.mapInArrow(write, "part long, number long, path string, n_ids long").write.parquet(stored)
    return spark.read.parquet(stored)


def read_tokens(spark: SparkSession, report: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (little-endian u32 binary).

    The driver sums ids by part, of which there are as many as shuffle partitions.
    """
    ship(spark)
    sums = {row["part"]: row["n"] for row in report.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, running = {}, 0
    for part in sorted(sums):
        before[part], running = running, running + sums[part]
    if not before:
        before = {0: 0}
    base = F.create_map(*[F.lit(x).cast("bigint") for pair in before.items() for x in pair])
    earlier = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    inside = report.withColumn("inside", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    todo = inside.select("path", (base[F.col("part")] + F.col("inside")).alias("start")).repartition(parts, "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"])
                docs, first = len(shard.doc_ids), 0
                while first < docs:
                    # As many documents as hold READ_IDS ids, one at least.
                    limit = shard.doc_starts[first] + READ_IDS
                    last = max(first + 1, int(np.searchsorted(shard.doc_starts, limit, "right")) - 1)
                    begin = int(shard.doc_starts[first])
                    ids = shard.read(begin, int(shard.doc_starts[last])).astype("<u4")
                    offsets = ((shard.doc_starts[first : last + 1] - begin) * 4).astype(np.int32)
                    starts = shard.doc_starts[first:last]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[first:last], mask=~shard.known[first:last]),
                            pa.array(starts + row["start"]),
                            pa.array(shard.doc_starts[first + 1 : last + 1] - starts),
                            pa.BinaryArray.from_buffers(
                                pa.binary(), last - first, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
                            ),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    first = last

    return todo.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
