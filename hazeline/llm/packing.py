"""Packing token sequences by multiway differencing (Karmarkar and Karp).

A document's ids and its end id are cut into full windows, each a sequence of its own, and a
tail. Tails are packed by the thousand: each starts as a partition of itself into k windows;
the two partitions with the largest imbalances are merged, the fullest window of one with the
emptiest of the other, until one partition with near-equal windows is left. Where a window
exceeds the capacity and cutting is allowed, its surplus is cut off and levels the windows
below capacity; otherwise, or where no room is left, k rises and the tails are packed anew.

Each task packs what it reads: no shuffle, no group, and memory for one pool of tails and the
longest document. A task's sequence ids lie in a range of its own and depend only on the rows
it reads, in their order, so a repeated task repeats them. Rows keep the scan's order.

Defined results: a null text is empty and has the end id alone; repeated rows are packed
like any others; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hazeline.llm.chunked import ChunkEncoder, slices, task_encoder
from hazeline.llm.memory import released
from hazeline.llm.shipping import ship

CAPACITY = 1024
POOL = 512
TASK_SHIFT = 36  # sequences of a task: 2**36, far more than a task can read

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


@dataclass
class _Partition:
    """k windows: sums, and chained items by first and last (-1: none)."""

    sums: np.ndarray
    head: np.ndarray
    tail: np.ndarray


def differencing(sizes: np.ndarray, k: int) -> list[list[int]]:
    """Items of each of k windows, near-equal in total size."""
    following = np.full(len(sizes), -1, np.int64)
    heap: list[tuple[int, int, _Partition]] = []
    for i, size in enumerate(sizes):
        # Windows in ascending order of their sums throughout.
        sums, chain = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[-1], chain[-1] = size, i
        heap.append((-int(size) if k > 1 else 0, i, _Partition(sums, chain, chain.copy())))
    heapq.heapify(heap)
    tick = len(sizes)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        sums = one.sums + two.sums[::-1]
        head2, tail2 = two.head[::-1], two.tail[::-1]
        both = (one.head >= 0) & (head2 >= 0)
        following[one.tail[both]] = head2[both]
        head = np.where(one.head >= 0, one.head, head2)
        tail = np.where(head2 >= 0, tail2, one.tail)
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (-int(sums[-1] - sums[0]), tick, _Partition(sums, head[order], tail[order])))
        tick += 1
    windows: list[list[int]] = []
    if heap:
        for i in heap[0][2].head:
            items = []
            while i >= 0:
                items.append(int(i))
                i = following[i]
            windows.append(items)
    return windows


def level(windows: list[list[tuple[int, int, int]]], capacity: int) -> bool:
    """Cut the surplus off windows above capacity and give it to those below; whether it fits.

    A window is a list of (item, start, length); the last of them is cut, from its end.
    """
    spare: list[tuple[int, int, int]] = []
    totals = [sum(piece[2] for piece in window) for window in windows]
    for w, window in enumerate(windows):
        while totals[w] > capacity:
            item, start, length = window.pop()
            cut = min(length, totals[w] - capacity)
            spare.append((item, start + length - cut, cut))
            if cut < length:
                window.append((item, start, length - cut))
            totals[w] -= cut
    for w in sorted(range(len(windows)), key=lambda w: -totals[w]):
        while spare and totals[w] < capacity:
            item, start, length = spare.pop()
            put = min(length, capacity - totals[w])
            windows[w].append((item, start, put))
            totals[w] += put
            if put < length:
                spare.append((item, start + put, length - put))
    return not spare


def pack_tails(sizes: np.ndarray, capacity: int, cuts: bool) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start, length) over items of at most `capacity`, none above it."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        windows = [[(i, 0, int(sizes[i])) for i in window] for window in differencing(sizes, k)]
        totals = [sum(piece[2] for piece in window) for window in windows]
        if max(totals, default=0) <= capacity or cuts and level(windows, capacity):
            return [window for window in windows if window]
        k += 1


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, pool: int = POOL, cuts: bool = True
) -> DataFrame:
    """A row for each piece: its document, where in it the piece starts, its ids (little-endian
    u32), and the sequence and offset it is put at. `cuts`: tails may be cut to fill windows."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_encoder(tokenizer) as encoder:
            yield from packed(batches, encoder)

    def packed(batches: Iterator[pa.RecordBatch], encoder: ChunkEncoder) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << TASK_SHIFT
        tails: list[tuple[int | None, int, np.ndarray, int]] = []  # doc, start, ids, doc's tokens
        rows: list[tuple] = []

        def close_pool() -> None:
            nonlocal sequence
            sizes = np.array([len(t[2]) for t in tails], np.int64)
            for window in pack_tails(sizes, capacity, cuts):
                offset = 0
                for item, start, length in window:
                    doc, at, ids, total = tails[item]
                    rows.append(
                        (doc, at + start, length, ids[start : start + length].tobytes(), total, sequence, offset)
                    )
                    offset += length
                sequence += 1
            tails.clear()

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, data, offsets in slices(batch.column("text")):
                ids, sizes = encoder.encode(data, offsets)
                ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")
                ends = np.cumsum(sizes + 1)
                for name, begin, end in zip(names[first:], ends - sizes - 1, ends):
                    own = ids[begin:end]
                    full = len(own) // capacity * capacity
                    for start in range(0, full, capacity):
                        piece = own[start : start + capacity]
                        rows.append((name, start, capacity, piece.tobytes(), len(own), sequence, 0))
                        sequence += 1
                    if full < len(own):
                        tails.append((name, full, own[full:].copy(), len(own)))
                        if len(tails) >= pool:
                            close_pool()
                if rows:
                    yield flushed()
        if tails:
            close_pool()
        if rows:
            yield flushed()

    return docs.select("doc_id", "text").mapInArrow(released(run), PIECES)
