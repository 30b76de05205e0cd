"""Suffix-array removal of repeated passages, exact to the byte.

A byte goes where a string of `length` bytes around it also starts earlier: in a document of
smaller doc_id, or earlier in its own. Strings are judged on the input; they lie in one
document whole.

1. Every string picks an anchor, a gram of 32 bytes inside it, so that equal strings pick the
   same place in themselves (`anchors`). Strings in a row with one anchor form a context.
2. Contexts are dealt by their gram's code. Equal contexts are collapsed, before the shuffle
   inside a task and after it in full: all but the first are repeats from end to end. Grams
   with one context left are done.
3. Of the others the bytes are fetched, and each shard's contexts are sorted by external
   induction with disk-backed queues (`induced`). Neighbours that share `length` bytes are one
   string; the first place of each stays and all others are repeats.
4. Repeats are joined to maximal runs per document and cut out.

Rows travel as packed arrays, many contexts to a row. Texts are moved only for documents that
may hold a context to fetch or a run to cut, by a bit map of fixed size. Codes of 64 bits tell
contexts apart within a gram; strings are compared byte by byte.

Defined results: a null text is empty, an empty or short text keeps all; rows that repeat a
doc_id are one document, no copies of each other, and lose the same runs; rows with a null
doc_id neither lose anything nor make others lose; other columns are left alone.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.anchors import contexts
from hazeline.llm.bind import free_name
from hazeline.llm.chunked import expand, slices
from hazeline.llm.id_map import IdMap
from hazeline.llm.induced import Sorter
from hazeline.llm.memory import give_back, released
from hazeline.llm.shingles import _mixed
from hazeline.llm.shipping import ship
from hazeline.scratch import discard, new_dir

LENGTH = 100
HELD_CONTEXTS = 300_000  # of a task before it deals them
SHARD_CONTEXTS = 12_000  # to sort in one task, about 1.6 MB of text, if grams allow
HELD_WINDOWS = 1_000_000  # repeated strings of a shard before they are dealt
QUEUE_ROWS = 1_000_000  # of a shard's sorter in memory; more go to disk
BASE_NAMES = 4_000_000  # reduced texts up to it are sorted in memory
MAPPED_BYTES = 64_000_000  # text of a shard from which it is mapped from disk

CONTEXT = (("gram", "<u8"), ("code", "<u8"), ("doc", "<i8"), ("first", "<i8"), ("width", "<u2"))
SPAN = (("doc", "<i8"), ("start", "<i8"), ("end", "<i8"))
WANTED = (("doc", "<i8"), ("gram", "<u8"), ("first", "<i8"), ("width", "<u2"))
Columns = tuple[np.ndarray, ...]


def pack(columns: Columns, layout: tuple) -> bytes:
    return b"".join(np.ascontiguousarray(c, kind).tobytes() for c, (_, kind) in zip(columns, layout))


def unpack(blobs: list[bytes], layout: tuple) -> Columns:
    size = sum(np.dtype(kind).itemsize for _, kind in layout)
    parts: list[list[np.ndarray]] = [[] for _ in layout]
    for blob in blobs:
        rows, at = len(blob) // size, 0
        for part, (_, kind) in zip(parts, layout):
            part.append(np.frombuffer(blob, kind, rows, at))
            at += rows * np.dtype(kind).itemsize
    return tuple(np.concatenate(p) if p else np.zeros(0, kind) for p, (_, kind) in zip(parts, layout))


def dealt(kind: int, columns: Columns, layout: tuple, shard: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """The rows of each shard as one blob."""
    order = np.argsort(shard, kind="stable")
    shard, columns = shard[order], tuple(c[order] for c in columns)
    cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else [], len(shard)).astype(int)
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield kind, int(shard[a]), pack(tuple(c[a:b] for c in columns), layout)


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["kind", "shard", "data"]
    )


BLOBS = "kind int, shard int, data binary"
CONTEXTS, SPANS, REQUESTS = 0, 1, 2


def _by_doc(doc: np.ndarray, parts: int) -> np.ndarray:
    return (_mixed(doc.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _collapsed(columns: Columns) -> tuple[Columns, np.ndarray]:
    """Contexts by gram, code, document and place; and which are the first of their kind."""
    order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
    columns = tuple(c[order] for c in columns)
    # A row that repeats a doc_id names the same places again.
    twice = np.zeros(len(order), bool)
    twice[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns[:4]])
    columns = tuple(c[~twice] for c in columns)
    gram, code = columns[0], columns[1]
    fresh = np.ones(len(gram), bool)
    fresh[1:] = (gram[1:] != gram[:-1]) | (code[1:] != code[:-1])
    return columns, fresh


def joined(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> Columns:
    """Spans that touch or overlap in a document as one."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    # Running ends inside a document: documents stand apart by more than any of them is long.
    apart = int(end.max()) + 2
    number = np.cumsum(np.append(False, doc[1:] != doc[:-1])).astype(np.int64) * apart
    reach = np.maximum.accumulate(number + end)
    fresh = np.append(True, (number + start)[1:] > reach[:-1])
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], reach[last] - number[last]


def _spans(columns: Columns, length: int, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Contexts that are repeats from end to end, as spans dealt by document."""
    doc, first, width = columns[2], columns[3], columns[4].astype(np.int64)
    spans = joined(doc, first, first + width - 1 + length)
    yield from dealt(SPANS, spans, SPAN, _by_doc(spans[0], parts))


def _anchored(docs: DataFrame, length: int, parts: int) -> DataFrame:
    """Steps 1 and 2 before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Columns] = []
        count = 0

        def deal() -> Iterator[pa.RecordBatch]:
            columns, fresh = _collapsed(tuple(np.concatenate(c) for c in zip(*held)))
            held.clear()
            rows = list(_spans(tuple(c[~fresh] for c in columns), length, parts)) if not fresh.all() else []
            kept = tuple(c[fresh] for c in columns)
            rows += dealt(CONTEXTS, kept, CONTEXT, (kept[0] % np.uint64(parts)).astype(np.int64))
            yield _batch(rows)

        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for start, data, offsets in slices(batch.column("text")):
                for text, first, last, gram, code in contexts(data, offsets, length):
                    held.append((gram, code, ids[start + text], first, (last - first + 1).astype(np.uint16)))
                    count += len(gram)
                if count >= HELD_CONTEXTS:
                    yield from deal()
                    count = 0
        if held:
            yield from deal()

    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(released(run), BLOBS)


def _gathered(blobs: DataFrame, length: int, parts: int) -> DataFrame:
    """Step 2 after the shuffle: spans, and requests for the bytes of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        for batch in batches:
            rows = []
            for kind, shard, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "shard", "data"))):
                if kind == CONTEXTS:
                    held.append(data)
                else:
                    rows.append((kind, shard, data))
            if rows:
                yield _batch(rows)
        if not held:
            return
        columns, fresh = _collapsed(unpack(held, CONTEXT))
        rows = list(_spans(tuple(c[~fresh] for c in columns), length, parts)) if not fresh.all() else []
        gram, _, doc, first, width = (c[fresh] for c in columns)
        begins = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        several = np.repeat(np.diff(np.append(begins, len(gram))) > 1, np.diff(np.append(begins, len(gram))))
        wanted = (doc[several], gram[several], first[several], width[several])
        rows += dealt(REQUESTS, wanted, WANTED, _by_doc(wanted[0], parts))
        if rows:
            yield _batch(rows)

    return blobs.repartition(parts, "shard").mapInArrow(released(run), BLOBS)


def _requests(blobs: DataFrame, parts: int) -> DataFrame:
    """doc_id and its packed requests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = unpack([d for batch in batches for d in batch.column("data").to_pylist()], WANTED)
        order = np.argsort(columns[0], kind="stable")
        columns = tuple(c[order] for c in columns)
        doc = columns[0]
        begins = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
        cuts = np.append(begins, len(doc))
        for low in range(0, len(begins), 5000):
            some = list(zip(cuts[low : low + 5000].tolist(), cuts[low + 1 : low + 5001].tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[[a for a, _ in some]]),
                    pa.array([pack(tuple(c[a:b] for c in columns), WANTED) for a, b in some], pa.binary()),
                ],
                names=["doc_id", "wanted"],
            )

    return blobs.filter(F.col("kind") == REQUESTS).select("shard", "data").repartition(parts, "shard").mapInArrow(
        released(run), "doc_id long, wanted binary"
    )


def _fetched(docs: DataFrame, wanted: DataFrame, length: int, shards: int) -> DataFrame:
    """The contexts' bytes, dealt by gram: packed contexts and their bytes, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[Columns, bytes]] = []
        count = 0

        def deal() -> Iterator[pa.RecordBatch]:
            columns = tuple(np.concatenate(c) for c in zip(*(h[0] for h in held)))
            raw = np.frombuffer(b"".join(h[1] for h in held), np.uint8)
            held.clear()
            sizes = columns[3].astype(np.int64) + (length - 1)
            ends = np.cumsum(sizes)
            shard = (_mixed(columns[1]) % np.uint64(shards)).astype(np.int64)
            for number in np.unique(shard).tolist():
                of = np.flatnonzero(shard == number)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int32()),
                        pa.array([pack(tuple(c[of] for c in columns), WANTED)], pa.binary()),
                        pa.array([expand(raw, ends[of] - sizes[of], sizes[of]).tobytes()], pa.binary()),
                    ],
                    names=["shard", "contexts", "bytes"],
                )

        for batch in batches:
            for text, blob in zip(batch.column("text"), batch.column("wanted")):
                columns = unpack([blob.as_py()], WANTED)
                raw = np.frombuffer(text.as_py().encode(), np.uint8)
                sizes = columns[3].astype(np.int64) + (length - 1)
                # A row that repeats a doc_id may be shorter than the one that asked.
                inside = columns[2] + sizes <= len(raw)
                columns, sizes = tuple(c[inside] for c in columns), sizes[inside]
                held.append((columns, expand(raw, columns[2], sizes).tobytes()))
                count += len(sizes)
                if count >= HELD_CONTEXTS // 4:
                    yield from deal()
                    count = 0
        if count:
            yield from deal()

    near = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    asked = near.filter(IdMap(wanted, "doc_id").maybe(F.col("doc_id"))).join(wanted, "doc_id")
    return asked.select("text", "wanted").mapInArrow(released(run), "shard int, contexts binary, bytes binary")


def repeated_windows(buckets, begins, doc, first, width, length: int) -> Iterator[Columns]:
    """(document, place) of strings that also start earlier, from buckets of sorted suffixes."""
    for position, shared in buckets:
        group = np.cumsum(shared < length)
        context = np.searchsorted(begins, position, "right") - 1
        offset = position - begins[context]
        whole = offset < width[context]
        group, context, offset = group[whole], context[whole], offset[whole]
        if not len(group):
            continue
        # Groups of one are no repeats; most are.
        alone = np.ones(len(group), bool)
        same = group[1:] == group[:-1]
        alone[1:][same] = False
        alone[:-1][same] = False
        group, context, offset = group[~alone], context[~alone], offset[~alone]
        own, place = doc[context], first[context] + offset
        order = np.lexsort((place, own, group))
        group, own, place = group[order], own[order], place[order]
        # The first string of a group stays, with every row that names the very same place.
        fresh = np.append(True, group[1:] != group[:-1]) if len(group) else np.zeros(0, bool)
        head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(group) else np.zeros(0, np.int64)
        later = (own != own[head]) | (place != place[head])
        yield own[later], place[later]


def _sorted(fetched: DataFrame, length: int, shards: int, parts: int) -> DataFrame:
    """Step 3: spans of repeated strings, dealt by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
            path = os.path.join(folder, "text")
            blobs: list[bytes] = []
            with open(path, "wb") as file:
                for batch in batches:
                    for blob, raw in zip(batch.column("contexts").to_pylist(), batch.column("bytes").to_pylist()):
                        blobs.append(blob)
                        sizes = unpack([blob], WANTED)[3].astype(np.int64) + (length - 1)
                        # Bytes as symbols from 2; a 1 ends each context.
                        ends = np.cumsum(sizes) + np.arange(1, len(sizes) + 1)
                        out = np.ones(int(sizes.sum()) + len(sizes), "<u2")
                        mask = np.ones(len(out), bool)
                        mask[ends - 1] = False
                        out[mask] = np.frombuffer(raw, np.uint8).astype("<u2") + 2
                        file.write(out.tobytes())
                file.write(b"\0\0")
            if not blobs:
                return
            doc, _, first, width = unpack(blobs, WANTED)
            width = width.astype(np.int64)
            begins = np.cumsum(width + length) - (width + length)
            size = os.path.getsize(path)
            text = np.memmap(path, "<u2", "r") if size > MAPPED_BYTES else np.fromfile(path, "<u2")
            sorter = Sorter(folder, length, QUEUE_ROWS, BASE_NAMES)
            held: list[Columns] = []
            count = 0

            def deal() -> pa.RecordBatch:
                own, place = (np.concatenate(c) for c in zip(*held))
                held.clear()
                spans = joined(own, place, place + length)
                return _batch(list(dealt(SPANS, spans, SPAN, _by_doc(spans[0], parts))))

            for windows in repeated_windows(sorter.buckets(text), begins, doc, first, width, length):
                if len(windows[0]):
                    held.append(windows)
                    count += len(windows[0])
                if count >= HELD_WINDOWS:
                    yield deal()
                    count = 0
            if held:
                yield deal()

    return fetched.repartition(shards, "shard").mapInArrow(released(run), BLOBS)


def _runs(blobs: DataFrame, parts: int) -> DataFrame:
    """doc_id, starts, ends: maximal removed runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = unpack([d for batch in batches for d in batch.column("data").to_pylist()], SPAN)
        doc, start, end = joined(*spans)
        begins = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
        cuts = np.append(begins, len(doc))
        for low in range(0, len(begins), 5000):
            part = cuts[low : low + 5001]
            lists = [pa.ListArray.from_arrays(pa.array((part - part[0]).astype(np.int32)), pa.array(c[part[0] : part[-1]])) for c in (start, end)]
            yield pa.RecordBatch.from_arrays([pa.array(doc[part[:-1]]), *lists], names=["doc_id", "starts", "ends"])

    return blobs.repartition(parts, "shard").mapInArrow(released(run), "doc_id long, starts array<long>, ends array<long>")


def _stored(df: DataFrame, label: str, paths: list[str]) -> DataFrame:
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    paths.append(path)
    return df.sparkSession.read.parquet(path)


def repeated_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, starts, ends: for each document with repeats, its maximal runs of repeated bytes."""
    spark = docs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths: list[str] = []
    first = _stored(_gathered(_anchored(docs, length, parts), length, parts), "contexts", paths)
    wanted = _stored(_requests(first, parts), "requests", paths)
    # Sorting needs most memory for each byte: as many shards as keep them small.
    row_bytes = sum(np.dtype(kind).itemsize for _, kind in WANTED)
    asked = wanted.agg(F.sum(F.octet_length("wanted"))).first()[0] or 0
    shards = max(parts, -(-asked // (row_bytes * SHARD_CONTEXTS)))
    second = _stored(_sorted(_fetched(docs, wanted, length, shards), length, shards, parts), "sorted", paths)
    runs = _stored(_runs(first.filter(F.col("kind") == SPANS).union(second).select("shard", "data"), parts), "runs", [])
    for path in paths:
        discard(spark, path)
    return runs


def _cutter(characters: bool):
    @F.pandas_udf("kept binary, n_removed long, n_spans long")
    def cut(data: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = []
        for raw, begin, end in zip(data, starts, ends):
            keep = np.ones(len(raw), bool)
            spans = 0
            for a, b in zip(begin, end):
                a, b = int(a), min(int(b), len(raw))
                if characters:
                    # A character goes only if all its bytes do.
                    while a < b and raw[a] & 0xC0 == 0x80:
                        a += 1
                    while a < b < len(raw) and raw[b] & 0xC0 == 0x80:
                        b -= 1
                if a < b:
                    keep[a:b] = False
                    spans += 1
            kept = np.frombuffer(raw, np.uint8)[keep].tobytes()
            rows.append((kept, len(raw) - len(kept), spans))
        out = pd.DataFrame(rows, columns=["kept", "n_removed", "n_spans"])
        del rows
        give_back()
        return out

    return cut


def removed(docs: DataFrame, length: int = LENGTH, characters: bool = False) -> DataFrame:
    """All rows and columns, and `_cut`: struct<kept binary, n_removed, n_spans>.

    `characters`: keep characters whole, those that a run covers in part.
    """
    runs = repeated_runs(docs, length)
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    maybe = IdMap(runs, "doc_id").maybe(F.col("doc_id"))
    whole = F.struct(data.alias("kept"), F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"))
    flag, of, begin, end = (free_name(docs, name) for name in ("_maybe", "_id", "_starts", "_ends"))
    marked = docs.withColumn(flag, F.col("doc_id").isNotNull() & F.coalesce(maybe, F.lit(False)))
    untouched = marked.filter(~F.col(flag)).select(*docs.columns, whole.alias("_cut"))
    runs = runs.withColumnsRenamed({"doc_id": of, "starts": begin, "ends": end})
    near = marked.filter(F.col(flag)).join(runs, F.col("doc_id") == F.col(of), "left")
    empty = F.array().cast("array<bigint>")
    cut = _cutter(characters)(data, F.coalesce(begin, empty), F.coalesce(end, empty))
    return untouched.union(near.select(*docs.columns, cut.alias("_cut")))


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same columns, repeats cut out of the texts, whole characters kept, `n_chars` brought
    up; rows whose text is left without a word go, rows that had none before stay."""
    out = removed(docs, length, characters=True)
    text = F.when(F.col("text").isNotNull(), F.decode(F.col("_cut.kept"), "UTF-8"))
    left = free_name(out, "_text")
    out = out.withColumn(left, text).filter(
        (F.col("_cut.n_removed") == 0) | (F.length(F.regexp_replace(left, r"\s+", "")) > 0)
    )
    columns = {"text": F.col(left)}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(left).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(columns).select(*docs.columns)
