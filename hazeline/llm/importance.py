"""Importance resampling towards a target: documents drawn by how much they look like it.

1. A text is ASCII-lowered and pre-tokenised by the tokenizers library: an untrained Split on a
   pattern returns the words with their offsets. It is given the UTF-8 bytes, one character
   each, so that offsets are byte offsets; the pattern only looks at ASCII, which bytes of
   other characters never are.
2. Windows of one and two neighbouring offset pairs are the features: CRC-32 of the words'
   bytes, joined by one blank, modulo the number of buckets. The checksums of all windows of a
   slice of texts are worked out byte place by byte place, those of long words by zlib.
3. The buckets of every document are stored; histograms of the corpus and of the target are
   added up from them, one per task, then by bucket.
4. A bucket's gain is the logarithm of its smoothed share in the target over that in the
   corpus, in thousandths; a document's weight is the mean gain of its features. Gains are one
   table of fixed size.
5. A Gumbel number from a hash of the id is added to the weight, and of the N documents long
   enough the floor(percent * N / 100) greatest scores are drawn. Ranks come from a range
   partition of the scores: a row's place in its partition, and the sizes of those before.

Defined results: a null text has no words, no features and weight 0; repeated rows are
documents of their own, each counted and ranked; a row without a doc_id has a null score and is
neither drawn nor counted among the N, but its features count in the corpus; an empty table
gives no rows, an empty target gains as if nothing were known of it; other columns are left out.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.chunked import slices
from hazeline.llm.memory import released
from hazeline.llm.shipping import ship
from hazeline.scratch import new_dir

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Words beyond this many bytes get their checksums one by one.
LONG = 48

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


@lru_cache(maxsize=1)
def _splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def words(lowered: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the words of an ASCII-lowered text: starts and ends."""
    found = _splitter().pre_tokenize_str(lowered.decode("latin-1"))
    pairs = np.array([pair for _, pair in found], np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _continued(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of bytes data[starts:ends] that follow what has the checksums `crc`."""
    state = crc ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    many = int((size > LONG).sum())
    order, held = order[many:], order[:many]
    at, part, left = starts[order], state[order], size[order]
    # Of words by falling length, those that have a byte at this place stand in front.
    for place in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -place, "left"))
        part[:n] = _TABLE[(part[:n] ^ data[at[:n] + place]) & 255] ^ (part[:n] >> 8)
    out = crc.copy()
    out[order] = part ^ np.uint32(0xFFFFFFFF)
    for i in held.tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(crc[i]))
    return out


def features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the texts, text by text, and how many words each has."""
    lowered = _LOWER[data]
    raw = lowered.tobytes()
    found = [words(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    counts = np.array([len(starts) for starts, _ in found], np.int64)
    if not counts.sum():
        return np.zeros(0, np.uint32), counts
    begin = np.repeat(offsets[:-1], counts)
    starts = np.concatenate([s for s, _ in found]) + begin
    ends = np.concatenate([e for _, e in found]) + begin
    single = _continued(np.zeros(len(starts), np.uint32), lowered, starts, ends)
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.flatnonzero(text[1:] == text[:-1])
    state = single[first] ^ np.uint32(0xFFFFFFFF)
    blank = (_TABLE[(state ^ 32) & 255] ^ (state >> 8)) ^ np.uint32(0xFFFFFFFF)
    double = _continued(blank, lowered, starts[first + 1], ends[first + 1])
    # A text's single words, then its pairs.
    order = np.argsort(np.concatenate([2 * text, 2 * text[first] + 1]), kind="stable")
    return (np.concatenate([single, double]) % np.uint32(buckets))[order], counts


def bucketed(docs: DataFrame, buckets: int, key: str | None = "doc_id") -> DataFrame:
    """doc_id, n_words, buckets (little-endian u32) of every text; without a key, only buckets."""
    kept = docs.select("text") if key is None else docs.select(F.col(key).cast("bigint").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data, offsets in slices(batch.column("text")):
                flat, counts = features(data, offsets, buckets)
                sizes = np.maximum(2 * counts - 1, 0)
                ends = np.concatenate([[0], np.cumsum(sizes)]) * 4
                packed = pa.BinaryArray.from_buffers(
                    pa.binary(), len(counts),
                    [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat.astype("<u4"))],
                )
                columns, names = [pa.array(counts), packed], ["n_words", "buckets"]
                if key is not None:
                    columns, names = [batch.column("doc_id").slice(start, len(counts)), *columns], ["doc_id", *names]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = "n_words long, buckets binary"
    return kept.mapInArrow(released(run), fields if key is None else f"doc_id long, {fields}")


def _flat(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a column, and the rows' numbers of them."""
    _, places, data = column.buffers()
    ends = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]].view("<u4"), np.diff(ends) // 4


def histogram(stored: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall in each bucket; at most `buckets` rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_flat(batch.column("buckets"))[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    rows = stored.select("buckets").mapInArrow(released(run), "bucket int, n long")
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in the target over that in the corpus)."""
    buckets = len(corpus)
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighted(stored: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight."""
    table = stored.sparkSession.sparkContext.broadcast(gain)  # 8 bytes a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, sizes = _flat(batch.column("buckets"))
            sums = np.concatenate([[0], np.cumsum(table.value[flat])])
            ends = np.cumsum(sizes)
            weight = (sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(sizes), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return stored.mapInArrow(released(run), "doc_id long, n_words long, n_features long, weight long")


def scored(weights: DataFrame, seed: int) -> DataFrame:
    """Adds the score: weight and a Gumbel number of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string"))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weights.withColumn("score", F.col("weight") + gumbel)


def ranked(table: DataFrame, least_words: int, percent: int) -> DataFrame:
    """Adds the rank of drawn rows, without bringing the rows into one task."""
    spark = table.sparkSession
    fields = ["doc_id", "n_words", "n_features", "weight", "score"]
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    path = new_dir(spark, "ranges")
    # The row's number in the stored table tells equal rows apart and spreads them.
    order = [F.col("score").desc(), "doc_id", "n_features", "weight", "row"]
    (
        table.filter(able).select(*fields, F.monotonically_increasing_id().alias("row"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*fields, F.monotonically_increasing_id().alias("at"))
        .write.parquet(path)
    )
    ranges = spark.read.schema(", ".join(f"{f} long" for f in [*fields, "at"])).parquet(path)
    part = F.shiftright("at", 33)
    sizes = sorted(
        (r["part"], r["count"]) for r in ranges.groupBy(part.alias("part")).count().collect()
    )  # a row for each range
    before, total = {}, 0
    for number, count in sizes:
        before[number], total = total, total + count
    drawn = percent * total // 100
    starts = spark.createDataFrame(list(before.items()), "part long, before long")
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    placed = ranges.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rank", rank)
    of_able = placed.select(*fields, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    rest = table.filter(~F.coalesce(able, F.lit(False))).select(*fields, F.lit(None).cast("bigint").alias("rank"))
    return of_able.unionByName(rest)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Every document with n_features, weight, score, and its rank if it is drawn."""
    spark = docs.sparkSession
    ship(spark)
    path = new_dir(spark, "buckets")
    bucketed(docs, buckets).write.parquet(path)
    stored = spark.read.parquet(path)
    gain = gains(histogram(stored, buckets), histogram(bucketed(target, buckets, None), buckets))
    path = new_dir(spark, "scores")
    scored(weighted(stored, gain), seed).write.parquet(path)
    return ranked(spark.read.parquet(path), least_words, percent).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )
