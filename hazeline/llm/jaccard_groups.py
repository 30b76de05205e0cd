"""N-gram Jaccard join by groups with a common prefix.

Shingles stand in one order for all documents: those of crowded hash classes last, else by
code. Two sets with a Jaccard similarity of t or more share k shingles among the first
n - ceil(t * n) + k of each, their prefixes. k is 2 for long sets, which often meet by chance once
but hardly ever twice, else 1; a pair goes by the k of its lesser set.

1. Count the hash classes of all shingles; classes far above the mean are crowded.
2. Per document: size of its set, keys of the set and of the prefix, the prefix, and a sketch
   (how many shingles fall in each of 128 classes, or of more for a long set, so that a class has
   few; the sums of the lesser counts bound the overlap from above).
3. Documents with one set become one; sets with one prefix and one size become a group.
4. Groups meet at the shingles of their prefixes. Size and place in the prefix bound the
   overlap; pairs of groups that can't reach t are dropped. At first each group is paired with
   four neighbours in each of 64 orders only, which is linear in the prefixes.
5. What the sketches allow is verified on the sets themselves. Pairs that hang together are
   verified in one place, to which each text moves once, however many pairs name it.
6. The links found give components. Then all other pairs of groups that meet and don't lie in
   one component are taken, without limit, each at the first k shingles the two share; a row
   carries the last few meeting shingles before its own to tell, and a small sketch of the
   set that drops most pairs out of reach where they meet. Pairs that met less than k times are
   dropped. Only the pairs left are
   expanded to their members, and members of different components verified: no link between
   components is lost, and pairs inside one component change nothing.

Shingles in a group of copies are met once, not once for each pair of copies. Nothing is
gathered on the driver but the list of crowded classes and a bit map of fixed size.

Shingles are told apart by 63 bits, in prefixes and in verification.

Defined results: a null or empty text, or one without words, has no shingles, is linked with
nothing and is its own component; fewer words than a shingle has are one shingle; repeated
rows with one doc_id are one document if their texts agree, else each text stands for the id
and what links any of them links the id; a null doc_id is dropped from links and has a null
component; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.bind import free_name
from hazeline.llm.chunked import slices
from hazeline.llm.components import components
from hazeline.llm.id_map import IdMap
from hazeline.llm.memory import released
from hazeline.llm.shingles import _mixed, distinct, shingled
from hazeline.llm.shipping import ship
from hazeline.scratch import discard, new_dir
from hazeline.session import settings

CLASS_BITS = 22
CROWDED = 4.0  # times the mean count of a class
LONG = 256  # shingles of a set that has to meet another twice
SKETCH = 128
CLASS_SHINGLES = 8  # of a set in a class of its sketch, at most, on average
COARSE = 64  # classes of the small sketch that prefix rows carry, four bits each
ORDERS = 64
NEIGHBOURS = (1, 2, 3, 7)  # how far on, in each order
EARLIER = 4  # meeting shingles before its own that a row carries
TASK_ROWS = 1_000_000  # prefix shingles to a task
# Texts and rows go to the Python workers in lots of so many bytes; a worker holds several copies of one.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m"}
CELL_SHINGLES = 4_000_000  # of sets verified together, before they are cut into blocks
_LAST = np.uint64(1) << np.uint64(63)
_NO_BOUND = b"\xff" * (COARSE // 2)  # in place of a small sketch: counts that don't fit, or several sets


def _stored(df: DataFrame, label: str, paths: list[str]) -> DataFrame:
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    paths.append(path)
    return df.sparkSession.read.parquet(path)


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that sets of these sizes have to share: the least o with o / (a + b - o) >= t."""
    return -(-percent * (a + b) // (100 + percent))


def meetings(n):
    """Shingles that a set of so many has to share with a larger one among their prefixes."""
    return 1 + (n >= LONG)


def sketch_classes(n: int) -> int:
    """Classes of the sketch of a set of so many: SKETCH times a power of two."""
    return SKETCH << max(0, -(-n // (SKETCH * CLASS_SHINGLES)) - 1).bit_length()


def crowded_classes(docs: DataFrame, words: int) -> np.ndarray:
    """Which of the 2**CLASS_BITS classes of shingle codes are crowded."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CLASS_BITS, np.int32)
        for batch in batches:
            for _, data, offsets in slices(batch.column("text")):
                codes, _ = shingled(data, offsets, words)
                classes, n = np.unique(codes >> np.uint64(63 - CLASS_BITS), return_counts=True)
                total[classes.astype(np.int64)] += n.astype(np.int32)
        # A class crowded in the whole is crowded in some task; a task passes on those that stand
        # out in its own share, and the sum of all. A class missed costs time, never a link.
        mean = total.mean()
        out = np.flatnonzero(total > max(2 * mean, mean + 4 * mean**0.5, 3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(out, -1)), pa.array(np.append(total[out].astype(np.int64), total.sum()))], names=["class", "n"]
        )

    paths: list[str] = []
    counts = docs.select("text").mapInArrow(released(count), "class long, n long").groupBy("class").agg(F.sum("n").alias("n"))
    counts = _stored(counts, "counts", paths)  # read twice below
    crowded = np.zeros(1 << CLASS_BITS, bool)
    whole = counts.filter("class = -1").first()
    if whole is not None and whole["n"]:
        limit = max(CROWDED * whole["n"] / (1 << CLASS_BITS), 8.0)
        # At most 2**CLASS_BITS / CROWDED classes can be above the limit.
        for row in counts.filter((F.col("class") >= 0) & (F.col("n") > limit)).select("class").collect():
            crowded[row["class"]] = True
    discard(docs.sparkSession, paths[0])
    return crowded


def _key(values: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a list of codes from others, as two signed numbers."""
    place = np.arange(1, len(values) + 1, dtype=np.uint64)
    one = _mixed(values + place * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    two = _mixed(values ^ (place * np.uint64(0xD1B54A32D192ED03))).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def described(docs: DataFrame, words: int, percent: int, crowded: np.ndarray) -> DataFrame:
    """Step 2: a row for each document."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(crowded).tobytes())  # 512 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
        for batch in batches:
            for start, data, offsets in slices(batch.column("text")):
                codes, sizes = shingled(data, offsets, words)
                last = table[(codes >> np.uint64(63 - CLASS_BITS)).astype(np.int64)]
                codes, sizes = distinct(np.where(last, codes | _LAST, codes), sizes)
                ends = np.cumsum(sizes)
                columns: list[list] = [[] for _ in range(8)]
                for n, end in zip(sizes.tolist(), ends.tolist()):
                    own = codes[end - n : end]
                    prefix = own[: n - -(-percent * n // 100) + meetings(n)] if n else own
                    most = sketch_classes(n)
                    sketch = np.bincount((own & np.uint64(most - 1)).astype(np.int64), minlength=most)
                    # A byte for each count where all fit, else four.
                    kind = "<u1" if sketch.max(initial=0) < 256 else "<u4"
                    coarse = sketch.reshape(-1, COARSE).sum(axis=0)
                    row = (
                        n, *_key(own), *_key(prefix), prefix.tobytes(), sketch.astype(kind).tobytes(),
                        (coarse[0::2] | coarse[1::2] << 4).astype("<u1").tobytes() if coarse.max() < 15 else _NO_BOUND,
                    )
                    for column, value in zip(columns, row):
                        column.append(value)
                kinds = [pa.int64()] * 5 + [pa.binary()] * 3
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(sizes))]
                    + [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "n", "set_a", "set_b", "pre_a", "pre_b", "prefix", "sketch", "coarse"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        released(run),
        "doc_id long, n long, set_a long, set_b long, pre_a long, pre_b long, prefix binary, sketch binary, "
        "coarse binary",
    )


def _near(n1, p1, n2, p2, percent: int, before=0) -> np.ndarray:
    """Whether sizes n1 <= n2 that meet at places p1, p2 of their prefixes can reach t, if they met
    `before` times already."""
    most = before + np.minimum(n1 - p1, n2 - p2)
    return (100 * n1 >= percent * n2) & (most >= least_overlap(n1, n2, percent))


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """All rows of a task by token, then size and group; and where the runs of a token begin."""
    held = [[batch.column(name).to_numpy(zero_copy_only=False) for name in names] for batch in batches]
    if not held:
        return [np.zeros(0, np.int64) for _ in names], np.zeros(1, np.int64)
    columns = [np.concatenate(c) for c in zip(*held)]
    order = np.lexsort((columns[1], columns[2], columns[0]))
    columns = [c[order] for c in columns]
    token = columns[0]
    begins = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
    return columns, np.append(begins, len(token))


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    low, high = np.minimum(a, b), np.maximum(a, b)
    both = np.unique(np.stack([low, high], axis=1), axis=0) if len(low) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def meeting_rows(groups: DataFrame, parts: int) -> DataFrame:
    """token, gid, n, place: prefix shingles that two groups or more have."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                prefixes = [np.frombuffer(p, np.int64) for p in part.column("prefix").to_pylist()]
                sizes = np.fromiter(map(len, prefixes), np.int64, len(prefixes))
                token = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
                place = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token),
                        pa.array(np.repeat(part.column("gid").to_numpy(), sizes)),
                        pa.array(np.repeat(part.column("n").to_numpy(), sizes).astype(np.int32)),
                        pa.array(place.astype(np.int32)),
                    ],
                    names=["token", "gid", "n", "place"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, begins = _runs(batches, ["token", "gid", "n", "place"])
        keep = np.repeat(np.diff(begins) > 1, np.diff(begins))
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[keep]) for c in columns], names=["token", "gid", "n", "place"]
            )

    schema = "token long, gid long, n int, place int"
    return groups.select("gid", "n", "prefix").mapInArrow(released(spread), schema).repartition(parts, "token").mapInArrow(
        released(meet), schema
    )


def neighbour_pairs(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """Each group with its neighbours at each token, in one of ORDERS orders of the groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (token, gid, n, place), _ = _runs(batches, ["token", "gid", "n", "place"])
        # A pair of one size can only meet early in the prefix; late rows wait for step 6.
        early = n - place >= least_overlap(n, n, percent)
        token, gid, n, place = (c[early] for c in (token, gid, n.astype(np.int64), place.astype(np.int64)))
        turn = token.astype(np.uint64) % np.uint64(ORDERS)
        mixed = _mixed(gid.astype(np.uint64) * np.uint64(ORDERS) + turn)
        order = np.lexsort((mixed, token))
        token, gid, n, place = (c[order] for c in (token, gid, n, place))
        low, high = [], []
        for step in NEIGHBOURS:
            i = np.flatnonzero(token[step:] == token[:-step])
            swap = n[i] > n[i + step]
            small, large = np.where(swap, i + step, i), np.where(swap, i, i + step)
            ok = _near(n[small], place[small], n[large], place[large], percent)
            low.append(gid[small[ok]])
            high.append(gid[large[ok]])
        yield _pairs(np.concatenate(low), np.concatenate(high))

    return rows.repartition(parts, "token").mapInArrow(released(run), "a long, b long").distinct()


def with_earlier(rows: DataFrame) -> DataFrame:
    """Adds `earlier`: the group's meeting shingles that stand before this one, the last few;
    none where `mixed` says that two groups go by one id."""
    before = Window.partitionBy("gid").orderBy("place").rowsBetween(-EARLIER, -1)
    return rows.withColumn("earlier", F.collect_list(F.when(~F.col("mixed"), F.col("token"))).over(before))


def _shared_earlier(earlier: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many shingles two rows carry in common; absent ones are none."""
    out = np.zeros(len(i), np.int64)
    for low in range(0, len(i), 50_000):
        one, two = earlier[i[low : low + 50_000]], earlier[j[low : low + 50_000]]
        same = (one[:, :, None] == two[:, None, :]) & (one[:, :, None] >= 0)
        out[low : low + 50_000] = same.sum(axis=(1, 2))
    return out


def _most_shared(coarse: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Upper bounds of overlaps, from the small sketches of two rows."""
    out = np.empty(len(i), np.int64)
    for low in range(0, len(i), 50_000):
        one, two = coarse[i[low : low + 50_000]], coarse[j[low : low + 50_000]]
        shared = np.minimum(one & 15, two & 15) + np.minimum(one >> 4, two >> 4)
        out[low : low + 50_000] = shared.sum(axis=1, dtype=np.int64)
    return out


def crossing_groups(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """All pairs of groups that meet often enough and whose members are not all of one component;
    rows have the least and the greatest component of the group, `low` and `high`, `earlier` and
    `coarse`."""

    def counted(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        a, b, need = (np.concatenate(c) for c in zip(*held))
        met = np.stack([np.minimum(a, b), np.maximum(a, b), need], axis=1)
        met, times = np.unique(met, axis=0, return_counts=True) if len(met) else (met, np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays([*map(pa.array, met.T), pa.array(times)], names=["a", "b", "need", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "gid", "n", "place", "low", "high", "coarse", *(f"e{k}" for k in range(EARLIER))]
        columns, begins = _runs(batches, names)
        _, gid, n, place, least, greatest = columns[:6]
        coarse = np.frombuffer(b"".join(columns[6].tolist()), "<u1").reshape(-1, COARSE // 2)
        free = (coarse == 255).all(axis=1)
        earlier = np.stack(columns[7:], axis=1)
        n, place = n.astype(np.int64), place.astype(np.int64)
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for begin, end in zip(begins[:-1].tolist(), begins[1:].tolist()):
            if (least[begin:end] == least[begin]).all() and (greatest[begin:end] == least[begin]).all():
                continue
            # Ascending sizes: a row's partners are those behind it up to n / t.
            reach = np.searchsorted(n[begin:end], 100 * n[begin:end] // percent, "right") + begin
            for low in range(begin, end, 512):
                high = min(low + 512, end)
                i = np.arange(low, high)[:, None]
                j = np.arange(low + 1, int(reach[high - begin - 1]))[None, :]
                ok = (j > i) & ((least[i] != greatest[j]) | (greatest[i] != least[j]))
                i, j = (x[ok] for x in np.broadcast_arrays(i, j))
                # The lesser set comes first. None of its first `need` meetings is left out here.
                ok = _near(n[i], place[i], n[j], place[j], percent, meetings(n[i]) - 1)
                i, j = i[ok], j[ok]
                ok = free[i] | free[j] | (_most_shared(coarse, i, j) >= least_overlap(n[i], n[j], percent))
                i, j = i[ok], j[ok]
                need = meetings(n[i])
                first = _shared_earlier(earlier, i, j) < need
                held.append((gid[i[first]], gid[j[first]], need[first]))
                count += len(held[-1][0])
                if count > 1_000_000:
                    yield counted(held)
                    held, count = [], 0
        if held:
            yield counted(held)

    # Codes are never negative but for crowded shingles; absent ones are -1 once shifted.
    carried = [
        F.coalesce(F.get("earlier", F.lit(k)).bitwiseAND(F.lit((1 << 63) - 1)), F.lit(-1).cast("bigint")).alias(f"e{k}")
        for k in range(EARLIER)
    ]
    flat = rows.select("token", "gid", "n", "place", "low", "high", "coarse", *carried)
    met = flat.repartition(parts, "token").mapInArrow(released(run), "a long, b long, need long, times long")
    # Two groups that go by one id may differ in need.
    often = met.groupBy("a", "b").agg(F.min("need").alias("need"), F.sum("times").alias("times")).filter("times >= need")
    return often.select("a", "b")


def _counts(sketch: bytes, n: int) -> np.ndarray:
    return np.frombuffer(sketch, "<u1" if len(sketch) == sketch_classes(n) else "<u4")


def sketched_overlap(one: list[bytes], n: np.ndarray, two: list[bytes], m: np.ndarray) -> np.ndarray:
    """Upper bounds of overlaps, from the sketches of sets of sizes n and m."""
    out = np.empty(len(one), np.int64)
    small = np.array([len(s) == len(t) == SKETCH for s, t in zip(one, two)], bool)
    some = np.flatnonzero(small).tolist()
    s, t = (np.frombuffer(b"".join(side[i] for i in some), "<u1").reshape(-1, SKETCH) for side in (one, two))
    out[small] = np.minimum(s, t).sum(axis=1, dtype=np.int64)
    for i in np.flatnonzero(~small).tolist():
        s, t = _counts(one[i], int(n[i])), _counts(two[i], int(m[i]))
        # The finer one is brought to the classes of the other.
        width = min(len(s), len(t))
        s, t = (c.reshape(-1, width).sum(axis=0, dtype=np.int64) if len(c) > width else c for c in (s, t))
        out[i] = np.minimum(s, t).sum(dtype=np.int64)
    return out


def _promising(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups expanded to their members (gid, rep, label, n, sketch): those of different
    labels that their sketches let reach t."""
    one = members.select(F.col("gid").alias("a"), *[F.col(c).alias(f"{c}_u") for c in ("rep", "label", "n", "sketch")])
    two = members.select(F.col("gid").alias("b"), *[F.col(c).alias(f"{c}_v") for c in ("rep", "label", "n", "sketch")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            s, t = (batch.column(c).to_pylist() for c in ("sketch_u", "sketch_v"))
            n, m = batch.column("n_u").to_numpy(), batch.column("n_v").to_numpy()
            ok = sketched_overlap(s, n, t, m) >= least_overlap(n, m, percent)
            yield _pairs(batch.column("rep_u").to_numpy()[ok], batch.column("rep_v").to_numpy()[ok])

    apart = pairs.join(one, "a").join(two, "b").filter("label_u <> label_v")
    return apart.select("rep_u", "rep_v", "n_u", "n_v", "sketch_u", "sketch_v").mapInArrow(released(run), "a long, b long").distinct()


def celled(pairs: DataFrame, sizes: DataFrame, most: int = CELL_SHINGLES, paths: list[str] | None = None) -> DataFrame:
    """a, b, cell: pairs that hang together lie in one cell, so that each set moves once and not once
    for each of its pairs. Of those with more than `most` shingles (sizes: rep, n) the sets fall into
    blocks, and a cell holds the pairs of two blocks. Written once; `paths` gets the folders."""
    paths = [] if paths is None else paths
    near = components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    named = ids.join(near.select(F.col("u").alias("id"), F.col("v").alias("label")), "id", "left").select(
        "id", F.coalesce("label", "id").alias("label")
    )
    of = sizes.groupBy(F.col("rep").alias("id")).agg(F.sum("n").alias("n"))
    blocks = named.join(of, "id").groupBy("label").agg(F.ceil(F.sum("n") / most).alias("blocks"))
    placed = named.join(blocks, "label").select("id", "label", F.pmod(F.xxhash64("id"), "blocks").alias("block"))
    placed = _stored(placed, "placed", paths)
    one, two = (
        placed.select(F.col("id").alias(side), F.col("block").alias(f"block_{side}"), F.col("label").alias(f"label_{side}"))
        for side in ("a", "b")
    )
    cells = pairs.join(one, "a").join(two, "b").select(
        "a", "b", F.xxhash64("label_a", F.least("block_a", "block_b"), F.greatest("block_a", "block_b")).alias("cell")
    )
    return _stored(cells, "cells", paths)


def with_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """cell, a, b, text: the pairs, and for each cell the texts (b null) that its pairs name."""
    wanted = pairs.select(F.col("a").alias("doc_id"), "cell").union(pairs.select(F.col("b").alias("doc_id"), "cell")).distinct()
    known = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    marked = known.filter(IdMap(wanted, "doc_id").maybe(F.col("doc_id"))).join(wanted, "doc_id")
    return pairs.select("cell", "a", "b", F.lit(None).cast("string").alias("text")).union(
        marked.select("cell", "doc_id", F.lit(None).cast("bigint"), "text")
    )


def _alike(one: bytes, two: bytes, percent: int) -> bool:
    both = np.concatenate([np.frombuffer(one, "<u8"), np.frombuffer(two, "<u8")])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared > 0 and 100 * shared >= percent * (len(both) - shared)


def _verified(cells: DataFrame, docs: DataFrame, words: int, percent: int, parts: int) -> DataFrame:
    """Pairs whose sets reach t. Texts move, which take fewer bytes than their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[tuple[int, int], set[bytes]] = {}  # rows that repeat an id may have several
        for batch in batches:
            if not batch.num_rows:
                continue
            paired = batch.column("b").is_valid()
            some, rest = batch.filter(paired), batch.filter(pc.invert(paired))
            keys = list(zip(rest.column("cell").to_pylist(), rest.column("a").to_pylist()))
            for start, data, offsets in slices(rest.column("text")):
                codes, counts = distinct(*shingled(data, offsets, words))
                ends = np.cumsum(counts)
                for key, n, end in zip(keys[start:], counts.tolist(), ends.tolist()):
                    sets.setdefault(key, set()).add(codes[end - n : end].astype("<u8").tobytes())
            ok = [
                any(_alike(x, y, percent) for x in sets.get((cell, one), ()) for y in sets.get((cell, two), ()))
                for cell, one, two in zip(*(some.column(c).to_pylist() for c in ("cell", "a", "b")))
            ]
            yield some.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
            last = batch.column("cell")[-1].as_py()
            sets = {key: own for key, own in sets.items() if key[0] == last}

    # A cell's texts come before its pairs; one cell is held at a time.
    rows = with_texts(cells, docs).repartition(parts, "cell").sortWithinPartitions("cell", F.col("b").asc_nulls_first())
    return rows.mapInArrow(released(run), "a long, b long")


def linked(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (least document reached by links, itself included)."""
    with settings(docs.sparkSession, **BATCH):
        return _linked(docs, words, percent)


def _linked(docs: DataFrame, words: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    paths: list[str] = []
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    crowded = crowded_classes(docs, words)
    every = _stored(described(docs, words, percent, crowded), "described", paths)
    full = every.filter("n > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("set_a", "set_b", "n").agg(
        F.min("doc_id").alias("rep"), F.first("pre_a").alias("pre_a"), F.first("pre_b").alias("pre_b")
    )
    classes = _stored(classes, "classes", paths)
    group = ["n", "pre_a", "pre_b"]
    members = _stored(
        classes.groupBy(*group).agg(F.min("rep").alias("gid"), F.count(F.lit(1)).alias("members"))
        .join(classes, group)
        .select("gid", "rep", "n", "members", "set_a", "set_b", F.xxhash64(*group).alias("token")),
        "members", paths,
    )
    own = ["doc_id", "set_a", "set_b"]
    kept = full.join(members.select(F.col("rep").alias("doc_id"), "gid", "set_a", "set_b"), own)
    sketches = _stored(kept.select(F.col("doc_id").alias("rep"), "n", "sketch", "coarse").distinct(), "sketches", paths)
    heads = kept.filter("doc_id = gid").dropDuplicates(own)
    # A task gathers the rows of its shingles: as many tasks as keep them few.
    meeting = full.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    parts = max(parts, -(-meeting // (8 * TASK_ROWS)))
    rows = _stored(meeting_rows(heads, parts), "meeting", paths)
    # Members of a group meet at the group itself: they share all of a prefix.
    inside = members.filter("members > 1").select(
        "token", F.col("rep").alias("gid"), F.col("n").cast("int").alias("n"), F.lit(0).alias("place")
    )

    def links_of(wanted: DataFrame) -> DataFrame:
        wanted = _stored(wanted, "promising", paths)
        cells = celled(wanted, members.select("rep", "n"), paths=paths)
        links = _verified(cells, docs, words, percent, parts)
        return _stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "links", paths)

    first_pairs = _stored(neighbour_pairs(rows.union(inside), percent, parts), "pairs", paths)
    # At first every set is a group and a label of its own.
    alone = sketches.select(F.col("rep").alias("gid"), "rep", F.col("rep").alias("label"), "n", "sketch")
    tried = _promising(first_pairs, alone, percent)
    first = links_of(tried)
    near = components(first).select(F.col("u").alias("gid"), F.col("v").alias("label"))
    labelled = members.select("gid", "rep", "n", "token").join(near.withColumnRenamed("gid", "rep"), "rep", "left").select(
        "gid", "rep", "n", "token", F.coalesce("label", "rep").alias("label")
    )
    of_groups = labelled.join(sketches, ["rep", "n"])
    # The small sketch speaks for a group of one set only.
    spans = of_groups.groupBy("gid").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), (F.min("token") < F.max("token")).alias("mixed"),
        F.when(F.count(F.lit(1)) == 1, F.max("coarse")).otherwise(F.lit(_NO_BOUND)).alias("coarse"),
    )
    groups = crossing_groups(with_earlier(rows.join(spans, "gid")), percent, parts)
    # Members of a group meet at the group itself.
    torn = spans.filter("low <> high").select(F.col("gid").alias("a"), F.col("gid").alias("b"))
    crossing = _promising(groups.union(torn), of_groups, percent).join(first_pairs, ["a", "b"], "left_anti")
    second = links_of(crossing)
    same_set = full.join(classes.select("set_a", "set_b", "n", "rep"), ["set_a", "set_b", "n"]).filter(
        "doc_id <> rep"
    ).select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    final = components(first.union(second))
    # Documents with one set hang on its representative, which the links may take further.
    least = final.select(F.col("u").alias("rep"), F.col("v").alias("least"))
    copies = same_set.groupBy("u").agg(F.min("v").alias("rep")).join(least, "rep", "left").select(
        F.col("u").alias("doc_id"), F.coalesce("least", "rep").alias("component_id")
    )
    named = least.select(F.col("rep").alias("doc_id"), F.col("least").alias("component_id")).union(copies)
    ids = _stored(
        every.select("doc_id", F.col("n").alias("n_shingles"))
        .join(named.groupBy("doc_id").agg(F.min("component_id").alias("component_id")), "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id")),
        "components", [],
    )
    for path in paths:
        discard(spark, path)
    return ids


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of the least document of each component, with all their columns; rows without
    a doc_id stay, and of rows that repeat a doc_id one stays."""
    found = linked(docs, words, percent)
    rows = free_name(docs, "rows")
    stay = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias(rows))
    kept = docs.join(stay, "doc_id")
    single = kept.filter(F.col(rows) == 1).select(*docs.columns)
    repeated = kept.filter(F.col(rows) > 1).dropDuplicates(["doc_id"]).select(*docs.columns)
    return single.union(repeated).union(docs.filter("doc_id IS NULL"))
