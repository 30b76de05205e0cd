"""Texts made to share the codes by which they are looked up."""

from __future__ import annotations

from uuid import uuid4

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazeline.llm import components, jaccard_groups, lexicon, packing, token_blocks
from hazeline.llm.chunked import _powers, cut, library_encoder
from hazeline.llm.shingles import shingled
from hazeline.llm.suffix_dedup import joined

BPE = public_tokenizers.path("byte_bpe_50k.json")


def _thue_morse(a: str, b: str, size: int = 1024) -> str:
    return "".join(b if bin(i).count("1") % 2 else a for i in range(size))


ONE, TWO = _thue_morse("a", "b"), _thue_morse("b", "a")
TEXTS = [ONE, TWO, f"so {TWO} and {ONE} here", f"so {ONE} and {TWO} here", TWO, "", "plain words"]


def _bytes(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    return data, np.cumsum([0, *[len(t.encode()) for t in texts]])


def _ids(text):
    return Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids


def test_the_two_words_share_a_code():
    _, _, codes, _ = cut(*_bytes([ONE, TWO]), [])
    assert codes[0] == codes[1]


@pytest.mark.parametrize("order", [TEXTS, TEXTS[::-1]])
def test_encoders_compare_bytes(order):
    for encoder in (library_encoder(BPE), lexicon.lexicon_encoder(BPE, None)[0]):
        for texts in (order, order[1:], order):  # what was learned, and what was not
            ids, sizes = encoder.encode(*_bytes(texts))
            ends = np.cumsum(sizes)
            for text, begin, end in zip(texts, ends - sizes, ends):
                assert ids[begin:end].tolist() == _ids(text)
        encoder.forget()


def test_operators_compare_bytes(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(1)
    wanted = {i: _ids(t) for i, t in enumerate(TEXTS)}
    for r in token_blocks.read_tokens(spark, token_blocks.write_tokens(docs, BPE)).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == [*wanted[r["doc_id"]], 2]
    for r in lexicon.encode(docs, BPE, None).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == wanted[r["doc_id"]]
    for r in packing.pack(docs, BPE).collect():
        own = [*wanted[r["doc_id"]], 0][r["start"] : r["start"] + r["length"]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == own
    found = {r["doc_id"]: r["component_id"] for r in jaccard_groups.linked(docs).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 3, 4: 1, 5: 5, 6: 6}


def test_shingles_tell_the_words_apart():
    codes, _ = shingled(*_bytes([ONE, TWO, _thue_morse("é", "ß", 2048), _thue_morse("ß", "é", 2048)]), 4)
    assert len(set(codes.tolist())) == 4


def test_spans_of_many_documents_are_joined():
    count = (1 << 23) + 3
    doc = np.arange(count)
    start, end = np.full(count, 5), np.full(count, 5 + (1 << 20))
    found = joined(doc, start, end)
    assert len(found[0]) == count and found[1].min() == 5 and found[2].min() == found[2].max() == 5 + (1 << 20)


def _jaccard_brute(texts, words, percent):
    def shingle_set(text):
        w = text.split()
        return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()

    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_groups_with_one_prefix_and_crowds_below_the_threshold(spark, seed):
    """Families of one text with ends changed (one prefix often), and with shares just below t."""
    draw = np.random.default_rng(seed)
    texts = []
    for family in range(4):
        base = [f"{family}w{k}" for k in range(60)]
        common = [f"line{k}" for k in range(30)]
        for _ in range(40):
            own = list(base)
            for _ in range(int(draw.integers(0, 5))):
                own[int(draw.integers(0, 60))] = f"x{int(draw.integers(0, 9))}"
            texts.append(" ".join([*common, *own] if draw.integers(0, 2) else [*own, *common]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for words, percent in ((4, 85), (5, 80)):
        found = {r["doc_id"]: r["component_id"] for r in jaccard_groups.linked(docs, words, percent).collect()}
        assert [found[i] for i in range(len(texts))] == _jaccard_brute(texts, words, percent)


def test_each_text_moves_once_to_be_verified(spark):
    """Thirty texts with all their 435 pairs, and a pair of its own."""
    several = [(i, j) for i in range(30) for j in range(i + 1, 30)] + [(40, 41)]
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)] + [(None, "none"), (3, None)], "doc_id long, text string")
    pairs = spark.createDataFrame(several, "a long, b long")
    sizes = spark.createDataFrame([(i, 100) for i in range(60)], "rep long, n long")
    for most, cells in ((100_000, 2), (1000, None)):
        rows = jaccard_groups.with_texts(jaccard_groups.celled(pairs, sizes, most), docs).collect()
        texts = {(r["cell"], r["a"]): r["text"] for r in rows if r["b"] is None}
        assert len(texts) == sum(r["b"] is None for r in rows)
        paired = [(r["cell"], r["a"], r["b"]) for r in rows if r["b"] is not None]
        assert sorted((a, b) for _, a, b in paired) == several
        # Both texts of a pair are where it is, and no others.
        assert {key for c, a, b in paired for key in ((c, a), (c, b))} == set(texts)
        assert all(text == f"text {i}" for (_, i), text in texts.items())
        if cells:
            assert len({c for c, _ in texts}) == cells and len(texts) == 32
        else:
            # 3000 shingles in three blocks: no cell has more texts than two blocks have.
            assert len({c for c, _ in texts}) > 2 and max(sum(c == d for d, _ in texts) for c, _ in texts) < 30


def test_waiting_workers_remember_no_chunks(spark):
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(64)], "doc_id long, text string")

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([library_encoder(BPE).n]), pa.array([_powers.cache_info().currsize])], names=["n", "powers"])

    for _ in range(2):
        assert packing.pack(docs.repartition(8), BPE).count() >= 64
        rows = docs.repartition(8).mapInArrow(held, "n long, powers long").collect()
        assert rows and {(r["n"], r["powers"]) for r in rows} == {(0, 0)}


def _jobs(spark, run):
    """What run() returns, and how many jobs it took."""
    context = spark.sparkContext
    context.setJobGroup(group := uuid4().hex, "counted")
    try:
        found = run()
        return found, len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)


def test_components_take_few_jobs(spark):
    """A path in mixed order, two chains that meet at their greatest node, a clique, a star, copies, nulls."""
    draw = np.random.default_rng(3)
    path = draw.permutation(300).tolist()
    links = list(zip(path, path[1:])) + [(1000 + i, 1002 + i) for i in range(80)] + [(1080, 1081)]
    links += [(2000 + i, 2000 + j) for i in range(25) for j in range(i)] + [(3000 + i, 3199) for i in range(200)]
    links += [(4001, 4001), (4003, 4002), (4002, 4003), (None, 4004), (4005, None), (-5, 4006)]
    frame = spark.createDataFrame(links, "u long, v long").repartition(6)
    rows, jobs = _jobs(spark, lambda: components.components(frame).collect())
    wanted = {i: 0 for i in range(1, 300)} | {i: 1000 for i in range(1001, 1082)} | {i: 2000 for i in range(2001, 2025)}
    wanted |= {i: 3000 for i in range(3001, 3200)} | {4003: 4002, 4006: -5}
    assert len(rows) == len(wanted) and {r["u"]: r["v"] for r in rows} == wanted
    assert jobs <= 60, jobs


def test_lots_of_links_hang_a_node_once():
    """Links in order of u, cut into lots in the middle of a node's links."""
    links = [(9, 1), (9, 2), (9, 3), (9, 4), (10, 4), (10, 5), (11, 9)]
    batches = [pa.RecordBatch.from_pylist([{"u": u, "v": v} for u, v in links[i : i + 2]]) for i in range(0, 7, 2)]
    held, components.HELD = components.HELD, 2
    try:
        out = [tuple(r.values()) for batch in components._forests(iter(batches)) for r in batch.to_pylist()]
    finally:
        components.HELD = held
    assert sorted(u for u, _ in out if u > 8) == [9, 10, 11] and all(u > v for u, v in out)
    u, v = components.forest(*(np.array(c) for c in zip(*out)))
    assert dict(zip(u.tolist(), v.tolist())) == {i: 1 for i in (2, 3, 4, 5, 9, 10, 11)}


def test_workers_get_texts_in_small_lots(spark, monkeypatch):
    name, seen, verified = "spark.sql.execution.arrow.maxBytesPerBatch", [], jaccard_groups._verified

    def watched(*given):
        seen.append(spark.conf.get(name))
        return verified(*given)

    monkeypatch.setattr(jaccard_groups, "_verified", watched)
    before = spark.conf.get(name, None)
    texts = [" ".join([*(f"w{i // 2}.{k}" for k in range(20)), f"x{i % 2}"]) for i in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, jobs = _jobs(spark, lambda: jaccard_groups.linked(docs, 4, 85).collect())
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i // 2 * 2 for i in range(8)}
    assert set(seen) == {"2m"} and spark.conf.get(name, None) == before
    assert jobs <= 150, jobs


def test_long_sets_have_to_meet_twice(spark):
    rows = [
        (7, 1, 300, 3), (7, 2, 310, 5),  # once
        (8, 3, 300, 3), (8, 4, 310, 5), (9, 3, 300, 6), (9, 4, 310, 9),  # twice
        (8, 5, 240, 3), (7, 6, 240, 2), (7, 5, 240, 4),  # 5 meets 3 and 4 once, 1 and 2 once, 6 once, all by the lesser
    ]
    frame = spark.createDataFrame(rows, "token long, gid long, n int, place int").selectExpr(
        "*", "gid AS low", "gid AS high", "false AS mixed"
    ).withColumn("coarse", F.lit(jaccard_groups._NO_BOUND))
    pairs = jaccard_groups.crossing_groups(jaccard_groups.with_earlier(frame), 75, 4).collect()
    assert sorted((r["a"], r["b"]) for r in pairs) == [(1, 5), (1, 6), (2, 5), (2, 6), (3, 4), (3, 5), (4, 5), (5, 6)]


@pytest.mark.parametrize("first_round", [True, False])
def test_links_of_long_texts_near_the_threshold(spark, monkeypatch, first_round):
    """Sets of 230 to 2,300 shingles in families whose shares lie about t; without the first round
    every link has to be found by the second."""
    if not first_round:
        monkeypatch.setattr(
            jaccard_groups, "neighbour_pairs", lambda rows, *_: spark.createDataFrame([], "a long, b long")
        )
    draw = np.random.default_rng(5)
    texts = []
    for family, size in enumerate((235, 252, 258, 270, 400, 1100, 2300)):
        base = [f"{family}w{k}" for k in range(size)]
        for share in draw.uniform(0.005, 0.06, 9):
            own = list(base)
            for at in draw.integers(0, size, max(1, int(share * size))).tolist():
                own[at] = f"x{int(draw.integers(0, 10**6))}"
            texts.append(" ".join(own[: size - int(draw.integers(0, size // 12))]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for words, percent in ((4, 85), (5, 80)):
        found = {r["doc_id"]: r["component_id"] for r in jaccard_groups.linked(docs, words, percent).collect()}
        assert [found[i] for i in range(len(texts))] == _jaccard_brute(texts, words, percent)
        assert 7 < len(set(found.values())) < len(texts)


def test_sketches_of_long_sets_tell_strangers():
    """Strangers of 10,000 shingles are out of reach; no bound is below the overlap."""
    draw = np.random.default_rng(3)

    def sketch(codes):
        most = jaccard_groups.sketch_classes(len(codes))
        return np.bincount(codes % most, minlength=most).astype("<u1").tobytes()

    codes = draw.choice(10**9, 30_000, replace=False)
    sets = [codes[:10_000], codes[10_000:20_000], codes[1_000:9_000], codes[5_000:6_000], codes[:100]]
    for one in sets:
        for two in sets:
            n, m = np.array([len(one)]), np.array([len(two)])
            bound = jaccard_groups.sketched_overlap([sketch(one)], n, [sketch(two)], m)[0]
            assert bound >= len(np.intersect1d(one, two))
    n = np.array([10_000])
    stranger = jaccard_groups.sketched_overlap([sketch(sets[0])], n, [sketch(sets[1])], n)
    assert stranger[0] < jaccard_groups.least_overlap(n, n, 80)[0]
