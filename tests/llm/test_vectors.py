"""Top-k search, importance resampling and whitening against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from hazeline.llm import impact_index, importance, queries, whitening
from hazeline.scratch import new_dir

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, x long, key string"


def _table(spark, vectors, parts=3):
    rows = [(i, v, 0, 5, "clash") for i, v in vectors]
    return spark.createDataFrame(rows, VECTORS).repartition(parts)


def _whole(vector):
    if vector is None or any(c is None or not math.isfinite(c) for c in vector):
        return None
    return [math.floor(256 * float(np.float32(c))) for c in vector]


def _random(seed, rows, dims, spread=0.2):
    draw = np.random.default_rng(seed)
    return [(i, [float(c) for c in draw.normal(0, spread, dims).astype(np.float32)]) for i in range(rows)]


ODD = [
    (900, None), (901, []), (902, [None, 1.0]), (903, [float("nan")] * 4), (904, [float("inf"), 0.0]),
    (905, [-0.0] * 12), (906, [0.5, -0.25]), (None, [1.0] * 12), (950, [3.0] * 20), (1000, None),
]


def _top(vectors, k):
    known = [(i, _whole(v)) for i, v in vectors if i is not None and _whole(v) is not None]
    asks = {}
    for i, x in known:
        if i % 50 == 0:
            asks[i] = min(x, asks.get(i, x))
    out = set()
    for q, y in asks.items():
        scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, x in known if i != q)
        out |= {(q, rank, i, -score) for rank, (score, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("shard", [7, 64, 8192])
def test_search_equals_brute_force(spark, shard):
    draw = _random(1, 400, 12)
    # A third of the rows are one vector, so that ties fill whole lists; some ids repeat.
    vectors = [(i, draw[3][1] if i % 3 == 0 else v) for i, v in draw] + ODD + [(7, draw[9][1]), (8, draw[8][1])]
    table = _table(spark, vectors)
    path = new_dir(spark, "index")
    impact_index.build(table, path, shard=shard)
    found = impact_index.search(spark, path, table.filter("vec_id % 50 = 0"), k=5)
    rows = [tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(rows) == len(set((r[0], r[1]) for r in rows))
    assert set(rows) == _top(vectors, 5)


def test_search_of_few_rows_and_none(spark):
    vectors = [(50, [1.0, 2.0]), (1, [0.5, 0.5]), (100, [1.0, 2.0])]
    table = _table(spark, vectors)
    found = impact_index.nearest(table, table.filter("vec_id % 50 = 0"))
    assert {tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()} == _top(vectors, 5)
    nothing = spark.createDataFrame([], VECTORS)
    assert impact_index.nearest(nothing, nothing).count() == 0
    assert impact_index.nearest(table, nothing).count() == 0
    assert impact_index.nearest(nothing, table).count() == 0


def test_search_stops_on_proof_before_the_end():
    draw = np.random.default_rng(2)
    x = np.floor(256 * draw.normal(0, 0.125, (4000, 64))).astype(np.int64)
    x[100:105] = x[99] + draw.integers(-3, 4, (5, 64))
    shard = impact_index.Shard()
    for _, *row in impact_index.shard_rows(0, np.arange(4000), x.reshape(-1), np.full(4000, 64)):
        shard.add(*row)
    shard.ready()
    own = np.arange(4000) == 99
    members = shard.possible(own, x[99], 5)
    assert set(range(100, 105)) <= set(members.tolist()) and len(members) <= 4000 // impact_index.FEW
    # The proof holds without the segments near zero: an index cut short gives the same members.
    for cut in range(1, len(shard.levels)):
        short = impact_index.Shard()
        for name in ("step", "keys", "sizes", "values", "starts"):
            setattr(short, name, getattr(shard, name))
        short.levels = shard.levels[:cut]
        if len(left := short.possible(own, x[99], 5)) <= 4000 // impact_index.FEW:
            break
    assert cut < len(shard.levels) - 1 and np.array_equal(left, members)
    keys, scores = shard.best(99, x[99], 5)
    every = x @ x[99]
    every[99] = np.iinfo(np.int64).min
    assert scores.tolist() == np.sort(every)[::-1][:5].tolist()


def test_large_components_are_scored_exactly(spark):
    vectors = [(i, [float(2**20 + i * 1000), float(-(2**21) + i)] + [0.001] * 3) for i in range(60)]
    table = _table(spark, vectors)
    found = impact_index.nearest(table, table.filter("vec_id % 50 = 0"))
    assert {tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()} == _top(vectors, 5)


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _features(text):
    words = WORDS.findall((text or "").translate(LOWER))
    grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(g.encode()) % 10000 for g in grams]


def _resampled(docs, target, percent=25, least=20):
    corpus, wanted = Counter(), Counter()
    held = [(i, *_features(t)) for i, t in docs]
    for _, _, f in held:
        corpus.update(f)
    for t in target:
        wanted.update(_features(t)[1])
    s_all, t_all = sum(corpus.values()), sum(wanted.values())

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1.0) * (s_all + 10000.0) / ((corpus[b] + 1.0) * (t_all + 10000.0))))

    out = []
    for i, n, f in held:
        weight = sum(map(gain, f)) // len(f) if f else 0
        if i is None:
            out.append([i, len(f), weight, None, n])
            continue
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in out if r[3] is not None and r[4] >= least), key=lambda r: (-r[3], r[0], r[1], r[2]))
    rank = {id(r): at for at, r in enumerate(able[: percent * len(able) // 100], 1)}
    return Counter((*r[:4], rank.get(id(r))) for r in out)


DOCS = "doc_id long, text string, n_words long, bucket int, rank long, weight string"
LONG_WORD = "é" * 4000 + "z" * 9000


@pytest.mark.parametrize("seed", [0, 1])
def test_resampling_equals_brute_force(spark, seed):
    draw = np.random.default_rng(seed)
    pool = ["Alpha", "beta", "GAMMA", "x1", "日本", "é", "a_b", "c-d", "İ", "k" * 47, "k" * 48, "k" * 49, LONG_WORD, "straße"]
    docs = [(i, " \n"[i % 2].join(draw.choice(pool, int(draw.integers(0, 60))))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, " .,"), (None, "a b " * 30), (3, docs[3][1]), (3, docs[3][1]), (3, docs[4][1])]
    docs += [(1000 + i, docs[7][1]) for i in range(60)]
    target = [" ".join(draw.choice(pool[:6], 30)) for _ in range(5)] + [None, ""]
    table = spark.createDataFrame([(i, t, 1, 2, 3, "clash") for i, t in docs], DOCS).repartition(4)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resampled(table, wanted)
    names = ("doc_id", "n_features", "weight", "score", "rank")
    assert Counter(tuple(r[n] for n in names) for r in found.collect()) == _resampled(docs, target)


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(1, "a b c d", 1, 2, 3, "")], DOCS)
    assert importance.resampled(none, some).count() == 0
    row = importance.resampled(some, none, least_words=1, percent=100).first()
    assert (row["n_features"], row["rank"]) == (7, 1)


def test_resampling_of_the_smallest_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = queries.op12_importance_resampling(spark, SF)
    assert Counter(tuple(r) for r in found.collect()) == _resampled(docs, target)


def _fit(vectors):
    rows = [(i, x) for i, x in ((i, _whole(v)) for i, v in vectors) if x is not None]
    dims = max(len(x) for _, x in rows)
    rows = [(i, x + [0] * (dims - len(x))) for i, x in rows]
    return rows, np.array(sorted(set(tuple(x) for _, x in rows)), object)


def _check_whitened(rows, vectors, most=4):
    held, fit = _fit(vectors)
    n, total = len(fit), fit.sum(axis=0)
    covariance = np.array([[sum((n * a - s) * (n * b - t) for a, b in zip(x, y)) / n**3 for y, t in zip(fit.T, total)] for x, s in zip(fit.T, total)], float)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(most, int((values > 1e-12 * values[0]).sum()))
    assert len(rows) == k * len(held)
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    for c in range(1, k + 1):
        truth = (np.array([x for _, x in held], float) - (total / n).astype(float)) @ axes[:, c - 1] / math.sqrt(values[c - 1])
        by_id = {}
        for (i, _), w in zip(held, truth):
            by_id.setdefault(i, []).append(w)
        sign = 1 if sum((sorted(r["whitened"] for r in got[i][c])[0] - min(by_id[i])) ** 2 for i in by_id) < sum(
            (sorted(-r["whitened"] for r in got[i][c])[0] - min(by_id[i])) ** 2 for i in by_id
        ) else -1
        for i in by_id:
            assert np.allclose(sorted(sign * r["whitened"] for r in got[i][c]), sorted(by_id[i]), atol=1e-6)
    for r in rows:
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert math.isclose(r["explained"], values[r["component"] - 1] / values.sum(), rel_tol=1e-6)
    for i, x in held:
        far = sum((n * a - s) ** 2 for a, s in zip(x, total))
        assert far in [r["deviation"] for r in got[i][1]]


def test_whitening_equals_brute_force(spark):
    draw = _random(5, 300, 10)
    vectors = [(i, draw[2][1] if i % 3 == 0 else v) for i, v in draw]
    vectors += [v for v in ODD if v[0] != 950] + [(None, draw[4][1]), (7, draw[7][1]), (7, draw[8][1])]
    _check_whitened(whitening.whitened(_table(spark, vectors)).collect(), vectors)


def test_whitening_of_few_dimensions_and_none(spark):
    vectors = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]
    _check_whitened(whitening.whitened(_table(spark, vectors)).collect(), vectors)  # one component has any spread
    assert whitening.whitened(_table(spark, [(1, [1.0, 2.0])] * 4)).count() == 0
    assert whitening.whitened(_table(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whitened(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("top", [1, 300, 2**31, 2**62])
def test_cross_products_are_exact(top):
    x = np.random.default_rng(3).integers(-top, top + 1, (130, 7))
    sums, products = whitening.cross_products(x)
    wide = x.astype(object)
    assert sums.tolist() == wide.sum(axis=0).tolist()
    assert np.triu(products).tolist() == np.triu(wide.T @ wide).tolist()
