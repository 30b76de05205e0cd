"""Operators against brute force on small rows: nulls, empty and odd texts, ties, repeated
rows, clashing column names, empty tables; and on the smallest test tables."""

from __future__ import annotations

import hashlib
import random
import re
import tempfile
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazeline.llm import (
    jaccard_groups, lexicon, merkle, packing, pseudonyms, quality_rules, queries, secret_scan,
    suffix_dedup, token_blocks, warc_zip,
)
from hazeline.llm.induced import Sorter

BPE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, _rows long, n long"


def _prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 7))) for _ in range(words))


LONG = _prose(1, 9000)
BASE = _prose(2, 300)
WORDS = BASE.split(" ")
NEAR = " ".join([*WORDS[:150], "changed", *WORDS[151:]])
FAR = " ".join([*WORDS[:60], *_prose(3, 240).split(" ")])
TEXTS = [
    (1, None), (2, ""), (3, "one"), (4, "two words"), (5, BASE), (6, BASE), (7, NEAR), (8, FAR), (9, LONG),
    (10, "<|endoftext|> hi  there\n\n x's 12a\t"), (11, "日本語 …  é b  Ⅻ٣ \x1c z"), (12, " lead and trail "),
    (13, "a" * 700), (14, "ab" * 300), (15, "one"), (16, "x\n" + BASE[:150] + "\n" + BASE[:150]), (17, "é" * 90),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "clash", 7, 9) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    return {r["doc_id"]: r["text"] or "" for r in frame.collect()}


def _ids(text: str, tokenizer=Tokenizer.from_file(BPE)) -> np.ndarray:
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4")


def _check_bpe(rows, texts):
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts)
    wanted = dict(texts)
    for r in rows:
        assert np.array_equal(np.frombuffer(r["ids"], "<u4"), _ids(wanted[r["doc_id"]])), r["doc_id"]
        assert r["decoded"] == (wanted[r["doc_id"]] or "")


def test_lexicon_bpe(spark, docs, empty, small):
    name = lexicon.build_lexicon(docs, BPE, words=40)
    _check_bpe(lexicon.encode(docs, BPE, name).collect(), TEXTS)
    _check_bpe(lexicon.encode(docs, BPE, lexicon.build_lexicon(empty, BPE)).collect(), TEXTS)
    assert lexicon.encode(empty, BPE, name).count() == 0
    again = lexicon.build_lexicon(docs, BPE, words=40)  # equal contents, the same application
    _check_bpe(lexicon.encode(docs, BPE, again).collect(), TEXTS)
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    _check_bpe(lexicon.encode(frame, BPE, lexicon.build_lexicon(frame, BPE)).collect(), list(small.items()))


def test_automaton_is_minimal_and_numbers_words():
    words = sorted({b"tap", b"taps", b"top", b"tops", b"stop", b"stops", b"a"})
    parts = lexicon.compile_automaton(words)
    with tempfile.NamedTemporaryFile() as file:
        ids = np.arange(len(words))
        lexicon.Lexicon.write(file.name, words, ids, np.ones(len(words), np.int64))
        held = lexicon.Lexicon(file.name)
        assert held.numbers([*words, b"", b"ta", b"tapsx", b"zz"]).tolist() == [*range(len(words)), -1, -1, -1, -1]
    assert len(parts["final"]) < sum(map(len, words)) // 2  # endings are shared


def test_token_blocks(spark, docs, empty):
    report = token_blocks.write_tokens(docs, BPE, shard_ids=500)
    rows = sorted(token_blocks.read_tokens(spark, report).collect(), key=lambda r: r["doc_id"])
    start = 0
    for r, (i, text) in zip(rows, TEXTS, strict=True):
        wanted = np.append(_ids(text), 2).astype("<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (i, start, len(wanted))
        assert r["ids"] == wanted.tobytes()
        start += len(wanted)
    assert token_blocks.read_tokens(spark, token_blocks.write_tokens(empty, BPE)).count() == 0


@pytest.mark.parametrize("ids", [[], [5], [7] * 600, [0, 2**32 - 1] * 300, list(range(1000))])
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    blocks, starts = token_blocks.encode_blocks(ids)
    assert np.array_equal(token_blocks.decode_blocks(b"".join(blocks), starts.astype(np.int64))[: len(ids)], ids)


def _check_packs(rows, texts):
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        whole = np.append(_ids(dict(texts)[r["doc_id"]]), 0).astype("<u4")
        assert r["ids"] == whole[r["start"] : r["start"] + r["length"]].tobytes() and r["doc_tokens"] == len(whole)
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["length"], len(whole)))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert set(pieces) == {i for i, _ in texts}
    for parts in pieces.values():
        assert sum(length for _, length, _ in parts) == parts[0][2]


def test_packing(docs, empty):
    for cuts in (True, False):
        _check_packs(packing.pack(docs, BPE, cuts=cuts).collect(), TEXTS)
    assert packing.pack(empty, BPE).count() == 0


def test_differencing_balances_and_count_rises():
    windows = packing.differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in windows) == [14, 16]
    assert len(packing.pack_tails(np.array([600, 600, 600]), 1024, cuts=False)) == 3
    assert len(packing.pack_tails(np.array([600, 600, 600]), 1024, cuts=True)) == 2


def _removed(texts):
    seen, out = set(), {}
    for i, text in sorted(texts):
        data = (text or "").encode()
        keep = bytearray(b"\1" * len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                keep[p : p + 100] = bytes(100)
            seen.add(data[p : p + 100])
        out[i] = (bytes(x for x, k in zip(data, keep) if k), len([x for x in bytes(keep).split(b"\1") if x]))
    return out


def test_suffix_dedup(spark, docs, empty, small):
    for frame, texts in ((docs, TEXTS), (spark.read.parquet(f"{SF}/documents.parquet"), list(small.items()))):
        wanted = _removed(texts)
        rows = suffix_dedup.removed(frame).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert (bytes(r["_cut"]["kept"]), r["_cut"]["n_spans"]) == wanted[r["doc_id"]], r["doc_id"]
    assert suffix_dedup.removed(empty).count() == 0
    kept = {r["doc_id"]: r["text"] for r in suffix_dedup.deduplicated(docs).collect()}
    assert kept[5] == BASE and 6 not in kept and kept[1] is None and kept[2] == ""
    assert suffix_dedup.deduplicated(docs).columns == docs.columns


def test_repeated_rows_and_null_ids_are_no_copies(spark):
    rows = spark.createDataFrame([(1, BASE), (1, BASE), (None, BASE), (2, BASE)], "doc_id long, text string")
    left = sorted((str(r["doc_id"]), len(r["_cut"]["kept"])) for r in suffix_dedup.removed(rows).collect())
    size = len(BASE.encode())
    assert left == [("1", size), ("1", size), ("2", 0), ("None", size)]
    found = jaccard_groups.linked(rows, 4, 85).select("doc_id", "component_id").distinct().collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(1, 1), (2, 1), (None, None)}
    assert sorted(str(r["doc_id"]) for r in jaccard_groups.one_of_each(rows).collect()) == ["1", "None"]


@pytest.mark.parametrize("seed", range(12))
def test_induced_sorting(seed, tmp_path):
    draw = random.Random(seed)
    size, letters, limit = draw.choice([1, 40, 600]), draw.choice([1, 2, 20]), draw.choice([1, 50, 10**6])
    symbols = [draw.randint(1, letters) for _ in range(size)] * draw.choice([1, 3]) + [0]
    found = list(Sorter(str(tmp_path), 3000, limit).buckets(np.array(symbols, np.uint16)))[::-1]
    assert np.concatenate([p for p, _ in found]).tolist() == sorted(range(len(symbols) - 1), key=lambda i: symbols[i:])


def _components(texts, words, percent):
    sets = {}
    for i, text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    names = sorted(sets)
    for a in names:
        for b in names:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_group_jaccard(spark, docs, empty):
    rng = random.Random(5)
    crowd = [(1000 + k, " ".join(w if rng.random() > 0.012 else f"x{k}" for w in WORDS)) for k in range(60)]
    many = spark.createDataFrame(crowd, "doc_id long, text string").repartition(4)
    for frame, texts, words, percent in ((docs, TEXTS, 4, 85), (many, crowd, 5, 80)):
        rows = jaccard_groups.linked(frame, words, percent).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == _components(texts, words, percent)
    assert jaccard_groups.linked(empty).count() == 0
    assert jaccard_groups.one_of_each(docs).columns == docs.columns


def test_merkle(docs, empty):
    rows = {r["doc_id"]: r for r in merkle.compared(docs).collect()}
    order = sorted(rows, reverse=True)
    texts = {i: t or "" for i, t in TEXTS}
    for k, i in enumerate(order):
        text, follows = texts[i], texts[order[(k + 1) % len(order)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + follows[:third]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), i
        assert rows[i]["n_chars"] == len(text)
        assert 0 <= rows[i]["near_next"] <= 1 and 0 <= rows[i]["near_edited"] <= 1
        assert (rows[i]["fingerprint"] == rows[i]["edited_fingerprint"]) == (text == edited)
    assert rows[5]["fingerprint"] == rows[6]["fingerprint"] and rows[6]["near_next"] == 1.0
    assert rows[5]["fingerprint"] != rows[7]["fingerprint"]
    assert merkle.compared(empty).count() == 0


def test_merkle_edits_are_located(spark):
    lines = [f"line {k}\n" for k in range(40)]
    other = [*lines[:17], "new\n", *lines[18:]]
    frame = spark.createDataFrame([("".join(lines), "".join(other))], "a string, b string")
    a, b = merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))
    assert frame.select(merkle.edits(a, b).alias("e")).first()["e"] == [17]


def test_quality_rules(docs, empty):
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judged(docs).collect()}
    assert not kept[1] and not kept[2] and not kept[3] and not kept[13]
    assert quality_rules.judged(empty).count() == 0
    assert quality_rules.keep(docs).columns == docs.columns


def test_secrets(spark):
    key = "AKIA" + "Q7ZPL2M9X4B6N8V1"
    text = f'é password = "hunter22" {key} 0123456789abcdef01234567 secret: abc token: x9 zK3v9Qe7Rt5Yw1Ub8Ic2Op4A done'
    frame = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in secret_scan.digests(secret_scan.scanned(frame)).collect()}
    assert (rows[1]["n_assign"], rows[1]["n_access"], rows[1]["n_hex"]) == (1, 1, 1)
    at = text.index("zK3v9")
    assert f"entropy:{at}:{at + 24}" in rows[1]["spans"].split(",")
    assert rows[2]["spans"] == rows[3]["spans"] == ""


def test_entropy_by_steps(spark):
    def peak(text, w):
        def bits(part):
            return -sum(c / w * np.log2(c / w) for c in Counter(part).values())
        return max(bits(text[i : i + w]) for i in range(len(text) - w + 1))

    texts = ["abcabcabcdddddd", "aaaaaaaa", "zxcvbnmasdfghjkl", "aabbccddeeff"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", secret_scan.peak_entropy(F.col("t"), 8).alias("h")).collect():
        assert abs(r["h"] - peak(r["t"], 8)) < 1e-9


def test_pseudonyms(spark, docs, empty):
    text = "a@b.org 4111 1111 1111 1111, 4111111111111112 +1 (017) 555-7713 10.0.0.1 999.1.1.1 2024-02-29 2024-02-30 123-45-6789"
    frame = spark.createDataFrame([(1, text), (2, "x " + text), (3, None), (4, "")], "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymised(frame, "k").collect()}
    assert rows[3] is None and rows[4] == "" and rows[2] == "x " + rows[1]
    for gone in ("a@b.org", "4111 1111 1111 1111", "555-7713", "10.0.0.1", "2024-02-29", "123-45-6789"):
        assert gone not in rows[1]
    for stays in ("4111111111111112", "999.1.1.1", "2024-02-30", "+1 ("):
        assert stays in rows[1]
    assert pseudonyms.pseudonymised(empty, "k").columns == empty.columns


def test_feistel_is_a_permutation(spark):
    digits = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("d"))
    moved = digits.select(pseudonyms.permuted_digits(F.col("d"), "k", "t").alias("p"))
    assert moved.distinct().count() == 10_000 and moved.filter("length(p) = 4").count() == 10_000


def test_warc(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 50)
    big = "<p>" + "é" * 200
    rows = [(1, "u", "x"), (2, "u", "x"), (3, "u\r\nX: y", big), (4, None, big), (5, "u", None), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = warc_zip.read_packages(spark, warc_zip.write_packages(pages)).collect()
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["size"], r["digest"]) for r in found}
    for i, _, html in rows:
        data = (html or "").encode()
        first = 3 if html == big and i != 3 else None
        assert got[i] == ("revisit" if first else "response", first, len(data), hashlib.sha256(data).hexdigest())
    assert warc_zip.read_packages(spark, warc_zip.write_packages(pages.filter("false"))).count() == 0
    # A package with ZIP64 records throughout, by another writer.
    path = tmp_path / "p.zip"
    with zipfile.ZipFile(path, "w") as out:
        for k in range(3):
            out.writestr(f"pad{k}", b"z" * 60)
        out.writestr(warc_zip.ARCHIVE, b"archive bytes")
    package = warc_zip.Package(str(path))
    start = package.start(warc_zip.ARCHIVE)
    assert package.read(start, package.members[warc_zip.ARCHIVE].size) == b"archive bytes"


def test_pipeline(spark, docs):
    import corpus_pipeline

    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, SF).collect(), docs.schema)
        assert frame.columns == docs.columns, name
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert {"op1_warc_zip", "op10_lexicon_bpe"} <= set(queries.queries())
    assert zlib.crc32(b"") == 0
