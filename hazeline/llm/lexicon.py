"""BPE through a lexicon: a minimal acyclic transducer of frequent words, and exact merges.

Word counts over all texts choose the lexicon's words. Their ids come from the merges once,
and the words, in order, are compiled into the smallest deterministic automaton: states with
equal futures are one state, so endings are shared. Each transition carries how many words
sort before those behind it; the sum along a path numbers the word, and the number finds its
ids. The automaton is arrays in one file, shipped to every executor once and memory-mapped by
its workers. Distinct pieces of a slice of texts walk it side by side, a byte a step. Words
it doesn't hold are merged exactly, many at a time: in each step every word joins its leftmost
pair of lowest rank.

Results never depend on the lexicon, only speed does; its size is bounded by `words`.
Defined results: a null text is empty and has no ids; an empty table gives no rows and an
empty lexicon; the special token's own text gives its id, as in the library; repeated rows
give repeated results; other columns are left out.
"""

from __future__ import annotations

import heapq
import json
import os
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.chunked import ChunkEncoder, cut, expand, slices
from hazeline.llm.shipping import ship

WORDS = 100_000
COUNTED_FROM = 3  # a word reaches the shuffle with the counts of slices that hold it so often
WIDE = 48  # longer words are merged one by one

_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_SPLIT = regex.compile(_CONTRACTIONS + r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Characters whose class is the same in every Unicode version that matters here.
_SETTLED = regex.compile(r"[\x00-ɏͰ-ͳΑ-ΡΣ-ϿЀ-ҁ‐-‧€]*")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints,
    else the next free code point from 256 on."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Merges:
    """A byte-level BPE's tables, and exact merging."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        back = {letter: byte for byte, letter in letters.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.base = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.size = max(max(vocab.values()), *self.special.values(), 0) + 1
        texts = [b""] * self.size
        for token, i in vocab.items():
            texts[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            texts[i] = token.encode()
        self.lengths = np.fromiter(map(len, texts), np.int64, self.size)
        self.ends = np.cumsum(self.lengths)
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        joined = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.joined = keys[order], order, joined
        self.none = len(pairs)
        self.pair_rank = dict(zip(keys.tolist(), range(len(pairs))))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.rank[at], self.none)

    def _one(self, word: bytes) -> list[int]:
        """A long word: a queue of pairs by rank and place over a chain of symbols."""
        ids = self.base[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        queue: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                rank = self.pair_rank.get(ids[i] * self.size + ids[after[i]])
                if rank is not None:
                    heapq.heappush(queue, (rank, i, ids[i], ids[after[i]]))

        for i in range(len(ids)):
            push(i)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i]
            if j < 0 or ids[i] != left or ids[j] != right:
                continue
            ids[i], ids[j] = int(self.joined[rank]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            push(before[i])
            push(i)
        return [i for i in ids if i >= 0]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word, as flat ids and sizes."""
        sizes = np.zeros(len(words), np.int64)
        found: list[np.ndarray | None] = [None] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(lengths > WIDE):
            found[i] = np.array(self._one(words[i]), np.int64)
        for low, high in ((0, 8), (8, 16), (16, 32), (32, WIDE)):
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            if len(rows):
                for i, ids in zip(rows, self._side_by_side([words[i] for i in rows], high)):
                    found[i] = ids
        for i, ids in enumerate(found):
            sizes[i] = 0 if ids is None else len(ids)
        flat = [ids for ids in found if ids is not None]
        return (np.concatenate(flat) if flat else np.zeros(0, np.int64)), sizes

    def _side_by_side(self, words: list[bytes], width: int) -> list[np.ndarray]:
        count = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        ids = np.where(np.arange(width) < count[:, None], self.base[raw.reshape(-1, width)], -1)
        done: list[np.ndarray | None] = [None] * len(words)
        live = np.arange(len(words))
        ranks = self.ranks(ids[:, :-1], ids[:, 1:])
        columns = np.arange(width)
        while len(live):
            lowest = ranks.argmin(axis=1)
            every = np.arange(len(live))
            rank = ranks[every, lowest]
            over = rank == self.none
            for row in np.flatnonzero(over):
                done[live[row]] = ids[row][ids[row] >= 0]
            more = ~over
            live, ids, ranks, lowest, rank = live[more], ids[more], ranks[more], lowest[more], rank[more]
            if not len(live):
                break
            every = every[: len(live)]
            ids[every, lowest] = self.joined[rank]
            # Close the gap behind the joined symbol, then rank its two new pairs.
            from_ = np.minimum(columns + (columns > lowest[:, None]), width - 1)
            closed = np.take_along_axis(ids, from_, axis=1)
            closed[:, -1] = -1
            ids = closed
            ranks = np.take_along_axis(ranks, np.minimum(from_[:, :-1], width - 2), axis=1)
            ranks[:, -1] = self.none
            right = lowest < width - 1
            ranks[every[right], lowest[right]] = self.ranks(
                ids[every[right], lowest[right]], ids[every[right], lowest[right] + 1]
            )
            left = lowest > 0
            ranks[every[left], lowest[left] - 1] = self.ranks(
                ids[every[left], lowest[left] - 1], ids[every[left], lowest[left]]
            )
        return done

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The text of each run of ids."""
        lengths = self.lengths[ids]
        data = expand(self.bytes, self.ends[ids] - lengths, lengths).tobytes()
        marks = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(marks, marks[1:])]


class Pieces:
    """Splits text as the tokenizer does before its merges; special tokens come out whole."""

    def __init__(self, path: str, special: dict[str, int]):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def _plain(self, text: str) -> list[str]:
        if _SETTLED.fullmatch(text):
            return _SPLIT.findall(text)
        # Rarer characters: the library knows which class it takes them for.
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def of(self, text: str) -> list[str]:
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        found: list[str] = []
        for part in self.cut.split(text):
            found += [part] if part in self.special else self._plain(part)
        return found


def compile_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of sorted, distinct, non-empty words.

    keys: state * 256 + byte, ascending; target; skip: words before those behind it; final.
    """
    children: list[list[tuple[int, int]]] = [[]]  # of states on the path of the last word
    finals = [False]
    register: dict[tuple, int] = {}
    done: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def close(final: bool, edges: list[tuple[int, int]]) -> int:
        state = (final, tuple(edges))
        if state not in register:
            register[state] = len(done)
            done.append(state)
        return register[state]

    last = b""
    for word in words:
        common = os.path.commonprefix([last, word])
        while len(children) - 1 > len(common):
            state = close(finals.pop(), children.pop())
            children[-1].append((last[len(children) - 1], state))
        for _ in word[len(common):]:
            children.append([])
            finals.append(False)
        finals[-1] = True
        last = word
    while len(children) > 1:
        state = close(finals.pop(), children.pop())
        children[-1].append((last[len(children) - 1], state))
    start = close(finals[0], children[0])
    below: list[int] = []
    keys, target, skip = [], [], []
    for number, (final, edges) in enumerate(done):  # a state's targets are closed before it
        seen = int(final)
        for byte, to in edges:
            keys.append(number * 256 + byte), target.append(to), skip.append(seen)
            seen += below[to]
        below.append(seen)
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return {
        "keys": np.array(keys, np.int64)[order],
        "target": np.array(target, np.int64)[order],
        "skip": np.array(skip, np.int64)[order],
        "final": np.array([f for f, _ in done], bool),
        "start": np.array([start], np.int64),
    }


class Lexicon:
    """The compiled file, memory-mapped: word to ids for many words at a time."""

    NAMES = ("keys", "target", "skip", "final", "start", "ids", "ends")

    def __init__(self, path: str):
        self.parts: dict[str, np.ndarray] = {}
        with open(path, "rb") as file:
            size = int.from_bytes(file.read(8), "little")
            spec = json.loads(file.read(size))
        for name, (kind, count, offset) in spec.items():
            shape = (count,)
            self.parts[name] = (
                np.memmap(path, kind, "r", 8 + size + offset, shape) if count else np.zeros(0, kind)
            )

    @classmethod
    def write(cls, path: str, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        parts = compile_automaton(words) | {"ids": ids.astype(np.int64), "ends": np.cumsum(sizes)}
        spec, offset = {}, 0
        for name in cls.NAMES:
            spec[name] = (parts[name].dtype.str, len(parts[name]), offset)
            offset += parts[name].nbytes
        head = json.dumps(spec).encode()
        with open(path, "wb") as file:
            file.write(len(head).to_bytes(8, "little") + head)
            for name in cls.NAMES:
                file.write(parts[name].tobytes())

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, -1 where the lexicon doesn't hold it."""
        p = self.parts
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        number = np.full(len(words), -1, np.int64)
        if not len(p["keys"]) or not len(words):
            return number
        data = np.frombuffer(b"".join(words), np.uint8)
        begins = np.cumsum(lengths) - lengths
        live = np.flatnonzero(lengths > 0)
        state, total = np.full(len(live), int(p["start"][0])), np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            over = lengths[live] == step
            ends = over & p["final"][state]
            number[live[ends]] = total[ends]
            live, state, total = live[~over], state[~over], total[~over]
            if not len(live):
                break
            keys = state * 256 + data[begins[live] + step]
            at = np.minimum(np.searchsorted(p["keys"], keys), len(p["keys"]) - 1)
            goes = p["keys"][at] == keys
            at, live = at[goes], live[goes]
            state, total = p["target"][at], total[goes] + p["skip"][at]
            step += 1
        return number


class LexiconResolver:
    """Resolves chunks: pieces, the lexicon, and merges for what it doesn't hold."""

    def __init__(self, tokenizer: str, lexicon: str | None):
        self.merges = Merges(tokenizer)
        self.pieces = Pieces(tokenizer, self.merges.special)
        self.lexicon = Lexicon(lexicon) if lexicon else None

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, as flat ids and sizes."""
        raw = [w.encode() for w in words]
        number = self.lexicon.numbers(raw) if self.lexicon else np.full(len(raw), -1)
        special = self.merges.special
        for i, word in enumerate(words):
            if word in special:
                number[i] = -2
        unseen = np.flatnonzero(number == -1)
        merged, merged_sizes = self.merges.merge([raw[i] for i in unseen])
        fixed = np.array([special[words[i]] for i in np.flatnonzero(number == -2)], np.int64)
        parts = self.lexicon.parts if self.lexicon else {"ids": np.zeros(0, np.int64), "ends": np.zeros(0, np.int64)}
        known = np.flatnonzero(number >= 0)
        ends = parts["ends"]
        known_ends = ends[number[known]] if len(known) else np.zeros(0, np.int64)
        known_starts = np.where(number[known] > 0, ends[number[known] - 1], 0) if len(known) else known_ends
        source = np.concatenate([parts["ids"], merged, fixed])
        starts, sizes = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
        starts[known], sizes[known] = known_starts, known_ends - known_starts
        starts[unseen] = len(parts["ids"]) + np.cumsum(merged_sizes) - merged_sizes
        sizes[unseen] = merged_sizes
        starts[number == -2] = len(parts["ids"]) + len(merged) + np.arange(len(fixed))
        return expand(source, starts, sizes), sizes

    def __call__(self, chunks: list[str], opening: bool = True) -> tuple[np.ndarray, np.ndarray]:
        pieces = [self.pieces.of(chunk) for chunk in chunks]
        every = list(chain.from_iterable(pieces))
        distinct = {word: i for i, word in enumerate(dict.fromkeys(every))}
        ids, sizes = self.words(list(distinct))
        entry = np.fromiter(map(distinct.__getitem__, every), np.int64, len(every))
        starts = np.cumsum(sizes) - sizes
        out = expand(ids, starts[entry], sizes[entry])
        ends = np.concatenate([[0], np.cumsum(sizes[entry])])
        marks = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        return out.astype(np.uint32), np.diff(ends[marks], prepend=0)


@lru_cache(maxsize=2)
def lexicon_encoder(tokenizer: str, lexicon: str | None) -> tuple[ChunkEncoder, Merges]:
    """One for each worker process."""
    resolver = LexiconResolver(tokenizer, lexicon)
    return ChunkEncoder(resolver, list(resolver.merges.special)), resolver.merges


def frequent_words(docs: DataFrame, tokenizer: str, words: int = WORDS) -> list[str]:
    """The most frequent pieces over all texts; ties by the piece itself.

    Slices of texts are counted where they are read, and a slice passes on what it holds
    COUNTED_FROM times or more; rarer words would not be worth a place.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(tokenizer, Merges(tokenizer).special)
        for batch in batches:
            for _, data, offsets in slices(batch.column("text")):
                starts, ends, codes, _ = cut(data, offsets, [])
                _, sample, counts = np.unique(codes, return_index=True, return_counts=True)
                often = (counts >= COUNTED_FROM) & (ends[sample] - starts[sample] <= WIDE)
                raw = data.tobytes()
                found: Counter[str] = Counter()
                for place, n in zip(sample[often].tolist(), counts[often].tolist()):
                    for piece in pieces.of(raw[starts[place] : ends[place]].decode()):
                        found[piece] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                    names=["word", "n"],
                )

    counted = docs.select("text").mapInArrow(count, "word string, n long")
    top = (
        counted.groupBy("word").agg(F.sum("n").alias("n"))
        .orderBy(F.col("n").desc(), "word").limit(words).select("word")
    )
    return [row["word"] for row in top.collect()]


def build_lexicon(docs: DataFrame, tokenizer: str, words: int = WORDS) -> str:
    """Compile the lexicon and ship it; the name by which executors find the file."""
    merges = Merges(tokenizer)
    chosen = sorted({w.encode() for w in frequent_words(docs, tokenizer, words)} - {b""})
    ids, sizes = merges.merge(chosen)
    folder = tempfile.mkdtemp(prefix="lexicon-")  # the driver's own: executors get copies
    # A name of its own: one application can't ship two files under one name, not even equal ones.
    name = f"{uuid4().hex}.lexicon"
    path = os.path.join(folder, name)
    Lexicon.write(path, chosen, ids, sizes)
    docs.sparkSession.sparkContext.addFile(path)
    return name


def encode(docs: DataFrame, tokenizer: str, lexicon: str | None) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian u32 binary), decoded (the ids turned back to text)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, merges = lexicon_encoder(tokenizer, SparkFiles.get(lexicon) if lexicon else None)
        for batch in batches:
            names = batch.column("doc_id")
            for start, data, offsets in slices(batch.column("text")):
                ids, sizes = encoder.encode(data, offsets)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                yield pa.RecordBatch.from_arrays(
                    [
                        names.slice(start, len(sizes)),
                        pa.array(sizes),
                        pa.BinaryArray.from_buffers(
                            pa.binary(), len(sizes),
                            [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))],
                        ),
                        pa.array(merges.decode(ids, sizes), pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
