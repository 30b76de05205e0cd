"""Encoding texts by chunks: places where a byte-level BPE never joins across.

The split of such a tokenizer starts a new piece at a blank that something other than white
space follows, and where an ASCII letter is followed by another ASCII character that is none.
So a text's ids are those of its chunks, one after the other, and each distinct chunk is
resolved once. Chunks are looked up by 64 bits of a keyed polynomial of their bytes, worked
out for a slice of texts at a time, and compared with the bytes that are remembered; those that
only share a code are resolved by themselves. What a worker remembers is bounded, then forgotten.
A text that holds a special token's own text is one chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1_000_000
MEMO_ENTRIES = 500_000
MEMO_IDS = 4_000_000
MEMO_BYTES = 16_000_000

_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= ord("a")) & ((_BYTES | 32) <= ord("z")) & (_BYTES < 128)
_OTHER = ~_LETTER & (_BYTES < 128)
# Bytes that never open white space: ASCII's own and the leads of all others are left out.
_SOLID = ~np.isin(_BYTES, [*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3])
_MULTIPLIER = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(20_260_101).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: resolve(chunks, opening) gives the ids of each chunk, as flat ids and sizes. `opening`: the
#: chunks open their texts; others follow a blank, a letter or stand before one.
Resolver = Callable[[list[str], bool], tuple[np.ndarray, np.ndarray]]


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.full(size, _MULTIPLIER, np.uint64)
    back = np.full(size, pow(_MULTIPLIER, -1, 2**64), np.uint64)
    one[0] = back[0] = 1
    return np.multiply.accumulate(one), np.multiply.accumulate(back)


def expand(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + sizes[i]] for all i, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about SLICE_BYTES: the first text's place, the bytes, and the
    offsets of the texts in them. Null texts are empty."""
    texts = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    if not len(texts):
        return
    offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        yield first, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def cut(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of the texts: starts, ends, 64-bit codes, and which of them open a text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none.astype(bool)
    edge = np.zeros(len(data), bool)
    after_letter = _LETTER[data[:-1]] & _OTHER[data[1:]]
    edge[1:] = after_letter
    edge[:-1] |= (data[:-1] == 32) & _SOLID[data[1:]]
    full = offsets[1:] > offsets[:-1]
    opens, closes = offsets[:-1][full], offsets[1:][full] - 1
    # What follows a text's last byte is another text.
    edge[closes] = (closes > 0) & after_letter[np.maximum(closes, 1) - 1] if len(data) > 1 else False
    if special:
        whole = data.tobytes()
        for token in special:
            at = whole.find(token)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, "right")) - 1
                edge[offsets[text] : offsets[text + 1]] = False
                at = whole.find(token, int(offsets[text + 1]))
    edge[opens] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(data))
    powers, back = _powers(max(SLICE_BYTES, 1 << int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * powers[: len(data)], out=sums[1:])
    codes = (sums[ends] - sums[starts]) * back[starts]
    opening = np.zeros(len(data), bool)
    opening[opens] = True
    opening = opening[starts]
    codes = (codes ^ (codes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    codes += (ends - starts).astype(np.uint64) * np.uint64(0x94D049BB133111EB) + opening.astype(np.uint64)
    return starts, ends, codes, opening


class ChunkEncoder:
    def __init__(self, resolve: Resolver, special: list[str]):
        self.resolve = resolve
        self.special = [token.encode() for token in special]
        self.forget()

    def forget(self) -> None:
        self.codes = np.zeros(0, np.uint64)  # ascending
        self.entry = np.zeros(0, np.int64)  # of each code, its place in starts and sizes
        self.n, self.used, self.held = 0, 0, 0
        self.flat = np.empty(1 << 16, np.uint32)
        self.starts = np.empty(1 << 14, np.int64)
        self.sizes = np.empty(1 << 14, np.int64)
        # The bytes of each entry, and where they lie.
        self.text = np.empty(1 << 16, np.uint8)
        self.places = np.empty(1 << 14, np.int64)
        self.lengths = np.empty(1 << 14, np.int64)

    def _learn(self, codes: np.ndarray, chunks: list[bytes], opening: bool) -> None:
        if not chunks:
            return
        ids, sizes = self.resolve([chunk.decode() for chunk in chunks], opening)
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        total = int(lengths.sum())
        while self.n + len(chunks) > len(self.starts):
            for name in ("starts", "sizes", "places", "lengths"):
                held = getattr(self, name)
                setattr(self, name, np.concatenate([held, np.empty_like(held)]))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while self.held + total > len(self.text):
            self.text = np.concatenate([self.text, np.empty_like(self.text)])
        new = slice(self.n, self.n + len(chunks))
        self.starts[new], self.sizes[new] = self.used + np.cumsum(sizes) - sizes, sizes
        self.places[new], self.lengths[new] = self.held + np.cumsum(lengths) - lengths, lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.text[self.held : self.held + total] = np.frombuffer(b"".join(chunks), np.uint8)
        every = np.concatenate([self.codes, codes])
        order = np.argsort(every, kind="stable")
        self.codes = every[order]
        self.entry = np.concatenate([self.entry, np.arange(self.n, self.n + len(chunks))])[order]
        self.n, self.used, self.held = self.n + len(chunks), self.used + len(ids), self.held + total

    def _strangers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Chunks that share their code with other bytes. The chunks cover the data from end to end."""
        size = ends - starts
        alike = self.lengths[entries] == size
        if alike.all() and np.array_equal(expand(self.text, self.places[entries], size), data):
            return np.zeros(0, np.int64)
        some = np.flatnonzero(alike)
        differs = expand(self.text, self.places[entries[some]], size[some]) != expand(data, starts[some], size[some])
        wrong = ~alike
        wrong[np.repeat(some, size[some])[differs]] = True
        return np.flatnonzero(wrong)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        if self.n > MEMO_ENTRIES or self.used > MEMO_IDS or self.held > MEMO_BYTES:
            self.forget()
        starts, ends, codes, opening = cut(data, offsets, self.special)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        distinct, sample, which = np.unique(codes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.codes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.codes)
        known[inside] = self.codes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            for opens in (True, False):
                part = new[opening[sample[new]] == opens]
                places = sample[part]
                chunks = [raw[a:b] for a, b in zip(starts[places].tolist(), ends[places].tolist())]
                self._learn(distinct[part], chunks, opens)
            at = np.searchsorted(self.codes, distinct)
        entries = self.entry[at][which]
        sizes, places, flat = self.sizes[entries], self.starts[entries], self.flat
        for i in self._strangers(data, starts, ends, entries).tolist():
            own, _ = self.resolve([data[starts[i] : ends[i]].tobytes().decode()], bool(opening[i]))
            sizes[i], places[i] = len(own), len(flat)
            flat = np.concatenate([flat, own.astype(np.uint32)])
        ids = expand(flat, places, sizes)
        # A text's ids end where the chunks of the next begin.
        bounds = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, offsets)]
        return ids, np.diff(bounds)


def library_resolver(tokenizer) -> Resolver:
    """Resolves chunks through the tokenizers library, many of them in one call: a known
    one-id word goes before each, which is then found again by the ids' lengths in bytes."""
    special = {int(i) for i in tokenizer.get_added_tokens_decoder()}
    lengths = np.array(
        [
            len((tokenizer.id_to_token(i) or "").encode()) if i in special
            else len(tokenizer.id_to_token(i) or "")  # a character of an ordinary token is a byte
            for i in range(tokenizer.get_vocab_size())
        ]
    )
    mark = tokenizer.encode(" x", add_special_tokens=False).ids

    def one_by_one(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def in_one(texts: list[str], marked: bool) -> tuple[np.ndarray, np.ndarray]:
        joined = (" x" + " x".join(texts)) if marked else "".join(texts)
        ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.cumsum(lengths[ids])
        sizes = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts)) + 2 * marked
        bounds = np.cumsum(sizes)
        last = np.searchsorted(ends, bounds)
        first = np.append(0, last[:-1] + 1)
        if last[-1] >= len(ends) or (ends[last] != bounds).any():
            return one_by_one(texts)
        if not marked:
            return ids, last + 1 - first
        if (ids[first] != mark[0]).any():
            return one_by_one(texts)
        keep = np.ones(len(ids), bool)
        keep[first] = False
        return ids[keep], last - first

    def resolve(texts: list[str], opening: bool) -> tuple[np.ndarray, np.ndarray]:
        if opening or len(texts) < 8 or len(mark) != 1:
            return one_by_one(texts)
        blank = [len(t) > 1 and t[0] == " " and not t[1].isspace() for t in texts]
        parts = [[t for t, b in zip(texts, blank) if b], [t for t, b in zip(texts, blank) if not b]]
        after_blank = np.array(blank)
        (ids_a, sizes_a), (ids_b, sizes_b) = (
            in_one(part, marked) if part else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            for part, marked in zip(parts, (False, True))
        )
        sizes = np.zeros(len(texts), np.int64)
        sizes[after_blank], sizes[~after_blank] = sizes_a, sizes_b
        starts = np.zeros(len(texts), np.int64)
        starts[after_blank] = np.cumsum(sizes_a) - sizes_a
        starts[~after_blank] = len(ids_a) + np.cumsum(sizes_b) - sizes_b
        return expand(np.concatenate([ids_a, ids_b]), starts, sizes), sizes

    return resolve


@lru_cache(maxsize=2)
def library_encoder(path: str) -> ChunkEncoder:
    """One for each worker process."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return ChunkEncoder(
        library_resolver(tokenizer), [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    )


@contextmanager
def task_encoder(path: str) -> Iterator[ChunkEncoder]:
    """The worker's encoder for one task; a worker that waits for the next keeps the tokenizer alone."""
    encoder = library_encoder(path)
    try:
        yield encoder
    finally:
        encoder.forget()
        _powers.cache_clear()
