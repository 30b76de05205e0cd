"""External induced sorting: suffixes of a shard's text in order, with common-prefix lengths.

The text lies in a memory-mapped file. Suffixes at left-most S positions are sorted first:
their substrings by one round of induction, then, where substrings repeat, the string of
their names by recursion (in memory once it is short). From them all L and then all S suffixes
are induced. What induction has found but not yet scanned waits in priority queues: the
priority is the first symbol, and inside a symbol the order of arrival is already the order of
the suffixes, so a queue is a file of blocks that is written at its end and read from its
start. Queues beyond the memory limit go to disk. Each tuple in a queue carries the length of
the prefix it shares with the one before it: one more than the least such length between the
two suffixes that induced them. Lengths are cut off at `cap`, and suffixes that agree on `cap`
symbols may stand in any order among themselves.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

SCAN = 1 << 16


class Queues:
    """Blocks of (position, shared) by first symbol, first in, first out."""

    def __init__(self, folder: str, name: str, limit: int):
        self.folder, self.name, self.limit = folder, name, limit
        self.blocks: dict[int, list[np.ndarray]] = {}
        self.spilled: dict[int, list[int]] = {}  # rows of each block on disk
        self.held = 0

    def _path(self, symbol: int) -> str:
        return os.path.join(self.folder, f"{self.name}-{symbol}")

    def push(self, symbol: int, position: np.ndarray, shared: np.ndarray) -> None:
        self.blocks.setdefault(symbol, []).append(np.stack([position, shared.astype(np.int64)]))
        self.held += len(position)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        for key, blocks in self.blocks.items():
            with open(self._path(key), "ab") as file:
                for block in blocks:
                    self.spilled.setdefault(key, []).append(block.shape[1])
                    file.write(np.ascontiguousarray(block).tobytes())
        self.blocks, self.held = {}, 0

    def symbols(self) -> list[int]:
        return sorted({*self.blocks, *self.spilled})

    def take(self, symbol: int) -> Iterator[np.ndarray]:
        """The blocks that wait now, oldest first; they are gone from the queue."""
        sizes, fresh = self.spilled.pop(symbol, []), self.blocks.pop(symbol, [])
        self.held -= sum(b.shape[1] for b in fresh)
        wait: list[np.ndarray] = []
        rows = 0
        for block in (block for source in (self._stored(symbol, sizes), fresh) for block in source):
            # Small blocks go together: a scan costs as much for ten rows as for a thousand.
            if wait and rows + block.shape[1] > SCAN:
                yield np.concatenate(wait, axis=1)
                wait, rows = [], 0
            wait.append(block)
            rows += block.shape[1]
        if wait:
            yield np.concatenate(wait, axis=1)

    def _stored(self, symbol: int, sizes: list[int]) -> Iterator[np.ndarray]:
        if sizes:
            path = self._path(symbol)
            os.rename(path, f"{path}.reading")
            with open(f"{path}.reading", "rb") as file:
                for size in sizes:
                    yield np.frombuffer(file.read(16 * size), np.int64).reshape(2, size)
            os.remove(f"{path}.reading")


class Carry:
    """Shared lengths of pushed suffixes, from those of the scanned ones."""

    def __init__(self, symbols: int, cap: int):
        self.low = np.full(symbols, -1, np.int64)  # least length since the last push; -1: none yet
        self.cap = cap

    def pushed(self, shared: np.ndarray, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """`shared`: lengths along the scan; pushes of `symbol` happen at scan places `at`,
        both grouped by symbol, places ascending inside a symbol."""
        levels = [shared]
        while 2 << (len(levels) - 1) <= len(shared):
            step, last = 1 << (len(levels) - 1), levels[-1]
            levels.append(np.minimum(last[: len(last) - step], last[step:]))
        first = np.ones(len(at), bool)
        first[1:] = symbol[1:] != symbol[:-1]
        begin = np.zeros(len(at), np.int64)
        begin[1:] = at[:-1] + 1
        begin[first] = 0
        least = self._range(levels, begin, at + 1)
        before = self.low[symbol[first]]
        least[first] = np.where(before < 0, -1, np.minimum(before, least[first]))
        self.low = np.where(self.low < 0, self.low, np.minimum(self.low, shared.min()))
        lasts = np.append(first[1:], True)
        end = np.full(int(lasts.sum()), len(shared))
        tail = at[lasts] + 1
        self.low[symbol[lasts]] = np.where(
            tail < end, self._range(levels, np.minimum(tail, len(shared) - 1), end), self.cap
        )
        return np.minimum(least + 1, self.cap)

    @staticmethod
    def _range(levels: list[np.ndarray], begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = np.maximum(end - begin, 1)
        level = np.frexp(size.astype(np.float64))[1] - 1
        out = np.empty(len(begin), np.int64)
        for k in np.unique(level):
            of = level == k
            row = levels[k]
            out[of] = np.minimum(row[begin[of]], row[np.maximum(end[of] - (1 << int(k)), 0)])
        return out


def shared_prefix(text: np.ndarray, one: np.ndarray, two: np.ndarray, cap: int) -> np.ndarray:
    """Symbols that pairs of suffixes share, by looking, `cap` at most."""
    one, two = np.asarray(one, np.int64), np.asarray(two, np.int64)
    out = np.zeros(len(one), np.int64)
    live = np.arange(len(one))
    # Several symbols at a time where both suffixes have them, then one by one.
    wide = 8 // text.dtype.itemsize
    if wide > 1 and len(text) >= wide:
        view = np.ndarray(len(text) - wide + 1, np.uint64, text, strides=(text.dtype.itemsize,))
        while len(live):
            a, b = one[live] + out[live], two[live] + out[live]
            same = (a < len(view)) & (b < len(view)) & (out[live] + wide <= cap)
            same[same] = view[a[same]] == view[b[same]]
            live = live[same]
            out[live] += wide
        live = np.arange(len(one))
    for _ in range(cap):
        a, b = one[live] + out[live], two[live] + out[live]
        same = (a < len(text)) & (b < len(text)) & (out[live] < cap)
        same[same] = text[a[same]] == text[b[same]]
        live = live[same]
        if not len(live):
            break
        out[live] += 1
    return out


def kinds(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it (S), from the right by blocks."""
    out = np.empty(len(text), bool)
    out[-1] = True
    right, following = True, text[-1]
    for end in range(len(text) - 1, 0, -SCAN * 16):
        begin = max(0, end - SCAN * 16)
        part = np.append(text[begin:end], following).astype(np.int64)
        change = np.sign(np.diff(part))
        place = np.where(change != 0, np.arange(len(change)), len(change))
        place = np.minimum.accumulate(place[::-1])[::-1]
        out[begin:end] = np.append(change > 0, right)[place]
        right, following = out[begin], text[begin]
    return out


class Sorter:
    """`limit`: rows that each set of queues holds in memory; `base`: length up to which the
    reduced text is sorted in memory, not by recursion."""

    def __init__(self, folder: str, cap: int, limit: int, base: int | None = None):
        self.folder, self.cap, self.limit = folder, cap, limit
        self.base = limit if base is None else base
        self.depth = 0

    def _scan(self, text, small, position, shared, carry, queues, want_small: bool) -> None:
        """Push what a block of scanned suffixes induces."""
        for begin in range(0, len(position), SCAN):
            own, lengths = position[begin : begin + SCAN], shared[begin : begin + SCAN]
            before = own - 1
            ok = before >= 0
            ok[ok] = small[before[ok]] == want_small
            at = np.flatnonzero(ok)
            if not len(at):
                if carry is not None:
                    carry.low = np.where(carry.low < 0, carry.low, np.minimum(carry.low, lengths.min()))
                continue
            before = before[at]
            symbol = text[before].astype(np.int64)
            order = np.argsort(symbol, kind="stable")
            before, symbol, at = before[order], symbol[order], at[order]
            found = np.zeros(len(at), np.int64) if carry is None else carry.pushed(lengths, at, symbol)
            cuts = np.append(np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1])), len(symbol))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                queues.push(int(symbol[a]), before[a:b], found[a:b])

    def _induce(self, text, small, seeds, seed_shared, rough: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Buckets by descending symbol: L positions and S positions, each ascending, and the
        shared lengths of all of them, L before S. Seeds are left-most S positions by symbol;
        `rough`: in no order inside a symbol, and no lengths are wanted."""
        symbols = int(text.max()) + 1
        self.depth += 1
        larger = Queues(self.folder, f"l{self.depth}", self.limit)
        kept = Queues(self.folder, f"k{self.depth}", self.limit)
        smaller = Queues(self.folder, f"s{self.depth}", self.limit)
        seed_symbol = text[seeds].astype(np.int64)
        edges = np.searchsorted(seed_symbol, np.arange(symbols + 1))
        carry = None if rough else Carry(symbols, self.cap)
        present = np.unique(text)
        for symbol in present.tolist():
            last = -1
            while symbol in larger.blocks or symbol in larger.spilled:
                for position, shared in larger.take(symbol):
                    kept.push(symbol, position, shared)
                    # The first of a symbol shares nothing with what was scanned before it.
                    lengths = np.maximum(shared, 0)
                    if last < 0:
                        lengths = np.append(0, lengths[1:])
                    last = int(position[-1])
                    self._scan(text, small, position, lengths, carry, larger, False)
            own, lengths = seeds[edges[symbol] : edges[symbol + 1]], seed_shared[edges[symbol] : edges[symbol + 1]]
            if len(own):
                lengths = lengths.copy()
                lengths[0] = 0 if last < 0 else shared_prefix(text, [last], own[:1], self.cap)[0]
                self._scan(text, small, own, lengths, carry, larger, False)
        carry = None if rough else Carry(symbols, self.cap)
        for symbol in present[::-1].tolist():
            small_parts, last = [], -1
            while symbol in smaller.blocks or symbol in smaller.spilled:
                for position, shared in smaller.take(symbol):
                    lengths = np.maximum(shared, 0)
                    if last < 0:
                        lengths = np.append(0, lengths[1:])
                    small_parts.append((position, lengths))
                    last = int(position[-1])
                    self._scan(text, small, position, lengths, carry, smaller, True)
            empty = np.zeros((2, 0), np.int64)
            large = np.concatenate([empty, *kept.take(symbol)], axis=1)
            large_position, large_shared = large[0], np.maximum(large[1], 0)
            join = 0
            if len(large_position):
                if last >= 0:
                    join = int(shared_prefix(text, large_position[-1:], [last], self.cap)[0])
                down = np.append(join, large_shared[1:][::-1])
                self._scan(text, small, large_position[::-1], down, carry, smaller, True)
                large_shared = np.append(0, large_shared[1:])
            if small_parts:
                position = np.concatenate([p for p, _ in small_parts])[::-1]
                shared = np.concatenate([s for _, s in small_parts])
                small_shared = np.append(join, shared[1:][::-1])
            else:
                position, small_shared = empty[0], empty[0]
            yield large_position, position, np.concatenate([large_shared, small_shared])

    def _leftmost(self, small: np.ndarray) -> np.ndarray:
        return np.flatnonzero(small[1:] & ~small[:-1]) + 1

    def _sorted_seeds(self, text: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Left-most S positions in the order of their suffixes, and what neighbours share."""
        left = self._leftmost(small)
        if len(left) <= 1:
            return left, np.zeros(len(left), np.int64)
        rough = left[np.argsort(text[left], kind="stable")]
        is_left = np.zeros(len(text), bool)
        is_left[left] = True
        found = [p[is_left[p]] for _, p, _ in self._induce(text, small, rough, np.zeros(len(rough), np.int64), rough=True)]
        order = np.concatenate([left[-1:], *found[::-1]])  # the end of the text is the smallest
        following = np.append(left[1:], left[-1])
        slot = np.searchsorted(left, order)
        sizes = (following - left)[slot] + 1
        code = self._codes(text, order, sizes)
        fresh = np.append(True, (code[1:] != code[:-1]) | (sizes[1:] != sizes[:-1]))
        fresh[1] = True
        name = np.empty(len(left), np.int64)
        name[slot] = np.cumsum(fresh) - 1
        if name.max() + 1 < len(left):
            order = left[self._order(name)]
        shared = np.append(0, shared_prefix(text, order[:-1], order[1:], self.cap))
        return order, shared

    def _codes(self, text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """64 bits that tell substrings of one size apart."""
        out = np.zeros(len(start), np.uint64)
        live, step = np.arange(len(start)), 0
        while len(live):
            symbol = text[start[live] + step].astype(np.uint64) + np.uint64(1)
            out[live] = (out[live] ^ symbol) * np.uint64(0x9E3779B97F4A7C15)
            out[live] ^= out[live] >> np.uint64(31)
            step += 1
            live = live[size[live] > step]
        return out

    def _order(self, names: np.ndarray) -> np.ndarray:
        """Suffixes of the reduced text in order."""
        if len(names) > self.base:
            small = kinds(names)
            seeds, shared = self._sorted_seeds(names, small)
            parts = [np.concatenate([l, s]) for l, s, _ in self._induce(names, small, seeds, shared)]
            # The end itself is induced by nothing and stands first.
            return np.concatenate([[len(names) - 1], *parts[::-1]])
        rank, step = names, 1
        while True:
            after = np.zeros(len(rank), np.int64)
            after[:-step] = rank[step:] + 1
            key = rank * (int(rank.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            new = np.empty(len(rank), np.int64)
            new[order] = np.cumsum(np.append(False, ranked[1:] != ranked[:-1]))
            rank, step = new, step * 2
            if step >= len(rank) or step > self.cap or rank.max() + 1 == len(rank):
                return np.argsort(rank, kind="stable")

    def buckets(self, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions in suffix order, a first symbol at a time (descending), and the length that
        each shares with the one before it. The text ends with its only 0."""
        small = kinds(text)
        seeds, shared = self._sorted_seeds(text, small)
        for large, position, lengths in self._induce(text, small, seeds, shared):
            yield np.concatenate([large, position]), lengths
