"""Anchors of windows: every window of bytes picks the least code among the grams inside it.

Equal windows pick the same gram at the same place, so windows can be equal only where their
anchors' grams are. Neighbouring windows mostly share an anchor; a run of such windows and
the bytes they cover is an anchor's context.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from hazeline.llm.chunked import _CODES, _MULTIPLIER
from hazeline.llm.shingles import _mixed

GRAM = 32
BLOCK = 4_000_000
_PLACE_BITS = np.uint64(23)
_PLACE = np.uint64((1 << 23) - 1)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.full(size, _MULTIPLIER, np.uint64)
    back = np.full(size, pow(_MULTIPLIER, -1, 2**64), np.uint64)
    one[0] = back[0] = 1
    return np.multiply.accumulate(one), np.multiply.accumulate(back)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours, from running minima of blocks in both directions."""
    count = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def _block(data: np.ndarray, valid: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """First and last window, anchor's code and context's code, of each context in the data."""
    size = 1 << int(max(len(data), 2) - 1).bit_length()
    powers, back = _powers(max(size, 1 << 21))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * powers[: len(data)], out=sums[1:])
    grams = len(data) - GRAM + 1
    codes = _mixed((sums[GRAM:] - sums[:grams]) * back[:grams])
    packed = (codes & ~_PLACE) | np.arange(grams, dtype=np.uint64)
    least = _sliding_least(packed, window - GRAM + 1)
    starts = np.flatnonzero(valid[: len(least)])
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    anchor = (least[starts] & _PLACE).astype(np.int64)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(fresh)
    first, last = starts[at], starts[np.append(at[1:], len(starts)) - 1]
    gram = codes[anchor[at]]
    end = last + window
    context = _mixed((sums[end] - sums[first]) * back[first] + (end - first).astype(np.uint64) * np.uint64(_MULTIPLIER))
    return first, last, gram, context + (anchor[at] - first).astype(np.uint64)


def contexts(data: np.ndarray, offsets: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per block: text number, first and last window's start in it, gram code, context code.
    A window lies in one text whole."""
    if len(data) < window:
        return
    for begin in range(0, len(data) - window + 1, BLOCK):
        end = min(begin + BLOCK + window - 1, len(data))
        starts = np.arange(begin, end - window + 1)
        text = np.searchsorted(offsets, starts, "right") - 1
        valid = starts + window <= offsets[text + 1]
        first, last, gram, context = _block(data[begin:end], valid, window)
        which = text[first]
        yield which, first + begin - offsets[which], last + begin - offsets[which], gram, context
