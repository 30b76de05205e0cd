"""Sets of word shingles, worked out by array operations for a slice of texts at a time.

Words are runs of anything but ASCII white space, A to Z in lower case. A word's code is the sum
of 64 scattered bits for each byte at its place in the word, a shingle's that of its words at
their places; 63 bits of it tell shingles apart. Texts of fewer words than a shingle has are one
shingle; texts without a word have none.
"""

from __future__ import annotations

import numpy as np

from hazeline.llm.chunked import expand

_BYTES = np.arange(256)
_WHITE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_PLACES = np.random.default_rng(20_260_102).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# The first places of a word in a table, later ones when they are met.
_NEAR = 64
_KEY = np.uint64(0x5851F42D4C957F2D)
_AT = _mixed(_KEY + np.arange(_NEAR * 256, dtype=np.uint64))


def word_codes(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each word. Every (place, byte) has bits of its own, so that no order of bytes
    cancels out, as it can in a polynomial modulo a power of two."""
    size = ends - starts
    text = expand(lowered, starts, size)
    place = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
    bits = np.empty(len(text), np.uint64)
    near = place < _NEAR
    bits[near] = _AT[place[near] * 256 + text[near]]
    far = np.flatnonzero(~near)
    if len(far):
        bits[far] = _mixed(_KEY + place[far].astype(np.uint64) * np.uint64(256) + text[far])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(bits, dtype=np.uint64)])
    last = np.cumsum(size)
    return _mixed(sums[last] - sums[last - size] + size.astype(np.uint64))


def shingled(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all shingles in the order of the texts, and how many each text has."""
    texts = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(texts, np.int64)
    solid = ~_WHITE[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | opens[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | opens[1:])) + 1
    code = word_codes(_LOWER[data], starts, ends)
    first = np.searchsorted(starts, offsets)  # of each text, its first word
    count = np.diff(first)
    sizes = np.where(count >= words, count - (words - 1), np.minimum(count, 1))
    text = np.repeat(np.arange(texts), sizes)
    place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[text]
    used = np.minimum(count, words)[text]
    total = used.astype(np.uint64)
    if len(code):
        for k in range(words):
            term = code[np.minimum(place + k, len(code) - 1)] * _PLACES[k]
            total = total + np.where(k < used, term, np.uint64(0))
    return _mixed(total) >> np.uint64(1), sizes


def distinct(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's codes ascending and once, and how many it has."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((codes, text))
    codes, text = codes[order], text[order]
    fresh = np.ones(len(codes), bool)
    fresh[1:] = (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])
    return codes[fresh], np.bincount(text[fresh], minlength=len(sizes))
