"""Word shingles as 64-bit hashes, vectorised over Arrow string arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_TABLE = np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = _U(0x9E3779B97F4A7C15)
_BLOCK = 1 << 22


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.full(n, _BASE)
    inverse = np.full(n, _U(pow(int(_BASE), -1, 1 << 64)))
    base[0] = inverse[0] = 1
    return np.cumprod(base), np.cumprod(inverse)


def _words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of ``data``; ``edges`` are offsets at which words end besides spaces."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = _SPACE[data]
    inner = ~space
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    before = np.concatenate([[True], space[:-1]]) | cut[:-1]
    after = np.concatenate([space[1:], [True]]) | cut[1:]
    start, end = np.flatnonzero(inner & before), np.flatnonzero(inner & after)
    n = 1 << max(16, int(len(data) - 1).bit_length())
    power, inverse = _powers(n)
    total = np.cumsum(_TABLE[_LOWER[data]] * power[:len(data)])
    first = np.where(start > 0, total[start - 1], _U(0))
    return mix((total[end] - first) * inverse[start] + (end - start).astype(np.uint64)), start


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) and, for each text, where its words begin (one more at the end)."""
    low = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(low)
    offsets = np.frombuffer(low.buffers()[1], np.int64)[low.offset:low.offset + n + 1]
    data = np.frombuffer(low.buffers()[2] or b"", np.uint8)
    hashes, starts, at = [], [], int(offsets[0]) if n else 0
    last = int(offsets[-1]) if n else 0
    while at < last:                    # in blocks that end at a space or where a text does
        end = min(last, at + _BLOCK)
        if end < last:
            edge = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
            spaces = np.flatnonzero(_SPACE[data[at:end]])
            back = max(edge, at + int(spaces[-1]) + 1 if len(spaces) else 0)
            if back > at:
                end = back
            else:                       # one word fills the block: take all of it
                stop = int(offsets[np.searchsorted(offsets, end, side="right")])
                while end < stop and not _SPACE[data[end]]:
                    end += 1
        inside = offsets[(offsets >= at) & (offsets <= end)] - at
        h, s = _words(data[at:end], inside)
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles.

    A text with fewer words has its whole sequence as one; without words the set is empty.
    """
    words, bounds = word_hashes(texts)
    rolled = words.copy()
    for k in range(1, width):
        rolled = mix(rolled[:len(rolled) - 1] * _U(0xD6E8FEB86659FD93) + words[k:]) if len(rolled) else rolled
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(rolled[a:b - width + 1])
        elif b > a:
            h = words[a:a + 1]
            for k in range(a + 1, b):
                h = mix(h * _U(0xD6E8FEB86659FD93) + words[k:k + 1])
            yield mix(h + _U(b - a))
        else:
            yield np.zeros(0, np.uint64)
