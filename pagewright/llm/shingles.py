"""Words, word shingles and MinHash signatures of many texts at once, in numpy."""

from __future__ import annotations

from functools import cache

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C17 | 3  # 3 modulo 4
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = np.random.Generator(np.random.PCG64(1)).integers(0, 1 << 64, 256, _U)[_LOWER]
_PLACES = np.random.Generator(np.random.PCG64(2)).integers(0, 1 << 64, 64, _U) | _U(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** (0 .. n-1) modulo 2**64."""
    found = _powers.get(base)
    if found is None or len(found) < n:
        size = max(n, 1 << 21)
        found = np.full(size, base, _U)
        found[0] = 1
        np.multiply.accumulate(found, out=found)
        if size <= 1 << 21:
            _powers[base] = found
    return found[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit over all."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words of UTF-8 texts, A-Z lower-cased; the first word of each text and the end of the last (len + 1 offsets); each word's start and end byte within its own text."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    space = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edges[::2], edges[1::2]
    summed = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTES[data] * _power(_BASE, len(data)), out=summed[1:])
    hashes = mix((summed[end] - summed[start]) * _power(_INVERSE, len(data))[start] + (end - start).astype(_U))
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = 1 + np.concatenate([[0], np.cumsum(lengths + 1)])
    offsets = np.searchsorted(start, begins)
    shift = np.repeat(begins[:-1], np.diff(offsets))
    return hashes, offsets, start - shift, end - shift


def range_hashes(words: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """64-bit hashes of the word sequences at:to."""
    summed = np.zeros(len(words) + 1, _U)
    np.cumsum(mix(words + _U(0x632BE59BD9B4E019)) * _power(_BASE, len(words)), out=summed[1:])
    return mix((summed[to] - summed[at]) * _power(_INVERSE, len(words) + 1)[at] + (to - at).astype(_U))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of one text; fewer words are one shingle, none are none."""
    n = len(words)
    if not n:
        return words
    if n < k:
        return mix((words * _PLACES[:n]).sum(dtype=_U, keepdims=True) + _U(n))
    total = words[: n - k + 1] * _PLACES[0]
    for i in range(1, k):
        total += words[i : n - k + 1 + i] * _PLACES[i]
    return np.unique(mix(total + _U(k)))


@cache
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(3))
    return draw.integers(0, 1 << 32, (n, 1), np.uint32) | np.uint32(1), draw.integers(0, 1 << 32, (n, 1), np.uint32)


def minhash(shingles: np.ndarray, n: int) -> np.ndarray:
    """n minima of hashed shingles as 32-bit values; the set must not be empty."""
    a, b = _permutations(n)
    x = (shingles >> _U(32)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(least, (a * x[i : i + 2048] + b).min(axis=1), out=least)
    return least


def jaccard_counts(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and the union of two sorted distinct arrays."""
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared, len(both) - shared
