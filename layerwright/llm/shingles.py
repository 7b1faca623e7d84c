"""Word shingles of whole texts as 64-bit hashes, a text at a time in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

from layerwright.llm.common import LOWER_BYTES

_RNG = np.random.default_rng(20240)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + _RNG.integers(0, 2, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C13
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each at least."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word, A-Z lower-cased: a difference of running polynomial sums, moved to the word's start."""
    raw = np.frombuffer(text.encode().translate(LOWER_BYTES), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(inside))
    start, end = edges[::2], edges[1::2]
    up, down = _power(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:len(raw)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles of ``size`` words. Fewer words are one shingle; none, none."""
    words = word_hashes(text or "")
    if not len(words):
        return np.empty(0, np.uint64)
    width = min(size, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[i:i + n])
    return np.unique(out)


def signature(tokens: np.ndarray) -> bytes:
    """16 bytes that tell a set of shingles."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
