"""Vectorised 64-bit hashes of words and word shingles, for use inside tasks."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
# The inverse of the base modulo 2 to the 64.
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, dtype=np.int8)
_SPACE[[32, 9, 10, 11, 12, 13]] = 1
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = min(CHUNK, max(n, 1 << 14)) if n <= CHUNK else n
        steps = np.full(size, BASE), np.full(size, _INVERSE)
        for s in steps:
            s[0] = 1
        _POWERS["up"], _POWERS["down"] = (np.multiply.accumulate(s) for s in steps)
    return _POWERS["up"][:n], _POWERS["down"]


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of every white-space separated word of UTF-8 bytes, A-Z lower-cased, in order."""
    if len(data) <= CHUNK:
        return _piece(data)
    out, at = [], 0
    while at < len(data):  # long texts in pieces that end between words
        end = min(len(data), at + CHUNK)
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        out.append(_piece(data[at:end]))
        at = end
    return np.concatenate(out)


def _piece(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.uint64)
    b = np.frombuffer(data, dtype=np.uint8)
    space = np.ones(len(b) + 2, dtype=np.int8)
    space[1:-1] = _SPACE[b]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(b))
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_LOWER[b] * up, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of all runs of ``size`` words, sorted; fewer words are one run, none give none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = out * BASE + words[k : k + n]
    return np.unique(mix(out))
