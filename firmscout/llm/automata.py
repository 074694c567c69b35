"""Weighted acyclic automata over word numbers: count transducers of word sequences.

A transducer reads a sequence word by word; the arc it takes last carries how often the sequence read so far occurred.
It is built from sorted rows, level by level: arcs that begin alike are one, and states that go on alike (same labels,
counts and targets) are one as well. Word numbers are positive, 0 ends a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from firmscout.llm.hashing import mix

KEY_BITS = 62


def row_order(rows: np.ndarray) -> np.ndarray:
    """The order that sorts rows, several words packed into one number where they fit."""
    bits = max(1, int(rows.max(initial=0)).bit_length())
    each = max(1, KEY_BITS // bits)
    keys = []
    for at in range(0, rows.shape[1], each):
        key = rows[:, at].astype(np.int64)
        for column in rows[:, at + 1 : at + each].T:
            key = (key << bits) | column
        keys.append(key)
    return np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")


def summed(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with the sums of their counts."""
    if not len(rows):
        return rows, counts
    order = row_order(rows)
    rows, counts = rows[order], counts[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    return rows[starts], np.add.reduceat(counts, starts)


def prefixes(rows: np.ndarray, counts: np.ndarray):
    """For every length: the rows' distinct beginnings, their counts, and the place of each one's own beginning."""
    n, width = rows.shape
    new, before = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
    if n:
        new[0] = True
    for d in range(width):
        new[1:] |= rows[1:, d] != rows[:-1, d]
        valid = rows[:, d] > 0
        if not valid.any():
            return
        first = new & valid
        starts = np.flatnonzero(first)
        weights = np.add.reduceat(counts[valid], np.flatnonzero(first[valid]))
        yield rows[starts, : d + 1], weights, before[starts]
        before = np.cumsum(first) - 1


@dataclass
class Level:
    """Arcs of the states of one depth; ``sizes`` says how many belong to each state."""

    sizes: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    targets: np.ndarray  # place of the next state, counted from 1; 0 where nothing follows

    def keys(self) -> np.ndarray:
        state = np.repeat(np.arange(len(self.sizes), dtype=np.int64), self.sizes)
        return (state << 32) | self.labels.astype(np.int64)


class Transducer:
    def __init__(self, levels: list[Level]) -> None:
        self.levels = levels

    @classmethod
    def build(cls, rows: np.ndarray, counts: np.ndarray) -> Transducer:
        """From distinct sorted rows. States are closed from the last level up and looked up among those of their level."""
        found = list(prefixes(rows, counts))
        levels, targets = [], None
        for d in reversed(range(len(found))):
            paths, weights, parent = found[d]
            labels = paths[:, d]
            targets = np.zeros(len(labels), dtype=np.int64) if targets is None else targets
            n_parents = len(found[d - 1][0]) if d else 1
            level, up = _register(labels, weights, targets, parent, n_parents)
            levels.append(level)
            targets = up
        return cls(levels[::-1])

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """The rows it was built from: every path, with what its count exceeds those of its continuations by."""
        rows, _, own = self._paths()
        return rows[own > 0], own[own > 0]

    def all_rows(self) -> tuple[np.ndarray, np.ndarray]:
        """Every path with its count."""
        rows, weights, _ = self._paths()
        return rows, weights

    def _paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = max(1, len(self.levels))
        state, path = np.zeros(1 if self.levels else 0, dtype=np.int64), np.zeros((1 if self.levels else 0, width), np.int64)
        out, own, all_weights = [], [], []
        for d, level in enumerate(self.levels):
            ends = np.cumsum(level.sizes)
            sizes = level.sizes[state]
            arcs = np.repeat(ends[state] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
            path = np.repeat(path, sizes, axis=0)
            path[:, d] = level.labels[arcs]
            if d:  # what goes on is taken off where it came from
                own[-1] = own[-1] - _sums(level.weights[arcs], sizes, came)
            out.append(path.copy())
            own.append(level.weights[arcs])
            all_weights.append(level.weights[arcs])
            target = level.targets[arcs]
            came = (np.flatnonzero(target), len(target))
            path, state = path[target > 0], target[target > 0] - 1
        if not out:
            return path, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(out), np.concatenate(all_weights), np.concatenate(own)

    def weigh(self, paths: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Composes paths with the transducer: the count of each, 0 if it has none."""
        state, weight = np.zeros(len(paths), dtype=np.int64), np.zeros(len(paths), dtype=np.int64)
        alive = np.ones(len(paths), dtype=bool)
        for d in range(int(lengths.max(initial=0))):
            if d >= len(self.levels):
                weight[lengths > d] = 0
                break
            level, here = self.levels[d], np.flatnonzero(alive & (lengths > d))
            keys, asked = level.keys(), (state[here] << 32) | paths[here, d]
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            hit = keys[at] == asked
            weight[here] = np.where(hit, level.weights[at], 0)
            target = np.where(hit, level.targets[at], 0).astype(np.int64)
            alive[here], state[here] = target > 0, np.maximum(target - 1, 0)
            weight[(lengths > d + 1) & ~alive] = 0
        return weight

    def dump(self) -> bytes:
        """A few bytes per level say how many numbers follow and how wide; labels ascend, so their steps are written."""
        heads, values = [len(self.levels)], []
        for level in self.levels:
            arrays = [level.sizes, _steps(level.labels, level.sizes), level.weights, level.targets]
            widths = [_width(a) for a in arrays]
            heads += [len(level.sizes), len(level.labels), int.from_bytes(bytes(widths), "little")]
            values += [_planes(a, width) for a, width in zip(arrays, widths)]
        head = np.array(heads, dtype="<u4").tobytes()
        return head + pa.compress(b"".join(values), codec="zstd", asbytes=True)

    @classmethod
    def load(cls, data: bytes) -> Transducer:
        if not data:
            return cls([])
        n_levels = int.from_bytes(data[:4], "little")
        heads = np.frombuffer(data, dtype="<u4", count=3 * n_levels, offset=4).reshape(-1, 3).tolist()
        sizes = [(n, w) for states, arcs, ws in heads for n, w in zip((states, arcs, arcs, arcs), ws.to_bytes(4, "little"))]
        total = sum(n * w for n, w in sizes)
        packed = memoryview(data)[4 + 12 * n_levels :]
        values = pa.decompress(packed, decompressed_size=total, codec="zstd", asbytes=True)
        arrays, at = [], 0
        for n, width in sizes:
            arrays.append(_of_planes(values[at : at + n * width], n, width))
            at += n * width
        levels = [Level(*arrays[i : i + 4]) for i in range(0, len(arrays), 4)]
        for level in levels:
            level.labels = _of_steps(level.labels, level.sizes)
        return cls(levels)


def _width(values: np.ndarray) -> int:
    """Bytes that the largest number takes; none if all are 0."""
    return (int(values.max(initial=0)).bit_length() + 7) // 8


def _planes(values: np.ndarray, width: int) -> bytes:
    """Numbers byte by byte of their places: the high ones are mostly alike."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _of_planes(data: bytes, n: int, width: int) -> np.ndarray:
    whole = np.zeros((n, 8), dtype=np.uint8)
    whole[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(width, n).T
    return whole.view("<i8").ravel()


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in ascending order, by their steps."""
    steps = np.diff(values, prepend=0)
    width = _width(steps)
    return len(values).to_bytes(8, "little") + bytes([width]) + pa.compress(_planes(steps, width), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), data[8]
    return np.cumsum(_of_planes(pa.decompress(data[9:], decompressed_size=n * width, codec="zstd", asbytes=True), n, width))


def _steps(labels: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The labels of a state, which ascend, each less the one before it."""
    steps = np.diff(labels, prepend=0)
    begins = np.cumsum(sizes) - sizes
    steps[begins] = labels[begins]
    return steps


def _of_steps(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums, begins = np.cumsum(steps), np.cumsum(sizes) - sizes
    return sums - np.repeat(sums[begins] - steps[begins], sizes)


def _sums(values: np.ndarray, sizes: np.ndarray, came: tuple[np.ndarray, int]) -> np.ndarray:
    """Values summed by where they came from; most places got none."""
    places, n = came
    out = np.zeros(n, dtype=np.int64)
    if len(values):
        out[places] = np.add.reduceat(values, np.cumsum(sizes) - sizes)
    return out


def _register(
    labels: np.ndarray, weights: np.ndarray, targets: np.ndarray, parent: np.ndarray, n_parents: int
) -> tuple[Level, np.ndarray]:
    """One level's states, equal ones once, and for every arc above the place of its state (from 1; 0: none)."""
    begins = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
    sizes = np.diff(np.r_[begins, len(parent)])
    sign = mix(mix(mix(targets.astype(np.uint64)) + weights.astype(np.uint64)) + labels.astype(np.uint64))
    signs = mix(np.add.reduceat(sign, begins) + sizes.astype(np.uint64))
    _, first, place = np.unique(signs, return_index=True, return_inverse=True)
    same = first[place]
    # A hash only suggests that states are equal: their arcs are compared.
    fits = sizes[same] == sizes
    if fits.all():
        other = np.repeat(begins[same] - begins, sizes) + np.arange(len(labels))
        fits = (labels[other] == labels) & (weights[other] == weights) & (targets[other] == targets)
    if not fits.all():
        first = place = np.arange(len(begins))
    kept = np.repeat(begins[first] - np.r_[0, np.cumsum(sizes[first])[:-1]], sizes[first]) + np.arange(sizes[first].sum())
    up = np.zeros(n_parents, dtype=np.int64)
    up[parent[begins]] = place + 1
    return Level(sizes[first], labels[kept], weights[kept], targets[kept]), up


def union(parts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of several transducers in order, their counts added."""
    if not parts:
        return np.zeros((0, 1), dtype=np.int64), np.zeros(0, dtype=np.int64)
    found = [Transducer.load(p).rows() for p in parts]
    width = max(rows.shape[1] for rows, _ in found)
    padded = [np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) for rows, _ in found]
    return summed(np.concatenate(padded), np.concatenate([counts for _, counts in found]))
