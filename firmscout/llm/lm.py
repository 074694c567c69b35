"""Language-model scores by logistic context mixing.

A text is coded as its style (its most frequent accented character and kind of punctuation, which tell the language and
layout), then token by token, in order. A token (a word, or the end of the text) is coded bit by bit: the bytes of a
word and a space behind it, or one line feed for the end. Every bit is predicted by hashed contexts (the last 1, 2, 3
and 4 bytes and the word so far, each with the style, and the last 6 bytes), each a pair of counts in a table. Their
log odds are mixed by weights that two gates select (how well the long contexts are known; where in the word the bit
stands), learned online; the result is refined by an adaptive map from prediction to outcome.

Contexts of a token's head, its first ``HEAD`` bytes, reach across the space into the end of the token before (``HEAD``
bytes of it); those of the rest of the token lie within the token. So a token costs what its head costs behind that end
and what its rest costs: equal heads behind equal ends cost the same, equal words have equal rests, and a text's score,
which depends on the order of its tokens, is a sum over both.

On Spark: tasks number the words of a block of texts, by style, and emit the block's texts as bags of numbers and its
words, packed by part of the vocabulary, with their training counts. A part (words that begin alike) sums its words'
counts over all blocks. The tables are sums over all words of the training texts; the weights are learned from all of
them, each predicted as if it had occurred once less; then all words are scored once and their scores sent back to the
blocks. Heads are counted and scored in the same way, as words of a second kind. Words that begin alike share their bits' predictions, so sorted words cost a fraction. Tables and weights have
a fixed size (``SLOTS`` for each context), which bounds what is broadcast; the vocabulary stays distributed.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import parts_for, picked, staged, text_bytes
from firmscout.llm.hashing import mix, powers

#: Contexts by their number of bytes, and those of them that know the text's style; the word so far is one more.
ORDERS, STYLED = (1, 2, 3, 4, 6), (1, 2, 3, 4)
CONTEXTS = len(ORDERS) + 1
STYLES = 64
SLOTS = 1 << 20
#: Bytes of a token's head, and of the end of the token before that its contexts see.
HEAD = 2  # heads_of packs them into one number
#: Kinds of a key, in its first byte beside the style: a word coded whole, a head, and the rest of a word.
WHOLE, FRONT, REST = 64, 128, 192
#: Counts start at this much on either side.
START = 0.3
#: Words a task learns from, words that are predicted together, and words of one step of learning.
WORDS_PER_TASK, BATCH, STEP = 500_000, 1 << 14, 1 << 12
#: Tokens and words of a block, bytes of text for a part of the vocabulary, and bytes by which words begin alike.
BLOCK_TOKENS, BLOCK_WORDS, PART_BYTES, ALIKE = 1 << 22, 300_000, 4 << 20, 5
RATE = 0.02
LEVELS = np.array([0.5, 1.5, 7.5, 63.5])
GATES = ((len(LEVELS) + 1) ** 2, 64)
STEPS, REACH = 33, 8.0
END = b"\n"

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BLOCKS = "block long, part int, payload binary, styles array<long>"


def _pack(*parts: np.ndarray | list[bytes]) -> bytes:
    """Arrays, and lists of words (none holds a line feed), as compressed bytes."""
    raw = [b"\n".join(x) if isinstance(x, list) else x.tobytes() for x in parts]
    sizes = np.array([len(x) for x in raw], dtype=np.int64)
    return zstandard.ZstdCompressor(level=1).compress(sizes.tobytes() + b"".join(raw))


def _unpack(payload: bytes, *kinds: type) -> list:
    data = zstandard.ZstdDecompressor().decompress(payload)
    out, at = [], 8 * len(kinds)
    for size, kind in zip(np.frombuffer(data, dtype=np.int64, count=len(kinds)).tolist(), kinds):
        raw = data[at : at + size]
        out.append(raw.split(b"\n") if kind is bytes else np.frombuffer(raw, dtype=kind))
        at += size
    return out


def style_of(data: bytes) -> int:
    """The most frequent character beyond ASCII, if there are some, and the punctuation that abounds, if any."""
    b = np.frombuffer(data, dtype=np.uint8)
    if not len(b):
        return 0
    after = b[1:][b[:-1] >= 0xC0]
    accent = 1 + int(np.bincount(after, minlength=256).argmax()) % 15 if 200 * len(after) > len(b) else 0
    held = np.bincount(b, minlength=256)
    if 12 * held[list(b"#*$%&")].sum() > len(b):
        return 4 * accent + 1
    return 4 * accent + (2 if 12 * held[ord("!")] > len(b) else 3 if 20 * held[ord("|")] > len(b) else 0)


def heads_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct heads of a lower-cased text's tokens, the end included, as numbers, and how often they occur.

    A number has the last two bytes of the token before and the first two of the token; a missing one is a space.
    """
    gap = np.ones(len(data) + 2, dtype=np.int8)
    b = np.frombuffer(data, dtype=np.uint8)
    gap[1:-1] = (b == 32) | ((b >= 9) & (b <= 13))
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    long, space = ends - starts > 1, np.full(1, 32, dtype=np.uint32)
    b = np.append(b, np.uint8(32)).astype(np.uint32)
    before = np.where(long, b[ends - 2], 32) << 8 | b[ends - 1]
    head = b[starts] << 8 | np.where(long, b[starts + 1], 32)
    empty = space << 8 | space
    return np.unique(np.append(empty, before).astype(np.uint32) << 16 | np.append(head, empty).astype(np.uint32), return_counts=True)


def head_key(number: int) -> bytes:
    """A head behind the end of the token before and a space; a short one ends in its own space, that of the end is empty."""
    data = number.to_bytes(4, "big")
    return data[:2].strip(b" ") + b" " + (data[2:] if data[2] != 32 else b"")


def tokenised(docs: DataFrame, parts: int) -> DataFrame:
    """Rows of two kinds for each block: its texts (``part`` -1), and its words of one part of the vocabulary.

    ``docs`` has ``doc_id``, ``held`` and ``text``. A word is written behind its kind and style, the end as nothing behind it,
    and so is a head.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId(), 0

        def empty() -> tuple:
            number = count().__next__
            words, heads = ([defaultdict(number) for _ in range(STYLES)] for _ in range(2))
            return words, heads, [], [], []

        words, heads, texts, trained, fronts = empty()
        total = 0

        def flush() -> pa.RecordBatch:
            keys, places = [], []
            for style, (own, begun) in enumerate(zip(words, heads)):
                mark, front = bytes([REST + style]), bytes([FRONT + style])
                keys += [mark if w == END else mark + w for w in own]
                keys += [front + head_key(h) for h in begun]
                places += [*own.values(), *begun.values()]
            idx = np.array(places, dtype=np.int64)
            n = np.zeros(len(keys), dtype=np.int64)
            if trained:
                own, times = map(np.concatenate, zip(*fronts))
                n = np.bincount(np.concatenate(trained), minlength=len(keys))
                n = (n + np.bincount(own, weights=times, minlength=len(keys)).astype(np.int64))[idx]
            part = np.fromiter((zlib.crc32(k[1 : 1 + ALIKE]) % parts for k in keys), dtype=np.int64, count=len(keys))
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=parts)).tolist()
            ids, held, styles, sizes, bags = zip(*texts)
            known = np.array([i is not None for i in ids], dtype=np.uint8)
            payloads = [
                _pack(
                    np.array([i or 0 for i in ids], dtype=np.int64), known, np.array(held, dtype=np.uint8),
                    np.array(styles, dtype=np.uint8), np.array(sizes, dtype=np.int64), np.concatenate(bags),
                )
            ]
            names = [-1]
            for a, b in zip(cuts[:-1], cuts[1:]):
                own = order[a:b]
                names.append(int(part[own[0]]))
                payloads.append(_pack([keys[i] for i in own.tolist()], idx[own].astype(np.uint32), n[own].astype(np.uint32)))
            seen = np.bincount([s for s, h in zip(styles, held) if not h], minlength=STYLES).tolist()
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([task << 32 | serial] * len(names), pa.int64()),
                    "part": pa.array(names, pa.int32()),
                    "payload": pa.array(payloads, pa.binary()),
                    "styles": pa.array([seen] + [None] * (len(names) - 1), pa.list_(pa.int64())),
                }
            )

        for batch in batches:
            for doc, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                lower = raw.translate(_LOWER)
                style, data = style_of(raw), lower.split()
                data.append(END)
                ids = np.fromiter(map(words[style].__getitem__, data), dtype=np.uint32, count=len(data))
                own, times = np.unique(ids, return_counts=True)
                codes, often = heads_of(lower)
                front = np.fromiter(map(heads[style].__getitem__, codes.tolist()), dtype=np.uint32, count=len(codes))
                own, times = np.append(own, front), np.append(times, often)
                order = np.argsort(own)
                own, times = own[order], times[order]
                texts.append((doc, held, style, len(own), np.concatenate([np.diff(own, prepend=np.uint32(0)), times]).astype(np.uint32)))
                if not held:
                    trained.append(ids)
                    fronts.append((front, often))
                total += len(data)
                if total >= BLOCK_TOKENS or sum(map(len, [*words, *heads])) >= BLOCK_WORDS:
                    yield flush()
                    (words, heads, texts, trained, fronts), total, serial = empty(), 0, serial + 1
        if texts:
            yield flush()

    return docs.mapInArrow(run, _BLOCKS)


def _united(group: pa.Table) -> pa.Table:
    """A part of the vocabulary: its words in order, their training counts by style and over all styles.

    Heads are no words: over all styles they count as -1.
    """
    sums: dict[bytes, int] = {}
    for payload in group.column("payload").to_pylist():
        keys, _, n = _unpack(payload, bytes, np.uint32, np.uint32)
        for key, times in zip(keys, n.tolist()):
            sums[key] = sums.get(key, 0) + times
    keys = sorted(sums)
    n = np.array([sums[k] for k in keys], dtype=np.int64)
    over: dict[bytes, int] = {}
    for key, times in zip(keys, n.tolist()):
        if key[0] >= REST:
            over[key[1:]] = over.get(key[1:], 0) + times
    c = np.array([over[k[1:]] if k[0] >= REST else -1 for k in keys], dtype=np.int64)
    return pa.table(
        {
            "part": group.column("part").slice(0, 1),
            "payload": pa.array([_pack(keys, n, c)], pa.binary()),
            "tokens": pa.array([int(n[c >= 0].sum())], pa.int64()),
            "known": pa.array([sum(x > 0 for x in over.values())], pa.int64()),
            "words": pa.array([len(keys)], pa.int64()),
        }
    )


def _trained(batch: pa.RecordBatch, size: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words of the training texts and their counts, ``size`` at a time."""
    for payload in batch.column("payload").to_pylist():
        keys, n, _ = _unpack(payload, bytes, np.int64, np.int64)
        own = np.flatnonzero(n)
        for at in range(0, len(own), size):
            part = own[at : at + size]
            yield [keys[i] for i in part.tolist()], n[part].astype(np.float64)


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The same, parts of the vocabulary put together until there are ``size`` words."""
    keys, times = [], []
    for batch in batches:
        for own, n in _trained(batch, size):
            keys += own
            times.append(n)
            if len(keys) >= size:
                yield keys, np.concatenate(times)
                keys, times = [], []
    if keys:
        yield keys, np.concatenate(times)


class Events:
    """The bits of a batch of words: what they are, their contexts' slots, and where in the word they stand.

    A word is its kind and style in one byte, then its bytes. Bytes that only are context (of a head the end of the token
    before, of a rest the head) have columns, too, but do not count. Arrays have a row for each of a byte's eight bits
    and a column for each byte; a byte behind the same bytes of the same style as in the word before shares that word's column.
    """

    SHARED = 32

    def __init__(self, keys: list[bytes]):
        coded = [self._coded(k) for k in keys]
        self.sizes = np.array([len(w) for w in coded]) - 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        data = np.frombuffer(b"".join(coded), dtype=np.uint8)
        inner = np.ones(len(data), dtype=bool)
        inner[self.starts + np.arange(len(coded))] = False
        style, wide = data[~inner].astype(np.uint64), data[inner].astype(np.uint64)
        place = np.arange(len(wide)) - np.repeat(self.starts, self.sizes)
        known = np.array([self._known(k) for k in keys])
        self.live = place >= np.repeat(known, self.sizes)
        self.column, own = self._shared(coded, place)
        here, at = wide[own], place[own]
        word = np.repeat(np.arange(len(coded)), self.sizes)[own]
        mark = style[word] * np.uint64(0xD6E8FEB86659FD93)
        contexts, history = [], np.zeros(len(own), dtype=np.uint64)
        for back in range(1, ORDERS[-1] + 1):
            earlier = np.where(at >= back, wide[np.maximum(own - back, 0)] + np.uint64(1), np.uint64(0))
            history = history * np.uint64(257) + earlier
            if back in ORDERS:
                last = history * np.uint64(16) + np.uint64(back)
                contexts.append(mix(last + mark if back in STYLED else last))
        up, down = powers(len(wide))
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((wide + np.uint64(1)) * up)])
        first = self.starts[word]
        contexts.append(mix((sums[own] - sums[first]) * down[first] + at.astype(np.uint64) + mark))
        bit = np.arange(8, dtype=np.uint8)[:, None]
        low = here.astype(np.uint8)
        self.bits = ((low[None, :] >> (7 - bit)) & 1).astype(np.float32)
        node = ((np.uint64(1) << bit.astype(np.uint64)) | (here[None, :] >> (8 - bit).astype(np.uint64))) * _GOLD
        self.slots = [(((c[None, :] + node) * _GOLD) >> np.uint64(44)).astype(np.int32) for c in contexts]
        before = np.where(style < REST, known, 0)[word]
        self.place = np.clip(at - before, 0, 7)[None, :] * 8 + bit

    @staticmethod
    def _coded(key: bytes) -> bytes:
        """A key's bytes with what closes it: a space behind a word, a line feed (no word begins so) for the end."""
        if FRONT <= key[0] < REST:
            return key + END if key.index(b" ", 1) == len(key) - 1 else key
        return key + b" " if len(key) > 1 else key + END

    @staticmethod
    def _known(key: bytes) -> int:
        """How many bytes behind the first are context only; the rest of a word that its head holds whole is empty."""
        if key[0] < FRONT:
            return 0
        return key.index(b" ", 1) if key[0] < REST else HEAD if len(key) > HEAD else len(key)

    def _shared(self, coded: list[bytes], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The column of every byte, and the byte that each column stands for first."""
        width = self.SHARED + 1
        table = np.array(coded, dtype=f"S{width}").view(np.uint8).reshape(len(coded), width)
        same = table[1:] == table[:-1]
        alike = np.zeros(len(coded), dtype=np.int64)  # bytes in common with the word before, its style included
        alike[1:] = np.where(same.all(axis=1), width, same.argmin(axis=1))
        new = place >= np.repeat(alike - 1, self.sizes)
        root = np.arange(len(place))
        for p in range(min(self.SHARED, int(self.sizes.max(initial=0)))):
            at = self.starts[self.sizes > p] + p
            root[at] = np.maximum.accumulate(np.where(new[at], at, 0))
        return (np.cumsum(new) - 1)[root], np.flatnonzero(new)

    def sides(self, k: int) -> np.ndarray:
        """Where the counts of the bits that came stand in a context's slots."""
        return self.slots[k] * 2 + self.bits.astype(np.int32)

    def over_words(self, values: np.ndarray) -> np.ndarray:
        """Sums of per-bit values over each word."""
        return np.add.reduceat(values.sum(axis=0, dtype=np.float64)[self.column] * self.live, self.starts)

    def per_bit(self, values: np.ndarray) -> np.ndarray:
        """For each column the sum of its words' values."""
        weights = np.repeat(values, self.sizes) * self.live
        return np.bincount(self.column, weights=weights, minlength=self.bits.shape[1])[None, :]


def table_sums(vocabulary: DataFrame, tasks: int) -> np.ndarray:
    """Counts of 0 and 1 bits for every context and slot, over all words by their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        # A count of a batch runs over all slots, so a batch is many words.
        for keys, times in _gathered(batches, BATCH):
            events = Events(keys)
            weight = np.broadcast_to(events.per_bit(times), events.bits.shape).ravel()
            if sums is None:
                sums = np.zeros((CONTEXTS, SLOTS, 2), dtype=np.float32)
            for k in range(CONTEXTS):
                sums[k] += np.bincount(events.sides(k).ravel(), weights=weight, minlength=2 * SLOTS).reshape(SLOTS, 2)
        if sums is not None:
            packer = zstandard.ZstdCompressor(level=1)
            for k in range(CONTEXTS):
                for side in range(2):
                    yield pa.RecordBatch.from_pydict(
                        {"part": pa.array([2 * k + side], pa.int32()), "sums": pa.array([packer.compress(sums[k, :, side].tobytes())], pa.binary())}
                    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of one part come one after the other; only one sum is held.
        part, total = None, None
        for batch in batches:
            for own, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(zstandard.ZstdDecompressor().decompress(sums), dtype=np.float32)
                if own != part:
                    if part is not None:
                        yield packed(part, total)
                    part, total = own, np.zeros(SLOTS)
                total += values
        if part is not None:
            yield packed(part, total)

    def packed(part: int, total: np.ndarray) -> pa.RecordBatch:
        data = zstandard.ZstdCompressor(level=1).compress(total.astype(np.float32).tobytes())
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "sums": pa.array([data], pa.binary())})

    kinds = "part int, sums binary"
    words = vocabulary.select("part", "payload").repartition(tasks, "part")
    once = words.mapInArrow(run, kinds).repartition(2 * CONTEXTS, "part").sortWithinPartitions("part").mapInArrow(add, kinds)
    out = np.zeros((CONTEXTS, SLOTS, 2), dtype=np.float32)
    for row in once.collect():  # a row for each context and side
        values = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row["sums"])), dtype=np.float32)
        out[row["part"] // 2, :, row["part"] % 2] = values
    return out


class Odds:
    """What the mixer takes from the counts, for all slots at once: log odds of every context, levels of two of them.

    There are fewer slots than bits to predict. With ``less`` a slot has a value for either bit that may come, as that much
    is taken off its count.
    """

    LEVELLED = (3, CONTEXTS - 1)

    def __init__(self, tables: np.ndarray, less: float):
        self.less = less
        shape = (CONTEXTS, SLOTS, 2) if less else (CONTEXTS, SLOTS)
        self.odds = np.empty(shape, dtype=np.float32)
        self.levels = {k: np.empty(shape[1:], dtype=np.int8) for k in self.LEVELLED}
        for k in range(CONTEXTS):
            for bit in (0, 1) if less else (None,):
                zero, one = tables[k, :, 0], tables[k, :, 1]
                if bit is not None:
                    zero, one = np.maximum(zero - less * (1 - bit), 0), np.maximum(one - less * bit, 0)
                at = (..., bit) if less else ...
                self.odds[k][at] = np.log((one + START) / (zero + START))
                if k in self.levels:
                    self.levels[k][at] = np.searchsorted(LEVELS, zero + one)

    def of(self, events: Events) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Log odds of all contexts at every bit, and the levels."""
        odds, levels = np.empty((CONTEXTS, *events.bits.shape), dtype=np.float32), {}
        for k in range(CONTEXTS):
            at = events.sides(k) if self.less else events.slots[k]
            np.take(self.odds[k].ravel(), at, out=odds[k], mode="clip")  # all are within; otherwise take buffers its output
            if k in self.levels:
                levels[k] = self.levels[k].ravel()[at].astype(np.intp)
        return odds, levels


class Mixer:
    """Gated weights over the contexts' log odds and an adaptive map of the result."""

    def __init__(self, weights: list[np.ndarray] | None = None, hits: np.ndarray | None = None):
        self.weights = weights or [np.full((n, CONTEXTS), 0.2, dtype=np.float32) for n in GATES]
        self.hits = np.zeros((len(LEVELS) + 1, STEPS, 2)) if hits is None else hits
        self.moments = [np.zeros(w.shape) for w in self.weights]

    def inputs(self, tables: np.ndarray | Odds, events: Events, less: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of all contexts, the first gate and the level of the word context.

        ``less`` is taken off the counts of the bit that came. ``tables`` are counts, or the ``Odds`` of counts and ``less``.
        """
        known = tables if isinstance(tables, Odds) else Odds(tables, less)
        odds, levels = known.of(events)
        word = levels[CONTEXTS - 1]
        return odds, word * (len(LEVELS) + 1) + levels[3], word

    def mixed(self, odds: np.ndarray, gates: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        total = np.zeros(odds.shape[1:], dtype=np.float32)
        for weights, gate in zip(self.weights, gates):
            for k in range(CONTEXTS):
                total += weights[:, k][gate] * odds[k]
        return np.clip(total, -12, 12)

    @staticmethod
    def step_of(mixed: np.ndarray) -> np.ndarray:
        return np.rint((np.clip(mixed, -REACH, REACH) + REACH) * ((STEPS - 1) / (2 * REACH))).astype(np.int32)

    def learn(self, tables: np.ndarray | Odds, events: Events, weight: np.ndarray) -> None:
        """One online step over a batch; every token is predicted as if it had occurred once less."""
        odds, gate, word = self.inputs(tables, events, 1.0)
        gates = gate, events.place
        mixed = self.mixed(odds, gates)
        share = np.broadcast_to(weight, mixed.shape)
        error = share * (events.bits - 1 / (1 + np.exp(-mixed)))
        for i, own in enumerate(gates):
            flat = own.ravel()
            n = len(self.weights[i])
            mass = np.bincount(flat, weights=share.ravel(), minlength=n)[:, None]
            slope = np.stack([np.bincount(flat, weights=(error * odds[k]).ravel(), minlength=n) for k in range(CONTEXTS)], axis=1)
            slope /= np.maximum(mass, 1e-9)
            self.moments[i] = 0.95 * self.moments[i] + 0.05 * slope**2
            self.weights[i] = (self.weights[i] + RATE * slope / (np.sqrt(self.moments[i]) + 1e-6) * (mass > 0)).astype(np.float32)
        cell = (word * STEPS + self.step_of(mixed)).ravel()
        size = self.hits[..., 0].size
        self.hits[..., 0] += np.bincount(cell, weights=share.ravel(), minlength=size).reshape(self.hits.shape[:2])
        self.hits[..., 1] += np.bincount(cell, weights=(share * events.bits).ravel(), minlength=size).reshape(self.hits.shape[:2])

    def refined(self) -> np.ndarray:
        """The adaptive map: probability of a 1 for every level and step, drawn towards the mixer's own."""
        centre = 1 / (1 + np.exp(-np.linspace(-REACH, REACH, STEPS)))
        return (self.hits[..., 1] + 20 * centre) / (self.hits[..., 0] + 20)

    def scores(self, tables: np.ndarray | Odds, events: Events, refined: np.ndarray) -> np.ndarray:
        """The log10 probability of every token."""
        odds, gate, word = self.inputs(tables, events, 0.0)
        mixed = self.mixed(odds, (gate, events.place))
        p = 0.5 / (1 + np.exp(-mixed.astype(np.float64))) + 0.5 * refined[word, self.step_of(mixed)]
        return events.over_words(np.log10(np.where(events.bits > 0, p, 1 - p)))


def learned(vocabulary: DataFrame, tables, tasks: int) -> Mixer:
    """Weights learned online in each task over its words and averaged by the tokens they stand for.

    ``tables`` is a broadcast of the counts.
    """
    sizes = [n * CONTEXTS for n in GATES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, tokens, odds = Mixer(), 0.0, None
        for batch in batches:
            for keys, counts in _trained(batch, STEP):
                events, odds = Events(keys), odds or Odds(tables.value, 1.0)
                mixer.learn(odds, events, events.per_bit(counts))
                tokens += counts.sum()
        if tokens:
            flat = np.concatenate([*[w.ravel() for w in mixer.weights], mixer.hits.ravel()]).astype(np.float64)
            yield pa.RecordBatch.from_pydict({"tokens": [tokens], "flat": [flat.tolist()]})

    words = vocabulary.select("part", "payload").repartition(tasks, "part").sortWithinPartitions("part")
    rows = words.mapInArrow(run, "tokens double, flat array<double>").collect()  # some 900 numbers for each task
    if not rows:
        return Mixer()
    rows = sorted(rows, key=lambda r: (-r["tokens"], r["flat"][:8]))
    share = np.array([r["tokens"] for r in rows])
    flat = np.array([r["flat"] for r in rows])
    weights, at = [], 0
    for n, size in zip(GATES, sizes):
        mean = (flat[:, at : at + size] * share[:, None]).sum(axis=0) / share.sum()
        weights.append(mean.reshape(n, CONTEXTS).astype(np.float32))
        at += size
    return Mixer(weights, flat[:, at:].sum(axis=0).reshape(len(LEVELS) + 1, STEPS, 2))


def scored_words(vocabulary: DataFrame, tables, mixer: Mixer) -> DataFrame:
    """``part, payload``: the words of each part with their counts and log10 probabilities."""
    refined = mixer.refined()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = None
        for batch in batches:
            for part, payload in zip(batch.column("part").to_pylist(), batch.column("payload").to_pylist()):
                odds = odds or Odds(tables.value, 0.0)
                keys, _, c = _unpack(payload, bytes, np.int64, np.int64)
                p = [mixer.scores(odds, Events(keys[i : i + BATCH]), refined) for i in range(0, len(keys), BATCH)]
                packed = _pack(keys, c, np.concatenate(p))
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "payload": pa.array([packed], pa.binary())})

    return vocabulary.select("part", "payload").mapInArrow(run, "part int, payload binary")


def _answered(asked: pa.Table, scored: pa.Table) -> pa.Table:
    """For every block its words' numbers, counts and scores in one part."""
    keys, c, p = _unpack(scored.column("payload")[0].as_py(), bytes, np.int64, np.float64)
    place = {k: i for i, k in enumerate(keys)}
    payloads = []
    for payload in asked.column("payload").to_pylist():
        own, idx, _ = _unpack(payload, bytes, np.uint32, np.uint32)
        at = np.fromiter(map(place.__getitem__, own), dtype=np.int64, count=len(own))
        payloads.append(_pack(idx, c[at], p[at]))
    return pa.table({"block": asked.column("block"), "payload": pa.array(payloads, pa.binary())})


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Learns from the rows (``doc_id, text``) whose crc32 of the id is not 1 modulo 5; a null id is learned from. A null
    or empty text is its end alone. Repeated rows count and are scored each; extra columns are ignored; if nothing is
    learned, all counts are 0; no rows give no rows.
    """
    docs = picked(docs, "doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    parts = parts_for(text_bytes(docs), PART_BYTES)
    rows = staged(tokenised(docs.select(F.col("doc_id").cast("long"), held.alias("held"), "text"), parts))
    blocks = rows.where("part >= 0").select("block", "part", "payload")
    kinds = "part int, payload binary, tokens long, known long, words long"
    vocabulary = staged(blocks.groupBy("part").applyInArrow(_united, kinds))
    n, v, words = (x or 0 for x in vocabulary.agg(F.sum("tokens"), F.sum("known"), F.sum("words")).first())
    tasks = max(1, -(-words // WORDS_PER_TASK))
    seen = dict(rows.where("part < 0").select(F.posexplode("styles")).groupBy("pos").agg(F.sum("col")).collect())
    total_texts = sum(seen.values())
    style_cost = np.log10([(seen.get(k, 0) + 0.5) / (total_texts + 0.5 * STYLES) for k in range(STYLES)])
    tables = docs.sparkSession.sparkContext.broadcast(table_sums(vocabulary, tasks))
    mixer = learned(vocabulary, tables, tasks)
    scored = scored_words(vocabulary, tables, mixer)
    found = blocks.groupBy("part").cogroup(scored.groupBy("part")).applyInArrow(_answered, "block long, payload binary")

    def total(texts: pa.Table, answers: pa.Table) -> pa.Table:
        got = [_unpack(x, np.uint32, np.int64, np.float64) for x in answers.column("payload").to_pylist()]
        order = np.concatenate([x[0] for x in got]).astype(np.int64)
        c, p = np.zeros(len(order)), np.zeros(len(order))
        c[order], p[order] = np.concatenate([x[1] for x in got]), np.concatenate([x[2] for x in got])
        base = np.where(c < 0, 0, np.log10((np.maximum(c, 0) + 0.5) / (n + 0.5 * (v + 1))))
        payload = texts.column("payload")[0].as_py()
        ids, known, held, styles, sizes, bags = _unpack(payload, np.int64, np.uint8, np.uint8, np.uint8, np.int64, np.uint32)
        bags = bags.astype(np.int64)
        columns = [[], [], [], []]
        at = 0
        for style, size in zip(styles.tolist(), sizes.tolist()):
            own, times = np.cumsum(bags[at : at + size]), bags[at + size : at + 2 * size]
            at += 2 * size
            values = times[c[own] >= 0].sum(), times[c[own] > 0].sum(), times @ base[own], style_cost[style] + times @ p[own]
            for column, value in zip(columns, values):
                column.append(value.item())
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=known == 0),
                "held_out": pa.array(held > 0),
                "n_tokens": pa.array(columns[0], pa.int64()),
                "n_known": pa.array(columns[1], pa.int64()),
                "train_tokens": pa.array([n] * len(ids), pa.int64()),
                "base_score": pa.array(columns[2], pa.float64()),
                "score": pa.array(columns[3], pa.float64()),
            }
        )

    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    texts = rows.where("part < 0").select("block", "payload")
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(total, kinds)
