"""Exact substring deduplication with run-length compressed indexes.

A byte goes if it lies in a ``LENGTH``-byte string that also starts in a document with a smaller id.

Routing. Documents are packed into blocks of 16 megabytes by a hash of their id. Every window of ``LENGTH`` bytes is
dealt to a bucket by its anchor, the 20-byte string with the least hash in it, so equal windows meet in one bucket
wherever they stand. Neighbouring windows mostly share their anchor and travel together as one piece of at most 80
bytes. Blocks first send the hashes of their anchors alone; buckets answer which of them a second document has, and only
the pieces of those are sent, equal ones of a block once. Anchors that are very frequent are found beforehand
(``common_anchors``) and chosen last, so that windows at the edge of a common passage are dealt by what is beside it;
windows wholly within common passages are equal pieces.

Index. Of equal pieces all but those of the smallest document are covered as a whole. The distinct pieces that share
an anchor with others are indexed: a Burrows-Wheeler transform of their texts, kept as its runs (head, character, LF of
the head), with samples at the ends of the runs of suffixes that agree in ``LENGTH`` bytes (the smallest document
there). All pieces are then streamed backwards through the index, a step for all of them at a time; at every position
the matching statistic is at least ``LENGTH`` where that many bytes are left, and the sample says whether the match is
in a smaller document.

Covered ranges go back to the blocks and are cut out there. Blocks, buckets and answers are of bounded size; their
number grows with the corpus. All that is shuffled is packed and compressed: one message from a block to a bucket and
back, whatever the parts a block is looked at in. Messages grow with the square of the corpus, so blocks and buckets are
as large as a task's memory allows, and what a message costs stays small beside what it carries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import numbered, parts_for, picked, text_bytes
from firmscout.llm.hashing import mix, powers

LENGTH = 50
ANCHOR = 20
#: Bytes of text for each bucket, buckets' worth of text for each block, and the piece of text that a task looks at in one go.
BUCKET_BYTES = 8 << 20
BLOCK_BUCKETS = 2
CHUNK = 1 << 20
#: Pieces whose bytes are compared in one go.
COMPARED = 1 << 14
#: Symbols that are indexed together; anchors with more are indexed alone.
INDEX_SYMBOLS = 1 << 20
_SPREAD = LENGTH - ANCHOR + 1  # anchors to choose from in a window
_POSITION = np.uint64((1 << 24) - 1)
_KEY_BITS = np.uint64(40)  # of an anchor's hash
_KEY = np.uint64((1 << 40) - 1)
_NO_ID = np.iinfo(np.int64).max  # a null id is larger than all others

PACKED = "{0} int, payload binary"


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; those of a number are kept plane by plane, as high ones are mostly 0."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays]
    sizes = np.array([len(a) for a in arrays], dtype=np.int64)
    return zstandard.ZstdCompressor(level=3).compress(sizes.tobytes() + b"".join(planes))


def _unpack(payload: bytes, *types: type) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    out, at = [], 8 * len(types)
    for n, kind in zip(np.frombuffer(data, dtype=np.int64, count=len(types)), map(np.dtype, types)):
        end = at + int(n) * kind.itemsize
        planes = np.frombuffer(data[at:end], dtype=np.uint8).reshape(kind.itemsize, int(n))
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(int(n)))
        at = end
    return out


def _rows(name: str, names: list, payloads: list, **more: list) -> pa.Table:
    columns = {name: pa.array(names, pa.int32()), **{k: pa.array(v, pa.int32()) for k, v in more.items()}}
    return pa.table({**columns, "payload": pa.array(payloads, pa.binary())})


def _cuts(sorted_names: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Begin and end of every run of equal names below ``n``."""
    edges = np.flatnonzero(np.diff(sorted_names, prepend=-1, append=n))
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + n)`` over all (s, n)."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def anchors(text: np.ndarray) -> np.ndarray:
    """For every ``ANCHOR``-byte string of ``text`` a 40-bit hash, shifted left by 24."""
    x = text.astype(np.uint64)
    for width in (1, 2, 4):
        x = (x[:-width] << np.uint64(8 * width)) | x[width:]
    n = len(text) - ANCHOR + 1
    out = x[:n].copy()
    for at in (ANCHOR - 16, ANCHOR - 8) if ANCHOR > 16 else (ANCHOR - 8,):  # eight bytes each, the last ones overlap
        out = out * np.uint64(0x9E3779B97F4A7C15) + x[at : at + n]
    return mix(out) & ~_POSITION


def chosen(text: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For every window of ``text`` its anchor's hash and, in the last 24 bits, the anchor's position."""
    found = anchors(text)
    if len(common):
        # Common anchors come after all others; the hash itself gives way by one bit.
        found >>= np.uint64(1)
        found &= ~_POSITION
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        found |= (common[at] == found).astype(np.uint64) << np.uint64(63)
    found |= np.arange(len(found), dtype=np.uint64)
    # Least of 2, 4, 8, ... neighbours, then of two overlapping runs that make up a window.
    width = 1
    while 2 * width <= _SPREAD:
        found = np.minimum(found[:-width], found[width:])
        width *= 2
    return np.minimum(found[: len(found) - (_SPREAD - width)], found[_SPREAD - width :])


def _chunks(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts of a batch in chunks: bytes, and of every part its start there, id, offset in its text and text's tag.

    Long texts are cut into parts that overlap by all but one byte of a window.
    """
    data, starts, ids, offsets, tags, total = [], [], [], [], [], 0
    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
        raw = text.as_buffer().to_pybytes() if text.is_valid else b""
        if len(raw) < LENGTH:
            continue
        tag = _tag(raw)
        for at in range(0, len(raw) - LENGTH + 1, CHUNK):
            part = raw[at : at + CHUNK + LENGTH - 1]
            if total and total + len(part) > CHUNK + LENGTH:
                yield _chunk(data, starts, ids, offsets, tags)
                data, starts, ids, offsets, tags, total = [], [], [], [], [], 0
            data.append(part)
            starts.append(total)
            ids.append(_NO_ID if doc is None else doc)
            offsets.append(at)
            tags.append(tag)
            total += len(part)
    if data:
        yield _chunk(data, starts, ids, offsets, tags)


def _tag(raw: bytes) -> int:
    """Tells apart different texts that carry the same id."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=3).digest(), "little")


def _chunk(data: list, *parts: list) -> tuple:
    return np.frombuffer(b"".join(data), dtype=np.uint8), *[np.array(p, dtype=np.int64) for p in parts]


def _pieces(text: np.ndarray, starts: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first byte, length in bytes, anchor's hash, part."""
    windows = chosen(text, common)
    part = np.zeros(len(text), dtype=np.int64)
    part[starts[1:]] = 1
    np.cumsum(part, out=part)
    inside = part[: len(windows)] == part[LENGTH - 1 :]
    change = np.flatnonzero((windows[1:] != windows[:-1]) | (inside[1:] != inside[:-1])) + 1
    first = np.concatenate([[0], change])
    first = first[inside[first]]
    last = np.concatenate([change, [len(windows)]])
    last = last[inside[last - 1]]
    return first, last - first + LENGTH - 1, windows[first] >> np.uint64(24), part[first]


def _hashed(text: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every piece, from sums over the text before its end and before its first byte."""
    up, down = powers(len(text))
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return mix((sums[first + length] - sums[first]) * down[first] + length.astype(np.uint64))


def _routes(key: np.ndarray, buckets: int) -> np.ndarray:
    """Anchors' hashes behind their buckets, so that their order is that of buckets, and of hashes in a bucket."""
    return (key % np.uint64(buckets)) << _KEY_BITS | key


def _bucket(route: np.ndarray) -> np.ndarray:
    return (route >> _KEY_BITS).astype(np.int32)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of values, and where in it the runs of equal ones begin."""
    order = np.argsort(values)
    return order, np.flatnonzero(np.diff(values[order], prepend=~values[order[:1]]))


def _block_pieces(rows: pa.Table, buckets: int, common: np.ndarray, sent: bool = True) -> tuple[np.ndarray, ...]:
    """Of all pieces of a block: route, id, and if they may be ``sent`` hash and length, first byte, place and the text.

    A hash stands before its piece's length, which takes eight bits; a place before its text's tag.
    """
    found, texts, at = [], [], 0
    for text, starts, ids, offsets, tags in _chunks(rows):
        first, length, key, part = _pieces(text, starts, common)
        columns = [_routes(key, buckets), ids[part]]
        if sent:
            same = _hashed(text, first, length) << np.uint64(32) >> np.uint64(24) | length.astype(np.uint64)
            columns += [same, first + at, (first - starts[part] + offsets[part]) << 24 | tags[part]]
            texts.append(text)
            at += len(text)
        found.append(columns)
    kinds = [np.uint64, np.int64, np.uint64, np.int64, np.int64][: 5 if sent else 2]
    columns = [np.concatenate([np.zeros(0, dtype=k), *x]) for k, x in zip(kinds, zip(*found) if found else [[]] * 5)]
    return *columns, *([np.concatenate([np.zeros(0, dtype=np.uint8), *texts])] if sent else [])


def _ask(rows: pa.Table, block: int, buckets: int, common: np.ndarray) -> pa.Table:
    """The different anchors of a block by bucket, and whether two documents of the block have them."""
    route, ids = _block_pieces(rows, buckets, common, sent=False)
    order, heads = _runs(route)
    if not len(heads):
        return _rows("bucket", [], [], block=[])
    ids, route = ids[order], route[order[heads]]
    both = (np.minimum.reduceat(ids, heads) != np.maximum.reduceat(ids, heads)).view(np.uint8)
    names, payloads, key, bucket = [], [], route & _KEY, _bucket(route)
    for a, b in _cuts(bucket, buckets):
        names.append(bucket[a])
        payloads.append(_pack(np.diff(key[a:b], prepend=np.uint64(0)), both[a:b]))
    return _rows("bucket", names, payloads, block=[block] * len(names))


def _answer(group: pa.Table) -> pa.Table:
    """For every block of a bucket the bits of its anchors that two documents have; none if there are none."""
    found = [_unpack(p, np.uint64, np.uint8) for p in group.column("payload").to_pylist()]
    keys = np.concatenate([np.cumsum(k, dtype=np.uint64) for k, _ in found])
    hit = np.concatenate([m for _, m in found]) > 0
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    # What two documents of one block have, no other block need have.
    sizes = np.array([len(k) for k, _ in found])
    ends = np.cumsum(sizes)
    any_hit = np.add.reduceat(hit, ends - sizes) > 0
    bits = [np.packbits(hit[e - n : e]).tobytes() for e, n, x in zip(ends, sizes, any_hit) if x]
    keep = np.flatnonzero(any_hit)
    bucket = group.column("bucket")[0].as_py()
    return _rows("block", group.column("block").take(keep).to_pylist(), bits, bucket=[bucket] * len(bits))


def _unequal(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which of the stretches that begin at ``a`` and at ``b`` differ, byte by byte."""
    out = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), COMPARED):
        own = slice(at, at + COMPARED)
        differ = text[_ranges(a[own], length[own])] != text[_ranges(b[own], length[own])]
        out[own] = np.logical_or.reduceat(differ, np.cumsum(length[own]) - length[own])
    return out


def _send(rows: pa.Table, answers: pa.Table, buckets: int, common: np.ndarray) -> pa.Table:
    """The pieces of a block whose anchors a second document has, packed by bucket."""
    route, ids, same, first, place, text = _block_pieces(rows, buckets, common)
    order, heads = _runs(route)
    different = route[order[heads]]
    wanted = np.zeros(len(different), dtype=bool)
    at = {name: (a, b) for (a, b), name in ((cut, int(different[cut[0]] >> _KEY_BITS)) for cut in _cuts(_bucket(different), buckets))}
    for name, bits in zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist()):
        a, b = at[name]
        wanted[a:b] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=b - a) > 0
    own = order[np.repeat(wanted, np.diff(np.append(heads, len(order))))]
    own = own[np.lexsort((same[own], route[own]))]
    route, ids, same, first, place = (x[own] for x in (route, ids, same, first, place))
    length = (same & np.uint64(255)).astype(np.int64)
    new = np.ones(len(own), dtype=bool)
    new[1:] = (same[1:] != same[:-1]) | (route[1:] != route[:-1])
    alike = np.flatnonzero(~new)  # a hash only suggests that pieces are equal
    new[alike] = _unequal(text, first[alike - 1], first[alike], length[alike])
    heads = np.flatnonzero(new)
    copies = np.diff(np.append(heads, len(own))).astype(np.int32)
    first, key, same, length = first[heads], (route & _KEY)[heads], (same >> np.uint64(8)).astype(np.uint32)[heads], length[heads]
    names, payloads, bucket = [], [], _bucket(route[heads])
    ends = np.append(heads, len(own))
    for a, b in _cuts(bucket, buckets):
        every = slice(ends[a], ends[b])
        body = text[_ranges(first[a:b], length[a:b])]
        difference = np.diff(key[a:b], prepend=np.uint64(0))
        names.append(bucket[a])
        payloads.append(_pack(length[a:b].astype(np.uint8), difference, same[a:b], copies[a:b], ids[every], place[every], body))
    return _rows("bucket", names, payloads)


def _sorted(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of so many bits in order, and their places, which decide between equal ones; sorted as one number if both fit."""
    room = np.uint64(max(1, (len(key) - 1).bit_length()))
    if bits + int(room) > 64:
        order = np.argsort(key, kind="stable")
        return key[order], order
    both = np.sort(key << room | np.arange(len(key), dtype=np.uint64))
    return both >> room, (both & ((np.uint64(1) << room) - np.uint64(1))).astype(np.int64)


class Marks:
    """Marked places among ``n``, one bit each, with the marks before every 64 of them."""

    def __init__(self, places: np.ndarray, n: int):
        bits = np.zeros(-(-n // 64) * 64, dtype=np.uint8)
        bits[places] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def upto(self, at: np.ndarray) -> np.ndarray:
        """How many marks there are up to a place, itself included."""
        word = at >> 6
        return self.before[word] + np.bitwise_count(self.words[word] << (63 - (at & 63)).astype(np.uint64))


class RunIndex:
    """A run-length compressed Burrows-Wheeler index of short texts, each with a document.

    ``smallest`` streams all texts backwards and gives, for every position with ``LENGTH`` bytes left, the smallest
    document in which those bytes occur.
    """

    def __init__(self, body: np.ndarray, length: np.ndarray, docs: np.ndarray):
        self.length, self.body = length, body
        n_texts, n = len(length), int(length.sum()) + len(length)
        # Symbols are bytes plus one; every text ends with a 0, and the earlier text's 0 is the smaller.
        self.ends = np.cumsum(length + 1) - 1
        symbols = np.zeros(n, dtype=np.uint64)
        symbols[np.delete(np.arange(n), self.ends)] = body.astype(np.uint64) + np.uint64(1)
        text_of = np.repeat(np.arange(n_texts), length + 1)
        left = self.ends[text_of] - np.arange(n)
        order, at_28 = self._ranks(symbols, left)
        # The transform's runs. What stands before a text's first byte is never asked for and counts as a 0.
        before = np.where(np.concatenate([[True], symbols[:-1] == 0])[order], 0, symbols[order - 1]).astype(np.int16)
        self.heads = np.flatnonzero(np.diff(before, prepend=-1))
        self.run = Marks(self.heads, n)
        self.characters = before[self.heads]
        sizes = np.diff(np.append(self.heads, n))
        by_character = np.argsort(self.characters, kind="stable")
        mapped = np.zeros(len(self.heads), dtype=np.int64)
        placed = np.cumsum(sizes[by_character]) - sizes[by_character]
        mapped[by_character] = placed
        # Texts' first bytes were counted as 0s, of which there are as many as texts: the places fit.
        self.mapped = mapped
        # Samples: where a run of suffixes with equal first bytes ends, the smallest document in it.
        whole = left[order] >= LENGTH
        one = at_28[order]
        two = at_28[np.minimum(order + LENGTH - 28, n - 1)]
        start = np.ones(n, dtype=bool)
        start[1:] = ~(whole[1:] & whole[:-1] & (one[1:] == one[:-1]) & (two[1:] == two[:-1]))
        starts = np.flatnonzero(start)
        self.alike = Marks(starts, n)
        self.least = np.minimum.reduceat(docs[text_of[order]], starts)

    @staticmethod
    def _ranks(symbols: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of all suffixes up to the end of their text, equal ones by place, and dense ranks of their first 28 symbols."""
        n = len(symbols)
        key = np.zeros(n, dtype=np.uint64)
        for k in range(7):  # seven symbols of nine bits
            own = symbols[k:] << np.uint64(9 * (6 - k))
            key[: n - k] |= np.where(left[: n - k] > k, own, 0) if k else own
        depth, at_28 = 7, None
        while True:
            ordered, order = _sorted(key, 63 if depth == 7 else (n * (n + 1) + n).bit_length())
            if depth > 2 * LENGTH:
                return order, at_28
            steps = np.zeros(n, dtype=np.int64)
            steps[1:] = np.cumsum(ordered[1:] != ordered[:-1])
            rank = np.empty(n, dtype=np.int64)
            rank[order] = steps
            if depth == 28:
                at_28 = rank
            rest = np.zeros(n, dtype=np.int64)
            rest[: n - depth] = np.where(left[: n - depth] >= depth, rank[depth:] + 1, 0) if n > depth else 0
            key = rank.astype(np.uint64) * np.uint64(n + 1) + rest.astype(np.uint64)
            depth *= 2

    def smallest(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(texts, position in each, smallest document) for one position of all texts at a time, from their ends."""
        at = np.arange(len(self.length))  # the rank of a text's end is its number
        texts = np.arange(len(self.length))
        for step in range(1, int(self.length.max(initial=0)) + 1):
            going = self.length[texts] >= step
            texts, at = texts[going], at[going]
            run = self.run.upto(at) - 1
            at = self.mapped[run] + at - self.heads[run]
            if step >= LENGTH:
                yield texts, self.length[texts] - step, self.least[self.alike.upto(at) - 1]


def covered(length: np.ndarray, key: np.ndarray, body: np.ndarray, first_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct pieces, the first and last window that a smaller document than their first one has; or (0, -1).

    Windows of a piece overlap, so what is covered is one range.
    """
    low, high = np.full(len(length), 1 << 30), np.full(len(length), -1)
    order = np.argsort(key, kind="stable")
    groups = np.flatnonzero(np.diff(key[order], prepend=key[order][:1] + np.uint64(1)))
    sizes = np.diff(np.append(groups, len(order)))
    offsets = np.cumsum(length) - length
    several = sizes > 1  # a piece that is alone with its anchor has no other to match
    groups, sizes = groups[several], sizes[several]
    symbols = np.add.reduceat(length[order] + 1, groups) if len(groups) else groups
    at = 0
    while at < len(groups):
        end, total = at + 1, symbols[at] if at < len(groups) else 0
        # Groups that are too large for one index are indexed alone.
        while end < len(groups) and total + 2 * sizes[at:end].sum() < INDEX_SYMBOLS and total < INDEX_SYMBOLS:
            total += length[order[groups[end] : groups[end] + sizes[end]]].sum()
            end += 1
        own = np.concatenate([order[g : g + s] for g, s in zip(groups[at:end], sizes[at:end])])
        index = RunIndex(body[_ranges(offsets[own], length[own])], length[own], first_doc[own])
        for texts, position, least in index.smallest():
            hit = least < first_doc[own[texts]]
            found = own[texts[hit]]
            low[found] = np.minimum(low[found], position[hit])
            high[found] = np.maximum(high[found], position[hit])
        at = end
    return np.where(high < 0, 0, low), high


def _match(group: pa.Table, blocks: int) -> pa.Table:
    """Covered ranges of one bucket, packed by block of documents."""
    kinds = np.uint8, np.uint64, np.uint32, np.int32, np.int64, np.int64, np.uint8
    found = [_unpack(p, *kinds) for p in group.column("payload").to_pylist()]
    for columns in found:
        columns[1] = np.cumsum(columns[1], dtype=np.uint64)
    length, key, same, copies, ids, place, body = (np.concatenate(x) for x in zip(*found))
    del found
    length = length.astype(np.int64)
    # Pieces whose anchor one document only has cannot match.
    piece = np.repeat(np.arange(len(length)), copies)
    least, most = np.full(len(length), _NO_ID), np.full(len(length), np.iinfo(np.int64).min)
    np.minimum.at(least, piece, ids)
    np.maximum.at(most, piece, ids)
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.diff(key[order], prepend=key[order][:1] + np.uint64(1)))
    group_least, group_most = np.minimum.reduceat(least[order], heads), np.maximum.reduceat(most[order], heads)
    shared = np.zeros(len(length), dtype=bool)
    shared[order] = np.repeat(group_least != group_most, np.diff(np.append(heads, len(order))))
    # Equal pieces that came from several blocks become one.
    own = np.flatnonzero(shared)
    own = own[np.lexsort((length[own], same[own], key[own]))]
    if not len(own):
        return _rows("block", [], [])
    new = np.ones(len(own), dtype=bool)
    new[1:] = (key[own][1:] != key[own][:-1]) | (same[own][1:] != same[own][:-1]) | (length[own][1:] != length[own][:-1])
    # A hash only suggests that pieces are equal; equal ones that others with the same hash part meet in the index.
    offsets = np.cumsum(length) - length
    alike = np.flatnonzero(~new)
    new[alike] = _unequal(body, offsets[own[alike - 1]], offsets[own[alike]], length[own[alike]])
    heads = np.flatnonzero(new)
    first_doc = np.minimum.reduceat(least[own], heads)
    number = np.full(len(length), -1)
    number[own] = np.cumsum(new) - 1
    picked = own[heads]
    low, high = covered(length[picked], key[picked], body[_ranges(offsets[picked], length[picked])], first_doc)
    # Copies in later documents are covered whole, those in the first one by what the index found.
    distinct = number[piece]
    held = distinct >= 0
    distinct, ids, place = distinct[held], ids[held], place[held]
    later = ids > first_doc[distinct]
    low, high = np.where(later, 0, low[distinct]), np.where(later, length[picked][distinct] - LENGTH, high[distinct])
    hit = high >= 0
    ids, place, low, high = ids[hit], place[hit], low[hit], high[hit]
    start = place + (low << 24)
    block = _block(ids, blocks)
    order = np.lexsort((start, ids, block))
    block, ids, start, size = block[order], ids[order], start[order], (high - low + LENGTH)[order].astype(np.uint8)
    cuts = _cuts(block, blocks)
    return _rows("block", [block[a] for a, _ in cuts], [_pack(ids[a:b], start[a:b], size[a:b]) for a, b in cuts])


def _block(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(blocks)).astype(np.int32)


def common_anchors(docs: DataFrame) -> np.ndarray:
    """Hashes of anchors so frequent that their pieces alone would fill a quarter of a bucket, from every 16th document's pieces.

    They only decide where windows are compared, never whether; so a sample does.
    """
    least = max(64, BUCKET_BYTES // 4 // 64 // 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for text, starts, *_ in _chunks(batch):
                _, _, key, _ = _pieces(text, starts, none)
                keys, counts = np.unique(key, return_counts=True)
                keys, counts = keys[counts > 1], counts[counts > 1]  # a common one occurs again in most chunks
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)], names=["key", "n"])

    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(16)) == 0).select(F.col("doc_id").cast("long"), "text")
    counts = some.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # At most four anchors for each bucket's worth of text can be that frequent; the sixteenth bounds the list again.
    keys = [r["key"] for r in counts.where(F.col("n") >= least).select("key").collect()]
    return np.sort((np.array(keys, dtype=np.uint64) << np.uint64(24) >> np.uint64(1)) & ~_POSITION)


def cut(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_kept`` (the remaining bytes), ``_n_bytes``, ``_n_removed`` and ``_n_spans``; all other columns as they are.

    A null text counts as empty and has ``_kept`` empty. A null id is larger than all others. Rows that repeat an id
    are no smaller than each other, so neither loses anything to the other. No rows give no rows.
    """
    names, docs = docs.columns, numbered(docs, "doc_id", "text")
    total = text_bytes(docs)
    n_blocks, buckets = parts_for(total, BLOCK_BUCKETS * BUCKET_BYTES), parts_for(total, BUCKET_BYTES)
    common = docs.sparkSession.sparkContext.broadcast(common_anchors(docs))
    columns = docs.columns
    text_at, id_at = columns.index("text"), columns.index("doc_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.num_columns - 1).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            rows = batch.select(list(range(batch.num_columns - 1)))
            block = _block(ids, n_blocks)
            order = np.argsort(block, kind="stable")
            names, payloads = [], []
            for a, b in _cuts(block[order], n_blocks):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema) as writer:
                    writer.write_batch(rows.take(pa.array(order[a:b])))
                names.append(block[order[a]])
                payloads.append(zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes()))
            yield from _rows("block", names, payloads).to_batches()

    def opened(group: pa.Table) -> pa.Table:
        unpacker = zstandard.ZstdDecompressor()
        return pa.concat_tables([pa.ipc.open_stream(unpacker.decompress(p)).read_all() for p in group.column("payload").to_pylist()])

    def texts_of(group: pa.Table) -> pa.Table:
        rows = opened(group)
        ids = rows.column(id_at).cast(pa.int64())
        return pa.table({"doc_id": ids, "text": rows.column(text_at)}).combine_chunks()

    placed = [F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]
    texts = docs.select(*placed, F.col("doc_id").cast("long").alias("_id")).mapInArrow(pack, PACKED.format("block"))
    asked = texts.groupBy("block").applyInArrow(
        lambda key, group: _ask(texts_of(group), key[0].as_py(), buckets, common.value), "bucket int, block int, payload binary"
    )
    answers = asked.groupBy("bucket").applyInArrow(_answer, "block int, bucket int, payload binary")
    sent = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda left, right: _send(texts_of(left), right, buckets, common.value) if right.num_rows else _rows("bucket", [], []),
        PACKED.format("bucket"),
    )
    spans = sent.groupBy("bucket").applyInArrow(lambda group: _match(group, n_blocks), PACKED.format("block"))
    own = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    out = texts.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(
        lambda left, right: _cut_block(opened(left), right, text_at, id_at),
        f"{own}, _kept binary, _n_bytes long, _n_removed long, _n_spans long",
    )
    return out.toDF(*names, "_kept", "_n_bytes", "_n_removed", "_n_spans")


def _cut_block(rows: pa.Table, spans: pa.Table, text_at: int, id_at: int) -> pa.Table:
    found = [_unpack(p, np.int64, np.int64, np.uint8) for p in spans.column("payload").to_pylist()]
    ids, starts, sizes = (np.concatenate([np.zeros(0, dtype=np.int64), *x]).astype(np.int64) for x in (zip(*found) if found else [[]] * 3))
    order = np.argsort(ids, kind="stable")
    ids, starts, sizes = ids[order], starts[order], sizes[order]
    kept, n_bytes, removed, spans = [], [], [], []
    for doc, text in zip(rows.column(id_at).to_pylist(), rows.column(text_at)):
        raw = text.as_buffer().to_pybytes() if text.is_valid else b""
        doc = _NO_ID if doc is None else int(doc)
        a, b = np.searchsorted(ids, doc), np.searchsorted(ids, doc, side="right")
        own = slice(a, b)
        mine = (starts[own] & int(_POSITION)) == _tag(raw) if b > a else np.zeros(0, dtype=bool)
        if not mine.any():
            kept.append(raw)
            n_bytes.append(len(raw))
            removed.append(0)
            spans.append(0)
            continue
        begin, size = starts[own][mine] >> 24, sizes[own][mine]
        turns = np.zeros(len(raw) + 1, dtype=np.int32)
        np.add.at(turns, begin, 1)
        np.subtract.at(turns, begin + size, 1)
        gone = np.cumsum(turns[:-1]) > 0
        kept.append(np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes())
        n_bytes.append(len(raw))
        removed.append(int(gone.sum()))
        spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
    for name, values, kind in (
        ("_kept", kept, pa.binary()),
        ("_n_bytes", n_bytes, pa.int64()),
        ("_n_removed", removed, pa.int64()),
        ("_n_spans", spans, pa.int64()),
    ):
        rows = rows.append_column(name, pa.array(values, kind))
    return rows


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated bytes cut out of ``text`` and ``n_chars`` (if there) set to what is left.

    Documents of which nothing but white space is left go; those that had no more before stay. A character that loses
    a part of its bytes loses all.
    """

    @F.pandas_udf("string")
    def decoded(kept):
        return kept.map(lambda x: bytes(x).decode("utf-8", "ignore"), na_action="ignore")

    names, docs = docs.columns, numbered(docs, "doc_id", "text", *(["n_chars"] if "n_chars" in docs.columns else []))
    found = cut(docs)
    text = F.when(F.col("_n_removed") > 0, decoded("_kept")).otherwise(F.col("text"))
    out = found.withColumn("text", text).where("_n_removed = 0 OR text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("_n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns).toDF(*names)


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``."""
    found = cut(picked(docs, "doc_id", "text"))
    sha = F.sha2("_kept", 256).alias("kept_sha256")
    return found.select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), sha)
