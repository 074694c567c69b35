"""Benchmark decontamination by template canonicalisation.

Words lose case and punctuation; numbers, names (capitalised words within a sentence) and units become typed placeholders. What is left of five words in a
row is a template window. Documents and benchmark items meet on equal windows by a hash join, also where an item was
asked again with other numbers and names. A document's windows count for an item if they lie within one stretch of
text and what stands in the slots is consistent there: one value of the item always stands for one value of the
document, and the other way round. A document is contaminated if at least ``PERCENT`` of an item's windows count.

Beside the templates, plain windows of the same five words are joined, whatever the words are: so copies are found that
differ in case and punctuation only, also where names cannot be told by their capitals, and items of numbers and names
alone. They have no slots. An item counts by either kind, never by windows of both together. Items of fewer than
``WINDOW`` words are one shorter window, which only texts as short have.

Before the join, tasks drop windows that no item has, by a bit table of bounded size, and documents that have fewer
such windows than ``PERCENT`` of the smallest item's; neither can lose a match.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import numbered, picked, staged
from firmscout.llm.hashing import BASE, CHUNK, mix, powers

WINDOW = 5
PERCENT = 80
#: Literal words a window needs; with fewer it would match nearly anything.
LEAST_LITERAL = 3
#: Bits of the table for each window of the benchmark, and the most it may have in all.
BITS_PER_WINDOW, MOST_BITS = 64, 1 << 27
# What may follow a number as its unit.
UNITS = (
    "mm cm m km in ft yd mi mile miles g kg mg lb lbs oz t ml l litre litres liter liters s sec second seconds min "
    "minute minutes h hr hour hours day days week weeks month months year years ms w kw v a j kj cal kcal hz khz mhz "
    "ghz pa kpa k c f percent dollar dollars euro euros pound pounds cent cents usd eur gbp mph kmh"
)
NUMBER, NAME, UNIT = (np.uint64(x) for x in (1, 2, 3))
#: The kind of a window, the lowest bit of its hash.
TEMPLATE, PLAIN = np.uint64(0), np.uint64(1)

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:"]] = True


def _words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    edge = np.ones(len(b) + 2, dtype=bool)
    edge[1:-1] = _SPACE[b]
    edges = np.flatnonzero(edge[1:] != edge[:-1])
    return edges[::2], edges[1::2]


def _names(b: np.ndarray) -> np.ndarray:
    """Which words begin with a capital, go on in small letters and do not begin a sentence."""
    starts, ends = _words(b)
    if not len(starts):
        return np.zeros(0, dtype=bool)
    # Capitals and small letters of ASCII, and of Latin letters with accents, which are two bytes.
    second = np.zeros(len(b), dtype=bool)
    second[1:] = b[:-1] == 0xC3
    small = (b >= 97) & (b < 123) | second & (b >= 0xA0)
    large = (b >= 65) & (b < 91) | second & (b < 0xA0)
    lead = np.flatnonzero(_ALNUM[b] & ~second)
    count = np.zeros(len(b) + 1, dtype=np.int64)
    np.cumsum(_ALNUM[b] & ~second, out=count[1:])
    first = lead[np.minimum(count[starts], len(lead) - 1)] if len(lead) else starts
    capital = large[first] | large[np.minimum(first + 1, len(b) - 1)] & (b[first] == 0xC3)
    np.cumsum(small, out=count[1:])
    after_stop = np.concatenate([[True], _STOP[b[ends - 1]][:-1]])
    return capital & (count[ends] > count[starts]) & ~after_stop


def tokens(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Template tokens of a text and what stands in their slots (0 for literal words)."""
    parts, at = [], 0
    while at < len(data):  # long texts in pieces that end between words
        end = min(len(data), at + CHUNK)
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        parts.append(_tokens(data[at:end]))
        at = end
    none = np.zeros(0, dtype=np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (none, none)


def _tokens(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    none = np.zeros(0, dtype=np.uint64)
    b = np.frombuffer(data.decode("utf-8", "replace").casefold().encode(), dtype=np.uint8)
    starts, ends = _words(b)
    if not len(starts):
        return none, none
    name = _names(np.frombuffer(data, dtype=np.uint8))
    if len(name) != len(starts):
        name = np.zeros(len(starts), dtype=bool)
    # Words are hashed over their letters and digits alone.
    solid = _ALNUM[b]
    count = np.zeros(len(b) + 1, dtype=np.int64)
    np.cumsum(solid, out=count[1:])
    real = count[ends] > count[starts]
    if not real.any():
        return none, none
    low, high, name = count[starts[real]], count[ends[real]], name[real]
    letters = b[solid]
    up, down = powers(len(b))
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * up[: len(letters)], out=sums[1:])
    words = mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64))
    digits = np.zeros(len(letters) + 1, dtype=np.int64)
    np.cumsum((letters >= 48) & (letters < 58), out=digits[1:])
    number = digits[high] > digits[low]
    unit = np.zeros(len(words), dtype=bool)
    after = np.flatnonzero(number[:-1]) + 1
    if len(after):
        unit[after] = np.isin(words[after], _unit_hashes()) & ~number[after]
    name &= ~number & ~unit
    out = words.copy()
    out[number], out[name], out[unit] = NUMBER, NAME, UNIT
    return out, np.where(number | name | unit, words, np.uint64(0))


@cache
def _unit_hashes() -> np.ndarray:
    return np.sort(tokens(UNITS.encode())[0])  # no number stands before any of them, so all are literal here


def windows(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash, slots) of all template windows with enough literal words, then of all plain windows.

    Slots are ``WINDOW`` values each, all 0 for plain windows.
    """
    found, values = tokens(data)
    words = np.where(values != 0, values, found)
    size = min(WINDOW, len(found))
    n = len(found) - size + 1 if size else 0
    hashed, plain = np.full(n, size, dtype=np.uint64), np.full(n, size, dtype=np.uint64)
    slots = np.zeros((n, WINDOW), dtype=np.uint64)
    for k in range(size):
        hashed = hashed * BASE + found[k : k + n]
        plain = plain * BASE + words[k : k + n]
        slots[:, k] = values[k : k + n]
    literal = size - (slots != 0).sum(axis=1)
    at = np.flatnonzero(literal >= min(LEAST_LITERAL, size))
    kinds = [mix(hashed[at]) & ~PLAIN | TEMPLATE, mix(plain) | PLAIN]
    return np.concatenate([at, np.arange(n)]), np.concatenate(kinds), np.concatenate([slots[at], np.zeros_like(slots)])


SCHEMA = "{0}, at array<int>, hash array<long>, slots array<long>"


def _listed(rows: DataFrame, bits: np.ndarray | None, least: int) -> DataFrame:
    """Windows of every row (an id, then a text), in one list a row.

    With ``bits``, only windows whose bit is set, and only rows that have ``least`` different ones.
    """
    name, kind = rows.columns[0], rows.schema.fields[0].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(bits) if bits is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value if shared else None
        shift = np.uint64(64 - int(math.log2(len(table) * 8))) if shared else None
        for batch in batches:
            kept, out = [], ([], [], [])
            for i, text in enumerate(batch.column(1)):
                at, hashed, slots = windows(text.as_buffer().to_pybytes() if text.is_valid else b"")
                if table is not None:
                    place = hashed >> shift
                    hit = (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
                    at, hashed, slots = at[hit], hashed[hit], slots[hit]
                    if len(at) < least or len(np.unique(hashed)) < least:
                        continue
                kept.append(i)
                for column, values in zip(out, (at.astype(np.int32), hashed.view(np.int64), slots.ravel().view(np.int64))):
                    column.append(values)
            arrays = [batch.column(0).take(pa.array(kept, pa.int64()))]
            arrays += [pa.array(x, pa.list_(t)) for x, t in zip(out, (pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[name, "at", "hash", "slots"])

    return rows.mapInArrow(run, SCHEMA.format(f"`{name}` {kind}"))


def _long(listed: DataFrame, at: str, slots: str) -> DataFrame:
    """One row per window."""
    each = f"inline(transform(at, (x, i) -> struct(x AS {at}, hash[i] AS hash, slice(slots, i * {WINDOW} + 1, {WINDOW}) AS {slots})))"
    return listed.selectExpr(listed.columns[0], each)


def table_of(hashes: DataFrame, n: int) -> np.ndarray:
    """A bit table of the hashes, packed; its size follows ``n`` up to ``MOST_BITS``.

    A fuller table only lets more windows through to the join.
    """
    bits = min(MOST_BITS, 1 << max(16, math.ceil(math.log2(max(1, n) * BITS_PER_WINDOW))))
    place = f"shiftrightunsigned(hash, {64 - int(math.log2(bits))})"
    rows = hashes.selectExpr(f"shiftright({place}, 3) AS byte", f"shiftleft(1, cast({place} & 7 AS int)) AS bit")
    packed = rows.groupBy("byte").agg(F.bit_or("bit").alias("bit")).toPandas()  # an eighth of MOST_BITS rows at most
    out = np.zeros(bits // 8, dtype=np.uint8)
    out[packed["byte"].to_numpy(dtype=np.int64)] = packed["bit"].to_numpy(dtype=np.int64).astype(np.uint8)
    return out


def consistent(item_at: np.ndarray, doc_at: np.ndarray, item_slots: np.ndarray, doc_slots: np.ndarray, span: int) -> int:
    """Different windows of an item that one stretch of ``span`` tokens of a document has with consistent slots."""
    order = np.lexsort((item_at, doc_at))
    item_at, doc_at, item_slots, doc_slots = item_at[order], doc_at[order], item_slots[order], doc_slots[order]
    # The stretch that holds most different windows of the item.
    seen: Counter = Counter()
    best, best_n, low = (0, 0), 0, 0
    for high in range(len(doc_at)):
        seen[item_at[high]] += 1
        while doc_at[high] - doc_at[low] >= span:
            seen[item_at[low]] -= 1
            if not seen[item_at[low]]:
                del seen[item_at[low]]
            low += 1
        if len(seen) > best_n:
            best, best_n = (low, high + 1), len(seen)
    here = slice(*best)
    item_at, item_slots, doc_slots = item_at[here], item_slots[here], doc_slots[here]
    # The most frequent partner of each value, both ways.
    used = item_slots != 0
    pairs = Counter(zip(item_slots[used].tolist(), doc_slots[used].tolist()))
    there: dict[int, int] = {}
    back: dict[int, int] = {}
    for (mine, other), _ in sorted(pairs.items(), key=lambda x: (-x[1], x[0])):
        if mine not in there and other not in back:
            there[mine], back[other] = other, mine
    fine = [
        all(there.get(m) == o for m, o in zip(a, b) if m) for a, b in zip(item_slots.tolist(), doc_slots.tolist())
    ]
    return len(set(item_at[np.array(fine, dtype=bool)].tolist())) if len(fine) else 0


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``key, items``: the items found in each contaminated row of ``docs`` (``key, text``).

    ``benchmark`` has ``item_id`` and ``text``; items without a word are never found. Rows with one key need the
    same text.
    """
    items = picked(benchmark, "item_id", "text").where("text IS NOT NULL").groupBy("item_id", "text").agg(F.lit(1))
    # Items that share an id are told apart by their text until the end.
    items = items.select(F.struct("item_id", F.xxhash64("text").alias("tag")).alias("item"), "text")
    flat = items.select(F.to_json("item", {"ignoreNullFields": "false"}).alias("item"), "text")
    listed = staged(_listed(flat, None, 0).where("size(at) > 0"))
    own = staged(_long(listed, "item_at", "item_slots").withColumn("kind", F.col("hash").bitwiseAND(F.lit(1))))
    sizes = own.groupBy("item", "kind").agg(F.countDistinct("hash").alias("n"), (F.max("item_at") + WINDOW).alias("length"))
    n, least = sizes.agg(F.sum("n"), F.min("n")).first()
    if not n:
        return docs.select("key", F.lit(None).cast("array<bigint>").alias("items")).where("false")
    bits = table_of(own.select("hash").distinct(), n)
    met = _long(_listed(docs.select("key", "text"), bits, -(-PERCENT * least // 100)), "doc_at", "doc_slots")
    pairs = met.join(own, "hash")
    entry = F.struct("item_at", "doc_at", "item_slots", "doc_slots", "hash")
    together = pairs.groupBy("key", "item", "kind").agg(F.collect_list(entry).alias("found"), F.countDistinct("hash").alias("m"))
    together = together.join(sizes, ["item", "kind"]).where(100 * F.col("m") >= PERCENT * F.col("n"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names = [], []
            for row in batch.to_pylist():
                # Windows of an item that are equal count once: by the first place the item has them.
                first: dict[int, int] = {}
                for e in row["found"]:
                    first[e["hash"]] = min(first.get(e["hash"], e["item_at"]), e["item_at"])
                entries = row["found"]
                columns = [
                    np.array([first[e["hash"]] for e in entries]),
                    np.array([e["doc_at"] for e in entries]),
                    np.array([e["item_slots"] for e in entries], dtype=np.int64),
                    np.array([e["doc_slots"] for e in entries], dtype=np.int64),
                ]
                if 100 * consistent(*columns, span=2 * row["length"]) >= PERCENT * row["n"]:
                    keys.append(row["key"])
                    names.append(row["item"])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(names, pa.string())], names=["key", "item"])

    hits = together.select("key", "item", "found", "n", "length").mapInArrow(check, "key long, item string")
    ids = F.from_json("item", "item_id long")["item_id"]
    return hits.groupBy("key").agg(F.sort_array(F.collect_set(ids)).alias("items"))  # as many as items found in one text


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (columns but id and text by number) with ``_key``, equal for rows with equal id and text only."""
    return numbered(docs, "doc_id", "text").withColumn("_key", F.xxhash64("doc_id", "text"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, items`` for every row of ``docs``.

    Null and empty texts are clean; null ids pass; equal rows are judged alike; extra columns are ignored; an empty
    benchmark leaves every document clean; no rows give no rows.
    """
    keyed = _keyed(docs)
    hits = contaminated(keyed.select(F.col("_key").alias("key"), "text"), benchmark)
    out = keyed.select("doc_id", "_key").join(hits.withColumnRenamed("key", "_key"), "_key", "left")
    return out.select(
        F.col("doc_id"), F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast("array<bigint>")).alias("items")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, all columns as they are."""
    keyed = _keyed(docs)
    hits = contaminated(keyed.select(F.col("_key").alias("key"), "text"), benchmark).select(F.col("key").alias("_key"))
    return keyed.join(hits.dropDuplicates(["_key"]), "_key", "left_anti").drop("_key").toDF(*docs.columns)
