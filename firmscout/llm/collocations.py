"""Phrase collocation mining with weighted acyclic automata.

Shards of text are turned into word numbers. Each shard builds count transducers from its sorted word sequences and cuts
them by prefix range; the owner of a range unites the transducers of all shards and adds their weights. As no phrase is
more frequent than its parts, this goes in rounds: first words, then pairs of frequent words, then runs of three and more
words whose neighbours are frequent pairs; owners tell every shard which of its words and pairs are frequent. So counts
are exact, over all texts, and nothing rare travels twice. The parts of every phrase are looked up by composing them with
the united transducer of their range.

A frequent first word has as many ranges as it has followers, by 4096; shards meet in an owner in groups first.

Null texts are empty, a null language is ``und``, rows count each (repeated ones too), and an empty table has no phrases.
Word numbers stay below 2**32, which only counts frequent words.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.llm.automata import Transducer, packed, prefixes, row_order, union, unpacked
from firmscout.llm.common import parts_for, picked, staged
from firmscout.llm.hashing import mix

LEAST, LONGEST, TOP, ABSORB = 100, 5, 2000, 100
# Words of a shard, words of the whole for each owner, and shards whose transducers meet at once.
SHARD_WORDS, OWNER_WORDS, MEET = 1_500_000, 2_000_000, 512
FOLLOWERS = 12
PIECE = 1 << 20
# A-Z lower-cased, tabs to spaces; what ends a piece becomes a byte that no text holds.
_CUT = 0xFF
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b == 9 else _CUT if b in b".,;:!?" or 10 <= b <= 13 else b for b in range(256)
)

SHARD = "shard long, lang string, words array<binary>, counts array<bigint>, ids binary, size long"
VOCABULARY = (
    "bucket int, salt int, shard long, lang string, words array<binary>, places array<bigint>, times array<bigint>"
)
AUTOMATON = "bucket int, salt int, shard long, automaton binary"
PART = "bucket int, phrase array<bigint>, a long, cut int, tail boolean, part array<bigint>"


def tokens(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text and its piece ends, in lists of bounded size."""
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and _BYTES[data[end]] not in (32, _CUT):
            end += 1
        yield data[at:end].translate(_BYTES).replace(b"\xff", b" \xff ").split()
        at = end


def _packed(ids: np.ndarray) -> bytes:
    """Word numbers byte by byte of their places, compressed: most are small, so most high bytes are alike."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(ids).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=4 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Shard:
    def __init__(self) -> None:
        self.numbers = _Numbers({b"\xff": 0})
        self.runs: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        self.runs.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.size += len(words)

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        ids = np.concatenate([*self.runs, np.zeros(1, np.uint32)])
        counts = np.bincount(ids, minlength=len(self.numbers))[1:]
        words = list(self.numbers)[1:]
        values = [[number], [lang], [words], [counts.tolist()], [_packed(ids)], [len(ids)]]
        kinds = [pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.int64()]
        names = ["shard", "lang", "words", "counts", "ids", "size"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, shards = TaskContext.get().partitionId() << 32, defaultdict(_Shard)
    size, end = 0, np.zeros(1, np.uint32)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard = shards[lang]
            for words in tokens(text.as_py() or b""):
                shard.add(words)
                size += len(words)
            shard.runs.append(end)
            if size >= SHARD_WORDS:
                largest = max(shards, key=lambda key: shards[key].size)
                size -= shards[largest].size
                yield shards.pop(largest).row(number, largest)
                number += 1
    for lang, shard in shards.items():
        yield shard.row(number, lang)
        number += 1


def shards(docs: DataFrame) -> DataFrame:
    """Texts as word numbers of their shard, 0 where a piece ends; staged."""
    rows = picked(docs, "lang", "text").select(F.coalesce("lang", F.lit("und")), F.col("text").cast("binary"))
    return staged(rows.mapInArrow(_shards, SHARD))


def _flat(rows: pa.Table) -> pa.Table:
    """Lists of words with their language, word by word."""
    sizes = rows.column("words").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    langs = rows.column("lang").take(pa.array(np.repeat(np.arange(rows.num_rows), sizes)))
    return pa.table([langs, *(rows.column(c).combine_chunks().flatten() for c in ("words", "times"))], ["lang", "word", "times"])


def _listed(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), values)


def _salt(shard: int, salts: int) -> int:
    return int(mix(np.array([shard], dtype=np.uint64))[0] % np.uint64(salts))


def _vocabularies(buckets: int, salts: int):
    """Every shard's words, in a row per owner."""

    def vocabularies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                words, times = (row.column(c).flatten() for c in ("words", "counts"))
                own = np.array([zlib.crc32(w) % buckets for w in words.to_pylist()], dtype=np.int32)
                order = np.argsort(own, kind="stable")
                present, sizes = np.unique(own, return_counts=True)
                shard, lang = row.column("shard")[0].as_py(), row.column("lang")[0].as_py()
                columns = {
                    "bucket": pa.array(present, pa.int32()),
                    "salt": pa.array([_salt(shard, salts)] * len(present), pa.int32()),
                    "shard": pa.array([shard] * len(present), pa.int64()),
                    "lang": pa.array([lang] * len(present), pa.string()),
                    "words": _listed(words.take(pa.array(order)), sizes),
                    "places": _listed(pa.array(order, pa.int64()), sizes),
                    "times": _listed(times.take(pa.array(order)), sizes),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return vocabularies


def _add_words(key: tuple, rows: pa.Table) -> pa.Table:
    """Counts of an owner's words over a group of shards, a row per language."""
    total = _flat(rows).group_by(["lang", "word"]).aggregate([("times", "sum")]).sort_by("lang")
    langs = total.column("lang").to_pylist()
    names, sizes = list(dict.fromkeys(langs)), np.array(list(Counter(langs).values()), dtype=np.int64)
    return pa.table(
        {
            "bucket": pa.array([key[0].as_py()] * len(names), pa.int32()),
            "lang": pa.array(names, pa.string()),
            "words": _listed(total.column("word").combine_chunks(), sizes),
            "times": _listed(total.column("times_sum").combine_chunks(), sizes),
        }
    )


def _frequent_words(least: int, buckets: int):
    """An owner's words that occur ``least`` times, with numbers no other owner gives, and without word what all words of
    a language count."""

    def frequent(key: tuple, rows: pa.Table) -> pa.Table:
        total = _flat(rows).group_by(["lang", "word"]).aggregate([("times", "sum")]).rename_columns(["lang", "word", "f"])
        sums = total.group_by("lang").aggregate([("f", "sum")])
        known = total.filter(pa.compute.greater_equal(total.column("f"), least))
        langs, words = known.column("lang").to_pylist(), known.column("word").to_pylist()
        counts = known.column("f").to_pylist() + sums.column("f_sum").to_pylist()
        ids = [i * buckets + key[0].as_py() + 1 for i in range(len(words))] + [None] * sums.num_rows
        langs += sums.column("lang").to_pylist()
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()] * len(langs), pa.int32()),
                "lang": pa.array(langs, pa.string()),
                "word": pa.array(words + [None] * sums.num_rows, pa.binary()),
                "f": pa.array(counts, pa.int64()),
                "id": pa.array(ids, pa.int64()),
            }
        )

    return frequent


def _number(key: tuple, asks: pa.Table, known: pa.Table) -> pa.Table:
    """To every shard that asks: the numbers of its frequent words. The first group of an owner also hands on its words."""
    ids: dict[str, dict[bytes, int]] = defaultdict(dict)
    for lang, word, number in zip(*(known.column(c).to_pylist() for c in ("lang", "word", "id"))):
        if word is not None:
            ids[lang][word] = number
    out: list[tuple] = []
    for shard, lang, words, places in zip(*(asks.column(c).to_pylist() for c in ("shard", "lang", "words", "places"))):
        numbers = np.array([ids[lang].get(w, 0) for w in words], dtype=np.uint32)
        if numbers.any():
            out.append((shard, packed(np.array(places, dtype=np.int64)[numbers > 0]), _packed(numbers[numbers > 0]), *[None] * 4))
    if key[1].as_py() == 0:
        out += [(None, None, None, *row) for row in zip(*(known.column(c).to_pylist() for c in ("lang", "word", "f", "id")))]
    columns = list(zip(*out)) or [[]] * 7
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
    names = ["shard", "places", "numbers", "lang", "word", "f", "id"]
    return pa.table({name: pa.array(c, kind) for name, c, kind in zip(names, columns, kinds)})


def numbered_words(asks: DataFrame, least: int, buckets: int, salts: int) -> tuple[DataFrame, DataFrame]:
    """Per language the words that occur ``least`` times, and the numbers of each shard's.

    The first frame has ``id`` from 1, ``lang``, ``word``, ``f``, and ``n``, what all words of the language count; both
    come from one staged frame, for which the asking rows are shuffled once.
    """
    groups = asks.groupBy("bucket", "salt").applyInArrow(
        _add_words, "bucket int, lang string, words array<binary>, times array<bigint>"
    )
    counted = groups.groupBy("bucket").applyInArrow(
        _frequent_words(least, buckets), "bucket int, lang string, word binary, f long, id long"
    )
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    told = counted.select(F.col("bucket").alias("b"), every_salt.alias("s"), "lang", "word", "f", "id")
    both = asks.groupBy("bucket", "salt").cogroup(told.groupBy("b", "s"))
    both = staged(
        both.applyInArrow(_number, "shard long, places binary, numbers binary, lang string, word binary, f long, id long")
    )
    own = both.where(F.col("shard").isNull())
    sizes = own.where(F.col("word").isNull()).groupBy("lang").agg(F.sum("f").alias("n"))
    known = own.where(F.col("word").isNotNull()).select("id", "lang", "word", "f").join(sizes, "lang")
    return known, both.where(F.col("shard").isNotNull()).select("shard", "places", "numbers")


def _renumber(shard: pa.Table, known: pa.Table) -> pa.Table:
    """A shard's words by their numbers in the whole; rare ones end a piece, and so do runs of ends, once."""
    if not shard.num_rows:
        return pa.table({"shard": pa.array([], pa.int64()), "ids": pa.array([], pa.binary())})
    ids = _unpacked(shard.column("ids")[0].as_py())
    number = np.zeros(int(ids.max(initial=0)) + 1, dtype=np.uint32)
    for places, numbers in zip(known.column("places").to_pylist(), known.column("numbers").to_pylist()):
        number[unpacked(places) + 1] = _unpacked(numbers)
    ids = number[ids]
    ids = ids[(ids > 0) | np.r_[True, ids[:-1] > 0]]
    return pa.table({"shard": shard.column("shard"), "ids": pa.array([_packed(ids)], pa.binary())})


def _bucket(rows: np.ndarray, buckets: int) -> np.ndarray:
    """The owner of a sequence's prefix range: its first word, and a run of words that may follow it."""
    first, second = rows[:, 0].astype(np.uint64), rows[:, 1].astype(np.uint64) >> np.uint64(FOLLOWERS)
    return (mix(first * np.uint64(0x9E3779B97F4A7C15) + second) % np.uint64(buckets)).astype(np.int32)


def _cut(rows: np.ndarray, counts: np.ndarray, shard: int, buckets: int, salts: int) -> pa.RecordBatch:
    """A shard's transducers, one per prefix range it has sequences in."""
    own = _bucket(rows, buckets)
    order = np.argsort(own, kind="stable")
    edges = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1], True]) if len(own) else np.zeros(1, int)
    out = []
    for start, end in zip(edges[:-1], edges[1:]):
        at = order[start:end]  # still sorted
        out.append((int(own[at[0]]), Transducer.build(rows[at], counts[at]).dump()))
    columns = [[b for b, _ in out], [_salt(shard, salts)] * len(out), [shard] * len(out), [a for _, a in out]]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "salt", "shard", "automaton"]
    )


def _counted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = row_order(rows)
    rows = rows[order]
    new = np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)] if len(rows) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    return rows[starts], np.diff(np.r_[starts, len(rows)])


def _pairs(buckets: int, salts: int):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, packed in zip(batch.column("shard").to_pylist(), batch.column("ids")):
                ids = _unpacked(packed.as_py()).astype(np.int64)
                keys = (ids[:-1] << 32) | ids[1:]
                keys, counts = np.unique(keys[(ids[:-1] > 0) & (ids[1:] > 0)], return_counts=True)
                yield _cut(np.column_stack([keys >> 32, keys & 0xFFFFFFFF]), counts, shard, buckets, salts)

    return pairs


def _runs(buckets: int, salts: int, longest: int):
    """Three and more words whose neighbours are frequent pairs, each run as long as it may be."""

    def runs(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([_cut(np.zeros((0, 2), np.int64), np.zeros(0, np.int64), 0, 1, 1)])
        ids = _unpacked(left.column("ids")[0].as_py()).astype(np.int64)
        known = np.sort(np.concatenate([unpacked(k) for k in right.column("keys").to_pylist()]))
        keys = (ids[:-1] << 32) | ids[1:]
        linked = np.zeros(len(ids) + longest, dtype=bool)
        linked[: len(keys)] = known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys
        at = np.flatnonzero(linked[:-1] & linked[1:])
        on = np.ones(len(at), dtype=bool)
        rows = np.zeros((len(at), longest), dtype=np.int64)
        for j in range(longest):
            rows[on, j] = ids[at[on] + j]
            on &= linked[at + j]
        shard = left.column("shard")[0].as_py()
        return pa.Table.from_batches([_cut(*_counted(rows), shard, buckets, salts)])

    return runs


def _unite(key: tuple, parts: pa.Table) -> pa.Table:
    rows, counts = union(parts.column("automaton").to_pylist())
    return pa.table(
        {
            "bucket": pa.array([key[0].as_py()], pa.int32()),
            "automaton": pa.array([Transducer.build(rows, counts).dump()], pa.binary()),
        }
    )


def _frequent(least: int, shortest: int):
    """The united transducer of a range, cut back to sequences that occur ``least`` times."""

    def frequent(key: tuple, parts: pa.Table) -> pa.Table:
        found = []
        for paths, weights, _ in prefixes(*union(parts.column("automaton").to_pylist())):
            if paths.shape[1] >= shortest and (weights >= least).any():
                found.append((paths[weights >= least], weights[weights >= least]))
        if not found:
            return pa.table({"bucket": pa.array([], pa.int32()), "automaton": pa.array([], pa.binary())})
        return pa.table(
            {"bucket": pa.array([key[0].as_py()], pa.int32()), "automaton": pa.array([_of_prefixes(found).dump()], pa.binary())}
        )

    return frequent


def _of_prefixes(found: list[tuple[np.ndarray, np.ndarray]]) -> Transducer:
    """The transducer in which every given sequence has its given count; longer ones are taken off their beginnings."""
    width = found[-1][0].shape[1]
    rows = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p, _ in found])
    counts = np.concatenate([w for _, w in found])
    order = row_order(rows)
    rows, counts = rows[order], counts[order]
    own = counts.copy()
    sizes = (rows > 0).sum(axis=1)
    for d in range(int(sizes.min()), int(sizes.max())):
        # Rows of d + 1 words follow their beginning of d words, which is the last row of that size before them.
        longer = np.flatnonzero(sizes == d + 1)
        shorter = np.flatnonzero(sizes == d)
        np.subtract.at(own, shorter[np.searchsorted(shorter, longer) - 1], counts[longer])
    return Transducer.build(rows, own)


def _united(cut: DataFrame, salts: int, least: int, shortest: int) -> DataFrame:
    """Frequent sequences per prefix range: ``bucket``, ``automaton``; shards are united in groups first."""
    groups = cut.groupBy("bucket", "salt").applyInArrow(_unite, "bucket int, automaton binary")
    return groups.groupBy("bucket").applyInArrow(_frequent(least, shortest), "bucket int, automaton binary")


def _reply(key: tuple, asks: pa.Table, united: pa.Table) -> pa.Table:
    """To every shard that asks: which of its pairs are frequent. The first group of an owner also hands on its transducer."""
    out: list[tuple] = []
    if united.num_rows:
        rows, _ = union(united.column("automaton").to_pylist())
        known = (rows[:, 0] << 32) | rows[:, 1]
        for shard, automaton in zip(asks.column("shard").to_pylist(), asks.column("automaton").to_pylist()):
            rows, _ = Transducer.load(automaton).rows()
            asked = (rows[:, 0] << 32) | rows[:, 1]
            asked = asked[known[np.minimum(np.searchsorted(known, asked), len(known) - 1)] == asked]
            if len(asked):
                out.append((shard, packed(asked), None, None))
        if key[1].as_py() == 0:
            out += [(None, None, key[0].as_py(), automaton) for automaton in united.column("automaton").to_pylist()]
    columns = list(zip(*out)) or [[]] * 4
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    return pa.table({name: pa.array(c, kind) for name, c, kind in zip(("shard", "keys", "bucket", "automaton"), columns, kinds)})


def _lists(rows: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    flat = rows[np.arange(rows.shape[1]) < sizes[:, None]]
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(flat, pa.int64()))


def _parts(buckets: int, shortest: int):
    """All phrases of a range's transducer with the parts of two and more words that each can be cut into."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("automaton"):
                rows, counts = Transducer.load(packed.as_py()).all_rows()
                sizes = (rows > 0).sum(axis=1)
                rows, counts, sizes = rows[sizes >= shortest], counts[sizes >= shortest], sizes[sizes >= shortest]
                yield _ask(rows, counts, sizes, np.zeros_like(sizes), False, rows[:, :2], np.zeros_like(sizes), buckets)
                for cut in range(1, rows.shape[1]):
                    for tail in (False, True):
                        own = sizes - cut if tail else np.full_like(sizes, cut)
                        fits = (sizes > cut) & (own >= 2)
                        if fits.any():
                            part = rows[fits][:, cut:] if tail else rows[fits][:, :cut]
                            at = sizes[fits]
                            yield _ask(rows[fits], counts[fits], at, np.full_like(at, cut), tail, part, own[fits], buckets)

    return parts


def _ask(rows, counts, sizes, cut, tail, part, part_sizes, buckets) -> pa.RecordBatch:
    """Rows of ``PART``; those with cut 0 stand for the phrase itself and ask for nothing."""
    columns = [
        pa.array(_bucket(part, buckets), pa.int32()),
        _lists(rows, sizes),
        pa.array(counts, pa.int64()),
        pa.array(cut, pa.int32()),
        pa.array(np.full(len(cut), tail), pa.bool_()),
        _lists(part, part_sizes),
    ]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "phrase", "a", "cut", "tail", "part"])


def _compose(asks: pa.Table, united: pa.Table) -> pa.Table:
    """The counts of the parts, each from the transducer of its length's round."""
    weights = np.zeros(asks.num_rows, dtype=np.int64)
    if asks.num_rows:
        parts = asks.column("part").to_pylist()
        sizes = np.array([len(p) for p in parts])
        rows = np.zeros((len(parts), int(sizes.max())), dtype=np.int64)
        rows[np.arange(rows.shape[1]) < sizes[:, None]] = [w for p in parts for w in p]
        for shortest, packed in zip(united.column("shortest").to_pylist(), united.column("automaton").to_pylist()):
            own = (sizes == 2) == (shortest == 2)
            weights[own] = np.maximum(weights[own], Transducer.load(packed).weigh(rows[own], sizes[own]))
    kept = asks.select(["phrase", "a", "cut", "tail", "part"])
    lists = {"phrase": pa.list_(pa.int64()), "part": pa.list_(pa.int64())}
    columns = {c: kept.column(c).cast(lists[c]) if c in lists else kept.column(c) for c in kept.column_names}
    return pa.table(columns | {"f": pa.array(weights, pa.int64())})


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cut of lowest score, in whole numbers of any size."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            words, found = row["words"], {(p["cut"], p["tail"]): p["f"] for p in row["parts"]}
            m, best = len(words), None
            for cut in range(1, m):
                left = found.get((cut, False)) if cut > 1 else words[0]["f"]
                right = found.get((cut, True)) if m - cut > 1 else words[-1]["f"]
                score = 1000 * row["a"] * row["n"] // (left * right)
                if best is None or score < best[0]:
                    best = score, left, right
            phrase = b" ".join(w["word"] for w in words).decode()
            out.append((row["lang"], phrase, row["a"], best[1], best[2], row["n"], best[0]))
        columns = list(zip(*out)) or [[]] * 7
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "phrase", "a", "l", "r", "n", "score"]
        )


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, absorb: int = ABSORB) -> DataFrame:
    """All candidates that no longer one absorbs: ``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Phrases have 2 to ``longest`` words and occur ``least`` times. A longer one absorbs those it holds if it is ``absorb``
    percent as frequent; as every phrase between the two is as frequent then, one word more is all that has to be seen.
    """
    cut = shards(docs)
    total, n_shards = cut.agg(F.sum("size"), F.count("*")).first()
    buckets, salts = parts_for(total or 0, OWNER_WORDS), parts_for(n_shards, MEET)
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))

    asks = cut.select("shard", "lang", "words", "counts").mapInArrow(_vocabularies(buckets, salts), VOCABULARY)
    known, numbers = numbered_words(asks, least, buckets, salts)
    numbered = cut.select("shard", "ids").groupBy("shard").cogroup(numbers.toDF("at", "places", "numbers").groupBy("at"))
    numbered = staged(numbered.applyInArrow(_renumber, "shard long, ids binary"))

    asks = numbered.mapInArrow(_pairs(buckets, salts), AUTOMATON)
    every = _united(asks, salts, least, 2).select(F.col("bucket").alias("b"), every_salt.alias("s"), "automaton")
    both = asks.groupBy("bucket", "salt").cogroup(every.groupBy("b", "s"))
    both = staged(both.applyInArrow(_reply, "shard long, keys binary, bucket int, automaton binary"))
    pairs = both.where(F.col("shard").isNull()).select("bucket", "automaton")
    replies = both.where(F.col("shard").isNotNull()).select(F.col("shard").alias("at"), "keys")
    met = numbered.groupBy("shard").cogroup(replies.groupBy("at"))
    if longest > 2:
        longer = staged(_united(met.applyInArrow(_runs(buckets, salts, longest), AUTOMATON), salts, least, 3))
        united = pairs.withColumn("shortest", F.lit(2)).unionByName(longer.withColumn("shortest", F.lit(3)))
    else:
        longer, united = pairs.where("false"), pairs.withColumn("shortest", F.lit(2))

    asked = pairs.mapInArrow(_parts(buckets, 2), PART).unionByName(longer.mapInArrow(_parts(buckets, 3), PART))
    asked = staged(asked)
    answers = asked.where("cut > 0").groupBy("bucket").cogroup(united.toDF("b", "automaton", "shortest").groupBy("b"))
    answers = staged(
        answers.applyInArrow(_compose, "phrase array<bigint>, a long, cut int, tail boolean, part array<bigint>, f long")
    )
    absorbed = answers.where(F.col("a") * 100 >= F.col("f") * absorb).select(F.col("part").alias("gone")).distinct()
    found = asked.where("cut = 0").select("phrase", "a").join(absorbed, F.col("phrase") == F.col("gone"), "left_anti")

    spelled = found.select("phrase", "a", F.posexplode("phrase").alias("place", "id"))
    spelled = spelled.join(known.select("id", "lang", "word", "f", "n"), "id")
    spelled = spelled.groupBy("phrase").agg(
        F.any_value("a").alias("a"),
        F.any_value("lang").alias("lang"),
        F.any_value("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("place", "word", "f"))).alias("words"),
    )
    parts = answers.groupBy(F.col("phrase").alias("of")).agg(F.collect_list(F.struct("cut", "tail", "f")).alias("parts"))
    whole = spelled.join(parts, F.col("phrase") == F.col("of"), "left")
    whole = whole.select("lang", "a", "n", "words", F.coalesce("parts", F.array().cast(parts.schema["parts"].dataType)).alias("parts"))
    return whole.mapInArrow(_scores, "lang string, phrase string, a long, l long, r long, n long, score long")


def collocations(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """Each language's first ``top`` phrases by score, count and spelling, with their ``rank``."""
    place = "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)"
    ranked_rows = phrases(docs, **options).withColumn("rank", F.expr(place).cast("long")).where(F.col("rank") <= top)
    return ranked_rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
