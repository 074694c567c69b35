"""Ranked lexical search by pipelined term partitioning.

The documents are indexed in blocks of rows; the postings of a block are split by term over a few owners, from the rarest
terms to the most frequent ones. A bundle holds all items of a group and their sparse accumulators over one block. It
visits the owners one after the other: each stage cogroups the bundles with the postings of its owner, adds the integer
contributions of its terms and sends the bundle on. The last stage picks the best documents of its block, and a ranked
window, which Spark limits before its shuffle, those of all blocks.

What is lost on the way cannot matter: an accumulator goes only if all terms still to come, each at its largest
contribution, cannot lift it to the score that the k-th best document of its block has already. This is exact, ties
included. A frequent term has one row of postings per block, so no owner holds it whole.

A document is a row: one without text or terms is in no count, repeated ids are documents of their own, documents
without an id come before all others of the same score. Rows with the same item id are one item with the terms of all;
an item without terms has no rows, nor has any item if no document has a term.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import picked, staged

K = 10
# Documents of a block, and items of a bundle: their product bounds the accumulators of a task.
BLOCK_DOCS, BUNDLE_ITEMS = 4096, 512
# Postings a block may gather before it is closed.
BLOCK_POSTINGS = 4_000_000
# The stages of the pipeline: an owner takes the terms that stand in less than this share of the documents.
OWNERS = (1 / 512, 1 / 64, 1 / 8, 2.0)
# No contribution exceeds a term's weight times this.
MOST = 1_000_000
# Bits of the filter that keeps terms of no item out of the index; its size does not depend on the items.
FILTER_BITS = 22
PIECE = 1 << 20
BLOCKS_A_SALT = 64

# Letters and digits of ASCII and all bytes above it are term bytes, A-Z lower-cased; the rest separates.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

INDEX = "block long, term binary, n_docs long, n_terms long, docs binary, ids array<bigint>"
BUNDLE = (
    "block long, grp int, n_all long, l_all long, n_items int, item_ids array<bigint>, lengths binary, "
    "ids array<bigint>, terms array<struct<term:binary,owner:int,weight:bigint,items:array<int>>>, "
    "items binary, docs binary, scores binary"
)

# The same columns as Arrow types; a column that comes without nulls is declared otherwise.
_LISTS = {
    "item_ids": pa.list_(pa.int64()),
    "ids": pa.list_(pa.int64()),
    "terms": pa.list_(
        pa.struct([("term", pa.binary()), ("owner", pa.int32()), ("weight", pa.int64()), ("items", pa.list_(pa.int32()))])
    ),
}


def terms_of(data: bytes) -> Counter:
    """How often each term stands in a text, taken in pieces that end between terms."""
    if len(data) <= PIECE:
        return Counter(data.translate(_TERM_BYTES).split())
    found: Counter = Counter()
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and _TERM_BYTES[data[end]] != 32:
            end += 1
        found.update(data[at:end].translate(_TERM_BYTES).split())
        at = end
    return found


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.columns
        found = [list(terms_of(t.as_py() or b"")) for t in texts]
        rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
        flat = pa.array([t for f in found for t in f], pa.binary())
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), flat], ["item_id", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """Every item's distinct terms: ``item_id``, ``term``."""
    rows = picked(items, "item_id", "text").select(F.col("item_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(_item_terms, "item_id long, term binary").distinct()


def _term_filter(terms: DataFrame) -> np.ndarray:
    """A bit for every term's hash: at most 2**22 of them reach the driver, packed in words, whatever the items are."""
    slot = F.crc32("term") % (1 << FILTER_BITS)
    word = terms.select(slot.alias("slot")).selectExpr("slot div 32 AS at", "shiftleft(1L, cast(slot % 32 AS int)) AS bit")
    bits = np.zeros(1 << (FILTER_BITS - 5), dtype="<u4")
    for at, value in word.groupBy("at").agg(F.bit_or("bit")).collect():
        bits[at] = value
    return np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)


class _Block:
    """The postings of a run of documents."""

    def __init__(self) -> None:
        self.ids: list = []
        self.lengths: list[int] = []
        self.postings: dict[bytes, tuple[list[int], list[int]]] = {}
        self.size = 0

    def add(self, doc_id, counts: Counter, wanted) -> None:
        here = len(self.ids)
        self.ids.append(doc_id)
        self.lengths.append(counts.total())
        for term, n in counts.items():
            if wanted(term):
                docs, times = self.postings.setdefault(term, ([], []))
                docs.append(here)
                times.append(n)
                self.size += 1

    def rows(self, block: int) -> pa.RecordBatch:
        packed = [np.array(p, dtype=np.int64).tobytes() for p in self.postings.values()]
        n = len(packed)
        own = [block] * (n + 1)
        counts = [*(len(d) for d, _ in self.postings.values()), sum(x > 0 for x in self.lengths)]
        lengths = np.array(self.lengths, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(own, pa.int64()),
                pa.array([*self.postings, None], pa.binary()),
                pa.array(counts, pa.int64()),
                pa.array([0] * n + [int(lengths.sum())], pa.int64()),
                pa.array([*packed, lengths.tobytes()], pa.binary()),
                pa.array([None] * n + [self.ids], pa.list_(pa.int64())),
            ],
            ["block", "term", "n_docs", "n_terms", "docs", "ids"],
        )


def index(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """Postings in blocks of documents, staged: a row per block and term, and one without term about the block itself.

    ``docs`` holds places in the block and occurrences, or all lengths of the block's documents. Terms whose bit is not
    set are left out, but counted in the lengths.
    """
    packed, mask = np.packbits(bits, bitorder="little").tobytes(), (1 << FILTER_BITS) - 1

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed, known = np.unpackbits(np.frombuffer(packed, dtype=np.uint8), bitorder="little").tobytes(), {}

        def wanted(term: bytes) -> bool:
            found = known.get(term)
            if found is None:
                if len(known) > 500_000:
                    known.clear()
                found = known[term] = bool(allowed[zlib.crc32(term) & mask])
            return found

        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, terms_of(text.as_py() or b""), wanted)
                if len(block.ids) == BLOCK_DOCS or block.size >= BLOCK_POSTINGS:
                    yield block.rows(number)
                    number, block = number + 1, _Block()
        if block.ids:
            yield block.rows(number)

    rows = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return staged(rows.mapInArrow(blocks, INDEX))


def _weight(n_all: str, df: str) -> F.Column:
    ratio = f"(2D * {n_all} + 2D) / (2D * {df} + 1D)"
    return F.expr(f"cast(floor(1000D * ln({ratio})) AS bigint)")


def _bundles(indexed: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The empty bundles, one per block and group of items, and the postings with their owner and group."""
    n_items = terms.select("item_id").distinct().count()
    n_groups = max(1, math.ceil(n_items / BUNDLE_ITEMS))
    about = indexed.where(F.col("term").isNull())
    n_all, l_all, n_blocks = about.agg(F.sum("n_docs"), F.sum("n_terms"), F.count("*")).first()
    n_all, l_all = n_all or 0, l_all or 0

    owner = F.lit(len(OWNERS) - 1)
    for i in reversed(range(len(OWNERS) - 1)):
        owner = F.when(F.col("df") < F.lit(OWNERS[i] * n_all), i).otherwise(owner)
    found = indexed.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n_docs").alias("df"))
    weighed = terms.join(found, "term").select(
        "item_id", "term", owner.cast("int").alias("owner"), _weight(f"{n_all}D", "df").alias("weight")
    )
    grp = F.pmod(F.xxhash64("item_id"), F.lit(n_groups)).cast("int").alias("grp")
    numbered = terms.select("item_id").distinct().withColumn("grp", grp)
    groups = numbered.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("item_id"))).alias("own"))
    places = groups.select("grp", F.posexplode("own").alias("place", "item")).select("grp", "place", "item.item_id")
    same = F.col("a.item_id").eqNullSafe(F.col("b.item_id"))
    by_term = (
        weighed.alias("a")
        .join(places.alias("b"), same)
        .groupBy("b.grp", "a.term")
        .agg(F.any_value("a.owner").alias("owner"), F.any_value("a.weight").alias("weight"), F.collect_list("b.place").alias("items"))
        .groupBy("grp")
        .agg(F.collect_list(F.struct("term", "owner", "weight", "items")).alias("terms"))
    )
    item_groups = groups.select("grp", F.col("own.item_id").alias("item_ids"), F.size("own").alias("n_items")).join(by_term, "grp")

    salts = max(1, math.ceil((n_blocks or 0) / BLOCKS_A_SALT))
    every = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))
    salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt")
    blocks = about.select("block", salt, F.col("docs").alias("lengths"), "ids").withColumn("grp", every)
    spread = item_groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    nothing = F.lit(b"").cast("binary")
    bundles = blocks.join(spread, ["grp", "salt"]).select(
        "block",
        "grp",
        F.lit(n_all).cast("long").alias("n_all"),
        F.lit(l_all).cast("long").alias("l_all"),
        "n_items",
        "item_ids",
        "lengths",
        "ids",
        "terms",
        nothing.alias("items"),
        nothing.alias("docs"),
        nothing.alias("scores"),
    )
    of_owner = terms.join(found, "term").select("term", owner.cast("int").alias("owner")).distinct()
    postings = indexed.where(F.col("term").isNotNull()).select("block", "term", "docs")
    return bundles, _owned(postings, of_owner, n_groups)


def _owned(postings: DataFrame, owners: DataFrame, n_groups: int) -> DataFrame:
    """Postings with their owner; those of terms of no item, which the filter let through by chance, go."""
    every = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))
    return postings.join(owners, "term").withColumn("grp", every)


def _damping(lengths: np.ndarray, n_all: int, l_all: int) -> np.ndarray:
    """Eight times each document's length term; Python integers where 64 bits might not do."""
    factor = 90 * n_all
    if len(lengths) and int(lengths.max()) * factor >= 1 << 63:
        return np.array([8 * (10 + n * factor // max(l_all, 1)) for n in lengths.tolist()], dtype=np.int64)
    return 8 * (10 + lengths * factor // max(l_all, 1))


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest score of every row, 0 if there are fewer columns."""
    if scores.shape[1] < k:
        return np.zeros(len(scores), dtype=np.int64)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def _visit(owner: int, k: int):
    """One stage: every bundle of a block meets the postings of ``owner`` there."""

    def stage(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left
        bundle = left.to_pylist()[0]
        lengths = np.frombuffer(bundle["lengths"], dtype=np.int64)
        scores = _dense(bundle, len(lengths))
        damping = _damping(lengths, bundle["n_all"], bundle["l_all"])
        mine = {t["term"]: t for t in bundle["terms"] if t["owner"] == owner}
        for term, packed in zip(right.column("term").to_pylist(), right.column("docs").to_pylist()):
            if term in mine:
                docs, times = np.frombuffer(packed, dtype=np.int64).reshape(2, -1)
                gains = mine[term]["weight"] * (1_000_000_000 * times // (1000 * times + damping[docs]))
                scores[np.ix_(mine[term]["items"], docs)] += gains
        rest = np.zeros(len(scores), dtype=np.int64)
        for term in bundle["terms"]:
            if term["owner"] > owner:
                rest[term["items"]] += MOST * term["weight"]
        keep = (scores > 0) & (scores + rest[:, None] >= _kth(scores, k)[:, None])
        items, docs = np.nonzero(keep)
        sparse = [items.astype(np.int32), docs.astype(np.int32), scores[items, docs]]
        packed = dict(zip(("items", "docs", "scores"), (pa.array([s.tobytes()], pa.binary()) for s in sparse)))
        lists = {name: left.column(name).cast(kind) for name, kind in _LISTS.items()}
        columns = packed | lists
        return pa.table({name: columns.get(name, left.column(name)) for name in left.column_names})

    return stage


def _dense(bundle: dict, n_docs: int) -> np.ndarray:
    scores = np.zeros((bundle["n_items"], n_docs), dtype=np.int64)
    items, docs = (np.frombuffer(bundle[c], dtype=np.int32) for c in ("items", "docs"))
    scores[items, docs] = np.frombuffer(bundle["scores"], dtype=np.int64)
    return scores


def _best_of_block(k: int):
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch.to_pylist():
                items, docs = (np.frombuffer(bundle[c], dtype=np.int32) for c in ("items", "docs"))
                scores = np.frombuffer(bundle["scores"], dtype=np.int64)
                ids = bundle["ids"]
                known = np.array([i is not None for i in ids], dtype=bool)
                number = np.array([i if i is not None else 0 for i in ids], dtype=np.int64)
                order = np.lexsort((number[docs], known[docs], -scores, items))
                items, docs, scores = items[order], docs[order], scores[order]
                place = np.arange(len(items)) - np.searchsorted(items, items)
                top = place < k
                own = bundle["item_ids"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own[i] for i in items[top].tolist()], pa.int64()),
                        pa.array([ids[d] for d in docs[top].tolist()], pa.int64()),
                        pa.array(scores[top], pa.int64()),
                    ],
                    ["item_id", "doc_id", "score"],
                )

    return best


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The ``k`` documents of highest score above 0 for every item: ``item_id``, ``rank``, ``doc_id``, ``score``."""
    terms = staged(item_terms(items))
    indexed = index(docs, _term_filter(terms))
    bundles, postings = _bundles(indexed, terms)
    for owner in range(len(OWNERS)):
        own = postings.where(F.col("owner") == owner).select("block", "grp", "term", "docs").toDF("at", "of", "term", "docs")
        met = bundles.groupBy("block", "grp").cogroup(own.groupBy("at", "of"))
        bundles = met.applyInArrow(_visit(owner, k), BUNDLE)
    found = bundles.mapInArrow(_best_of_block(k), "item_id long, doc_id long, score long")
    place = "row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)"
    ranked = found.withColumn("rank", F.expr(place).cast("int")).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
