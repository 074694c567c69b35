"""Near duplicates by a chosen-path set similarity join.

Documents with equal shingle sets form one class at once; one representative of each goes on. Every representative has
``COORDINATES`` minwise values. A tree splits them by one value at its root. A node that is still large chooses one
or, with the probability that makes it 1 / threshold on average, two more coordinates by a hash of its own path, and
sends its members on by their values there; similar documents choose alike, so a pair at the threshold is expected
to stay together in one child. Nodes that are small are compared exhaustively, and independent trees (``TREES``, more
where the threshold is lower) bring the recall to its target. Nodes that never get small (dense groups) are cut into blocks, and all pairs of blocks are
compared, so nothing is left out and no task holds a whole group.

A pair that meets in several leaves is compared in one of them, which both sides can tell. Only pairs whose signatures agree in
enough coordinates (a pair at the threshold fails that at most once in 25,000 times) have their full shingle sets read
and compared. A leaf gives back a spanning forest of its links, not all of them, and components are
found over those: what is written grows with the documents, not with the pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import numbered, picked, staged
from firmscout.llm.hashing import mix, shingles, word_hashes

SHINGLE = 5
#: Links are pairs with 100 * intersection >= percent * union; this much in the query, which has a contract for it.
PERCENT = 85
COORDINATES = 64
#: Trees at ``PERCENT``.
TREES = 16
LEAF = 4096
DEPTH = 12
#: Members of leaves that are compared in one call.
CALL = 4096
#: How often a pair at the threshold may agree in too few coordinates.
MISSED = 1 / 25_000

_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)


def least_agreement(percent: int) -> int:
    """Coordinates that signatures of a link agree in, but for ``MISSED`` of the pairs at the threshold."""
    share, below = percent / 100, 0.0
    for k in range(COORDINATES):
        below += math.comb(COORDINATES, k) * share**k * (1 - share) ** (COORDINATES - k)
        if below > MISSED:
            return k
    return COORDINATES


def branching(percent: int) -> int:
    """Nodes in a thousand that choose two coordinates."""
    return int(1000 * (100 / percent - 1))


def trees_for(percent: int) -> int:
    """Trees that miss a pair at the threshold, where all nodes branch to the last level, no more often than ``TREES`` do at ``PERCENT``."""

    def apart(percent: int) -> float:
        share, two, lost = percent / 100, branching(percent) / 1000, 0.0
        for _ in range(DEPTH):
            one = 1 - share + share * lost
            lost = one * (1 - two + two * one)
        return 1 - share + share * lost

    trees = max(TREES, math.ceil(TREES * math.log(apart(PERCENT)) / math.log(apart(percent)))) if percent < PERCENT else TREES
    if not 50 <= percent <= 100 or trees >= COORDINATES - 1:
        raise ValueError(f"no trees for {percent} percent")
    return trees


def minwise(ids: np.ndarray) -> np.ndarray:
    """``COORDINATES`` 32-bit minwise values of a set of 64-bit hashes."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(ids), 1024):
        part = ids[at : at + 1024]
        np.minimum(low, (part[None, :] * _SEEDS[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def described(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, same, signature``: ``same`` is equal for equal sets, null for empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, same, signatures = [], [], []
            for text in batch.column(1):
                ids = shingles(word_hashes(text.as_buffer().to_pybytes() if text.is_valid else b""), size)
                counts.append(len(ids))
                same.append(hashlib.blake2b(ids.tobytes(), digest_size=16).digest() if len(ids) else None)
                signatures.append(minwise(ids).tobytes() if len(ids) else None)
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(same, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "same", "signature"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, same binary, signature binary")


def leaves(classes: DataFrame, percent: int) -> DataFrame:
    """``leaf, tree, members, doc_id`` for all leaves of all trees that hold two documents or more.

    ``tree`` is the tree's number where its root's child is a leaf already, -1 farther down. Counting the members of
    nodes is an aggregate over (node, document) rows; documents alone in a node leave. Signatures are only joined to
    the members of nodes that branch.
    """
    value = lambda c: F.substring(F.col("signature"), c * 4 + 1, F.lit(4))
    roots = F.transform(
        F.sequence(F.lit(0), F.lit(trees_for(percent) - 1)), lambda t: F.struct(F.xxhash64(t, value(t)).alias("node"), t.alias("tree"))
    )
    rows = classes.select("doc_id", F.inline(roots))
    found: DataFrame | None = None
    for level in range(DEPTH + 1):
        sizes = rows.groupBy("node").agg(F.count("*").alias("members")).where("members > 1")
        shared = staged(rows.join(sizes, "node"))
        large = shared.where(F.col("members") > LEAF)
        last = level == DEPTH or large.isEmpty()
        ended = (shared if last else shared.where(F.col("members") <= LEAF)).select("node", "tree", "members", "doc_id")
        found = ended if found is None else found.unionByName(ended)
        if last:
            break
        pick = lambda i: F.pmod(F.xxhash64("node", F.lit(i)), F.lit(COORDINATES)).cast("int")
        child = lambda c: F.xxhash64("node", c, value(c))
        # The second coordinate differs from the first, or the two children would be one.
        second = (pick(1) + 1 + F.pmod(F.xxhash64("node", F.lit(2)), F.lit(COORDINATES - 1)).cast("int")) % COORDINATES
        two = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1000)) < branching(percent)
        children = F.when(two, F.array(child(pick(1)), child(second))).otherwise(F.array(child(pick(1))))
        large = large.select("node", "doc_id").join(classes.select("doc_id", "signature"), "doc_id")
        rows = large.select("doc_id", F.explode(children).alias("node"), F.lit(-1).alias("tree"))
    return found.withColumnRenamed("node", "leaf")


class _Members:
    """The members of some leaves, ordered by leaf and block pair: the columns that comparing them needs."""

    def __init__(self, table: pa.Table):
        group = ["leaf", "i", "j"]
        self.table = table.sort_by([(c, "ascending") for c in (*group, "doc_id")])
        keys = np.stack([self.table.column(c).to_numpy().astype(np.int64) for c in group])
        change = np.ones(keys.shape[1], dtype=bool)
        change[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        self.starts = np.flatnonzero(change)
        self.ends = np.append(self.starts[1:], keys.shape[1])
        self.ids = self.table.column("doc_id").to_numpy()


def _agreeing(rows: _Members, percent: int, least: int, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that may be links and are to be compared in this leaf, ordered by the first row."""
    table = rows.table
    signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)
    sizes, side, tree = (table.column(c).to_numpy() for c in ("n_shingles", "side", "tree"))
    flat, leaf = table.column("flat").to_numpy(), table.column("leaf").to_numpy()
    deep = table.column("deep")
    bits = np.int64(1) << np.arange(trees)
    left, right = [], []

    def check(i: np.ndarray, j: np.ndarray) -> None:
        fits = 100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])
        # In two blocks only pairs across are compared; the blocks themselves are compared elsewhere.
        fits &= (side[i] < 0) | (side[i] != side[j])
        i, j = i[fits], j[fits]
        same = signature[i] == signature[j]
        fits = same.sum(axis=1) >= least
        i, j, same = i[fits], j[fits], same[fits]
        # The first tree whose root's child both share and which is a leaf compares the pair; failing that, the
        # common leaf with the least name.
        shared = (same[:, :trees] & ((flat[i] & flat[j])[:, None] & bits > 0))
        first = np.where(shared.any(axis=1), shared.argmax(axis=1), -1)
        here = first == tree[i]
        for k in np.flatnonzero(here & (first < 0)).tolist():
            here[k] = min(set(deep[int(i[k])].as_py()) & set(deep[int(j[k])].as_py())) == leaf[i[k]]
        left.append(i[here].astype(np.int32))
        right.append(j[here].astype(np.int32))

    size = rows.ends - rows.starts
    for n in np.unique(size):
        own = rows.starts[size == n]
        if n <= 16:  # all leaves of one size at once
            a, b = np.triu_indices(n, 1)
            for at in range(0, len(own), 4096):
                part = own[at : at + 4096, None]
                check((part + a).ravel(), (part + b).ravel())
        else:
            step = max(1, (1 << 14) // n)  # some thousand pairs at a time
            for start in own:
                for at in range(0, n - 1, step):
                    a, b = np.meshgrid(np.arange(at, min(at + step, n - 1)), np.arange(at + 1, n), indexing="ij")
                    pair = b > a
                    check(start + a[pair], start + b[pair])
    left, right = (np.concatenate([np.zeros(0, dtype=np.int32), *x]) for x in (left, right))
    order = np.argsort(left, kind="stable")
    return left[order], right[order]


def links(classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links that connect the same representatives as all links do; ``docs`` has their texts."""
    met = staged(leaves(classes, percent))
    least, trees = least_agreement(percent), trees_for(percent)
    leaf = F.when(F.col("tree") < 0, F.col("leaf"))
    own = met.groupBy("doc_id").agg(
        F.sum(F.expr("CASE WHEN tree >= 0 THEN shiftleft(1L, tree) ELSE 0L END")).alias("flat"),
        F.collect_list(leaf).alias("deep"),  # a few for each tree at most
    )
    facts = classes.select("doc_id", "n_shingles", "signature").join(own, "doc_id")
    # Larger leaves, which no further coordinate was there for, are compared block by block.
    blocks = F.ceil(F.col("members") / LEAF).cast("int")
    block = F.pmod(F.xxhash64("doc_id", "leaf"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")),
    )
    spread = met.withColumn("blocks", blocks).withColumn("block", block).select("*", F.inline(pairs))
    spread = spread.withColumn("side", F.when(F.col("i") == F.col("j"), -1).otherwise(F.col("block")))
    # Leaves are small; a task's call gets some thousand members of many.
    calls = max(1, -(-met.count() // CALL))
    call = F.pmod(F.xxhash64("leaf", "i", "j"), F.lit(calls)).alias("call")
    spread = spread.select("leaf", "tree", "i", "j", "side", "doc_id").join(facts, "doc_id").withColumn("call", call)

    def choose(group: pa.Table) -> pa.Table:
        rows = _Members(group)
        left, right = _agreeing(rows, percent, least, trees)
        keep = np.unique(np.concatenate([left, right]))
        offsets = np.searchsorted(left, np.append(keep, np.iinfo(np.int32).max)).astype(np.int32)
        partners = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ids[right], pa.int64()))
        out = rows.table.take(pa.array(keep)).select(["call", "leaf", "i", "j", "doc_id"])
        return out.append_column("partners", partners)

    kinds = "call long, leaf long, i int, j int, doc_id long, partners array<long>"
    chosen = staged(spread.groupBy("call").applyInArrow(choose, kinds))
    texts = docs.select("doc_id", "text").join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = chosen.join(with_sets(texts).dropDuplicates(["doc_id"]), "doc_id")

    def confirm(group: pa.Table) -> pa.Table:
        rows = _Members(group)
        partners, packed = rows.table.column("partners"), rows.table.column("ids")
        a, b = [], []
        for start, end in zip(rows.starts.tolist(), rows.ends.tolist()):
            ids = rows.ids[start:end]  # in order
            held = [np.frombuffer(packed[k].as_buffer(), dtype=np.uint64) for k in range(start, end)]
            root, join = _forest(len(ids))
            for k in range(len(ids)):
                others = partners[start + k].values
                for other in np.searchsorted(ids, others.to_numpy()).tolist() if others is not None else ():
                    if root(k) == root(other):
                        continue  # already connected: the link adds nothing to components
                    both = len(np.intersect1d(held[k], held[other], assume_unique=True))
                    if 100 * both >= percent * (len(held[k]) + len(held[other]) - both):
                        join(k, other)
                        a.append(int(min(ids[k], ids[other])))
                        b.append(int(max(ids[k], ids[other])))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return sets.groupBy("call").applyInArrow(confirm, "a long, b long").distinct()


def _forest(n: int) -> tuple[Callable[[int], int], Callable[[int, int], None]]:
    """Find and join of a union-find over ``n`` places."""
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(x: int, y: int) -> None:
        up[root(x)] = root(y)

    return root, join


def with_sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, ids``: the full shingle sets as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [shingles(word_hashes(x.as_buffer().to_pybytes() if x.is_valid else b""), size).tobytes() for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def components(edges: DataFrame) -> DataFrame:
    """``id, component``: the smallest id reachable, for every id of ``edges`` (``a``, ``b``).

    Alternating large-star and small-star rounds (every id is linked to the smallest of its neighbours) until nothing
    changes; each round is two aggregates with partial sums and is staged, so lineage stays short.
    """

    def star(rows: DataFrame, large: bool) -> DataFrame:
        both = rows.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(rows.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = rows.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(least, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        return out.where("a <> b").distinct()

    mark = lambda rows: tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = staged(edges.select("a", "b").where("a <> b").distinct())
    seen = None
    while True:
        now = staged(star(star(now, True), False))
        state = mark(now)
        if state == seen:
            break
        seen = state
    # Every edge now goes from an id to the smallest of its component.
    ends = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ends.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component"))).groupBy("id").agg(
        F.min("component").alias("component")
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``).

    Texts without words have an empty set and are linked with nothing; a null id is linked with nothing either, has a
    null component and is kept. Sets are linked from ``percent`` of their union on. Rows that repeat an id are in its component; extra columns are ignored; no rows give
    no rows.
    """
    docs = picked(docs, "doc_id", "text")
    facts = staged(described(docs))
    known = facts.where("same IS NOT NULL AND doc_id IS NOT NULL")
    # Equal sets have equal signatures, so any of them stands for the class.
    classes = known.groupBy("same").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    classes = staged(classes)
    found = components(links(classes, docs, percent))
    ids = classes.select("same", F.col("doc_id").alias("id")).join(found, "id", "left")
    ids = ids.select("same", F.coalesce("component", "id").alias("_c"))
    out = facts.drop("signature").join(ids, "same", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows whose document has a smaller id in its component; all columns as they are."""
    dropped = near_duplicates(docs, percent).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    held = numbered(docs, "doc_id")
    return held.join(dropped, F.col("doc_id") == F.col("_gone"), "left_anti").toDF(*docs.columns)
