"""Approximate nearest neighbours by a forest of random-projection trees.

Every tree splits vectors by their projection on the difference of two random ones, at the median, down to leaves of equal
share. The planes are fitted on a bounded sample; every vector is then led to one leaf of each tree. A query enters all
trees at once: one queue holds the open nodes of the whole forest, ordered by the least margin on the way to each, and
leaves are taken from it until enough have been seen. What lies in them is ranked by the inner products of the original
vectors. How many leaves are enough is measured on the sample against brute force, so that it meets ``target`` recall.

Inner products become angles by one more component, which gives all vectors the length of the longest one.

Equal vectors are one vector in the forest, with the smallest ids that can be among anyone's ``k`` nearest, so that a
vector that a third of all rows repeat is searched once. Rows whose vector is null, zero or empty or holds a null or a
non-finite component take no part, nor do those without id or with another number of components than most rows have (of
equally frequent numbers, the largest counts). Rows with the same id and vector are one; rows with the same id and
different vectors are different rows. With no query there are no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import picked, staged

K, TREES, TARGET, SEED = 20, 24, 0.95, 13
# The sample on which planes are fitted: at most so many vectors, and so many bytes of them.
SAMPLE, SAMPLE_BYTES = 65_536, 32 << 20
# Vectors of a leaf, bytes of all planes, and vectors of a leaf that one task compares at once.
LEAF, FOREST_BYTES, SLICE_ROWS = 512, 16 << 20, 8192
# Queries that the number of leaves is measured with, queries compared at once, and hits kept beyond k before exact sums.
TRIALS, QUERIES, SPARE = 256, 256, 4


def _clean(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` of the rows that take part."""
    found = picked(rows, key, vector).toDF("id", "v").select(F.col("id").cast("long"), "v")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    found = found.where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
    # Negative zeros become zeros, so that equal vectors are equal everywhere.
    return found.withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double"))))


def _norm(v: F.Column) -> F.Column:
    """The length of a vector; components are scaled first, so that no square overflows."""
    most = F.array_max(F.transform(v, F.abs))
    return most * F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, x: total + (x / most) * (x / most)))


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _raised(v: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component, all of length 1."""
    v = v / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", v, v)))
    return np.column_stack([v, rest]).astype(np.float32)


def _asked(v: np.ndarray) -> np.ndarray:
    """Queries of length 1, without that component."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return np.column_stack([v / np.linalg.norm(v, axis=1, keepdims=True), np.zeros(len(v))]).astype(np.float32)


def grow(v: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The planes and cuts of one tree, node by node of every level; children of node i are 2i + 1 and 2i + 2."""
    rng = np.random.default_rng([SEED, seed])
    planes, cuts = np.zeros(((1 << depth) - 1, v.shape[1]), np.float32), np.zeros((1 << depth) - 1, np.float32)
    members = [np.arange(len(v))]
    for node in range(len(planes)):
        own = members[node]
        plane = rng.normal(size=v.shape[1])
        if len(own) > 1:
            a, b = rng.choice(own, 2, replace=False)
            plane = v[a] - v[b] if (v[a] != v[b]).any() else plane
        planes[node] = plane / np.linalg.norm(plane)
        side = v[own] @ planes[node]
        cuts[node] = np.median(side) if len(own) else 0
        members += [own[side <= cuts[node]], own[side > cuts[node]]]
        members[node] = own[:0]
    return planes, cuts


class Forest:
    """All trees, of one depth; small whatever the data, as sample and leaves are bounded."""

    def __init__(self, planes: np.ndarray, cuts: np.ndarray) -> None:
        self.planes, self.cuts = planes, cuts
        self.depth = (cuts.shape[1] + 1).bit_length() - 1
        self.leaves = 1 << self.depth
        self.size = self.leaves * len(cuts)

    def leaf_of(self, v: np.ndarray) -> np.ndarray:
        """For every vector its leaf in each tree, numbered through the forest."""
        out = np.zeros((len(v), len(self.cuts)), dtype=np.int64)
        for t, (planes, cuts) in enumerate(zip(self.planes, self.cuts)):
            node = np.zeros(len(v), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", v, planes[node]) > cuts[node])
            out[:, t] = t * self.leaves + node - (self.leaves - 1)
        return out

    def margins(self, q: np.ndarray) -> np.ndarray:
        """The least margin on the way to every leaf.

        The shared queue takes the open node whose least margin is largest next, and no child has more than its parent. So
        leaves leave the queue in the order of this number, which is computed for many queries at once.
        """
        every = []
        for planes, cuts in zip(self.planes, self.cuts):
            sides, least = q @ planes.T - cuts, np.full((len(q), 1), np.inf, np.float32)
            for d in range(self.depth):
                own = sides[:, (1 << d) - 1 : (2 << d) - 1]
                least = np.stack([np.minimum(least, -own), np.minimum(least, own)], axis=2).reshape(len(q), -1)
            every.append(least)
        return np.concatenate(every, axis=1)

    def queue(self, q: np.ndarray, n: int) -> np.ndarray:
        """For every query the ``n`` leaves that the shared queue gives first."""
        n = min(n, self.size)
        return np.argpartition(-self.margins(q), n - 1, axis=1)[:, :n]


def leaves_needed(forest: Forest, v: np.ndarray, longest: float, k: int, target: float) -> int:
    """After how many leaves queries of the sample have seen ``target`` of their ``k`` nearest in the sample."""
    rng = np.random.default_rng(SEED)
    own = rng.choice(len(v), min(TRIALS, len(v)), replace=False)
    leaf, needed = forest.leaf_of(_raised(v, longest)), []
    for i in own:
        products = v @ v[i]
        products[i] = -np.inf
        near = np.argsort(-products, kind="stable")[: min(k, len(v) - 1)]
        place = np.empty(forest.size, dtype=np.int64)
        place[np.argsort(-forest.margins(_asked(v[i : i + 1]))[0], kind="stable")] = np.arange(forest.size)
        needed.append(place[leaf[near]].min(axis=1))
    needed = np.concatenate(needed)
    return int(np.quantile(needed, target, method="higher")) + 1 if len(needed) else 1


def _fit(sample: DataFrame, d: int, depth: int, trees: int, longest: float, k: int, target: float) -> tuple[Forest, int]:
    """Trees grow in tasks of their own; then one task, which has the bounded sample, counts the leaves needed."""

    def tree(key: tuple, rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("uid").to_numpy())
        planes, cuts = grow(_raised(_matrix(rows.column("v"), d)[order], longest), depth, key[0].as_py())
        return pa.table({"tree": [key[0]], "planes": [planes.tobytes()], "cuts": [cuts.tobytes()]})

    every = sample.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    grown = every.groupBy("tree").applyInArrow(tree, "tree int, planes binary, cuts binary").collect()
    grown.sort(key=lambda row: row.tree)
    forest = Forest(
        np.stack([np.frombuffer(t.planes, np.float32).reshape(-1, d + 1) for t in grown]),
        np.stack([np.frombuffer(t.cuts, np.float32) for t in grown]),
    )

    def trial(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("uid").to_numpy())
        n = leaves_needed(forest, _matrix(rows.column("v"), d)[order], longest, k, target)
        return pa.table({"n": pa.array([n], pa.int32())})

    return forest, sample.groupBy().applyInArrow(trial, "n int").first()[0]


def _packed(leaf: np.ndarray, parts: dict[str, np.ndarray], row: np.ndarray) -> pa.RecordBatch:
    """A row per leaf, with what lies there; ``row`` names the vector of every place in ``leaf``."""
    order = np.argsort(leaf, kind="stable")
    leaf, row = leaf[order], row[order]
    edges = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1], True]) if len(leaf) else np.zeros(1, int)
    spans = list(zip(edges[:-1], edges[1:]))
    columns = {"leaf": pa.array(leaf[edges[:-1]] if spans else [], pa.int64())}
    for name, values in parts.items():
        columns[name] = pa.array([values[row[a:b]].tobytes() for a, b in spans], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def _members(forest: Forest, d: int, longest: float, slices: int):
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), d)
            if len(v):
                uid, rep = (batch.column(c).to_numpy() for c in ("uid", "rep"))
                leaf = forest.leaf_of(_raised(v, longest)) * slices + (uid % slices)[:, None]
                row = np.repeat(np.arange(len(v)), leaf.shape[1])
                yield _packed(leaf.ravel(), {"uids": uid, "reps": rep, "vectors": v}, row)

    return members


def _askers(forest: Forest, d: int, n: int, slices: int):
    def askers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, uid = _matrix(batch.column("v"), d), batch.column("uid").to_numpy()
            for at in range(0, len(v), QUERIES):
                own = v[at : at + QUERIES]
                leaf = forest.queue(_asked(own), n)
                leaf = (leaf[:, :, None] * slices + np.arange(slices)).reshape(len(own), -1)
                row = np.repeat(np.arange(len(own)), leaf.shape[1])
                yield _packed(leaf.ravel(), {"asked": uid[at : at + QUERIES], "vectors": own}, row)

    return askers


def _unpack(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, dtype=kind) for x in column.to_pylist()])


def _best(asked: np.ndarray, found: np.ndarray, reps: np.ndarray, scores: np.ndarray, k: int) -> list[np.ndarray]:
    """The ``k`` best of every query, each vector once."""
    order = np.lexsort((found, reps, -scores, asked))
    columns = [c[order] for c in (asked, found, reps, scores)]
    new = np.r_[True, (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])] if len(order) else []
    columns = [c[np.asarray(new, dtype=bool)] for c in columns]
    place = np.arange(len(columns[0])) - np.searchsorted(columns[0], columns[0])
    return [c[place < k] for c in columns]


def _results(columns: list[np.ndarray]) -> pa.Table:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["asked", "found", "rep", "score"])


def _search(d: int, k: int, buckets: int):
    """Exact inner products of a leaf's vectors with the queries that reached it; the best of each, packed by bucket."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: dict[str, list] = {"bucket": [], "hits": []}
        if left.num_rows and right.num_rows:
            uids, reps = _unpack(left.column("uids"), np.int64), _unpack(left.column("reps"), np.int64)
            v = _unpack(left.column("vectors"), np.float64).reshape(-1, d)
            asked, q = _unpack(right.column("asked"), np.int64), _unpack(right.column("vectors"), np.float64).reshape(-1, d)
            n, found = min(len(v), k + SPARE), []
            for at in range(0, len(q), QUERIES):
                own = q[at : at + QUERIES]
                near = np.argpartition(-(own @ v.T), n - 1, axis=1)[:, :n]
                scores = (v[near] * own[:, None, :]).sum(axis=2)
                who = np.repeat(asked[at : at + QUERIES], n)
                found.append(_best(who, uids[near].ravel(), reps[near].ravel(), scores.ravel(), k))
            columns = [np.concatenate(c) for c in zip(*found)]
            bucket = columns[0] % buckets
            for b in np.unique(bucket):
                own = bucket == b
                rows["bucket"].append(int(b))
                rows["hits"].append(b"".join(c[own].tobytes() for c in columns))
        return pa.table({"bucket": pa.array(rows["bucket"], pa.int32()), "hits": pa.array(rows["hits"], pa.binary())})

    return search


def _merge(k: int):
    def merge(rows: pa.Table) -> pa.Table:
        parts = []
        for packed in rows.column("hits").to_pylist():
            words = np.frombuffer(packed, dtype=np.int64).reshape(4, -1)
            parts.append([*words[:3], words[3].view(np.float64)])
        return _results(_best(*[np.concatenate(c) for c in zip(*parts)], k))

    return merge


def nearest(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 20,
    k: int = K,
    trees: int = TREES,
    target: float = TARGET,
    sample: int = SAMPLE,
) -> DataFrame:
    """For rows whose id ``every`` divides, the ``k`` nearest others found: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    out = "query_id long, rank int, vec_id long, score double"
    clean = _clean(rows, key, vector)
    common = clean.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return rows.sparkSession.createDataFrame([], out)
    d = common.d
    clean = clean.where(F.size("v") == d).distinct()
    near = "row_number() OVER (PARTITION BY v ORDER BY id)"
    first = clean.withColumn("_place", F.expr(near)).where(F.col("_place") <= k + 1)
    distinct = first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = staged(distinct.select(F.monotonically_increasing_id().alias("uid"), F.col("ids")[0].alias("rep"), "ids", "v"))
    queries = clean.where(F.col("id") % every == 0).join(distinct.select("v", "uid"), "v").select(F.col("id").alias("query_id"), "uid")
    queries = staged(queries)
    asked = distinct.join(queries.select("uid").distinct(), "uid", "left_semi").select("uid", "v")

    n, longest = distinct.agg(F.count("*"), F.max(_norm(F.col("v")))).first()
    n_asked = queries.agg(F.countDistinct("uid")).first()[0]
    bound = min(sample, max(2, SAMPLE_BYTES // (8 * d)))
    share = min(1.0, bound / n)
    part = staged(distinct.where(F.pmod(F.xxhash64("uid"), F.lit(1 << 30)) < int(share * (1 << 30))).select("uid", "v"))
    most = min(bound // 16, FOREST_BYTES // (4 * trees * (d + 2)), n // LEAF)
    forest, enough = _fit(part, d, max(0, most.bit_length() - 1), trees, longest, k, target)
    slices, buckets = max(1, math.ceil(n / forest.leaves / SLICE_ROWS)), max(1, math.ceil(n_asked / QUERIES))

    members = distinct.select("uid", "rep", "v").mapInArrow(
        _members(forest, d, longest, slices), "leaf long, uids binary, reps binary, vectors binary"
    )
    askers = asked.mapInArrow(_askers(forest, d, enough, slices), "leaf long, asked binary, vectors binary")
    met = members.groupBy("leaf").cogroup(askers.toDF("at", "asked", "vectors").groupBy("at"))
    hits = met.applyInArrow(_search(d, k + 1, buckets), "bucket int, hits binary").groupBy("bucket")
    best = hits.applyInArrow(_merge(k + 1), "asked long, found long, rep long, score double")

    copies = distinct.select(F.col("uid").alias("found"), F.explode("ids").alias("vec_id"))
    spread = best.select("asked", "found", "score").join(copies, "found")
    order = "ORDER BY score DESC, vec_id, found"
    spread = spread.withColumn("_place", F.expr(f"row_number() OVER (PARTITION BY asked {order})")).where(F.col("_place") <= k + 1)
    pairs = queries.join(spread, F.col("uid") == F.col("asked"))
    pairs = pairs.where(~((F.col("vec_id") == F.col("query_id")) & (F.col("found") == F.col("asked"))))
    place = F.expr(f"row_number() OVER (PARTITION BY query_id, asked {order})").cast("int")
    return pairs.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
