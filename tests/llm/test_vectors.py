from __future__ import annotations

import heapq

import numpy as np
import pytest

from firmscout.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    floats = lambda v: None if v is None else [None if x is None else float(x) for x in v]
    df = spark.createDataFrame([(i, floats(v), 0) for i, v in rows], SCHEMA)
    for name in ("uid", "v", "leaf", "VEC_ID"):
        df = df.toDF(*[f"_{i}" for i in range(len(df.columns))]).selectExpr("*", "'x' AS extra").toDF(*df.columns, name)
    return df.repartition(3) if rows else df


def brute(rows, every, k):
    """Exact neighbours: {query id: [(score, id)]} over distinct rows whose vector takes part."""
    fine = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine[(i, tuple(np.float32(v).astype(float)))] = None
    ids, m = [i for i, _ in fine], np.array([v for _, v in fine])
    out = {}
    for at, i in enumerate(ids):
        if i % every == 0:
            scores = (m * m[at]).sum(axis=1)
            out[i] = sorted((-s, j) for n, (s, j) in enumerate(zip(scores.tolist(), ids)) if n != at)[:k]
    return out


def got(df, twice=()):
    out = {}
    for q, rank, v, s in sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect())):
        out.setdefault(q, []).append((-s, v))
        assert q in twice or rank == len(out[q])
    return out


def recall(found, want):
    return sum(len({j for _, j in found.get(q, [])} & {j for _, j in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 2, 3, 4, 5, 6]) for i in range(70)]  # one vector many times
    rows += [(0, rows[0][1]), (20, rng.normal(size=6).tolist())]  # a repeated row, a repeated id
    rows += [(300, None), (320, []), (340, [0.0] * 6), (360, [1.0, None, 0, 0, 0, 0]), (380, [float("nan")] * 6)]
    rows += [(400, [float("inf")] * 6), (None, [1.0] * 6), (420, [-0.0, 1, 0, 0, 0, 0]), (440, [0.0, 1, 0, 0, 0, 0])]
    want = brute(rows, 20, 5)
    twice = {20}
    found = got(vectors.nearest(frame(spark, [*rows, (460, [1.0, 2.0])]), k=5), twice)  # another number of components
    assert {q for q in found} == {q for q in want} and 460 not in found
    assert len(found[20]) == 10
    for q in set(want) - twice:
        assert [j for _, j in found[q]] == [j for _, j in want[q]]
        assert np.allclose([s for s, _ in found[q]], [s for s, _ in want[q]])


def test_fewer_rows_than_asked_for(spark):
    found = got(vectors.nearest(frame(spark, [(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])])))
    assert found == {20: [(-0.5, 1), (1.0, 2)]}


@pytest.mark.parametrize("rows", [[], [(20, None)], [(1, [1.0]), (2, [2.0])], [(20, [3.0])]])
def test_no_result(spark, rows):
    found = vectors.nearest(frame(spark, rows))
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert found.count() == 0


@pytest.mark.parametrize(("kind", "sample"), [("sphere", 65_536), ("lengths", 65_536), ("clusters", 700)])
def test_recall(spark, monkeypatch, kind, sample):
    monkeypatch.setattr(vectors, "LEAF", 64)
    monkeypatch.setattr(vectors, "SLICE_ROWS", 40)
    rng = np.random.default_rng(2)
    m = rng.normal(size=(3000, 24))
    if kind == "clusters":
        m = rng.normal(size=(30, 24))[rng.integers(0, 30, 3000)] * 3 + 0.3 * m
    if kind != "lengths":
        m /= np.linalg.norm(m, axis=1, keepdims=True)
    rows = [(i, v) for i, v in enumerate(m.astype(np.float32).tolist())]
    want = brute(rows, 20, 20)
    found = got(vectors.nearest(frame(spark, rows), sample=sample))
    assert recall(found, want) >= 0.9
    assert all(len(v) == 20 for v in found.values())


def test_a_vector_that_most_rows_have(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 1.0, 0.0]) for i in range(2000)] + [(2000 + i, rng.normal(size=3).tolist()) for i in range(200)]
    found, want = got(vectors.nearest(frame(spark, rows))), brute(rows, 20, 20)
    assert recall(found, want) >= 0.9
    hot = [q for q in want if q < 2000]
    assert all(len(found[q]) == 20 for q in hot)


def test_order_is_that_of_a_shared_queue():
    rng = np.random.default_rng(3)
    v = rng.normal(size=(500, 5)).astype(np.float32)
    grown = [vectors.grow(v, 4, t) for t in range(3)]
    forest = vectors.Forest(np.stack([p for p, _ in grown]), np.stack([c for _, c in grown]))
    q = rng.normal(size=(1, 5)).astype(np.float32)
    heap, order = [(-np.inf, t, 0) for t in range(3)], []
    while heap:
        margin, t, node = heapq.heappop(heap)
        if node >= forest.leaves - 1:
            order.append(t * forest.leaves + node - (forest.leaves - 1))
            continue
        side = float(q[0] @ forest.planes[t, node] - forest.cuts[t, node])
        heapq.heappush(heap, (max(margin, side), t, 2 * node + 1))
        heapq.heappush(heap, (max(margin, -side), t, 2 * node + 2))
    for n in (1, 5, 20):
        margins = forest.margins(q)[0]
        assert sorted(margins[forest.queue(q, n)[0]]) == sorted(margins[order[:n]])
    assert forest.leaf_of(v).shape == (500, 3)
