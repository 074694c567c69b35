from __future__ import annotations

import random
from collections import defaultdict

import pytest
from helpers import EDGES, documents, prose

from firmscout.llm import mixing
from firmscout.llm.common import ranked


def targets(sizes):
    """Shares by plain rounds: who is over the cap stops there, the rest is shared anew."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, budget = {}, 1.5 * sum(sizes.values())
    while True:
        left = [s for s in names if s not in full]
        if not left:
            return full
        rest = budget - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        full |= {s: 2.0 * sizes[s] for s in over}


def corpus():
    rng = random.Random(2)
    rows = [(i, prose(i, rng.randint(1, 200)), rng.choice(["b", "a", "É", "z", None, "hot", "hot", "hot"])) for i in range(150)]
    return rows + [(d, t, "edge") for d, t in EDGES] + [(790, prose(7, 30), "a"), (790, prose(7, 30), "a"), (800, "one", "tiny")]


@pytest.mark.parametrize("shard_words", [1 << 20, 500])
def test_targets_and_taken(spark, shard_words):
    rows = corpus()
    got = mixing.mix(documents(spark, rows, extra=True), shard_words=shard_words, block_words=8).collect()
    assert len(got) == len(rows)
    words = defaultdict(int)
    for _, text, source in rows:
        words[source] += len((text or "").split())
    want = targets(words)
    by_doc = {d: s for d, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        source = by_doc[r["doc_id"]]
        assert r["source_size"] == words[source]
        assert r["target"] == pytest.approx(want[source], rel=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    for source, target in want.items():
        shards = -(-words[source] // shard_words) + 1
        assert abs(taken[source] - target) <= 8 * (shards + 1)


def test_apportionment_takes_the_highest_quotients(spark):
    rng = random.Random(4)
    goals = [(str(i), 0, float(rng.choice([0, 0.4, 3, 3, 17, 250, 1000 * rng.random()]))) for i in range(60)]
    for seats in (0, 1, 7, 100, 999):
        units = spark.createDataFrame(goals, "src string, shard long, goal double")
        got = {r["src"]: r["quota"] for r in mixing.apportion(units, seats, 10.0).collect()}
        quotients = sorted(((-g / (2 * k + 1), s, k) for s, _, g in goals if g for k in range(seats)))[:seats]
        want = defaultdict(int)
        for _, s, _ in quotients:
            want[s] += 1
        assert got == {s: want[s] for s, _, _ in goals}


def test_reruns_and_partitions_agree(spark):
    docs = documents(spark, corpus())
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(mixing.mix(docs)) == rows(mixing.mix(docs.repartition(7)))


@pytest.mark.parametrize("rows", [[], [(1, None, None), (2, "", "a")]])
def test_nothing_to_mix(spark, rows):
    assert [r["taken"] for r in mixing.mix(documents(spark, rows)).collect()] == [0] * len(rows)


def test_ranked(spark):
    df = spark.createDataFrame([(f"k{i:03}",) for i in range(100)], "k string").repartition(7)
    assert [r["_rank"] for r in ranked(df, "k").orderBy("k").collect()] == list(range(100))
