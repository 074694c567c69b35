from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import EDGES, documents, prose

import corpus_pipeline
from firmscout.llm import neardup
from firmscout.llm.hashing import shingles, word_hashes


def shingle_set(text):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(doc, shingle_set(text)) for doc, text in rows]
    up = {doc: doc for doc, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    known = [(d, s) for d, s in sets if d is not None and s]
    for i, (a, x) in enumerate(known):
        for b, y in known[:i]:
            if 100 * len(x & y) >= 85 * len(x | y):
                low, high = sorted((root(a), root(b)))
                up[high] = low
    out = [(d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets]
    return sorted(out, key=repr)


def edited(text, seed, edits):
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = "new" + str(rng.randrange(1000))
    return " ".join(words)


def corpus():
    rows = [(i, prose(i, 150)) for i in range(40)]
    rows += [(100 + i, edited(prose(1, 150), i, i % 4)) for i in range(60)]
    rows += [(200 + i, prose(2, 150)) for i in range(30)]
    rows += [(300 + i, edited(prose(500, 400), i, i % 9)) for i in range(60)]
    rows += [(400, "One two three"), (401, "one TWO three"), (402, "one two four"), (20, prose(20, 150) + " tail")]
    return [*rows, *EDGES]


def found(docs):
    return sorted(map(tuple, neardup.near_duplicates(docs).collect()), key=repr)


def test_equals_brute_force(spark):
    rows = corpus()
    rows.remove((20, prose(20, 150) + " tail"))
    assert found(documents(spark, rows, extra=True)) == brute(rows)


def test_branching_and_blocks_equal_brute_force(spark, monkeypatch):
    """Leaves so small that nodes branch, and that the last ones are compared block by block."""
    rows = [r for r in corpus() if r[0] != 20]
    monkeypatch.setattr(neardup, "LEAF", 8)
    monkeypatch.setattr(neardup, "DEPTH", 2)
    assert found(documents(spark, rows)) == brute(rows)


def test_rows_that_repeat_an_id(spark):
    rows = [(1, prose(1)), (1, prose(1)), (2, prose(2)), (2, prose(1))]
    got = found(documents(spark, rows))
    assert [r[2] for r in got if r[0] == 1] == [1, 1] and len(got) == 4


def test_stage_keeps_the_first_of_each_group(spark):
    docs = documents(spark, corpus(), extra=True)
    out = neardup.keep_first(docs)
    assert out.columns == docs.columns
    ids = [r[0] for r in out.collect()]
    assert {200, None, 900, 901, 902, 903, 400, 402} <= set(ids) | {200}
    assert 201 not in ids and 401 not in ids and 2 in ids


def spaced(text, seed, edits):
    """Each edit changes five shingles: three leave 0.81 of 150 words in common, four 0.76."""
    words = text.split()
    for i in range(edits):
        words[10 + 30 * i] = f"new{seed}x{i}"
    return " ".join(words)


def between():
    rows = [(i, prose(i, 150)) for i in range(60)]
    return rows + [(1000 * n + i, spaced(prose(i, 150), i, n)) for i in range(60) for n in (3, 4) if (i + n) % 2]


def kept_by_force(rows, percent):
    sets = [(doc, shingle_set(text)) for doc, text in sorted(rows)]
    up = dict.fromkeys(d for d, _ in sets)
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if 100 * len(x & y) >= percent * len(x | y):
                up[a] = b
    return {d for d in up if up[d] is None}  # of the planted groups of two the first


@pytest.mark.parametrize("leaf", [neardup.LEAF, 8])
def test_stage_takes_pairs_from_80_percent(spark, monkeypatch, leaf):
    rows = between()
    monkeypatch.setattr(neardup, "LEAF", leaf)
    out = corpus_pipeline.near_duplicates(spark, documents(spark, rows), "")
    kept = {r[0] for r in out.collect()}
    assert kept == kept_by_force(rows, 80) and len(kept) == 90
    assert {r[0] for r in found(documents(spark, rows)) if r[3]} == {doc for doc, _ in rows}


def test_checks_follow_the_threshold():
    assert [neardup.least_agreement(p) for p in (80, 85)] == [37, 42]
    assert [neardup.trees_for(p) for p in (80, 85, 90)] == [21, 16, 16]
    with pytest.raises(ValueError):
        neardup.trees_for(40)


@pytest.mark.parametrize("rows", [[], EDGES])
def test_nothing_to_link(spark, rows):
    assert found(documents(spark, rows)) == brute(rows)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    got = {r.id: r.component for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for start in got:
        seen, todo = {start}, [start]
        while todo:
            todo += [y for y in near[todo.pop()] if y not in seen and not seen.add(y)]
        assert got[start] == min(seen)


def test_word_hashes_follow_words():
    texts = ["a b  A\tB", "Écran écran x", "one two three four five six", "z" * 3000 + " " + "z" * 3000]
    for text in texts:
        hashed, words = word_hashes(text.encode()), text.encode().lower().split()
        assert len(hashed) == len(words)
        assert (hashed[:, None] == hashed[None, :]).tolist() == [[a == b for b in words] for a in words]
    long = (" ".join(str(i) for i in range(400_000))).encode()
    assert len(np.unique(word_hashes(long))) == 400_000
    assert len(shingles(word_hashes(b"a b c d e f"), 5)) == 2 and len(shingles(word_hashes(b"a b"), 5)) == 1
