from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import EDGES, documents, prose

from firmscout.llm import collocations
from firmscout.llm.automata import Transducer, packed, prefixes, summed, union, unpacked


def brute(rows, least, longest, top, absorb=100):
    counts = {}
    for text, lang in rows:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            for size in range(1, longest + 1):
                own.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        cand = {k: v for k, v in f.items() if len(k) > 1 and v >= least}
        gone = {
            k[i : i + s] for k, v in cand.items() for s in range(2, len(k)) for i in range(len(k) - s + 1) if 100 * v >= absorb * f[k[i : i + s]]
        }
        scored = []
        for k, a in cand.items():
            if k not in gone:
                cuts = [(1000 * a * n // (f[k[:c]] * f[k[c:]]), c) for c in range(1, len(k))]
                score, c = min(cuts)
                scored.append((-score, -a, " ".join(k).encode(), f[k[:c]], f[k[c:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def corpus():
    rng = random.Random(3)
    heads = ["New york city", "of the", "The end of the day", "a b a b a b", "x\ty", "é É", "zz, top", "w.w", "nul\x00l byte"]
    rows = []
    for i in range(150):
        words = " ".join(rng.choice([*heads, *(rng.choice(["the", "of", "day", "york"]) for _ in range(6)), f"r{rng.randint(0, 999)}"]) for _ in range(40))
        rows.append((i, words, "s", rng.choice(["en", "en", "en", "fr", None, "und"])))
    rows += [(200 + i, t, "s", "en") for i, (_, t) in enumerate(EDGES)]
    rows += [(300, prose(1, 400), "s", "fr"), (301, "The end of the day " * 30_000, "s", "de"), (300, prose(1, 400), "s", "fr")]
    return rows


@pytest.mark.parametrize(
    ("least", "longest", "top", "absorb", "small"),
    [(5, 5, 2000, 100, False), (3, 4, 7, 60, True), (20, 2, 50, 100, False), (4, 7, 1000, 100, True)],
)
def test_equals_brute_force(spark, monkeypatch, least, longest, top, absorb, small):
    if small:
        for name, value in (("SHARD_WORDS", 200), ("OWNER_WORDS", 500), ("MEET", 4), ("PIECE", 50), ("FOLLOWERS", 2)):
            monkeypatch.setattr(collocations, name, value)
    rows = corpus()
    found = collocations.collocations(documents(spark, rows, extra=True), top, least=least, longest=longest, absorb=absorb)
    got = sorted(map(tuple, found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))
    assert got == brute([(t, lang) for _, t, _, lang in rows], least, longest, top, absorb)
    assert got


@pytest.mark.parametrize("rows", [[], [(1, None), (2, " . ")], [(1, "one two three")]])
def test_nothing_found(spark, rows):
    found = collocations.collocations(documents(spark, rows))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found.count() == 0


def random_rows(seed, n=3000, words=6, width=5):
    rng = np.random.default_rng(seed)
    rows = rng.integers(1, words, (n, width))
    rows[np.arange(width) >= rng.integers(1, width + 1, n)[:, None]] = 0
    return summed(rows, rng.integers(1, 4, n))


@pytest.mark.parametrize("seed", range(3))
def test_transducer(seed):
    rows, counts = random_rows(seed)
    built = Transducer.load(Transducer.build(rows, counts).dump())
    back = summed(*built.rows())
    assert np.array_equal(back[0], rows) and np.array_equal(back[1], counts)
    plain = Counter()
    for row, n in zip(rows.tolist(), counts.tolist()):
        path = [w for w in row if w]
        for d in range(1, len(path) + 1):
            plain[tuple(path[:d])] += n
    assert {tuple(p): w for paths, ws, _ in prefixes(rows, counts) for p, w in zip(paths.tolist(), ws.tolist())} == plain
    paths = [*plain, (1, 1, 1, 1, 1, 1), (9,), (1, 9), (5, 5, 5, 5, 9)]
    matrix = np.zeros((len(paths), 6), np.int64)
    for i, p in enumerate(paths):
        matrix[i, : len(p)] = p
    assert built.weigh(matrix, np.array([len(p) for p in paths])).tolist() == [plain[p] for p in paths]


def test_states_that_go_on_alike_are_one():
    rows = np.array([[a, b, 7, 8] for a in range(1, 50) for b in range(1, 50)])
    built = Transducer.build(rows, np.ones(len(rows), np.int64))
    assert [len(level.sizes) for level in built.levels] == [1, 1, 1, 1]
    assert [len(level.labels) for level in built.levels] == [49, 49, 1, 1]


def test_union_adds():
    parts = [random_rows(s) for s in range(4)]
    total = Counter()
    for rows, counts in parts:
        for row, n in zip(rows.tolist(), counts.tolist()):
            total[tuple(row)] += n
    rows, counts = union([Transducer.build(*p).dump() for p in parts] + [b""])
    assert {tuple(r): n for r, n in zip(rows.tolist(), counts.tolist())} == total


@pytest.mark.parametrize("numbers", [[], [0, 0, 7], [3, 70_000, 2**62]])
def test_ascending_numbers_are_packed(numbers):
    values = np.array(numbers, dtype=np.int64)
    assert unpacked(packed(values)).tolist() == numbers


def test_small_transducers_are_small():
    """A shard has as many as there are owners: with more text they hold less each, and what is around them must not grow."""
    one = Transducer.build(np.array([[5, 900], [5, 901], [70_000, 3]]), np.array([1, 2, 400]))
    assert len(one.dump()) < 80
    back, counts = Transducer.load(one.dump()).rows()
    assert back.tolist() == [[5, 900], [5, 901], [70_000, 3]] and counts.tolist() == [1, 2, 400]
    empty = Transducer.build(np.zeros((0, 2), dtype=np.int64), np.zeros(0, dtype=np.int64))
    assert not Transducer.load(empty.dump()).levels
