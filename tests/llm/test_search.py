from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from helpers import EDGES, documents, prose

from firmscout.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def brute(docs, items, k):
    counts = [(d, terms(t)) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_all, l_all = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scored = []
        for doc, c in counts:
            m = 10 + 90 * c.total() * n_all // l_all
            score = sum(
                math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own
                if t in c
            )
            if score > 0:
                scored.append((-score, doc is not None, doc or 0))
        out += [(item, i + 1, d if known else None, -s) for i, (s, known, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(n=120):
    rng = random.Random(5)
    docs = [(i, prose(rng.randint(0, 60), rng.choice([3, 40, 300]))) for i in range(n)]
    docs += [(d, t) for d, t, *_ in EDGES] + [(7, "É été 9a9a_b-c\x7fDEL" + " ba" * 50), (7, "ba ba ko"), (950, "x" * (1 << 21) + " ba " + "ko-" * 400_000)]
    items = [(i, " ".join(prose(i, 20).split()[:12])) for i in range(12)]
    items += [(50, None), (51, ""), (52, "?!"), (53, "zzzz nowhere"), (3, "ba ko é 9A9A"), (54, "ba"), (None, "ko ri"), (55, "É été")]
    return docs, items


@pytest.mark.parametrize(("k", "block", "bundle"), [(10, 4096, 512), (3, 7, 4), (200, 50, 512)])
def test_equals_brute_force(spark, monkeypatch, k, block, bundle):
    monkeypatch.setattr(search, "BLOCK_DOCS", block)
    monkeypatch.setattr(search, "BUNDLE_ITEMS", bundle)
    monkeypatch.setattr(search, "BLOCKS_A_SALT", 3)
    docs, items = corpus()
    found = search.search(documents(spark, docs, extra=True), spark.createDataFrame(items, "item_id long, text string"), k)
    assert rows(found) == brute(docs, items, k)


def test_pruning_keeps_ties(spark, monkeypatch):
    """Many documents of the same score: those with the smallest ids stay, whatever the stage."""
    monkeypatch.setattr(search, "BLOCK_DOCS", 16)
    docs = [(i, "ba ko" if i % 2 else "ba ko ri") for i in range(100)] + [(i, "te sa") for i in range(100, 3000)]
    items = [(1, "ba ko"), (2, "ba ri te"), (3, "sa")]
    found = search.search(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), 5)
    assert rows(found) == brute(docs, items, 5)


@pytest.mark.parametrize("empty", ["docs", "items", "both", "no terms"])
def test_empty_tables(spark, empty):
    docs = [] if empty in ("docs", "both") else [(1, "?") if empty == "no terms" else (1, "ba ko")]
    items = [] if empty in ("items", "both") else [(1, "ba")]
    found = search.search(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert found.count() == 0


def test_terms_of_long_text_meet_at_no_cut(monkeypatch):
    text = prose(1, 500).encode()
    whole = search.terms_of(text)
    monkeypatch.setattr(search, "PIECE", 10)
    assert search.terms_of(text) == whole


def test_large_lengths_do_not_overflow():
    import numpy as np

    lengths = np.array([10**12, 5], dtype=np.int64)
    assert search._damping(lengths, 10**9, 10**12).tolist() == [8 * (10 + 90 * n * 10**9 // 10**12) for n in (10**12, 5)]
