from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGES, documents, prose

from firmscout.llm import lm

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*(text or "").encode().translate(LOWER).split(), b"\n"]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


def found(docs):
    return {r["doc_id"]: r for r in lm.score(docs).collect()}


def check(rows, got):
    counts = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for doc, text in rows:
        own, r = tokens(text), got[doc]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held(doc), len(own), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0


def test_counts_and_base(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 300)  # several blocks, several tasks
    monkeypatch.setattr(lm, "WORDS_PER_TASK", 200)
    monkeypatch.setattr(lm, "PART_BYTES", 2000)
    rows = [(i, prose(i, 60)) for i in range(25)] + [(50, "A a É é\x0bx"), (51, "a " * 900), *EDGES]
    check(rows, found(documents(spark, rows, extra=True)))


def test_better_than_the_base_on_held_out_texts(spark):
    """Two languages, which the base cannot tell apart."""
    rng = random.Random(1)
    plain, accents = ([w for w in set(prose(k, 700).split()) if w] for k in ("one", "two"))
    accents = [w.replace("o", "é").replace("a", "ü") for w in accents]
    rows = [(i, " ".join(rng.choice((plain, accents)[i % 2]) for _ in range(300))) for i in range(120)]
    got = found(documents(spark, rows))
    out = [r for r in got.values() if r["held_out"]]
    assert out and sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_probabilities_of_all_next_symbols_sum_to_one():
    """Bits are coded, so what can follow a prefix shares its probability exactly."""
    rng = random.Random(5)
    tables = np.zeros((lm.CONTEXTS, lm.SLOTS, 2), dtype=np.float32)
    words = sorted({b"@" + bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 4))) for _ in range(300)})
    events = lm.Events(words)
    for k, slots in enumerate(events.slots):
        for bit, slot in zip(events.bits.ravel(), slots.ravel()):
            tables[k, slot, int(bit)] += 1
    mixer = lm.Mixer()
    for _ in range(5):
        mixer.learn(tables, events, events.per_bit(np.ones(len(words))))
    after = [b"@ab" + bytes([c]) for c in range(256) if c != 10]
    # Only the byte after the common prefix differs; what is behind it is left out.
    events = lm.Events(after)
    odds, gate, word = mixer.inputs(tables, events, 0.0)
    mixed = mixer.mixed(odds, (gate, events.place))
    p = 0.5 / (1 + np.exp(-mixed.astype(float))) + 0.5 * mixer.refined()[word, mixer.step_of(mixed)]
    each = np.where(events.bits > 0, p, 1 - p).prod(axis=0)[events.column[events.starts + 2]]
    assert each.sum() <= 1 + 1e-6 and each.sum() > 0.99


def test_shared_columns_change_nothing():
    rng = random.Random(6)
    words = {bytes([rng.choice(b"@A")]) + bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 9))) for _ in range(400)}
    words = sorted(words | {b"@" + b"x" * 40, b"@" + b"x" * 41, b"@" + b"x" * 39 + b"y"})
    together, weights = lm.Events(words), np.arange(1.0, len(words) + 1)
    assert together.bits.shape[1] < sum(len(w) for w in words)
    tables = np.random.default_rng(1).random((lm.CONTEXTS, lm.SLOTS, 2)).astype(np.float32) * 9
    mixer = lm.Mixer()
    scores = mixer.scores(tables, together, mixer.refined())
    for word, score in list(zip(words, scores))[::7]:
        assert mixer.scores(tables, lm.Events([word]), mixer.refined())[0] == pytest.approx(score, rel=1e-6)
    assert together.per_bit(weights).sum() == sum(w * n for w, n in zip(weights, together.sizes))


def test_nothing_learned_and_no_rows(spark):
    assert found(documents(spark, [])) == {}
    only = next(i for i in range(100) if held(i))
    got = found(documents(spark, [(only, "a b")]))[only]
    assert got["train_tokens"] == 0 and got["n_known"] == 0 and got["score"] < 0


def test_reruns_agree(spark):
    rows = [(i, prose(i, 80)) for i in range(30)]
    assert found(documents(spark, rows)) == found(documents(spark, rows))


def test_order_of_words_counts(spark):
    """Contexts reach across the space: a text scores better than the same words in another order."""
    rng = random.Random(2)
    chain = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "of", "a"]
    rows = [(i, " ".join(chain * 20)) for i in range(60)]
    one, other = [i for i in range(1000, 1200) if held(i)][:2]
    mixed = chain * 20
    rng.shuffle(mixed)
    got = found(documents(spark, [*rows, (one, " ".join(chain * 20)), (other, " ".join(mixed))]))
    assert got[one]["base_score"] == pytest.approx(got[other]["base_score"])
    assert got[one]["score"] > 0.5 * got[other]["score"]


def test_heads_and_rests_make_the_whole_token():
    """Every bit of every token is coded once, and what can follow the end of a token shares its probability."""
    texts = [b"a", b"ab", b"abc", b"abcd", b"a\0b", "\u00e9t\u00e9".encode()]
    codes, often = lm.heads_of(b"\t" + b" ".join(texts) + b"\n ")
    accent = "\u00e9".encode()
    want = [b" a ", b"a ab", b"ab ab", b"bc ab", b"cd a\0", b"\0b " + accent, accent + b" "]
    assert sorted(map(lm.head_key, codes.tolist())) == sorted(want) and often.tolist() == [1] * 7
    assert [lm.head_key(c) for c in lm.heads_of(b"")[0].tolist()] == [b" "]
    heads = want
    fronts = lm.Events([bytes([lm.FRONT]) + h for h in heads])
    rests = lm.Events([bytes([lm.REST]) + t for t in texts] + [bytes([lm.REST])])
    bits = fronts.over_words(np.ones(fronts.bits.shape)) + rests.over_words(np.ones(rests.bits.shape))
    assert bits.tolist() == [8 * (len(t) + 1) for t in texts] + [8]


def test_odds_of_slots_are_those_of_single_bits():
    """What the mixer looks up per slot is what the counts of each bit's slot say."""
    rng = np.random.default_rng(3)
    tables = rng.integers(0, 70, (lm.CONTEXTS, lm.SLOTS, 2)).astype(np.float32)
    events = lm.Events(sorted(b"@" + w.encode() for w in set(prose(4, 300).split())))
    for less in (0.0, 1.0):
        odds, gate, word = lm.Mixer().inputs(lm.Odds(tables, less), events, less)
        levels = []
        for k, slots in enumerate(events.slots):
            zero, one = tables[k][slots][..., 0], tables[k][slots][..., 1]
            zero, one = np.maximum(zero - less * (1 - events.bits), 0), np.maximum(one - less * events.bits, 0)
            assert (odds[k] == np.log((one + lm.START) / (zero + lm.START))).all()
            levels.append(np.searchsorted(lm.LEVELS, zero + one))
        assert (word == levels[-1]).all() and (gate == levels[-1] * (len(lm.LEVELS) + 1) + levels[3]).all()


def test_small_parts_are_counted_together():
    """A count runs over all slots, so it is not made for every part of the vocabulary."""
    parts = [([b"@" + w.encode() for w in prose(k, 40).split()], k) for k in range(12)]
    batches = [
        pa.RecordBatch.from_pydict({"part": [k], "payload": [lm._pack(sorted(set(words)), np.ones(len(set(words)), dtype=np.int64), np.zeros(0))]})
        for words, k in parts
    ]
    got = list(lm._gathered(iter(batches), 1000))
    assert len(got) == 1 and got[0][0] == [w for words, _ in parts for w in sorted(set(words))]
    assert len(got[0][1]) == len(got[0][0]) and (got[0][1] == 1).all()
    assert [len(k) for k, _ in lm._gathered(iter(batches), 60)][:-1] >= [60]
