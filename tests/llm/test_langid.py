from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from helpers import EDGES, documents

from firmscout.llm import langid

PARTS = {"aa": "tha ing ess", "bb": "eau oux que", "cc": "sch ung lich", "dd": "ción ado mente", "ee": "ska och inte"}


def text(lang, seed, words=40):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(PARTS[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(words))


def test_held_out_accuracy_and_edges(spark):
    langs = sorted(PARTS)
    rows = [(i, text(langs[i % 5], i), "s", langs[i % 5]) for i in range(200)]
    rows += [(300, text("aa", 300), "s", None), (301, "12 34 !!", "s", "aa"), (302, text("bb", 1) * 400, "s", "bb")]
    rows += [(d, t, "s", "cc") for d, t in EDGES]
    got = {r["doc_id"]: r for r in langid.identify(documents(spark, rows, extra=True)).collect()}
    assert len(got) == len(rows)
    held = [(i, r) for i, r in got.items() if r["held_out"] and i is not None and i < 200]
    assert len(held) > 20 and all(r["lang_pred"] == langs[i % 5] for i, r in held)
    assert got[300]["lang_pred"] == "aa" and got[302]["lang_pred"] == "bb"
    for doc in (301, 900, 901, 902):
        assert (got[doc]["lang_pred"], got[doc]["score"], got[doc]["ambiguous"]) == ("und", 0.0, True)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_mixed_text_is_ambiguous(spark):
    rows = [(i, text(("aa", "bb")[i % 2], i), "s", ("aa", "bb")[i % 2]) for i in range(60)]
    both = " ".join(w for pair in zip(text("aa", 99).split(), text("bb", 99).split()) for w in pair)
    got = {r["doc_id"]: r for r in langid.identify(documents(spark, [*rows, (500, both, "s", None)])).collect()}
    assert got[500]["score"] < min(got[i]["score"] for i in range(60))


@pytest.mark.parametrize("rows", [[], [(1, "abc", "s", None)], [(1, "abc", "s", "aa"), (4, "abc abc", "s", "aa")]])
def test_little_to_learn_from(spark, rows):
    got = langid.identify(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r["lang_pred"] for r in got} <= {"und", "aa"}


@pytest.mark.parametrize("n", [2, 3, 4, 6, 9, 30])
def test_codewords_are_apart(n):
    code = langid.codewords(n)
    apart = min(int((a != b).sum()) for a, b in itertools.combinations(code, 2))
    assert apart >= (1 if n == 2 else code.shape[1] // 4)
    assert (np.abs(code.sum(axis=0)) < n).all()


def test_long_text_equals_its_parts():
    data = text("aa", 5, 200).encode()
    slots = langid.trigram_slots(data)
    assert len(slots) == len(data) and (slots >= 0).all() and (slots < langid.SLOTS).all()
    assert (langid.trigram_slots(data.upper()) == slots).all()
