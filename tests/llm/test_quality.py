from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from helpers import EDGES, documents, prose

from firmscout.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            repeated |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(repeated),
        len(lines), sum(c.isascii() and c.isupper() for c in text or ""), (text or "").count("!"),
        len(re.findall(r"[#*$%&|<>]+", text or "")),
        sum(bool(re.fullmatch(r"[^\W\d_]+[.,;:!?]?", w)) for w in words),
    )


def rows():
    out = [(i, prose(i, 60 + i)) for i in range(40)]
    out += [(100 + i, " ".join(w + "***" for w in prose(i, 80).split())) for i in range(6)]
    out += [(200 + i, " ".join(w.upper() + "!!" for w in prose(i, 80).split()[:10] * 5)) for i in range(6)]
    out += [(300, "a b c d e f " * 3), (301, "x y z\nx y z\n\nx y z "), (302, "a b c d e"), (303, "é ü. ß! 1, b"), (304, "a a a a a a a a a a a a")]
    out += [(305, prose(7, 30) + "\n" + prose(7, 30)), (306, "tiny but clean text of eleven words in one plain line.")]
    return [*out, *EDGES]


def test_counts_equal_plain_python(spark):
    data = rows()
    got = quality.features(documents(spark, data)).select("doc_id", "_q").collect()
    assert {r["doc_id"]: tuple(r["_q"]) for r in got} == {d: counts(t) for d, t in data}


def votes(c):
    names = dict(zip(quality.FEATURES, c))
    out = []
    for _, bad, good in quality.RULES:
        true = lambda rule: bool(
            eval(re.sub(r"(\w+) BETWEEN (.+) AND (.+)$", r"(\2) <= \1 <= (\3)", rule).replace(" = ", " == ").replace("AND", "and").replace("OR", "or"), {}, names)
        )
        out.append(-1 if true(bad) else 1 if true(good) else 0)
    return tuple(out)


def posteriors(patterns):
    """The same model by plain loops."""
    m = len(quality.RULES)
    good, b, g = quality.GOOD_SHARE, [quality.PRIOR_BAD] * m, [quality.PRIOR_GOOD] * m
    total = sum(patterns.values())
    k = quality.GUESS_SHARE * total

    def p(v):
        odds = math.log(good / (1 - good))
        for j, x in enumerate(v):
            odds += math.log(g[j] / b[j]) if x < 0 else math.log((1 - g[j]) / (1 - b[j])) if x > 0 else 0
        return 1 / (1 + math.exp(-odds))

    for _ in range(quality.ROUNDS):
        own = {v: p(v) for v in patterns}

        def share(j, mass, prior, held):
            bad = sum(mass(v) for v in patterns if v[j] == -1)
            cast = sum(mass(v) for v in patterns if v[j] != 0)
            return (bad + k * held * prior) / (cast + k * held)

        b = [share(j, lambda v: patterns[v] * (1 - own[v]), quality.PRIOR_BAD, 1 - quality.GOOD_SHARE) for j in range(m)]
        g = [share(j, lambda v: patterns[v] * own[v], quality.PRIOR_GOOD, quality.GOOD_SHARE) for j in range(m)]
        good = (sum(n * own[v] for v, n in patterns.items()) + k * quality.GOOD_SHARE) / (total + k)
    return {v: p(v) for v in patterns}


def test_report_equals_plain_model(spark):
    data = rows()
    counted = {d: counts(t) for d, t in data}
    model = posteriors(Counter(votes(c) for c in counted.values()))
    got = {r["doc_id"]: r for r in quality.report(documents(spark, data, extra=True)).collect()}
    for doc, c in counted.items():
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        r = got[doc]
        assert tuple(r)[1:6] == c[:5]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and model[votes(c)] >= 0.5)
    assert all(got[i]["kept"] for i in [*range(40), 306])
    assert not any(got[i]["kept"] for i in (*range(100, 106), *range(200, 206), 300, 900, 901, 902, 903))


def test_stage_passes_columns_and_rows(spark):
    docs = documents(spark, [*rows(), rows()[0]], extra=True)
    out = quality.keep_good(docs)
    assert out.columns == docs.columns
    ids = [r[0] for r in out.collect()]
    assert ids.count(0) == 2 and 200 not in ids and 306 in ids


@pytest.mark.parametrize("make", [quality.report, quality.keep_good])
def test_no_rows(spark, make):
    assert make(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = quality.keep_good(documents(spark, rows()[:3]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
