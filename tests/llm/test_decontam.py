from __future__ import annotations

import pytest
from helpers import EDGES, documents, prose

from firmscout.llm import decontam

QUESTION = "If the old train leaves Paris at 7 and travels 120 km before Anna boards, how many of the 120 km were left when Anna sat down at 7?"
AGAIN = QUESTION.replace("Paris", "London").replace("120", "85").replace("Anna", "Bert").replace("7", "9")
MUDDLED = QUESTION.replace("Paris", "London").replace("Anna boards", "Bert boards").replace("Anna sat", "Carl sat").replace("travels 120", "travels 31").replace("at 7?", "at 6?")
PLAIN = " ".join(prose("item", 40).split())


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, rows, benchmark, **kwargs):
    out = decontam.report(documents(spark, rows, **kwargs), items(spark, benchmark)).collect()
    return {r["doc_id"]: (r["contaminated"], r["items"]) for r in out}


BENCHMARK = [(1, QUESTION), (2, PLAIN), (3, None), (4, ""), (5, prose("other", 30)), (6, QUESTION), (None, prose("lost", 30))]


def around(text, i=0):
    return prose(1000 + i, 60) + " Now. " + text + " Well. " + prose(2000 + i, 60)


def test_copies_and_reparameterised_questions(spark):
    words = PLAIN.split()
    rows = [
        (1, around(QUESTION)),
        (2, around(AGAIN)),
        (3, around(MUDDLED)),
        (4, around(PLAIN.upper())),
        (5, around("\n".join(words))),
        (6, around(" ".join(words[:20]))),
        (7, " ".join(words[:14]) + prose(5, 400) + " ".join(words[14:27]) + prose(6, 400) + " ".join(words[27:])),
        (8, around(" ".join(w if i != 20 else "changed" for i, w in enumerate(words)))),
        (9, around(prose("lost", 30))),
        *[(20 + i, prose(i, 200)) for i in range(20)],
        *EDGES,
    ]
    got = found(spark, rows, BENCHMARK, extra=True)
    assert got[1] == got[2] == (True, [1, 6])
    assert got[3] == (False, [])
    assert got[4] == got[5] == got[8] == (True, [2])
    assert got[6] == got[7] == (False, [])
    assert got[9][0]
    assert not any(got[d][0] for d in [*range(20, 40), *(d for d, _ in EDGES)])


NUMBERS = "12 + 30 = 42, 7 * 8 = 56; 100 - 1 = 99 km 81 / 9 = 9"
NAMED = "Today we ask if Anna or Bert or Carl or Dora or Emil came with Fritz and Gerd to see Hans and Ida."
STREET = "Die große Straße führt weiß und heiß an der Maßgasse vorbei"


@pytest.mark.parametrize("change", [str, str.upper, str.lower, str.title])
def test_copies_whatever_the_words_and_their_case(spark, change):
    benchmark = [(1, QUESTION), (2, NUMBERS), (3, NAMED), (4, STREET), (5, "2024 2023")]
    rows = [(i, around(change(text), i)) for i, text in benchmark[:4]]
    rows += [(5, "2024 2023"), (6, around("12 + 30 = 42, 7 * 8 = 57; 100 - 2 = 98 km 80 / 8 = 10"))]
    rows += [(7, around(" ".join(reversed(NUMBERS.split())))), (8, around("ten " * 40))]
    got = found(spark, rows, benchmark)
    assert {d: x for d, (hit, x) in got.items() if hit} == {1: [1], 2: [2], 3: [3], 4: [4], 5: [5]}


def test_stage_drops_them(spark):
    docs = documents(spark, [(1, around(QUESTION)), (2, prose(2)), (2, prose(2)), (None, around(PLAIN)), *EDGES], extra=True)
    out = decontam.keep_clean(docs, items(spark, BENCHMARK))
    assert out.columns == docs.columns
    assert sorted(str(r[0]) for r in out.collect()) == sorted(["2", "2", "None", "900", "901", "902", "903"])


@pytest.mark.parametrize("benchmark", [[], [(1, None), (2, " ")]])
def test_empty_benchmark(spark, benchmark):
    assert found(spark, [(1, QUESTION)], benchmark) == {1: (False, [])}


def test_no_rows(spark):
    assert found(spark, [], BENCHMARK) == {}


def test_tokens():
    own, slots = decontam.tokens("We met Anna, 5 km off. Anna saw 12.5 m; IT was é-à.".encode())
    kinds = [{1: "num", 2: "name", 3: "unit"}.get(int(x), "word") for x in own]
    assert kinds == ["word", "word", "name", "num", "unit", "word", "word", "word", "num", "unit", "word", "word", "word"]
    assert [bool(s) for s in slots] == [k != "word" for k in kinds]
    upper, _ = decontam.tokens("WE MET ÉVA".encode())
    lower, _ = decontam.tokens("we met éva".encode())
    assert upper.tolist() == lower.tolist()
    long = ("word and Other 7 " * 200_000).encode()
    assert len(decontam.tokens(long)[0]) == 800_000
