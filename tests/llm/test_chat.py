from __future__ import annotations

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from firmscout.llm import chat

TEXTS = st.lists(st.sampled_from([*chat.CONTROL, "\\", "\n", "<", "[", "a", "é", "|>", "</s", "<<", "INST]"]), max_size=12).map("".join)


@given(TEXTS)
def test_escape_is_reversible_and_hides_control_strings(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROL)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), TEXTS), TEXTS), max_size=5))
def test_rendered_text_reads_back(messages):
    text, spans = chat.render(messages)
    assert chat.parse(text) == messages
    loss = [chat.unescape(text[s : s + n]) for s, n in spans]
    assert loss == [body for role, body in messages if role == "assistant"]


def test_fold():
    events = [
        ("message", "1", "user", "hi"),
        ("message", "2", "assistant", "he"),
        ("delta", "2", "assistant", "llo"),
        ("regenerate", "2", "", ""),
        ("delta", "2", "", "hey"),
        ("message", "3", "user", "what?"),
        ("edit", "3", "", "why?"),
        ("message", "4", "assistant", "so"),
        ("edit", "3", "", "how?"),
        ("delta", "5", "assistant", "new"),
        ("edit", "9", "user", "opens"),
    ]
    assert chat.fold(events) == [
        ("user", "hi"), ("assistant", "hey"), ("user", "how?"), ("assistant", "new"), ("user", "opens")
    ]


def log(spark, rows):
    schema = "conv_id long, seq long, kind string, message long, role string, text string, ignored string"
    return spark.createDataFrame([(*r, "x") for r in rows], schema).repartition(3)


def test_frame(spark):
    rows = [
        (1, 0, "message", 0, "user", "a"),
        (1, 1, None, 1, "assistant", None),
        (1, 2, "delta", 1, None, "</s>b\\"),
        (2, 0, "message", 0, None, "x"),
        (2, None, "message", 7, "assistant", "first"),
        (2, 0, "message", 0, None, "x"),
        (None, 0, "message", 0, "assistant", "lost"),
    ]
    out = chat.format_chats(log(spark, rows))
    got = {r["conv_id"]: r["formatted"] for r in out.collect()}
    assert chat.parse(got[1]) == [("user", "a"), ("assistant", "</s>b\\")]
    assert chat.parse(got[2]) == [("assistant", "first"), ("", "x"), ("", "x")]
    assert chat.parse(got[None]) == [("assistant", "lost")]
    digest = {r["conv_id"]: r for r in chat.chat_digest(out).collect()}
    assert digest[1]["loss_chars"] == 6 and digest[1]["n_turns"] == 2
    assert digest[1]["loss_sha256"] == hashlib.sha256("</s>b\\".encode()).hexdigest()
    assert digest[1]["formatted_chars"] == len(got[1])


def test_no_rows(spark):
    assert chat.chat_digest(chat.format_chats(log(spark, []))).collect() == []
