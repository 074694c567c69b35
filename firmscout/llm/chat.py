"""Chat formatting: event logs folded into final messages, then rendered with a loss mask.

A log has one row per event: ``conv_id``, ``seq``, ``kind``, ``message``, ``role``, ``text``.

* ``message`` opens a message with the id ``message``;
* ``delta`` appends text to the latest message with that id (it opens one if there is none);
* ``edit`` replaces the text of that message and drops what was said after it;
* ``regenerate`` drops that message and what was said after it, and opens it anew.

Events are shuffled by conversation, sorted by sequence within partitions and folded as a stream, so a task holds one
conversation at a time. A conversation is one output text, and therefore has to fit into one cell.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import picked

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# Strings that common chat templates treat as control tokens.
CONTROL = (
    "<|im_start|>",
    "<|im_end|>",
    "<|endoftext|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
)
# A backslash goes behind the first character of every control string, and before every backslash.
_STARTS = re.compile("|".join(rf"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(OPEN) + r"((?:[^\\\n]|\\.)*)\n(.*?)" + re.escape(CLOSE), re.DOTALL)

FORMATTED = "conv_id long, formatted string, loss_spans array<struct<start: long, length: long>>"
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    """Text in which no control string occurs; :func:`unescape` gives the text back."""
    return _STARTS.sub(r"\g<0>\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def fold(events: Iterable[tuple]) -> list[tuple[str, str]]:
    """Final (role, text) messages of one conversation's sorted (kind, message, role, text) events."""
    messages: list[list] = []  # id, role, parts
    for kind, message, role, text in events:
        at = next((i for i in range(len(messages) - 1, -1, -1) if messages[i][0] == message), None)
        if kind == "delta" and at is not None:
            messages[at][2].append(text)
        elif kind == "edit" and at is not None:
            messages[at][2] = [text]
            del messages[at + 1 :]
        elif kind == "regenerate" and at is not None:
            role = role or messages[at][1]
            del messages[at:]
            messages.append([message, role, [text]])
        else:
            messages.append([message, role, [text]])
    return [(role, "".join(parts)) for _, role, parts in messages]


def render(messages: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The training text of a conversation and the (start, length) spans of it that bear loss."""
    out, at, spans = [], 0, []
    for role, text in messages:
        head, body = OPEN + escape(role).replace("\n", "\\\n") + "\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), len(body)))
        piece = head + body + CLOSE
        out.append(piece)
        at += len(piece)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendered conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def format_chats(log: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans``.

    Other columns are ignored. Null roles and texts are empty, a null kind is ``message``; events without
    conversation id form one conversation with id null; equal ``seq`` are ordered by role, then text; repeated rows
    are events of their own. An empty log gives no rows.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    kind = F.coalesce("kind", F.lit("message")).alias("kind")
    events = picked(log, "conv_id", "seq", "kind", "message", "role", "text").select(F.col("conv_id").cast("long"), "seq", kind, F.col("message"), text("role"), text("text"))
    events = events.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, done = None, [], []

        def flush() -> None:
            if held:
                done.append((now, *render(fold(held))))
                held.clear()

        for batch in batches:
            ids = [None if pd.isna(x) else int(x) for x in batch["conv_id"]]
            for conv, *event in zip(ids, batch["kind"], batch["message"], batch["role"], batch["text"]):
                if conv != now:
                    flush()
                now = conv
                held.append(event)
            if done:
                yield frame(done)
                done = []
        flush()
        if done:
            yield frame(done)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        ids = pd.array([r[0] for r in rows], dtype="Int64")
        spans = [[{"start": s, "length": n} for s, n in r[2]] for r in rows]
        return pd.DataFrame({"conv_id": ids, "formatted": [r[1] for r in rows], "loss_spans": spans})

    return events.mapInPandas(run, FORMATTED)


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from their text and loss spans."""
    sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv, text, spans in zip(batch["conv_id"], batch["formatted"], batch["loss_spans"]):
                turns = parse(text)
                loss = "".join(unescape(text[s["start"] : s["start"] + s["length"]]) for s in spans)
                said = sha("".join(f"{role}\n{body}\n" for role, body in turns))
                conv = None if pd.isna(conv) else int(conv)
                rows.append((conv, len(turns), said, len(loss), sha(loss), len(text)))
            names = [c.split()[0] for c in DIGEST.split(", ")]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"conv_id": "Int64"})

    return formatted.mapInPandas(run, DIGEST)
