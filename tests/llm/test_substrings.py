from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGES, documents, prose

from firmscout.llm import substrings
from firmscout.llm.hashing import mix

PASSAGE = prose("shared", 20)


def brute(rows):
    """doc -> (bytes, removed, spans, digest), by a set of all strings of smaller documents."""
    seen, out = {}, []
    for doc, text in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, r[0] or 0)):
        key, data = (float("inf") if doc is None else doc), text.encode()
        gone = [False] * len(data)
        for i in range(len(data) - 49):
            if seen.setdefault(data[i : i + 50], key) < key:
                gone[i : i + 50] = [True] * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **kwargs):
    return sorted(map(tuple, substrings.report(documents(spark, rows, **kwargs)).collect()), key=repr)


def corpus():
    long = prose("long", 2000)
    rows = [(i, prose(i, 40) + PASSAGE + prose(-i - 1, 40)) for i in range(12)]
    rows += [(20, prose(3, 200)), (21, prose(3, 200)), (22, prose(3, 200)[7:400]), (23, "ab" * 200), (24, "ab" * 90)]
    rows += [(30, long), (31, "é" * 120 + PASSAGE), (32, "xé" + "é" * 120), (33, "a" * 50), (34, "a" * 49), (35, "a" * 51)]
    rows += [(36, "\0" * 60 + "\x01" * 60), (37, "\0" * 55), (7, long[:900]), (40, long[500:9000])]
    return [*rows, *EDGES]


def test_equals_brute_force(spark):
    rows = corpus()
    assert found(spark, rows) == brute(rows)


def test_many_buckets_long_texts_and_common_anchors(spark, monkeypatch):
    """Texts cut into parts, many buckets, several indexes, and anchors that are chosen last."""
    rows = corpus()
    monkeypatch.setattr(substrings, "CHUNK", 700)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(substrings, "INDEX_SYMBOLS", 500)
    keys = substrings.anchors(np.frombuffer((PASSAGE + prose(3, 200)).encode(), dtype=np.uint8))
    common = np.sort((keys >> np.uint64(1)) & ~substrings._POSITION)[::2]
    monkeypatch.setattr(substrings, "common_anchors", lambda docs: common)
    assert found(spark, rows, extra=True) == brute(rows)


def test_common_anchors_are_found(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 0)
    rows = [(i, prose(i, 20) + PASSAGE) for i in range(3000)]
    common = substrings.common_anchors(documents(spark, rows))
    text = np.frombuffer(PASSAGE.encode(), dtype=np.uint8)
    inside = set(((substrings.anchors(text) >> np.uint64(1)) & ~substrings._POSITION).tolist())
    assert len(common) > 0 and set(common.tolist()) & inside


def test_index_finds_the_smallest_document():
    texts = [PASSAGE.encode()[a:b] for a, b in ((0, 80), (10, 84), (3, 60), (40, 100), (0, 50))] + [bytes(range(80))]
    docs = np.array([5, 3, 9, 1, 7, 2])
    body = np.frombuffer(b"".join(texts), dtype=np.uint8)
    index = substrings.RunIndex(body, np.array([len(t) for t in texts]), docs)
    got = {(int(t), int(p)): int(d) for ts, ps, ds in index.smallest() for t, p, d in zip(ts, ps, ds)}
    want = {}
    for i, text in enumerate(texts):
        for p in range(len(text) - 49):
            want[i, p] = min(int(d) for t, d in zip(texts, docs) if text[p : p + 50] in t)
    assert got == want
    assert len(index.heads) < len(body)


def test_stage_cuts_texts_and_keeps_columns(spark):
    rows = [(1, PASSAGE), (2, prose(1) + PASSAGE), (3, PASSAGE), (4, "é" * 60), (5, "xé" + "é" * 60), *EDGES]
    docs = documents(spark, rows, extra=True)
    out = substrings.cut_repeats(docs)
    assert out.columns == docs.columns
    got = {r[0]: (r[1], r[4]) for r in out.collect()}
    assert 3 not in got and got[1] == (PASSAGE, len(PASSAGE))
    assert got[2][1] == len(got[2][0]) < len(prose(1)) + 5
    assert got[900] == (None, None) and got[902][0] == " \n\t "


@pytest.mark.parametrize("extra", [False, True])
def test_no_rows(spark, extra):
    assert found(spark, [], extra=extra) == []


def test_mix_is_a_bijection_on_a_sample():
    assert len(np.unique(mix(np.arange(100_000, dtype=np.uint64)))) == 100_000


def _group(*pieces):
    """A bucket's payload: (document, bytes) pieces with one anchor and, as forced here, one hash."""
    n = len(pieces)
    columns = [
        np.array([len(b) for _, b in pieces], np.uint8),
        np.array([5] + [0] * (n - 1), np.uint64),
        np.zeros(n, np.uint32),
        np.ones(n, np.int32),
        np.array([d for d, _ in pieces], np.int64),
        np.zeros(n, np.int64),
        np.frombuffer(b"".join(b for _, b in pieces), np.uint8),
    ]
    return pa.table({"bucket": [0], "payload": [substrings._pack(*columns)]})


def _covered(*pieces):
    out = {}
    for payload in substrings._match(_group(*pieces), 1).column("payload").to_pylist():
        ids, start, size = substrings._unpack(payload, np.int64, np.int64, np.uint8)
        out |= dict(zip(ids.tolist(), zip((start >> 24).tolist(), size.tolist())))
    return out


def test_equal_hashes_of_other_bytes_cover_nothing():
    anchor = b"twenty bytes, shared"
    one, other = anchor + b"x" * 60, anchor + b"y" * 60
    assert _covered((1, one), (2, other)) == {}
    assert _covered((1, one), (2, one)) == {2: (0, 80)}
    assert _covered((1, one), (2, other), (3, one)) == {3: (0, 80)}
    assert _covered((1, other), (2, one), (3, other), (4, one), (5, anchor + b"z" * 60)) == {3: (0, 80), 4: (0, 80)}


def _block(rows):
    return pa.table({"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.string())})


def test_a_block_sends_a_bucket_one_message(monkeypatch):
    """However many parts its texts are looked at in; bytes that differ stay apart also where hashes are equal."""
    none, buckets = np.zeros(0, dtype=np.uint64), 3
    rows = [(i, prose(i, 60) + PASSAGE) for i in range(30)] + [(40, prose(1, 300)), (41, prose(1, 300))]
    monkeypatch.setattr(substrings, "CHUNK", 700)
    for same in (substrings._hashed, lambda text, first, length: np.zeros(len(first), dtype=np.uint64)):
        monkeypatch.setattr(substrings, "_hashed", same)
        asked = substrings._ask(_block(rows), 0, buckets, none).to_pylist()
        answers = [substrings._answer(pa.Table.from_pylist([m])) for m in asked]
        sent = substrings._send(_block(rows), pa.concat_tables(answers), buckets, none)
        names = sent.column("bucket").to_pylist()
        assert len(names) == buckets and sorted(names) == sorted(m["bucket"] for m in asked) == sorted(set(names))
        spans = pa.concat_tables([substrings._match(sent.slice(i, 1), 1) for i in range(len(names))])
        cut = substrings._cut_block(_block(rows), spans, 1, 0).to_pylist()
        got = [(r["doc_id"], r["_n_bytes"], r["_n_removed"], r["_n_spans"], hashlib.sha256(r["_kept"]).hexdigest()) for r in cut]
        assert sorted(got, key=repr) == brute(rows)


def test_marks_and_orders():
    places = np.array([0, 3, 63, 64, 130, 191])
    assert substrings.Marks(places, 192).upto(np.arange(192)).tolist() == [int((places <= i).sum()) for i in range(192)]
    keys = np.array([5, 1, 5, 0, 1, 5], dtype=np.uint64)
    for bits in (3, 64):
        ordered, order = substrings._sorted(keys, bits)
        assert ordered.tolist() == [0, 1, 1, 5, 5, 5] and order.tolist() == [3, 1, 4, 0, 2, 5]


def test_blocks_and_buckets_are_far_fewer_than_megabytes():
    """What travels between them is a message for every pair."""
    assert substrings.BUCKET_BYTES >= 8 << 20 and substrings.BLOCK_BUCKETS * substrings.BUCKET_BYTES >= 16 << 20
