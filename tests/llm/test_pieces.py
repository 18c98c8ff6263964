"""Unigram segmentation against a plain dynamic programme, and exact round trips."""

import functools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marginflow.llm import pieces

pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def run(vocabulary, texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, bounds = pieces.encode_texts(vocabulary, data, offsets)
    back, where = pieces.decode_ids(vocabulary, ids, bounds)
    lists = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    return lists, [bytes(back[a:b]).decode() for a, b in zip(where[:-1], where[1:])]


@functools.cache
def table_of(path=pieces.MODEL):
    vocabulary = pieces.load(path)
    raw = set(vocabulary.byte_id.tolist())
    return {bytes(vocabulary.content[a:b]): i for i, (a, b) in enumerate(
        zip(vocabulary.bounds[:-1], vocabulary.bounds[1:])) if b > a and i not in raw}


def plain(vocabulary, text):
    """The whole text at once, without cutting it into words."""
    if not text:
        return []
    table = table_of()
    chars = [c.encode() for c in " " + text]
    best = [(-np.inf, None)] * (len(chars) + 1)
    best[0] = (0.0, None)
    for i in range(len(chars)):
        joined = b""
        for j in range(i, min(i + 17, len(chars))):
            joined += chars[j]
            if joined in table:
                score = best[i][0] + vocabulary.score[table[joined]]
            elif j == i:
                score = best[i][0] + vocabulary.unknown
            else:
                continue
            if score > best[j + 1][0]:
                best[j + 1] = (score, i)
    out, at = [], len(chars)
    while at:
        start = best[at][1]
        joined = b"".join(chars[start:at])
        out[:0] = [table[joined]] if joined in table else \
            [int(vocabulary.byte_id[b]) for b in joined]
        at = start
    return out


CASES = ["", " ", "   ", "hello world", "Hello  wörld\n\ttab ▁x ", "▁", "日本語のテキスト です", "a" * 700,
         "naïve😀 café\r\n", "\u0000x", "x" * 95 + " " + "y" * 97, "the the the"]


def test_equals_plain_segmentation(vocabulary):
    lists, back = run(vocabulary, CASES)
    assert back == CASES
    assert lists == [plain(vocabulary, t) for t in CASES]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text_comes_back(vocabulary, texts):
    lists, back = run(vocabulary, texts)
    assert back == texts
    for ids, text in zip(lists, texts):
        assert ids == plain(vocabulary, text)


def test_queries_handle_odd_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "y"), (None, "", None), (3, "é" * 3000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = pieces.encode(docs)
    assert sorted(out.columns) == sorted(["doc_id", "ids", "n_pieces", "n_bytes", "round_trip"])
    got = out.collect()
    assert len(got) == 5 and all(r.round_trip for r in got)
    texts = {(r.doc_id, r.text) for r in pieces.decode(out).collect()}
    assert texts == {(1, "a b"), (2, ""), (None, ""), (3, "é" * 3000)}
    assert pieces.encode(docs.limit(0)).count() == 0
