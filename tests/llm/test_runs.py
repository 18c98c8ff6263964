"""Runs by automaton and link-cut access: against all periods of all places, a naive recolouring,
the planted documents in Python, odd rows."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marginflow.llm.runs import (Paths, Runs, all_runs, automaton, find_runs, planted, runs_of,
                                 stretches, strongest)


def plain_runs(words, least=6, periods=4):
    """Every period at every place, each stretch with its smallest period only."""
    n, found = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, periods * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted((s, m, q) for (s, m), q in found.items())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5),
                          st.integers(1, 9)), max_size=6))
def test_equals_plain(parts):
    words = [w for unit, times in parts for w in unit * times]
    ids = np.array(words, dtype=np.int64)
    assert all_runs(ids) == plain_runs(words)
    assert sorted(runs_of(ids)) == plain_runs(words)  # the stretches lose nothing
    wider = Runs(least_words=9, least_periods=5)
    assert all_runs(ids, wider) == plain_runs(words, 9, 5)


def test_access_recolours_like_a_walk():
    r = random.Random(5)
    words = [r.randrange(3) for _ in range(300)]
    length, link, prefix = automaton(words)
    assert all(length[link[v]] < length[v] for v in range(1, len(link)))
    paths, last = Paths(link), [-1] * len(link)
    for at, state in enumerate(prefix):
        walk, x = [], state
        while x >= 0:  # pieces of equal colour on the way up, by their deepest node
            if not walk or last[x] != walk[-1][1]:
                walk.append((x, last[x]))
            last[x], x = at, link[x]
        pieces = paths.access(state, at)
        merged = [p for i, p in enumerate(pieces) if i == 0 or p[1] != pieces[i - 1][1]]
        assert merged == walk


def test_long_periods_and_prose():
    r = random.Random(2)
    unit = [r.randrange(1000) for _ in range(4000)]
    assert all_runs(np.array(unit * 5)) == [(0, 20000, 4000)]
    prose = np.array([r.randrange(30) for _ in range(5000)])
    assert sum(b - a for a, b in stretches(prose)) < 500 and all_runs(prose) == plain_runs(prose)
    with pytest.raises(ValueError):
        Runs(least_periods=3)


def changed(doc_id, text):
    h = zlib.crc32(str(doc_id).encode())
    words = text.split()
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_planted_documents(spark):
    r = random.Random(8)
    rows = [(i, " ".join(f"w{r.randrange(40)}" for _ in range(r.randrange(0, 200))))
            for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = find_runs(planted(docs))
    for row in out.collect():
        words = changed(row.doc_id, dict(rows)[row.doc_id])
        runs = plain_runs(words)
        assert [tuple(x) for x in row.runs] == runs and row.n_words == len(words)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        assert row.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, " \t\n ", 5), (None, "a " * 6, 5), (4, "x y " * 30000, 5),
            (4, "x y " * 30000, 5), (5, "a b " * 6, 5), (6, "A a " * 3, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    out = {}
    for row in find_runs(docs).collect():
        out.setdefault(row.doc_id, []).append(([tuple(r) for r in row.runs], row.collapsed))
    assert out[1] == out[2] == out[3] == [([], "")]
    assert out[None] == [([(0, 6, 1)], "a")]
    assert out[4] == [([(0, 60000, 2)], "x y")] * 2
    assert out[5] == [([(0, 6, 1)], "a b")]  # no separator outside ASCII
    assert out[6] == [([], "A a A a A a")]  # three periods only
    assert find_runs(docs.limit(0)).count() == 0
    assert planted(docs).filter("doc_id is null").first().text == "a " * 6


def test_strongest_run(spark):
    rows = spark.createDataFrame(
        [(1, [(0, 8, 2), (9, 12, 3), (30, 4, 1)]), (2, [(5, 9, 2), (7, 9, 2)]), (3, [])],
        "i int, runs array<struct<start:long,length:long,period:long>>")
    out = {r.i: r.best and tuple(r.best) for r in rows.select(
        "i", strongest(rows["runs"]).alias("best")).collect()}
    assert out == {1: (0, 8, 2), 2: (5, 9, 2), 3: None}
