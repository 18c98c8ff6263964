"""Repeated passages against all windows in plain Python."""

import random
import re
from collections import defaultdict

import pytest

from marginflow.llm.suffix_dedup import Passages, drop_repeats, repeated_passages


def union(places):
    out = []
    for x in sorted(places):
        if out and out[-1][1] == x:
            out[-1][1] = x + 1
        else:
            out.append([x, x + 1])
    return [tuple(x) for x in out]


def plain(rows, length):
    places = defaultdict(set)
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        for p in range(len(w) - length + 1):
            places[tuple(w[p:p + length])].add((i, p))
    spans, later = defaultdict(set), defaultdict(set)
    for found in places.values():
        if len(found) > 1:
            first = min(found)[0]
            for i, p in found:
                spans[i].update(range(p, p + length))
                if i != first:
                    later[i].update(range(p, p + length))
    return {i: (union(spans[i]), union(later.get(i, ()))) for i in spans}


def corpus(seed, length):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    passages = [[r.choice(words) for _ in range(r.randrange(length - 3, 3 * length))]
                for _ in range(8)]
    rows = []
    for i in range(120):
        text = [r.choice(words) for _ in range(r.randrange(length))]
        for _ in range(r.randrange(4)):
            p = list(r.choice(passages))
            if r.random() < 0.3:
                p[r.randrange(len(p))] = "changed"
            text += p + [r.choice(words) for _ in range(r.randrange(4))]
        if r.random() < 0.1:
            text += ["x"] * (3 * length)
        rows.append((i, "  ".join(text)))
    return rows + [(200 + i, rows[5][1]) for i in range(3)]


@pytest.mark.parametrize("length,prefix", [(50, 25), (12, 5), (8, 8)])
def test_equals_all_windows(spark, length, prefix):
    rows = corpus(length, length)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: ([tuple(s) for s in r.spans], [tuple(s) for s in r.later])
           for r in repeated_passages(docs, Passages(length, prefix)).collect()}
    assert got == plain(rows, length)


def test_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"a {passage} b", 1), (2, f"c\n{passage.upper()}\nd", 2), (None, passage, 3), (4, None, 4),
            (5, "", 5), (6, passage, 6), (6, passage, 6), (7, "z " * 20000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = {r.doc_id: ([tuple(s) for s in r.spans], [tuple(s) for s in r.later])
           for r in repeated_passages(docs).collect()}
    assert got == {1: ([(1, 61)], []), 2: ([(1, 61)], [(1, 61)]), 6: ([(0, 60)], [(0, 60)]),
                   7: ([(0, 20000)], [])}
    left = drop_repeats(docs)
    assert left.columns == docs.columns
    texts = {(r.doc_id, r.spans): r.text for r in left.collect()}
    assert texts[(1, 1)] == rows[0][1] and texts[(2, 2)] == "c\n\nd" and texts[(6, 6)] == ""
    assert texts[(4, 4)] is None and texts[(None, 3)] == passage and len(texts) == 7
    assert repeated_passages(docs.limit(0)).count() == 0
