import random

import pytest

from marginflow.llm.graph import components


def plain(links):
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in parent}


@pytest.mark.parametrize("links", [
    [], [(1, 1), (None, 2)], [(i, i + 1) for i in range(40)], [(7, i) for i in range(60)],
    [(random.Random(i).randrange(300), random.Random(-i).randrange(300)) for i in range(1, 200)],
    [(3, 2), (2, 3), (9, 8), (-5, 8)]])
def test_components(spark, links):
    frame = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.component for r in components(frame).collect()} == plain(links)
