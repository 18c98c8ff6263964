"""Links and components against all pairs; saturated groups, odd vectors."""

import numpy as np
import pytest

from marginflow.llm import nn_descent
from marginflow.llm.nn_descent import Descent, linked, search
from marginflow.sources import files, scratch


def plain(rows, threshold=0.93):
    units = {}
    for i, v, label in rows:
        if v is None or label is None or not len(v) or any(
                x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v) / np.abs(v).max()
        units[i] = (label, v / np.linalg.norm(v))
    parent = {i: i for i, _, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    count = dict.fromkeys(parent, 0)
    ids = sorted(units)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            (la, x), (lb, y) = units[a], units[b]
            if la == lb and len(x) == len(y) and x @ y >= threshold:
                count[a] += 1
                count[b] += 1
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {i: (count[i], root(i), root(i) == i) for i in parent}


def test_equals_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = []

    def add(v, label):
        rows.append((len(rows), None if v is None else [float(x) for x in v], label))

    for label in (0, 1):
        for size in (1, 2, 5, 40):  # the largest overfills its lists and its first blocks
            centre = rng.normal(size=16)
            for _ in range(size):
                add(centre + rng.normal(size=16) * 0.05, label)
        for _ in range(60):
            add(rng.normal(size=16), label)
    add(rows[10][1], rows[10][2]), add(rows[10][1], rows[10][2])  # equal vectors
    add(rows[10][1], 1 - rows[10][2]), add(rows[10][1], None)
    add(None, 0), add([], 0), add([0.0] * 16, 0), add([float("nan")] + [1.0] * 15, 0)
    add([float("inf")] + [1.0] * 15, 0), add([1e300] * 16, 0), add([1e-300] * 16, 0)
    add([1.0] * 8, 0), add([1.0] * 8, 0)
    rows.append((len(rows), [None] + [1.0] * 15, 0))
    data = [(*r, "x") for r in rows] + [(3, rows[3][1], rows[3][2], "x"), (None, [1.0], 0, "x")]
    vectors = spark.createDataFrame(
        data, "vec_id long, embedding array<double>, label int, component_id string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in linked(vectors, Descent(neighbours=6, block=16)).collect()}
    want = plain(rows)
    assert {i: (want[i], got.get(i)) for i in want if want[i] != got.get(i)} == {}
    assert set(got) == set(want)
    assert linked(vectors.limit(0)).count() == 0


def planted(n, dims, pairs, seed):
    """n random vectors of one label, of which some pairs are close; and their true link counts."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    half = n // 2
    for k in range(pairs):
        other = x[half + k] - (x[half + k] @ x[k]) * x[k]
        cosine = rng.uniform(0.935, 0.96)
        x[half + k] = cosine * x[k] + np.sqrt(1 - cosine ** 2) * other / np.linalg.norm(other)
    s = np.triu(x @ x.T, 1) >= 0.93
    return x, s.sum(0) + s.sum(1)


@pytest.mark.parametrize("pairs", [0, 40, 400])
def test_the_descent_finds_few_and_many_pairs(spark, monkeypatch, pairs):
    """The result is the descent's, whether all vectors, some or none of the linked are asked."""
    x, links = planted(1500, 32, pairs, 5)
    vectors = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)],
                                    "vec_id long, embedding array<double>, label int")
    calls = []
    descend = nn_descent._descend
    monkeypatch.setattr(nn_descent, "_descend", lambda *a: calls.append(1) or descend(*a))
    monkeypatch.setattr(nn_descent, "QUERIES", 256)
    for rules in (Descent(), Descent(codes=1, audit=16, queries=256)):
        calls.clear()
        rows, audit = search(vectors, rules)
        got = {r.vec_id: r.n_links for r in rows.collect()}
        assert calls and audit.attempts >= 1
        assert all(got[i] <= k for i, k in enumerate(links))  # none below the threshold
        assert sum(got.values()) >= (1.0 if audit.complete else 0.9) * links.sum()
        assert audit.asked <= rules.queries + 100 or audit.complete
        if not pairs:
            assert audit.recall is None and audit.seen == 0
        elif audit.complete:
            assert audit.recall == 1.0 and audit.seen == (links > 0).sum()
        if not audit.complete and audit.seen < rules.least_seen:
            assert audit.attempts >= rules.blind_attempts


def test_rounds_leave_no_tables_behind(spark):
    """Graphs, codes and components of past rounds are deleted."""
    x, _ = planted(600, 16, 30, 7)
    vectors = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)],
                                    "vec_id long, embedding array<double>, label int")
    folder = scratch.application_folder(spark)
    before = set(files.names(spark, folder))
    linked(vectors, Descent(codes=1, neighbours=2)).collect()
    left = [n.rsplit("-", 1)[0] for n in set(files.names(spark, folder)) - before]
    assert left.count("graph") == 1 and left.count("codes") <= 1 and left.count("components") == 1


def test_a_large_group_is_counted_in_blocks(spark, monkeypatch):
    """A group that holds a third of all vectors, compared some members at a time."""
    monkeypatch.setattr(nn_descent, "QUERIES", 16)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.05).tolist(), 0) for i in range(150)]
    rows += [(150 + i, rng.normal(size=16).tolist(), 0) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in linked(vectors).collect()}
    assert got == plain(rows)
