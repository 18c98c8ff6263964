"""The join against all pairs in plain Python; hot columns and odd rows."""

import random
import re

import pytest

from marginflow.llm.jaccard_join import Similarity, link_components, one_of_each


def plain(rows, n=4, percent=85):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = ({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n
                   else {tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [r.choice(words) for _ in range(30)]
    rows, i = [], 0
    for group in range(6):
        base = [r.choice(words) for _ in range(r.choice([3, 12, 40, 90]))]
        for _ in range(25):
            copy = list(base)
            for _ in range(r.randrange(4)):
                copy[r.randrange(len(copy))] = r.choice(words)
            if r.random() < 0.3:
                copy = copy + [r.choice(words) for _ in range(r.randrange(6))]
            if r.random() < 0.3:
                copy = passage + copy
            rows.append((i, " ".join(copy)))
            i += 1
    return rows + [(i, None), (i + 1, ""), (i + 2, " \n"), (i + 3, "One"), (i + 4, "one"),
                   (i + 5, "É é"), (i + 6, "a b a b a b a b a b a b"), (i + 7, "a b a b a b a")]


@pytest.mark.parametrize("few", [2, 12, 1000])
def test_equals_all_pairs(spark, few):
    rows = corpus(few)
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_components(
        docs, Similarity(few_rows=few, slots=1 << 12, most_slots=1 << 13,
                             broadcast_ids=1_000_000 if few > 2 else 7)).collect()}
    assert got == plain(rows)


def test_odd_rows(spark):
    rows = [(5, "a b c d e f", 1), (5, "a b c d e f", 1), (3, "A b c d\te f", 2), (None, "a b c", 3),
            (9, "x " * 30000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in link_components(docs).collect())
    assert got == [(3, 3, 3), (5, 3, 3), (9, 1, 9)]
    docs = docs.selectExpr("*", "1 AS copy", "2 AS node", "3 AS n")
    left = one_of_each(docs, Similarity())
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 3, 9]
    assert link_components(docs.limit(0)).count() == 0


def test_the_table_of_counts_grows_with_the_documents():
    rules = Similarity(slots=1 << 10, most_slots=1 << 14)
    assert [rules.sized(n).slots for n in (0, 100, 1000, 10**9)] == [1 << 10, 1 << 10, 1 << 12, 1 << 14]
    assert Similarity().sized(10).slots == Similarity().slots
