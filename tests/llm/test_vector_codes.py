"""Vector codes: cells against all entries, whole training in plain Python, SQL, odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marginflow.llm.vector_codes import OP13_SQL, Cells, Codes, encode, fingerprint, learn, \
    op13_vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 3, 16]),
       st.sampled_from([0, 1, 20, 3000, 10**7]), st.integers(1, 60))
def test_cells_find_the_nearest(seed, width, spread, n_entries):
    r = np.random.default_rng(seed)
    entries = r.integers(-spread, spread + 1, (n_entries, width))
    x = np.concatenate([r.integers(-spread, spread + 1, (50, width)), entries,
                        r.integers(-4 * spread, 4 * spread + 1, (20, width))])
    cells = Cells(entries, Codes(remembered=40))
    for _ in range(2):  # the second time from memory
        index, squares, counts = cells.nearest(x)
        every = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == every.argmin(axis=1)).all() and (squares == every.min(axis=1)).all()
        assert (counts >= 1).all() and (counts <= n_entries).all()


def test_cells_leave_most_entries_out():
    r = np.random.default_rng(1)
    entries, x = (np.floor(r.normal(size=(n, 16)) * 128).astype(int) for n in (256, 500))
    cells = Cells(entries, Codes())
    _, _, counts = cells.nearest(x)
    assert counts.mean() < 16 and len(cells.known) <= 500
    cells.nearest(x[:1] // cells.width * cells.width)  # another point of a known cell
    assert len(cells.known) <= 500


def plain(rows, entries, rounds, parts=4):
    """(codes, errors, codebooks) with every part compared with every entry."""
    kept = sorted(((i, v) for i, v in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [[math.floor(1024 * c) for c in v] for _, v in kept]
    size = len(x[0])
    cut = [size * k // parts for k in range(parts + 1)]
    books = [[v[a:b] for v in x[:entries]] for a, b in zip(cut, cut[1:])]

    def assigned(k):
        out = []
        for v in x:
            own = v[cut[k]:cut[k + 1]]
            squares = [sum((p - q) ** 2 for p, q in zip(own, e)) for e in books[k]]
            out.append((squares.index(min(squares)), min(squares)))
        return out

    for _ in range(rounds):
        for k in range(parts):
            groups = {}
            for v, (i, _) in zip(x, assigned(k)):
                groups.setdefault(i, []).append(v[cut[k]:cut[k + 1]])
            for i, members in groups.items():
                books[k][i] = [sum(c) // len(members) for c in zip(*members)]
    last = [assigned(k) for k in range(parts)]
    codes = ["".join(f"{last[k][i][0]:02x}" for k in range(parts)) for i in range(len(x))]
    errors = [sum(last[k][i][1] for k in range(parts)) for i in range(len(x))]
    return [i for i, _ in kept], codes, errors, books


def test_training_equals_plain(spark):
    r = random.Random(3)
    centres = [[r.gauss(0, .1) for _ in range(10)] for _ in range(6)]
    rows = [(i, [float(np.float32(c + r.gauss(0, .03))) for c in r.choice(centres)], i % 3)
            for i in r.sample(range(500), 200)]
    rules = Codes(entries=12, rounds=3)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(5)
    books = learn(vectors, rules)
    ids, codes, errors, expected = plain([(i, v) for i, v, _ in rows], 12, 3)
    assert [b.tolist() for b in books] == expected
    text = ",".join(str(c) for b in expected for e in b for c in e)
    assert fingerprint(books) == hashlib.sha256(text.encode()).hexdigest()
    out = {x.vec_id: (x.code, x.error) for x in encode(vectors, books, rules).collect()}
    assert out == {i: (c, e) for i, c, e in zip(ids, codes, errors)}


def test_query_equals_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    r = random.Random(4)
    rows = [(i, [float(np.float32(r.gauss(0, .1))) for _ in range(8)], r.choice([1, 2, None]))
            for i in range(400)]
    rows += [(900, None, 1), (901, [0.1, float("nan")] * 4, 1), (902, [None] * 8, 2),
             (903, [float("inf")] * 8, 2), (904, [0.0] * 8, None), (905, rows[0][1], 2)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = op13_vector_codes(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    sql = con.execute(OP13_SQL)
    names = [d[0] for d in sql.description]
    assert sorted(tuple(x[c] for c in names) for x in out.collect()) == sorted(sql.fetchall())
    assert out.count() == 402


def test_odd_rows(spark):
    rows = [(1, [0.5, -0.25, 0.0, 1.0], "a"), (1, [0.5, -0.25, 0.0, 1.0], "a"), (None, [1e30] * 4, None),
            (3, [1.0], "a"), (4, [], "b"), (5, [-1e30] * 4, "b")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string") \
        .selectExpr("*", "1 AS code", "2 AS error")
    books = learn(vectors)
    assert len(books) == 4 and books[0].tolist()[:2] == [[512], [512]]
    out = sorted(((x.vec_id or 0, x.code, x.error) for x in encode(vectors, books).collect()))
    # other lengths have no code; equal entries: the first; sizes end at the bound
    assert out == [(0, "03030303", 0), (1, "00000000", 0), (1, "00000000", 0), (3, None, None),
                   (4, None, None), (5, "02020202", 0)]
    empty = vectors.limit(0)
    assert learn(empty) == [] and encode(empty, []).count() == 0
    assert {x.code for x in encode(vectors, []).collect()} == {None}
    with pytest.raises(ValueError):
        Codes(entries=257)
