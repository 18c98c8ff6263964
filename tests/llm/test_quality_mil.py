"""Gradients against finite differences, passages against plain counts, held-out accuracy."""

import random

import numpy as np

from marginflow.llm import quality_mil as q
from marginflow.llm.langid import held_out


def packed(texts):
    raw = [t.encode() for t in texts]
    return (np.frombuffer(b"".join(raw), np.uint8),
            np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))


def test_passages_cover_whole_texts():
    texts = ["", "a" * 3, " ".join(["Word"] * 200), "x. " * 65, "\n\n"]
    x, bounds = q.passages(*packed(texts))
    assert np.diff(bounds).tolist() == [1, 1, 4, 2, 1]
    assert not x[0].any() and not x[-1].any()
    assert np.isclose(x[bounds[2]][0], 64 / 320) and np.isclose(x[bounds[2], 10], 1 / 64)
    alone = [q.passages(*packed([t]))[0] for t in texts]
    assert np.allclose(np.concatenate(alone), x)


def test_hashed_parts_equal_plain_counts():
    """Words and runs of three bytes of each passage, by a loop over them."""
    texts = ["the river the garden", "ab", "", " ".join(f"w{i % 90}" for i in range(150)), "é ü. x"]
    data, offsets = packed(texts)
    x, bounds = q.passages(data, offsets)
    half = q.BUCKETS // 2

    def bucket(value, seed):
        h = int(q.mix(np.array([value], np.uint64), seed)[0])
        return h % half, 1 if h >> 63 else -1

    w = q.words(data, offsets)
    for i in range(len(texts)):
        for k, row in enumerate(x[bounds[i]:bounds[i + 1]]):
            own = np.arange(w.bounds[i] + 64 * k, min(w.bounds[i] + 64 * (k + 1), w.bounds[i + 1]))
            counts = np.zeros(q.BUCKETS)
            if len(own):
                for h in w.hash[own]:
                    at, sign = bucket(h, 6)
                    counts[at] += sign
                stop = offsets[i + 1] if own[-1] + 1 == w.bounds[i + 1] else w.start[own[-1] + 1]
                for c in range(w.start[own[0]], stop - 2):
                    at, sign = bucket(int(data[c]) * 65536 + int(data[c + 1]) * 256 + int(data[c + 2]), 4)
                    counts[half + at] += sign
            for part in (slice(0, half), slice(half, None)):
                counts[part] /= max(np.sqrt((counts[part] ** 2).sum()), 1)
            assert np.allclose(row[q.N_COUNTS:], counts, atol=1e-6)


def test_repeated_rows_and_words_alone_decide(spark):
    """Labels that only the vocabulary tells; rows that repeat score alike."""
    r = random.Random(8)
    kinds = (["garden", "flower", "summer", "meadow"], ["garage", "flavor", "simmer", "mellow"])
    rows = [(i, " ".join(r.choice(kinds[i % 2]) for _ in range(r.randrange(20, 150)))) for i in range(400)]
    docs = spark.createDataFrame(rows + rows[:5] + rows[:5], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] * 2, "doc_id long, quality int")
    model = q.learn(docs, labels.filter(~held_out()))
    out = q.score(docs, model).withColumn("held_out", held_out()).collect()
    unseen = [x for x in out if x.held_out]
    assert len(out) == 410 and sum((x.score >= 0.5) == x.doc_id % 2 for x in unseen) >= 0.97 * len(unseen)
    for i in range(5):
        assert len({x.score for x in out if x.doc_id == i}) == 1


def test_gradients():
    rng = np.random.default_rng(0)
    size, hidden = 5, 4
    p = {"w1": rng.normal(size=(size, hidden)), "b1": rng.normal(size=hidden),
         "v": rng.normal(size=(hidden, hidden)), "u": rng.normal(size=(hidden, hidden)),
         "a": rng.normal(size=hidden), "c": rng.normal(size=hidden), "c0": np.array(0.3)}
    x, bounds, label = rng.normal(size=(9, size)), np.array([0, 1, 5, 9]), np.array([1., 0., 1.])

    def loss(p):
        s = q.forward(p, x, bounds)["score"]
        return -np.mean(label * np.log(s) + (1 - label) * np.log(1 - s))

    grads = q.gradients(p, x, bounds, label)
    for k in p:
        for at in np.ndindex(p[k].shape):
            up, down = {**p, k: p[k].copy()}, {**p, k: p[k].copy()}
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            assert np.isclose(grads[k][at], (loss(up) - loss(down)) / 2e-5, atol=1e-6)


def test_learns_and_handles_odd_rows(spark):
    r = random.Random(5)
    good = lambda: " ".join(r.choice(["the", "river", "runs", "by.", "A", "house"])
                            for _ in range(r.randrange(5, 300)))
    junk = lambda: " ".join(r.choice(["!!", "BUY", "##", "$$$"])
                            for _ in range(r.randrange(5, 300)))
    rows = [(i, (junk if i % 4 == 0 else good)(), 0.0) for i in range(300)]
    odd = [(1000, None, 0.0), (1001, "", 0.0), (None, "text", 0.0), (1002, "x " * 30000, 0.0)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(300)]
                                   + [(None, 1), (5, None), (7, 1)], "doc_id long, quality int")
    model = q.learn(docs, labels.filter(~held_out()))
    out = q.score(docs, model).withColumn("held_out", held_out()).collect()
    assert len(out) == 304 and all(0 <= x.score <= 1 for x in out)
    unseen = [x for x in out if x.held_out and x.doc_id is not None and x.doc_id < 300]
    assert unseen and all((x.score >= 0.5) == (x.doc_id % 4 != 0) for x in unseen)
    assert q.score(docs.limit(0), model).count() == 0
    flat = q.learn(docs, labels.limit(0))
    assert q.score(docs, flat).select("score").distinct().count() == 1
