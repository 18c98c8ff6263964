"""Text quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage is encoded from its words and runs of
three characters, each hashed to a learned embedding, and from a few counts; a gated attention
weighs the passages, and the weighted representation gives the score. Embeddings, attention and
output are learned together from document labels.

The model is fitted with numpy on a bounded sample of labelled documents; all passages of all
documents are scored inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm.arrays import list_column, mix, text_chunks, words
from marginflow.llm.langid import held_out

PASSAGE = 64  # words
_CLASSES = ("upper", "lower", "digit", "stop", "symbol", "newline", "wide")


def _class_table() -> np.ndarray:
    table = np.full(256, -1, np.int8)
    for name, chars in (("upper", range(65, 91)), ("lower", range(97, 123)),
                        ("digit", range(48, 58)), ("stop", b".,;:!?'\"-()"),
                        ("symbol", b"#$%&*+/<=>@[\\]^_`{|}~"), ("newline", b"\n"),
                        ("wide", range(128, 256))):
        table[list(chars)] = _CLASSES.index(name)
    return table


_CLASS = _class_table()
N_COUNTS = len(_CLASSES) + 9
BUCKETS = 256  # words share the first half, runs of characters the second
N_FEATURES = N_COUNTS + BUCKETS


@dataclass(frozen=True)
class Attention:
    """``fit_documents``: at most so many labelled documents are learned from, the first in a
    hash order of their ids, and of each at most ``fit_passages`` passages, evenly spread.
    Scoring always takes every passage."""

    fit_documents: int = 4000
    fit_passages: int = 64
    hidden: int = 16
    epochs: int = 25
    batch: int = 64
    rate: float = 0.01
    decay: float = 1e-4
    threshold: float = 0.3


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of several texts, and the bounds of each text among them. A text
    without words is one passage of zeros.

    After the counts come hashed words and runs of three bytes: how often each bucket is hit, half of
    the hits counting down, divided by the length of each half. Times the first weights of the encoder
    that is the mean of the embeddings of what the passage holds.
    """
    w = words(data, offsets)
    n = np.diff(w.bounds)
    per_text = np.maximum(-(-n // PASSAGE), 1)
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    owner = np.repeat(np.arange(len(n)), per_text)
    turn = np.arange(bounds[-1]) - bounds[owner]
    first = w.bounds[owner] + turn * PASSAGE
    last = np.minimum(first + PASSAGE, w.bounds[owner + 1])
    size = last - first
    held = size > 0
    start = np.append(w.start, len(data))[first]
    is_last = turn == per_text[owner] - 1
    stop = np.where(is_last, offsets[owner + 1], np.append(w.start, len(data))[last])
    start, stop = np.where(held, start, 0), np.where(held, stop, 0)
    out = np.zeros((len(owner), N_FEATURES), np.float32)
    kinds = _CLASS[data]
    chars = np.maximum(stop - start, 1)
    for i in range(len(_CLASSES)):
        sums = np.concatenate([[0], np.cumsum(kinds == i)])
        out[:, i] = (sums[stop] - sums[start]) / chars
    # words of each passage side by side
    place = np.minimum(first[:, None] + np.arange(PASSAGE), max(len(w.hash) - 1, 0))
    real = np.arange(PASSAGE) < size[:, None]
    many = np.maximum(size, 1)
    if len(w.hash):
        length = (w.end - w.start).astype(np.float32)[place] * real
        mean = length.sum(1) / many
        spread = np.sqrt(np.maximum((length ** 2).sum(1) / many - mean ** 2, 0))
        hashes = w.hash[place]
        again = ((hashes[:, 1:] == hashes[:, :-1]) & real[:, 1:]).sum(1) / many
        filler = np.arange(PASSAGE, dtype=np.uint64)  # pads are told apart from words and pads
        ordered = np.sort(np.where(real, hashes, filler), axis=1)
        distinct = 1 + (ordered[:, 1:] != ordered[:, :-1]).sum(1) - (PASSAGE - size)
        final = data[w.end - 1][place]
        ends = ((final == ord(".")) & real).sum(1) / many
        long_words = ((length > 20) & real).sum(1) / many
        tail = ((_CLASS[final] == _CLASSES.index("symbol")) & real).sum(1) / many
        bang = ((final == ord("!")) & real).sum(1) / many
        out[:, len(_CLASSES):N_COUNTS] = np.stack([np.log1p(mean), np.log1p(spread), again, distinct / many, ends,
                               long_words, tail, bang, np.log1p(size) / 5], axis=1)
        out[:, N_COUNTS:] = _hashed(w.hash, first, last, data, start, stop)
        out[~held] = 0
    return out, bounds


def _hashed(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, data: np.ndarray,
            start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    low = data.astype(np.uint64)
    runs = mix(low[:-2] * np.uint64(65536) + low[1:-1] * np.uint64(256) + low[2:], 4) \
        if len(low) > 2 else np.zeros(0, np.uint64)
    half, parts = BUCKETS // 2, []
    for values, a, b in ((mix(hashes, 6), first, last),
                         (runs, start, np.maximum(np.minimum(stop, len(data)) - 2, start))):
        size = np.maximum(b - a, 0)
        owner = np.repeat(np.arange(len(a)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)
        chosen = values[at]
        sign = np.where(chosen >> np.uint64(63), 1.0, -1.0)
        counts = np.bincount(owner * half + (chosen % np.uint64(half)).astype(np.int64), sign,
                             minlength=len(a) * half).reshape(len(a), half)
        norm = np.sqrt((counts ** 2).sum(axis=1, keepdims=True))
        parts.append(counts / np.maximum(norm, 1))
    return np.concatenate(parts, axis=1).astype(np.float32)


@dataclass
class Model:
    """Parameters of encoder (w1, b1), gates (v, u, a), output (c), and feature scaling."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def score(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bounds) - 1, self.constant)
        return forward(self.weights, (features - self.mean) / self.scale, bounds)["score"]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(p: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray) -> dict:
    """Scores of bags; bag i holds the rows bounds[i]:bounds[i + 1], at least one."""
    starts, sizes = bounds[:-1], np.diff(bounds)
    h = np.tanh(x @ p["w1"] + p["b1"])
    t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
    e = (t * g) @ p["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    weight = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(h * weight[:, None], starts)
    score = _sigmoid(z @ p["c"] + p["c0"])
    return {"h": h, "t": t, "g": g, "weight": weight, "z": z, "score": score}


def gradients(p: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray,
              label: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss."""
    f, sizes = forward(p, x, bounds), np.diff(bounds)
    d_out = (f["score"] - label) / len(label)
    d_z = np.repeat(np.outer(d_out, p["c"]), sizes, axis=0)
    by_weight = (d_z * f["h"]).sum(1)
    mean = np.repeat(np.add.reduceat(by_weight * f["weight"], bounds[:-1]), sizes)
    d_e = f["weight"] * (by_weight - mean)
    d_t = np.outer(d_e, p["a"]) * f["g"] * (1 - f["t"] ** 2)
    d_g = np.outer(d_e, p["a"]) * f["t"] * f["g"] * (1 - f["g"])
    d_h = d_z * f["weight"][:, None] + d_t @ p["v"].T + d_g @ p["u"].T
    d_in = d_h * (1 - f["h"] ** 2)
    return {"w1": x.T @ d_in, "b1": d_in.sum(0), "v": f["h"].T @ d_t, "u": f["h"].T @ d_g,
            "a": (f["t"] * f["g"]).T @ d_e, "c": f["z"].T @ d_out, "c0": d_out.sum()}


def fit(bags: list[np.ndarray], labels: np.ndarray, rules: Attention = Attention()) -> Model:
    """Adam on shuffled batches; the seed is fixed. One kind of label only: its prior."""
    if len(labels) == 0 or labels.min() == labels.max():
        prior = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), {}, float(prior))
    rng = np.random.default_rng(11)
    every = np.concatenate(bags)
    mean, scale = every.mean(0), every.std(0) + 1e-3
    mean[N_COUNTS:] = 0  # buckets keep their common measure: rare ones are not blown up
    scale[N_COUNTS:] = np.sqrt((every[:, N_COUNTS:] ** 2).mean()) + 1e-3
    bags = [((b - mean) / scale).astype(np.float32) for b in bags]
    size, hidden = every.shape[1], rules.hidden
    p = {"w1": rng.normal(0, size ** -0.5, (size, hidden)), "b1": np.zeros(hidden),
         "v": rng.normal(0, hidden ** -0.5, (hidden, hidden)),
         "u": rng.normal(0, hidden ** -0.5, (hidden, hidden)),
         "a": rng.normal(0, hidden ** -0.5, hidden), "c": rng.normal(0, hidden ** -0.5, hidden),
         "c0": np.zeros(())}
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(rules.epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), rules.batch):
            chosen = order[lo:lo + rules.batch]
            part = [bags[i] for i in chosen]
            bounds = np.concatenate([[0], np.cumsum([len(b) for b in part])])
            grads = gradients(p, np.concatenate(part), bounds, labels[chosen])
            step += 1
            for k, g in grads.items():
                g = g + rules.decay * p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = p[k] - rules.rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, p)


def learn(docs: DataFrame, labels: DataFrame, rules: Attention = Attention()) -> Model:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, quality)``; null labels and ids are
    ignored, of several labels of one document the smallest counts."""
    sample = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
              .filter("quality in (0, 1) and doc_id is not null")
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.fit_documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                x, bounds = passages(chunk.data, chunk.offsets)
                rows, cut = [], [0]
                for a, b in zip(bounds[:-1], bounds[1:]):
                    at = np.arange(a, b)
                    if len(at) > rules.fit_passages:
                        at = a + np.linspace(0, b - a - 1, rules.fit_passages).astype(int)
                    rows.append(x[at])
                    cut.append(cut[-1] + len(at) * N_FEATURES)
                yield pa.record_batch(
                    [batch.column(0).slice(chunk.first, chunk.count),
                     batch.column(2).slice(chunk.first, chunk.count),
                     list_column(np.concatenate(rows).ravel(), np.array(cut), pa.float32())],
                    names=["doc_id", "quality", "bag"])

    taught = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # fit_documents rows
              .select("doc_id", "text", "quality")
              .mapInArrow(run, "doc_id long, quality int, bag array<float>").toPandas())
    taught = taught.sort_values("doc_id", kind="stable")
    bags = [np.asarray(b, np.float32).reshape(-1, N_FEATURES) for b in taught["bag"]]
    return fit(bags, taught["quality"].to_numpy(np.float64), rules)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs``: the probability of label 1 from all passages
    of the whole text. Null and empty texts are one empty passage; repeated rows give repeated
    results; ids may be null; other columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                x, bounds = passages(chunk.data, chunk.offsets)
                yield pa.record_batch([batch.column(0).slice(chunk.first, chunk.count),
                                       pa.array(model.score(x, bounds))],
                                      names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, score double")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = Attention()
    model = learn(docs, labels.filter(~held_out()), rules)
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= rules.threshold).cast("int").alias("predicted"))
