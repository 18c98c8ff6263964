"""Repeated passages by sparse suffix arrays.

Of all suffixes of all texts only those are retained that start at a minimiser: the place whose
25-word prefix has the smallest hash among 26 neighbours. The choice depends on content alone,
and every run of 50 words holds such a place with its whole prefix, in each of its copies at the
same spot. The retained suffixes are sorted by prefix over the cluster and neighbours compared;
what equals a neighbour is extended left and right, word by word, as far as 50-word runs reach
around it, and the extended runs are sorted and compared with their neighbours in turn.

Both sorts are range-partitioned on the key and the place, so a passage that a third of all
documents share spreads over many tasks. Copies of whole documents are represented by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm.arrays import as_long, list_column, mix, ranges_hash, text_chunks, words
from marginflow.sources.scratch import durable

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Passages:
    """Runs of at least ``length`` words count. ``prefix`` words of a suffix are compared first;
    minimisers are chosen among ``length - prefix + 1`` neighbours."""

    length: int = 50
    prefix: int = 25


def _sliding(op, x: np.ndarray, size: int) -> np.ndarray:
    """``op`` over x[i:i + size] for every i, by doubling."""
    out, width = x, 1
    while width * 2 <= size:
        out = op(out[:len(out) - width], out[width:])
        width *= 2
    rest = size - width
    return op(out[:len(out) - rest], out[rest:]) if rest else out


def minimisers(hashes: np.ndarray, bounds: np.ndarray, rules: Passages):
    """Places of the retained suffixes among all words, and the hash of their prefixes."""
    n, choice = len(hashes), rules.length - rules.prefix + 1
    if n < rules.length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.arange(n - rules.prefix + 1)
    prefix = ranges_hash(hashes, first, first + rules.prefix)
    least = _sliding(np.minimum, mix(prefix, 3), choice)
    ends = np.repeat(bounds[1:], np.diff(bounds))[:len(least)]
    least[np.arange(len(least)) + rules.length > ends] = 0  # would reach into the next text
    padded = np.concatenate([np.zeros(choice - 1, np.uint64), least,
                             np.zeros(choice - 1, np.uint64)])
    reached = _sliding(np.maximum, padded, choice)
    place = np.flatnonzero((reached == mix(prefix, 3)) & (reached > 0))
    return place, prefix[place]


def _suffixes(docs: DataFrame, rules: Passages) -> DataFrame:
    """(doc_id, n, f1, f2, at, key): length and fingerprint of each text, its suffixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                w = words(chunk.data, chunk.offsets)
                place, key = minimisers(w.hash, w.bounds, rules)
                cut = np.searchsorted(place, w.bounds)
                owner = np.repeat(np.arange(chunk.count), np.diff(cut))
                f1, f2 = (ranges_hash(mix(w.hash, seed), w.bounds[:-1], w.bounds[1:])
                          for seed in (1, 2))
                yield pa.record_batch(
                    [batch.column(0).slice(chunk.first, chunk.count),
                     pa.array(np.diff(w.bounds).astype(np.int32)), pa.array(as_long(f1)),
                     pa.array(as_long(f2)),
                     list_column((place - w.bounds[owner]).astype(np.int32), cut, pa.int32()),
                     list_column(as_long(key), cut, pa.int64())],
                    names=["doc_id", "n", "f1", "f2", "at", "key"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n int, f1 long, f2 long, at array<int>, key array<long>")


def equal_neighbours(rows: DataFrame) -> DataFrame:
    """(doc_id, at, first) of the rows of ``rows(key, doc_id, at)`` whose key another row has;
    first: smallest doc_id with that key.

    Rows are sorted by key and place and compared with their neighbours. A run of equal keys may
    go on in the next partition, so the first run and the last row of each partition are
    compared once more, by key.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None         # the last row so far, whose successor is not known yet
        opening = True      # still in the first run
        last_key = last_first = None

        def out(key, doc, at, first, repeated, edge):
            keep = repeated | edge
            return pa.record_batch([pa.array(x[keep]) for x in (
                key, doc, at, first, repeated, edge)],
                names=["key", "doc_id", "at", "first", "repeated", "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, doc, at = (np.asarray(batch.column(i)) for i in range(3))
            begins = np.concatenate([[last_key is None or key[0] != last_key],
                                     key[1:] != key[:-1]])
            if last_key is not None and begins[0]:
                opening = False
            run_start = np.maximum.accumulate(np.where(begins, np.arange(len(key)), -1))
            first = np.where(run_start >= 0, doc[np.maximum(run_start, 0)],
                             last_first if last_first is not None else 0)
            starts = np.flatnonzero(begins)
            # rows before the second run of the partition
            edge = np.zeros(len(key), bool)
            if opening:
                later = starts[1:] if last_key is None else starts
                edge[:later[0] if len(later) else len(key)] = True
                opening = not len(later)
            follows = np.append(key[1:] == key[:-1], False)
            repeated = ~begins | follows
            if held is not None:
                k, d, a, f, r, e = held
                yield out(k, d, a, f, r | (not begins[0]), e)
            held = tuple(x[-1:] for x in (key, doc, at, first, repeated, edge))
            yield out(key[:-1], doc[:-1], at[:-1], first[:-1], repeated[:-1], edge[:-1])
            last_key, last_first = key[-1], first[-1]
        if held is not None:
            k, d, a, f, r, e = held
            yield out(k, d, a, f, r, np.array([True]))

    order = ("key", "doc_id", "at")
    compared = durable(
        rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            run, "key long, doc_id long, at int, first long, repeated boolean, edge boolean"),
        "neighbours")
    # at most two keys for each partition, so the broadcast is bounded
    ends = compared.filter("edge").groupBy("key").agg(F.min("first").alias("least"),
                                                      F.count("*").alias("ends"))
    return (compared.join(F.broadcast(ends), "key", "left").filter("repeated or ends > 1")
            .select("doc_id", "at", F.least("first", "least").alias("first")))


def _runs_around(docs: DataFrame, rules: Passages) -> DataFrame:
    """(doc_id, at, key): all runs of ``length`` words that hold a listed place with its prefix,
    from ``docs(doc_id, text, places)``."""
    reach = rules.length - rules.prefix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                w = words(chunk.data, chunk.offsets)
                lists = batch.column(2).slice(chunk.first, chunk.count)
                sizes = np.asarray(pa.compute.list_value_length(lists))
                owner = np.repeat(np.arange(chunk.count), sizes)
                place = np.asarray(lists.flatten()).astype(np.int64) + w.bounds[owner]
                low = np.maximum(place - reach, w.bounds[owner])
                high = np.minimum(place, w.bounds[owner + 1] - rules.length)
                fine = high >= low  # else the place belongs to another text of the same id
                cover = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(cover, low[fine], 1)
                np.add.at(cover, high[fine] + 1, -1)
                start = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
                key = ranges_hash(w.hash, start, start + rules.length)
                cut = np.searchsorted(start, w.bounds)
                of = np.repeat(np.arange(chunk.count), np.diff(cut))
                yield pa.record_batch(
                    [batch.column(0).slice(chunk.first, chunk.count),
                     list_column((start - w.bounds[of]).astype(np.int32), cut, pa.int32()),
                     list_column(as_long(key), cut, pa.int64())], names=["doc_id", "at", "key"])

    return docs.mapInArrow(run, "doc_id long, at array<int>, key array<long>")


_SPANS = "array<struct<start:int,end:int>>"


def _merged(rows: DataFrame, length: int) -> DataFrame:
    """(doc_id, spans, later) of ``rows(doc_id, runs)``: unions of runs, in order."""
    def union(starts: np.ndarray) -> list[dict]:
        if not len(starts):
            return []
        starts = np.unique(starts)
        fresh = np.flatnonzero(np.diff(starts) > length) + 1
        return [{"start": int(a), "end": int(b) + length} for a, b in zip(
            starts[np.concatenate([[0], fresh])], starts[np.append(fresh, len(starts)) - 1])]

    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, later = [], []
            for cell in batch.column(1):
                at = np.asarray(cell.values.field("at"))
                repeat = np.asarray(cell.values.field("repeat"))
                spans.append(union(at))
                later.append(union(at[repeat]))
            yield pa.record_batch([batch.column(0), pa.array(spans, kind), pa.array(later, kind)],
                                  names=["doc_id", "spans", "later"])

    return rows.mapInArrow(run, f"doc_id long, spans {_SPANS}, later {_SPANS}")


def repeated_passages(docs: DataFrame, rules: Passages = Passages()) -> DataFrame:
    """(doc_id, n_words, spans, later): one row for each document with a repeated passage.

    ``spans`` are the unions, in words from 0, of all runs of at least ``length`` words that
    occur at another place as well, in any document; ``later`` of those that a document with a
    smaller id has. Null, empty and shorter texts repeat nothing; rows without doc_id are left
    out; equal rows count once; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .filter("doc_id is not null")
    table = durable(_suffixes(docs, rules), "suffixes")
    one = table.filter(F.col("n") >= rules.length).select("doc_id", "n", "f1", "f2").distinct()
    classes = durable(one.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("doc_id"),
                                                       F.max("doc_id").alias("other")), "classes")
    kept = table.join(classes, ["doc_id", "n", "f1", "f2"], "left_semi")
    suffixes = kept.select("doc_id", F.explode(F.arrays_zip("at", "key")).alias("s")) \
        .select("s.key", "doc_id", "s.at")
    places = equal_neighbours(suffixes).groupBy("doc_id").agg(
        F.collect_set("at").alias("places"))
    around = durable(_runs_around(docs.join(places, "doc_id").select("doc_id", "text", "places"),
                                  rules), "runs")
    runs = around.select("doc_id", F.explode(F.arrays_zip("at", "key")).alias("s")) \
        .select("s.key", "doc_id", "s.at")
    found = equal_neighbours(runs).groupBy("doc_id").agg(F.collect_list(F.struct(
        "at", (F.col("first") < F.col("doc_id")).alias("repeat"))).alias("runs"))
    partial = _merged(found, rules.length)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n").alias("end")))
    none = F.expr(f"cast(array() as {_SPANS})")
    copies = one.join(classes.select("n", "f1", "f2", F.col("doc_id").alias("kept_id"), "other"),
                      ["n", "f1", "f2"])
    copied = F.col("kept_id") != F.col("other")
    return (copies.join(partial, "doc_id", "left")
            .filter(copied | F.col("spans").isNotNull())
            .select("doc_id", F.col("n").alias("n_words"),
                    F.when(copied, whole).otherwise(F.col("spans")).alias("spans"),
                    F.when(F.col("doc_id") != F.col("kept_id"), whole)
                    .otherwise(F.coalesce("later", none)).alias("later")))


def drop_repeats(docs: DataFrame, rules: Passages = Passages()) -> DataFrame:
    """``docs`` without the passages that a document with a smaller id has, whole words at a
    time, with all rows and columns."""
    later = repeated_passages(docs, rules).filter(F.size("later") > 0) \
        .select(F.col("doc_id").alias("__id"), F.col("later").alias("__later"))
    joined = docs.join(later, docs["doc_id"].cast("long") == F.col("__id"), "left").drop("__id")
    at = joined.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for cell, spans in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                text, gone = cell.as_py(), spans.as_py()
                if gone and text is not None:
                    where = [m.span() for m in _WORD.finditer(text)]
                    out, done = [], 0
                    for span in gone:
                        out.append(text[done:where[span["start"]][0]])
                        done = where[span["end"] - 1][1]
                    text = "".join(out) + text[done:]
                texts.append(text)
            yield pa.record_batch(
                [pa.array(texts, pa.string()) if i == at else batch.column(i)
                 for i in range(batch.num_columns - 1)], names=batch.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def written(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(column)

    def total(column: str):
        return F.aggregate(column, F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])

    return repeated_passages(docs).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), written("spans"),
        written("later"), total("spans").alias("n_repeated"), total("later").alias("n_later"))


def _sql(rules: Passages = Passages()) -> str:
    """The definition in plain SQL: every run of words against every other one."""
    def spans(name: str, condition: str) -> str:
        return f"""
{name}_islands AS (
    SELECT doc_id, min(pos) AS a, max(pos) + {rules.length} AS b FROM (
        SELECT doc_id, pos, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM (
            SELECT doc_id, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos)
                                         <= {rules.length} THEN 0 ELSE 1 END AS fresh
            FROM hits WHERE {condition}))
    GROUP BY doc_id, island),
{name} AS (SELECT doc_id, string_agg(a || ':' || b, ',' ORDER BY a) AS listed,
                  CAST(sum(b - a) AS BIGINT) AS total FROM {name}_islands GROUP BY doc_id)"""

    return f"""
WITH t AS (SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents WHERE doc_id IS NOT NULL),
runs AS (SELECT doc_id, pos, array_to_string(w[pos + 1 : pos + {rules.length}], ' ') AS k FROM (
    SELECT doc_id, w, unnest(range(0, len(w) - {rules.length - 1})) AS pos FROM t
    WHERE len(w) >= {rules.length})),
hits AS (SELECT * FROM (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY k) AS first,
                               count(*) OVER (PARTITION BY k) AS n FROM runs) WHERE n > 1),
{spans('every', 'true')},{spans('later', 'first < doc_id')}
SELECT e.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, e.listed AS spans,
       coalesce(l.listed, '') AS later, e.total AS n_repeated, coalesce(l.total, 0) AS n_later
FROM every e JOIN t USING (doc_id) LEFT JOIN later l USING (doc_id)
"""


OP10_SQL = _sql()
