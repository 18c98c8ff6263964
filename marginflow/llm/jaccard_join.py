"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are rows and word n-grams columns of an incidence matrix A; A times its transpose
counts the n-grams two documents share. Only the part of the product that can reach the
threshold is computed:

* Equal rows are one class; its smallest document stands for it.
* Columns are ordered from rare to common and cut, row by row, into a head and a tail block. Two
  rows that reach the threshold share a column of both heads (the head of a row of n columns has
  n - ceil(t * n) + 1), so only the head blocks are multiplied with each other by a join.
* At a shared column the overlap is at most what is left of either row. Pairs whose sizes or
  places keep them below the size-derived bound are discarded inside the join.
* For the pairs that are left, the overlap is counted over whole rows.

Which rows belong together needs no pair twice: a column with many rows first compares all of
them with one row, and afterwards only rows that still lie in different components.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm.arrays import Words, as_long, list_column, mix, ranges_hash, text_chunks, words
from marginflow.llm.graph import components
from marginflow.sources.scratch import discard, durable


@dataclass(frozen=True)
class Similarity:
    """Jaccard of at least ``percent`` / 100 on runs of ``n`` words. ``few_rows``: a column with
    up to so many rows multiplies all of them at once. ``slots``: size of the table of column
    counts (one byte a slot is broadcast); it grows with the documents up to ``most_slots``.
    ``broadcast_ids``: so many ids of documents to be compared are broadcast at a time (8 bytes
    each), in as many passes as that takes, so that texts always stay where they are."""

    n: int = 4
    percent: int = 85
    few_rows: int = 12
    slots: int = 1 << 22
    most_slots: int = 1 << 24
    broadcast_ids: int = 1_000_000

    def sized(self, documents: int) -> Similarity:
        """With four slots a document, within the bounds."""
        wanted = 1 << (4 * documents).bit_length()
        return replace(self, slots=min(max(self.slots, wanted), max(self.slots, self.most_slots)))


BLOCK = 1 << 16


def shingle_sets(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted, and their bounds. A text with fewer words
    than n has its whole sequence as the only one; a text without words has none."""
    _, hashes = w.windows(n)
    sizes = np.diff(w.bounds)
    windows = np.maximum(sizes - n + 1, 0)
    short = (sizes > 0) & (windows == 0)
    counts = windows + short
    owner = np.repeat(np.arange(len(sizes)), counts)
    values = np.empty(int(counts.sum()), np.uint64)
    is_short = short[owner]
    values[~is_short] = hashes
    begin = w.bounds[:-1][short]
    values[is_short] = ranges_hash(w.hash, begin, begin + sizes[short])
    order = np.lexsort((values, owner))
    values = values[order]  # owner is sorted already
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    bounds = np.searchsorted(owner[new], np.arange(len(sizes) + 1))
    return values[new], bounds


def _chunks(batch: pa.RecordBatch, n: int):
    for chunk in text_chunks(batch.column(1)):
        sets, bounds = shingle_sets(words(chunk.data, chunk.offsets), n)
        yield batch.column(0).slice(chunk.first, chunk.count), sets, bounds


def column_levels(docs: DataFrame, rules: Similarity) -> np.ndarray:
    """Binary logarithm of how many documents hold the columns of each slot.

    All documents count. Every task sums up its own table of ``slots`` counters and hands it on
    in blocks; blocks are added as they stream in. The counts only order the columns: two that
    share a slot make the join slower, never wrong.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(rules.slots, np.uint32)
        for batch in batches:
            for _, sets, _ in _chunks(batch, rules.n):
                counts += np.bincount((sets % np.uint64(rules.slots)).astype(np.int64),
                                      minlength=rules.slots).astype(np.uint32)
        parts = counts.reshape(-1, min(BLOCK, rules.slots))
        held = [i for i, part in enumerate(parts) if part.any()]
        yield pa.record_batch([pa.array(held, pa.int32()), pa.array(
            [zlib.compress(_narrow(parts[i]), 1) for i in held], pa.binary())],
            names=["block", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = _wide(zlib.decompress(raw.as_py()))
                sums[block] = sums[block] + part if block in sums else part.astype(np.uint64)
        yield pa.record_batch([pa.array(sums.keys(), pa.int32()), pa.array(
            [np.floor(np.log2(s + np.uint64(1))).astype(np.uint8).tobytes()
             for s in sums.values()], pa.binary())], names=["block", "levels"])

    levels = np.zeros(rules.slots, np.uint8)
    size = min(BLOCK, rules.slots)
    rows = (docs.select(F.lit(0).alias("x"), "text").mapInArrow(partial, "block int, counts binary")
            .repartition("block").mapInArrow(total, "block int, levels binary").collect())
    for row in rows:  # a fixed number of blocks, ``slots`` bytes together
        levels[row.block * size:(row.block + 1) * size] = np.frombuffer(row.levels, np.uint8)
    return levels


def _narrow(counts: np.ndarray) -> bytes:
    kind = np.uint8 if counts.max() < 256 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8 if raw[0] == 1 else np.uint32, offset=1)


def heads(docs: DataFrame, rules: Similarity) -> DataFrame:
    """(doc_id, n, f1, f2, head): size of each row, fingerprint of its content, and its rarest
    columns in order."""
    levels = docs.sparkSession.sparkContext.broadcast(column_levels(docs, rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            for ids, sets, bounds in _chunks(batch, rules.n):
                n = np.diff(bounds)
                owner = np.repeat(np.arange(len(n)), n)
                rank = level[(sets % np.uint64(rules.slots)).astype(np.int64)]
                # sets are sorted by hash within a text, so a stable sort by rank is the order
                order = np.argsort(owner * 64 + rank, kind="stable")
                length = np.where(n > 0, n - -(-n * rules.percent // 100) + 1, 0)
                place = np.arange(len(sets)) - bounds[owner]
                inside = place < length[owner]
                f1, f2 = (np.zeros(len(n), np.uint64) for _ in range(2))
                for out, seed in ((f1, 1), (f2, 2)):
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets, seed))])
                    out[:] = sums[bounds[1:]] - sums[bounds[:-1]]
                yield pa.record_batch(
                    [ids, pa.array(n.astype(np.int32)), pa.array(as_long(f1)),
                     pa.array(as_long(f2)),
                     list_column(as_long(sets[order][inside]),
                                 np.concatenate([[0], np.cumsum(length)]), pa.int64())],
                    names=["doc_id", "n", "f1", "f2", "head"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n int, f1 long, f2 long, head array<long>")


def whole_rows(docs: DataFrame, rules: Similarity) -> DataFrame:
    """(doc_id, row): all columns of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets, bounds in _chunks(batch, rules.n):
                yield pa.record_batch([ids, list_column(as_long(sets), bounds, pa.int64())],
                                      names=["doc_id", "row"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, row array<long>")


def _reaches(rules: Similarity, overlap: Column, na: str, nb: str) -> Column:
    """100 * overlap >= percent * union, in whole numbers."""
    return overlap * (100 + rules.percent) >= rules.percent * (F.col(na) + F.col(nb))


def _possible(rules: Similarity) -> Column:
    """At a column the two rows share first, no more than the rest of either can be shared."""
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return _reaches(rules, rest, "na", "nb")


def _row(side: str) -> list[Column]:
    return [F.col("doc_id").alias(side), F.col("n").alias(f"n{side}"),
            F.col("place").alias(f"p{side}")]


def _verified(pairs: DataFrame, docs: DataFrame, rules: Similarity) -> DataFrame:
    """The pairs (a, b) that reach the threshold, by counting over whole rows, stored. The rows
    are deleted again."""
    pairs = durable(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "pairs")
    needed = pairs.select(F.col("a").alias("doc_id")).unionByName(
        pairs.select(F.col("b").alias("doc_id"))).distinct()
    needed = durable(needed, "needed")
    passes = max(1, -(-needed.count() // rules.broadcast_ids))
    of_pass = F.pmod(F.xxhash64("doc_id"), F.lit(passes))
    rows = durable(reduce(DataFrame.unionByName, [
        whole_rows(docs.join(F.broadcast(needed.filter(of_pass == i)), "doc_id", "left_semi"),
                   rules) for i in range(passes)]), "rows")
    overlap = F.size(F.array_intersect("row_a", "row_b"))
    found = durable(
        pairs.join(rows.select(F.col("doc_id").alias("a"), F.col("row").alias("row_a")), "a")
        .join(rows.select(F.col("doc_id").alias("b"), F.col("row").alias("row_b")), "b")
        .select("a", "b", overlap.alias("overlap"), F.size("row_a").alias("na"),
                F.size("row_b").alias("nb"))
        .filter(_reaches(rules, F.col("overlap"), "na", "nb")).select("a", "b"), "verified")
    discard(pairs, needed, rows)
    return found


def link_components(docs: DataFrame, rules: Similarity = Similarity()) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per distinct document id.

    Two documents link when their Jaccard similarity reaches the threshold; component_id is the
    smallest doc_id reachable. Null and empty texts have no n-grams and link with nothing.
    Rows without doc_id are left out; equal rows count once; of several texts under one id the
    one with the smallest fingerprint stands for it. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .filter("doc_id is not null")
    rules = rules.sized(docs.count())
    table = durable(heads(docs, rules), "heads")
    one = table.groupBy("doc_id").agg(F.min(F.struct("n", "f1", "f2")).alias("c")) \
        .select("doc_id", "c.*")
    classes = durable(one.filter("n > 0").groupBy("n", "f1", "f2")
                      .agg(F.min("doc_id").alias("doc_id")), "classes")
    rows = table.join(classes, ["doc_id", "n", "f1", "f2"], "left_semi")
    cells = rows.select("doc_id", "n", F.posexplode("head").alias("place", "column"))
    shared = cells.groupBy("column").agg(F.count("*").alias("rows")).filter("rows > 1")
    block = durable(cells.join(shared, "column"), "block")

    def sized(a: DataFrame, b: DataFrame, more: Column) -> DataFrame:
        both = a.join(b, "column")
        return both.filter((F.col("a") != F.col("b")) & more & _possible(rules))

    few = block.filter(F.col("rows") <= rules.few_rows)
    many = block.filter(F.col("rows") > rules.few_rows)
    all_pairs = sized(few.select("column", *_row("a")), few.select("column", *_row("b")),
                      F.col("a") < F.col("b")).select("a", "b")
    centre = many.groupBy("column").agg(F.min(F.struct("place", "n", "doc_id")).alias("c")) \
        .select("column", "c.*")
    stars = sized(centre.select("column", *_row("a")), many.select("column", *_row("b")),
                  F.lit(True)).select("a", "b")
    links = _verified(all_pairs.unionByName(stars), docs, rules)
    first = durable(components(links), "components")

    # rows of a long column that are not yet where its centre is meet the whole column
    known = many.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
        .withColumn("component", F.coalesce("component", "doc_id"))
    known = durable(known, "long_columns")
    home = known.join(centre.select("column", F.col("doc_id").alias("centre")), "column") \
        .filter("doc_id = centre").select("column", F.col("component").alias("home"))
    apart = known.join(home, "column").filter("component <> home")
    left = apart.select("column", *_row("a"), F.col("component").alias("ca"))
    right = known.select("column", *_row("b"), F.col("component").alias("cb"))
    rest = sized(left, right, F.col("ca") != F.col("cb")).select("a", "b")
    more = _verified(rest, docs, rules)
    discard(block, known)
    final = components(links.unionByName(more)) if not more.isEmpty() else first
    return (one.join(classes.select("n", "f1", "f2", F.col("doc_id").alias("node")),
                     ["n", "f1", "f2"], "left")
            .join(final, "node", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.coalesce("component", "node", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, rules: Similarity) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component, with all columns.
    Rows without doc_id are kept."""
    gone = link_components(docs, rules).filter("doc_id <> component_id") \
        .select(F.col("doc_id").alias("copy"))
    return docs.join(gone, docs["doc_id"].cast("long") == gone["copy"], "left_anti")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql(rules: Similarity = Similarity()) -> str:
    """All pairs that share any n-gram, counted, and a recursive closure."""
    words_of = ("list_filter(regexp_split_to_array(translate(coalesce(text, ''), "
                "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                "'[\\x20\\x09-\\x0D]+'), lambda w: w <> '')")
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {words_of} AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {rules.n}
        THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i : i + {rules.n - 1}], ' ')
             FOR i IN range(1, len(w) - {rules.n} + 2)]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
      FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * i >= {rules.percent} * (na.n + nb.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(d.doc_id, coalesce(c.m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


OP2_SQL = _sql()
