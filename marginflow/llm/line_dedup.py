"""Line deduplication by a deletion-neighbourhood join.

Lines are compared as sequences of lower-case words. Two lines within one edit (a word put in,
left out or replaced) become equal when one word is deleted from the longer, or the word at the
same place from both. So every line emits its variants with one word left out as hashed keys,
equal keys meet, the edit distance is verified on the words, and the earliest line stays.

Variants are only made for lines that can have a partner: an edit leaves the first or the second
half of a line as it was, so lines first meet on hashes of their halves (four keys a line).
Groups are summed up by their earliest line; members of a group never meet in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm.arrays import (
    CHUNK_BYTES,
    Rolling,
    Words,
    as_long,
    list_column,
    mix,
    ranges_hash,
    text_chunks,
    words,
)
from marginflow.sources.scratch import durable

NEWLINE = 10


@dataclass(frozen=True)
class Lines:
    """Lines of at least ``edit_words`` words may differ by one word; in shorter ones a word is
    too large a share of the content, and they must be equal."""

    edit_words: int = 8


def _line_words(data: np.ndarray, offsets: np.ndarray):
    """Words of every line of every text; which text and which line (from 1) each one is."""
    breaks = np.flatnonzero(data == NEWLINE) + 1
    counts = np.diff(np.searchsorted(breaks, offsets, side="right")) + 1
    first = np.cumsum(counts) - counts  # an empty text is one empty line
    begin = np.empty(int(counts.sum()), np.int64)
    opening = np.zeros(len(begin), bool)
    opening[first] = True
    begin[opening] = offsets[:-1]
    begin[~opening] = breaks
    owner = np.repeat(np.arange(len(counts)), counts)
    return (words(data, np.append(begin, len(data))), owner,
            np.arange(len(begin)) - first[owner] + 1)


def _line_hashes(w: Words, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each line, then those by which it meets lines of its own length and of one
    word more: its halves."""
    starts, ends, tags = [first], [last], [np.uint64(0)]
    for size in (last - first, last - first - 1):
        tag = mix(size.astype(np.uint64), 5)
        starts += [first, last - (size - size // 2)]
        ends += [first + size // 2, last]
        tags += [tag + np.uint64(1), tag + np.uint64(2)]
    every = ranges_hash(w.hash, np.concatenate(starts), np.concatenate(ends))
    whole, *halves = np.split(every, len(starts))
    second = ranges_hash(mix(w.hash, 9), first, last)
    return [whole, second, *(mix(h + tag) for h, tag in zip(halves, tags[1:]))]


def _scan(docs: DataFrame, rules: Lines) -> DataFrame:
    """(doc_id, line, n, h, g, k0..k3) of every line with words; h and g tell contents apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                w, owner, line = _line_words(chunk.data, chunk.offsets)
                n = np.diff(w.bounds)
                kept = n > 0
                first, last = w.bounds[:-1][kept], w.bounds[1:][kept]
                short = n[kept] < rules.edit_words
                h, g, *keys = _line_hashes(w, first, last)
                ids = batch.column(0).slice(chunk.first, chunk.count)
                yield pa.record_batch(
                    [ids.take(pa.array(owner[kept])), pa.array(line[kept].astype(np.int32)),
                     pa.array(n[kept].astype(np.int32)), pa.array(as_long(h)),
                     pa.array((g >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                     *(pa.array(as_long(k), mask=short) for k in keys)],
                    names=["doc_id", "line", "n", "h", "g", "k0", "k1", "k2", "k3"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, line int, n int, h long, g int, "
             "k0 long, k1 long, k2 long, k3 long")


def _variants(docs: DataFrame) -> DataFrame:
    """(doc_id, line, n, h, content, variants) of the lines listed in ``docs(doc_id, text,
    lines)``; ``h`` is the hash of the line and variant i that of the line without word i."""
    def rows(ids, numbers, cells) -> pa.RecordBatch:
        raw = [cell.encode() for cell in cells]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        w = words(np.frombuffer(b"".join(raw), np.uint8), offsets)
        rolling = Rolling(w.hash)
        hashes = rolling.ranges(w.bounds[:-1], w.bounds[1:])
        return pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()),
             pa.array(np.diff(w.bounds).astype(np.int32)), pa.array(as_long(hashes)),
             pa.array(cells, pa.string()),
             list_column(as_long(rolling.without_one(w.bounds)), w.bounds, pa.int64())],
            names=["doc_id", "line", "n", "h", "content", "variants"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, cells, size = [], [], [], 0
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py().split("\n")
                for line in batch.column(2)[k].as_py():
                    if line <= len(text):
                        ids.append(batch.column(0)[k].as_py())
                        numbers.append(line)
                        cells.append(text[line - 1])
                        size += len(cells[-1])
                if size > CHUNK_BYTES:
                    yield rows(ids, numbers, cells)
                    ids, numbers, cells, size = [], [], [], 0
            if ids:
                yield rows(ids, numbers, cells)

    return docs.mapInArrow(run, "doc_id long, line int, n int, h long, content string, "
                                "variants array<long>")


def _within_one(a, b):
    """Word sequences whose lengths differ by one at most: is their edit distance 1 or 0?"""
    split = "[\\x20\\x09-\\x0D]+"
    x, y = (F.filter(F.split(F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                         "abcdefghijklmnopqrstuvwxyz"), split),
                     lambda w: w != "") for c in (a, b))
    differ = F.array_position(F.zip_with(x, y, lambda p, q: ~p.eqNullSafe(q)), True)
    # behind the first place that differs, one word is skipped on the longer side, or on both
    rest = F.lit(1_000_000_000)
    longer = F.size(x) > F.size(y)
    shorter = F.size(x) < F.size(y)
    at = differ.cast("int")
    tail_x = F.slice(x, at + F.when(shorter, 0).otherwise(1), rest)
    tail_y = F.slice(y, at + F.when(longer, 0).otherwise(1), rest)
    return (F.abs(F.size(x) - F.size(y)) <= 1) & F.when(at == 0, True).otherwise(tail_x == tail_y)


def repeated_lines(docs: DataFrame, rules: Lines = Lines()) -> DataFrame:
    """(doc_id, line): the lines, counted from 1, that repeat an earlier one within the bound.

    Earlier is by doc_id, then line. A line is compared with the earliest line within the bound,
    whether that one stays or repeats another itself. Every line with a word counts; null and empty
    texts have none; rows without doc_id are left out; rows that repeat an id are treated alike, and a line at one place does
    not repeat itself. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text")).filter("doc_id is not null")
    lines = durable(_scan(docs, rules), "lines")
    where = F.struct("doc_id", "line")
    kinds = durable(lines.groupBy("n", "h", "g").agg(
        F.min(where).alias("first"), F.max(where).alias("last"),
        *[F.any_value(k).alias(k) for k in ("k0", "k1", "k2", "k3")]), "line_kinds")

    keys = kinds.filter("k0 is not null").select(
        "first", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key"))
    met = keys.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    chosen = (keys.join(met, "key", "left_semi").select("first.*").distinct()
              .groupBy("doc_id").agg(F.collect_list("line").alias("lines")))
    near = durable(_variants(docs.join(chosen, "doc_id").select("doc_id", "text", "lines")),
                   "near_lines")
    placed = near.select(where.alias("own"), "n", F.posexplode("variants").alias("i", "v"))
    same = placed.groupBy("n", "i", "v").agg(F.min("own").alias("other"),
                                             F.count("*").alias("kinds")).filter("kinds > 1")
    replaced = placed.join(same.drop("kinds"), ["n", "i", "v"]).select("own", "other")
    whole = near.select(where.alias("other"), (F.col("n") + 1).alias("n"), F.col("h").alias("v"))
    longer = placed.select("own", "n", "v").join(whole, ["n", "v"])
    pairs = replaced.unionByName(longer.select("own", "other")).unionByName(
        longer.select(F.col("other").alias("own"), F.col("own").alias("other")))
    earliest = pairs.filter("other < own").groupBy("own").agg(F.min("other").alias("other"))
    texts = near.select(where.alias("at"), "content")
    verified = (earliest.join(texts.select(F.col("at").alias("own"), F.col("content").alias("a")),
                              "own")
                .join(texts.select(F.col("at").alias("other"), F.col("content").alias("b")),
                      "other")
                .filter(_within_one(F.col("a"), F.col("b"))).select("own"))
    edited = verified.select(F.col("own").alias("first"), F.lit(True).alias("edited"))
    dirty = (kinds.select("n", "h", "g", "first", "last").join(edited, "first", "left")
             .filter("edited or last <> first"))
    return (lines.select("n", "h", "g", "doc_id", "line").join(dirty, ["n", "h", "g"])
            .filter(F.coalesce("edited", F.lit(False)) | (F.struct("doc_id", "line")
                                                          != F.col("first")))
            .select("doc_id", "line").distinct())


def dedup_lines(docs: DataFrame, rules: Lines = Lines()) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and ``n_lines``, ``n_removed``.

    All rows and columns stay; a null text stays null. Columns named n_lines or n_removed are
    replaced.
    """
    gone = repeated_lines(docs, rules).groupBy(F.col("doc_id").alias("__gone_id")) \
        .agg(F.collect_list("line").alias("__gone_lines"))
    joined = docs.join(gone, docs["doc_id"].cast("long") == F.col("__gone_id"), "left")
    split = F.split(docs["text"], "\n")
    left = F.array_except(F.sequence(F.lit(1), F.size(split)), F.col("__gone_lines"))
    text = F.array_join(F.transform(left, lambda i: F.get(split, i - 1)), "\n")
    return joined.withColumns({
        "text": F.when(F.col("__gone_lines").isNull(), docs["text"]).otherwise(text),
        "n_lines": F.when(docs["text"].isNull(), 0).otherwise(F.size(split)).cast("long"),
        "n_removed": F.coalesce(F.size("__gone_lines"), F.lit(0)).cast("long"),
    }).drop("__gone_id", "__gone_lines")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs)


def _sql(rules: Lines = Lines()) -> str:
    """The same in plain SQL: variants as strings."""
    return f"""
WITH parts AS (SELECT doc_id, text, string_split(text, chr(10)) AS p FROM documents),
l AS (SELECT doc_id, unnest(p) AS content, generate_subscripts(p, 1) AS line FROM parts),
w AS (SELECT doc_id, line, list_filter(regexp_split_to_array(translate(content,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
        lambda x: x <> '') AS w FROM l),
k AS (SELECT doc_id, line, len(w) AS n, w, array_to_string(w, ' ') AS h FROM w
      WHERE len(w) > 0),
f AS (SELECT h, any_value(n) AS n, any_value(w) AS w, min(doc_id * 10000000 + line) AS first
      FROM k GROUP BY h),
i AS (SELECT h, n, first, w, unnest(range(1, n + 1)) AS i FROM f WHERE n >= {rules.edit_words}),
v AS (SELECT h, n, first, i, array_to_string(list_concat(w[1 : i - 1], w[i + 1 :]), ' ') AS v
      FROM i),
m AS (SELECT n, i, v, min(first) AS other FROM v GROUP BY ALL),
e AS (SELECT v.h, m.other FROM v JOIN m USING (n, i, v)
      UNION ALL SELECT v.h, f.first FROM v JOIN f ON v.v = f.h AND f.n = v.n - 1
                WHERE f.n >= {rules.edit_words}
      UNION ALL SELECT f.h, v.first FROM v JOIN f ON v.v = f.h AND f.n = v.n - 1
                WHERE f.n >= {rules.edit_words}),
o AS (SELECT h, min(other) AS other FROM e GROUP BY h),
g AS (SELECT DISTINCT k.doc_id, k.line FROM k JOIN f USING (h) LEFT JOIN o USING (h)
      WHERE f.first <> k.doc_id * 10000000 + k.line OR o.other < f.first),
s AS (SELECT l.doc_id, l.line, l.content, g.doc_id IS NOT NULL AS gone
      FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.line = g.line),
t AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
             coalesce(string_agg(content, chr(10) ORDER BY line) FILTER (WHERE NOT gone), '')
             AS text FROM s GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE t.text END AS text,
       CASE WHEN d.text IS NULL THEN 0 ELSE t.n_lines END AS n_lines,
       coalesce(t.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN t USING (doc_id)
"""


OP9_SQL = _sql()
