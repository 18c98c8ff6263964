"""Vector codes: each quarter of a vector is replaced by the index of its nearest codebook entry.

Nearest entries are found through memoised grid cells. A part falls into the cell of a coarse
grid; for a cell the least and the greatest distance from its box to every entry are known, and
an entry whose least distance exceeds the smallest greatest distance can be nearest to nothing in
the box. The entries that remain are remembered under the cell, and only they are compared exactly
with its parts. A ball around the box is tried first, for one matrix product settles it for many
cells at once; the box itself then decides over the entries that the ball leaves.

All distances are of integers and exact. The codebooks are the only thing that the driver holds:
parts x entries rows, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.sources.scratch import durable


@dataclass(frozen=True)
class Codes:
    """``parts`` of a vector, ``entries`` of each codebook and ``rounds`` of refinement.

    Components become floor(``scale`` * x), at most ``largest`` away from zero, so that distances
    of up to 1,000 components fit 64 bits. A cell is as wide as the mean deviation of the codebook over
    ``cells``. ``remembered`` cells are kept for each part and task, then the memory starts anew;
    ``block`` vectors are worked on at once. Widths and bounds never change a result.
    """

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    largest: int = 1 << 25
    cells: int = 8
    remembered: int = 1 << 15
    block: int = 2048

    def __post_init__(self):
        if not 1 <= self.entries <= 256:
            raise ValueError("an index must fit two hex digits")


def whole(vec: str = "embedding") -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    x = F.col(vec).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & ~odd, F.lit(False))


def integers(flat: np.ndarray, rules: Codes) -> np.ndarray:
    scaled = np.floor(flat.astype(np.float64) * rules.scale)
    return np.clip(scaled, -rules.largest, rules.largest).astype(np.int64)


def bounds(size: int, rules: Codes) -> list[int]:
    """Where the parts of a vector of ``size`` components begin, and its end."""
    return [size * k // rules.parts for k in range(rules.parts + 1)]


class Cells:
    """The codebook of one part and what is remembered of its grid."""

    def __init__(self, entries: np.ndarray, rules: Codes):
        self.entries, self.rules = entries, rules
        centre = entries.mean(axis=0) if entries.size else 0
        spread = np.abs(entries - centre).mean() if entries.size else 0
        self.width = max(1, int(spread / rules.cells))
        self.known: dict[bytes, np.ndarray] = {}

    def _candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """The entries that some point of each cell's box may be nearest to, in order."""
        low = cells * self.width
        high = low + self.width - 1
        middle = (low + high) / 2
        e = self.entries.astype(np.float64)
        squares = ((middle * middle).sum(1)[:, None] - 2 * (middle @ e.T) + (e * e).sum(1)[None])
        # products of large numbers are rounded: the slack is far above what they lose
        slack = 1e-9 * ((middle * middle).sum(1).max(initial=0) + (e * e).sum(1).max(initial=0))
        near = np.sqrt(np.maximum(squares - slack, 0))
        far = np.sqrt(np.maximum(squares, 0) + slack)
        radius = (self.width - 1) / 2 * np.sqrt(low.shape[1])
        cell, entry = np.nonzero(near - radius <= (far.min(axis=1) + radius)[:, None] + 1e-6)
        below = low[cell] - self.entries[entry]
        above = self.entries[entry] - high[cell]
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=1)
        greatest = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=1)
        first = np.searchsorted(cell, np.arange(len(cells)))
        smallest = np.minimum.reduceat(greatest, first)
        stays = least <= smallest[cell]  # equal ones too: ties go to the lower index
        cell, entry = cell[stays], entry[stays]
        return np.split(entry, np.searchsorted(cell, np.arange(1, len(cells))))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of every row, and how many entries
        were compared for it."""
        cells = np.ascontiguousarray(x // self.width)
        keys = [row.tobytes() for row in cells]
        new = {k: i for i, k in enumerate(keys) if k not in self.known}
        if len(self.known) + len(new) > self.rules.remembered:
            self.known = {}
            new = {k: i for i, k in enumerate(keys)}
        if new:
            self.known.update(zip(new, self._candidates(cells[list(new.values())])))
        lists = [self.known[k] for k in keys]
        counts = np.array([len(c) for c in lists])
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        entry = np.concatenate(lists)
        row = np.repeat(np.arange(len(x)), counts)
        squares = ((x[row] - self.entries[entry]) ** 2).sum(axis=1)
        best = np.minimum.reduceat(squares, first)
        hits = np.flatnonzero(squares == best[row])
        lowest = hits[np.searchsorted(row[hits], np.arange(len(x)))]
        return entry[lowest], best, counts


def _blocks(batch: pa.RecordBatch, at: int, size: int, rules: Codes):
    """(rows, integer vectors) of the vectors of ``size`` components, some at a time."""
    import pyarrow.compute  # noqa: F401

    column = batch.column(at)
    rows = np.flatnonzero(np.asarray(pa.compute.list_value_length(column)) == size)
    for i in range(0, len(rows), rules.block):
        some = rows[i:i + rules.block]
        flat = np.asarray(column.take(pa.array(some)).flatten())
        yield some, integers(flat, rules).reshape(len(some), size)


def _usable(vectors: DataFrame) -> DataFrame:
    return vectors.filter(whole()).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.col("embedding").cast("array<double>").alias("embedding"))


def first_codebooks(vectors: DataFrame, rules: Codes) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids: ``entries`` rows, a fixed bound."""
    rows = _usable(vectors).orderBy(F.asc_nulls_last("vec_id"), "embedding") \
        .limit(rules.entries).collect()
    if not rows:
        return []
    size = len(rows[0].embedding)
    x = integers(np.array([r.embedding for r in rows if len(r.embedding) == size]), rules)
    cut = bounds(size, rules)
    return [x[:, a:b] for a, b in zip(cut, cut[1:])]


def _moved(vectors: DataFrame, books: list[np.ndarray], rules: Codes) -> list[np.ndarray]:
    """Codebooks after one round: entries go to the floor of the mean of their parts."""
    size = sum(b.shape[1] for b in books)
    cut = bounds(size, rules)
    widest = max(b.shape[1] for b in books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, rules) for b in books]
        total = np.zeros((len(books), len(books[0]), widest + 1), dtype=np.int64)
        for batch in batches:
            for _, x in _blocks(batch, 0, size, rules):
                for k, (a, b) in enumerate(zip(cut, cut[1:])):
                    index, _, _ = cells[k].nearest(x[:, a:b])
                    np.add.at(total[k, :, 0], index, 1)
                    np.add.at(total[k, :, 1:b - a + 1], index, x[:, a:b])
        part, entry = np.nonzero(total[:, :, 0])
        yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)),
                               *(pa.array(total[part, entry, i]) for i in range(widest + 1))],
                              names=["part", "entry", "n", *(f"s{i}" for i in range(widest))])

    names = ["n", *(f"s{i}" for i in range(widest))]
    rows = (_usable(vectors).select("embedding")
            .mapInArrow(sums, "part int, entry int, " + ", ".join(f"{c} long" for c in names))
            .groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in names)).collect())
    out = [b.copy() for b in books]
    for r in rows:
        n, *s = r[2:]
        out[r.part][r.entry] = [v // n for v in s[:out[r.part].shape[1]]]
    return out


def learn(vectors: DataFrame, rules: Codes = Codes()) -> list[np.ndarray]:
    """One codebook for each part: integer rows, empty list where there is no usable vector.

    Refined over all vectors as long as the one with the smallest id; one pass and at most
    parts * entries rows of sums for each round. Entries without parts stay as they are.
    """
    books = first_codebooks(vectors, rules)
    if sum(b.shape[1] for b in books):
        for _ in range(rules.rounds):
            books = _moved(vectors, books, rules)
    return books


def fingerprint(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, as decimals joined by commas."""
    text = ",".join(str(v) for book in books for v in book.ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray], rules: Codes = Codes()) -> DataFrame:
    """(vec_id, label, code, error, n_compared) of ``vectors(vec_id, embedding, label)``.

    ``code``: two hex digits a part; ``error``: the squared distances to the chosen entries,
    summed; ``n_compared``: entries compared exactly. Ties go to the lower index. Vectors that are
    null or hold null or non-finite components have no row; vectors of another length than the
    codebooks have one without code, error and count. Null ids and labels stay, repeated rows give
    repeated results, other columns are ignored.
    """
    size = sum(b.shape[1] for b in books)
    cut = bounds(size, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, rules) for b in books]
        for batch in batches:
            n = batch.num_rows
            code, error = np.zeros((n, len(books)), np.uint8), np.zeros(n, np.int64)
            compared, fits = np.zeros(n, np.int64), np.zeros(n, bool)
            for rows, x in _blocks(batch, 2, size, rules) if books else ():
                fits[rows] = True
                for k, (a, b) in enumerate(zip(cut, cut[1:])):
                    index, squares, counts = cells[k].nearest(x[:, a:b])
                    code[rows, k] = index
                    error[rows] += squares
                    compared[rows] += counts
            digits = [bytes(c).hex() if ok else None for c, ok in zip(code, fits.tolist())]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(digits, pa.string()),
                                   pa.array(error, mask=~fits), pa.array(compared, mask=~fits)],
                                  names=["vec_id", "label", "code", "error", "n_compared"])

    rows = _usable(vectors)
    return rows.mapInArrow(run, f"vec_id long, label {rows.schema['label'].dataType.simpleString()},"
                                " code string, error long, n_compared long")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    books = learn(vectors)
    coded = durable(encode(vectors, books), "codes")
    # sums over labels are stored: their true size decides whether they are broadcast
    by_label = durable(coded.groupBy(F.col("label").alias("of")).agg(
        F.try_sum("error").alias("label_error")), "label-errors")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left") \
        .select("vec_id", "code", "error", "label_error",
                F.lit(fingerprint(books)).alias("codebooks_sha256"))


def _sql(rules: Codes = Codes()) -> str:
    """Plain SQL: every part against every entry, round by round."""
    def assigned(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
    SELECT p.row, p.part, p.x, arg_min(b.entry, (d.square, b.entry)) AS entry,
           min(d.square) AS square
    FROM parts p JOIN b{k} b USING (part),
         LATERAL (SELECT CAST(list_sum(list_transform(range(1, len(p.x) + 1),
                  lambda i: (p.x[i] - b.x[i]) * (p.x[i] - b.x[i]))) AS BIGINT) AS square) d
    GROUP BY p.row, p.part, p.x)"""

    def moved(k: int) -> str:
        return f"""m{k} AS (
    SELECT part, entry, list(CAST(v AS BIGINT) ORDER BY i) AS x FROM (
        SELECT part, entry, i, floor(sum(v) / count(*)) AS v FROM (
            SELECT part, entry, unnest(range(len(x))) AS i, unnest(x) AS v FROM a{k})
        GROUP BY part, entry, i)
    GROUP BY part, entry
), b{k + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
    FROM b{k} b LEFT JOIN m{k} m USING (part, entry))"""

    steps = ",\n".join(f"{assigned(k)},\n{moved(k)}" for k in range(rules.rounds))
    last = rules.rounds
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS row, vec_id, label,
           list_transform(embedding, lambda v: CAST(
               floor(CAST(v AS DOUBLE) * {rules.scale}) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), parts AS MATERIALIZED (
    SELECT row, part, x[1 + len(x) * part // {rules.parts}
                        : len(x) * (part + 1) // {rules.parts}] AS x
    FROM kept, (SELECT unnest(range({rules.parts})) AS part)
), b0 AS (
    SELECT part, row AS entry, x FROM parts WHERE row < {rules.entries}
), {steps},
{assigned(last)},
coded AS (
    SELECT row, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code,
           CAST(sum(square) AS BIGINT) AS error
    FROM a{last} GROUP BY row
), sums AS (
    SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM kept JOIN coded USING (row)
    GROUP BY label
), book AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS digest
    FROM b{last}
)
SELECT k.vec_id, c.code, c.error, s.label_error, book.digest AS codebooks_sha256
FROM kept k JOIN coded c USING (row)
     JOIN sums s ON s.label IS NOT DISTINCT FROM k.label, book
"""


OP13_SQL = _sql()
