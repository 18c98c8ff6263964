"""Periodic runs of words, by a suffix automaton with link-cut access.

The suffix links of the automaton of a word sequence form a tree; the path from the state of a
prefix to the root holds all suffixes of that prefix. Words are appended one after the other.
Each access makes the path of the new prefix one preferred path and colours it with the new end;
the pieces of older preferred paths that it runs through tell where the suffixes in them ended
last. A piece with deepest length m and last end at distance d says that the last m words stand
d words earlier as well: the last m + d words have period d. With m >= d that is a square, d is
its smallest period, and comparing words at distance d extends it to the whole run.

Most words of prose cannot lie in a run. In a run of four periods or more every three words
in a row recur within a quarter of its length, so the automaton is built over the stretches of
which that holds; no run is lost by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
          "collapsed string")
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                            ("period", pa.int64())]))
BATCH_BYTES = 1 << 22  # of texts that leave a task at once


@dataclass(frozen=True)
class Runs:
    """A run has at least ``least_words`` words and ``least_periods`` periods (four or more)."""

    least_words: int = 6
    least_periods: int = 4

    def __post_init__(self):
        if self.least_periods < 4 or self.least_words < 6:
            raise ValueError("runs of under 6 words or 4 periods are not searched for")


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(length, link) of every state of the suffix automaton, and the state of every prefix."""
    length, link, step, prefix = [0], [-1], [{}], []
    last = 0
    for word in words:
        state = len(length)
        length.append(length[last] + 1)
        link.append(0)
        step.append({})
        prefix.append(state)
        p, last = last, state
        while p >= 0 and word not in step[p]:
            step[p][word] = state
            p = link[p]
        if p < 0:
            continue
        q = step[p][word]
        if length[p] + 1 == length[q]:
            link[state] = q
            continue
        clone = len(length)
        length.append(length[p] + 1)
        link.append(link[q])
        step.append(step[q].copy())
        link[q] = link[state] = clone
        while p >= 0 and step[p].get(word) == q:
            step[p][word] = clone
            p = link[p]
    return length, link, prefix


class Paths:
    """A rooted tree cut into preferred paths, each kept in a splay tree ordered by depth.

    ``up`` is the parent in the splay tree or, at its root, the node from which the path hangs.
    Every path has one colour, kept at the root of its splay tree; -1 means never coloured.
    """

    def __init__(self, parent: list[int]):
        self.up = list(parent)
        self.left = [-1] * len(parent)
        self.right = [-1] * len(parent)
        self.colour = [-1] * len(parent)

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            y = up[x]
            if y < 0 or (left[y] != x and right[y] != x):
                return
            z = up[y]
            if z >= 0 and (left[z] == y or right[z] == y):
                # the upper edge first where both bend the same way
                same = (left[y] == x) == (left[z] == y)
                self._rotate(*((y, z) if same else (x, y)))
            self._rotate(x, up[x])

    def _rotate(self, x: int, y: int) -> None:
        """``x`` takes the place of its parent ``y``, and its colour if ``y`` was a root."""
        up, left, right = self.up, self.left, self.right
        z = up[y]
        if left[y] == x:
            moved = left[y] = right[x]
            right[x] = y
        else:
            moved = right[y] = left[x]
            left[x] = y
        if moved >= 0:
            up[moved] = y
        up[y], up[x] = x, z
        if z >= 0:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
            else:
                self.colour[x] = self.colour[y]
        else:
            self.colour[x] = self.colour[y]

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Give the path from ``node`` to the root ``colour``. Returned are its pieces before
        that, from below, as (deepest node, colour)."""
        pieces, below, x = [], -1, node
        while x >= 0:
            self._splay(x)
            old = self.colour[x]
            pieces.append((x, old))
            deeper = self.right[x]
            if deeper >= 0:
                self.colour[deeper] = old
            self.right[x] = below
            below, x = x, self.up[x]
        self.colour[below] = colour
        return pieces


def _breaks(ids: np.ndarray, period: int) -> np.ndarray:
    """Places whose word differs from the one a period later, with a mark at either end."""
    return np.concatenate([[-1], np.flatnonzero(ids[period:] != ids[:-period]),
                           [len(ids) - period]])


def runs_of(ids: np.ndarray, rules: Runs = Runs()) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``ids``, whatever stands in them."""
    length, link, prefix = automaton(ids.tolist())
    paths = Paths(link)
    found, breaks, ends = [], {}, {}
    for at, state in enumerate(prefix):
        for node, before in paths.access(state, at):
            if before < 0:
                continue
            period = at - before
            if length[node] + period < max(rules.least_words, rules.least_periods * period):
                continue
            if at < ends.get(period, 0):
                continue  # inside a run that is known
            if period not in breaks:
                breaks[period] = _breaks(ids, period)
            edge = breaks[period]
            k = int(np.searchsorted(edge, before))
            start, stop = int(edge[k - 1]) + 1, int(edge[k]) + period
            ends[period] = stop
            found.append((start, stop - start, period))
    return found


def stretches(ids: np.ndarray, rules: Runs = Runs()) -> list[tuple[int, int]]:
    """Bounds of the stretches that can hold runs.

    A run of length L and period q <= L / least_periods has at every place, as far as three
    words fit, the same three words q places on or back. Places without such a partner within
    their stretch are taken out and the rest is looked at again, until nothing changes.
    """
    n, out = len(ids), []
    if n < rules.least_words:
        return out
    size = int(ids.max()) + 1
    pairs = ids[:-1] * size + ids[1:]
    if size > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    three = pairs[:-1] * size + ids[2:]
    todo = [(0, n - 2)]
    while todo:
        a, b = todo.pop()
        if b - a + 2 < rules.least_words:
            continue
        reach = (b - a + 2) // rules.least_periods
        order = np.argsort(three[a:b], kind="stable")
        placed = three[a:b][order]
        near = (placed[1:] == placed[:-1]) & (np.diff(order) <= reach)
        partner = np.zeros(b - a + 2, dtype=bool)
        partner[order[1:][near] + 1] = True
        partner[order[:-1][near] + 1] = True
        if partner[1:-1].all():
            out.append((a, b + 2))
            continue
        edge = np.flatnonzero(partner[1:] != partner[:-1]) + a
        todo += list(zip(edge[::2].tolist(), edge[1::2].tolist()))
    return sorted(out)


def all_runs(ids: np.ndarray, rules: Runs = Runs()) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in ``ids``, by start, then period."""
    return sorted((start + a, length, period) for a, b in stretches(ids, rules)
                  for start, length, period in runs_of(ids[a:b], rules))


def _document(text: str | None, rules: Runs) -> tuple[int, list[tuple[int, int, int]], str]:
    words = (text or "").encode().split()  # bytes: at 0x20 and 0x09-0x0D and nowhere else
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    runs = all_runs(ids, rules) if len(known) < len(words) else []
    if runs:
        gone = np.zeros(len(words), dtype=bool)
        for start, length, period in runs:
            gone[start + period:start + length] = True
        words = [w for w, out in zip(words, gone.tolist()) if not out]
    return len(ids), runs, b" ".join(words).decode()


def find_runs(docs: DataFrame, rules: Runs = Runs()) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs(doc_id, text)``.

    Words are runs of characters outside 0x20 and 0x09-0x0D, compared exactly and numbered from
    0. ``runs`` are all maximal stretches with their smallest period, by start, then period;
    ``collapsed`` has the words left when each run is cut to its first period, one space between
    them. Null and empty texts have no words, no runs and an empty ``collapsed``. Null ids stay
    null, repeated rows give repeated results, other columns are ignored. A text is worked on
    alone, whatever its length; its automaton takes about a kilobyte a word of the stretches that
    can hold runs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, runs, texts, held = [], [], [], [], 0
            for i in range(batch.num_rows):
                n, found, text = _document(batch.column(1)[i].as_py(), rules)
                ids.append(batch.column(0)[i].as_py())
                counts.append(n)
                runs.append([{"start": s, "length": m, "period": q} for s, m, q in found])
                texts.append(text)
                held += len(text)
                if held >= BATCH_BYTES or i + 1 == batch.num_rows:
                    yield pa.record_batch(
                        [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()),
                         pa.array(runs, _RUNS), pa.array(texts, pa.string())],
                        names=["doc_id", "n_words", "runs", "collapsed"])
                    ids, counts, runs, texts, held = [], [], [], [], 0

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first."""
    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"]
                                       > best["length"] * run["period"]), run).otherwise(best)

    return F.reduce(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which every tenth document, by the checksum of its id, repeats the
    words from a place on with a period; both follow from that checksum. The words of such a
    document are joined by single spaces. Documents without id or words stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        place = F.struct(a.alias("a"), p.alias("p"))
        # a bound variable: the place is worked out once for all words
        return F.transform(F.array(place), lambda v: F.array_join(F.transform(
            words, lambda word, i: F.when(i < v["a"], word).otherwise(
                F.get(words, (v["a"] + (i - v["a"]) % v["p"]).cast("int")))), " "))[0]

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    changed = F.transform(F.array(words), lambda ws: F.when(
        F.size(ws) > 0, repeated(ws)).otherwise(F.col("text")))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, changed).otherwise(F.col("text"))
                       .alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    best = strongest(F.col("runs"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"], r["length"], r["period"])), "\n")
    return (find_runs(planted(docs)).withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start",
                    "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n")))
                           .otherwise(""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


#: Equal words at distance q, as far as three in a row are equal, form islands; an island and
#: the q words after it are a stretch of period q. The smallest q of a stretch is its period.
OP12_SQL = r"""
WITH hashed AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
           list_reduce(flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i:
               list_concat([CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)],
                           [-1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda c, e: CASE WHEN e >= 0 THEN xor(c, e)
                              ELSE xor(c >> 1, 3988292384 * (c & 1)) END,
               CAST(4294967295 AS BIGINT)) AS reg
    FROM documents
), summed AS (
    SELECT doc_id, ws, len(ws) AS n, xor(reg, CAST(4294967295 AS BIGINT)) AS h FROM hashed
), placed AS (
    SELECT doc_id, ws, n, h, (h // 10) % greatest(n, 1) AS a,
           1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p
    FROM summed
), changed AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
               ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws
    FROM placed
), tokens AS (
    SELECT doc_id, n, unnest(range(n)) AS i, unnest(ws) AS w FROM changed
), triples AS (
    SELECT doc_id, n, i, w AS w1, lead(w, 1) OVER d AS w2, lead(w, 2) OVER d AS w3
    FROM tokens WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q
    FROM triples x JOIN triples y ON x.doc_id = y.doc_id AND x.w1 = y.w1 AND x.w2 = y.w2
         AND x.w3 = y.w3 AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
    SELECT doc_id, q, min(i) AS s, count(*) + 2 AS m
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
    GROUP BY doc_id, q, island
), runs AS (
    SELECT doc_id, s, m + q AS len, min(q) AS q FROM islands
    WHERE m + q >= greatest(6, 4 * q) GROUP BY doc_id, s, m + q
), best AS (
    SELECT a.doc_id, a.s, a.len, a.q FROM runs a WHERE NOT EXISTS (
        SELECT 1 FROM runs b WHERE b.doc_id = a.doc_id AND (b.len * a.q > a.len * b.q
            OR b.len * a.q = a.len * b.q AND (b.s < a.s OR b.s = a.s AND b.q < a.q)))
), listed AS (
    SELECT doc_id, count(*) AS n_runs,
           string_agg(concat(s, ',', len, ',', q, chr(10)), '' ORDER BY s, q) AS text
    FROM runs GROUP BY doc_id
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs
), kept AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text
    FROM tokens ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT c.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.s AS start, b.len AS length, b.q AS period,
       1000 * b.len // b.q AS exponent_milli, sha256(coalesce(l.text, '')) AS runs_sha256,
       sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM changed c LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id)
     LEFT JOIN kept k USING (doc_id)
"""
