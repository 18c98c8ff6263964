"""Near-duplicate vectors by NN-descent.

Every vector keeps a list of its nearest neighbours so far. A first graph comes from comparing
vectors inside small blocks of equal random-hyperplane codes; then neighbours of neighbours are
compared, round by round, until few lists change. Links are the listed pairs whose cosine, in
double precision, reaches the threshold.

A list that is full of links is saturated: there may be more than it holds. All members of a
saturated group (vectors connected by links) are then compared with the whole group, some of
them at a time, which enlarges their lists to the full number of partners without writing the
pairs down or moving the group's vectors.

Recall is audited against brute force on query vectors: as many as it takes to see a stated number
with true links, and at most a stated number. The audit only judges. Below the target the descent
goes on with lists twice as long and twice as many new codes, from the lists it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginflow.llm.graph import components
from marginflow.sources.scratch import discard, durable


@dataclass(frozen=True)
class Descent:
    """``neighbours``: length of a list. ``block``: vectors compared at once in a first block,
    ``codes``: how many times that is done with other hyperplanes. A pivot's block holds its own
    list and at most ``2 * neighbours`` vectors that list it, chosen anew each round; this only
    steers the search. ``audit`` query vectors with true links measure recall, ``target`` is what
    they must reach; where all vectors could be asked, none may be missed. No more than ``queries``
    vectors are asked. If fewer than ``least_seen`` of them have links, the audit says little, and
    ``blind_attempts`` are made. ``rows_per_task`` bounds what a Python task holds."""

    threshold: float = 0.93
    neighbours: int = 8
    block: int = 48
    codes: int = 4
    rounds: int = 4
    least_change: float = 0.02
    audit: int = 256
    target: float = 0.97
    queries: int = 8192
    least_seen: int = 32
    blind_attempts: int = 2
    rows_per_task: int = 20_000


@dataclass(frozen=True)
class Audit:
    """How well the links were found: vectors asked, those with true links, recall on them (None
    where there are none: of all vectors at most about 3 / ``asked`` have links, with 95 %
    confidence), and whether every vector was asked."""

    asked: int
    seen: int
    recall: float | None
    complete: bool
    attempts: int


QUERIES = 1024  # about so many query vectors are asked at first, four times as many at most
SLACK = 0.005  # lists hold single-precision cosines; what comes this close is computed in double


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """Unit vectors of a list column with equal lengths."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow below
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(kind)


def prepared(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal vectors (u, grp, embedding, copies) and their members (vec_id, u).

    grp tells apart labels and lengths: only vectors of one grp are compared. Null labels, null
    or empty vectors, zero vectors and those with null or non-finite components have no class.
    """
    vec = F.col("embedding")
    usable = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size(vec) > 0)
              & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
              & F.exists(vec, lambda x: x != 0))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("embedding"), "label")
            .filter(F.coalesce(usable, F.lit(False)))
            .withColumn("grp", F.xxhash64("label", F.size("embedding"))))
    keyed = durable(rows.withColumn("f", F.xxhash64("embedding", F.lit(1)))
                    .withColumn("f2", F.xxhash64(F.lit(2), "embedding")), "vectors")
    found = keyed.groupBy("grp", "f", "f2").agg(
        F.min("vec_id").alias("u"), F.countDistinct("vec_id").alias("copies"))
    members = keyed.join(found.drop("copies"), ["grp", "f", "f2"]).select("vec_id", "u").distinct()
    nodes = (keyed.join(found.withColumnRenamed("u", "vec_id"), ["grp", "f", "f2", "vec_id"])
             .dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("u"), "grp", "embedding",
                                                "copies"))
    return durable(nodes, "nodes"), durable(members, "members")


def _coded(nodes: DataFrame, sets: int, attempt: int) -> DataFrame:
    """nodes with one 24-bit code for each of ``sets`` sets of hyperplanes, new in each attempt."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, sets), np.int32)
            size = np.asarray(pa.compute.list_value_length(batch.column(2)))
            for dim in np.unique(size):
                rows = np.flatnonzero(size == dim)
                x = _matrix(batch.column(2).take(pa.array(rows)))
                planes = np.random.default_rng((int(dim), attempt)).normal(size=(dim, 24 * sets))
                bits = (x @ planes > 0).reshape(len(rows), sets, 24)
                codes[rows] = bits @ (1 << np.arange(23, -1, -1))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.FixedSizeListArray.from_arrays(
                    pa.array(codes.ravel()), sets).cast(pa.list_(pa.int32()))],
                names=["u", "grp", "codes"])

    return nodes.select("u", "grp", "embedding").mapInArrow(
        run, "u long, grp long, codes array<int>")


def _compared(rows: DataFrame, n_rows: int, keep: int, rules: Descent) -> DataFrame:
    """(u, v, sim): for every row of ``rows(block, u, worst, vec)`` its nearest in the block, if
    nearer than ``worst``. Blocks are small; many are dealt to one task by a hash."""
    def run(table: pa.Table) -> pa.Table:
        block, u, worst = (np.asarray(table.column(i)) for i in range(3))
        raw = table.column(3).combine_chunks()
        size = np.asarray(pa.compute.list_value_length(raw))
        order = np.lexsort((u, size, block))
        block, u, worst, size = block[order], u[order], worst[order], size[order]
        raw = raw.take(pa.array(order))
        cut = np.flatnonzero(np.concatenate([
            [True], (block[1:] != block[:-1]) | (size[1:] != size[:-1]), [True]]))
        left, right, sims = [], [], []
        for a, b in zip(cut[:-1], cut[1:]):
            if b - a < 2:
                continue
            x = np.asarray(raw[a:b].flatten(), np.float32).reshape(b - a, -1)
            s = x @ x.T
            np.fill_diagonal(s, -2)
            s[u[a:b][:, None] == u[a:b][None, :]] = -2
            k = min(keep, b - a - 1)
            near = np.argpartition(-s, k - 1, axis=1)[:, :k]
            got = np.take_along_axis(s, near, axis=1)
            i, j = np.nonzero((got > worst[a:b][:, None]) & (got > -2))
            left.append(u[a:b][i]), right.append(u[a:b][near[i, j]]), sims.append(got[i, j])
        if not left:
            left, right, sims = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        return pa.table({"u": np.concatenate(left), "v": np.concatenate(right),
                         "sim": np.concatenate(sims).astype(np.float64)})

    tasks = max(1, -(-n_rows // rules.rows_per_task))
    return (rows.withColumn("task", F.pmod(F.xxhash64("block"), F.lit(tasks)))
            .select("block", "u", "worst", "vec", "task")
            .groupBy("task").applyInArrow(lambda t: run(t.drop_columns(["task"])),
                                          "u long, v long, sim double"))


def _unit(nodes: DataFrame) -> DataFrame:
    """(u, vec): single-precision unit vectors, half the size on the way."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            size = np.asarray(pa.compute.list_value_length(column))
            out: list = [None] * len(size)
            for dim in np.unique(size):
                rows = np.flatnonzero(size == dim)
                x = _matrix(column.take(pa.array(rows)), np.float32)
                for i, r in enumerate(rows):
                    out[r] = x[i]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.float32()))],
                                  names=["u", "vec"])

    return nodes.select("u", "embedding").mapInArrow(run, "u long, vec array<float>")


def _best(candidates: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` nearest of each u. Catalyst limits every task to them before the shuffle."""
    nearest = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return (candidates.groupBy("u", "v").agg(F.max("sim").alias("sim"),
                                             F.max("old").alias("old"))
            .withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= keep)
            .drop("rank"))


def _first_graph(units: DataFrame, codes: DataFrame, compared: int, keep: int,
                 rules: Descent) -> DataFrame:
    """Nearest neighbours inside blocks of like codes; ``compared`` is the number of codes. The prefix of a code that names a block is
    as long as the group is large; blocks that are still too large are split by a hash."""
    sized = codes.join(codes.groupBy("grp").agg(F.count("*").alias("members")), "grp")
    bits = F.greatest(F.lit(0), F.least(F.lit(24), F.floor(F.log2(
        F.col("members") / rules.block)))).cast("int")
    turned = sized.select("u", "grp", F.posexplode("codes").alias("turn", "code"),
                          bits.alias("bits")) \
        .withColumn("prefix", F.expr("shiftright(code, 24 - bits)"))
    place = ["grp", "turn", "prefix"]
    counts = turned.groupBy(*place).agg(F.count("*").alias("held"))
    parts = F.ceil(F.col("held") / rules.block)
    rows = (turned.join(counts, place)
            .withColumn("part", F.pmod(F.xxhash64("u", "turn"), parts))
            .select(F.xxhash64(*place, "part").alias("block"), "u", F.lit(-2.0).alias("worst"))
            .join(units, "u"))
    return _compared(rows, compared, keep, rules).withColumn("old", F.lit(False))


def _descend(graph: DataFrame, units: DataFrame, n: int, keep: int, turn: int,
             rules: Descent) -> DataFrame:
    """One round: what lies around a common neighbour is compared with each other. Only
    neighbours with a new entry in their list, or newly listed, are visited."""
    worst = graph.groupBy("u").agg(F.min("sim").alias("worst"), F.count("*").alias("held"))
    lists = graph.select(F.col("u").alias("block"), F.col("v").alias("u"), "old")
    listed = graph.select(F.col("v").alias("block"), "u", "old")
    some = Window.partitionBy("block").orderBy("old", F.xxhash64("u", F.lit(turn)))
    listed = listed.withColumn("rank", F.row_number().over(some)) \
        .filter(F.col("rank") <= 2 * keep).drop("rank")
    around = lists.unionByName(listed).groupBy("block", "u").agg(F.min("old").alias("old"))
    fresh = around.groupBy("block").agg(F.min("old").alias("settled")).filter("not settled")
    rows = (around.join(fresh.drop("settled"), "block").select("block", "u")
            .join(worst.select("u", F.when(F.col("held") < keep, -2.0).otherwise(F.col("worst"))
                               .alias("worst")), "u")
            .join(units, "u"))
    found = _compared(rows, 4 * n * keep, keep, rules).withColumn("old", F.lit(False))
    return _best(graph.withColumn("old", F.lit(True)).unionByName(found), keep)


def _cosines(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """pairs(a, b) with their cosine in double precision."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(pa.compute.list_value_length(batch.column(2)))
            cosine = np.zeros(len(size))
            for dim in np.unique(size):
                rows = pa.array(np.flatnonzero(size == dim))
                x, y = (_matrix(batch.column(i).take(rows)) for i in (2, 3))
                cosine[np.asarray(rows)] = np.einsum("ij,ij->i", x, y)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cosine)],
                                  names=["a", "b", "cosine"])

    return (pairs.join(nodes.select(F.col("u").alias("a"), F.col("embedding").alias("x")), "a")
            .join(nodes.select(F.col("u").alias("b"), F.col("embedding").alias("y")), "b")
            .select("a", "b", "x", "y")
            .mapInArrow(run, "a long, b long, cosine double"))


def _true_counts(nodes: DataFrame, asked: pa.Table, rules: Descent) -> DataFrame:
    """(u, true): the links of every vector of ``asked(u, grp, embedding)`` that has one, counted
    by brute force over ``nodes(u, grp, copies, embedding)``. Copies count one by one. Nothing
    but the counts leaves a task."""
    groups: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    asked_grp = np.asarray(asked.column("grp"))
    for grp in np.unique(asked_grp):
        rows = asked.take(pa.array(np.flatnonzero(asked_grp == grp)))
        groups[int(grp)] = (np.asarray(rows.column("u")), _matrix(rows.column("embedding")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {g: np.zeros(len(ids), np.int64) for g, (ids, _) in groups.items()}
        for batch in batches:
            u, grp, copies = (np.asarray(batch.column(i)) for i in range(3))
            for g, (ids, queries) in groups.items():
                rows = np.flatnonzero(grp == g)
                for part in np.array_split(rows, -(-len(rows) // QUERIES) or 1):
                    if len(part):
                        near = queries @ _matrix(batch.column(3).take(pa.array(part))).T \
                            >= rules.threshold
                        near &= ids[:, None] != u[part][None, :]
                        total[g] += near @ copies[part]
        for g, (ids, _) in groups.items():
            some = total[g] > 0
            yield pa.record_batch([pa.array(ids[some]), pa.array(total[g][some])],
                                  names=["u", "true"])

    return nodes.select("u", "grp", "copies", "embedding").mapInArrow(run, "u long, true long") \
        .groupBy("u").agg(F.sum("true").alias("true"))


def _asked(nodes: DataFrame, parts: int, first: int, end: int) -> pa.Table:
    """The vectors of some of ``parts`` equal shares, dealt by a hash."""
    part = F.pmod(F.xxhash64("u", F.lit(parts)), F.lit(parts))
    return nodes.filter((part >= first) & (part < end)).select("u", "grp", "embedding").toArrow()


def _within_groups(members: DataFrame, rules: Descent) -> DataFrame:
    """(u, links): partners of every row of ``members(u, grp, copies, embedding)`` in its group.

    A block of rows at a time goes to where the members lie and is compared with those of its
    groups. A large group is spread over all tasks, and the vectors are not shuffled.
    """
    members = durable(members, "members")
    parts = max(1, -(-members.count() // (4 * QUERIES)))
    counted = [durable(_true_counts(members, _asked(members, parts, k, k + 1), rules), "within")
               for k in range(parts)]
    return reduce(DataFrame.unionByName, counted).withColumnRenamed("true", "links")


def _true_links(nodes: DataFrame, n: int, rules: Descent) -> tuple[DataFrame, Audit]:
    """(u, true) of query vectors that have true links, and what was asked.

    Blocks of query vectors are asked until ``audit`` of them have a link, or ``queries`` have
    been asked. A block is collected.
    """
    parts = max(1, -(-n // QUERIES))
    most = min(parts, max(1, rules.queries // QUERIES))
    blocks, seen, done, step = [], 0, 0, 1
    while not blocks or done < most and seen < rules.audit:
        end = min(done + step, most)
        blocks.append(durable(_true_counts(nodes, _asked(nodes, parts, done, end), rules),
                              "true_links"))
        seen += blocks[-1].count()
        done, step = end, min(4, 2 * step)
    asked = n * done // parts
    return reduce(DataFrame.unionByName, blocks), Audit(asked, seen, None, done == parts, 0)


def _recall(true: DataFrame, links: DataFrame) -> float:
    """Share of the true links of the query vectors that were found: of all of them together, or
    on the average vector, whichever is less, for large groups hide what single pairs lose."""
    found = F.least("true", F.coalesce("links", F.lit(0)))
    row = true.join(links, "u", "left").agg(
        (F.sum(found) / F.sum("true")).alias("all"), F.avg(found / F.col("true")).alias("each")) \
        .first()
    return min(row["all"], row["each"])


def _link_counts(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(u, links): copies of a partner count one by one."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(nodes.select(F.col("u").alias("b"), "copies"), "b") \
        .groupBy(F.col("a").alias("u")).agg(F.sum("copies").alias("links"))


def _searched(nodes: DataFrame, n: int, true: DataFrame, audit: Audit,
              rules: Descent) -> tuple[DataFrame, DataFrame, Audit]:
    """Components (node, component) and counts (u, links) by descent, once ``target`` is reached.
    Every attempt compares inside blocks of new codes, keeps what the lists hold, and goes on.
    Tables of rounds that nothing reads any more are deleted."""
    units = durable(_unit(nodes), "units")
    keep, sets, attempt, graph = rules.neighbours, rules.codes, 0, None
    while True:
        codes = durable(_coded(nodes, sets, attempt), "codes")
        begun = _first_graph(units, codes, n * sets, keep, rules)
        if graph is not None:
            begun = begun.unionByName(graph.withColumn("old", F.lit(False)))
        past = [graph, codes]
        graph = durable(_best(begun, keep), "graph")
        discard(*past)
        for turn in range(rules.rounds):
            past = [graph]
            graph = durable(_descend(graph, units, n, keep, turn, rules), "graph")
            discard(*past)
            fresh, held = graph.agg(F.sum((~F.col("old")).cast("long")), F.count("*")).first()
            if not held or fresh <= rules.least_change * held:
                break
        near = graph.filter(F.col("sim") >= rules.threshold - SLACK)
        pairs = near.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")) \
            .distinct()
        links = durable(_cosines(pairs, nodes).filter(F.col("cosine") >= rules.threshold)
                        .select("a", "b"), "links")
        found = durable(components(links), "components")
        full = near.groupBy("u").agg(F.count("*").alias("held")).filter(F.col("held") >= keep)
        saturated = durable(full.join(found.withColumnRenamed("node", "u"), "u")
                            .select(F.col("component").alias("grp")).distinct(), "saturated")
        large = (found.withColumnsRenamed({"node": "u", "component": "grp"})
                 .join(saturated, "grp", "left_semi").join(nodes.drop("grp"), "u")
                 .select("u", "grp", "copies", "embedding"))
        enlarged = _within_groups(large, rules).withColumnRenamed("links", "all_links")
        total = durable(_link_counts(links, nodes).join(enlarged, "u", "full").select(
            "u", F.coalesce("all_links", "links").alias("links")), "link_counts")
        attempt += 1
        recall = _recall(true, total) if audit.seen else None
        wanted = 1.0 if audit.complete else rules.target
        reached = recall is None or recall >= wanted
        told = audit.complete or audit.seen >= rules.least_seen
        if keep > n or reached and (told or attempt >= rules.blind_attempts):
            return found, total, replace(audit, recall=recall, attempts=attempt)
        discard(links, found, total, saturated)
        keep, sets = 2 * keep, 2 * sets


def search(vectors: DataFrame, rules: Descent = Descent()) -> tuple[DataFrame, Audit]:
    """The rows of ``linked``, and how well the links were found."""
    nodes, members = prepared(vectors)
    n = nodes.count()
    true, audit = _true_links(nodes, n, rules)
    found, total, audit = _searched(nodes, n, true, audit, rules)
    per_class = (members.join(nodes.select("u", "copies"), "u").join(total, "u", "left")
                 .join(found.withColumnRenamed("node", "u"), "u", "left")
                 .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
                         .alias("n_links"), F.coalesce("component", "u").alias("component_id"))
                 .groupBy("vec_id").agg(F.sum("n_links").alias("n_links"),
                                        F.min("component_id").alias("component_id")))
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id")) \
        .filter("vec_id is not null").distinct()
    component = F.coalesce("component_id", "vec_id")
    return ids.join(per_class, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept")), audit


def linked(vectors: DataFrame, rules: Descent = Descent()) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each distinct vec_id of
    ``vectors(vec_id, embedding, label)``.

    Only equal, non-null labels and equal lengths are compared. Vectors that are null, empty or
    zero, or hold null or non-finite components, link with nothing and are kept. n_links counts
    other vectors; component_id is the smallest vec_id reachable. Rows without vec_id are left
    out; of several vectors under one id all links count. Other columns are ignored.
    """
    return search(vectors, rules)[0]


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
