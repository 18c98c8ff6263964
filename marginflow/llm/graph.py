"""Connected components of a link table, by alternating star contractions in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.sources.scratch import discard, durable


def _signature(edges: DataFrame) -> tuple:
    """Number of links and a sum over them: equal for equal tables."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                 .first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; component: smallest node reachable.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest
    node it knows. A node is stored with its parent only, so a very connected node is summed
    up by partial aggregation and never gathered. Rounds end when nothing moves; their number
    grows with the logarithm of the longest path. Null ends and self links are ignored; no
    links give an empty table.
    """
    edges = durable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = (both.join(least, "u").filter("v > u")
                  .select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .filter("u <> v").distinct())
        larger = durable(larger, "links")
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        joined = larger.join(least, "u")
        smaller = joined.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(joined.select("u", F.col("m").alias("v"))) \
            .filter("u <> v").distinct()
        smaller = durable(smaller, "links")
        settled = _signature(smaller) == _signature(edges)
        discard(edges, larger)
        edges = smaller
        if settled:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
