"""Global order without a single-task window.

``ROW_NUMBER() OVER (ORDER BY ...)`` without a partition key sends every row to one task. Here
rows are range-partitioned on the full sort key (value plus unique tie columns, so even a value
shared by most rows spreads over many slices), sorted inside each slice and numbered there. The
numbered rows are made durable, because slice limits are sampled and must not be drawn twice.
Adding what lies in earlier slices gives exact positions, tie ranks, tertiles, running totals and
quantiles.

The per-slice summaries are aggregates: one row for each slice and ``by`` group that occurs in it.
They join without a hint, so Spark broadcasts them only when their size at run time allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginflow.functions.numeric import quotient
from marginflow.sources.scratch import durable

SLICE = "slice_id"
ROW = "slice_row"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


class Ordered:
    """Rows under a total order. ``order`` has to be unique; each step adds a column."""

    def __init__(self, df: DataFrame, order: Sequence[Column]) -> None:
        self._order = list(order)
        self._df = self._place(df)

    @property
    def rows(self) -> DataFrame:
        return self._df.drop(SLICE, ROW)

    def _place(self, df: DataFrame) -> DataFrame:
        """Ordered slices, rows numbered from 0 inside the slice."""
        numbered = (df.repartitionByRange(*self._order).sortWithinPartitions(*self._order)
                    .withColumn(ROW, F.monotonically_increasing_id()))
        return durable(
            numbered.withColumn(SLICE, F.shiftright(ROW, _ROW_BITS).cast("int"))
            .withColumn(ROW, F.col(ROW).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))), "placed")

    def position(self, name: str, by: Sequence[str] = (),
                 count_name: str | None = None) -> Ordered:
        """1-based position of each row, overall or inside its ``by`` group, and group size."""
        local = F.col(ROW) + 1
        if by:
            local = F.row_number().over(W.partitionBy(SLICE, *by).orderBy(ROW))
        return self._accumulate(local, F.count(F.lit(1)), "bigint", name, by, count_name)

    def running_total(self, value: str, name: str, by: Sequence[str] = (),
                      total_name: str | None = None) -> Ordered:
        """Inclusive running total of ``value``, and the total."""
        kind = self._df.schema[value].dataType.simpleString()
        kind = "decimal(38,4)" if kind.startswith("decimal") else kind
        inside = (W.partitionBy(SLICE, *by).orderBy(ROW)
                  .rowsBetween(W.unboundedPreceding, W.currentRow))
        return self._accumulate(F.sum(value).over(inside), F.sum(value), kind, name, by,
                                total_name)

    def _accumulate(self, local: Column, per_slice: Column, kind: str, name: str,
                    by: Sequence[str], total_name: str | None) -> Ordered:
        """``local`` inside the slice plus ``per_slice`` of all earlier slices."""
        every = W.partitionBy(*by)
        earlier = every.orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
        summary = (
            self._df.groupBy(SLICE, *by).agg(per_slice.cast(kind).alias("_here"))
            .select(SLICE, *by,
                    F.coalesce(F.sum("_here").over(earlier), F.lit(0)).cast(kind)
                    .alias("_before"),
                    F.sum("_here").over(every).cast(kind).alias("_all")))
        joined = _join_slices(self._df.withColumn("_local", local.cast(kind)), summary, by)
        added = joined.withColumn(name, (F.col("_before") + F.col("_local")).cast(kind))
        if total_name:
            added = added.withColumn(total_name, F.col("_all"))
        self._df = added.drop("_local", "_before", "_all")
        return self

    def tie_rank(self, position: str, name: str, ties: Sequence[str]) -> Ordered:
        """Smallest position among rows equal on ``ties``, which must lead the order.

        Equal rows inside one slice are resolved there. Only the first and last key of a slice
        can reach into another one, so at most two keys per slice are looked up.
        """
        local = self._df.withColumn(
            "_start", F.min(position).over(W.partitionBy(SLICE, *ties)))
        ends = self._df.groupBy(SLICE).agg(F.max(ROW).alias("_last"))
        edges = (
            _join_slices(local, ends, ())
            .filter((F.col(ROW) == 0) | (F.col(ROW) == F.col("_last")))
            .groupBy(*ties).agg(F.min("_start").alias("_edge"))
        ).select(*[F.col(c).alias(f"_{c}") for c in ties], "_edge")
        match = F.lit(True)
        for c in ties:
            match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
        self._df = (local.join(edges, match, "left")
                    .withColumn(name, F.coalesce("_edge", "_start"))
                    .drop("_edge", "_start", *[f"_{c}" for c in ties]))
        return self


def _join_slices(placed: DataFrame, summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach per-slice values."""
    renamed = summary.select(
        F.col(SLICE).alias("_slice"),
        *[F.col(c).alias(f"_{c}") for c in by],
        *[c for c in summary.columns if c != SLICE and c not in by],
    )
    match = F.col(SLICE) == F.col("_slice")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return placed.join(renamed, match).drop("_slice", *[f"_{c}" for c in by])


def percent_rank(tie_rank: Column, rows: Column) -> Column:
    """(rank - 1) / (n - 1); 0 for a single row."""
    return F.when(rows > 1, quotient(tie_rank - 1, rows - 1)).otherwise(F.lit(0.0))


def tile(position: Column, rows: Column, tiles: int) -> Column:
    """NTILE from a position: the first n mod tiles buckets hold one extra row."""
    size = F.floor(rows / F.lit(tiles))
    long_rows = (rows % F.lit(tiles)) * (size + 1)
    return F.when(
        position <= long_rows, F.floor((position - 1) / (size + 1)) + 1,
    ).otherwise(
        rows % F.lit(tiles) + F.floor((position - long_rows - 1) / F.greatest(size, F.lit(1))) + 1
    ).cast("int")


def exact_quantiles(df: DataFrame, column: str, points: dict[str, float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Interpolated quantiles of the non-null values, one row per ``by`` group.

    Values are first counted, so frequent values cost one row each, and the counted values are
    accumulated in order across slices; no task holds a group.
    """
    known = df.filter(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("_v"))
    counted = known.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    cumulated = Ordered(counted, [F.col(c).asc() for c in (*by, "_v")]) \
        .running_total("_n", "_upto", by, "_rows").rows
    hits, values = F.lit(False), []
    for name, point in points.items():
        at = F.lit(float(point)) * (F.col("_rows") - 1)
        low, high = F.floor(at), F.ceil(at)
        begin = F.col("_upto") - F.col("_n")
        in_low = (begin <= low) & (low < F.col("_upto"))
        in_high = (begin <= high) & (high < F.col("_upto"))
        hits = hits | in_low | in_high
        left, right = F.max(F.when(in_low, F.col("_v"))), F.max(F.when(in_high, F.col("_v")))
        share = F.max(at - low)
        values.append((left + (right - left) * share).alias(name))
    return cumulated.filter(hits).groupBy(*by).agg(*values)
