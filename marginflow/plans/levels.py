"""Rates at several levels at once: total, single dimensions and their combinations.

Each fact is summed once, at the finest level; the sums add up, so all coarser levels come from
those few rows by grouping sets. Rates are taken from the sums of their own level at the end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import count_where, rate, sum_where

LEVEL = "level"


def order_measures() -> dict[str, Column]:
    delivered = F.col("is_delivered")
    return {
        "rto_orders": count_where(F.col("is_rto")),
        "shipped_orders": count_where(F.col("is_shipped")),
        "delivered_orders": count_where(delivered),
        "on_time": sum_where(F.col("is_on_time").cast("int"), delivered),
        "delivered_units": sum_where(F.col("quantity"),
                                     delivered & ~F.col("is_quantity_invalid")),
    }


def return_measures() -> dict[str, Column]:
    return {
        "catalog_units": sum_where(F.col("quantity_returned"), F.col("is_catalog_related")),
        "returned_value": F.sum("returned_value_aed"),
        "recovered_value": F.sum("recovered_value_aed"),
    }


def sums_by_level(fact: DataFrame, by: Sequence[str], measures: Mapping[str, Column],
                  levels: Sequence[Sequence[str]]) -> DataFrame:
    """``level``, the columns of ``by`` and the measures, for every combination in ``levels``.

    ``level`` names the columns that a row is grouped by, ``total`` for none: a NULL in a column
    is a value of its own there and means "all" elsewhere. The finest groups are the only
    ones that the fact is shuffled for.
    """
    finest = fact.groupBy(*by).agg(*[v.alias(k) for k, v in measures.items()])
    kept = F.concat_ws(" x ", *[F.when(F.grouping(c) == 0, F.lit(c)) for c in by])
    named = F.when(kept == "", "total").otherwise(kept).alias(LEVEL)
    return (finest.groupingSets([list(level) for level in levels], *by)
            .agg(named, *[F.sum(k).alias(k) for k in measures]).select(LEVEL, *by, *measures))


def all_levels(by: Sequence[str]) -> list[tuple[str, ...]]:
    """Every combination of the columns, from all of them to none."""
    return [tuple(c for k, c in enumerate(by) if bits >> k & 1)
            for bits in range(2 ** len(by) - 1, -1, -1)]


def rates_by_level(order_lines: DataFrame, return_lines: DataFrame,
                   by: Sequence[str] = ("category", "seller_id"),
                   levels: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Catalog return, RTO, recovery and on-time rate at every level, groups with orders only."""
    levels = all_levels(by) if levels is None else levels
    sold = sums_by_level(order_lines, by, order_measures(), levels)
    back = sums_by_level(return_lines, by, return_measures(), levels) \
        .withColumnsRenamed({c: f"_{c}" for c in (LEVEL, *by)})
    match = F.col(LEVEL) == F.col(f"_{LEVEL}")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return sold.join(back, match, "left").select(
        LEVEL, *by, "shipped_orders", "delivered_orders",
        rate(F.coalesce("catalog_units", F.lit(0)), F.col("delivered_units"))
        .alias("catalog_return_rate"),
        rate(F.col("rto_orders"), F.col("shipped_orders")).alias("rto_rate"),
        rate(F.col("recovered_value"), F.col("returned_value")).alias("recovery_rate"),
        rate(F.col("on_time"), F.col("delivered_orders")).alias("on_time_rate"))
