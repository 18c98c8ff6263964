"""Approximate quantiles and distinct counts that add up: an opt-in beside the exact ones.

A sketch is kept per listing and month. Merging sketches gives the sketch of the union, so any
slice and any period is answered from these few rows, without the lines. Quantiles come from KLL
sketches (the rank of an answer is off by a bounded share of the rows), distinct counts from
HyperLogLog sketches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions.dates import month_key

KLL_K = 400
RANK_ERROR = 0.02  # of KLL at this size, with more than 99 % confidence
HLL_LOG_K = 14
COUNT_ERROR = 0.03  # three standard errors of HyperLogLog at this size


def listing_month_sketches(order_lines: DataFrame, value: str = "realized_net_revenue_aed",
                           entity: str = "order_id") -> DataFrame:
    """(listing_id, category, seller_id, month, lines, value_sketch, entity_sketch).

    NULL values are in ``lines`` and in no sketch. One partial aggregation: a listing with very
    many lines leaves a task as one sketch a month.
    """
    return order_lines.groupBy(
        "listing_id", "category", "seller_id",
        month_key(F.col("order_date_key")).alias("month")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("value_sketch"),
        F.hll_sketch_agg(F.col(entity).cast("string"), F.lit(HLL_LOG_K)).alias("entity_sketch"))


def from_sketches(sketches: DataFrame, by: Sequence[str],
                  points: Mapping[str, float]) -> DataFrame:
    """Per slice: lines, the quantiles ``points`` names, and the number of distinct entities. A
    slice without values has NULL quantiles."""
    merged = sketches.groupBy(*by).agg(
        F.sum("lines").alias("lines"),
        F.kll_merge_agg_double("value_sketch", F.lit(KLL_K)).alias("_values"),
        F.hll_union_agg("entity_sketch").alias("_entities"))
    some = F.kll_sketch_get_n_double("_values") > 0
    return merged.select(
        *by, "lines",
        *[F.when(some, F.kll_sketch_get_quantile_double("_values", F.lit(p))).alias(name)
          for name, p in points.items()],
        F.hll_sketch_estimate("_entities").alias("entities"))


def measured_errors(order_lines: DataFrame, answers: DataFrame, by: Sequence[str],
                    points: Mapping[str, float], value: str = "realized_net_revenue_aed",
                    entity: str = "order_id") -> DataFrame:
    """Per slice: how far the rank of every quantile lies from the one asked for, and the
    relative error of the distinct count, both against the lines themselves."""
    known = answers.withColumnsRenamed({c: f"_{c}" for c in by})
    match = F.lit(True)
    for c in by:
        match = match & order_lines[c].eqNullSafe(known[f"_{c}"])
    joined = order_lines.join(known, match)
    x = F.col(value).cast("double")
    filled = F.count(x)
    errors = []
    for name, p in points.items():
        below, upto = F.count_if(x < F.col(name)) / filled, F.count_if(x <= F.col(name)) / filled
        errors.append(F.greatest(below - p, p - upto, F.lit(0.0)).alias(f"{name}_rank_error"))
    distinct = F.count_distinct(entity)
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("lines"), *errors,
        (F.abs(F.any_value("entities") - distinct) / distinct).alias("count_error"))
