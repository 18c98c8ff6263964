"""Seller scorecard: rollup of the listing mart, trust score, peer and cost ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginflow.functions.numeric import (
    count_where, half_up, quotient, rate, sum_where, weighted_mean,
)
from marginflow.operators.ranking import Ordered, percent_rank
from marginflow.settings import TIER_PRIOR, TRUST_WEIGHTS, Settings
from marginflow.sources.scratch import durable

SELLER_COLUMNS = (
    "seller_id", "seller_name", "seller_country", "fulfillment_type", "seller_tier",
    "primary_category", "listing_count", "active_listing_count", "total_orders",
    "delivered_orders", "shipped_orders", "rto_orders", "cancelled_orders", "returned_orders",
    "delivered_units", "returned_units", "catalog_returned_units", "gross_margin", "return_cost",
    "net_margin_after_returns", "net_margin_after_returns_pct", "realized_net_revenue",
    "returned_value", "recovered_value", "recoverable_profit", "rto_cost", "catalog_return_rate",
    "rto_rate", "recovery_rate", "on_time_delivery_rate", "avg_delivery_attempts",
    "damage_return_share", "average_listing_quality_score", "trust_score", "seller_rto_cost",
    "rto_cost_rank", "is_top_decile_rto_cost", "is_toxic_rto",
    "seller_percentile_within_category",
)
VOLUMES = ("total_orders", "delivered_orders", "shipped_orders", "rto_orders",
           "cancelled_orders", "returned_orders", "delivered_units", "returned_units",
           "catalog_returned_units")
AMOUNTS = ("gross_margin", "return_cost", "rto_cost", "realized_net_revenue", "returned_value",
           "recovered_value", "recoverable_profit")


def _wide(c: Column) -> Column:
    return c.cast("decimal(38,4)")


def listing_rollup(listings: DataFrame, *keys: str, more: Sequence[Column] = ()) -> DataFrame:
    """Sums of the additive listing measures at a coarser grain, and ``more`` aggregates."""
    return listings.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("listing_count"),
        count_where(F.col("total_orders") > 0).alias("active_listing_count"),
        quotient(F.sum("listing_quality_score"), F.count("listing_quality_score"))
        .alias("average_listing_quality_score"),
        *[F.sum(v).alias(v) for v in VOLUMES],
        *[_wide(F.sum(a)).alias(a) for a in AMOUNTS], *more,
    )


def primary_categories(listings: DataFrame) -> DataFrame:
    """The category with most of a seller's listings, the alphabetically first on a tie."""
    counted = listings.groupBy("seller_id", "category").agg(F.count(F.lit(1)).alias("n"))
    first = W.partitionBy("seller_id").orderBy(F.col("n").desc(),
                                               F.col("category").asc_nulls_last())
    return (counted.withColumn("_at", F.row_number().over(first)).filter("_at = 1")
            .select("seller_id", F.col("category").alias("primary_category")))


def trust_components(corrected: bool = False) -> dict[str, Column]:
    """Observable components in 0..1, higher is better, NULL where undefined.

    The published definition takes LEAST over a missing catalog return rate, which ignores the
    NULL and scores such sellers 0, and leaves the damage component undefined for sellers with
    returns but none of them damaged. ``corrected`` leaves the first one out and scores the
    second one 1.
    """
    catalog = quotient(F.col("catalog_returned_units"), F.col("delivered_units"))
    damaged = F.col("damage_returned_units")
    inverse_catalog = F.lit(1.0) - F.least(catalog, F.lit(1.0))
    if corrected:
        inverse_catalog = F.when(catalog.isNotNull(), inverse_catalog)
        damaged = F.coalesce(damaged, F.lit(0))
    active = F.col("delivered_orders") > 0
    tier = F.when(F.lit(False), F.lit(0.0))
    for name, prior in TIER_PRIOR.items():
        tier = tier.when(F.col("seller_tier") == name, F.lit(prior))
    return {
        "on_time_delivery_rate": quotient(F.col("on_time_delivered"), F.col("delivered_orders")),
        "inverse_rto_rate": F.lit(1.0) - quotient(F.col("rto_orders"), F.col("shipped_orders")),
        "inverse_catalog_return_rate": inverse_catalog,
        "inverse_damage_return_share":
            F.when(F.col("returned_units") > 0,
                   F.lit(1.0) - quotient(damaged, F.col("returned_units")))
            .when(active, F.lit(1.0)),
        "delivery_attempt_efficiency": F.when(active, F.greatest(
            F.lit(0.0), F.lit(1.0) - (F.col("average_attempts") - F.lit(1.0)) / F.lit(2.0))),
        "mean_listing_quality_score": F.col("average_listing_quality_score") / F.lit(100.0),
        "seller_tier_prior": tier.otherwise(F.lit(0.0)),
    }


def trust_score(corrected: bool = False) -> Column:
    mean = weighted_mean(TRUST_WEIGHTS, trust_components(corrected))
    return F.round((F.lit(100.0) * mean).cast("decimal(18,8)"), 2).cast("decimal(9,2)")


def seller_base(sellers: DataFrame, listings: DataFrame, order_lines: DataFrame,
                return_lines: DataFrame, settings: Settings) -> DataFrame:
    """All sellers with their rollups, rates and trust score; no ranks yet.

    Delivery behaviour and damaged units follow the seller of the line, everything else the
    seller of the listing. All four inputs arrive partitioned by seller.
    """
    delivered = F.col("is_delivered")
    delivery = order_lines.groupBy("seller_id").agg(
        sum_where(F.col("is_on_time").cast("int"), delivered).alias("on_time_delivered"),
        quotient(sum_where(F.col("delivery_attempts"), delivered),
                 F.count(F.when(delivered, F.col("delivery_attempts"))))
        .alias("average_attempts"))
    damage = return_lines.groupBy("seller_id").agg(
        sum_where(F.col("quantity_returned"), F.col("reason_group") == "damaged")
        .alias("damage_returned_units"))
    joined = (sellers.select("seller_id", "seller_name", "seller_country", "fulfillment_type",
                             "seller_tier")
              .join(listing_rollup(listings, "seller_id"), "seller_id", "left")
              .join(delivery, "seller_id", "left").join(damage, "seller_id", "left")
              .join(primary_categories(listings), "seller_id", "left"))
    filled = joined.withColumns({
        **{c: F.coalesce(F.col(c), F.lit(0))
           for c in ("listing_count", "active_listing_count", *VOLUMES)},
        **{c: _wide(F.coalesce(F.col(c), F.lit(0))) for c in AMOUNTS},
    })
    margin = F.col("gross_margin") - F.col("return_cost")
    unrounded_rto = quotient(F.col("rto_orders"), F.col("shipped_orders"))
    return filled.select(
        "seller_id", "seller_name", "seller_country", "fulfillment_type", "seller_tier",
        "primary_category", "listing_count", "active_listing_count", *VOLUMES,
        "gross_margin", "return_cost", _wide(margin).alias("net_margin_after_returns"),
        rate(margin, F.col("realized_net_revenue")).alias("net_margin_after_returns_pct"),
        "realized_net_revenue", "returned_value", "recovered_value", "recoverable_profit",
        "rto_cost",
        rate(F.col("catalog_returned_units"), F.col("delivered_units"))
        .alias("catalog_return_rate"),
        half_up(unrounded_rto, 6).alias("rto_rate"),
        rate(F.col("recovered_value"), F.col("returned_value")).alias("recovery_rate"),
        rate(F.col("on_time_delivered"), F.col("delivered_orders"))
        .alias("on_time_delivery_rate"),
        half_up(F.col("average_attempts"), 4).alias("avg_delivery_attempts"),
        rate(F.col("damage_returned_units"), F.col("returned_units"))
        .alias("damage_return_share"),
        half_up(F.col("average_listing_quality_score"), 2)
        .alias("average_listing_quality_score"),
        trust_score(settings.corrected_trust).alias("trust_score"),
        F.col("rto_cost").alias("seller_rto_cost"),
        ((unrounded_rto > settings.toxic_rate_threshold)
         & (F.col("shipped_orders") >= settings.toxic_min_shipped)).alias("is_toxic_rto"),
    )


def add_cost_rank(base: DataFrame, settings: Settings) -> DataFrame:
    """Rank of failed-delivery cost and the flag of its most expensive share of sellers."""
    by_cost = Ordered(base, [F.col("seller_rto_cost").desc(), F.col("seller_id").asc()])
    ranked = (by_cost.position("rto_cost_rank", count_name="_sellers")
              .tie_rank("rto_cost_rank", "_rank", ("seller_rto_cost",)).rows)
    share = percent_rank(F.col("_rank"), F.col("_sellers"))
    return (ranked.withColumn("is_top_decile_rto_cost", share <= settings.toxic_top_fraction)
            .drop("_rank", "_sellers"))


def add_peer_percentile(base: DataFrame) -> DataFrame:
    """Percentile of the net margin among sellers with the same primary category."""
    peers = Ordered(base, [F.col("primary_category").asc_nulls_last(),
                           F.col("net_margin_after_returns").asc(), F.col("seller_id").asc()])
    ranked = (peers.position("_at", ("primary_category",), "_peers")
              .tie_rank("_at", "_rank", ("primary_category", "net_margin_after_returns")).rows)
    return (ranked.withColumn("seller_percentile_within_category",
                              half_up(percent_rank(F.col("_rank"), F.col("_peers")), 4))
            .drop("_at", "_rank", "_peers"))


def seller_metrics(sellers: DataFrame, listings: DataFrame, order_lines: DataFrame,
                   return_lines: DataFrame, settings: Settings) -> DataFrame:
    """``listings`` is the listing mart."""
    base = durable(seller_base(sellers, listings, order_lines, return_lines, settings),
                   "sellers")
    return add_peer_percentile(add_cost_rank(base, settings)).select(*SELLER_COLUMNS)
