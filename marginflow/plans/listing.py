"""Listing scorecard: quality score, volumes, rates, economics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginflow.functions.numeric import (
    count_where, half_up, quotient, rate, sum_where,
)
from marginflow.settings import (
    SIGNAL_OVERRIDES, SIGNAL_TARGETS, SIGNAL_WEIGHTS, Settings,
)

LISTING_COLUMNS = (
    "listing_id", "category", "seller_id", "listing_quality_score", "total_orders",
    "delivered_orders", "shipped_orders", "rto_orders", "cancelled_orders", "returned_orders",
    "delivered_units", "returned_units", "catalog_returned_units", "catalog_return_rate",
    "rto_rate", "recovery_rate", "gross_margin", "return_cost", "net_margin_after_returns",
    "net_margin_after_returns_pct", "rto_cost", "realized_net_revenue", "returned_value",
    "recovered_value", "on_time_delivery_rate", "avg_delivery_attempts", "damage_return_share",
    "recoverable_profit",
)
# Additive parts that the marts above re-use instead of scanning the facts again
CARRIED_COLUMNS = ("on_time_delivered", "attempts_total", "attempts_known",
                   "catalog_return_cost")


def signal_weight(signal: str) -> Column:
    """Raw weight of a signal for the row's category."""
    out = F.when(F.lit(False), F.lit(0.0))
    for category, changes in SIGNAL_OVERRIDES.items():
        if signal in changes:
            out = out.when(F.col("category") == category, F.lit(float(changes[signal])))
    return out.otherwise(F.lit(float(SIGNAL_WEIGHTS[signal])))


def signal_values() -> dict[str, Column]:
    """Catalog signals scaled to 0..1; missing content counts as absent."""
    def capped(column: str) -> Column:
        share = F.coalesce(F.col(column), F.lit(0)) / F.lit(float(SIGNAL_TARGETS[column]))
        return F.least(share, F.lit(1.0))

    def present(column: str) -> Column:
        return F.when(F.col(column), F.lit(1.0)).otherwise(F.lit(0.0))

    title = F.col("title_length_chars")
    enough = float(SIGNAL_TARGETS["title_length_chars"])
    return {
        "image_sufficiency": capped("image_count"),
        "has_video": present("has_video"),
        "title_adequacy": F.when(title >= enough, F.lit(1.0))
                           .otherwise(F.coalesce(title / F.lit(enough), F.lit(0.0))),
        "description_adequacy": capped("description_length_chars"),
        "specifications_filled_pct": F.coalesce("specifications_filled_pct", F.lit(0.0)),
        "has_size_chart": present("has_size_chart"),
        "has_dimensions_listed": present("has_dimensions_listed"),
        "variant_sufficiency": capped("variant_count"),
    }


def category_signal_weights(listings: DataFrame) -> DataFrame:
    """(category, signal, raw_weight, weight); weights sum to 1 inside a category."""
    rows = F.array(*[F.struct(F.lit(s).alias("signal"), signal_weight(s).alias("raw_weight"))
                     for s in SIGNAL_WEIGHTS])
    return (listings.select("category").distinct().select("category", F.inline(rows))
            .withColumn("weight", F.col("raw_weight")
                        / F.sum("raw_weight").over(W.partitionBy("category"))))


def listing_signals(listings: DataFrame) -> DataFrame:
    """(listing_id, category, signal, value): eight rows per listing from one scan."""
    rows = F.array(*[F.struct(F.lit(s).alias("signal"), v.cast("double").alias("value"))
                     for s, v in signal_values().items()])
    return listings.select("listing_id", "category", F.inline(rows))


def quality_score() -> Column:
    """0..100; a weighted mean on the listing row itself, so nothing is shuffled."""
    values = signal_values()
    top = bottom = F.lit(0.0)
    for signal in SIGNAL_WEIGHTS:
        top = top + signal_weight(signal) * values[signal]
        bottom = bottom + signal_weight(signal)
    return F.when(F.col("category").isNotNull(), F.lit(100.0) * top / bottom)


def _order_side(order_lines: DataFrame) -> DataFrame:
    delivered = F.col("is_delivered")
    return order_lines.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        count_where(delivered).alias("delivered_orders"),
        count_where(F.col("is_shipped")).alias("shipped_orders"),
        count_where(F.col("is_rto")).alias("rto_orders"),
        count_where(F.col("is_cancelled")).alias("cancelled_orders"),
        sum_where(F.col("quantity"), delivered & ~F.col("is_quantity_invalid"))
        .alias("delivered_units"),
        F.sum("gross_margin_aed").alias("gross_margin"),
        F.sum("realized_net_revenue_aed").alias("realized_net_revenue"),
        F.sum("rto_cost_aed").alias("rto_cost"),
        sum_where(F.col("is_on_time").cast("int"), delivered).alias("on_time_delivered"),
        sum_where(F.col("delivery_attempts"), delivered).alias("attempts_total"),
        F.count(F.when(delivered, F.col("delivery_attempts"))).alias("attempts_known"),
    )


def _return_side(return_lines: DataFrame, economics: DataFrame) -> DataFrame:
    units, catalog = F.col("quantity_returned"), F.col("is_catalog_related")
    leak = F.col("return_cost_aed") + F.col("returned_value_aed") * F.col("gross_margin_pct")
    margins = economics.select("category", "gross_margin_pct")
    return return_lines.join(margins, "category").groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("returned_orders"),
        F.sum(units).alias("returned_units"),
        sum_where(units, catalog).alias("catalog_returned_units"),
        sum_where(units, F.col("reason_group") == "damaged").alias("damage_returned_units"),
        F.sum("return_cost_aed").alias("return_cost"),
        F.sum("returned_value_aed").alias("returned_value"),
        F.sum("recovered_value_aed").alias("recovered_value"),
        sum_where(F.col("return_cost_aed"), catalog).alias("catalog_return_cost"),
        sum_where(leak, catalog).alias("catalog_leakage"),
    )


def listing_metrics(listings: DataFrame, order_lines: DataFrame, return_lines: DataFrame,
                    economics: DataFrame, settings: Settings,
                    carry: bool = False) -> DataFrame:
    """One row per listing, also without any activity.

    Both facts are aggregated before they meet the listings. ``carry`` keeps the additive
    helper columns for the seller and category marts and the queue.
    """
    orders, returns = _order_side(order_lines), _return_side(return_lines, economics)
    base = (listings.join(orders, "listing_id", "left").join(returns, "listing_id", "left"))

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def amount(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("decimal(28,4)")

    margin = amount("gross_margin") - amount("return_cost")
    fraction = F.lit(settings.addressable_fraction).cast("decimal(6,4)")
    leakage = F.coalesce(F.col("catalog_leakage"), F.lit(0)).cast("decimal(28,8)")
    volumes = ("total_orders", "delivered_orders", "shipped_orders", "rto_orders",
               "cancelled_orders", "returned_orders", "delivered_units", "returned_units",
               "catalog_returned_units")
    columns: dict[str, Column] = {
        "listing_id": F.col("listing_id"),
        "category": F.col("category"),
        "seller_id": F.col("seller_id"),
        "listing_quality_score": F.round(quality_score().cast("decimal(18,8)"), 2)
                                  .cast("decimal(9,2)"),
        **{v: zero(v) for v in volumes},
        "catalog_return_rate": rate(zero("catalog_returned_units"), F.col("delivered_units")),
        "rto_rate": rate(F.col("rto_orders"), F.col("shipped_orders")),
        "recovery_rate": rate(F.col("recovered_value"), F.col("returned_value")),
        "gross_margin": amount("gross_margin"),
        "return_cost": amount("return_cost"),
        "net_margin_after_returns": margin.cast("decimal(28,4)"),
        "net_margin_after_returns_pct": rate(margin, F.col("realized_net_revenue")),
        "rto_cost": amount("rto_cost"),
        "realized_net_revenue": amount("realized_net_revenue"),
        "returned_value": amount("returned_value"),
        "recovered_value": amount("recovered_value"),
        "on_time_delivery_rate": rate(F.col("on_time_delivered"), F.col("delivered_orders")),
        "avg_delivery_attempts": half_up(
            quotient(F.col("attempts_total"), F.col("attempts_known")), 4),
        "damage_return_share": rate(F.col("damage_returned_units"), F.col("returned_units")),
        "recoverable_profit": F.round(fraction * leakage, 2).cast("decimal(28,4)"),
    }
    if carry:
        columns |= {"on_time_delivered": F.col("on_time_delivered"),
                    "attempts_total": F.col("attempts_total"),
                    "attempts_known": zero("attempts_known"),
                    "catalog_return_cost": amount("catalog_return_cost")}
    return base.select(*[c.alias(n) for n, c in columns.items()])
