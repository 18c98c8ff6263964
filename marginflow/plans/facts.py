"""Line-level economics: one row per order line, one row per return line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import MONEY, band, money
from marginflow.operators.ranking import exact_quantiles
from marginflow.settings import (
    CANCELLED, DELIVERED, HEAVIEST_BAND, RTO_STATUSES, WEIGHT_BANDS,
)

ORDER_COLUMNS = (
    "order_line_id", "order_id", "listing_id", "seller_id", "geo_id", "category",
    "order_date_key", "payment_method", "order_status", "quantity", "unit_selling_price",
    "item_discount_amount", "logistics_zone", "weight_band", "weight_is_fallback",
    "gross_margin_pct", "realized_net_revenue_aed", "gross_margin_aed", "is_delivered",
    "is_shipped", "is_rto", "is_cancelled", "is_cod", "is_quantity_invalid",
    "promised_delivery_date_key", "actual_delivery_date_key", "delivery_attempts", "is_on_time",
    "rto_forward_cost_aed", "rto_handling_cost_aed", "rto_cost_aed",
)
RETURN_COLUMNS = (
    "return_id", "order_line_id", "listing_id", "seller_id", "category", "reported_reason_code",
    "reason_group", "return_initiated_date_key", "return_received_date_key",
    "item_condition_on_receipt", "quantity_returned", "unit_selling_price", "returned_value_aed",
    "recovery_pct", "recovered_value_aed", "reverse_logistics_cost_aed", "handling_cost_aed",
    "merchandise_loss_aed", "return_cost_aed", "refund_amount", "is_catalog_related",
    "is_reason_missing",
)


def category_weight_medians(listings: DataFrame) -> DataFrame:
    """Exact median weight per category; the value counts are small whatever the listings."""
    return exact_quantiles(listings, "item_weight_kg", {"median_weight_kg": 0.5}, ("category",))


def weight_band(weight: Column) -> Column:
    return band(weight, WEIGHT_BANDS, HEAVIEST_BAND)


def listing_weights(listings: DataFrame) -> DataFrame:
    """Effective weight and rate-card band of every listing."""
    return (listings.join(category_weight_medians(listings), "category", "left")
            .withColumn("weight_kg_effective",
                        F.coalesce("item_weight_kg", "median_weight_kg"))
            .select("listing_id", "category", "weight_kg_effective",
                    weight_band(F.col("weight_kg_effective")).alias("weight_band"),
                    F.col("dq_missing_item_weight_kg").alias("weight_is_fallback")))


def _leg(rates: DataFrame, leg: str, name: str) -> DataFrame:
    return rates.filter(F.col("leg") == leg).select(
        "logistics_zone", "weight_band", F.col("cost_aed").alias(name))


def status_flags() -> dict[str, Column]:
    status = F.col("order_status")
    return {
        "is_delivered": status == DELIVERED,
        "is_rto": status.isin(*RTO_STATUSES),
        "is_cancelled": status == CANCELLED,
        "is_shipped": status != CANCELLED,
        "is_cod": F.col("payment_method") == "cod",
    }


def net_revenue() -> Column:
    """quantity x unit price - line discount."""
    gross = F.col("quantity").cast("decimal(9,0)") * money(F.col("unit_selling_price"))
    return money(gross - money(F.col("item_discount_amount")))


def order_line_economics(orders: DataFrame, listings: DataFrame, geography: DataFrame,
                         economics: DataFrame, rates: DataFrame) -> DataFrame:
    """Revenue, margin and failed-delivery cost of every order line.

    Category economics are attached to the listings first, so the lines meet one listing table
    instead of two. Geography and rates are small; whether the listings are broadcast or
    shuffled is left to their measured size, and a much-sold listing to adaptive skew splitting.
    """
    priced = listing_weights(listings).join(
        economics.select("category", "gross_margin_pct", "warehouse_handling_cost_aed"),
        "category", "left")
    zones = geography.select("geo_id", "logistics_zone")
    lines = (orders.join(priced, "listing_id", "left").join(zones, "geo_id", "left")
             .join(_leg(rates, "forward", "forward_leg"), ["logistics_zone", "weight_band"],
                   "left")
             .withColumn("is_quantity_invalid", F.col("dq_out_of_range_quantity"))
             .withColumns(status_flags()))
    earns = F.col("is_delivered") & ~F.col("is_quantity_invalid")
    zero = F.lit(0).cast(MONEY)
    handling = money(F.col("warehouse_handling_cost_aed"))
    forward = F.col("forward_leg")
    rto = F.col("is_rto")
    return (
        lines.withColumn("realized_net_revenue_aed", F.when(earns, net_revenue()))
        .withColumns({
            "gross_margin_aed": money(F.round(
                F.col("realized_net_revenue_aed") * F.col("gross_margin_pct"), 4)),
            "is_on_time": F.col("is_delivered") & (
                F.col("actual_delivery_date_key") <= F.col("promised_delivery_date_key")),
            "rto_forward_cost_aed": F.when(rto, forward).otherwise(zero),
            "rto_handling_cost_aed": F.when(rto, handling).otherwise(zero),
            "rto_cost_aed": F.when(rto, money(forward + handling)).otherwise(zero),
        })
        .select(*ORDER_COLUMNS)
    )


def recovery_ratio() -> Column:
    """Salvage ratio by condition on receipt; write-offs and unknown conditions recover nothing."""
    condition = F.col("item_condition_on_receipt")
    return (F.when(condition == "resellable", F.col("recovery_pct_resellable"))
            .when(condition == "refurbishable", F.col("recovery_pct_refurbishable"))
            .otherwise(F.lit(0).cast("decimal(6,4)")))


# What a return needs to know of its order line
SOLD_COLUMNS = ("order_line_id", "listing_id", "seller_id", "category", "logistics_zone",
                "weight_band", "unit_selling_price")


def return_line_economics(returns: DataFrame, order_lines: DataFrame, reasons: DataFrame,
                          economics: DataFrame, rates: DataFrame) -> DataFrame:
    """Salvage and cost of every return line that belongs to a known order line."""
    sold = order_lines.select(*SOLD_COLUMNS)
    attributed = reasons.select(F.col("reason_code").alias("reported_reason_code"),
                                "reason_group", "is_catalog_related")
    salvage = economics.select("category", "warehouse_handling_cost_aed",
                               "recovery_pct_resellable", "recovery_pct_refurbishable")
    rows = (returns.join(sold, "order_line_id")
            .join(attributed, "reported_reason_code", "left")
            .join(salvage, "category", "left")
            .join(_leg(rates, "reverse", "reverse_logistics_cost_aed"),
                  ["logistics_zone", "weight_band"], "left"))
    value, ratio = F.col("returned_value_aed"), F.col("recovery_pct")
    kept = value * ratio
    loss = money(F.col("refund_amount")) - kept
    return (
        rows.withColumns({
            "returned_value_aed": money(F.col("quantity_returned").cast("decimal(9,0)")
                                        * money(F.col("unit_selling_price"))),
            "recovery_pct": recovery_ratio(),
            "handling_cost_aed": money(F.col("warehouse_handling_cost_aed")),
            "is_catalog_related": F.coalesce("is_catalog_related", F.lit(False)),
            "is_reason_missing": F.col("dq_missing_reported_reason_code"),
        })
        .withColumns({
            "recovered_value_aed": money(F.round(kept, 4)),
            "merchandise_loss_aed": money(F.round(loss, 4)),
            "return_cost_aed": money(F.round(
                F.col("reverse_logistics_cost_aed") + F.col("handling_cost_aed") + loss, 4)),
        })
        .select(*RETURN_COLUMNS)
    )
