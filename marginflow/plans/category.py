"""Category scorecard. Its rows are bounded by the category vocabulary, so plain windows do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginflow.functions.numeric import half_up, quotient, rate
from marginflow.plans.seller import listing_rollup

CATEGORY_COLUMNS = (
    "category", "listing_count", "seller_count", "total_orders", "delivered_orders",
    "shipped_orders", "returned_orders", "rto_orders", "delivered_units", "returned_units",
    "catalog_returned_units", "gross_margin", "return_cost", "recoverable_profit",
    "net_margin_after_returns", "net_margin_after_returns_pct", "rto_cost",
    "realized_net_revenue", "returned_value", "recovered_value",
    "average_listing_quality_score", "recovery_rate", "catalog_return_rate", "rto_rate",
    "average_trust_score", "average_delivery_attempts", "on_time_delivery_rate",
    "category_gross_margin_pct", "category_rank_by_margin_loss",
    "category_rank_by_return_cost", "category_rank_by_recoverable_profit",
    "percentage_of_marketplace_return_cost", "percentage_of_marketplace_recoverable_profit",
)


def category_trust(listings: DataFrame, sellers: DataFrame) -> DataFrame:
    """Mean trust of the distinct sellers that list in a category, and their number."""
    pairs = listings.select("category", "seller_id").distinct()
    scores = sellers.select("seller_id", "trust_score")
    return pairs.join(scores, "seller_id").groupBy("category").agg(
        F.count(F.lit(1)).alias("scored_sellers"),
        quotient(F.sum("trust_score"), F.count("trust_score")).alias("mean_trust"))


def category_base(listings: DataFrame, sellers: DataFrame, economics: DataFrame) -> DataFrame:
    """Rollup of the listing mart with rates; delivery counts are carried by that mart."""
    totals = listing_rollup(listings, "category", more=[
        F.sum("on_time_delivered").alias("on_time"),
        F.sum("attempts_total").alias("attempts"),
        F.sum("attempts_known").alias("attempts_of"),
        F.count_distinct("seller_id").alias("seller_count")]).drop("active_listing_count")
    margins = economics.select("category", F.col("gross_margin_pct").alias("category_pct"))
    joined = (totals.join(category_trust(listings, sellers), "category", "left")
              .join(margins, "category", "left"))
    known = F.col("category").isNotNull()
    margin = (F.col("gross_margin") - F.col("return_cost")).cast("decimal(38,4)")
    return joined.select(
        "*",
        margin.alias("net_margin_after_returns"),
        rate(margin, F.col("realized_net_revenue")).alias("net_margin_after_returns_pct"),
        rate(F.col("recovered_value"), F.col("returned_value")).alias("recovery_rate"),
        rate(F.col("catalog_returned_units"), F.col("delivered_units"))
        .alias("catalog_return_rate"),
        rate(F.col("rto_orders"), F.col("shipped_orders")).alias("rto_rate"),
        half_up(F.col("mean_trust"), 2).alias("average_trust_score"),
        F.when(known, half_up(quotient(F.col("attempts"), F.col("attempts_of")), 4))
        .alias("average_delivery_attempts"),
        F.when(known, rate(F.col("on_time"), F.col("delivered_orders")))
        .alias("on_time_delivery_rate"),
        half_up(F.col("category_pct"), 4).alias("category_gross_margin_pct"),
    ).withColumn("average_listing_quality_score",
                 half_up(F.col("average_listing_quality_score"), 2))


def add_ranks(base: DataFrame) -> DataFrame:
    """Three strict rankings, 1 being the most severe."""
    def rank(*order: Column) -> Column:
        return F.row_number().over(W.orderBy(*order, F.col("category").asc_nulls_last()))

    return base.withColumns({
        "category_rank_by_margin_loss": rank(F.col("net_margin_after_returns").asc()),
        "category_rank_by_return_cost": rank(F.col("return_cost").desc()),
        "category_rank_by_recoverable_profit": rank(F.col("recoverable_profit").desc()),
    })


def add_shares(base: DataFrame) -> DataFrame:
    """Share of the marketplace total."""
    everything = W.partitionBy()
    return base.withColumns({
        f"percentage_of_marketplace_{c}": rate(F.col(c), F.sum(c).over(everything))
        for c in ("return_cost", "recoverable_profit")})


def category_metrics(listings: DataFrame, sellers: DataFrame,
                     economics: DataFrame) -> DataFrame:
    """``listings`` is the listing mart with its carried columns, ``sellers`` the seller mart."""
    base = category_base(listings, sellers, economics)
    return add_shares(add_ranks(base)).select(*CATEGORY_COLUMNS)
