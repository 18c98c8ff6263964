"""Headline KPIs in a tall register."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import count_where, quotient
from marginflow.operators.ranking import exact_quantiles
from marginflow.settings import KPI_REGISTER, Settings
from marginflow.sources import inline


def marketplace_totals(listings: DataFrame) -> DataFrame:
    counts = ("total_orders", "delivered_orders", "returned_orders", "rto_orders",
              "shipped_orders", "delivered_units", "catalog_returned_units")
    amounts = ("returned_value", "recovered_value", "realized_net_revenue", "gross_margin",
               "return_cost", "recoverable_profit")
    return listings.agg(
        *[F.sum(c).alias(c) for c in counts],
        *[F.sum(c).cast("decimal(38,4)").alias(c) for c in amounts],
        count_where(F.col("net_margin_after_returns") < 0).alias("loss_making_listing_count"))


def low_quality_band(listings: DataFrame, settings: Settings) -> DataFrame:
    """Cutoff score and what the listings up to it hold of revenue and return cost."""
    cutoff = exact_quantiles(listings, "listing_quality_score",
                             {"cutoff": settings.low_quality_quantile})
    limit = cutoff.scalar()
    low = F.col("listing_quality_score") <= limit
    return listings.agg(
        F.max(limit).alias("cutoff"),
        count_where(low).alias("band_listings"),
        F.sum(F.when(low, F.col("realized_net_revenue"))).alias("band_revenue"),
        F.sum(F.when(low, F.col("return_cost"))).alias("band_return_cost"),
        F.sum("realized_net_revenue").alias("all_revenue"),
        F.sum("return_cost").alias("all_return_cost"),
    ).select("cutoff", "band_listings",
             quotient(F.col("band_revenue"), F.col("all_revenue")).alias("revenue_share"),
             quotient(F.col("band_return_cost"), F.col("all_return_cost"))
             .alias("return_cost_share"))


def rto_concentration(sellers: DataFrame) -> DataFrame:
    """Share of failed-delivery cost held by the flagged sellers."""
    return sellers.agg(quotient(
        F.sum(F.when(F.col("is_top_decile_rto_cost"), F.col("seller_rto_cost"))),
        F.sum("seller_rto_cost")).alias("concentration"))


def executive_summary(listings: DataFrame, sellers: DataFrame, categories: DataFrame,
                      settings: Settings) -> DataFrame:
    """Seventeen KPIs, one row each, in display order."""
    band = low_quality_band(listings, settings)
    focus = categories.filter(F.col("category") == settings.focus_category)

    def share(column: str):
        return focus.agg(F.max(f"percentage_of_marketplace_{column}")).scalar()

    kpis = {
        "total_orders": F.col("total_orders"),
        "delivered_orders": F.col("delivered_orders"),
        "returned_orders": F.col("returned_orders"),
        "rto_orders": F.col("rto_orders"),
        "total_gross_margin": F.col("gross_margin"),
        "total_return_cost": F.col("return_cost"),
        "total_recoverable_profit": F.col("recoverable_profit"),
        "net_margin_after_returns": F.col("gross_margin") - F.col("return_cost"),
        "marketplace_catalog_return_rate":
            quotient(F.col("catalog_returned_units"), F.col("delivered_units")),
        "marketplace_rto_rate": quotient(F.col("rto_orders"), F.col("shipped_orders")),
        "aggregate_recovery_rate": quotient(F.col("recovered_value"), F.col("returned_value")),
        "toxic_rto_concentration": rto_concentration(sellers).scalar(),
        "fashion_return_cost_share": share("return_cost"),
        "fashion_recoverable_profit_share": share("recoverable_profit"),
        "bottom_lqs_revenue_share": band.select("revenue_share").scalar(),
        "bottom_lqs_return_cost_share": band.select("return_cost_share").scalar(),
        "loss_making_listing_count": F.col("loss_making_listing_count"),
    }
    names = [name for name, *_ in KPI_REGISTER]
    wide = marketplace_totals(listings).select(
        *[kpis[n].cast("double").alias(n) for n in names])
    tall = wide.unpivot([], names, "kpi_name", "kpi_value")
    return (tall.join(inline.kpi_register(listings.sparkSession), "kpi_name")
            .select(F.lit(settings.as_of_date_key).alias("as_of_date_key"), "kpi_sort",
                    "kpi_group", "kpi_name", "kpi_label", "kpi_unit", "kpi_value")
            .orderBy("kpi_sort"))


def kpi(summary: DataFrame, *names: str) -> DataFrame:
    """Pick KPIs by name."""
    return summary.filter(F.col("kpi_name").isin(*names))
