"""Measures for any slice of the business tables. Rates are recomputed from sums, never averaged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginflow.functions.dates import month_key
from marginflow.functions.numeric import (
    count_where, half_up, quotient, rate, sum_where,
)
from marginflow.operators.ranking import Ordered, exact_quantiles, percent_rank

AMOUNT = "decimal(38,4)"


def _join_null_safe(left: DataFrame, right: DataFrame, by: Sequence[str],
                    how: str = "left") -> DataFrame:
    """Join on slice columns that may be NULL; the slice columns of the left side remain."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") for c in by],
                           *[c for c in right.columns if c not in by])
    match = F.lit(True)
    for c in by:
        match = match & left[c].eqNullSafe(renamed[f"_{c}"])
    return left.join(renamed, match, how).drop(*[f"_{c}" for c in by])


def weighted_rates(order_lines: DataFrame, return_lines: DataFrame,
                   by: Sequence[str]) -> DataFrame:
    """Catalog return, RTO, recovery and on-time rate per slice.

    ``by`` names columns that both facts have. Each fact is summed on its own before the join.
    """
    delivered = F.col("is_delivered")
    sold = order_lines.groupBy(*by).agg(
        count_where(F.col("is_rto")).alias("rto_orders"),
        count_where(F.col("is_shipped")).alias("shipped_orders"),
        count_where(delivered).alias("delivered_orders"),
        sum_where(F.col("is_on_time").cast("int"), delivered).alias("on_time"),
        sum_where(F.col("quantity"), delivered & ~F.col("is_quantity_invalid"))
        .alias("delivered_units"))
    back = return_lines.groupBy(*by).agg(
        sum_where(F.col("quantity_returned"), F.col("is_catalog_related"))
        .alias("catalog_units"),
        F.sum("returned_value_aed").alias("returned_value"),
        F.sum("recovered_value_aed").alias("recovered_value"))
    return _join_null_safe(sold, back, by).select(
        *by, "shipped_orders", "delivered_orders",
        rate(F.coalesce("catalog_units", F.lit(0)), F.col("delivered_units"))
        .alias("catalog_return_rate"),
        rate(F.col("rto_orders"), F.col("shipped_orders")).alias("rto_rate"),
        rate(F.col("recovered_value"), F.col("returned_value")).alias("recovery_rate"),
        rate(F.col("on_time"), F.col("delivered_orders")).alias("on_time_rate"))


def rto_by(order_lines: DataFrame, *by: str) -> DataFrame:
    """Failed-delivery rate and cost per slice of the order lines."""
    return order_lines.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_orders"),
        count_where(F.col("is_shipped")).alias("shipped_orders"),
        count_where(F.col("is_rto")).alias("rto_orders"),
        F.sum("rto_cost_aed").cast(AMOUNT).alias("rto_cost"),
    ).withColumn("rto_rate", rate(F.col("rto_orders"), F.col("shipped_orders")))


def return_cost_decomposition(return_lines: DataFrame, *by: str) -> DataFrame:
    """(slice, component, amount, share): logistics, handling and merchandise loss."""
    parts = {"reverse_logistics": "reverse_logistics_cost_aed",
             "handling": "handling_cost_aed", "merchandise_loss": "merchandise_loss_aed"}
    sums = return_lines.groupBy(*by).agg(
        *[F.sum(c).cast(AMOUNT).alias(n) for n, c in parts.items()])
    total = F.sum("amount").over(W.partitionBy(*by))
    return (sums.unpivot(list(by), list(parts), "component", "amount")
            .withColumn("share", rate(F.col("amount"), total)))


def returns_by_reason(return_lines: DataFrame) -> DataFrame:
    """Returns, units and cost per reason group; an unreported reason is ``unknown``.

    The groups are bounded by the reason table.
    """
    return return_lines.groupBy(
        F.coalesce("reason_group", F.lit("unknown")).alias("reason_group")
    ).agg(
        F.count(F.lit(1)).alias("returns"), F.sum("quantity_returned").alias("units"),
        F.sum("return_cost_aed").cast(AMOUNT).alias("return_cost"),
    ).withColumns({
        "unit_share": rate(F.col("units"), F.sum("units").over(W.partitionBy())),
        "cost_share": rate(F.col("return_cost"), F.sum("return_cost").over(W.partitionBy())),
    })


def recovery_by_condition(return_lines: DataFrame) -> DataFrame:
    return return_lines.groupBy("item_condition_on_receipt").agg(
        F.sum("quantity_returned").alias("units"),
        F.sum("returned_value_aed").cast(AMOUNT).alias("returned_value"),
        F.sum("recovered_value_aed").cast(AMOUNT).alias("recovered_value"),
    ).withColumn("recovery_rate", rate(F.col("recovered_value"), F.col("returned_value")))


def monthly_trend(order_lines: DataFrame, return_lines: DataFrame) -> DataFrame:
    """Orders by order month, returns by initiation month, and month-on-month change.

    The change is against the calendar month before; it is undefined after a month without rows.
    Rows are months, so the ordered windows hold a bounded number of them.
    """
    sold = order_lines.groupBy(month_key(F.col("order_date_key")).alias("month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("realized_net_revenue_aed").cast(AMOUNT).alias("revenue"))
    back = return_lines.groupBy(
        month_key(F.col("return_initiated_date_key")).alias("month")).agg(
        F.count(F.lit(1)).alias("returns"),
        F.sum("return_cost_aed").cast(AMOUNT).alias("return_cost"))
    merged = sold.join(back, "month", "full").fillna(0, ["orders", "returns"])
    previous = W.orderBy("month")
    january = F.col("month") % 100 == 1
    month_before = F.col("month") - F.when(january, 89).otherwise(1)
    follows = F.lag("month").over(previous) == month_before
    cost_before = F.when(follows, F.lag("return_cost").over(previous))
    orders_before = F.when(follows, F.lag("orders").over(previous))
    return merged.withColumns({
        "orders_mom": rate(F.col("orders") - orders_before, orders_before),
        "return_cost_mom": rate(F.col("return_cost") - cost_before, cost_before),
    })


def period_to_date(return_lines: DataFrame) -> DataFrame:
    """Return cost per day with month-, quarter- and year-to-date totals."""
    key = F.col("return_initiated_date_key")
    daily = return_lines.groupBy(key.alias("date_key")).agg(
        F.sum("return_cost_aed").cast(AMOUNT).alias("return_cost"))
    year, month = F.floor(F.col("date_key") / 10000), F.floor(F.col("date_key") / 100)
    quarter = F.floor((month % 100 - 1) / 3)

    def upto(*period: Column) -> Column:
        days = (W.partitionBy(*period).orderBy("date_key")
                .rowsBetween(W.unboundedPreceding, W.currentRow))
        return F.sum("return_cost").over(days).cast(AMOUNT)

    return daily.withColumns({"mtd": upto(month), "qtd": upto(year, quarter), "ytd": upto(year)})


def seasonal_return_cost(return_lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """(season, returns, return_cost, share of all cost) by initiation date."""
    seasons = ["is_ramadan", "is_eid_period", "is_white_friday_period",
               "is_uae_public_holiday", "is_weekend"]
    daily = return_lines.groupBy(
        F.col("return_initiated_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("return_cost_aed").alias("cost"))
    dated = daily.join(calendar.select("date_key", *seasons), "date_key", "left")
    rows = F.array(*[
        F.struct(F.lit(s).alias("season"),
                 F.coalesce(sum_where(F.col("n"), F.col(s)), F.lit(0)).alias("returns"),
                 F.coalesce(sum_where(F.col("cost"), F.col(s)), F.lit(0)).cast(AMOUNT)
                 .alias("return_cost")) for s in seasons])
    return (dated.agg(rows.alias("rows"), F.sum("cost").alias("_all"))
            .select(F.inline("rows"), "_all")
            .withColumn("share", rate(F.col("return_cost"), F.col("_all"))).drop("_all"))


def score_histogram(listings: DataFrame, width: int = 10) -> DataFrame:
    """Listings per score bucket and quartile band of the score."""
    score = F.col("listing_quality_score").cast("double")
    cuts = exact_quantiles(listings, "listing_quality_score",
                           {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    q1, q2, q3 = (cuts.select(q).scalar() for q in ("q1", "q2", "q3"))
    quartile = (F.when(score <= q1, 1).when(score <= q2, 2).when(score <= q3, 3)
                .when(score.isNotNull(), 4))
    bucket = F.least(F.floor(score / F.lit(width)), F.lit(100 // width - 1)) * F.lit(width)
    return listings.groupBy(bucket.cast("int").alias("bucket_from"),
                            quartile.alias("quartile")).agg(
        F.count(F.lit(1)).alias("listings"),
        F.sum("return_cost").cast(AMOUNT).alias("return_cost"))


def pareto(table: DataFrame, entity: str, value: str) -> DataFrame:
    """Entities by falling value with rank, running total and cumulative share."""
    falling = Ordered(table.select(entity, F.col(value).cast(AMOUNT).alias(value)),
                      [F.col(value).desc_nulls_last(), F.col(entity).asc()])
    summed = falling.position("rank").running_total(value, "running_total", total_name="_total")
    return summed.rows.select(
        entity, value, "rank", "running_total",
        rate(F.col("running_total"), F.col("_total")).alias("cumulative_share"))


def margin_waterfall(listings: DataFrame, *by: str) -> DataFrame:
    """(slice, step, amount): gross margin, minus return cost, net margin."""
    sums = listings.groupBy(*by).agg(
        F.sum("gross_margin").cast(AMOUNT).alias("gross_margin"),
        (-F.sum("return_cost")).cast(AMOUNT).alias("return_cost"))
    whole = sums.withColumn("net_margin",
                            (F.col("gross_margin") + F.col("return_cost")).cast(AMOUNT))
    return whole.unpivot(list(by), ["gross_margin", "return_cost", "net_margin"], "step",
                         "amount")


def net_margin_after_rto(listings: DataFrame, *by: str) -> DataFrame:
    """Net margin that also bears the cost of failed deliveries."""
    return listings.groupBy(*by).agg(
        F.sum("net_margin_after_returns").cast(AMOUNT).alias("net_margin_after_returns"),
        F.sum("rto_cost").cast(AMOUNT).alias("rto_cost"),
        F.sum("realized_net_revenue").alias("_revenue"),
    ).withColumn(
        "net_margin_after_returns_and_rto",
        (F.col("net_margin_after_returns") - F.col("rto_cost")).cast(AMOUNT),
    ).withColumn(
        "net_margin_after_returns_and_rto_pct",
        rate(F.col("net_margin_after_returns_and_rto"), F.col("_revenue"))).drop("_revenue")


def queue_summary(queue: DataFrame) -> DataFrame:
    """Actions and opportunity by type, owner and band."""
    total = F.sum("opportunity_aed").over(W.partitionBy())
    return queue.groupBy("intervention_type", "recommended_owner", "priority").agg(
        F.count(F.lit(1)).alias("actions"),
        F.sum("priority_opportunity_aed").cast(AMOUNT).alias("opportunity_aed"),
        count_where(F.col("priority") == "High").alias("high_priority"),
    ).withColumn("opportunity_share", rate(F.col("opportunity_aed"), total))


def queue_top(queue: DataFrame, n: int) -> DataFrame:
    return queue.orderBy("global_priority_rank").limit(n)


def rank_by(table: DataFrame, entity: str, metric: str, n: int) -> DataFrame:
    """The top ``n`` entities by a chosen metric."""
    return (table.select(entity, F.lit(metric).alias("metric"), F.col(metric).alias("value"))
            .orderBy(F.col("value").desc_nulls_last(), F.col(entity).asc()).limit(n))


def drill_down(table: DataFrame, **fixed: object) -> DataFrame:
    """Rows whose columns equal the given values; NULL selects NULL."""
    for column, value in fixed.items():
        table = table.filter(F.col(column).eqNullSafe(F.lit(value)))
    return table


def unknown_reason_rate(return_lines: DataFrame, *by: str) -> DataFrame:
    units = F.col("quantity_returned")
    return return_lines.groupBy(*by).agg(
        F.sum(units).alias("returned_units"),
        F.coalesce(sum_where(units, F.col("is_reason_missing")), F.lit(0))
        .alias("unknown_units"),
    ).withColumn("unknown_reason_rate",
                 rate(F.col("unknown_units"), F.col("returned_units")))


def concentration(order_lines: DataFrame, entity: str, segment: str,
                  top_fraction: float) -> DataFrame:
    """Per segment, the share of failed-delivery cost held by its most expensive entities.

    ``segment`` is a vocabulary column such as the category or the payment method.
    """
    cost = order_lines.groupBy(segment, entity).agg(
        F.sum("rto_cost_aed").cast(AMOUNT).alias("cost"))
    falling = Ordered(cost, [F.col(segment).asc_nulls_last(), F.col("cost").desc(),
                             F.col(entity).asc()])
    ranked = (falling.position("_at", (segment,), "_n")
              .tie_rank("_at", "_rank", (segment, "cost")).rows)
    top = percent_rank(F.col("_rank"), F.col("_n")) <= top_fraction
    return ranked.groupBy(segment).agg(
        F.count(F.lit(1)).alias("entities"), count_where(top).alias("top_entities"),
        F.sum("cost").cast(AMOUNT).alias("rto_cost"),
        half_up(quotient(sum_where(F.col("cost"), top), F.sum("cost")), 6)
        .alias("concentration"))


def listing_months(order_lines: DataFrame, return_lines: DataFrame) -> DataFrame:
    """Listing measures per month: orders by order month, returns by initiation month."""
    delivered = F.col("is_delivered")
    sold = order_lines.groupBy(
        "listing_id", month_key(F.col("order_date_key")).alias("month")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        count_where(delivered).alias("delivered_orders"),
        count_where(F.col("is_shipped")).alias("shipped_orders"),
        count_where(F.col("is_rto")).alias("rto_orders"),
        F.sum("gross_margin_aed").alias("gross_margin"))
    back = return_lines.groupBy(
        "listing_id", month_key(F.col("return_initiated_date_key")).alias("month")).agg(
        F.count(F.lit(1)).alias("returned_orders"),
        F.sum("return_cost_aed").alias("return_cost"))
    counts = ["total_orders", "delivered_orders", "shipped_orders", "rto_orders",
              "returned_orders"]
    merged = sold.join(back, ["listing_id", "month"], "full").fillna(0, counts)
    margin, cost = (F.coalesce(F.col(c), F.lit(0)).cast(AMOUNT)
                    for c in ("gross_margin", "return_cost"))
    return merged.select(
        "listing_id", "month", *counts,
        rate(F.col("rto_orders"), F.col("shipped_orders")).alias("rto_rate"),
        margin.alias("gross_margin"), cost.alias("return_cost"),
        (margin - cost).cast(AMOUNT).alias("net_margin_after_returns"))


def traffic_funnel(traffic: DataFrame, *by: str) -> DataFrame:
    """Impressions, views and carts with their conversion rates."""
    stages = ("impressions", "detail_page_views", "add_to_carts")
    return traffic.groupBy(*by).agg(*[F.sum(s).cast("bigint").alias(s) for s in stages]) \
        .withColumns({
            "view_rate": rate(F.col("detail_page_views"), F.col("impressions")),
            "cart_rate": rate(F.col("add_to_carts"), F.col("detail_page_views")),
        })
