"""Reconciliation checks of the business tables.

Each check is a row (check_name, value, pass). All checks of a table share one aggregation;
uniqueness counts keys with a shuffle of their own. Totals of another table are one row: known
since it was written (a mapping is given in its place), or else one scalar subquery over it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import count_where, half_up, quotient
from marginflow.operators.audit import union_all
from marginflow.operators.cleaning import duplicate_keys
from marginflow.plans.listing import category_signal_weights
from marginflow.plans.queue import listing_class
from marginflow.settings import (
    CANCELLED, DELIVERED, INTERVENTIONS, KPI_REGISTER, RTO_STATUSES, Settings,
)

CENT = 0.01


# -- check shapes ------------------------------------------------------------------------------
def outcome(name: str, passed: Column, value: Column | None = None) -> Column:
    number = F.lit(None) if value is None else value
    return F.struct(F.lit(name).alias("check_name"), number.cast("double").alias("value"),
                    F.coalesce(passed, F.lit(False)).alias("pass"))


def expect_zero(name: str, violation: Column) -> Column:
    """No row may meet the condition."""
    bad = count_where(violation)
    return outcome(name, bad == 0, bad)


def expect_bounds(name: str, columns: Sequence[str], low: float = 0, high: float = 1,
                  value: Column | None = None) -> Column:
    """All known values of the columns lie in the closed interval."""
    passed = F.lit(True)
    for c in columns:
        passed = passed & F.coalesce((F.min(c) >= low) & (F.max(c) <= high), F.lit(True))
    return outcome(name, passed, value)


def expect_close(name: str, pairs: Sequence[tuple[Column, Column]], tolerance: float = CENT,
                 value: Column | None = None) -> Column:
    """Each pair of totals agrees within the tolerance."""
    passed = F.lit(True)
    for a, b in pairs:
        passed = passed & (F.abs(a.cast("double") - b.cast("double")) < tolerance)
    return outcome(name, passed, value)


def expect_equal(name: str, pairs: Sequence[tuple[Column, Column]],
                 value: Column | None = None) -> Column:
    passed = F.lit(True)
    for a, b in pairs:
        passed = passed & (a == b)
    return outcome(name, passed, value)


def any_null(*columns: str) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out


def repeats(df: DataFrame, *key: str) -> Column:
    """How many rows exceed one per key, NULL keys included: a scalar subquery."""
    extra = duplicate_keys(df, key).agg(
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).cast("bigint"))
    return extra.scalar()


def total(df: DataFrame, value: Column) -> Column:
    return df.agg(value).scalar()


def _sums(source: DataFrame | Mapping[str, object],
          aggregates: Mapping[str, Column]) -> Callable[[str], Column]:
    """Name -> total of a table, which is asked once for all of them, or never."""
    if not isinstance(source, DataFrame):
        return lambda name: F.lit(source[name])
    one = source.agg(F.struct(*[v.alias(k) for k, v in aggregates.items()])).scalar()
    return lambda name: one[name]


def run(df: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return df.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


def rows() -> Column:
    return F.count(F.lit(1))


# -- totals that the checks of other tables need -----------------------------------------------
def order_source_totals() -> dict[str, Column]:
    """Of the cleaned order lines."""
    status = F.col("order_status")
    flags = {"is_delivered": status == DELIVERED, "is_rto": status.isin(*RTO_STATUSES),
             "is_cancelled": status == CANCELLED, "is_shipped": status != CANCELLED}
    return {"rows": rows(), **{flag: count_where(c) for flag, c in flags.items()}}


def return_source_totals() -> dict[str, Column]:
    return {"rows": rows()}


def order_line_totals() -> dict[str, Column]:
    return {"rows": rows(), "delivered": count_where(F.col("is_delivered")),
            "rto": count_where(F.col("is_rto")), "gross_margin": F.sum("gross_margin_aed"),
            "rto_cost": F.sum("rto_cost_aed")}


def return_line_totals() -> dict[str, Column]:
    return {"rows": rows(), "return_cost": F.sum("return_cost_aed"),
            "recovered": F.sum("recovered_value_aed"), "returned": F.sum("returned_value_aed")}


def listing_totals(settings: Settings) -> dict[str, Column]:
    counted = ("total_orders", "delivered_orders", "rto_orders", "returned_orders",
               "gross_margin", "return_cost", "recoverable_profit")
    return {"rows": rows(), **{c: F.sum(c) for c in counted},
            "lossy": count_where(F.col("net_margin_after_returns") < 0),
            "eligible": F.coalesce(F.sum(F.when(listing_class(settings) == "catalog",
                                                F.col("recoverable_profit"))), F.lit(0))}


def seller_totals() -> dict[str, Column]:
    return {c: F.sum(c) for c in ("gross_margin", "return_cost")}


def category_totals(settings: Settings) -> dict[str, Column]:
    focus = F.col("category") == settings.focus_category
    return {**{c: F.sum(c) for c in ("gross_margin", "return_cost", "recoverable_profit")},
            **{f"focus_{c}": F.max(F.when(focus, F.col(f"percentage_of_marketplace_{c}")))
               for c in ("return_cost", "recoverable_profit")}}


# -- checks per table --------------------------------------------------------------------------
Totals = DataFrame | Mapping[str, object]


def order_line_checks(order_lines: DataFrame, orders: Totals) -> DataFrame:
    source = _sums(orders, order_source_totals())
    expected = [(count_where(F.col(flag)), F.max(source(flag)))
                for flag in order_source_totals() if flag != "rows"]
    extra = repeats(order_lines, "order_line_id")
    return run(order_lines, [
        expect_equal("row_count", [(rows(), F.max(source("rows")))], rows()),
        outcome("pk_unique", (F.max(extra) == 0) & (F.count("order_line_id") == rows()), rows()),
        expect_equal("status_reconciliation", expected),
        expect_zero("margin_delivered_only",
                    F.col("gross_margin_aed").isNotNull() & ~F.col("is_delivered")),
        expect_zero("invalid_qty_excluded",
                    F.col("is_quantity_invalid") & F.col("gross_margin_aed").isNotNull()),
        outcome("margin_pct_and_revenue_bounds",
                (F.min("gross_margin_pct") >= 0) & (F.max("gross_margin_pct") <= 1)
                & (F.coalesce(F.min("realized_net_revenue_aed"), F.lit(0)) >= 0)),
        outcome("rto_cost_scoped",
                (count_where((F.col("rto_cost_aed") > 0) & ~F.col("is_rto")) == 0)
                & (count_where(F.col("is_rto") & (F.col("rto_cost_aed") <= 0)) == 0),
                count_where((F.col("rto_cost_aed") > 0) & ~F.col("is_rto"))),
        expect_zero("no_unresolved_dimensions",
                    any_null("category", "gross_margin_pct", "logistics_zone", "weight_band")),
    ])


def return_line_checks(return_lines: DataFrame, order_lines: DataFrame,
                       returns: Totals) -> DataFrame:
    source = _sums(returns, return_source_totals())
    undelivered = (return_lines.select("order_line_id")
                   .join(order_lines.filter(~F.col("is_delivered")).select("order_line_id"),
                         "order_line_id"))
    strays = total(undelivered, rows())
    extra = repeats(return_lines, "return_id")
    recovered, value = F.col("recovered_value_aed"), F.col("returned_value_aed")
    reverse, handling = F.col("reverse_logistics_cost_aed"), F.col("handling_cost_aed")
    ratio = quotient(F.sum(recovered), F.sum(value))
    return run(return_lines, [
        expect_equal("row_count", [(rows(), F.max(source("rows")))], rows()),
        outcome("pk_unique", (F.max(extra) == 0) & (F.count("return_id") == rows()), rows()),
        outcome("golden_rule_2_delivered_only", F.max(strays) == 0, F.max(strays)),
        expect_zero("recovered_le_returned", recovered > value),
        expect_bounds("recovery_pct_bounds", ["recovery_pct"]),
        expect_zero("writeoff_zero_recovery",
                    (F.col("item_condition_on_receipt") == "write_off") & (recovered != 0)),
        expect_zero("cost_components_positive",
                    reverse.isNull() | (reverse <= 0) | (handling <= 0)),
        expect_zero("return_cost_identity",
                    F.round(reverse + handling + F.col("merchandise_loss_aed"), 4)
                    != F.col("return_cost_aed")),
        outcome("recovery_rate_aggregate", ratio.between(0, 1), half_up(ratio, 4)),
    ])


def listing_checks(listings: DataFrame, order_lines: Totals, return_lines: Totals,
                   dimension: DataFrame) -> DataFrame:
    sold, back = _sums(order_lines, order_line_totals()), _sums(return_lines, return_line_totals())
    weights = (category_signal_weights(dimension).groupBy("category")
               .agg(F.sum("weight").alias("w")))
    off = total(weights, count_where(F.abs(F.col("w") - 1) > 1e-9))
    extra = repeats(listings, "listing_id")
    mandatory = any_null("listing_quality_score", "gross_margin", "return_cost",
                         "net_margin_after_returns", "recoverable_profit")
    undefined = (
        (F.col("catalog_return_rate").isNull() & (F.col("delivered_units") > 0))
        | (F.col("rto_rate").isNull() & (F.col("shipped_orders") > 0))
        | (F.col("recovery_rate").isNull() & (F.col("returned_units") > 0)))
    facts_recovery = quotient(back("recovered"), back("returned"))
    recovery = quotient(F.sum("recovered_value"), F.sum("returned_value"))
    return run(listings, [
        expect_equal("row_count", [(rows(), total(dimension, rows()))], rows()),
        outcome("one_row_per_listing",
                (F.max(extra) == 0) & (F.count("listing_id") == rows()), F.max(extra)),
        outcome("lqs_bounds",
                (F.min("listing_quality_score") >= 0) & (F.max("listing_quality_score") <= 100)
                & (count_where(F.col("listing_quality_score").isNull()) == 0),
                F.max("listing_quality_score")),
        outcome("lqs_weights_sum_to_1", F.max(off) == 0, F.max(off)),
        expect_bounds("rate_bounds_0_1", [
            "catalog_return_rate", "rto_rate", "recovery_rate", "on_time_delivery_rate",
            "damage_return_share"]),
        expect_zero("margin_identity", _identity_broken()),
        outcome("null_rules", (count_where(mandatory) == 0) & (count_where(undefined) == 0),
                count_where(mandatory)),
        outcome("reconcile_foundational", _all(
            F.sum("total_orders") == F.max(sold("rows")),
            F.sum("delivered_orders") == F.max(sold("delivered")),
            F.sum("rto_orders") == F.max(sold("rto")),
            F.sum("returned_orders") == F.max(back("rows")),
            _near(F.sum("gross_margin"), sold("gross_margin")),
            _near(F.sum("return_cost"), back("return_cost")),
            _near(F.sum("rto_cost"), sold("rto_cost")))),
        outcome("recovery_rate_reconcile",
                F.abs(recovery - F.max(facts_recovery)) < 1e-6, half_up(recovery, 4)),
    ])


def _near(own: Column, other: Column, tolerance: float = CENT) -> Column:
    return F.abs(own.cast("double") - F.max(other).cast("double")) < tolerance


def _all(*conditions: Column) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _identity_broken() -> Column:
    return F.abs(F.col("net_margin_after_returns")
                 - (F.col("gross_margin") - F.col("return_cost"))) > 0.001


def seller_checks(sellers: DataFrame, listings: Totals, order_lines: Totals,
                  return_lines: Totals, dimension: DataFrame, settings: Settings) -> DataFrame:
    sold, back = _sums(order_lines, order_line_totals()), _sums(return_lines, return_line_totals())
    listed = _sums(listings, listing_totals(settings))
    undefined = (
        (F.col("catalog_return_rate").isNull() & (F.col("delivered_units") > 0))
        | (F.col("rto_rate").isNull() & (F.col("shipped_orders") > 0))
        | (F.col("recovery_rate").isNull() & (F.col("returned_units") > 0)))
    mandatory = any_null("trust_score", "gross_margin", "return_cost",
                         "net_margin_after_returns", "seller_tier")
    first = F.max(F.when(F.col("rto_cost_rank") == 1, F.col("seller_rto_cost")))
    return run(sellers, [
        outcome("row_count", (rows() == F.max(total(dimension, rows())))
                & (F.max(repeats(sellers, "seller_id")) == 0), rows()),
        outcome("trust_score_bounds",
                (F.min("trust_score") >= 0) & (F.max("trust_score") <= 100)
                & (count_where(F.col("trust_score").isNull()) == 0), F.min("trust_score")),
        outcome("reconcile_listing_mart", _all(
            F.sum("listing_count") == F.max(listed("rows")),
            *[F.sum(c) == F.max(listed(c))
              for c in ("total_orders", "delivered_orders", "rto_orders", "returned_orders")],
            _near(F.sum("recoverable_profit"), listed("recoverable_profit")))),
        outcome("gross_margin_reconcile",
                _near(F.sum("gross_margin"), sold("gross_margin")),
                F.round(F.sum("gross_margin"), 2)),
        outcome("return_cost_reconcile",
                _near(F.sum("return_cost"), back("return_cost")),
                F.round(F.sum("return_cost"), 2)),
        expect_zero("margin_identity", _identity_broken()),
        outcome("ranking_consistency",
                (F.max(repeats(sellers, "rto_cost_rank")) == 0)
                & (F.max("rto_cost_rank") == rows()) & (first == F.max("seller_rto_cost")),
                F.max("rto_cost_rank")),
        expect_bounds("rate_and_percentile_bounds", [
            "catalog_return_rate", "rto_rate", "recovery_rate", "on_time_delivery_rate",
            "seller_percentile_within_category"]),
        outcome("null_rules", (count_where(mandatory) == 0) & (count_where(undefined) == 0),
                count_where(mandatory)),
    ])


def category_checks(categories: DataFrame, listings: DataFrame, settings: Settings,
                    listing_sums: Mapping[str, object] | None = None) -> DataFrame:
    listed = _sums(listings if listing_sums is None else listing_sums, listing_totals(settings))
    ranks = [f"category_rank_by_{r}" for r in
             ("margin_loss", "return_cost", "recoverable_profit")]
    shares = ["percentage_of_marketplace_return_cost",
              "percentage_of_marketplace_recoverable_profit"]
    distinct = [F.count_distinct(r) for r in ranks]  # as many rows as categories
    mandatory = any_null("gross_margin", "return_cost", "recoverable_profit",
                         "net_margin_after_returns", "average_listing_quality_score",
                         "average_trust_score", "recovery_rate", "catalog_return_rate",
                         "rto_rate", "on_time_delivery_rate")
    known = total(listings.select("category").distinct(), rows())
    extra = repeats(categories, "category")

    def reconcile(column: str) -> Column:
        return outcome(f"{column}_reconcile",
                       _near(F.sum(column), listed(column)),
                       F.round(F.sum(column), 2))

    return run(categories, [
        outcome("row_count", rows() == F.max(known), rows()),
        outcome("one_row_per_category",
                (F.max(extra) == 0) & (F.count("category") == rows()), F.max(extra)),
        reconcile("gross_margin"), reconcile("return_cost"), reconcile("recoverable_profit"),
        outcome("order_counts_reconcile", _all(*[
            F.sum(c) == F.max(listed(c))
            for c in ("total_orders", "delivered_orders", "returned_orders", "rto_orders")]),
            F.sum("total_orders")),
        expect_bounds("rate_bounds_0_1", ["recovery_rate", "catalog_return_rate", "rto_rate",
                                          "on_time_delivery_rate"]),
        expect_bounds("percentage_bounds", shares),
        outcome("ranking_uniqueness", _all(*[d == rows() for d in distinct]), distinct[0]),
        expect_zero("null_rules", mandatory),
        outcome("percentages_sum_to_1", _all(*[
            F.abs(F.sum(F.col(s).cast("decimal(9,6)")) - 1) < F.lit("0.000001").cast(
                "decimal(9,6)") for s in shares]),
            F.sum(F.col(shares[0]).cast("decimal(9,6)"))),
        expect_zero("financial_identity", _identity_broken()),
    ])


def executive_checks(summary: DataFrame, listings: Totals, sellers: Totals,
                     categories: Totals, order_lines: Totals, return_lines: Totals,
                     settings: Settings) -> DataFrame:
    sold, back = _sums(order_lines, order_line_totals()), _sums(return_lines, return_line_totals())
    listed, grouped = (_sums(listings, listing_totals(settings)),
                       _sums(categories, category_totals(settings)))
    traded = _sums(sellers, seller_totals())

    def kpi(name: str) -> Column:
        return F.max(F.when(F.col("kpi_name") == name, F.col("kpi_value")))

    def within(*names: str) -> Column:
        return F.coalesce(F.bool_and(F.when(
            F.col("kpi_name").isin(*names), F.col("kpi_value").between(0, 1))), F.lit(False))

    def ties(name: str, column: str, *marts: Callable[[str], Column]) -> Column:
        return outcome(f"{column}_reconcile", _all(*[
            _near(kpi(name), mart(column)) for mart in marts]), half_up(kpi(name), 2))

    gap = kpi("net_margin_after_returns") - (kpi("total_gross_margin") - kpi("total_return_cost"))
    return run(summary, [
        outcome("kpi_names_unique", F.max(repeats(summary, "kpi_name")) == 0, rows()),
        outcome("kpi_count_range", rows().between(12, 20), rows()),
        expect_zero("no_null_values", F.col("kpi_value").isNull()),
        ties("total_gross_margin", "gross_margin", listed, grouped, traded),
        ties("total_return_cost", "return_cost", listed, grouped, traded),
        ties("total_recoverable_profit", "recoverable_profit", listed, grouped),
        outcome("rate_bounds_0_1", within("marketplace_catalog_return_rate",
                                          "marketplace_rto_rate", "aggregate_recovery_rate")),
        outcome("toxic_rto_concentration_bounds", within("toxic_rto_concentration"),
                half_up(kpi("toxic_rto_concentration"), 4)),
        outcome("bottom_lqs_share_bounds", within("bottom_lqs_revenue_share",
                                                  "bottom_lqs_return_cost_share")),
        outcome("fashion_shares_reconcile", _all(*[
            _near(kpi(f"fashion_{c}_share"), grouped(f"focus_{c}"), 1e-6)
            for c in ("return_cost", "recoverable_profit")]),
            half_up(kpi("fashion_return_cost_share"), 6)),
        outcome("loss_making_reconcile",
                kpi("loss_making_listing_count") == F.max(listed("lossy")),
                kpi("loss_making_listing_count")),
        outcome("order_counts_reconcile", _all(
            kpi("total_orders") == F.max(sold("rows")),
            kpi("delivered_orders") == F.max(sold("delivered")),
            kpi("returned_orders") == F.max(back("rows")),
            kpi("rto_orders") == F.max(sold("rto"))),
            kpi("total_orders")),
        outcome("financial_identity", F.abs(gap) < CENT, half_up(gap, 4)),
    ])


def queue_checks(queue: DataFrame, listings: Totals, settings: Settings) -> DataFrame:
    eligible = _sums(listings, listing_totals(settings))("eligible")
    opportunity, cut, margin, profit = (F.col(c) for c in (
        "priority_opportunity_aed", "estimated_return_cost_reduction",
        "estimated_margin_recovery", "estimated_recoverable_profit"))
    kinds = list(INTERVENTIONS)
    owners = [owner for _, _, owner, _ in INTERVENTIONS.values()]
    listing_kinds = [k for k, v in INTERVENTIONS.items() if v[1] == "listing"]
    wrong_entity = F.lit(False)
    for kind, (_, entity, _, _) in INTERVENTIONS.items():
        wrong_entity = wrong_entity | ((F.col("intervention_type") == kind)
                                       & (F.col("entity_type") != entity))
    twice = total(duplicate_keys(queue.filter(F.col("intervention_type").isin(*listing_kinds)),
                                 ["entity_id"]), rows())
    per_category = queue.groupBy("category").agg(
        F.min("category_priority_rank").alias("low"),
        F.max("category_priority_rank").alias("high"), rows().alias("n"))
    uneven = total(per_category, count_where((F.col("low") != 1) | (F.col("high") != F.col("n"))))
    repeated = F.max(repeats(queue, "category", "category_priority_rank"))
    catalog = F.coalesce(F.sum(F.when(F.col("intervention_type").isin(
        "Catalog Fix", "Seller Coaching"), profit)), F.lit(0))
    rank = F.col("global_priority_rank")
    first = F.max(F.when(rank == 1, opportunity))
    unbalanced = (F.abs(cut + margin - profit) > CENT) | (F.abs(profit - opportunity) > CENT)
    impossible = count_where(wrong_entity) + F.max(twice)
    return run(queue, [
        outcome("no_duplicate_intervention_id",
                F.max(repeats(queue, "intervention_id")) == 0, rows()),
        outcome("global_rank_unique",
                F.max(repeats(queue, "global_priority_rank")) == 0, rows()),
        expect_zero("no_null_priority",
                    any_null("priority", "priority_opportunity_aed", "global_priority_rank")),
        expect_zero("financial_reconcile", unbalanced),
        outcome("opportunity_non_negative", _all(*[
            F.min(c) >= 0 for c in (opportunity, cut, margin, profit)]), F.min(opportunity)),
        expect_zero("valid_intervention_types", ~F.col("intervention_type").isin(*kinds)),
        expect_zero("valid_owners", ~F.col("recommended_owner").isin(*owners)),
        outcome("global_ranks_consecutive", (F.min(rank) == 1) & (F.max(rank) == rows()),
                F.max(rank)),
        outcome("category_ranks_consecutive", (F.max(uneven) == 0) & (repeated == 0),
                F.max(uneven)),
        outcome("opportunity_ordering", first == F.max(opportunity), first),
        outcome("no_impossible_combinations", impossible == 0, impossible),
        outcome("catalog_recoverable_reconcile", _near(catalog, eligible),
                F.round(catalog, 2)),
    ])


def row_count_regression(tables: Mapping[str, DataFrame],
                         expected: Mapping[str, Column]) -> DataFrame:
    """(table_name, expected, actual, pass) in build order."""
    return union_all([
        tables[name].agg(rows().alias("actual")).select(
            F.lit(name).alias("table_name"), count.cast("bigint").alias("expected"), "actual",
            (F.col("actual") == count).alias("pass"))
        for name, count in expected.items()])


def expected_counts(cleaned, known: Mapping[str, Mapping[str, object]] | None = None
                    ) -> dict[str, Column]:
    """What each business table must count, from the cleaned layer (name -> scalar). ``known``
    has totals of cleaned tables that were counted already."""
    listings, known = cleaned("dim_listing"), known or {}

    def lines(name: str) -> Column:
        return F.lit(known[name]["rows"]) if name in known else total(cleaned(name), rows())

    return {
        "gold_order_line_economics": lines("fact_orders"),
        "gold_return_line_economics": lines("fact_returns"),
        "gold_listing_metrics": total(listings, rows()),
        "gold_seller_metrics": total(cleaned("dim_seller"), rows()),
        "gold_category_metrics": total(listings.select("category").distinct(), rows()),
        "gold_executive_summary": F.lit(len(KPI_REGISTER)),
    }
