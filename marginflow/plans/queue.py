"""Ranked action queue: each proposed fix with one comparable amount, none counted twice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import half_up
from marginflow.functions.text import whole
from marginflow.operators.ranking import Ordered, tile
from marginflow.settings import INTERVENTIONS, Settings
from marginflow.sources.scratch import durable

QUEUE_COLUMNS = (
    "intervention_id", "entity_type", "entity_id", "category", "seller_id", "intervention_type",
    "intervention_reason", "priority", "priority_opportunity_aed",
    "estimated_return_cost_reduction", "estimated_margin_recovery",
    "estimated_recoverable_profit", "listing_quality_score", "trust_score",
    "catalog_return_rate", "rto_rate", "return_cost", "gross_margin",
    "net_margin_after_returns", "recommended_owner", "expected_business_outcome",
    "recommendation_summary", "global_priority_rank", "category_priority_rank",
)
AMOUNT = "decimal(38,4)"


def listing_class(settings: Settings) -> Column:
    """``delist`` before ``catalog``; NULL when neither applies."""
    net, score = F.col("net_margin_after_returns"), F.col("listing_quality_score")
    floor = settings.min_opportunity_aed
    beyond_repair = (net < 0) & (score < settings.delist_lqs) & (-net >= floor)
    improvable = (score < settings.lqs_cutoff) & (F.col("recoverable_profit") >= floor)
    return F.when(beyond_repair, "delist").when(improvable, "catalog")


def classify_listings(listings: DataFrame, settings: Settings) -> DataFrame:
    """Listings with an action, from the listing mart with its carried columns."""
    return (listings.withColumn("intervention_class", listing_class(settings))
            .filter(F.col("intervention_class").isNotNull()))


def coached_sellers(candidates: DataFrame, settings: Settings) -> DataFrame:
    """Sellers with so many improvable listings that they are coached as a whole."""
    return (candidates.filter("intervention_class = 'catalog'").groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("catalog_listing_count"),
        F.sum("recoverable_profit").cast(AMOUNT).alias("total_recoverable_profit"),
        F.sum("catalog_return_cost").cast(AMOUNT).alias("total_catalog_return_cost"),
    ).filter(F.col("catalog_listing_count") >= settings.coach_min_listings))


def _entry(kind: str, entity_id: Column, category: Column, reason: Column, summary: Column,
           opportunity: Column, cost_reduction: Column, score: Column) -> list[Column]:
    """The common queue shape."""
    prefix, entity, owner, outcome = INTERVENTIONS[kind]
    return [
        F.concat(F.lit(f"{prefix}-"), entity_id.cast("string")).alias("intervention_id"),
        F.lit(entity).alias("entity_type"),
        entity_id.cast("string").alias("entity_id"),
        category.alias("category"), F.col("seller_id"),
        F.lit(kind).alias("intervention_type"), reason.alias("intervention_reason"),
        opportunity.cast(AMOUNT).alias("opportunity"),
        cost_reduction.cast(AMOUNT).alias("cost_reduction"),
        score.cast("double").alias("listing_quality_score"),
        F.col("trust_score").cast("double").alias("trust_score"),
        F.col("catalog_return_rate"), F.col("rto_rate"),
        *[F.col(c).cast(AMOUNT).alias(c)
          for c in ("return_cost", "gross_margin", "net_margin_after_returns")],
        F.lit(owner).alias("recommended_owner"),
        F.lit(outcome).alias("expected_business_outcome"),
        summary.alias("recommendation_summary"),
    ]


def _text(*parts: Column | str) -> Column:
    """Concatenation that skips missing values."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(""))
                      for p in parts])


def _with_trust(candidates: DataFrame, sellers: DataFrame) -> DataFrame:
    return candidates.join(sellers.select("seller_id", "trust_score"), "seller_id")


def catalog_fixes(candidates: DataFrame, coached: DataFrame, sellers: DataFrame) -> DataFrame:
    """Single listings to improve, unless their seller is coached."""
    kept = (candidates.filter("intervention_class = 'catalog'")
            .join(coached.select("seller_id"), "seller_id", "left_anti"))
    gain = F.col("recoverable_profit")
    return _with_trust(kept, sellers).select(*_entry(
        "Catalog Fix", F.col("listing_id"), F.col("category"),
        _text("Low LQS (", whole(F.col("listing_quality_score")), ") with AED ", whole(gain),
              " catalog-return leakage"),
        _text("Fix catalog for ", F.col("listing_id"), " to recover ~AED ", whole(gain)),
        gain, F.col("catalog_return_cost"), F.col("listing_quality_score")))


def delistings(candidates: DataFrame, sellers: DataFrame) -> DataFrame:
    """Loss-making listings beyond repair; the opportunity is the loss that stops."""
    loss = -F.col("net_margin_after_returns")
    kept = candidates.filter("intervention_class = 'delist'")
    return _with_trust(kept, sellers).select(*_entry(
        "Delisting Candidate", F.col("listing_id"), F.col("category"),
        _text("Loss-making (net AED ", whole(F.col("net_margin_after_returns")),
              ") with very low LQS (", whole(F.col("listing_quality_score")), ")"),
        _text("Delist ", F.col("listing_id"), " to stop ~AED ", whole(loss), " net loss"),
        loss, loss, F.col("listing_quality_score")))


def coachings(coached: DataFrame, sellers: DataFrame) -> DataFrame:
    """Sellers whose listings are improved together."""
    gain, count = F.col("total_recoverable_profit"), F.col("catalog_listing_count")
    return coached.join(sellers, "seller_id").select(*_entry(
        "Seller Coaching", F.col("seller_id"), F.col("primary_category"),
        _text("Systemic catalog issues across ", count, " listings, AED ", whole(gain),
              " recoverable"),
        _text("Coach seller ", F.col("seller_id"), " (", count, " listings) to recover ~AED ",
              whole(gain)),
        gain, F.col("total_catalog_return_cost"), F.col("average_listing_quality_score")))


def cod_risks(sellers: DataFrame, settings: Settings) -> DataFrame:
    """Sellers with the most expensive failed deliveries."""
    cost = F.col("seller_rto_cost")
    kept = sellers.filter(F.col("is_top_decile_rto_cost")
                          & (cost >= settings.min_opportunity_aed))
    return kept.select(*_entry(
        "COD Risk Reduction", F.col("seller_id"), F.col("primary_category"),
        _text("Top-decile RTO cost (AED ", whole(cost), "), RTO rate ",
              half_up(F.col("rto_rate"), 3)),
        _text("Mitigate COD RTO for seller ", F.col("seller_id"), " to avoid ~AED ",
              whole(cost)),
        cost, cost, F.col("average_listing_quality_score")))


def proposals(listings: DataFrame, sellers: DataFrame, settings: Settings) -> DataFrame:
    """All four kinds of action, unranked."""
    candidates = classify_listings(listings, settings)
    coached = coached_sellers(candidates, settings)
    sets = [catalog_fixes(candidates, coached, sellers), delistings(candidates, sellers),
            coachings(coached, sellers), cod_risks(sellers, settings)]
    return reduce(DataFrame.unionByName, sets)


def intervention_queue(listings: DataFrame, sellers: DataFrame,
                       settings: Settings) -> DataFrame:
    """The queue with its tertile band and its ranks overall and per category.

    One range shuffle serves all three: the rows are placed once, and the position inside a
    category counts the earlier rows of that category.
    """
    by_amount = Ordered(durable(proposals(listings, sellers, settings), "proposals"), [
        F.col("opportunity").desc(), F.col("entity_type").asc(), F.col("entity_id").asc(),
        F.col("intervention_type").asc()])
    ranked = (by_amount.position("global_priority_rank", count_name="_all_rows")
              .position("category_priority_rank", ("category",)).rows)
    third = tile(F.col("global_priority_rank"), F.col("_all_rows"), 3)
    recovered, reduced = F.round("opportunity", 2), F.round("cost_reduction", 2)
    return ranked.withColumns({
        "priority": F.when(third == 1, "High").when(third == 2, "Medium").otherwise("Low"),
        "priority_opportunity_aed": recovered,
        "estimated_return_cost_reduction": reduced,
        "estimated_margin_recovery": recovered - reduced,
        "estimated_recoverable_profit": recovered,
        "listing_quality_score": half_up(F.col("listing_quality_score"), 2),
        **{c: F.round(c, 2) for c in ("return_cost", "gross_margin",
                                      "net_margin_after_returns")},
    }).select(*QUEUE_COLUMNS)
