"""One configuration object for contracts, cleaning rules and metric parameters.

Everything tunable lives here once; plans and operators receive it as an argument. The
module-level tables below hold fixed business values: they have to carry exactly these
numbers and spellings for results to agree with the published metric definitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# vocabularies
# ---------------------------------------------------------------------------
NULL_TOKENS = ("", "nan", "null", "na", "none", "n/a", "-")
CATEGORIES = ("Fashion", "Electronics", "Home", "Beauty", "Sports")
UNMAPPED_CATEGORY = "Unknown"
PAYMENT_METHODS = ("cod", "card", "wallet", "bnpl")
ITEM_CONDITIONS = ("resellable", "refurbishable", "write_off")
FULFILLMENT_TYPES = ("marketplace_fulfilled", "seller_fulfilled")
SELLER_COUNTRIES = ("local", "cross_border")
DELIVERED = "delivered"
CANCELLED = "cancelled_pre_shipment"
RTO_STATUSES = ("rto_customer_refused", "rto_unreachable")
ORDER_STATUSES = (DELIVERED, CANCELLED, *RTO_STATUSES)
FORBIDDEN_COLUMN_TOKENS = (
    "listingqualityscore", "lqs", "trustscore", "returncost", "recoverableprofit",
)

# Category, gross margin, handling AED, recovery resellable, recovery refurbishable
CATEGORY_ECONOMICS = (
    ("Fashion", "0.50", "8.0", "0.92", "0.55"),
    ("Electronics", "0.14", "9.0", "0.88", "0.50"),
    ("Home", "0.35", "7.0", "0.90", "0.52"),
    ("Beauty", "0.55", "6.0", "0.75", "0.35"),
    ("Sports", "0.38", "7.5", "0.90", "0.52"),
)

# Upper bound in kg and band name; heavier or unknown weights take the last name
WEIGHT_BANDS = ((0.5, "<=0.5kg"), (2.0, "0.5-2kg"), (5.0, "2-5kg"))
HEAVIEST_BAND = "5-15kg"

# Zone, band, forward AED, reverse AED
RATE_CARD = (
    ("urban_core", "<=0.5kg", "9.0", "10.35"),
    ("urban_core", "0.5-2kg", "12.0", "13.8"),
    ("urban_core", "2-5kg", "17.0", "19.55"),
    ("urban_core", "5-15kg", "26.0", "29.9"),
    ("suburban", "<=0.5kg", "12.0", "13.8"),
    ("suburban", "0.5-2kg", "15.0", "17.25"),
    ("suburban", "2-5kg", "21.0", "24.15"),
    ("suburban", "5-15kg", "32.0", "36.8"),
    ("remote", "<=0.5kg", "18.0", "20.7"),
    ("remote", "0.5-2kg", "23.0", "26.45"),
    ("remote", "2-5kg", "31.0", "35.65"),
    ("remote", "5-15kg", "48.0", "55.2"),
)

# Code, description, group, catalog related, refund eligible
RETURN_REASONS = (
    ("R001", "Item not as described", "catalog_mismatch", True, True),
    ("R002", "Wrong size / fit issue", "sizing", True, True),
    ("R003", "Missing product information", "catalog_mismatch", True, True),
    ("R004", "Damaged on arrival", "damaged", False, True),
    ("R005", "Product defective", "damaged", False, True),
    ("R006", "Changed my mind", "remorse", False, False),
    ("R007", "Ordered by mistake", "remorse", False, False),
    ("R008", "Late delivery", "delivery_issue", False, True),
    ("R009", "Wrong item delivered", "delivery_issue", False, True),
    ("R010", "Duplicate order", "remorse", False, False),
)

# The weight of each catalog signal and the category-specific replacements
SIGNAL_WEIGHTS = {
    "image_sufficiency": 0.20,
    "has_video": 0.10,
    "title_adequacy": 0.10,
    "description_adequacy": 0.15,
    "specifications_filled_pct": 0.20,
    "has_size_chart": 0.10,
    "has_dimensions_listed": 0.05,
    "variant_sufficiency": 0.10,
}
SIGNAL_OVERRIDES = {
    "Fashion": {"has_size_chart": 0.25, "specifications_filled_pct": 0.10},
    "Home": {"has_dimensions_listed": 0.20, "has_size_chart": 0.0},
    "Electronics": {"specifications_filled_pct": 0.30, "has_size_chart": 0.0},
}
# Input at which a signal earns full credit
SIGNAL_TARGETS = {"image_count": 5, "title_length_chars": 40,
                  "description_length_chars": 300, "variant_count": 3}

# Trust components
TRUST_WEIGHTS = {
    "on_time_delivery_rate": 0.25,
    "inverse_rto_rate": 0.20,
    "inverse_catalog_return_rate": 0.20,
    "inverse_damage_return_share": 0.10,
    "delivery_attempt_efficiency": 0.10,
    "mean_listing_quality_score": 0.10,
    "seller_tier_prior": 0.05,
}
TIER_PRIOR = {"T1": 1.0, "T2": 0.67, "T3": 0.33}

# KPI name, label, group, unit (display order is the position)
KPI_REGISTER = (
    ("total_orders", "Total Orders", "Volume", "count"),
    ("delivered_orders", "Delivered Orders", "Volume", "count"),
    ("returned_orders", "Returned Orders", "Volume", "count"),
    ("rto_orders", "RTO Orders", "Volume", "count"),
    ("total_gross_margin", "Total Gross Margin", "Financial", "aed"),
    ("total_return_cost", "Total Return Cost", "Financial", "aed"),
    ("total_recoverable_profit", "Total Recoverable Profit", "Financial", "aed"),
    ("net_margin_after_returns", "Net Margin After Returns", "Financial", "aed"),
    ("marketplace_catalog_return_rate", "Marketplace Catalog Return Rate", "Rate", "rate"),
    ("marketplace_rto_rate", "Marketplace RTO Rate", "Rate", "rate"),
    ("aggregate_recovery_rate", "Aggregate Recovery Rate", "Rate", "rate"),
    ("toxic_rto_concentration", "Toxic RTO Concentration (top 10%)", "Risk", "share"),
    ("fashion_return_cost_share", "Fashion Share of Return Cost", "Risk", "share"),
    ("fashion_recoverable_profit_share", "Fashion Share of Recoverable Profit", "Risk", "share"),
    ("bottom_lqs_revenue_share", "Bottom-LQS Revenue Share", "Quality Risk", "share"),
    ("bottom_lqs_return_cost_share", "Bottom-LQS Return Cost Share", "Quality Risk", "share"),
    ("loss_making_listing_count", "Loss-Making Listings", "Quality Risk", "count"),
)

# Intervention type, id prefix, entity, owner, expected outcome
INTERVENTIONS = {
    "Catalog Fix": ("CATFIX", "listing", "Catalog Operations",
                    "Add images / specs / description to cut catalog-driven returns"),
    "Delisting Candidate": ("DELIST", "listing", "Category Management",
                            "Stop the margin bleed by delisting or renegotiating terms"),
    "Seller Coaching": ("COACH", "seller", "Seller Experience",
                        "Coach seller on catalog standards to fix issues at scale"),
    "COD Risk Reduction": ("CODRISK", "seller", "COD Risk Ops",
                           "Cut failed COD deliveries via prepaid nudges and address verification"),
}


# ---------------------------------------------------------------------------
# Table contracts (audit)
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    parent_column: str


@dataclass(frozen=True)
class Bounds:
    """Inclusive validity interval of a numeric column; ``quarantine`` also nulls offenders."""

    column: str
    low: float | None = None
    high: float | None = None
    quarantine: bool = False


@dataclass(frozen=True)
class Membership:
    """A closed vocabulary, either listed or taken from a parent column."""

    column: str
    label: str
    values: tuple[str, ...] = ()
    table: str | None = None
    parent_column: str | None = None


@dataclass(frozen=True)
class TableContract:
    key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    members: tuple[Membership, ...] = ()
    bounds: tuple[Bounds, ...] = ()
    funnel: tuple[str, ...] = ()
    delivered_only: bool = False


CALENDAR_TABLE = "dim_date"

CONTRACTS: dict[str, TableContract] = {
    "dim_date": TableContract(("date_key",)),
    "dim_geography": TableContract(("geo_id",)),
    "dim_return_reason": TableContract(("reason_code",)),
    "dim_seller": TableContract(("seller_id",)),
    "ref_category_economics": TableContract(("category",), bounds=(
        Bounds("gross_margin_pct", 0, 1),
        Bounds("recovery_pct_resellable", 0, 1),
        Bounds("recovery_pct_refurbishable", 0, 1),
        Bounds("warehouse_handling_cost_aed", 0),
    )),
    "ref_logistics_rate_card": TableContract(
        ("logistics_zone", "weight_band", "leg"), bounds=(Bounds("cost_aed", 0),)),
    "dim_listing": TableContract(
        ("listing_id",),
        (ForeignKey("seller_id", "dim_seller", "seller_id"),),
        (Membership("category", "ref_category_economics.category",
                    table="ref_category_economics", parent_column="category"),),
        (Bounds("price", 0), Bounds("discount_pct", 0, 1), Bounds("image_count", 0),
         Bounds("specifications_filled_pct", 0, 1), Bounds("item_weight_kg", 0),
         Bounds("variant_count", 0)),
    ),
    "fact_listing_traffic": TableContract(
        ("listing_id", "date_key"),
        (ForeignKey("listing_id", "dim_listing", "listing_id"),
         ForeignKey("date_key", "dim_date", "date_key")),
        bounds=(Bounds("impressions", 0), Bounds("detail_page_views", 0),
                Bounds("add_to_carts", 0)),
        funnel=("impressions", "detail_page_views", "add_to_carts"),
    ),
    "fact_orders": TableContract(
        ("order_line_id",),
        (ForeignKey("listing_id", "dim_listing", "listing_id"),
         ForeignKey("seller_id", "dim_seller", "seller_id"),
         ForeignKey("geo_id", "dim_geography", "geo_id"),
         ForeignKey("order_date_key", "dim_date", "date_key"),
         ForeignKey("promised_delivery_date_key", "dim_date", "date_key"),
         ForeignKey("actual_delivery_date_key", "dim_date", "date_key")),
        (Membership("order_status", "order_status_values", ORDER_STATUSES),),
        (Bounds("quantity", 1), Bounds("unit_selling_price", 0),
         Bounds("item_discount_amount", 0), Bounds("shipping_fee_charged", 0),
         Bounds("delivery_attempts", 0)),
    ),
    "fact_returns": TableContract(
        ("return_id",),
        (ForeignKey("order_line_id", "fact_orders", "order_line_id"),
         ForeignKey("reported_reason_code", "dim_return_reason", "reason_code"),
         ForeignKey("return_initiated_date_key", "dim_date", "date_key"),
         ForeignKey("return_received_date_key", "dim_date", "date_key")),
        bounds=(Bounds("quantity_returned", 1), Bounds("refund_amount", 0)),
        delivered_only=True,
    ),
}


# ---------------------------------------------------------------------------
# Cleaning rules
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class NullRule:
    """``fill`` a constant, ``flag_missing`` or ``keep``."""

    strategy: str
    value: object = None


@dataclass(frozen=True)
class CleaningRules:
    dedup_key: tuple[str, ...] = ()
    dedup_tie: tuple[str, ...] = ()
    category_column: str | None = None
    enums: dict[str, tuple[str, ...]] = field(default_factory=dict)
    nulls: dict[str, NullRule] = field(default_factory=dict)
    bounds: tuple[Bounds, ...] = ()
    temporal: str | None = None


CLEANING: dict[str, CleaningRules] = {
    "dim_seller": CleaningRules(
        dedup_key=("seller_id",),
        enums={"fulfillment_type": FULFILLMENT_TYPES, "seller_country": SELLER_COUNTRIES},
        nulls={"seller_tier": NullRule("fill", "Unknown")},
    ),
    "dim_listing": CleaningRules(
        dedup_key=("listing_id",),
        category_column="category",
        nulls={
            "brand": NullRule("fill", "Unknown"),
            "description_length_chars": NullRule("fill", 0),
            "specifications_filled_pct": NullRule("fill", 0.0),
            "has_size_chart": NullRule("fill", False),
            "has_dimensions_listed": NullRule("fill", False),
            "price": NullRule("flag_missing"),
            "item_weight_kg": NullRule("flag_missing"),
        },
        bounds=(Bounds("discount_pct", 0.0, 1.0, quarantine=True),
                Bounds("image_count", 0, quarantine=True)),
    ),
    "fact_listing_traffic": CleaningRules(
        dedup_key=("listing_id", "date_key"),
        nulls={"add_to_carts": NullRule("fill", 0.0)},
    ),
    "fact_orders": CleaningRules(
        enums={"payment_method": PAYMENT_METHODS},
        nulls={"shipping_fee_charged": NullRule("fill", 0.0),
               "actual_delivery_date_key": NullRule("keep")},
        bounds=(Bounds("quantity", 1),),
        temporal="orders",
    ),
    "fact_returns": CleaningRules(
        dedup_key=("return_id",),
        enums={"item_condition_on_receipt": ITEM_CONDITIONS},
        nulls={"reported_reason_code": NullRule("flag_missing")},
        temporal="returns",
    ),
}

PASS_THROUGH = ("dim_geography", "dim_return_reason", "ref_category_economics",
                "ref_logistics_rate_card")
WEEKEND_DAYS = ("Saturday", "Sunday")
EVENT_FLAG_DEFAULTS = {"is_ramadan": False, "is_eid_period": False,
                       "is_white_friday_period": False, "is_uae_public_holiday": False}


# ---------------------------------------------------------------------------
# Metric parameters
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Settings:
    as_of_date_key: int = 20260707
    # None: extend the calendar to the newest date key found in the facts.
    calendar_through: int | None = None
    addressable_fraction: str = "1.0"
    toxic_top_fraction: float = 0.10
    toxic_rate_threshold: float = 0.25
    toxic_min_shipped: int = 30
    lqs_cutoff: float = 70.0
    delist_lqs: float = 45.0
    min_opportunity_aed: float = 100.0
    coach_min_listings: int = 8
    low_quality_quantile: float = 0.25
    focus_category: str = "Fashion"
    # False keeps the published behaviour for entities without deliveries or damaged
    # returns; True drops or completes the affected trust component instead.
    corrected_trust: bool = False
    contracts: dict[str, TableContract] = field(default_factory=lambda: dict(CONTRACTS))
    cleaning: dict[str, CleaningRules] = field(default_factory=lambda: dict(CLEANING))


DEFAULT = Settings()
