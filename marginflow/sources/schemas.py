"""Declared schemas of the ten source tables; nothing is inferred."""

from __future__ import annotations

MONEY = "decimal(18,4)"

TABLE_DDL: dict[str, str] = {
    "dim_date": (
        "date_key int, full_date date, day_of_week string, week_of_year int, month int, "
        "quarter int, year int, is_weekend boolean, is_ramadan boolean, is_eid_period boolean, "
        "is_white_friday_period boolean, is_uae_public_holiday boolean"),
    "dim_geography": (
        "geo_id string, emirate string, city string, zone_type string, logistics_zone string"),
    "dim_return_reason": (
        "reason_code string, reason_description string, reason_group string, "
        "is_catalog_related boolean, is_refund_eligible boolean"),
    # join_date arrives in two formats, so it stays text
    "dim_seller": (
        "seller_id string, seller_name string, seller_tier string, fulfillment_type string, "
        "seller_country string, join_date string"),
    "dim_listing": (
        f"listing_id string, seller_id string, category string, subcategory string, "
        f"brand string, listing_created_date date, price {MONEY}, discount_pct double, "
        f"image_count bigint, has_video boolean, title_length_chars bigint, "
        f"description_length_chars double, specifications_filled_pct double, "
        f"has_size_chart boolean, has_dimensions_listed boolean, variant_count bigint, "
        f"item_weight_kg double"),
    "fact_listing_traffic": (
        "listing_id string, date_key int, impressions bigint, detail_page_views bigint, "
        "add_to_carts double"),
    "fact_orders": (
        f"order_line_id string, order_id string, listing_id string, seller_id string, "
        f"order_date_key int, geo_id string, payment_method string, quantity bigint, "
        f"unit_selling_price {MONEY}, item_discount_amount {MONEY}, "
        f"shipping_fee_charged {MONEY}, promised_delivery_date_key int, "
        f"actual_delivery_date_key int, delivery_attempts bigint, order_status string"),
    "fact_returns": (
        f"return_id string, order_line_id string, return_initiated_date_key int, "
        f"return_received_date_key int, reported_reason_code string, "
        f"item_condition_on_receipt string, quantity_returned bigint, refund_amount {MONEY}, "
        f"refund_method string"),
    "ref_category_economics": (
        "category string, gross_margin_pct decimal(6,4), "
        "warehouse_handling_cost_aed decimal(18,4), recovery_pct_resellable decimal(6,4), "
        "recovery_pct_refurbishable decimal(6,4)"),
    "ref_logistics_rate_card": (
        "logistics_zone string, weight_band string, leg string, cost_aed decimal(18,4)"),
}

TABLES = tuple(TABLE_DDL)
