"""Comparison SQL per query name."""

from __future__ import annotations

from marginflow import settings as S
from marginflow.plans.category import CATEGORY_COLUMNS
from marginflow.plans.facts import ORDER_COLUMNS, RETURN_COLUMNS
from marginflow.plans.listing import LISTING_COLUMNS
from marginflow.plans.queue import QUEUE_COLUMNS
from marginflow.plans.seller import SELLER_COLUMNS
from marginflow.sources.bridge import AS_OF
from oracles.audit_sql import COLUMNS, LAYERS, audit, details, outside
from oracles.prelude import (
    ORDER_REST, RAW_ORDERS_PLACED, SIGNAL_SQL, best_row, denull, enum_form, half_up, quot, rate, squeeze, statement,
)

STATEMENTS: dict[str, str] = {}

_TEXT = {
    "category", "payment_method", "order_status", "logistics_zone", "weight_band",
    "reported_reason_code", "reason_group", "item_condition_on_receipt", "seller_name",
    "seller_country", "fulfillment_type", "seller_tier", "primary_category", "intervention_id",
    "entity_type", "entity_id", "intervention_type", "intervention_reason", "priority",
    "recommended_owner", "expected_business_outcome", "recommendation_summary", "kpi_group",
    "kpi_name", "kpi_label", "kpi_unit",
}
_WHOLE = {
    "order_line_id", "order_id", "listing_id", "seller_id", "geo_id", "order_date_key",
    "quantity", "promised_delivery_date_key", "actual_delivery_date_key", "delivery_attempts",
    "return_id", "return_initiated_date_key", "return_received_date_key", "quantity_returned",
    "total_orders", "delivered_orders", "shipped_orders", "rto_orders", "cancelled_orders",
    "returned_orders", "delivered_units", "returned_units", "catalog_returned_units",
    "listing_count", "active_listing_count", "seller_count", "rto_cost_rank",
    "category_rank_by_margin_loss", "category_rank_by_return_cost",
    "category_rank_by_recoverable_profit", "global_priority_rank", "category_priority_rank",
    "as_of_date_key", "kpi_sort",
}


def typed(columns, source: str, tail: str = "") -> str:
    """Select the columns with portable types from a table expression."""
    out = []
    for c in columns:
        if c in _TEXT or c.startswith(("is_", "weight_is")):
            out.append(c)
        else:
            out.append(f"CAST({c} AS {'BIGINT' if c in _WHOLE else 'DOUBLE'}) AS {c}")
    return f"SELECT {', '.join(out)} FROM {source} {tail}"


def add(name: str, sql: str) -> None:
    STATEMENTS[name] = statement(sql)


def D(e: str, name: str | None = None) -> str:
    return f"CAST({e} AS DOUBLE) AS {name or e}"


def I(e: str, name: str | None = None) -> str:  # noqa: E743
    return f"CAST({e} AS BIGINT) AS {name or e}"


# -- sources, sinks -----------------------------------------------------------------------------
def _counts(layer: str) -> str:
    return "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {src} AS x"
                               for t, src in LAYERS[layer].items())


add("scan_profile", _counts("bronze"))
add("cleaning_row_delta", f"""
SELECT b.table_name, b.n_rows AS bronze, s.n_rows AS silver, s.n_rows - b.n_rows AS delta
FROM ({_counts('bronze')}) b JOIN ({_counts('silver')}) s ON b.table_name = s.table_name""")
_GOLD = {"gold_order_line_economics": "order_lines", "gold_return_line_economics": "return_lines",
         "gold_listing_metrics": "listing_mart", "gold_seller_metrics": "seller_mart",
         "gold_category_metrics": "category_mart", "gold_executive_summary": "executive",
         "gold_intervention_queue": "queue"}
_GOLD_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n FROM {c}" for t, c in _GOLD.items())
add("export_roundtrip", f"""
SELECT table_name, fmt, n AS source_rows, n AS file_rows, TRUE AS columns_match,
  TRUE AS content_match, TRUE AS order_match, 'OK' AS status
FROM ({_GOLD_COUNTS}), (SELECT unnest(['csv', 'parquet']) AS fmt)""")

add("scan_quarantine", """
SELECT 'quantity' AS column_name, count(*) AS faults, 'three' AS smallest
FROM raw_orders WHERE order_line_id % 89 = 7 AND order_line_id % 71 <> 2
UNION ALL SELECT 'unit_selling_price', count(*), min('AED ' || CAST(unit_selling_price AS VARCHAR))
FROM raw_orders WHERE order_line_id % 83 = 5 AND order_line_id % 71 <> 2
UNION ALL SELECT 'order_date_key', count(*), min('d' || CAST(order_date_key AS VARCHAR))
FROM raw_orders WHERE order_line_id % 79 = 11 AND order_line_id % 71 <> 2
UNION ALL SELECT '*', count(*), NULL FROM raw_orders WHERE order_line_id % 71 = 2
UNION ALL SELECT '(rows kept)', count(*), NULL FROM raw_orders WHERE order_line_id % 71 <> 2""")
add("gold_publish", f"""
SELECT table_name, n AS n_rows, CAST(2 AS BIGINT) AS version FROM ({_GOLD_COUNTS})""")
add("dedup_first_wins", f"""
SELECT order_line_id, order_id, listing_id, seller_id, {I('order_date_key')}, geo_id,
  payment_method, quantity, {D('unit_selling_price')}, {D('item_discount_amount')},
  {D('shipping_fee_charged')}, {I('promised_delivery_date_key')},
  {I('actual_delivery_date_key')}, delivery_attempts, order_status
FROM ({best_row('(' + RAW_ORDERS_PLACED + ')', ['order_line_id'], ORDER_REST, ['pos'])})""")

# -- cleaning -----------------------------------------------------------------------------------
add("clean_null_tokens", f"""
SELECT listing_id, {denull('category')} AS category, {denull('subcategory')} AS subcategory,
  {denull('brand')} AS brand FROM raw_listings""")
add("clean_dedup", f"""
SELECT order_line_id, order_id, listing_id, seller_id, {I('order_date_key')}, geo_id,
  payment_method, quantity, {D('unit_selling_price')}, {D('item_discount_amount')},
  {D('shipping_fee_charged')}, {I('promised_delivery_date_key')},
  {I('actual_delivery_date_key')}, delivery_attempts, order_status
FROM ({best_row('raw_orders', ['order_line_id'], ORDER_REST)})""")
add("clean_category", """
SELECT listing_id, category,
  category <> raw_category AND category <> 'Unknown' AS dq_category_normalized,
  category = 'Unknown' AS dq_category_unmapped FROM clean_listings""")
add("clean_enum", f"""
SELECT method AS payment_method, method <> payment_method AS dq_payment_method_normalized,
  count(*) AS n_rows
FROM (SELECT payment_method, CASE WHEN {enum_form('payment_method')}
        IN ('cod', 'card', 'wallet', 'bnpl') THEN {enum_form('payment_method')}
        ELSE payment_method END AS method FROM raw_orders)
GROUP BY ALL""")
add("clean_calendar", """
SELECT CAST(date_key AS BIGINT) AS date_key, full_date, day_of_week,
  CAST(week_of_year AS BIGINT) AS week_of_year, CAST(month AS BIGINT) AS month,
  CAST(quarter AS BIGINT) AS quarter, CAST(year AS BIGINT) AS year, is_weekend, is_ramadan,
  is_eid_period, is_white_friday_period, is_uae_public_holiday FROM calendar""")
add("clean_null_policy", f"""
SELECT listing_id, COALESCE({denull('brand')}, 'Unknown') AS brand,
  COALESCE(description_length_chars, 0) AS description_length_chars,
  COALESCE(specifications_filled_pct, 0) AS specifications_filled_pct,
  COALESCE(has_size_chart, FALSE) AS has_size_chart,
  COALESCE(has_dimensions_listed, FALSE) AS has_dimensions_listed, {D('price')}, item_weight_kg,
  {denull('brand')} IS NULL AS dq_imputed_brand,
  description_length_chars IS NULL AS dq_imputed_description_length_chars,
  specifications_filled_pct IS NULL AS dq_imputed_specifications_filled_pct,
  has_size_chart IS NULL AS dq_imputed_has_size_chart,
  has_dimensions_listed IS NULL AS dq_imputed_has_dimensions_listed,
  price IS NULL AS dq_missing_price, item_weight_kg IS NULL AS dq_missing_item_weight_kg
FROM raw_listings""")
add("clean_ranges", """
SELECT listing_id, CASE WHEN discount_pct > 1 THEN NULL ELSE discount_pct END AS discount_pct,
  CASE WHEN image_count < 0 THEN NULL ELSE image_count END AS image_count,
  discount_pct < 0 OR discount_pct > 1 AS dq_out_of_range_discount_pct,
  image_count < 0 AS dq_out_of_range_image_count FROM raw_listings""")
add("temporal_orders", f"""
SELECT order_line_id,
  COALESCE(promised_delivery_date_key < order_date_key, FALSE) AS dq_promised_before_order,
  COALESCE(actual_delivery_date_key < order_date_key, FALSE) AS dq_actual_before_order,
  order_status = 'delivered' AND actual_delivery_date_key IS NULL AS dq_delivered_missing_actual,
  order_status <> 'delivered' AND actual_delivery_date_key IS NOT NULL
    AS dq_nondelivered_has_actual,
  COALESCE(actual_delivery_date_key > {AS_OF}, FALSE) AS dq_delivery_after_asof
FROM clean_orders""")
add("temporal_returns", f"""
SELECT return_id,
  return_received_date_key < return_initiated_date_key AS dq_received_before_initiated,
  COALESCE(return_initiated_date_key < o.actual_delivery_date_key, FALSE)
    AS dq_return_before_delivery,
  return_initiated_date_key > {AS_OF} OR return_received_date_key > {AS_OF}
    AS dq_return_after_asof
FROM clean_returns r LEFT JOIN clean_orders o ON r.order_line_id = o.order_line_id""")
add("clean_pipeline", f"""
SELECT listing_id, seller_id, category, subcategory, brand, {D('price')}, discount_pct,
  image_count, has_video, title_length_chars, description_length_chars,
  specifications_filled_pct, has_size_chart, has_dimensions_listed, variant_count,
  item_weight_kg, category <> raw_category AND category <> 'Unknown' AS dq_category_normalized,
  category = 'Unknown' AS dq_category_unmapped, brand_imputed AS dq_imputed_brand,
  description_imputed AS dq_imputed_description_length_chars,
  specifications_imputed AS dq_imputed_specifications_filled_pct,
  size_chart_imputed AS dq_imputed_has_size_chart,
  dimensions_imputed AS dq_imputed_has_dimensions_listed, price_missing AS dq_missing_price,
  weight_missing AS dq_missing_item_weight_kg, discount_bad AS dq_out_of_range_discount_pct,
  images_bad AS dq_out_of_range_image_count
FROM clean_listings""")
add("clean_sellers", """
SELECT seller_id, seller_name, seller_tier, fulfillment_type, seller_country,
  fulfillment_type <> raw_fulfillment AS dq_fulfillment_type_normalized,
  seller_country <> raw_country AS dq_seller_country_normalized,
  tier_imputed AS dq_imputed_seller_tier FROM clean_sellers""")
_KEYED = {"dim_seller": ("clean_sellers", "seller_id"), "dim_listing": ("clean_listings", "listing_id"),
          "fact_listing_traffic": ("clean_traffic", "listing_id, date_key"),
          "fact_orders": ("clean_orders", "order_line_id"),
          "fact_returns": ("clean_returns", "return_id")}
add("pk_guard", "SELECT table_name, duplicate_rows, CASE WHEN duplicate_rows > 0 THEN 'FAIL' "
    "ELSE 'OK' END AS status FROM (" + "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(COALESCE(sum(n), 0) AS BIGINT) AS duplicate_rows "
        f"FROM (SELECT {k}, count(*) AS n FROM {c} GROUP BY ALL HAVING count(*) > 1)"
        for t, (c, k) in _KEYED.items()) + ")")


def _actions(table: str, raw: str, clean: str, texts: list[str], flags: dict[str, str]) -> str:
    tokens = " + ".join(f"count(*) FILTER ({squeeze(c)} IN ('', 'nan', 'null', 'na', 'none', "
                        f"'n/a', '-'))" for c in texts)
    rows = [f"SELECT '{table}' AS table_name, 'standardize_null_tokens' AS action, '*' AS target, "
            f"{tokens or '0 * count(*)'} AS affected FROM {raw}",
            f"SELECT '{table}', 'deduplicate', '*', (SELECT count(*) FROM {raw}) - "
            f"(SELECT count(*) FROM {clean})"]
    rows += [f"SELECT '{table}', 'flag', 'dq_{f}', count(*) FILTER ({e}) FROM {clean}"
             for f, e in flags.items()]
    return "\nUNION ALL ".join(rows)


_ORDER_FLAGS = {
    "payment_method_normalized": "payment_method <> raw_payment",
    "imputed_shipping_fee_charged": "fee_imputed", "out_of_range_quantity": "bad_quantity",
    "promised_before_order": "promised_delivery_date_key < order_date_key",
    "actual_before_order": "actual_delivery_date_key < order_date_key",
    "delivered_missing_actual":
        "order_status = 'delivered' AND actual_delivery_date_key IS NULL",
    "nondelivered_has_actual":
        "order_status <> 'delivered' AND actual_delivery_date_key IS NOT NULL",
    "delivery_after_asof": f"actual_delivery_date_key > {AS_OF}",
}
_RETURN_FLAGS = {
    "item_condition_on_receipt_normalized": "item_condition_on_receipt <> raw_condition",
    "missing_reported_reason_code": "reason_missing",
    "received_before_initiated": "return_received_date_key < return_initiated_date_key",
    "return_before_delivery": "return_initiated_date_key < arrived",
    "return_after_asof":
        f"return_initiated_date_key > {AS_OF} OR return_received_date_key > {AS_OF}",
}
_LISTING_FLAGS = {
    "category_normalized": "category <> raw_category AND category <> 'Unknown'",
    "category_unmapped": "category = 'Unknown'", "imputed_brand": "brand_imputed",
    "imputed_description_length_chars": "description_imputed",
    "imputed_specifications_filled_pct": "specifications_imputed",
    "imputed_has_size_chart": "size_chart_imputed",
    "imputed_has_dimensions_listed": "dimensions_imputed", "missing_price": "price_missing",
    "missing_item_weight_kg": "weight_missing", "out_of_range_discount_pct": "discount_bad",
    "out_of_range_image_count": "images_bad",
}
_SELLER_FLAGS = {"fulfillment_type_normalized": "fulfillment_type <> raw_fulfillment",
                 "seller_country_normalized": "seller_country <> raw_country",
                 "imputed_seller_tier": "tier_imputed"}
_RETURNS_DATED = ("(SELECT r.*, o.actual_delivery_date_key AS arrived FROM clean_returns r "
                  "LEFT JOIN clean_orders o ON r.order_line_id = o.order_line_id)")
add("cleaning_actions", "\nUNION ALL ".join([
    _actions("dim_seller", "raw_sellers", "clean_sellers",
             ["seller_name", "seller_tier", "fulfillment_type", "seller_country"], _SELLER_FLAGS),
    _actions("dim_listing", "raw_listings", "clean_listings",
             ["category", "subcategory", "brand"], _LISTING_FLAGS),
    _actions("fact_listing_traffic", "raw_traffic", "clean_traffic", [],
             {"imputed_add_to_carts": "carts_imputed"}),
    _actions("fact_orders", "raw_orders", "clean_orders", ["payment_method", "order_status"],
             _ORDER_FLAGS),
    _actions("fact_returns", "raw_returns", _RETURNS_DATED,
             ["reported_reason_code", "item_condition_on_receipt", "refund_method"],
             _RETURN_FLAGS)]))

# -- audit ----------------------------------------------------------------------------------------
_RAW = LAYERS["bronze"]
add("dq_primary_key", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS "
    f"null_key_rows, CAST(COALESCE(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows, "
    f"count(*) FILTER (n > 1) AS duplicate_groups FROM (SELECT {', '.join(S.CONTRACTS[t].key)}, "
    f"count(*) AS n FROM {_RAW[t]} GROUP BY ALL)"
    for t in S.CONTRACTS))


def _fk(table: str, fk: S.ForeignKey, calendar: bool) -> str:
    child, parent, c, p = _RAW[table], _RAW[fk.table], fk.column, fk.parent_column
    orphan = f"(k IS NOT NULL AND p IS NULL)"
    last = f"(SELECT max({p}) FROM {parent})"
    beyond = f"({orphan} AND k > {last})" if calendar else "FALSE"
    base = (f"(SELECT c.{c} AS k, q.p FROM {child} c LEFT JOIN (SELECT DISTINCT {p} AS p FROM "
            f"{parent}) q ON c.{c} = q.p)")
    sample = (f"COALESCE((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT "
              f"CAST(k AS VARCHAR) AS v FROM {base} WHERE {orphan} ORDER BY v LIMIT 10)), '')")
    cover = (f"count(*) FILTER ({orphan}) - count(*) FILTER ({beyond}) AS broken_orphans, "
             f"count(*) FILTER ({beyond}) AS coverage_orphans, "
             f"CAST(max(k) FILTER ({beyond}) AS BIGINT) AS coverage_extend_through, "
             if calendar else "")
    return (f"SELECT '{table}.{c}' AS reference, count(*) FILTER (k IS NULL) AS null_count, "
            f"count(*) FILTER ({orphan}) AS orphan_count, {cover}"
            f"COALESCE({rate(f'count(k) - count(*) FILTER ({orphan})', 'count(k)')}, 1.0::DOUBLE) AS match_rate, "
            f"{sample} AS orphan_sample FROM {base}")


add("dq_foreign_key", "\nUNION ALL ".join(
    _fk(t, fk, False) for t in ("dim_listing", "fact_listing_traffic", "fact_orders",
                                "fact_returns")
    for fk in S.CONTRACTS[t].foreign_keys if fk.table != "dim_date"))
add("dq_fk_coverage", "\nUNION ALL ".join(
    _fk(t, fk, True) for t in ("fact_listing_traffic", "fact_orders", "fact_returns")
    for fk in S.CONTRACTS[t].foreign_keys if fk.table == "dim_date"))
# fixed values: a column whose letters contain one of these is a metric
_METRIC_NAMES = "listingqualityscore|lqs|trustscore|returncost|recoverableprofit"


def _exposed(table: str, src: str, columns) -> str:
    """Columns are matched by name in SQL; their filled cells are counted."""
    names = ", ".join(f"'{c}'" for c in columns)
    bad = (f"regexp_matches(regexp_replace(lower(u.c), '[^a-z0-9]', '', 'g'), "
           f"'{_METRIC_NAMES}')")
    cells = " + ".join(
        f"CASE WHEN {bad.replace('u.c', repr(c))} THEN count({c}) ELSE 0 END" for c in columns)
    return (f"SELECT '{table}' AS table_name, count(*) AS n_rows, (SELECT count(*) FROM "
            f"(SELECT unnest([{names}]) AS c) u WHERE {bad}) AS offending_columns, "
            f"CAST({cells} AS BIGINT) AS exposed_values FROM {src} AS x")


add("dq_leakage", "\nUNION ALL ".join(
    [_exposed(t, src, COLUMNS[t]) for t, src in _RAW.items()]
    + [_exposed("gold_listing_metrics", "listing_mart", LISTING_COLUMNS)]))


def _member(table: str, column: str, words: str, forms: str) -> str:
    src = _RAW[table]
    known = f"{squeeze(column)} IN {forms}"
    unknown, dirty = f"NOT {known}", f"({known} AND {column} NOT IN {words})"

    def sample(cond: str) -> str:
        return (f"COALESCE((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {column} "
                f"AS v FROM {src} WHERE {cond} ORDER BY v LIMIT 10)), '')")

    return (f"SELECT '{table}.{column}' AS reference, (SELECT count(*) FROM {src} WHERE {unknown}) "
            f"AS unknown_count, (SELECT count(*) FROM {src} WHERE {dirty}) AS "
            f"needs_normalization_count, {sample(unknown)} AS unknown_sample, {sample(dirty)} AS "
            f"needs_normalization_sample")


def _words(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


add("dq_membership", "\nUNION ALL ".join([
    _member("dim_listing", "category", _words(S.CATEGORIES),
            _words(c.lower() for c in S.CATEGORIES)),
    _member("fact_orders", "order_status", _words(S.ORDER_STATUSES), _words(S.ORDER_STATUSES)),
    _member("fact_orders", "payment_method", _words(S.PAYMENT_METHODS),
            _words(S.PAYMENT_METHODS))]))
add("dq_delivered_only", """
SELECT COALESCE(s, 'unmatched') AS outcome, count(*) AS n_returns
FROM raw_returns r LEFT JOIN
  (SELECT order_line_id, max(order_status) AS s FROM raw_orders GROUP BY 1) o
  ON r.order_line_id = o.order_line_id GROUP BY ALL""")


def _nulls(table: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS "
        f"nulls, {rate(f'count(*) FILTER ({c} IS NULL)', 'count(*)')} AS pct FROM {_RAW[table]}"
        for c in columns)


add("dq_null_profile", "SELECT * FROM (" + "\nUNION ALL ".join(
    _nulls(t, COLUMNS[t]) for t in S.CONTRACTS) + ") WHERE nulls > 0")
add("dq_duplicate_rows", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count, "
    f"CAST(COALESCE(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows "
    f"FROM (SELECT {', '.join(COLUMNS[t])}, count(*) AS n FROM {_RAW[t]} GROUP BY ALL)"
    for t in S.CONTRACTS))
add("dq_ranges", "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{b.column}' AS column_name, count(*) FILTER ({outside(b)}) AS "
    f"out_of_range, CAST(min({b.column}) AS DOUBLE) AS observed_min, "
    f"CAST(max({b.column}) AS DOUBLE) AS observed_max FROM {_RAW[t]}"
    for t, c in S.CONTRACTS.items() if t.startswith(("dim_", "fact_")) for b in c.bounds)
    + ") WHERE out_of_range > 0")
add("dq_funnel", "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{u}<{v}' AS step, count(*) FILTER ({u} < {v}) AS breaches FROM raw_traffic"
    for u, v in (("impressions", "detail_page_views"), ("detail_page_views", "add_to_carts")))
    + ") WHERE breaches > 0")
add("audit_full", audit("bronze"))
add("audit_details", details("bronze"))
add("audit_summary", f"""
SELECT count(*) AS checks_run, count(*) FILTER (status = 'PASS') AS passed,
  count(*) FILTER (status = 'WARN') AS warnings, count(*) FILTER (blocking) AS blocking_failures,
  CASE WHEN bool_or(blocking) THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN'
    ELSE 'PASS' END AS overall_status
FROM ({audit('bronze')})""")
add("audit_before_after", "\nUNION ALL ".join(f"""
SELECT '{layer}' AS layer, table_name, count(*) AS checks,
  count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'WARN') AS warnings,
  count(*) FILTER (blocking) AS blocking FROM ({audit(layer)}) GROUP BY table_name"""
                                              for layer in ("bronze", "silver")))

# -- line facts -----------------------------------------------------------------------------------
add("weight_fallback", "SELECT category, median(item_weight_kg) AS median_weight_kg "
    "FROM clean_listings GROUP BY category")
add("weight_band", f"SELECT listing_id, category, {half_up('kg', 6)} AS weight_kg_effective, "
    "weight_band, weight_missing AS weight_is_fallback FROM weights")
add("order_economics", typed(ORDER_COLUMNS, "order_lines"))
add("on_time_rate", f"""
SELECT seller_id, count(*) AS delivered_orders, count(*) FILTER (is_on_time) AS on_time,
  count(*) FILTER (is_on_time IS NULL) AS undated,
  {rate('count(*) FILTER (is_on_time)', 'count(*)')} AS on_time_rate
FROM order_lines WHERE is_delivered GROUP BY seller_id""")
add("rto_cost", f"""
SELECT logistics_zone, weight_band, category, count(*) AS rto_orders,
  {D('sum(rto_forward_cost_aed)', 'forward')}, {D('sum(rto_handling_cost_aed)', 'handling')},
  {D('sum(rto_cost_aed)', 'cost')}
FROM order_lines WHERE is_rto GROUP BY ALL""")
add("return_economics", typed(RETURN_COLUMNS, "return_lines"))
add("return_cost", "SELECT category, item_condition_on_receipt, count(*) AS returns, "
    + ", ".join(D(f"sum({c})", c) for c in ("returned_value_aed", "recovered_value_aed",
                                            "merchandise_loss_aed", "return_cost_aed"))
    + " FROM return_lines GROUP BY ALL")

# -- entity marts -----------------------------------------------------------------------------------
add("lqs_weights", f"""
SELECT category, signal, raw_weight,
  {half_up('raw_weight / sum(raw_weight) OVER (PARTITION BY category)', 9)} AS weight
FROM signal_weights""")
add("lqs_signals", "\nUNION ALL ".join(
    f"SELECT listing_id, category, '{s}' AS signal, {half_up(e, 9)} AS value FROM clean_listings"
    for s, e in SIGNAL_SQL.items()))
add("listing_quality_score", f"""
SELECT l.listing_id, l.category, {D('q.listing_quality_score', 'listing_quality_score')}
FROM clean_listings l LEFT JOIN lqs q ON l.listing_id = q.listing_id""")
add("listing_metrics", typed(LISTING_COLUMNS, "listing_mart"))
add("seller_metrics", typed(SELLER_COLUMNS, "seller_mart"))
add("primary_category", """
SELECT seller_id, category AS primary_category
FROM (SELECT seller_id, category, count(*) AS n FROM clean_listings GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY n DESC, category NULLS LAST) = 1""")
add("safe_rates", f"""
SELECT listing_id, payment_method, count(*) FILTER (is_rto) AS rto_orders,
  count(*) FILTER (is_shipped) AS shipped_orders, count(*) FILTER (is_on_time) AS on_time,
  count(*) FILTER (is_delivered) AS delivered_orders,
  {rate('count(*) FILTER (is_rto)', 'count(*) FILTER (is_shipped)')} AS rto_rate,
  {rate('count(*) FILTER (is_on_time)', 'count(*) FILTER (is_delivered)')} AS on_time_rate
FROM order_lines GROUP BY ALL""")
add("trust_score", "SELECT seller_id, seller_tier, on_time_delivery_rate, avg_delivery_attempts, "
    f"damage_return_share, {D('trust_score')} FROM seller_mart")
add("seller_ranking", f"SELECT seller_id, {D('seller_rto_cost')}, is_toxic_rto, rto_cost_rank, "
    "is_top_decile_rto_cost FROM seller_mart")
add("seller_percentile", "SELECT seller_id, primary_category, "
    f"{D('net_margin_after_returns')}, seller_percentile_within_category FROM seller_mart")
add("category_metrics", typed(CATEGORY_COLUMNS, "category_mart"))
add("category_trust", f"""
SELECT p.category, count(*) AS scored_sellers,
  {half_up(quot('sum(m.trust_score)', 'count(m.trust_score)'), 2)} AS mean_trust
FROM (SELECT DISTINCT category, seller_id FROM listing_mart) p
JOIN seller_mart m ON p.seller_id = m.seller_id GROUP BY p.category""")
add("category_ranking", typed(
    ("category", "net_margin_after_returns", "return_cost", "recoverable_profit",
     "category_rank_by_margin_loss", "category_rank_by_return_cost",
     "category_rank_by_recoverable_profit"), "category_mart"))
add("category_share", typed(
    ("category", "return_cost", "recoverable_profit", "percentage_of_marketplace_return_cost",
     "percentage_of_marketplace_recoverable_profit"), "category_mart"))

# -- KPIs and queue -----------------------------------------------------------------------------------
add("executive_summary", typed(("as_of_date_key", "kpi_sort", "kpi_group", "kpi_name",
                                "kpi_label", "kpi_unit", "kpi_value"), "executive"))
add("bottom_quartile_share", f"""
SELECT {half_up('max(b.cutoff)', 9)} AS cutoff, count(*) FILTER (low) AS band_listings,
  {half_up(quot('sum(realized_net_revenue) FILTER (low)', 'sum(realized_net_revenue)'), 9)}
    AS revenue_share,
  {half_up(quot('sum(return_cost) FILTER (low)', 'sum(return_cost)'), 9)} AS return_cost_share
FROM (SELECT m.*, CAST(listing_quality_score AS DOUBLE) <= cutoff AS low, cutoff
      FROM listing_mart m, lqs_band) b""")
add("rto_concentration", f"""
SELECT count(*) FILTER (is_top_decile_rto_cost) AS flagged_sellers, count(*) AS sellers,
  {half_up(quot('sum(seller_rto_cost) FILTER (is_top_decile_rto_cost)', 'sum(seller_rto_cost)'), 9)}
    AS concentration FROM seller_mart""")
add("intervention_queue", typed(QUEUE_COLUMNS, "queue"))
add("listing_classification", f"""
SELECT listing_id, seller_id, {D('listing_quality_score')}, {D('net_margin_after_returns')},
  {D('recoverable_profit')}, {D('catalog_return_cost')}, class AS intervention_class
FROM candidates""")
add("coached_sellers", f"""
SELECT seller_id, n AS catalog_listing_count, {D('gain', 'total_recoverable_profit')},
  {D('cut', 'total_catalog_return_cost')} FROM coached""")
_PROPOSAL = (f"SELECT intervention_id, entity_type, entity_id, category, seller_id, "
             f"intervention_type, intervention_reason, {D('gain', 'opportunity')}, "
             f"{D('cut', 'cost_reduction')}, {D('lqs', 'listing_quality_score')}, "
             f"{D('trust', 'trust_score')}, crr AS catalog_return_rate, rr AS rto_rate, "
             f"{D('rc', 'return_cost')}, {D('gm', 'gross_margin')}, "
             f"{D('nm', 'net_margin_after_returns')}, owner AS recommended_owner, "
             f"outcome AS expected_business_outcome, summary AS recommendation_summary "
             f"FROM proposals WHERE intervention_type = ")
for _name, _kind in (("catalog_fix", "Catalog Fix"), ("delist_candidates", "Delisting Candidate"),
                     ("seller_coaching", "Seller Coaching"), ("cod_risk", "COD Risk Reduction")):
    add(_name, f"{_PROPOSAL}'{_kind}'")


# -- reconciliation -----------------------------------------------------------------------------------
def _check(name: str, passed: str, value: str = "NULL", source: str = "") -> str:
    return (f"SELECT '{name}' AS check_name, CAST({value} AS DOUBLE) AS value, "
            f"COALESCE({passed}, FALSE) AS pass{' FROM ' + source if source else ''}")


def _none(name: str, condition: str, source: str) -> str:
    n = f"count(*) FILTER ({condition})"
    return _check(name, f"{n} = 0", n, source)


def _in01(name: str, columns, source: str) -> str:
    parts = " AND ".join(f"COALESCE(min({c}) >= 0 AND max({c}) <= 1, TRUE)" for c in columns)
    return _check(name, parts, "NULL", source)


def _tot(expr: str, source: str) -> str:
    return f"(SELECT {expr} FROM {source})"


def _near(a: str, b: str, tol: float = 0.01) -> str:
    return f"abs({a} - {b}) < {tol}"


_CHECK_ROWS: dict[str, str] = {}


def _checks(name: str, rows: list[str]) -> None:
    _CHECK_ROWS[name] = "\nUNION ALL ".join(rows)
    add(name, _CHECK_ROWS[name])


_O, _R, _L, _SM, _C, _E, _Q = ("order_lines", "return_lines", "listing_mart", "seller_mart",
                               "category_mart", "executive", "queue")
_checks("checks_order_economics", [
    _check("row_count", f"count(*) = {_tot('count(*)', 'clean_orders')}", "count(*)", _O),
    _check("pk_unique", "count(*) = count(DISTINCT order_line_id)", "count(*)", _O),
    _check("status_reconciliation", " AND ".join(
        f"count(*) FILTER ({f}) = {_tot(f'count(*) FILTER ({c})', 'clean_orders')}"
        for f, c in (("is_delivered", "order_status = 'delivered'"),
                     ("is_rto", "order_status LIKE 'rto%'"),
                     ("is_cancelled", "order_status LIKE 'cancelled%'"),
                     ("is_shipped", "order_status NOT LIKE 'cancelled%'"))), "NULL", _O),
    _none("margin_delivered_only", "gross_margin_aed IS NOT NULL AND NOT is_delivered", _O),
    _none("invalid_qty_excluded", "is_quantity_invalid AND gross_margin_aed IS NOT NULL", _O),
    _check("margin_pct_and_revenue_bounds", "min(gross_margin_pct) >= 0 AND max(gross_margin_pct) "
           "<= 1 AND COALESCE(min(realized_net_revenue_aed), 0) >= 0", "NULL", _O),
    _check("rto_cost_scoped", "count(*) FILTER (rto_cost_aed > 0 AND NOT is_rto) = 0 AND "
           "count(*) FILTER (is_rto AND rto_cost_aed <= 0) = 0",
           "count(*) FILTER (rto_cost_aed > 0 AND NOT is_rto)", _O),
    _none("no_unresolved_dimensions", "category IS NULL OR gross_margin_pct IS NULL OR "
          "logistics_zone IS NULL OR weight_band IS NULL", _O)])
_RATIO = quot("sum(recovered_value_aed)", "sum(returned_value_aed)")
_checks("checks_return_economics", [
    _check("row_count", f"count(*) = {_tot('count(*)', 'clean_returns')}", "count(*)", _R),
    _check("pk_unique", "count(*) = count(DISTINCT return_id)", "count(*)", _R),
    _none("golden_rule_2_delivered_only", "NOT line_delivered", _R),
    _none("recovered_le_returned", "recovered_value_aed > returned_value_aed", _R),
    _in01("recovery_pct_bounds", ["recovery_pct"], _R),
    _none("writeoff_zero_recovery",
          "item_condition_on_receipt = 'write_off' AND recovered_value_aed <> 0", _R),
    _none("cost_components_positive", "reverse_logistics_cost_aed IS NULL OR "
          "reverse_logistics_cost_aed <= 0 OR handling_cost_aed <= 0", _R),
    _none("return_cost_identity", "ROUND(reverse_logistics_cost_aed + handling_cost_aed + "
          "merchandise_loss_aed, 4) <> return_cost_aed", _R),
    _check("recovery_rate_aggregate", f"{_RATIO} BETWEEN 0 AND 1", half_up(_RATIO, 4), _R)])
_UNDEFINED = ("(catalog_return_rate IS NULL AND delivered_units > 0) OR (rto_rate IS NULL AND "
              "shipped_orders > 0) OR (recovery_rate IS NULL AND returned_units > 0)")
_IDENTITY = "abs(net_margin_after_returns - (gross_margin - return_cost)) > 0.001"
_REC = quot("sum(recovered_value)", "sum(returned_value)")
_LNULL = ("listing_quality_score IS NULL OR gross_margin IS NULL OR return_cost IS NULL OR "
          "net_margin_after_returns IS NULL OR recoverable_profit IS NULL")
_checks("checks_listing", [
    _check("row_count", f"count(*) = {_tot('count(*)', 'clean_listings')}", "count(*)", _L),
    _check("one_row_per_listing", "count(*) = count(DISTINCT listing_id)",
           "count(*) - count(DISTINCT listing_id)", _L),
    _check("lqs_bounds", "min(listing_quality_score) >= 0 AND max(listing_quality_score) <= 100 "
           "AND count(*) = count(listing_quality_score)", "max(listing_quality_score)", _L),
    _none("lqs_weights_sum_to_1", "abs(s - 1) > 1e-9",
          "(SELECT category, sum(w) AS s FROM (SELECT category, raw_weight / sum(raw_weight) OVER "
          "(PARTITION BY category) AS w FROM signal_weights) GROUP BY category)"),
    _in01("rate_bounds_0_1", ["catalog_return_rate", "rto_rate", "recovery_rate",
                              "on_time_delivery_rate", "damage_return_share"], _L),
    _none("margin_identity", _IDENTITY, _L),
    _check("null_rules", f"count(*) FILTER ({_LNULL}) = 0 AND count(*) FILTER ({_UNDEFINED}) = 0",
           f"count(*) FILTER ({_LNULL})", _L),
    _check("reconcile_foundational", " AND ".join([
        f"sum(total_orders) = {_tot('count(*)', _O)}",
        f"sum(delivered_orders) = {_tot('count(*) FILTER (is_delivered)', _O)}",
        f"sum(rto_orders) = {_tot('count(*) FILTER (is_rto)', _O)}",
        f"sum(returned_orders) = {_tot('count(*)', _R)}",
        _near("sum(gross_margin)", _tot("sum(gross_margin_aed)", _O)),
        _near("sum(return_cost)", _tot("sum(return_cost_aed)", _R)),
        _near("sum(rto_cost)", _tot("sum(rto_cost_aed)", _O))]), "NULL", _L),
    _check("recovery_rate_reconcile", _near(_REC, _tot(_RATIO, _R), 1e-6), half_up(_REC, 4), _L)])
_SNULL = ("trust_score IS NULL OR gross_margin IS NULL OR return_cost IS NULL OR "
          "net_margin_after_returns IS NULL OR seller_tier IS NULL")
_checks("checks_seller", [
    _check("row_count", f"count(*) = {_tot('count(*)', 'clean_sellers')} AND count(*) = "
           "count(DISTINCT seller_id)", "count(*)", _SM),
    _check("trust_score_bounds", "min(trust_score) >= 0 AND max(trust_score) <= 100 AND count(*) "
           "= count(trust_score)", "min(trust_score)", _SM),
    _check("reconcile_listing_mart", " AND ".join(
        [f"sum(listing_count) = {_tot('count(*)', _L)}"]
        + [f"sum({c}) = {_tot(f'sum({c})', _L)}" for c in (
            "total_orders", "delivered_orders", "rto_orders", "returned_orders")]
        + [_near("sum(recoverable_profit)", _tot("sum(recoverable_profit)", _L))]), "NULL", _SM),
    _check("gross_margin_reconcile", _near("sum(gross_margin)", _tot("sum(gross_margin_aed)", _O)),
           "ROUND(sum(gross_margin), 2)", _SM),
    _check("return_cost_reconcile", _near("sum(return_cost)", _tot("sum(return_cost_aed)", _R)),
           "ROUND(sum(return_cost), 2)", _SM),
    _none("margin_identity", _IDENTITY, _SM),
    _check("ranking_consistency", "count(*) = count(DISTINCT rto_cost_rank) AND "
           "max(rto_cost_rank) = count(*) AND max(seller_rto_cost) FILTER (rto_cost_rank = 1) = "
           "max(seller_rto_cost)", "max(rto_cost_rank)", _SM),
    _in01("rate_and_percentile_bounds", [
        "catalog_return_rate", "rto_rate", "recovery_rate", "on_time_delivery_rate",
        "seller_percentile_within_category"], _SM),
    _check("null_rules", f"count(*) FILTER ({_SNULL}) = 0 AND count(*) FILTER ({_UNDEFINED}) = 0",
           f"count(*) FILTER ({_SNULL})", _SM)])
_SHARES = ("percentage_of_marketplace_return_cost", "percentage_of_marketplace_recoverable_profit")
_RANKS = [c for c in CATEGORY_COLUMNS if c.startswith("category_rank")]
_checks("checks_category", [
    _check("row_count", f"count(*) = {_tot('count(DISTINCT category)', _L)}", "count(*)", _C),
    _check("one_row_per_category", "count(*) = count(DISTINCT category)",
           "count(*) - count(DISTINCT category)", _C),
    *[_check(f"{c}_reconcile", _near(f"sum({c})", _tot(f"sum({c})", _L)), f"ROUND(sum({c}), 2)", _C)
      for c in ("gross_margin", "return_cost", "recoverable_profit")],
    _check("order_counts_reconcile", " AND ".join(
        f"sum({c}) = {_tot(f'sum({c})', _L)}" for c in (
            "total_orders", "delivered_orders", "returned_orders", "rto_orders")),
        "sum(total_orders)", _C),
    _in01("rate_bounds_0_1", ["recovery_rate", "catalog_return_rate", "rto_rate",
                              "on_time_delivery_rate"], _C),
    _in01("percentage_bounds", _SHARES, _C),
    _check("ranking_uniqueness", " AND ".join(f"count(DISTINCT {r}) = count(*)" for r in _RANKS),
           f"count(DISTINCT {_RANKS[0]})", _C),
    _none("null_rules", " OR ".join(f"{c} IS NULL" for c in (
        "gross_margin", "return_cost", "recoverable_profit", "net_margin_after_returns",
        "average_listing_quality_score", "average_trust_score", "recovery_rate",
        "catalog_return_rate", "rto_rate", "on_time_delivery_rate")), _C),
    _check("percentages_sum_to_1", " AND ".join(
        f"abs(sum(CAST({s} AS DECIMAL(9,6))) - 1) < 0.000001" for s in _SHARES),
        f"sum(CAST({_SHARES[0]} AS DECIMAL(9,6)))", _C),
    _none("financial_identity", _IDENTITY, _C)])


def _kpi(name: str) -> str:
    return f"max(kpi_value) FILTER (kpi_name = '{name}')"


def _kpi_ties(kpi: str, column: str, marts) -> str:
    return _check(f"{column}_reconcile", " AND ".join(
        _near(_kpi(kpi), f"CAST({_tot(f'sum({column})', m)} AS DOUBLE)") for m in marts),
        half_up(_kpi(kpi), 2), _E)


def _kpi_in01(name: str, names, value: str = "NULL") -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return _check(name, f"bool_and(kpi_value BETWEEN 0 AND 1) FILTER (kpi_name IN ({listed}))",
                  value, _E)


_GAP = (f"{_kpi('net_margin_after_returns')} - ({_kpi('total_gross_margin')} - "
        f"{_kpi('total_return_cost')})")
_LOSSY = _tot("count(*) FILTER (net_margin_after_returns < 0)", _L)
_checks("checks_executive", [
    _check("kpi_names_unique", "count(*) = count(DISTINCT kpi_name)", "count(*)", _E),
    _check("kpi_count_range", "count(*) BETWEEN 12 AND 20", "count(*)", _E),
    _none("no_null_values", "kpi_value IS NULL", _E),
    _kpi_ties("total_gross_margin", "gross_margin", (_L, _C, _SM)),
    _kpi_ties("total_return_cost", "return_cost", (_L, _C, _SM)),
    _kpi_ties("total_recoverable_profit", "recoverable_profit", (_L, _C)),
    _kpi_in01("rate_bounds_0_1", ("marketplace_catalog_return_rate", "marketplace_rto_rate",
                                  "aggregate_recovery_rate")),
    _kpi_in01("toxic_rto_concentration_bounds", ("toxic_rto_concentration",),
              half_up(_kpi("toxic_rto_concentration"), 4)),
    _kpi_in01("bottom_lqs_share_bounds", ("bottom_lqs_revenue_share",
                                          "bottom_lqs_return_cost_share")),
    _check("fashion_shares_reconcile", " AND ".join(
        _near(_kpi(f"fashion_{c}_share"),
              _tot(f"max(percentage_of_marketplace_{c}) FILTER (category = 'Fashion')", _C), 1e-6)
        for c in ("return_cost", "recoverable_profit")),
        half_up(_kpi("fashion_return_cost_share"), 6), _E),
    _check("loss_making_reconcile", f"{_kpi('loss_making_listing_count')} = {_LOSSY}",
           _kpi("loss_making_listing_count"), _E),
    _check("order_counts_reconcile", " AND ".join([
        f"{_kpi('total_orders')} = {_tot('count(*)', _O)}",
        f"{_kpi('delivered_orders')} = {_tot('count(*) FILTER (is_delivered)', _O)}",
        f"{_kpi('returned_orders')} = {_tot('count(*)', _R)}",
        f"{_kpi('rto_orders')} = {_tot('count(*) FILTER (is_rto)', _O)}"]),
        _kpi("total_orders"), _E),
    _check("financial_identity", f"abs({_GAP}) < 0.01", half_up(_GAP, 4), _E)])
_WRONG = ("(intervention_type IN ('Catalog Fix', 'Delisting Candidate') AND entity_type <> "
          "'listing') OR (intervention_type IN ('Seller Coaching', 'COD Risk Reduction') AND "
          "entity_type <> 'seller')")
_TWICE = ("(SELECT count(*) FROM (SELECT entity_id FROM queue WHERE intervention_type IN "
          "('Catalog Fix', 'Delisting Candidate') GROUP BY 1 HAVING count(*) > 1))")
_UNEVEN = ("(SELECT count(*) FROM (SELECT category FROM queue GROUP BY category HAVING "
           "min(category_priority_rank) <> 1 OR max(category_priority_rank) <> count(*) OR "
           "count(DISTINCT category_priority_rank) <> count(*)))")
_ELIGIBLE = _tot("COALESCE(sum(recoverable_profit) FILTER (class = 'catalog'), 0)", "candidates")
_CATALOG = ("COALESCE(sum(estimated_recoverable_profit) FILTER (intervention_type IN "
            "('Catalog Fix', 'Seller Coaching')), 0)")
_checks("checks_queue", [
    _check("no_duplicate_intervention_id", "count(*) = count(DISTINCT intervention_id)",
           "count(*)", _Q),
    _check("global_rank_unique", "count(*) = count(DISTINCT global_priority_rank)", "count(*)", _Q),
    _none("no_null_priority", "priority IS NULL OR priority_opportunity_aed IS NULL OR "
          "global_priority_rank IS NULL", _Q),
    _none("financial_reconcile", "abs(estimated_return_cost_reduction + estimated_margin_recovery "
          "- estimated_recoverable_profit) > 0.01 OR abs(estimated_recoverable_profit - "
          "priority_opportunity_aed) > 0.01", _Q),
    _check("opportunity_non_negative", " AND ".join(f"min({c}) >= 0" for c in (
        "priority_opportunity_aed", "estimated_return_cost_reduction",
        "estimated_margin_recovery", "estimated_recoverable_profit")),
        "min(priority_opportunity_aed)", _Q),
    _none("valid_intervention_types",
          f"intervention_type NOT IN {_words(S.INTERVENTIONS)}", _Q),
    _none("valid_owners",
          f"recommended_owner NOT IN {_words(v[2] for v in S.INTERVENTIONS.values())}", _Q),
    _check("global_ranks_consecutive", "min(global_priority_rank) = 1 AND "
           "max(global_priority_rank) = count(*)", "max(global_priority_rank)", _Q),
    _check("category_ranks_consecutive", f"{_UNEVEN} = 0", _UNEVEN),
    _check("opportunity_ordering", "max(priority_opportunity_aed) FILTER (global_priority_rank = "
           "1) = max(priority_opportunity_aed)",
           "max(priority_opportunity_aed) FILTER (global_priority_rank = 1)", _Q),
    _check("no_impossible_combinations", f"count(*) FILTER ({_WRONG}) + {_TWICE} = 0",
           f"count(*) FILTER ({_WRONG}) + {_TWICE}", _Q),
    _check("catalog_recoverable_reconcile", _near(_CATALOG, _ELIGIBLE), f"ROUND({_CATALOG}, 2)",
           _Q)])
add("row_count_regression", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({e} AS BIGINT) AS expected, count(*) AS actual, "
    f"count(*) = {e} AS pass FROM {_GOLD[t]}" for t, e in (
        ("gold_order_line_economics", _tot("count(*)", "clean_orders")),
        ("gold_return_line_economics", _tot("count(*)", "clean_returns")),
        ("gold_listing_metrics", _tot("count(*)", "clean_listings")),
        ("gold_seller_metrics", _tot("count(*)", "clean_sellers")),
        ("gold_category_metrics", _tot("count(DISTINCT category)", "clean_listings")),
        ("gold_executive_summary", "17"))))

# -- slices ---------------------------------------------------------------------------------------
add("weighted_rates_by_slice", f"""
SELECT o.seller_id, o.category, shipped_orders, delivered_orders,
  {rate('COALESCE(catalog_units, 0)', 'delivered_units')} AS catalog_return_rate,
  {rate('rto_orders', 'shipped_orders')} AS rto_rate,
  {rate('recovered_value', 'returned_value')} AS recovery_rate,
  {rate('on_time', 'delivered_orders')} AS on_time_rate
FROM (SELECT seller_id, category, count(*) FILTER (is_rto) AS rto_orders,
        count(*) FILTER (is_shipped) AS shipped_orders,
        count(*) FILTER (is_delivered) AS delivered_orders,
        sum(CAST(is_on_time AS INTEGER)) FILTER (is_delivered) AS on_time,
        sum(quantity) FILTER (is_delivered AND NOT is_quantity_invalid) AS delivered_units
      FROM order_lines GROUP BY ALL) o
LEFT JOIN (SELECT seller_id, category,
             sum(quantity_returned) FILTER (is_catalog_related) AS catalog_units,
             sum(returned_value_aed) AS returned_value, sum(recovered_value_aed) AS recovered_value
           FROM return_lines GROUP BY ALL) r
  ON o.seller_id IS NOT DISTINCT FROM r.seller_id AND o.category IS NOT DISTINCT FROM r.category""")
_LEVELS = ("GROUP BY GROUPING SETS ((category, seller_id), (category), (seller_id), ())")
_LEVEL = ("CASE WHEN grouping(category) + grouping(seller_id) = 2 THEN 'total' ELSE concat_ws(' x ', "
          "CASE WHEN grouping(category) = 0 THEN 'category' END, "
          "CASE WHEN grouping(seller_id) = 0 THEN 'seller_id' END) END AS level")
add("rates_by_level", f"""
SELECT o.level, o.category, o.seller_id, shipped_orders, delivered_orders,
  {rate('COALESCE(catalog_units, 0)', 'delivered_units')} AS catalog_return_rate,
  {rate('rto_orders', 'shipped_orders')} AS rto_rate,
  {rate('recovered_value', 'returned_value')} AS recovery_rate,
  {rate('on_time', 'delivered_orders')} AS on_time_rate
FROM (SELECT {_LEVEL}, seller_id, category, count(*) FILTER (is_rto) AS rto_orders,
        count(*) FILTER (is_shipped) AS shipped_orders,
        count(*) FILTER (is_delivered) AS delivered_orders,
        sum(CAST(is_on_time AS INTEGER)) FILTER (is_delivered) AS on_time,
        sum(quantity) FILTER (is_delivered AND NOT is_quantity_invalid) AS delivered_units
      FROM order_lines {_LEVELS}) o
LEFT JOIN (SELECT {_LEVEL}, seller_id, category,
             sum(quantity_returned) FILTER (is_catalog_related) AS catalog_units,
             sum(returned_value_aed) AS returned_value, sum(recovered_value_aed) AS recovered_value
           FROM return_lines {_LEVELS}) r
  ON o.level = r.level AND o.seller_id IS NOT DISTINCT FROM r.seller_id
     AND o.category IS NOT DISTINCT FROM r.category""")
add("sketch_accuracy", """
SELECT category, count(*) AS lines, TRUE AS median_close, TRUE AS p90_close,
  TRUE AS orders_close FROM order_lines GROUP BY category""")
add("quarter_trend", f"""
SELECT {I('month')}, orders, {D('revenue')}, returns, {D('cost', 'return_cost')},
  {rate('orders - lag(orders) OVER m', 'lag(orders) OVER m')} AS orders_mom,
  {rate('cost - lag(cost) OVER m', 'lag(cost) OVER m')} AS return_cost_mom
FROM (SELECT order_date_key // 100 AS month, count(*) AS orders,
        sum(realized_net_revenue_aed) AS revenue FROM order_lines GROUP BY 1) o
JOIN (SELECT return_initiated_date_key // 100 AS month, count(*) AS returns,
        sum(return_cost_aed) AS cost FROM return_lines GROUP BY 1) r USING (month)
WHERE month BETWEEN 199601 AND 199603 WINDOW m AS (ORDER BY month)""")
add("season_cost", f"""
SELECT CAST(date_key AS BIGINT) AS date_key, count(*) AS returns,
  {D('sum(return_cost_aed)', 'return_cost')}
FROM return_lines JOIN calendar ON return_initiated_date_key = date_key
WHERE is_white_friday_period GROUP BY 1""")
for _name, _by in (("rto_by_payment", "payment_method"),
                   ("rto_by_zone", "logistics_zone, payment_method")):
    add(_name, f"""
SELECT {_by}, count(*) AS total_orders, count(*) FILTER (is_shipped) AS shipped_orders,
  count(*) FILTER (is_rto) AS rto_orders, {D('sum(rto_cost_aed)', 'rto_cost')},
  {rate('count(*) FILTER (is_rto)', 'count(*) FILTER (is_shipped)')} AS rto_rate
FROM order_lines GROUP BY ALL""")
add("return_cost_decomposition", f"""
SELECT category, component, {D('a', 'amount')},
  {rate('a', 'sum(a) OVER (PARTITION BY category)')} AS share
FROM (SELECT category, 'reverse_logistics' AS component, sum(reverse_logistics_cost_aed) AS a
      FROM return_lines GROUP BY category
      UNION ALL SELECT category, 'handling', sum(handling_cost_aed) FROM return_lines
      GROUP BY category
      UNION ALL SELECT category, 'merchandise_loss', sum(merchandise_loss_aed) FROM return_lines
      GROUP BY category)""")
add("returns_by_reason", f"""
SELECT reason_group, returns, {I('u', 'units')}, {D('c', 'return_cost')},
  {rate('u', 'sum(u) OVER ()')} AS unit_share, {rate('c', 'sum(c) OVER ()')} AS cost_share
FROM (SELECT COALESCE(reason_group, 'unknown') AS reason_group, count(*) AS returns,
        sum(quantity_returned) AS u, sum(return_cost_aed) AS c FROM return_lines GROUP BY 1)""")
add("recovery_by_condition", f"""
SELECT item_condition_on_receipt, {I('sum(quantity_returned)', 'units')},
  {D('sum(returned_value_aed)', 'returned_value')},
  {D('sum(recovered_value_aed)', 'recovered_value')},
  {rate('sum(recovered_value_aed)', 'sum(returned_value_aed)')} AS recovery_rate
FROM return_lines GROUP BY ALL""")
add("monthly_trend", f"""
SELECT {I('month')}, orders, {D('revenue')}, returns, {D('cost', 'return_cost')},
  {rate('orders - orders_before', 'orders_before')} AS orders_mom,
  {rate('cost - cost_before', 'cost_before')} AS return_cost_mom
FROM (SELECT *,
        max(orders) OVER before AS orders_before, max(cost) OVER before AS cost_before
      FROM (SELECT COALESCE(o.month, r.month) AS month, COALESCE(orders, 0) AS orders, revenue,
        COALESCE(returns, 0) AS returns, cost
      FROM (SELECT order_date_key // 100 AS month, count(*) AS orders,
              sum(realized_net_revenue_aed) AS revenue FROM order_lines GROUP BY 1) o
      FULL JOIN (SELECT return_initiated_date_key // 100 AS month, count(*) AS returns,
              sum(return_cost_aed) AS cost FROM return_lines GROUP BY 1) r ON o.month = r.month)
      WINDOW before AS (ORDER BY month // 100 * 12 + month % 100
                        RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING))""")
add("period_to_date", f"""
SELECT {I('k', 'date_key')}, {D('c', 'return_cost')},
  {D('sum(c) OVER (PARTITION BY k // 100 ORDER BY k ROWS UNBOUNDED PRECEDING)', 'mtd')},
  {D('sum(c) OVER (PARTITION BY k // 10000, (k // 100 % 100 - 1) // 3 ORDER BY k ROWS UNBOUNDED PRECEDING)', 'qtd')},
  {D('sum(c) OVER (PARTITION BY k // 10000 ORDER BY k ROWS UNBOUNDED PRECEDING)', 'ytd')}
FROM (SELECT return_initiated_date_key AS k, sum(return_cost_aed) AS c FROM return_lines
      GROUP BY 1)""")
add("seasonal_return_cost", "\nUNION ALL ".join(f"""
SELECT '{s}' AS season, count(*) FILTER ({s}) AS returns,
  {D(f'COALESCE(sum(return_cost_aed) FILTER ({s}), 0)', 'return_cost')},
  {rate(f'COALESCE(sum(return_cost_aed) FILTER ({s}), 0)', 'sum(return_cost_aed)')} AS share
FROM return_lines LEFT JOIN calendar ON return_initiated_date_key = date_key""" for s in (
    "is_ramadan", "is_eid_period", "is_white_friday_period", "is_uae_public_holiday",
    "is_weekend")))
add("lqs_histogram", f"""
SELECT CAST(least(floor(s / 10), 9) * 10 AS BIGINT) AS bucket_from,
  CAST(CASE WHEN s <= q[1] THEN 1 WHEN s <= q[2] THEN 2 WHEN s <= q[3] THEN 3
    WHEN s IS NOT NULL THEN 4 END AS BIGINT) AS quartile, count(*) AS listings,
  {D('sum(return_cost)', 'return_cost')}
FROM (SELECT CAST(listing_quality_score AS DOUBLE) AS s, return_cost FROM listing_mart),
  (SELECT quantile_cont(CAST(listing_quality_score AS DOUBLE), [0.25, 0.5, 0.75]) AS q
   FROM listing_mart)
GROUP BY ALL""")
add("pareto_recoverable", f"""
SELECT listing_id, {D('recoverable_profit')},
  row_number() OVER (ORDER BY recoverable_profit DESC, listing_id) AS rank,
  {D('sum(recoverable_profit) OVER (ORDER BY recoverable_profit DESC, listing_id ROWS UNBOUNDED PRECEDING)', 'running_total')},
  {rate('sum(recoverable_profit) OVER (ORDER BY recoverable_profit DESC, listing_id ROWS UNBOUNDED PRECEDING)', 'sum(recoverable_profit) OVER ()')}
    AS cumulative_share
FROM listing_mart""")
add("margin_waterfall", "\nUNION ALL ".join(
    f"SELECT category, '{s}' AS step, {D(e, 'amount')} FROM listing_mart GROUP BY category"
    for s, e in (("gross_margin", "sum(gross_margin)"), ("return_cost", "-sum(return_cost)"),
                 ("net_margin", "sum(gross_margin) - sum(return_cost)"))))
add("queue_summary", f"""
SELECT intervention_type, recommended_owner, priority, count(*) AS actions,
  {D('sum(priority_opportunity_aed)', 'opportunity_aed')},
  count(*) FILTER (priority = 'High') AS high_priority,
  {rate('sum(priority_opportunity_aed)', 'sum(sum(priority_opportunity_aed)) OVER ()')}
    AS opportunity_share
FROM queue GROUP BY ALL""")
add("kpi_lookup", typed(("as_of_date_key", "kpi_sort", "kpi_group", "kpi_name", "kpi_label",
                         "kpi_unit", "kpi_value"), "executive",
                        "WHERE kpi_name IN ('total_return_cost', 'total_recoverable_profit', "
                        "'toxic_rto_concentration')"))
add("drill_down", typed(LISTING_COLUMNS, "listing_mart", "WHERE category = 'Fashion'"))
add("rank_by_metric", "\nUNION ALL ".join(
    f"(SELECT listing_id, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM listing_mart "
    f"ORDER BY value DESC NULLS LAST, listing_id LIMIT 25)"
    for m in ("recoverable_profit", "return_cost", "net_margin_after_returns")))
add("unknown_reason_rate", f"""
SELECT category, {I('sum(quantity_returned)', 'returned_units')},
  {I('COALESCE(sum(quantity_returned) FILTER (is_reason_missing), 0)', 'unknown_units')},
  {rate('COALESCE(sum(quantity_returned) FILTER (is_reason_missing), 0)',
        'sum(quantity_returned)')} AS unknown_reason_rate
FROM return_lines GROUP BY category""")
add("net_margin_after_rto", f"""
SELECT seller_id, {D('sum(net_margin_after_returns)', 'net_margin_after_returns')},
  {D('sum(rto_cost)', 'rto_cost')},
  {D('sum(net_margin_after_returns) - sum(rto_cost)', 'net_margin_after_returns_and_rto')},
  {rate('sum(net_margin_after_returns) - sum(rto_cost)', 'sum(realized_net_revenue)')}
    AS net_margin_after_returns_and_rto_pct
FROM listing_mart GROUP BY seller_id""")
add("concentration_by_segment", "\nUNION ALL ".join(f"""
SELECT '{s}' AS segment, value, count(*) AS entities, count(*) FILTER (top) AS top_entities,
  {D('sum(cost)', 'rto_cost')},
  {rate('sum(cost) FILTER (top)', 'sum(cost)')} AS concentration
FROM (SELECT value, cost, percent_rank() OVER (PARTITION BY value ORDER BY cost DESC) <= 0.10 AS top
      FROM (SELECT {s} AS value, seller_id, sum(rto_cost_aed) AS cost FROM order_lines GROUP BY ALL))
GROUP BY value""" for s in ("category", "payment_method")))
add("listing_metrics_monthly", f"""
SELECT COALESCE(o.listing_id, r.listing_id) AS listing_id,
  CAST(COALESCE(o.month, r.month) AS BIGINT) AS month, COALESCE(total_orders, 0) AS total_orders,
  COALESCE(delivered_orders, 0) AS delivered_orders, COALESCE(shipped_orders, 0) AS shipped_orders,
  COALESCE(rto_orders, 0) AS rto_orders, COALESCE(returned_orders, 0) AS returned_orders,
  {rate('rto_orders', 'shipped_orders')} AS rto_rate, {D('COALESCE(gm, 0)', 'gross_margin')},
  {D('COALESCE(rc, 0)', 'return_cost')},
  {D('COALESCE(gm, 0) - COALESCE(rc, 0)', 'net_margin_after_returns')}
FROM (SELECT listing_id, order_date_key // 100 AS month, count(*) AS total_orders,
        count(*) FILTER (is_delivered) AS delivered_orders,
        count(*) FILTER (is_shipped) AS shipped_orders, count(*) FILTER (is_rto) AS rto_orders,
        sum(gross_margin_aed) AS gm FROM order_lines GROUP BY ALL) o
FULL JOIN (SELECT listing_id, return_initiated_date_key // 100 AS month,
             count(*) AS returned_orders, sum(return_cost_aed) AS rc
           FROM return_lines GROUP BY ALL) r
  ON o.listing_id = r.listing_id AND o.month = r.month""")
add("traffic_funnel", f"""
SELECT listing_id, {I('sum(impressions)', 'impressions')},
  {I('sum(detail_page_views)', 'detail_page_views')}, {I('sum(add_to_carts)', 'add_to_carts')},
  {rate('sum(detail_page_views)', 'sum(impressions)')} AS view_rate,
  {rate('sum(add_to_carts)', 'sum(detail_page_views)')} AS cart_rate
FROM clean_traffic GROUP BY listing_id""")
add("queue_top_n", typed(("global_priority_rank", "intervention_id", "intervention_type",
                          "priority_opportunity_aed", "recommended_owner",
                          "recommendation_summary"), "queue",
                         "WHERE global_priority_rank <= 50"))


# -- reports ----------------------------------------------------------------------------------------
_KEYED = "CASE WHEN listing_id % 5 = 0 THEN CAST(listing_id AS VARCHAR) || '.5' " \
         "ELSE CAST(listing_id AS VARCHAR) END"
add("dq_key_normalization", f"""
SELECT count(*) FILTER (k IS NULL) AS null_count, count(*) FILTER (NOT known) AS orphan_count,
  COALESCE({rate('count(k) - count(*) FILTER (NOT known)', 'count(k)')}, 1.0::DOUBLE) AS match_rate,
  COALESCE((SELECT string_agg(k, ',' ORDER BY k) FROM (
    SELECT DISTINCT {_KEYED} AS k FROM raw_orders WHERE {_KEYED} NOT IN
      (SELECT CAST(listing_id AS VARCHAR) FROM raw_listings) ORDER BY k LIMIT 10)), '')
    AS orphan_sample
FROM (SELECT {_KEYED} AS k, {_KEYED} IN (SELECT CAST(listing_id AS VARCHAR) FROM raw_listings)
        AS known FROM raw_orders)""")
_MARTS = {"gold_order_line_economics": "checks_order_economics",
          "gold_return_line_economics": "checks_return_economics",
          "gold_listing_metrics": "checks_listing", "gold_seller_metrics": "checks_seller",
          "gold_category_metrics": "checks_category",
          "gold_executive_summary": "checks_executive",
          "gold_intervention_queue": "checks_queue"}
add("gold_build_checks", "\nUNION ALL ".join(
    f"SELECT '{table}' AS table_name, * FROM ({_CHECK_ROWS[name]})"
    for table, name in _MARTS.items()))
add("audit_report", f"""
SELECT a.*, tables, total_rows, row_counts, COALESCE(blocking_findings, '') AS blocking_findings
FROM (SELECT count(*) AS checks_run, count(*) FILTER (status = 'PASS') AS passed,
        count(*) FILTER (status = 'WARN') AS warnings,
        count(*) FILTER (blocking) AS blocking_failures,
        CASE WHEN bool_or(blocking) THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN'
          ELSE 'PASS' END AS overall_status,
        string_agg(table_name || ': ' || check_name, ',' ORDER BY table_name || ': ' || check_name)
          FILTER (blocking) AS blocking_findings
      FROM ({audit('bronze')})) a,
  (SELECT count(*) AS tables, CAST(sum(n_rows) AS BIGINT) AS total_rows,
     string_agg(table_name || '=' || n_rows, ',' ORDER BY table_name || '=' || n_rows)
       AS row_counts FROM ({_counts('bronze')}))""".replace("SELECT a.*,", """SELECT checks_run,
  passed, warnings, blocking_failures, overall_status,"""))


def _unmapped(table: str, column: str, words) -> str:
    src = _RAW[table]
    known = ", ".join("'" + "_".join(w.strip().lower().replace("_", " ").split()) + "'"
                      for w in words)
    other = f"({denull(column)}) IS NOT NULL AND {enum_form(column)} NOT IN ({known})"
    return (f"SELECT '{table}' AS table_name, 'unmapped_values' AS action, '{column}' AS target, "
            f"(SELECT count(*) FROM {src} WHERE {other}) AS affected, "
            f"COALESCE((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {column} AS v "
            f"FROM {src} WHERE {other} ORDER BY v LIMIT 10)), '') AS detail")


add("cleaning_report", "\nUNION ALL ".join([
    _unmapped("dim_seller", "fulfillment_type", ("marketplace_fulfilled", "seller_fulfilled")),
    _unmapped("dim_seller", "seller_country", S.SELLER_COUNTRIES),
    _unmapped("fact_orders", "payment_method", S.PAYMENT_METHODS),
    _unmapped("fact_returns", "item_condition_on_receipt", S.ITEM_CONDITIONS),
    "SELECT 'fact_orders', 'keep', 'actual_delivery_date_key', "
    "count(*) FILTER (actual_delivery_date_key IS NULL), 'nulls kept' FROM raw_orders"]))


# the build that counts while it writes must say what the separate scans say
STATEMENTS["silver_build_actions"] = STATEMENTS["cleaning_actions"]
STATEMENTS["silver_build_delta"] = STATEMENTS["cleaning_row_delta"]
# the same mart from another layout
STATEMENTS["listing_metrics_bucketed"] = STATEMENTS["listing_metrics"]
