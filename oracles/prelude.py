"""Common table expressions of the comparison SQL, and how they build on each other.

They state the bridged raw layer, the cleaned layer and the business tables over the generic
tables in plain SQL, apart from the Spark code.
"""

from __future__ import annotations

import re

from marginflow import settings as S
from marginflow.sources.bridge import AS_OF, LISTINGS_PER_SELLER

_CTES: dict[str, str] = {}


def _values(rows, columns: str) -> str:
    def cell(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    body = ",\n    ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES\n    {body}) AS t({columns})"


def key_of(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER)"


def squeeze(c: str) -> str:
    return rf"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"


def enum_form(c: str) -> str:
    return rf"regexp_replace({squeeze(c)}, '[\s_]+', '_', 'g')"


def denull(c: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in S.NULL_TOKENS)
    return f"CASE WHEN {squeeze(c)} IN ({tokens}) THEN NULL ELSE {c} END"


def money(e: str) -> str:
    return f"CAST({e} AS DECIMAL(18,4))"


def quot(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def half_up(e: str, n: int) -> str:
    return f"CAST(ROUND(CAST({e} AS DECIMAL(24,12)), {n}) AS DOUBLE)"


def rate(a: str, b: str, n: int = 6) -> str:
    return half_up(quot(a, b), n)


def whole(e: str) -> str:
    return f"CAST(CAST(ROUND({e}, 0) AS BIGINT) AS VARCHAR) || '.0'"


def best_row(source: str, key: list[str], rest: list[str],
             order: list[str] | None = None) -> str:
    """The most complete row of each key; ``order`` decides among equals, else all the rest."""
    filled = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in rest)
    ties = ", ".join(f"{c} ASC NULLS LAST" for c in order or rest)
    return (f"SELECT * FROM {source} QUALIFY ROW_NUMBER() OVER (PARTITION BY {', '.join(key)} "
            f"ORDER BY ({filled}) DESC, {ties}) = 1")


UNIT_PRICE = ("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) "
              "AS DECIMAL(18,4))")
ORDER_REST = ["order_id", "listing_id", "seller_id", "order_date_key", "geo_id",
              "payment_method", "quantity", "unit_selling_price", "item_discount_amount",
              "shipping_fee_charged", "promised_delivery_date_key", "actual_delivery_date_key",
              "delivery_attempts", "order_status"]
RETURN_REST = ["order_line_id", "return_initiated_date_key", "return_received_date_key",
               "reported_reason_code", "item_condition_on_receipt", "quantity_returned",
               "refund_amount", "refund_method"]

# -- raw layer -----------------------------------------------------------------------------
_CTES["raw_orders"] = f"""
SELECT l_orderkey * 8 + l_linenumber AS order_line_id, l_orderkey AS order_id,
  l_partkey AS listing_id, l_suppkey AS seller_id,
  {key_of('o_orderdate')} AS order_date_key, CAST(c_nationkey AS BIGINT) AS geo_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'COD' WHEN '2-HIGH' THEN ' cod '
    WHEN '3-MEDIUM' THEN 'card' WHEN '4-NOT SPECIFIED' THEN 'Wallet' WHEN '5-LOW' THEN 'bnpl'
    ELSE o_orderpriority END AS payment_method,
  CAST(CASE WHEN l_orderkey % 97 = 13 THEN -1 ELSE l_quantity END AS BIGINT) AS quantity,
  {UNIT_PRICE} AS unit_selling_price,
  {money(f"ROUND({UNIT_PRICE} * CAST(l_discount AS DECIMAL(4,2)), 4)")} AS item_discount_amount,
  CASE WHEN l_tax > 0 THEN {money('ROUND(l_tax * 100)')} END AS shipping_fee_charged,
  {key_of("CAST(o_orderdate AS DATE) + INTERVAL 90 DAY")} AS promised_delivery_date_key,
  CASE WHEN (o_orderstatus = 'F' AND l_orderkey % 101 <> 0) OR l_linenumber = 7
    THEN {key_of('l_shipdate')} END AS actual_delivery_date_key,
  CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE l_quantity % 3 + 1 END AS BIGINT)
    AS delivery_attempts,
  CASE WHEN o_orderstatus = 'F' THEN 'delivered'
    WHEN o_orderstatus = 'O' THEN 'cancelled_pre_shipment'
    WHEN l_linenumber % 2 = 1 THEN 'rto_customer_refused' ELSE 'rto_unreachable' END
    AS order_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
"""
RAW_ORDERS_PLACED = _CTES["raw_orders"].replace(
    "FROM lineitem", ", pos FROM (SELECT *, row_number() OVER () AS pos FROM lineitem)")
_CTES["raw_returns"] = f"""
SELECT l_orderkey * 8 + l_linenumber AS return_id, l_orderkey * 8 + l_linenumber AS order_line_id,
  {key_of("CAST(l_shipdate AS DATE) + to_days(CAST(l_linenumber - 2 AS INTEGER))")}
    AS return_initiated_date_key,
  {key_of("CAST(l_shipdate AS DATE) + to_days(CAST(l_linenumber - 2 + l_quantity % 5 - 1 AS INTEGER))")}
    AS return_received_date_key,
  CASE WHEN l_orderkey % 97 <> 0
    THEN 'R0' || lpad(CAST(l_orderkey % 10 + 1 AS VARCHAR), 2, '0') END AS reported_reason_code,
  CASE l_linenumber % 5 WHEN 0 THEN 'resellable' WHEN 1 THEN 'RESELLABLE'
    WHEN 2 THEN ' refurbishable' WHEN 3 THEN 'write off' ELSE 'refurbishable' END
    AS item_condition_on_receipt,
  CAST(floor((l_quantity + 1) / 2) AS BIGINT) AS quantity_returned,
  {money("ROUND(CAST(CAST(floor((l_quantity + 1) / 2) AS DECIMAL(9,0)) * " + UNIT_PRICE
         + " AS DECIMAL(18,4)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))), 4)")}
    AS refund_amount,
  CASE l_linenumber % 2 WHEN 0 THEN 'wallet' ELSE 'card' END AS refund_method
FROM lineitem WHERE l_returnflag = 'R'
"""
_CTES["raw_listings"] = f"""
SELECT p_partkey AS listing_id, CAST(floor(p_partkey / {LISTINGS_PER_SELLER}.0) AS BIGINT) AS seller_id,
  CASE WHEN p_partkey % 211 = 0 THEN 'Garden' WHEN p_type = 'ECONOMY' THEN 'Fashion'
    WHEN p_type = 'LARGE' THEN ' fashion' WHEN p_type = 'STANDARD' THEN 'Electronics'
    WHEN p_type = 'PROMO' THEN 'HOME' WHEN p_type = 'MEDIUM' THEN 'beauty '
    WHEN p_type = 'SMALL' THEN 'Sports' ELSE p_type END AS category,
  p_name AS subcategory,
  CASE WHEN p_partkey % 29 = 0 THEN 'N/A' WHEN p_partkey % 31 = 0 THEN ' none ' ELSE p_brand END
    AS brand,
  CASE WHEN p_partkey % 37 <> 0 THEN {money('p_retailprice')} END AS price,
  (p_partkey % 13) / 10.0::DOUBLE AS discount_pct,
  CAST(CASE WHEN p_partkey % 43 = 0 THEN -1 ELSE p_size % 7 END AS BIGINT) AS image_count,
  p_partkey % 3 = 0 AS has_video,
  CAST(length(p_name) * 4 AS BIGINT) AS title_length_chars,
  CASE WHEN p_partkey % 17 <> 0 THEN p_size * 8.0::DOUBLE END AS description_length_chars,
  CASE WHEN p_partkey % 19 <> 0 THEN (p_partkey % 11) / 10.0::DOUBLE END
    AS specifications_filled_pct,
  CASE WHEN p_partkey % 23 <> 0 THEN p_partkey % 2 = 0 END AS has_size_chart,
  CASE WHEN p_partkey % 27 <> 0 THEN p_partkey % 5 < 2 END AS has_dimensions_listed,
  CAST(p_size % 4 AS BIGINT) AS variant_count,
  CASE WHEN p_partkey % 41 <> 0 THEN p_size * 0.3::DOUBLE END AS item_weight_kg
FROM part
"""
_CTES["raw_sellers"] = """
SELECT s_suppkey AS seller_id, s_name AS seller_name,
  CASE WHEN s_suppkey % 37 = 5 THEN 'n/a' WHEN s_acctbal < 0 THEN NULL
    WHEN s_acctbal < 3000 THEN 'T3' WHEN s_acctbal < 6500 THEN 'T2' ELSE 'T1' END AS seller_tier,
  CASE s_suppkey % 4 WHEN 0 THEN 'marketplace_fulfilled' WHEN 1 THEN 'Seller Fulfilled'
    WHEN 2 THEN ' seller_fulfilled' ELSE 'MARKETPLACE FULFILLED' END AS fulfillment_type,
  CASE s_nationkey % 4 WHEN 0 THEN 'local' WHEN 1 THEN 'cross border' WHEN 2 THEN 'LOCAL'
    ELSE 'cross_border' END AS seller_country
FROM supplier
"""
_CTES["geography"] = """
SELECT CAST(n_nationkey AS BIGINT) AS geo_id, r_name AS emirate, n_name AS city,
  CASE r_regionkey % 3 WHEN 0 THEN 'urban_core' WHEN 1 THEN 'suburban' ELSE 'remote' END
    AS logistics_zone
FROM nation JOIN region ON n_regionkey = r_regionkey
"""
_CTES["raw_calendar"] = f"""
SELECT {key_of('d')} AS date_key, CAST(d AS DATE) AS full_date
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
      FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo,
              CAST(max(o_orderdate) AS DATE) AS hi FROM orders))
"""
_CTES["raw_traffic"] = f"""
SELECT user_id AS listing_id, {key_of('ts')} AS date_key,
  count(*) FILTER (event_type = 'view') AS impressions,
  count(*) FILTER (event_type = 'click') AS detail_page_views,
  CAST(NULLIF(count(*) FILTER (event_type = 'purchase'), 0) AS DOUBLE) AS add_to_carts
FROM events GROUP BY ALL
"""
_CTES["economics"] = ("SELECT category, CAST(gm AS DECIMAL(6,4)) AS gross_margin_pct, "
                      "CAST(h AS DECIMAL(18,4)) AS handling, "
                      "CAST(rs AS DECIMAL(6,4)) AS keep_resellable, "
                      "CAST(rf AS DECIMAL(6,4)) AS keep_refurbishable FROM ("
                      + _values(S.CATEGORY_ECONOMICS, "category, gm, h, rs, rf") + ")")
_CTES["rates"] = ("SELECT logistics_zone, weight_band, CAST(f AS DECIMAL(18,4)) AS forward_cost, "
                  "CAST(r AS DECIMAL(18,4)) AS reverse_cost FROM ("
                  + _values(S.RATE_CARD, "logistics_zone, weight_band, f, r") + ")")
_CTES["reasons"] = _values(
    [(c, g, k) for c, _, g, k, _ in S.RETURN_REASONS],
    "reason_code, reason_group, is_catalog_related")

# -- cleaned layer ---------------------------------------------------------------------------
_CTES["clean_orders"] = f"""
SELECT * REPLACE (
    CASE {enum_form('payment_method')} WHEN 'cod' THEN 'cod' WHEN 'card' THEN 'card'
      WHEN 'wallet' THEN 'wallet' WHEN 'bnpl' THEN 'bnpl' ELSE payment_method END
      AS payment_method,
    COALESCE(shipping_fee_charged, 0) AS shipping_fee_charged),
  payment_method AS raw_payment, shipping_fee_charged IS NULL AS fee_imputed,
  quantity < 1 AS bad_quantity
FROM ({best_row('raw_orders', ['order_line_id'], ORDER_REST)})
"""
_CTES["clean_returns"] = f"""
SELECT * REPLACE (
    CASE {enum_form('item_condition_on_receipt')} WHEN 'resellable' THEN 'resellable'
      WHEN 'refurbishable' THEN 'refurbishable' WHEN 'write_off' THEN 'write_off'
      ELSE item_condition_on_receipt END AS item_condition_on_receipt),
  item_condition_on_receipt AS raw_condition, reported_reason_code IS NULL AS reason_missing
FROM ({best_row('raw_returns', ['return_id'], RETURN_REST)})
"""
_CTES["clean_listings"] = f"""
SELECT * REPLACE (
    CASE WHEN category IS NULL THEN NULL ELSE COALESCE(known, 'Unknown') END AS category,
    COALESCE({denull('brand')}, 'Unknown') AS brand,
    COALESCE(description_length_chars, 0) AS description_length_chars,
    COALESCE(specifications_filled_pct, 0) AS specifications_filled_pct,
    COALESCE(has_size_chart, FALSE) AS has_size_chart,
    COALESCE(has_dimensions_listed, FALSE) AS has_dimensions_listed,
    CASE WHEN discount_pct BETWEEN 0 AND 1 THEN discount_pct END AS discount_pct,
    CASE WHEN image_count >= 0 THEN image_count END AS image_count),
  category AS raw_category, {denull('brand')} IS NULL AS brand_imputed,
  description_length_chars IS NULL AS description_imputed,
  specifications_filled_pct IS NULL AS specifications_imputed,
  has_size_chart IS NULL AS size_chart_imputed,
  has_dimensions_listed IS NULL AS dimensions_imputed,
  price IS NULL AS price_missing, item_weight_kg IS NULL AS weight_missing,
  COALESCE(discount_pct < 0 OR discount_pct > 1, FALSE) AS discount_bad,
  COALESCE(image_count < 0, FALSE) AS images_bad
FROM (SELECT r.*, CASE {squeeze('category')} WHEN 'fashion' THEN 'Fashion'
        WHEN 'electronics' THEN 'Electronics' WHEN 'home' THEN 'Home' WHEN 'beauty' THEN 'Beauty'
        WHEN 'sports' THEN 'Sports' END AS known FROM raw_listings r)
"""
_CTES["clean_sellers"] = f"""
SELECT seller_id, seller_name, COALESCE({denull('seller_tier')}, 'Unknown') AS seller_tier,
  CASE {enum_form('fulfillment_type')} WHEN 'marketplace_fulfilled' THEN 'marketplace_fulfilled'
    WHEN 'seller_fulfilled' THEN 'seller_fulfilled' ELSE fulfillment_type END AS fulfillment_type,
  CASE {enum_form('seller_country')} WHEN 'local' THEN 'local'
    WHEN 'cross_border' THEN 'cross_border' ELSE seller_country END AS seller_country,
  {denull('seller_tier')} IS NULL AS tier_imputed,
  fulfillment_type AS raw_fulfillment, seller_country AS raw_country
FROM raw_sellers
"""
_CTES["clean_traffic"] = """
SELECT listing_id, date_key, impressions, detail_page_views,
  COALESCE(add_to_carts, 0) AS add_to_carts, add_to_carts IS NULL AS carts_imputed
FROM raw_traffic
"""
_CTES["newest_key"] = """
SELECT max(k) AS k FROM (
  SELECT max(greatest(order_date_key, promised_delivery_date_key)) AS k FROM raw_orders
  UNION ALL SELECT max(actual_delivery_date_key) FROM raw_orders
  UNION ALL SELECT max(greatest(return_initiated_date_key, return_received_date_key))
    FROM raw_returns
  UNION ALL SELECT max(date_key) FROM raw_traffic)
"""
_CTES["calendar"] = f"""
SELECT date_key, full_date, strftime(full_date, '%A') AS day_of_week,
  CAST(strftime(full_date, '%V') AS INTEGER) AS week_of_year,
  CAST(month(full_date) AS INTEGER) AS month, CAST(quarter(full_date) AS INTEGER) AS quarter,
  CAST(year(full_date) AS INTEGER) AS year, isodow(full_date) >= 6 AS is_weekend,
  known AND month(full_date) = 3 AS is_ramadan,
  known AND month(full_date) = 4 AND day(full_date) <= 3 AS is_eid_period,
  known AND month(full_date) = 11 AND day(full_date) >= 20 AS is_white_friday_period,
  known AND month(full_date) = 12 AND day(full_date) <= 3 AS is_uae_public_holiday
FROM (
  SELECT date_key, full_date, TRUE AS known FROM raw_calendar
  UNION ALL
  SELECT {key_of('d')}, CAST(d AS DATE), FALSE
  FROM (SELECT unnest(generate_series(
          (SELECT max(full_date) FROM raw_calendar) + INTERVAL 1 DAY,
          (SELECT CAST(strptime(CAST(k AS VARCHAR), '%Y%m%d') AS DATE) FROM newest_key),
          INTERVAL 1 DAY)) AS d))
"""

# -- business tables -------------------------------------------------------------------------
_CTES["weights"] = """
SELECT l.listing_id, l.category, l.weight_missing,
  COALESCE(l.item_weight_kg, m.mid) AS kg,
  CASE WHEN COALESCE(l.item_weight_kg, m.mid) <= 0.5 THEN '<=0.5kg'
    WHEN COALESCE(l.item_weight_kg, m.mid) <= 2 THEN '0.5-2kg'
    WHEN COALESCE(l.item_weight_kg, m.mid) <= 5 THEN '2-5kg' ELSE '5-15kg' END AS weight_band
FROM clean_listings l
LEFT JOIN (SELECT category, median(item_weight_kg) AS mid FROM clean_listings GROUP BY category) m
  ON l.category = m.category
"""
_CTES["order_lines"] = f"""
SELECT b.*,
  {money('ROUND(realized_net_revenue_aed * gross_margin_pct, 4)')} AS gross_margin_aed,
  is_delivered AND actual_delivery_date_key <= promised_delivery_date_key AS is_on_time,
  CASE WHEN is_rto THEN forward_cost ELSE 0 END AS rto_forward_cost_aed,
  CASE WHEN is_rto THEN handling ELSE 0 END AS rto_handling_cost_aed,
  CASE WHEN is_rto THEN forward_cost + handling ELSE 0 END AS rto_cost_aed
FROM (
  SELECT o.order_line_id, o.order_id, o.listing_id, o.seller_id, o.geo_id, w.category,
    o.order_date_key, o.payment_method, o.order_status, o.quantity, o.unit_selling_price,
    o.item_discount_amount, g.logistics_zone, w.weight_band, w.weight_missing AS weight_is_fallback,
    e.gross_margin_pct, e.handling, rc.forward_cost, o.promised_delivery_date_key,
    o.actual_delivery_date_key, o.delivery_attempts, o.bad_quantity AS is_quantity_invalid,
    o.order_status = 'delivered' AS is_delivered,
    o.order_status IN ('rto_customer_refused', 'rto_unreachable') AS is_rto,
    o.order_status = 'cancelled_pre_shipment' AS is_cancelled,
    o.order_status <> 'cancelled_pre_shipment' AS is_shipped,
    o.payment_method = 'cod' AS is_cod,
    CASE WHEN o.order_status = 'delivered' AND NOT o.bad_quantity THEN
      {money('CAST(o.quantity AS DECIMAL(9,0)) * o.unit_selling_price - o.item_discount_amount')}
      END AS realized_net_revenue_aed
  FROM clean_orders o
  LEFT JOIN weights w ON o.listing_id = w.listing_id
  LEFT JOIN economics e ON w.category = e.category
  LEFT JOIN geography g ON o.geo_id = g.geo_id
  LEFT JOIN rates rc ON g.logistics_zone = rc.logistics_zone AND w.weight_band = rc.weight_band
) b
"""
_CTES["return_lines"] = f"""
SELECT v.*,
  {money('ROUND(returned_value_aed * recovery_pct, 4)')} AS recovered_value_aed,
  {money('ROUND(refund_amount - returned_value_aed * recovery_pct, 4)')} AS merchandise_loss_aed,
  {money('ROUND(reverse_logistics_cost_aed + handling_cost_aed + (refund_amount - returned_value_aed * recovery_pct), 4)')}
    AS return_cost_aed
FROM (
  SELECT r.return_id, r.order_line_id, o.listing_id, o.seller_id, o.category,
    r.reported_reason_code, q.reason_group, r.return_initiated_date_key,
    r.return_received_date_key, r.item_condition_on_receipt, r.quantity_returned,
    o.unit_selling_price, r.refund_amount, o.is_delivered AS line_delivered,
    {money('CAST(r.quantity_returned AS DECIMAL(9,0)) * o.unit_selling_price')}
      AS returned_value_aed,
    CASE WHEN r.item_condition_on_receipt = 'resellable' THEN e.keep_resellable
      WHEN r.item_condition_on_receipt = 'refurbishable' THEN e.keep_refurbishable
      ELSE CAST(0 AS DECIMAL(6,4)) END AS recovery_pct,
    rc.reverse_cost AS reverse_logistics_cost_aed, e.handling AS handling_cost_aed,
    e.gross_margin_pct AS pct,
    COALESCE(q.is_catalog_related, FALSE) AS is_catalog_related,
    r.reason_missing AS is_reason_missing
  FROM clean_returns r
  JOIN order_lines o ON r.order_line_id = o.order_line_id
  LEFT JOIN reasons q ON r.reported_reason_code = q.reason_code
  LEFT JOIN economics e ON o.category = e.category
  LEFT JOIN rates rc ON o.logistics_zone = rc.logistics_zone AND o.weight_band = rc.weight_band
) v
"""


def _weight(signal: str) -> str:
    whens = "".join(f" WHEN category = '{c}' THEN {w[signal]}::DOUBLE"
                    for c, w in S.SIGNAL_OVERRIDES.items() if signal in w)
    default = f"{S.SIGNAL_WEIGHTS[signal]}::DOUBLE"
    return f"CASE{whens} ELSE {default} END" if whens else default


SIGNAL_SQL = {
    "image_sufficiency": "least(COALESCE(image_count, 0) / 5.0::DOUBLE, 1.0::DOUBLE)",
    "has_video": "CASE WHEN has_video THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
    "title_adequacy": "CASE WHEN title_length_chars >= 40 THEN 1.0::DOUBLE "
                      "ELSE title_length_chars / 40.0::DOUBLE END",
    "description_adequacy": "least(description_length_chars / 300.0::DOUBLE, 1.0::DOUBLE)",
    "specifications_filled_pct": "specifications_filled_pct",
    "has_size_chart": "CASE WHEN has_size_chart THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
    "has_dimensions_listed":
        "CASE WHEN has_dimensions_listed THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
    "variant_sufficiency": "least(variant_count / 3.0::DOUBLE, 1.0::DOUBLE)",
}
_TOP = " + ".join(f"({_weight(s)}) * ({SIGNAL_SQL[s]})" for s in S.SIGNAL_WEIGHTS)
_BOTTOM = " + ".join(f"({_weight(s)})" for s in S.SIGNAL_WEIGHTS)
_CTES["signal_weights"] = "\nUNION ALL\n".join(
    f"SELECT category, '{s}' AS signal, {_weight(s)} AS raw_weight "
    f"FROM (SELECT DISTINCT category FROM clean_listings)" for s in S.SIGNAL_WEIGHTS)
_CTES["lqs"] = f"""
SELECT listing_id, CAST(ROUND(CAST(100.0::DOUBLE * ({_TOP}) / ({_BOTTOM}) AS DECIMAL(18,8)), 2)
  AS DECIMAL(9,2)) AS listing_quality_score
FROM clean_listings WHERE category IS NOT NULL
"""
_CTES["order_side"] = """
SELECT listing_id, count(*) AS total_orders,
  count(*) FILTER (is_delivered) AS delivered_orders, count(*) FILTER (is_shipped) AS shipped_orders,
  count(*) FILTER (is_rto) AS rto_orders, count(*) FILTER (is_cancelled) AS cancelled_orders,
  sum(quantity) FILTER (is_delivered AND NOT is_quantity_invalid) AS delivered_units,
  sum(gross_margin_aed) AS gross_margin, sum(realized_net_revenue_aed) AS realized_net_revenue,
  sum(rto_cost_aed) AS rto_cost,
  sum(CAST(is_on_time AS INTEGER)) FILTER (is_delivered) AS on_time_delivered,
  sum(delivery_attempts) FILTER (is_delivered) AS attempts_total,
  count(delivery_attempts) FILTER (is_delivered) AS attempts_known
FROM order_lines GROUP BY listing_id
"""
_CTES["return_side"] = """
SELECT listing_id, count(*) AS returned_orders, sum(quantity_returned) AS returned_units,
  sum(quantity_returned) FILTER (is_catalog_related) AS catalog_returned_units,
  sum(quantity_returned) FILTER (reason_group = 'damaged') AS damage_returned_units,
  sum(return_cost_aed) AS return_cost, sum(returned_value_aed) AS returned_value,
  sum(recovered_value_aed) AS recovered_value,
  sum(return_cost_aed) FILTER (is_catalog_related) AS catalog_return_cost,
  sum(return_cost_aed + returned_value_aed * pct) FILTER (is_catalog_related) AS catalog_leakage
FROM return_lines WHERE pct IS NOT NULL GROUP BY listing_id
"""
_CTES["listing_mart"] = f"""
SELECT l.listing_id, l.category, l.seller_id, q.listing_quality_score,
  COALESCE(o.total_orders, 0) AS total_orders, COALESCE(o.delivered_orders, 0) AS delivered_orders,
  COALESCE(o.shipped_orders, 0) AS shipped_orders, COALESCE(o.rto_orders, 0) AS rto_orders,
  COALESCE(o.cancelled_orders, 0) AS cancelled_orders,
  COALESCE(r.returned_orders, 0) AS returned_orders,
  COALESCE(o.delivered_units, 0) AS delivered_units, COALESCE(r.returned_units, 0) AS returned_units,
  COALESCE(r.catalog_returned_units, 0) AS catalog_returned_units,
  {rate('COALESCE(r.catalog_returned_units, 0)', 'o.delivered_units')} AS catalog_return_rate,
  {rate('o.rto_orders', 'o.shipped_orders')} AS rto_rate,
  {rate('r.recovered_value', 'r.returned_value')} AS recovery_rate,
  COALESCE(o.gross_margin, 0) AS gross_margin, COALESCE(r.return_cost, 0) AS return_cost,
  COALESCE(o.gross_margin, 0) - COALESCE(r.return_cost, 0) AS net_margin_after_returns,
  {rate('COALESCE(o.gross_margin, 0) - COALESCE(r.return_cost, 0)', 'o.realized_net_revenue')}
    AS net_margin_after_returns_pct,
  COALESCE(o.rto_cost, 0) AS rto_cost, COALESCE(o.realized_net_revenue, 0) AS realized_net_revenue,
  COALESCE(r.returned_value, 0) AS returned_value, COALESCE(r.recovered_value, 0) AS recovered_value,
  {rate('o.on_time_delivered', 'o.delivered_orders')} AS on_time_delivery_rate,
  {half_up(quot('o.attempts_total', 'o.attempts_known'), 4)} AS avg_delivery_attempts,
  {rate('r.damage_returned_units', 'r.returned_units')} AS damage_return_share,
  ROUND(CAST(COALESCE(r.catalog_leakage, 0) AS DECIMAL(28,8)), 2) AS recoverable_profit,
  o.on_time_delivered, o.attempts_total, o.attempts_known,
  COALESCE(r.catalog_return_cost, 0) AS catalog_return_cost
FROM clean_listings l
LEFT JOIN lqs q ON l.listing_id = q.listing_id
LEFT JOIN order_side o ON l.listing_id = o.listing_id
LEFT JOIN return_side r ON l.listing_id = r.listing_id
"""
_SUMS = ("total_orders", "delivered_orders", "shipped_orders", "rto_orders", "cancelled_orders",
         "returned_orders", "delivered_units", "returned_units", "catalog_returned_units",
         "gross_margin", "return_cost", "rto_cost", "realized_net_revenue", "returned_value",
         "recovered_value", "recoverable_profit")
_SUM_SQL = ", ".join(f"sum({c}) AS {c}" for c in _SUMS)
_CTES["primary_category"] = """
SELECT seller_id, category AS primary_category
FROM (SELECT seller_id, category, count(*) AS n FROM listing_mart GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY n DESC, category NULLS LAST) = 1
"""
_CTES["seller_sums"] = f"""
SELECT seller_id, count(*) AS listing_count,
  count(*) FILTER (total_orders > 0) AS active_listing_count,
  {quot('sum(listing_quality_score)', 'count(listing_quality_score)')} AS mean_lqs, {_SUM_SQL}
FROM listing_mart GROUP BY seller_id
"""
_CTES["seller_delivery"] = f"""
SELECT seller_id, sum(CAST(is_on_time AS INTEGER)) FILTER (is_delivered) AS on_time,
  {quot('sum(delivery_attempts) FILTER (is_delivered)',
        'count(delivery_attempts) FILTER (is_delivered)')} AS attempts
FROM order_lines GROUP BY seller_id
"""
_CTES["seller_damage"] = """
SELECT seller_id, sum(quantity_returned) FILTER (reason_group = 'damaged') AS damaged
FROM return_lines GROUP BY seller_id
"""
_CTES["seller_parts"] = f"""
SELECT b.*,
  {quot('on_time', 'delivered_orders')} AS on_time_delivery_rate_part,
  1.0::DOUBLE - {quot('rto_orders', 'shipped_orders')} AS rto_part,
  1.0::DOUBLE - least({quot('catalog_returned_units', 'delivered_units')}, 1.0::DOUBLE) AS catalog_part,
  CASE WHEN returned_units > 0 THEN 1.0::DOUBLE - {quot('damaged', 'returned_units')}
    WHEN delivered_orders > 0 THEN 1.0::DOUBLE END AS damage_part,
  CASE WHEN delivered_orders > 0
    THEN greatest(0.0::DOUBLE, 1.0::DOUBLE - (attempts - 1.0::DOUBLE) / 2.0::DOUBLE) END AS attempt_part,
  mean_lqs / 100.0::DOUBLE AS lqs_part,
  CASE seller_tier WHEN 'T1' THEN 1.0::DOUBLE WHEN 'T2' THEN 0.67::DOUBLE WHEN 'T3' THEN 0.33::DOUBLE
    ELSE 0.0::DOUBLE END AS tier_part
FROM (
  SELECT s.seller_id, s.seller_name, s.seller_country, s.fulfillment_type, s.seller_tier,
    p.primary_category, COALESCE(t.listing_count, 0) AS listing_count,
    COALESCE(t.active_listing_count, 0) AS active_listing_count, t.mean_lqs,
    {', '.join(f'COALESCE(t.{c}, 0) AS {c}' for c in _SUMS)},
    d.on_time, d.attempts, g.damaged
  FROM clean_sellers s
  LEFT JOIN seller_sums t ON s.seller_id = t.seller_id
  LEFT JOIN seller_delivery d ON s.seller_id = d.seller_id
  LEFT JOIN seller_damage g ON s.seller_id = g.seller_id
  LEFT JOIN primary_category p ON s.seller_id = p.seller_id) b
"""
_PARTS = (("on_time_delivery_rate_part", 0.25), ("rto_part", 0.20), ("catalog_part", 0.20),
          ("damage_part", 0.10), ("attempt_part", 0.10), ("lqs_part", 0.10), ("tier_part", 0.05))
_TRUST = ("100.0::DOUBLE * ((0.0::DOUBLE"
          + "".join(f" + COALESCE({w}::DOUBLE * {c}, 0.0::DOUBLE)" for c, w in _PARTS)
          + ") / (0.0::DOUBLE"
          + "".join(f" + CASE WHEN {c} IS NULL THEN 0.0::DOUBLE ELSE {w}::DOUBLE END"
                    for c, w in _PARTS) + "))")
_CTES["seller_mart"] = f"""
SELECT seller_id, seller_name, seller_country, fulfillment_type, seller_tier, primary_category,
  listing_count, active_listing_count, {', '.join(_SUMS)},
  gross_margin - return_cost AS net_margin_after_returns,
  {rate('gross_margin - return_cost', 'realized_net_revenue')} AS net_margin_after_returns_pct,
  {rate('catalog_returned_units', 'delivered_units')} AS catalog_return_rate,
  {rate('rto_orders', 'shipped_orders')} AS rto_rate,
  {rate('recovered_value', 'returned_value')} AS recovery_rate,
  {rate('on_time', 'delivered_orders')} AS on_time_delivery_rate,
  {half_up('attempts', 4)} AS avg_delivery_attempts,
  {rate('damaged', 'returned_units')} AS damage_return_share,
  {half_up('mean_lqs', 2)} AS average_listing_quality_score,
  CAST(ROUND(CAST({_TRUST} AS DECIMAL(18,8)), 2) AS DECIMAL(9,2)) AS trust_score,
  rto_cost AS seller_rto_cost,
  row_number() OVER (ORDER BY rto_cost DESC, seller_id) AS rto_cost_rank,
  percent_rank() OVER (ORDER BY rto_cost DESC) <= 0.10 AS is_top_decile_rto_cost,
  {quot('rto_orders', 'shipped_orders')} > 0.25 AND shipped_orders >= 30 AS is_toxic_rto,
  {half_up('percent_rank() OVER (PARTITION BY primary_category ORDER BY gross_margin - return_cost)', 4)}
    AS seller_percentile_within_category
FROM seller_parts
"""
_CTES["category_mart"] = f"""
SELECT b.*,
  row_number() OVER (ORDER BY net_margin_after_returns, category NULLS LAST)
    AS category_rank_by_margin_loss,
  row_number() OVER (ORDER BY return_cost DESC, category NULLS LAST) AS category_rank_by_return_cost,
  row_number() OVER (ORDER BY recoverable_profit DESC, category NULLS LAST)
    AS category_rank_by_recoverable_profit,
  {rate('return_cost', 'sum(return_cost) OVER ()')} AS percentage_of_marketplace_return_cost,
  {rate('recoverable_profit', 'sum(recoverable_profit) OVER ()')}
    AS percentage_of_marketplace_recoverable_profit
FROM (
  SELECT s.*, s.gross_margin - s.return_cost AS net_margin_after_returns,
    {rate('s.gross_margin - s.return_cost', 's.realized_net_revenue')}
      AS net_margin_after_returns_pct,
    {rate('s.recovered_value', 's.returned_value')} AS recovery_rate,
    {rate('s.catalog_returned_units', 's.delivered_units')} AS catalog_return_rate,
    {rate('s.rto_orders', 's.shipped_orders')} AS rto_rate,
    {half_up('t.mean_trust', 2)} AS average_trust_score, d.average_delivery_attempts,
    d.on_time_delivery_rate, {half_up('e.gross_margin_pct', 4)} AS category_gross_margin_pct
  FROM (SELECT category, count(*) AS listing_count, count(DISTINCT seller_id) AS seller_count,
          {half_up(quot('sum(listing_quality_score)', 'count(listing_quality_score)'), 2)}
            AS average_listing_quality_score, {_SUM_SQL}
        FROM listing_mart GROUP BY category) s
  LEFT JOIN (SELECT category, {rate('sum(CAST(is_on_time AS INTEGER)) FILTER (is_delivered)',
                                    'count(*) FILTER (is_delivered)')} AS on_time_delivery_rate,
               {half_up(quot('sum(delivery_attempts) FILTER (is_delivered)',
                             'count(delivery_attempts) FILTER (is_delivered)'), 4)}
                 AS average_delivery_attempts
             FROM order_lines GROUP BY category) d ON s.category = d.category
  LEFT JOIN (SELECT p.category, {quot('sum(trust_score)', 'count(trust_score)')} AS mean_trust
             FROM (SELECT DISTINCT category, seller_id FROM listing_mart) p
             JOIN seller_mart m ON p.seller_id = m.seller_id GROUP BY p.category) t
    ON s.category = t.category
  LEFT JOIN economics e ON s.category = e.category) b
"""
_CTES["kpi_names"] = _values(
    [(n, lab, g, u, i) for i, (n, lab, g, u) in enumerate(S.KPI_REGISTER, 1)],
    "kpi_name, kpi_label, kpi_group, kpi_unit, kpi_sort")
_CTES["lqs_band"] = f"""
SELECT quantile_cont(CAST(listing_quality_score AS DOUBLE), 0.25) AS cutoff FROM listing_mart
"""
_CTES["kpi_values"] = f"""
WITH t AS (SELECT sum(total_orders) AS a, sum(delivered_orders) AS b, sum(returned_orders) AS c,
    sum(rto_orders) AS d, sum(shipped_orders) AS s, sum(delivered_units) AS du,
    sum(catalog_returned_units) AS cu, sum(returned_value) AS rv, sum(recovered_value) AS rec,
    sum(realized_net_revenue) AS rev, sum(gross_margin) AS gm, sum(return_cost) AS rc,
    sum(recoverable_profit) AS rp, count(*) FILTER (net_margin_after_returns < 0) AS lossy,
    sum(realized_net_revenue) FILTER (CAST(listing_quality_score AS DOUBLE) <= (SELECT cutoff FROM lqs_band)) AS lrev,
    sum(return_cost) FILTER (CAST(listing_quality_score AS DOUBLE) <= (SELECT cutoff FROM lqs_band)) AS lrc
  FROM listing_mart)
SELECT 'total_orders' AS kpi_name, CAST(a AS DOUBLE) AS kpi_value FROM t
UNION ALL SELECT 'delivered_orders', CAST(b AS DOUBLE) FROM t
UNION ALL SELECT 'returned_orders', CAST(c AS DOUBLE) FROM t
UNION ALL SELECT 'rto_orders', CAST(d AS DOUBLE) FROM t
UNION ALL SELECT 'total_gross_margin', CAST(gm AS DOUBLE) FROM t
UNION ALL SELECT 'total_return_cost', CAST(rc AS DOUBLE) FROM t
UNION ALL SELECT 'total_recoverable_profit', CAST(rp AS DOUBLE) FROM t
UNION ALL SELECT 'net_margin_after_returns', CAST(gm - rc AS DOUBLE) FROM t
UNION ALL SELECT 'marketplace_catalog_return_rate', {quot('cu', 'du')} FROM t
UNION ALL SELECT 'marketplace_rto_rate', {quot('d', 's')} FROM t
UNION ALL SELECT 'aggregate_recovery_rate', {quot('rec', 'rv')} FROM t
UNION ALL SELECT 'toxic_rto_concentration',
  {quot('sum(seller_rto_cost) FILTER (is_top_decile_rto_cost)', 'sum(seller_rto_cost)')}
  FROM seller_mart
UNION ALL SELECT 'fashion_return_cost_share', max(percentage_of_marketplace_return_cost)
  FROM category_mart WHERE category = 'Fashion'
UNION ALL SELECT 'fashion_recoverable_profit_share',
  max(percentage_of_marketplace_recoverable_profit) FROM category_mart WHERE category = 'Fashion'
UNION ALL SELECT 'bottom_lqs_revenue_share', {quot('lrev', 'rev')} FROM t
UNION ALL SELECT 'bottom_lqs_return_cost_share', {quot('lrc', 'rc')} FROM t
UNION ALL SELECT 'loss_making_listing_count', CAST(lossy AS DOUBLE) FROM t
"""
_CTES["executive"] = f"""
SELECT {AS_OF} AS as_of_date_key, kpi_sort, kpi_group, v.kpi_name, kpi_label, kpi_unit, kpi_value
FROM kpi_values v JOIN kpi_names n ON v.kpi_name = n.kpi_name
"""
_CTES["candidates"] = """
SELECT * FROM (SELECT *, CASE
    WHEN net_margin_after_returns < 0 AND listing_quality_score < 45
      AND -net_margin_after_returns >= 100 THEN 'delist'
    WHEN listing_quality_score < 70 AND recoverable_profit >= 100 THEN 'catalog' END AS class
  FROM listing_mart) WHERE class IS NOT NULL
"""
_CTES["coached"] = """
SELECT seller_id, count(*) AS n, sum(recoverable_profit) AS gain, sum(catalog_return_cost) AS cut
FROM candidates WHERE class = 'catalog' GROUP BY seller_id HAVING count(*) >= 8
"""


def _entry(kind: str, source: str, ident: str, category: str, reason: str, summary: str,
           gain: str, cut: str, lqs: str, figures: str, trust: str) -> str:
    prefix, entity, owner, outcome = S.INTERVENTIONS[kind]
    return f"""SELECT '{prefix}-' || CAST({ident} AS VARCHAR) AS intervention_id,
  '{entity}' AS entity_type, CAST({ident} AS VARCHAR) AS entity_id, {category} AS category,
  {figures}.seller_id AS seller_id, '{kind}' AS intervention_type, {reason} AS intervention_reason,
  CAST({gain} AS DECIMAL(38,4)) AS gain, CAST({cut} AS DECIMAL(38,4)) AS cut, CAST({lqs} AS DOUBLE) AS lqs, CAST({trust}.trust_score AS DOUBLE) AS trust,
  {figures}.catalog_return_rate AS crr, {figures}.rto_rate AS rr, {figures}.return_cost AS rc,
  {figures}.gross_margin AS gm, {figures}.net_margin_after_returns AS nm,
  '{owner}' AS owner, '{outcome}' AS outcome, {summary} AS summary
FROM {source}"""


_CTES["proposals"] = "\nUNION ALL\n".join([
    _entry("Catalog Fix",
           "candidates c JOIN seller_mart m ON c.seller_id = m.seller_id WHERE c.class = 'catalog' "
           "AND NOT EXISTS (SELECT 1 FROM coached k WHERE k.seller_id = c.seller_id)",
           "c.listing_id", "c.category",
           f"'Low LQS (' || {whole('c.listing_quality_score')} || ') with AED ' || "
           f"{whole('c.recoverable_profit')} || ' catalog-return leakage'",
           f"'Fix catalog for ' || c.listing_id || ' to recover ~AED ' || "
           f"{whole('c.recoverable_profit')}",
           "c.recoverable_profit", "c.catalog_return_cost", "c.listing_quality_score", "c", "m"),
    _entry("Delisting Candidate",
           "candidates c JOIN seller_mart m ON c.seller_id = m.seller_id WHERE c.class = 'delist'",
           "c.listing_id", "c.category",
           f"'Loss-making (net AED ' || {whole('c.net_margin_after_returns')} || "
           f"') with very low LQS (' || {whole('c.listing_quality_score')} || ')'",
           f"'Delist ' || c.listing_id || ' to stop ~AED ' || "
           f"{whole('-c.net_margin_after_returns')} || ' net loss'",
           "-c.net_margin_after_returns", "-c.net_margin_after_returns",
           "c.listing_quality_score", "c", "m"),
    _entry("Seller Coaching", "coached k JOIN seller_mart m ON k.seller_id = m.seller_id",
           "m.seller_id", "m.primary_category",
           f"'Systemic catalog issues across ' || k.n || ' listings, AED ' || {whole('k.gain')} "
           f"|| ' recoverable'",
           f"'Coach seller ' || m.seller_id || ' (' || k.n || ' listings) to recover ~AED ' || "
           f"{whole('k.gain')}",
           "k.gain", "k.cut", "m.average_listing_quality_score", "m", "m"),
    _entry("COD Risk Reduction",
           "seller_mart m WHERE m.is_top_decile_rto_cost AND m.seller_rto_cost >= 100",
           "m.seller_id", "m.primary_category",
           f"'Top-decile RTO cost (AED ' || {whole('m.seller_rto_cost')} || '), RTO rate ' || "
           f"COALESCE(CAST({half_up('m.rto_rate', 3)} AS VARCHAR), '')",
           f"'Mitigate COD RTO for seller ' || m.seller_id || ' to avoid ~AED ' || "
           f"{whole('m.seller_rto_cost')}",
           "m.seller_rto_cost", "m.seller_rto_cost", "m.average_listing_quality_score", "m", "m"),
])
_RANKED = "ORDER BY gain DESC, entity_type, entity_id, intervention_type"
_CTES["queue"] = f"""
SELECT intervention_id, entity_type, entity_id, category, seller_id, intervention_type,
  intervention_reason,
  CASE ntile(3) OVER ({_RANKED}) WHEN 1 THEN 'High' WHEN 2 THEN 'Medium' ELSE 'Low' END AS priority,
  ROUND(gain, 2) AS priority_opportunity_aed, ROUND(cut, 2) AS estimated_return_cost_reduction,
  ROUND(gain, 2) - ROUND(cut, 2) AS estimated_margin_recovery,
  ROUND(gain, 2) AS estimated_recoverable_profit, {half_up('lqs', 2)} AS listing_quality_score,
  trust AS trust_score, crr AS catalog_return_rate, rr AS rto_rate, ROUND(rc, 2) AS return_cost,
  ROUND(gm, 2) AS gross_margin, ROUND(nm, 2) AS net_margin_after_returns,
  owner AS recommended_owner, outcome AS expected_business_outcome,
  summary AS recommendation_summary,
  row_number() OVER ({_RANKED}) AS global_priority_rank,
  row_number() OVER (PARTITION BY category {_RANKED}) AS category_priority_rank
FROM proposals
"""


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [name for name in _CTES if name in words]


def statement(final: str) -> str:
    """A complete statement: the final SELECT behind the expressions it needs."""
    wanted: set[str] = set()
    pending = _needs(final)
    while pending:
        name = pending.pop()
        if name not in wanted:
            wanted.add(name)
            pending.extend(n for n in _needs(_CTES[name]) if n != name)
    parts = [f"{n} AS MATERIALIZED ({_CTES[n].strip()})" for n in _CTES if n in wanted]
    return ("WITH " + ",\n".join(parts) + "\n" + final.strip()) if parts else final.strip()
