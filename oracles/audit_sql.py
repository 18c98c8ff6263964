"""SQL of the contract audit, one row per check, for the raw and the cleaned layer."""

from __future__ import annotations

from marginflow import settings as S
from oracles.prelude import squeeze

_ECON = ("(SELECT category, gross_margin_pct, handling AS warehouse_handling_cost_aed, "
         "keep_resellable AS recovery_pct_resellable, "
         "keep_refurbishable AS recovery_pct_refurbishable FROM economics)")
_CARD = ("(SELECT logistics_zone, weight_band, 'forward' AS leg, forward_cost AS cost_aed FROM rates "
         "UNION ALL SELECT logistics_zone, weight_band, 'reverse', reverse_cost FROM rates)")
_FIXED = {"dim_geography": "geography", "dim_return_reason": "reasons",
          "ref_category_economics": _ECON, "ref_logistics_rate_card": _CARD}
LAYERS = {
    "bronze": {"dim_date": "raw_calendar", "dim_seller": "raw_sellers",
               "dim_listing": "raw_listings", "fact_listing_traffic": "raw_traffic",
               "fact_orders": "raw_orders", "fact_returns": "raw_returns", **_FIXED},
    "silver": {"dim_date": "calendar", "dim_seller": "clean_sellers",
               "dim_listing": "clean_listings", "fact_listing_traffic": "clean_traffic",
               "fact_orders": "clean_orders", "fact_returns": "clean_returns", **_FIXED},
}
COLUMNS = {
    "dim_date": ["date_key", "full_date"],
    "dim_geography": ["geo_id", "emirate", "city", "logistics_zone"],
    "dim_return_reason": ["reason_code", "reason_group", "is_catalog_related"],
    "dim_seller": ["seller_id", "seller_name", "seller_tier", "fulfillment_type",
                   "seller_country"],
    "dim_listing": ["listing_id", "seller_id", "category", "subcategory", "brand", "price",
                    "discount_pct", "image_count", "has_video", "title_length_chars",
                    "description_length_chars", "specifications_filled_pct", "has_size_chart",
                    "has_dimensions_listed", "variant_count", "item_weight_kg"],
    "fact_listing_traffic": ["listing_id", "date_key", "impressions", "detail_page_views",
                             "add_to_carts"],
    "fact_orders": ["order_line_id", "order_id", "listing_id", "seller_id", "order_date_key",
                    "geo_id", "payment_method", "quantity", "unit_selling_price",
                    "item_discount_amount", "shipping_fee_charged",
                    "promised_delivery_date_key", "actual_delivery_date_key",
                    "delivery_attempts", "order_status"],
    "fact_returns": ["return_id", "order_line_id", "return_initiated_date_key",
                     "return_received_date_key", "reported_reason_code",
                     "item_condition_on_receipt", "quantity_returned", "refund_amount",
                     "refund_method"],
    "ref_category_economics": ["category", "gross_margin_pct", "warehouse_handling_cost_aed",
                               "recovery_pct_resellable", "recovery_pct_refurbishable"],
    "ref_logistics_rate_card": ["logistics_zone", "weight_band", "leg", "cost_aed"],
}


def outside(b: S.Bounds) -> str:
    parts = ([f"{b.column} < {b.low}"] if b.low is not None else []) + (
        [f"{b.column} > {b.high}"] if b.high is not None else [])
    return " OR ".join(parts)


def _row(table: str, check: str, kind: str, fails: str, warns: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{kind}' AS kind, "
            f"CAST(COALESCE({fails}, 0) AS BIGINT) AS fails, "
            f"CAST(COALESCE({warns}, 0) AS BIGINT) AS warns")


def table_rows(table: str, layer: dict[str, str]) -> list[str]:
    src, contract = layer[table], S.CONTRACTS[table]
    key = ", ".join(contract.key)
    null_key = " OR ".join(f"{c} IS NULL" for c in contract.key)
    out = [
        _row(table, "leakage", "hard", "0", "0"),
        _row(table, "primary_key", "hard",
             f"(SELECT sum(CASE WHEN n > 1 THEN n ELSE 0 END) + "
             f"sum(CASE WHEN {null_key} THEN n ELSE 0 END) "
             f"FROM (SELECT {key}, count(*) AS n FROM {src} GROUP BY ALL))", "0"),
        _row(table, "duplicate_rows", "soft", "0",
             f"(SELECT sum(n) FROM (SELECT {', '.join(COLUMNS[table])}, count(*) AS n FROM {src} "
             f"GROUP BY ALL) WHERE n > 1)"),
        _row(table, "null_analysis", "soft", "0",
             "(SELECT " + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in COLUMNS[table])
             + f" FROM {src})"),
    ]
    for fk in contract.foreign_keys:
        parent = layer[fk.table]
        orphan = (f"c.{fk.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p "
                  f"WHERE p.{fk.parent_column} = c.{fk.column})")
        if fk.table == S.CALENDAR_TABLE:
            last = f"(SELECT max({fk.parent_column}) FROM {parent})"
            fails = f"(SELECT count(*) FROM {src} c WHERE {orphan} AND c.{fk.column} <= {last})"
            warns = f"(SELECT count(*) FROM {src} c WHERE {orphan} AND c.{fk.column} > {last})"
        else:
            fails, warns = f"(SELECT count(*) FROM {src} c WHERE {orphan})", "0"
        out.append(_row(table, f"fk:{fk.column}", "hard", fails, warns))
    for m in contract.members:
        words = ("(SELECT " + m.parent_column + f" FROM {layer[m.table]})" if m.table
                 else "(" + ", ".join(f"'{v}'" for v in m.values) + ")")
        forms = (f"(SELECT {squeeze(m.parent_column)} FROM {layer[m.table]})" if m.table
                 else "(" + ", ".join(f"'{v.lower()}'" for v in m.values) + ")")
        known = f"{squeeze(m.column)} IN {forms}"
        out.append(_row(
            table, f"membership:{m.column}", "hard",
            f"(SELECT count(*) FROM {src} WHERE {m.column} IS NOT NULL AND NOT {known})",
            f"(SELECT count(*) FROM {src} WHERE {m.column} IS NOT NULL AND {known} "
            f"AND {m.column} NOT IN {words})"))
    if contract.bounds:
        out.append(_row(table, "distribution_ranges", "soft", "0",
                        "(SELECT " + " + ".join(f"count(*) FILTER ({outside(b)})"
                                                for b in contract.bounds) + f" FROM {src})"))
    if contract.funnel:
        steps = zip(contract.funnel, contract.funnel[1:])
        out.append(_row(table, "funnel_monotonicity", "soft", "0",
                        "(SELECT " + " + ".join(f"count(*) FILTER ({u} < {v})" for u, v in steps)
                        + f" FROM {src})"))
    if contract.delivered_only:
        orders = (f"(SELECT order_line_id, max(order_status) AS s FROM {layer['fact_orders']} "
                  f"GROUP BY 1)")
        out.append(_row(table, "returns_delivered_reconciliation", "hard",
                        f"(SELECT count(*) FROM {src} r LEFT JOIN {orders} o "
                        f"ON r.order_line_id = o.order_line_id WHERE r.order_line_id IS NOT NULL "
                        f"AND (o.order_line_id IS NULL OR o.s <> 'delivered'))", "0"))
    return out


def audit(layer: str) -> str:
    """(table_name, check_name, status, severity, blocking, violations) of a layer."""
    found = "\nUNION ALL ".join(r for t in S.CONTRACTS for r in table_rows(t, LAYERS[layer]))
    return f"""
SELECT table_name, check_name,
  CASE WHEN fails > 0 THEN 'FAIL' WHEN warns > 0 THEN 'WARN' ELSE 'PASS' END AS status,
  CASE WHEN kind = 'soft' OR (fails = 0 AND warns > 0) THEN 'warn' ELSE 'error' END AS severity,
  kind = 'hard' AND fails > 0 AS blocking, fails + warns AS violations
FROM ({found})"""


def _item(table: str, check: str, item: str, value: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{item}' AS item, "
            f"CAST({value} AS VARCHAR) AS value")


def _listed(values: str) -> str:
    """The ten smallest of distinct texts."""
    return (f"COALESCE((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT CAST(v AS VARCHAR) "
            f"AS v FROM ({values}) ORDER BY v LIMIT 10)), '')")


def _share(part: str, whole: str) -> str:
    return f"CAST(ROUND(CAST({part} AS DOUBLE) / {whole}, 6) AS DOUBLE)"


def table_items(table: str, layer: dict[str, str]) -> list[str]:
    src, contract = layer[table], S.CONTRACTS[table]
    key = ", ".join(contract.key)
    null_key = " OR ".join(f"{c} IS NULL" for c in contract.key)
    rows = f"(SELECT count(*) FROM {src})"
    keys = f"(SELECT {key}, count(*) AS n FROM {src} GROUP BY ALL)"
    copies = (f"COALESCE((SELECT sum(n) FROM (SELECT {', '.join(COLUMNS[table])}, count(*) AS n "
              f"FROM {src} GROUP BY ALL) WHERE n > 1), 0)")
    out = [_item(table, "leakage", "offending_columns", "''"),
           _item(table, "primary_key", "row_count", rows),
           _item(table, "primary_key", "null_key_rows",
                 f"COALESCE((SELECT sum(n) FROM {keys} WHERE {null_key}), 0)"),
           _item(table, "primary_key", "duplicate_rows",
                 f"COALESCE((SELECT sum(n) FROM {keys} WHERE n > 1), 0)"),
           _item(table, "primary_key", "duplicate_groups",
                 f"(SELECT count(*) FROM {keys} WHERE n > 1)"),
           _item(table, "duplicate_rows", "row_count", rows),
           _item(table, "duplicate_rows", "duplicate_rows", copies),
           _item(table, "null_analysis", "row_count", rows)]
    for c in COLUMNS[table]:
        out.append(f"SELECT '{table}', 'null_analysis', '{c}', "
                   f"'nulls=' || k || ' pct=' || {_share('k', 'n')} "
                   f"FROM (SELECT count(*) FILTER ({c} IS NULL) AS k, count(*) AS n FROM {src}) "
                   f"WHERE k > 0")
    for b in contract.bounds:
        low, high = ("" if v is None else v for v in (b.low, b.high))
        out.append(
            f"SELECT '{table}', 'distribution_ranges', '{b.column}', 'out_of_range=' || k || "
            f"' bounds=[{low},{high}] observed=[' || CAST(a AS DOUBLE) || ',' || "
            f"CAST(z AS DOUBLE) || ']' FROM (SELECT count(*) FILTER ({outside(b)}) AS k, "
            f"min({b.column}) AS a, max({b.column}) AS z FROM {src}) WHERE k > 0")
    for u, v in zip(contract.funnel, contract.funnel[1:]):
        out.append(f"SELECT '{table}', 'funnel_monotonicity', '{u}<{v}', CAST(k AS VARCHAR) "
                   f"FROM (SELECT count(*) FILTER ({u} < {v}) AS k FROM {src}) WHERE k > 0")
    for fk in contract.foreign_keys:
        check, parent = f"fk:{fk.column}", layer[fk.table]
        orphans = (f"SELECT c.{fk.column} AS v FROM {src} c WHERE c.{fk.column} IS NOT NULL AND "
                   f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{fk.parent_column} = "
                   f"c.{fk.column})")
        count, late = f"(SELECT count(*) FROM ({orphans}))", "false"
        if fk.table == S.CALENDAR_TABLE:
            late = f"v > (SELECT max({fk.parent_column}) FROM {parent})"
        filled = f"(SELECT count({fk.column}) FROM {src})"
        out += [_item(table, check, "null_count", f"{rows} - {filled}"),
                _item(table, check, "orphan_count", count),
                _item(table, check, "broken_orphans",
                      f"(SELECT count(*) FROM ({orphans}) WHERE NOT ({late}))"),
                _item(table, check, "coverage_orphans",
                      f"(SELECT count(*) FROM ({orphans}) WHERE {late})"),
                _item(table, check, "coverage_extend_through", "COALESCE(CAST((SELECT max(v) "
                      f"FROM ({orphans}) WHERE {late}) AS VARCHAR), '')"),
                _item(table, check, "match_rate", f"CASE WHEN {filled} = 0 THEN 1.0::DOUBLE ELSE "
                      + _share(f"({filled} - {count})", filled) + " END"),
                _item(table, check, "orphan_sample", _listed(orphans))]
    for m in contract.members:
        check = f"membership:{m.column}"
        words = ("(SELECT " + m.parent_column + f" FROM {layer[m.table]})" if m.table
                 else "(" + ", ".join(f"'{v}'" for v in m.values) + ")")
        forms = (f"(SELECT {squeeze(m.parent_column)} FROM {layer[m.table]})" if m.table
                 else "(" + ", ".join(f"'{v.lower()}'" for v in m.values) + ")")
        known = f"{squeeze(m.column)} IN {forms}"
        for kind, condition in (("unknown", f"NOT {known}"), (
                "needs_normalization", f"{known} AND {m.column} NOT IN {words}")):
            found = (f"SELECT {m.column} AS v FROM {src} WHERE {m.column} IS NOT NULL "
                     f"AND {condition}")
            out += [_item(table, check, f"{kind}_count", f"(SELECT count(*) FROM ({found}))"),
                    _item(table, check, f"{kind}_sample", _listed(found))]
    if contract.delivered_only:
        check = "returns_delivered_reconciliation"
        states = (f"(SELECT o.order_line_id IS NULL AS lost, o.s FROM {src} r LEFT JOIN "
                  f"(SELECT order_line_id, max(order_status) AS s FROM {layer['fact_orders']} "
                  f"GROUP BY 1) o ON r.order_line_id = o.order_line_id "
                  f"WHERE r.order_line_id IS NOT NULL)")
        other = "NOT lost AND s <> 'delivered'"
        out += [_item(table, check, "returns_with_order_ref", f"(SELECT count(*) FROM {states})"),
                _item(table, check, "unmatched_order_lines",
                      f"(SELECT count(*) FROM {states} WHERE lost)"),
                _item(table, check, "without_status",
                      f"(SELECT count(*) FROM {states} WHERE NOT lost AND s IS NULL)"),
                _item(table, check, "returns_against_non_delivered",
                      f"(SELECT count(*) FROM {states} WHERE {other})"),
                _item(table, check, "non_delivered_status_breakdown",
                      f"COALESCE((SELECT string_agg(s || '=' || n, ',' ORDER BY s) FROM (SELECT s, "
                      f"count(*) AS n FROM {states} WHERE {other} GROUP BY s)), '')")]
    return out


def details(layer: str) -> str:
    """(table_name, check_name, item, value): what every check reports."""
    return "\nUNION ALL ".join(i for t in S.CONTRACTS for i in table_items(t, LAYERS[layer]))
