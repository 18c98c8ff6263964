"""Named queries over one warehouse. Results use bigint, double, string, boolean and date only."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import half_up, quotient, rate
from marginflow.operators import audit, cleaning
from marginflow.operators.audit_scan import audit_layer
from marginflow.plans import category as category_plan
from marginflow.plans import executive as executive_plan
from marginflow.plans import facts, layout, levels, queue as queue_plan
from marginflow.plans import listing as listing_plan
from marginflow.plans import reconciliation as checks
from marginflow.plans import seller as seller_plan
from marginflow.plans import sketches, slices
from marginflow.plans.warehouse import (
    CATEGORIES, EXECUTIVE, GOLD_KEYS, LISTINGS, ORDER_LINES, QUEUE, RETURN_LINES, SELLERS,
    Warehouse,
)
from marginflow.settings import CALENDAR_TABLE, PAYMENT_METHODS
from marginflow.settings import CATEGORIES as CATEGORY_NAMES
from marginflow.sources.export import export_tables, read_back
from marginflow.sources.layers import CSV_OPTIONS, CsvScan, row_counts
from marginflow.sources.publish import current, publish, published
from marginflow.sources.schemas import TABLE_DDL, TABLES
from marginflow.sources.scratch import application_folder, durable

Query = Callable[[Warehouse], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Portable column types."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind.startswith("decimal") or kind == "float":
            c = c.cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        out.append(c.alias(name))
    return df.select(*out)


# -- sources and sinks ------------------------------------------------------------------------
@query
def scan_profile(w: Warehouse) -> DataFrame:
    return row_counts({t: w.raw[t] for t in TABLES})


@query
def cleaning_row_delta(w: Warehouse) -> DataFrame:
    return w.row_delta()


@query
def export_roundtrip(w: Warehouse) -> DataFrame:
    gold = w.gold_layer()
    folder = _scratch(gold[QUEUE])
    export_tables(gold, GOLD_KEYS, folder)
    return read_back(gold, folder, GOLD_KEYS)


def _scratch(df: DataFrame) -> str:
    return f"{application_folder(df.sparkSession)}/{uuid.uuid4().hex}"


@query
def scan_quarantine(w: Warehouse) -> DataFrame:
    """The order lines as CSV with cells that do not fit, words for "missing" and lines that are
    too long, scanned under the declared types: per column how many faults, and the smallest."""
    orders = w.raw["fact_orders"]
    key, price = F.col("order_line_id"), F.col("unit_selling_price").cast("string")
    text = {c: F.col(c).cast("string") for c in orders.columns}
    text["quantity"] = F.when(key % 89 == 7, "three").otherwise(text["quantity"])
    text["unit_selling_price"] = F.when(key % 83 == 5, F.concat(F.lit("AED "), price)) \
        .otherwise(price)
    text["order_date_key"] = F.when(key % 79 == 11, F.concat(F.lit("d"), text["order_date_key"])) \
        .otherwise(text["order_date_key"])
    text["delivery_attempts"] = F.when(key % 73 == 3, " N/A ") \
        .otherwise(text["delivery_attempts"])
    line = F.to_csv(F.struct(*[v.alias(c) for c, v in text.items()]),
                    {k: str(v).lower() for k, v in CSV_OPTIONS.items()})
    folder = _scratch(orders)
    orders.select(F.when(key % 71 == 2, F.concat(line, F.lit(",surplus"))).otherwise(line)) \
        .write.text(folder)
    scan = CsvScan(orders.sparkSession, folder, TABLE_DDL["fact_orders"], {"header": False})
    smallest = scan.bad_cells.groupBy(F.col("column_name").alias("of")).agg(
        F.min("value").alias("smallest"))
    kept = scan.table.agg(F.lit("(rows kept)").alias("column_name"),
                          F.count(F.lit(1)).alias("faults"),
                          F.lit(None).cast("string").alias("smallest"))
    return (scan.faults().join(smallest, F.col("column_name") == F.col("of"), "left")
            .select("column_name", "faults", "smallest").unionByName(kept))


@query
def gold_publish(w: Warehouse) -> DataFrame:
    """The business layer published twice, then a run that dies at its last table: readers still
    see the second version, whole."""
    gold = w.gold_layer()
    spark = gold[QUEUE].sparkSession
    folder = _scratch(gold[QUEUE])
    for _ in range(2):
        publish(spark, gold, folder)
    broken = {**gold, QUEUE: gold[QUEUE].withColumn("priority", F.raise_error(F.lit("lost")))}
    try:
        publish(spark, broken, folder)
    except Exception as e:  # the planted one, as Spark wraps it
        if "lost" not in str(e):
            raise
    number = int(current(spark, folder)[1:].split("-")[0])
    return row_counts(published(spark, folder)).withColumn(
        "version", F.lit(number).cast("bigint"))


# -- cleaning -----------------------------------------------------------------------------------
@query
def silver_build_actions(w: Warehouse) -> DataFrame:
    """The action log that is taken while the cleaned layer is written."""
    return w.write_silver(_scratch(w.raw[CALENDAR_TABLE])).actions


@query
def silver_build_delta(w: Warehouse) -> DataFrame:
    """Row counts before and after cleaning, taken the same way."""
    return w.write_silver(_scratch(w.raw[CALENDAR_TABLE])).row_delta


@query
def dedup_first_wins(w: Warehouse) -> DataFrame:
    """Of equally complete order lines with one key the first in the file stays."""
    return cleaning.deduplicate(w.raw.order_lines_as_ingested(), ["order_line_id"])


@query
def clean_null_tokens(w: Warehouse) -> DataFrame:
    df = cleaning.standardize_null_tokens(w.raw["dim_listing"])
    return df.select("listing_id", "category", "subcategory", "brand")


@query
def clean_dedup(w: Warehouse) -> DataFrame:
    return cleaning.deduplicate(w.raw["fact_orders"], ["order_line_id"])


@query
def clean_category(w: Warehouse) -> DataFrame:
    df = cleaning.normalize_category(w.raw["dim_listing"], "category")
    return df.select("listing_id", "category", "dq_category_normalized", "dq_category_unmapped")


@query
def clean_enum(w: Warehouse) -> DataFrame:
    df = cleaning.normalize_enum(w.raw["fact_orders"], "payment_method", PAYMENT_METHODS)
    return df.groupBy("payment_method", "dq_payment_method_normalized").agg(
        F.count(F.lit(1)).alias("n_rows"))


@query
def clean_calendar(w: Warehouse) -> DataFrame:
    return w.silver("dim_date")


@query
def clean_null_policy(w: Warehouse) -> DataFrame:
    rules = w.settings.cleaning["dim_listing"].nulls
    df = cleaning.apply_null_policy(
        cleaning.standardize_null_tokens(w.raw["dim_listing"]), rules)
    return df.select("listing_id", *rules,
                     *[c for c in df.columns if c.startswith("dq_")])


@query
def clean_ranges(w: Warehouse) -> DataFrame:
    bounds = w.settings.cleaning["dim_listing"].bounds
    df = cleaning.flag_invalid_ranges(w.raw["dim_listing"], bounds)
    return df.select("listing_id", *[b.column for b in bounds],
                     *[f"dq_out_of_range_{b.column}" for b in bounds])


@query
def temporal_orders(w: Warehouse) -> DataFrame:
    df = w.silver("fact_orders")
    return df.select("order_line_id", *[c for c in df.columns if c.startswith("dq_")
                                        and c.endswith(("order", "actual", "asof"))])


@query
def temporal_returns(w: Warehouse) -> DataFrame:
    df = w.silver("fact_returns")
    return df.select("return_id", "dq_received_before_initiated", "dq_return_before_delivery",
                     "dq_return_after_asof")


@query
def clean_pipeline(w: Warehouse) -> DataFrame:
    return w.silver("dim_listing")


@query
def clean_sellers(w: Warehouse) -> DataFrame:
    return w.silver("dim_seller")


@query
def pk_guard(w: Warehouse) -> DataFrame:
    return w.key_guard()


@query
def cleaning_actions(w: Warehouse) -> DataFrame:
    return w.actions()


@query
def cleaning_report(w: Warehouse) -> DataFrame:
    return w.action_details()


# -- audit ------------------------------------------------------------------------------------
@query
def dq_primary_key(w: Warehouse) -> DataFrame:
    return audit.union_all([
        audit.primary_key(w.raw[t], contract.key).withColumn("table_name", F.lit(t))
        for t, contract in w.settings.contracts.items()])


@query
def dq_foreign_key(w: Warehouse) -> DataFrame:
    return audit.union_all([
        _references(w, table, calendar=False).select(
            "reference", "null_count", "orphan_count", "match_rate", "orphan_sample")
        for table in ("dim_listing", "fact_listing_traffic", "fact_orders", "fact_returns")])


def _references(w: Warehouse, table: str, calendar: bool) -> DataFrame:
    return audit.foreign_keys(w.raw[table], [
        audit.Reference(f"{table}.{fk.column}", fk.column, w.raw[fk.table], fk.parent_column,
                        calendar)
        for fk in w.settings.contracts[table].foreign_keys
        if (fk.table == CALENDAR_TABLE) == calendar])


@query
def dq_key_normalization(w: Warehouse) -> DataFrame:
    """Keys held as fractional numbers against the same keys as padded text; every fifth is
    moved by a half and must not resolve."""
    key = F.col("listing_id")
    child = w.raw["fact_orders"].select(
        (key + F.when(key % 5 == 0, 0.5).otherwise(0.0)).cast("double").alias("listing_id"))
    parent = w.raw["dim_listing"].select(
        F.concat(F.lit("  "), key.cast("string"), F.lit(" ")).alias("listing_id"))
    return audit.foreign_key(child, "listing_id", parent, "listing_id").select(
        "null_count", "orphan_count", "match_rate", "orphan_sample")


@query
def dq_fk_coverage(w: Warehouse) -> DataFrame:
    return audit.union_all([
        _references(w, table, calendar=True)
        for table in ("fact_listing_traffic", "fact_orders", "fact_returns")])


@query
def dq_leakage(w: Warehouse) -> DataFrame:
    """Metric columns per table and how many values they expose, raw layer against marts."""
    layers = {**{t: w.raw[t] for t in TABLES}, LISTINGS: w.table(LISTINGS)}
    frames = []
    for name, df in layers.items():
        listing = audit.column_listing(df.sparkSession, {name: df})
        offending = audit.leakage(listing).select("offending_columns").scalar()
        metrics = [F.count(c) for c in df.columns if any(
            token in "".join(ch for ch in c.lower() if ch.isalnum())
            for token in audit.FORBIDDEN_COLUMN_TOKENS)]
        exposed = sum(metrics, F.lit(0).cast("bigint"))
        frames.append(df.agg(F.count(F.lit(1)).alias("n_rows"), exposed.alias("exposed_values"))
                      .select(F.lit(name).alias("table_name"), "n_rows",
                              offending.alias("offending_columns"), "exposed_values"))
    return audit.union_all(frames)


@query
def dq_membership(w: Warehouse) -> DataFrame:
    frames = []
    for table, contract in w.settings.contracts.items():
        for m in contract.members:
            parent = w.raw[m.table] if m.table else None
            frames.append(audit.membership(w.raw[table], m.column, m.values, parent,
                                           m.parent_column)
                          .withColumn("reference", F.lit(f"{table}.{m.column}")))
    # the payment method has no audit contract of its own; its enumeration is the vocabulary
    frames.append(audit.membership(w.raw["fact_orders"], "payment_method", PAYMENT_METHODS)
                  .withColumn("reference", F.lit("fact_orders.payment_method")))
    return audit.union_all(frames)


@query
def dq_delivered_only(w: Warehouse) -> DataFrame:
    """All lines flagged as returned, whatever became of their order, against its status."""
    return audit.delivered_only(w.raw["fact_returns"], w.raw["fact_orders"])


@query
def dq_null_profile(w: Warehouse) -> DataFrame:
    return audit.union_all([
        audit.null_profile(w.raw[t]).withColumn("table_name", F.lit(t))
        for t in w.settings.contracts])


@query
def dq_duplicate_rows(w: Warehouse) -> DataFrame:
    return audit.union_all([
        audit.duplicate_rows(w.raw[t], contract.key).withColumn("table_name", F.lit(t))
        for t, contract in w.settings.contracts.items()])


@query
def dq_ranges(w: Warehouse) -> DataFrame:
    return audit.union_all([
        audit.ranges(w.raw[t], contract.bounds).withColumn("table_name", F.lit(t))
        for t, contract in w.settings.contracts.items()
        if contract.bounds and t.startswith(("dim_", "fact_"))])


@query
def dq_funnel(w: Warehouse) -> DataFrame:
    return audit.funnel(w.raw["fact_listing_traffic"],
                        w.settings.contracts["fact_listing_traffic"].funnel)


@query
def audit_full(w: Warehouse) -> DataFrame:
    return audit_layer(w.raw, w.settings).select(
        "table_name", "check_name", "status", "severity", "blocking", "violations")


@query
def audit_details(w: Warehouse) -> DataFrame:
    """What each check found, item by item."""
    return audit_layer(w.raw, w.settings).select(
        "table_name", "check_name", F.explode("details").alias("item", "value"))


@query
def audit_summary(w: Warehouse) -> DataFrame:
    return audit.summarize(audit_layer(w.raw, w.settings))


@query
def audit_report(w: Warehouse) -> DataFrame:
    return audit.report(audit_layer(w.raw, w.settings))


@query
def audit_before_after(w: Warehouse) -> DataFrame:
    """The same contract on the raw and the cleaned layer. Raw tables that come from a join or a
    sum are written once, for both audits, the cleaning and the calendar read them."""
    w, frames = Warehouse(w.raw.kept("fact_orders", "fact_listing_traffic"), w.settings), []
    for layer, tables in (("bronze", w.raw), ("silver", w.stored_silver())):
        results = audit_layer(tables, w.settings)
        frames.append(results.groupBy("table_name").agg(
            F.count(F.lit(1)).alias("checks"),
            F.count_if(F.col("status") == audit.PASS).alias("passed"),
            F.count_if(F.col("status") == audit.WARN).alias("warnings"),
            F.count_if("blocking").alias("blocking"),
        ).withColumn("layer", F.lit(layer)))
    return audit.union_all(frames)


# -- line facts ---------------------------------------------------------------------------------
@query
def weight_fallback(w: Warehouse) -> DataFrame:
    """Every category; NULL where no listing has a weight."""
    listings = w.cleaned("dim_listing")
    medians = facts.category_weight_medians(listings).withColumnRenamed("category", "of")
    return (listings.select("category").distinct()
            .join(medians, F.col("category").eqNullSafe(F.col("of")), "left").drop("of"))


@query
def weight_band(w: Warehouse) -> DataFrame:
    return facts.listing_weights(w.cleaned("dim_listing")).withColumn(
        "weight_kg_effective", half_up(F.col("weight_kg_effective"), 6))


@query
def order_economics(w: Warehouse) -> DataFrame:
    return w.table(ORDER_LINES)


@query
def on_time_rate(w: Warehouse) -> DataFrame:
    lines = w.table(ORDER_LINES).filter("is_delivered")
    return lines.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("delivered_orders"),
        F.count_if("is_on_time").alias("on_time"),
        F.count_if(F.col("is_on_time").isNull()).alias("undated"),
    ).withColumn("on_time_rate", rate(F.col("on_time"), F.col("delivered_orders")))


@query
def rto_cost(w: Warehouse) -> DataFrame:
    return w.table(ORDER_LINES).filter("is_rto").groupBy("logistics_zone", "weight_band",
                                                         "category").agg(
        F.count(F.lit(1)).alias("rto_orders"), F.sum("rto_forward_cost_aed").alias("forward"),
        F.sum("rto_handling_cost_aed").alias("handling"), F.sum("rto_cost_aed").alias("cost"))


@query
def return_economics(w: Warehouse) -> DataFrame:
    return w.table(RETURN_LINES)


@query
def return_cost(w: Warehouse) -> DataFrame:
    return w.table(RETURN_LINES).groupBy("category", "item_condition_on_receipt").agg(
        F.count(F.lit(1)).alias("returns"),
        *[F.sum(c).alias(c) for c in ("returned_value_aed", "recovered_value_aed",
                                      "merchandise_loss_aed", "return_cost_aed")])


# -- entity marts ---------------------------------------------------------------------------------
@query
def lqs_weights(w: Warehouse) -> DataFrame:
    return listing_plan.category_signal_weights(w.cleaned("dim_listing")).withColumn(
        "weight", half_up(F.col("weight"), 9))


@query
def lqs_signals(w: Warehouse) -> DataFrame:
    return listing_plan.listing_signals(w.cleaned("dim_listing")).withColumn(
        "value", half_up(F.col("value"), 9))


@query
def listing_quality_score(w: Warehouse) -> DataFrame:
    return w.cleaned("dim_listing").select(
        "listing_id", "category",
        half_up(listing_plan.quality_score(), 2).alias("listing_quality_score"))


@query
def listing_metrics(w: Warehouse) -> DataFrame:
    return w.table(LISTINGS)


@query
def seller_metrics(w: Warehouse) -> DataFrame:
    return w.table(SELLERS)


@query
def primary_category(w: Warehouse) -> DataFrame:
    return seller_plan.primary_categories(w.cleaned("dim_listing"))


@query
def safe_rates(w: Warehouse) -> DataFrame:
    """Rates by listing and payment method; zero denominators stay undefined.

    On the stored lines: grouped by its join key, the lazy plan could not split a hot listing.
    """
    return w.stored(ORDER_LINES).groupBy("listing_id", "payment_method").agg(
        F.count_if("is_rto").alias("rto_orders"), F.count_if("is_shipped").alias("shipped_orders"),
        F.count_if("is_on_time").alias("on_time"),
        F.count_if("is_delivered").alias("delivered_orders"),
    ).withColumns({
        "rto_rate": rate(F.col("rto_orders"), F.col("shipped_orders")),
        "on_time_rate": rate(F.col("on_time"), F.col("delivered_orders")),
    })


def _seller_base(w: Warehouse) -> DataFrame:
    listings = w.stored(LISTINGS)
    return seller_plan.seller_base(w.cleaned("dim_seller"), listings, w.stored(ORDER_LINES),
                                   w.stored(RETURN_LINES), w.settings)


@query
def trust_score(w: Warehouse) -> DataFrame:
    return _seller_base(w).select("seller_id", "seller_tier", "on_time_delivery_rate",
                                  "avg_delivery_attempts", "damage_return_share", "trust_score")


@query
def seller_ranking(w: Warehouse) -> DataFrame:
    base = durable(_seller_base(w).select("seller_id", "seller_rto_cost", "is_toxic_rto"))
    return seller_plan.add_cost_rank(base, w.settings)


@query
def seller_percentile(w: Warehouse) -> DataFrame:
    base = durable(_seller_base(w).select("seller_id", "primary_category",
                                          "net_margin_after_returns"))
    return seller_plan.add_peer_percentile(base)


@query
def category_metrics(w: Warehouse) -> DataFrame:
    return w.table(CATEGORIES)


@query
def category_trust(w: Warehouse) -> DataFrame:
    listings = w.stored(LISTINGS)
    out = category_plan.category_trust(listings, _seller_base(w))
    return out.withColumn("mean_trust", half_up(F.col("mean_trust"), 2))


@query
def category_ranking(w: Warehouse) -> DataFrame:
    base = category_plan.category_base(w.stored(LISTINGS), _seller_base(w),
                                       w.cleaned("ref_category_economics"))
    return category_plan.add_ranks(base).select(
        "category", "net_margin_after_returns", "return_cost", "recoverable_profit",
        "category_rank_by_margin_loss", "category_rank_by_return_cost",
        "category_rank_by_recoverable_profit")


@query
def category_share(w: Warehouse) -> DataFrame:
    totals = w.stored(LISTINGS).groupBy("category").agg(
        F.sum("return_cost").alias("return_cost"),
        F.sum("recoverable_profit").alias("recoverable_profit"))
    return category_plan.add_shares(totals)


# -- KPIs and queue -------------------------------------------------------------------------------
@query
def executive_summary(w: Warehouse) -> DataFrame:
    return w.table(EXECUTIVE)


@query
def bottom_quartile_share(w: Warehouse) -> DataFrame:
    out = executive_plan.low_quality_band(w.stored(LISTINGS), w.settings)
    return out.withColumns({c: half_up(F.col(c), 9) for c in (
        "cutoff", "revenue_share", "return_cost_share")})


@query
def rto_concentration(w: Warehouse) -> DataFrame:
    base = durable(_seller_base(w).select("seller_id", "seller_rto_cost"))
    flagged = seller_plan.add_cost_rank(base, w.settings)
    return flagged.agg(
        F.count_if("is_top_decile_rto_cost").alias("flagged_sellers"),
        F.count(F.lit(1)).alias("sellers"),
        half_up(quotient(
            F.sum(F.when(F.col("is_top_decile_rto_cost"), F.col("seller_rto_cost"))),
            F.sum("seller_rto_cost")), 9).alias("concentration"))


@query
def intervention_queue(w: Warehouse) -> DataFrame:
    return w.table(QUEUE)


@query
def listing_classification(w: Warehouse) -> DataFrame:
    return queue_plan.classify_listings(w.stored(LISTINGS), w.settings).select(
        "listing_id", "seller_id", "listing_quality_score", "net_margin_after_returns",
        "recoverable_profit", "catalog_return_cost", "intervention_class")


def _candidates(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    found = queue_plan.classify_listings(w.stored(LISTINGS), w.settings)
    return found, queue_plan.coached_sellers(found, w.settings)


@query
def coached_sellers(w: Warehouse) -> DataFrame:
    return _candidates(w)[1]


@query
def catalog_fix(w: Warehouse) -> DataFrame:
    return queue_plan.catalog_fixes(*_candidates(w), _seller_base(w))


@query
def delist_candidates(w: Warehouse) -> DataFrame:
    return queue_plan.delistings(_candidates(w)[0], _seller_base(w))


@query
def seller_coaching(w: Warehouse) -> DataFrame:
    return queue_plan.coachings(_candidates(w)[1], _seller_base(w))


@query
def cod_risk(w: Warehouse) -> DataFrame:
    return queue_plan.cod_risks(w.stored(SELLERS), w.settings)


# -- reconciliation -------------------------------------------------------------------------------
@query
def checks_order_economics(w: Warehouse) -> DataFrame:
    return checks.order_line_checks(w.stored(ORDER_LINES), w.source_totals("fact_orders"))


@query
def checks_return_economics(w: Warehouse) -> DataFrame:
    lines = w.stored(ORDER_LINES)
    return checks.return_line_checks(w.stored(RETURN_LINES), lines,
                                     w.source_totals("fact_returns"))


@query
def checks_listing(w: Warehouse) -> DataFrame:
    return checks.listing_checks(w.stored(LISTINGS), w.stored(ORDER_LINES),
                                 w.stored(RETURN_LINES), w.cleaned("dim_listing"))


@query
def checks_seller(w: Warehouse) -> DataFrame:
    return checks.seller_checks(w.stored(SELLERS), w.stored(LISTINGS), w.stored(ORDER_LINES),
                                w.stored(RETURN_LINES), w.cleaned("dim_seller"), w.settings)


@query
def checks_category(w: Warehouse) -> DataFrame:
    return checks.category_checks(w.stored(CATEGORIES), w.stored(LISTINGS), w.settings)


@query
def checks_executive(w: Warehouse) -> DataFrame:
    summary = w.stored(EXECUTIVE)
    return checks.executive_checks(summary, w.stored(LISTINGS), w.stored(SELLERS),
                                   w.stored(CATEGORIES), w.stored(ORDER_LINES),
                                   w.stored(RETURN_LINES), w.settings)


@query
def checks_queue(w: Warehouse) -> DataFrame:
    return checks.queue_checks(w.stored(QUEUE), w.stored(LISTINGS), w.settings)


@query
def row_count_regression(w: Warehouse) -> DataFrame:
    gold = w.gold_layer()
    return checks.row_count_regression(gold, checks.expected_counts(w.cleaned, w.totals))


@query
def gold_build_checks(w: Warehouse) -> DataFrame:
    """All checks of the business build in one table."""
    return w.gold_checks()


# -- slices -----------------------------------------------------------------------------------------
@query
def weighted_rates_by_slice(w: Warehouse) -> DataFrame:
    lines = w.table(ORDER_LINES)
    return slices.weighted_rates(lines, w.table(RETURN_LINES), ("seller_id", "category"))


@query
def rates_by_level(w: Warehouse) -> DataFrame:
    """Marketplace, category, seller and category x seller in one sum of each fact."""
    lines = w.table(ORDER_LINES)
    return levels.rates_by_level(lines, w.table(RETURN_LINES))


SKETCHED = {"median": 0.5, "p90": 0.9}


@query
def sketch_accuracy(w: Warehouse) -> DataFrame:
    """Median and 90th percentile of line revenue and the number of orders, per category from
    stored listing-month sketches, held against the lines."""
    lines = w.stored(ORDER_LINES)
    stored = durable(sketches.listing_month_sketches(lines), "sketches")
    answers = sketches.from_sketches(stored, ["category"], SKETCHED)
    errors = sketches.measured_errors(lines, answers, ["category"], SKETCHED)
    close = [(F.col(f"{name}_rank_error") <= sketches.RANK_ERROR).alias(f"{name}_close")
             for name in SKETCHED]
    return errors.select("category", "lines", *close,
                         (F.col("count_error") <= sketches.COUNT_ERROR).alias("orders_close"))


@query
def quarter_trend(w: Warehouse) -> DataFrame:
    """One quarter of the monthly trend, from facts laid out by month: only its months are read."""
    sold = layout.by_month(w.stored(ORDER_LINES).select(
        "order_date_key", "realized_net_revenue_aed"), "order_date_key")
    back = layout.by_month(w.stored(RETURN_LINES).select(
        "return_initiated_date_key", "return_cost_aed"), "return_initiated_date_key")
    return slices.monthly_trend(layout.in_months(sold, 199601, 199603),
                                layout.in_months(back, 199601, 199603))


@query
def season_cost(w: Warehouse) -> DataFrame:
    """Return cost by day of the White Friday periods; the calendar prunes the months."""
    back = layout.by_month(w.stored(RETURN_LINES).select(
        "return_initiated_date_key", "return_cost_aed"), "return_initiated_date_key")
    found = layout.in_season(back, w.silver(CALENDAR_TABLE), "is_white_friday_period",
                             "return_initiated_date_key")
    return found.groupBy(F.col("return_initiated_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("returns"), F.sum("return_cost_aed").alias("return_cost"))


@query
def listing_metrics_bucketed(w: Warehouse) -> DataFrame:
    """The listing mart from facts hashed and sorted by their keys."""
    return Warehouse(w.raw, w.settings, buckets=16).table(LISTINGS)


@query
def rto_by_payment(w: Warehouse) -> DataFrame:
    return slices.rto_by(w.table(ORDER_LINES), "payment_method")


@query
def rto_by_zone(w: Warehouse) -> DataFrame:
    return slices.rto_by(w.table(ORDER_LINES), "logistics_zone", "payment_method")


@query
def return_cost_decomposition(w: Warehouse) -> DataFrame:
    return slices.return_cost_decomposition(w.table(RETURN_LINES), "category")


@query
def returns_by_reason(w: Warehouse) -> DataFrame:
    return slices.returns_by_reason(w.table(RETURN_LINES))


@query
def recovery_by_condition(w: Warehouse) -> DataFrame:
    return slices.recovery_by_condition(w.table(RETURN_LINES))


@query
def monthly_trend(w: Warehouse) -> DataFrame:
    lines = w.table(ORDER_LINES)
    return slices.monthly_trend(lines, w.table(RETURN_LINES))


@query
def period_to_date(w: Warehouse) -> DataFrame:
    return slices.period_to_date(w.table(RETURN_LINES))


@query
def seasonal_return_cost(w: Warehouse) -> DataFrame:
    return slices.seasonal_return_cost(w.table(RETURN_LINES), w.silver("dim_date"))


@query
def lqs_histogram(w: Warehouse) -> DataFrame:
    return slices.score_histogram(w.stored(LISTINGS))


@query
def pareto_recoverable(w: Warehouse) -> DataFrame:
    return slices.pareto(w.stored(LISTINGS), "listing_id", "recoverable_profit")


@query
def margin_waterfall(w: Warehouse) -> DataFrame:
    return slices.margin_waterfall(w.stored(LISTINGS), "category")


@query
def queue_summary(w: Warehouse) -> DataFrame:
    return slices.queue_summary(w.table(QUEUE))


@query
def kpi_lookup(w: Warehouse) -> DataFrame:
    return executive_plan.kpi(w.table(EXECUTIVE), "total_return_cost",
                              "total_recoverable_profit", "toxic_rto_concentration")


@query
def drill_down(w: Warehouse) -> DataFrame:
    """From a category to its listings."""
    return slices.drill_down(w.table(LISTINGS), category=CATEGORY_NAMES[0])


@query
def rank_by_metric(w: Warehouse) -> DataFrame:
    return audit.union_all([
        slices.rank_by(plain(w.stored(LISTINGS)), "listing_id", metric, 25)
        for metric in ("recoverable_profit", "return_cost", "net_margin_after_returns")])


@query
def unknown_reason_rate(w: Warehouse) -> DataFrame:
    return slices.unknown_reason_rate(w.table(RETURN_LINES), "category")


@query
def net_margin_after_rto(w: Warehouse) -> DataFrame:
    return slices.net_margin_after_rto(w.stored(LISTINGS), "seller_id")


@query
def concentration_by_segment(w: Warehouse) -> DataFrame:
    lines = durable(w.table(ORDER_LINES).groupBy("category", "payment_method", "seller_id")
                    .agg(F.sum("rto_cost_aed").alias("rto_cost_aed")), "rto_cost")
    frames = []
    for segment in ("category", "payment_method"):
        out = slices.concentration(lines, "seller_id", segment, w.settings.toxic_top_fraction)
        frames.append(out.withColumnRenamed(segment, "value")
                      .withColumn("segment", F.lit(segment)))
    return audit.union_all(frames)


@query
def listing_metrics_monthly(w: Warehouse) -> DataFrame:
    lines = w.table(ORDER_LINES)
    return slices.listing_months(lines, w.table(RETURN_LINES))


@query
def traffic_funnel(w: Warehouse) -> DataFrame:
    return slices.traffic_funnel(w.cleaned("fact_listing_traffic"), "listing_id")


@query
def queue_top_n(w: Warehouse) -> DataFrame:
    return slices.queue_top(w.table(QUEUE), 50).select(
        "global_priority_rank", "intervention_id", "intervention_type",
        "priority_opportunity_aed", "recommended_owner", "recommendation_summary")
