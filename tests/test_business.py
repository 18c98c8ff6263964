from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marginflow.operators import audit, observed
from marginflow.operators.audit_scan import audit_layer
from marginflow.plans import reconciliation as R
from marginflow.plans import seller as seller_plan
from marginflow.plans import slices
from marginflow.plans import warehouse as warehouse_module
from marginflow.plans.warehouse import (
    CATEGORIES, EXECUTIVE, GOLD_KEYS, LISTINGS, ORDER_LINES, QUEUE, RETURN_LINES, SELLERS,
    BuildFailure, GuardFailure, Warehouse,
)
from marginflow.settings import DEFAULT
from marginflow.sources import inline
from marginflow.sources.export import MissingTables, export_tables, read_back
from marginflow.sources.layers import MissingTable, read_layer, register_views, write_layer
from marginflow.sources.publish import publish, published
from marginflow.sources.schemas import TABLE_DDL
from marginflow.sources.scratch import durable


def make(spark, table, rows):
    return spark.createDataFrame(rows, TABLE_DDL[table])


@pytest.fixture(scope="module")
def raw(spark):
    """A tiny marketplace whose results are worked out by hand below."""
    listing = ("brand", date(2026, 1, 1), D(100), 0.1)
    return {
        "dim_date": make(spark, "dim_date", [
            (20260101, date(2026, 1, 1), "Thursday", 1, 1, 1, 2026, False, True, False, False,
             False)]),
        "dim_geography": make(spark, "dim_geography", [
            ("G1", "Dubai", "Deira", "urban_core", "urban_core")]),
        "dim_return_reason": inline.return_reasons(spark),
        "dim_seller": make(spark, "dim_seller", [
            ("S1", "One", "T1", "Seller Fulfilled", "local", "2024-01-01"),
            ("S2", "Two", None, "seller_fulfilled", "LOCAL", "01/02/2024"),
            ("S2", "Two", None, "seller_fulfilled", "LOCAL", "01/02/2024")]),
        "dim_listing": make(spark, "dim_listing", [
            ("L1", "S1", " fashion", "s", *listing, 5, True, 40, 300.0, 1.0, True, True, 3, 0.4),
            ("L2", "S1", "Home", "s", *listing, -1, False, 20, None, None, None, None, 0, None),
            ("L3", "S2", "Home", "s", *listing, 1, False, 20, 150.0, 0.5, True, False, 3, 3.0)]),
        "fact_listing_traffic": make(spark, "fact_listing_traffic", [
            ("L1", 20260101, 10, 12, None)]),
        "fact_orders": make(spark, "fact_orders", [
            ("O1", "o", "L1", "S1", 20260101, "G1", " COD ", 2, D(100), D(10), None, 20260105,
             20260104, 1, "delivered"),
            ("O2", "o", "L1", "S1", 20260101, "G1", "card", -1, D(100), D(0), D(5), 20260105,
             20260106, 3, "delivered"),
            ("O3", "o", "L2", "S1", 20260101, "G1", "cod", 1, D(50), D(0), D(5), 20260105, None,
             2, "rto_unreachable"),
            ("O4", "o", "L2", "S1", 20260101, "G1", "bnpl", 1, D(50), D(0), D(5), 20260105, None,
             0, "cancelled_pre_shipment")]),
        "fact_returns": make(spark, "fact_returns", [
            ("R1", "O1", 20260110, 20260112, "R001", "RESELLABLE", 1, D(95), "card"),
            ("R1", "O1", 20260110, 20260112, "R001", "RESELLABLE", 1, D(95), "card")]),
        "ref_category_economics": inline.category_economics(spark),
        "ref_logistics_rate_card": inline.rate_card(spark),
    }


@pytest.fixture(scope="module")
def warehouse(raw):
    return Warehouse(raw, DEFAULT)


def row(df, **key):
    for column, value in key.items():
        df = df.filter(F.col(column) == value)
    (found,) = df.collect()
    return found


def test_order_lines(warehouse):
    lines = warehouse.stored(ORDER_LINES)
    o1 = row(lines, order_line_id="O1")
    assert (o1.category, o1.weight_band, o1.is_cod, o1.is_on_time) == (
        "Fashion", "<=0.5kg", True, True)
    assert (o1.realized_net_revenue_aed, o1.gross_margin_aed) == (D("190"), D("95"))
    o2 = row(lines, order_line_id="O2")
    assert o2.is_quantity_invalid and o2.gross_margin_aed is None and o2.is_on_time is False
    o3 = row(lines, order_line_id="O3")
    # no weight: the median of Home is 3 kg; forward 17 + handling 7
    assert (o3.weight_band, o3.weight_is_fallback, o3.rto_cost_aed) == ("2-5kg", True, D("24"))


def test_return_lines(warehouse):
    r1 = row(warehouse.stored(RETURN_LINES), return_id="R1")
    # 100 x 0.92 recovered; 10.35 reverse + 8 handling + (95 - 92)
    assert (r1.recovered_value_aed, r1.merchandise_loss_aed, r1.return_cost_aed) == (
        D("92"), D("3"), D("21.35"))


def test_listing_mart(warehouse):
    marts = warehouse.table(LISTINGS)
    l1, l2, l3 = (row(marts, listing_id=f"L{i}") for i in (1, 2, 3))
    assert float(l1.listing_quality_score) == 100.0
    assert (l1.delivered_units, l1.catalog_return_rate) == (2, 0.5)
    assert float(l1.recoverable_profit) == 71.35  # 21.35 + 100 x 0.5
    assert l1.net_margin_after_returns == D("73.65")
    # title 20/40 of 0.10 over a raw sum of 1.05
    assert float(l2.listing_quality_score) == 4.76
    assert l2.rto_rate == 1.0 and l2.catalog_return_rate is None
    assert l3.total_orders == 0 and l3.rto_rate is None and l3.gross_margin == 0


def test_seller_mart_and_trust_modes(warehouse, spark):
    sellers = warehouse.stored(SELLERS)
    s1, s2 = row(sellers, seller_id="S1"), row(sellers, seller_id="S2")
    assert (s1.primary_category, s1.listing_count, s1.rto_cost_rank) == ("Fashion", 2, 1)
    assert s1.is_top_decile_rto_cost and not s2.is_top_decile_rto_cost
    assert s2.seller_tier == "Unknown"
    # without deliveries the published score counts a missing catalog rate as the worst one
    frame = spark.createDataFrame(
        [(0, 0, 0, 0, None, None, None, 50.0, "T1", None)],
        "delivered_orders int, shipped_orders int, delivered_units int, returned_units int, "
        "on_time_delivered int, rto_orders int, catalog_returned_units int, "
        "average_listing_quality_score double, seller_tier string, average_attempts double"
    ).withColumn("damage_returned_units", F.lit(None).cast("int"))
    published, corrected = frame.select(
        seller_plan.trust_score(), seller_plan.trust_score(True)).collect()[0]
    assert (float(published), float(corrected)) == (28.57, 66.67)


def test_marts_add_up(warehouse):
    gold = warehouse.gold_layer()
    sums = {n: gold[n].agg(F.sum("gross_margin"), F.sum("return_cost"), F.sum("rto_cost"))
            .collect()[0] for n in (LISTINGS, SELLERS, CATEGORIES)}
    assert sums[LISTINGS] == sums[SELLERS] == sums[CATEGORIES] == (D("95"), D("21.35"), D("24"))
    kpis = {r.kpi_name: r.kpi_value for r in gold[EXECUTIVE].collect()}
    assert len(kpis) == 17 and kpis["total_return_cost"] == 21.35
    assert kpis["fashion_return_cost_share"] == 1.0
    ranks = [r.global_priority_rank for r in gold[QUEUE].collect()]
    assert sorted(ranks) == list(range(1, len(ranks) + 1))


def test_checks_pass_and_catch(warehouse):
    lines = warehouse.stored(ORDER_LINES)
    checks = R.order_line_checks(lines, warehouse.cleaned("fact_orders")).collect()
    assert len(checks) == 8 and all(c["pass"] for c in checks)
    broken = lines.unionByName(lines.limit(1)).withColumn("logistics_zone", F.lit(None))
    bad = {c.check_name: c["pass"]
           for c in R.order_line_checks(broken, warehouse.cleaned("fact_orders")).collect()}
    assert not bad["row_count"] and not bad["pk_unique"] and not bad["no_unresolved_dimensions"]
    assert bad["rto_cost_scoped"]


def test_audit_before_and_after(warehouse, raw):
    before = {(r.table_name, r.check_name): r for r in audit_layer(raw, DEFAULT).collect()}
    assert before["dim_seller", "primary_key"].blocking
    assert before["fact_returns", "primary_key"].violations == 2
    assert before["dim_listing", "membership:category"].status == "WARN"
    assert before["fact_orders", "fk:promised_delivery_date_key"].status == "WARN"
    assert before["fact_listing_traffic", "funnel_monotonicity"].details == {
        "impressions<detail_page_views": "1"}
    after = audit_layer(warehouse.silver_layer(), DEFAULT)
    assert after.filter("blocking").count() == 0
    assert audit.summarize(after).collect()[0].overall_status == "WARN"


def test_stored_returns_read_the_stored_orders(raw):
    """Orders are cleaned once: returns look their deliveries up in the written table."""
    w = Warehouse(raw, DEFAULT, store=lambda df, label: read.setdefault(label, df) and durable(
        df, label))
    read, plain = {}, Warehouse(raw, DEFAULT).silver_layer()
    stored = w.stored_silver()
    assert any("silver-fact_orders" in f for f in read["silver-fact_returns"].inputFiles())
    assert list(stored) == list(plain)
    for name, df in plain.items():
        assert stored[name].columns == df.columns
        assert stored[name].exceptAll(df).count() == 0 == df.exceptAll(stored[name]).count()


def test_silver_guard_fails_closed(spark, raw, tmp_path, monkeypatch):
    w = Warehouse(raw, DEFAULT)
    w.write_silver(str(tmp_path / "silver"))
    assert {r.table_name: r.delta for r in w.row_delta().collect()}["dim_seller"] == -1
    # pretend the rule did not work
    monkeypatch.setattr(warehouse_module, "clean_table",
                        lambda df, rules, settings, orders=None: df)
    with pytest.raises(GuardFailure):
        w.write_silver(str(tmp_path / "again"))
    assert not (tmp_path / "again").exists()
    with pytest.raises(GuardFailure):
        w.write_silver(str(tmp_path / "silver"))
    kept = published(spark, str(tmp_path / "silver"))
    assert kept["dim_seller"].count() == 2 and "dq_imputed_seller_tier" in kept["dim_seller"].columns


@pytest.mark.parametrize("trusted", [True, False])
def test_silver_build_counts_while_writing(spark, raw, tmp_path, monkeypatch, trusted):
    """The log taken while writing equals the one of separate scans, and where a task ran twice
    the counts are asked for again."""
    monkeypatch.setattr(observed, "_ran_once", lambda spark, group: trusted)
    w = Warehouse(raw, DEFAULT)
    build = w.write_silver(str(tmp_path / "silver"))
    key = ("table_name", "action", "target")
    assert build.actions.orderBy(*key).collect() == w.actions().orderBy(*key).collect()
    assert sorted(build.row_delta.collect()) == sorted(w.row_delta().collect())
    for name, df in w.silver_layer().items():
        assert build.tables[name].columns == df.columns
        assert build.tables[name].exceptAll(df).count() == 0 == df.exceptAll(build.tables[name]).count()


def test_observed_totals_equal_asked_ones(warehouse):
    """Checks over totals counted while writing equal those over the tables."""
    warehouse.gold_layer()
    assert set(warehouse.totals) >= {ORDER_LINES, RETURN_LINES, LISTINGS, SELLERS, CATEGORIES,
                                     "fact_orders", "fact_returns"}
    known = warehouse.gold_checks().orderBy("table_name", "check_name").collect()
    bare = Warehouse(warehouse.raw, DEFAULT)
    bare._stored = warehouse._stored
    assert bare.gold_checks().orderBy("table_name", "check_name").collect() == known


def test_csv_layer_round_trip(spark, raw, tmp_path):
    write_layer(raw, str(tmp_path / "bronze"), "csv")
    back = read_layer(spark, str(tmp_path / "bronze"))
    for name, df in raw.items():
        assert back[name].schema.simpleString() == df.schema.simpleString()
        assert back[name].exceptAll(df).count() == 0 and df.count() == back[name].count()
    with pytest.raises(MissingTable):
        read_layer(spark, str(tmp_path / "nowhere"))


def test_export_reads_back(warehouse, tmp_path):
    gold = warehouse.gold_layer()
    export_tables(gold, GOLD_KEYS, str(tmp_path))
    report = read_back(gold, str(tmp_path), GOLD_KEYS).collect()
    assert len(report) == 14 and {r.status for r in report} == {"OK"}
    assert all(r.order_match for r in report)
    assert {r.order_match for r in read_back(gold, str(tmp_path)).collect()} == {None}
    with pytest.raises(MissingTables):
        export_tables({}, GOLD_KEYS, str(tmp_path))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
@pytest.mark.parametrize("fault", ["none", "rows", "files"])
def test_swapped_rows_and_files_are_noticed(spark, tmp_path, fmt, fault):
    """Content is the same, order is not."""
    table = spark.range(3000).selectExpr("(id * 7919) % 3001 AS k", "id AS v")
    keys = {"t": ("k",)}
    export_tables({"t": table}, keys, str(tmp_path))
    home = tmp_path / fmt / "t"
    parts = sorted(home.glob(f"part-*.{fmt}"))
    assert len(parts) > 1
    if fault == "files":
        first, last = parts[0].read_bytes(), parts[-1].read_bytes()
        parts[0].write_bytes(last), parts[-1].write_bytes(first)
    elif fault == "rows":
        rows = spark.read.parquet(str(home)) if fmt == "parquet" else spark.read.csv(
            str(home), header=True, schema=table.schema)
        few = rows.coalesce(1).sortWithinPartitions(F.col("k") % 2, "k")
        aside = str(tmp_path / "aside")
        few.write.csv(aside, header=True) if fmt == "csv" else few.write.parquet(aside)
        made = next((tmp_path / "aside").glob(f"part-*.{fmt}"))
        for part in parts:
            part.unlink()
        for checksum in home.glob(".*.crc"):
            checksum.unlink()
        parts[0].write_bytes(made.read_bytes())
    for checksum in home.glob(".*.crc"):
        checksum.unlink()
    report = {r.fmt: r for r in read_back({"t": table}, str(tmp_path), keys).collect()}
    assert report[fmt].content_match and report[fmt].order_match == (fault == "none")
    assert report[fmt].status == ("OK" if fault == "none" else "FAIL")


def test_monthly_change_is_against_the_calendar_month_before(spark):
    sold = spark.createDataFrame(
        [(20251201, D(1)), (20260105, D(1)), (20260106, D(1)), (20260301, D(1))],
        "order_date_key int, realized_net_revenue_aed decimal(18,4)")
    back = spark.createDataFrame([], "return_initiated_date_key int, return_cost_aed decimal(18,4)")
    out = {r.month: r.orders_mom for r in slices.monthly_trend(sold, back).collect()}
    assert out == {202512: None, 202601: 1.0, 202603: None}


def test_failing_checks_publish_nothing(spark, raw, tmp_path, monkeypatch):
    w = Warehouse(raw, DEFAULT)
    results = w.gold_checks()
    assert results.count() == 72
    failing = results.withColumn("pass", F.col("check_name") != "kpi_count_range")
    monkeypatch.setattr(Warehouse, "gold_checks", lambda self: failing)
    with pytest.raises(BuildFailure, match="kpi_count_range"):
        w.build_gold(str(tmp_path / "gold"))
    assert not (tmp_path / "gold").exists()


def test_passing_checks_publish_everything(spark, raw, tmp_path, monkeypatch):
    w = Warehouse(raw, DEFAULT)
    passing = w.gold_checks().withColumn("pass", F.lit(True))
    monkeypatch.setattr(Warehouse, "gold_checks", lambda self: passing)
    folder = str(tmp_path / "gold")
    w.build_gold(folder)
    layer = published(spark, folder)
    assert set(layer) == set(GOLD_KEYS)
    assert all(layer[n].count() == w.table(n).count() for n in GOLD_KEYS)
    # the next build dies in the middle: readers keep the whole layer of the last one
    w._stored[CATEGORIES] = w.stored(CATEGORIES).withColumn(
        "category", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        publish(spark, {name: w.table(name) for name in GOLD_KEYS}, folder)
    again = published(spark, folder)
    assert all(again[n].count() == layer[n].count() for n in GOLD_KEYS)


def test_miscounting_table_stops_the_build(spark, raw, tmp_path):
    w = Warehouse(raw, DEFAULT)
    w._stored[RETURN_LINES] = w.stored(RETURN_LINES).limit(0)
    with pytest.raises(BuildFailure, match=RETURN_LINES):
        w.build_gold(str(tmp_path / "gold"))
    assert not (tmp_path / "gold").exists()


def test_views_over_a_layer(spark, raw):
    register_views({"dim_seller": raw["dim_seller"]}, "bronze_")
    assert spark.sql("SELECT count(*) FROM bronze_dim_seller").first()[0] == 3
