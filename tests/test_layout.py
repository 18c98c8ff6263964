"""Levels against separate sums, sketches against lines, layouts by what their plans read."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marginflow.plans import layout, levels, listing, sketches, slices
from marginflow.plans.facts import return_line_economics
from marginflow.sources import inline
from marginflow.sources.scratch import durable


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lines(spark):
    r = random.Random(1)
    rows = [(i, i % 900, f"l{min(r.randrange(60), 20)}", f"s{r.randrange(7)}",
             r.choice(["Home", "Beauty", None]), 20260101 + 100 * r.randrange(12) + r.randrange(28),
             r.random() < .7, r.random() < .1, r.random() < .9, r.random() < .5, r.randrange(1, 4),
             False, None if r.random() < .05 else D(r.randrange(10000)) / 100)
            for i in range(4000)]
    return spark.createDataFrame(
        rows, "order_line_id long, order_id long, listing_id string, seller_id string, "
              "category string, order_date_key int, is_delivered boolean, is_rto boolean, "
              "is_shipped boolean, is_on_time boolean, quantity int, is_quantity_invalid boolean, "
              "realized_net_revenue_aed decimal(18,4)")


@pytest.fixture(scope="module")
def back(spark):
    r = random.Random(2)
    rows = [(i, f"s{r.randrange(9)}", r.choice(["Home", "Beauty", None]), r.randrange(1, 3),
             r.random() < .5, D(r.randrange(100)), D(r.randrange(50)),
             20260101 + 100 * r.randrange(12) + r.randrange(28)) for i in range(900)]
    return spark.createDataFrame(
        rows, "return_id long, seller_id string, category string, quantity_returned int, "
              "is_catalog_related boolean, returned_value_aed decimal(18,4), "
              "recovered_value_aed decimal(18,4), return_initiated_date_key int")


def test_every_level_equals_its_own_sums(lines, back):
    out = levels.rates_by_level(lines, back).collect()
    by_level = {}
    for r in out:
        by_level.setdefault(r.level, []).append(r)
    assert {k: len(v) for k, v in by_level.items()} == {
        "total": 1, "category": 3, "seller_id": 7, "category x seller_id": 21}
    for level, by in (("category", ("category",)), ("seller_id", ("seller_id",)),
                      ("category x seller_id", ("category", "seller_id"))):
        alone = {tuple(r[c] for c in by): r for r in slices.weighted_rates(lines, back, by).collect()}
        for r in by_level[level]:
            other = alone[tuple(r[c] for c in by)]
            assert all(r[c] == other[c] for c in other.asDict())
    some = levels.rates_by_level(lines, back, levels=[("category",), ()]).select("level").distinct()
    assert {r.level for r in some.collect()} == {"category", "total"}


def test_a_fact_is_shuffled_once_for_all_levels(lines):
    text = plan(levels.sums_by_level(lines, ("category", "seller_id"), levels.order_measures(),
                                     levels.all_levels(("category", "seller_id"))))
    assert text.count("Scan") == 1  # the levels are expanded from the sums, above the first exchange
    assert text.index("Expand") < text.rindex("Exchange")


def test_sketches_add_up(lines):
    """From listing and month to any slice, within the stated errors; NULLs and empty slices."""
    stored = sketches.listing_month_sketches(lines)
    points = {"p10": 0.1, "median": 0.5, "p99": 0.99}
    for by in (["category"], ["seller_id"], ["category", "seller_id"], ["month"]):
        answers = sketches.from_sketches(stored, by, points)
        dated = lines.withColumn("month", F.floor(F.col("order_date_key") / 100))
        for r in sketches.measured_errors(dated, answers, by, points).collect():
            assert all(r[f"{p}_rank_error"] <= sketches.RANK_ERROR for p in points)
            assert r.count_error <= sketches.COUNT_ERROR
    whole = sketches.from_sketches(stored, [], {"median": 0.5}).first()
    assert whole.lines == 4000 and abs(whole.entities - 900) <= 900 * sketches.COUNT_ERROR
    unknown = lines.filter("realized_net_revenue_aed IS NULL")
    gaps = sketches.from_sketches(sketches.listing_month_sketches(unknown), [], {"median": 0.5})
    assert gaps.first()["median"] is None and gaps.first().lines == unknown.count()


def test_a_period_reads_its_months_only(lines):
    stored = layout.by_month(lines, "order_date_key")
    assert stored.count() == 4000 and set(stored.columns) == {*lines.columns, "month"}
    some = layout.in_months(stored, 202603, 202604)
    text = plan(some)
    assert "PartitionFilters: [" in text and "month#" in text.split("PartitionFilters: [")[1][:80]
    read = {f.rsplit("month=", 1)[1][:6] for f in some.inputFiles()}
    expected = lines.filter("order_date_key BETWEEN 20260301 AND 20260431")
    assert some.count() == expected.count() > 0
    assert len(read) >= 2  # inputFiles lists the whole source; the scan is what the filter prunes
    measured = slices.monthly_trend(some, layout.in_months(layout.by_month(
        lines.select(F.col("order_date_key").alias("return_initiated_date_key"), F.col(
            "realized_net_revenue_aed").alias("return_cost_aed")),
        "return_initiated_date_key"), 202603, 202604))
    assert {r.month for r in measured.collect()} == {202603, 202604}


def test_a_season_prunes_months_at_run_time(spark, lines):
    stored = layout.by_month(lines, "order_date_key")
    calendar = durable(spark.createDataFrame(
        [(20260100 + 100 * m + d, m == 10 and d > 20) for m in range(12) for d in range(1, 29)],
        "date_key int, is_white_friday_period boolean"))
    found = layout.in_season(stored, calendar, "is_white_friday_period", "order_date_key")
    assert "dynamicpruning" in plan(found)
    assert found.columns == stored.columns
    assert found.count() == lines.filter("order_date_key BETWEEN 20261121 AND 20261128").count() > 0


def test_keyed_facts_need_no_shuffle(spark, lines):
    """Sums and joins by the key of the buckets have no exchange on the fact side."""
    sold = lines.withColumns({c: F.lit(None).cast("decimal(18,4)") for c in (
        "gross_margin_aed", "rto_cost_aed")}).withColumns({
            "is_cancelled": F.lit(False), "delivery_attempts": F.lit(1)})
    keyed = layout.by_key(sold, "listing_id", 8)
    side = listing._order_side(keyed)
    assert "Exchange" not in plan(side)
    assert sorted(side.select("listing_id", "total_orders").collect()) == sorted(
        listing._order_side(sold).select("listing_id", "total_orders").collect())

    slim = lines.selectExpr("order_line_id", "listing_id", "seller_id", "category",
                            "'remote' AS logistics_zone", "'2-5kg' AS weight_band",
                            "realized_net_revenue_aed AS unit_selling_price")
    returns = spark.range(0, 4000, 7).selectExpr(
        "id AS return_id", "id AS order_line_id", "20260101 AS return_initiated_date_key",
        "20260102 AS return_received_date_key", "'R001' AS reported_reason_code",
        "'resellable' AS item_condition_on_receipt", "1 AS quantity_returned",
        "CAST(5 AS DECIMAL(18,4)) AS refund_amount", "'card' AS refund_method",
        "false AS dq_missing_reported_reason_code")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = layout.by_key(returns, "order_line_id", 8).join(
            layout.by_key(slim, "order_line_id", 8), "order_line_id")
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    economics = return_line_economics(
        layout.by_key(returns, "order_line_id", 8), layout.by_key(slim, "order_line_id", 8),
        inline.return_reasons(spark), inline.category_economics(spark), inline.rate_card(spark))
    assert economics.count() == returns.count()


def test_hot_keys_are_told(lines):
    found = {r.listing_id for r in layout.hot_keys(lines, "listing_id", 8).collect()}
    assert found == {"l20"}  # two thirds of all lines
