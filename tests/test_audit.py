from dataclasses import replace

from pyspark.sql import functions as F

from marginflow.operators import audit as A
from marginflow.operators.audit_scan import audit_layer
from marginflow.settings import DEFAULT, Bounds, ForeignKey, Membership, TableContract
from marginflow.sources.layers import read_layer


def one(df):
    return df.collect()[0].asDict()


def test_primary_key_counts_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert one(A.primary_key(df, ["k"])) == {
        "row_count": 5, "null_key_rows": 2, "duplicate_rows": 4, "duplicate_groups": 2}


def test_foreign_key_orphans_and_samples(spark):
    child = spark.createDataFrame([(f"x{i}",) for i in range(12)] + [("a ",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    out = one(A.foreign_key(child, "k", parent, "k"))
    assert (out["null_count"], out["orphan_count"], out["match_rate"]) == (1, 12, 0.076923)
    assert out["orphan_sample"] == "x0,x1,x10,x11,x2,x3,x4,x5,x6,x7"
    empty = one(A.foreign_key(child.filter("k IS NULL"), "k", parent, "k"))
    assert empty["match_rate"] == 1.0 and empty["orphan_count"] == 0


def test_calendar_gap_only_warns(spark):
    child = spark.createDataFrame([(20260101,), (20260105,), (20250101,)], "d int")
    parent = spark.createDataFrame([(20260101,), (20260103,)], "date_key int")
    out = one(A.foreign_key(child, "d", parent, "date_key", True))
    assert (out["broken_orphans"], out["coverage_orphans"],
            out["coverage_extend_through"]) == (1, 1, 20260105)


def test_membership_against_list_and_parent(spark):
    df = spark.createDataFrame([("Home",), (" HOME",), ("Garden",), (None,)], "c string")
    parent = spark.createDataFrame([("Home",), ("Sports",)], "category string")
    for out in (one(A.membership(df, "c", ["Home", "Sports"])),
                one(A.membership(df, "c", parent=parent, parent_column="category"))):
        assert (out["unknown_count"], out["needs_normalization_count"]) == (1, 1)
        assert (out["unknown_sample"], out["needs_normalization_sample"]) == ("Garden", " HOME")


def test_delivered_only_outcomes(spark):
    orders = spark.createDataFrame([(1, "delivered"), (2, "rto_unreachable"), (3, None)],
                                   "order_line_id int, order_status string")
    returns = spark.createDataFrame([(1,), (2,), (2,), (3,), (4,), (None,)], "order_line_id int")
    found = {r.outcome: r.n_returns for r in A.delivered_only(returns, orders).collect()}
    assert found == {"delivered": 1, "rto_unreachable": 2, "no_status": 1, "unmatched": 1}


def test_profiles(spark):
    df = spark.createDataFrame([(1, 5, 3), (1, 5, 3), (2, None, 9), (3, 4, -1)],
                               "id int, a int, b int")
    assert one(A.duplicate_rows(df))["duplicate_rows"] == 2
    assert [tuple(r) for r in A.null_profile(df).collect()] == [("a", 1, 0.25)]
    assert [tuple(r) for r in A.ranges(df, [Bounds("b", 0), Bounds("a", 0)]).collect()] == [
        ("b", 1, -1.0, 9.0)]
    assert [tuple(r) for r in A.funnel(df, ["b", "a"]).collect()] == [("b<a", 3)]


def test_leakage_looks_through_punctuation(spark):
    listing = A.column_listing(spark, {"t": spark.createDataFrame(
        [(1, 2, 3)], "`Return Cost` int, price int, listing_Quality_Score int")})
    assert one(A.leakage(listing))["offending_columns"] == 2


def test_summary_verdict(spark):
    results = spark.createDataFrame([("PASS", False), ("WARN", False)],
                                    "status string, blocking boolean")
    assert one(A.summarize(results))["overall_status"] == "WARN"
    failed = results.union(spark.createDataFrame([("FAIL", True)], results.schema))
    assert one(A.summarize(failed))["overall_status"] == "FAIL"
    assert one(A.summarize(results.filter(F.col("status") == "PASS")))["overall_status"] == "PASS"


def test_fractional_keys_are_never_cut_off(spark):
    child = spark.createDataFrame([(10.0,), (10.5,), (20251025.0,), (None,), (7.0,)], "k double")
    parent = spark.createDataFrame([("10",), (" 20251025 ",), ("10.5x",)], "k string")
    out = one(A.foreign_key(child, "k", parent, "k"))
    assert (out["null_count"], out["orphan_count"], out["orphan_sample"]) == (1, 2, "10.5,7")
    numbers = spark.createDataFrame([(10,), (20251025,), (7,)], "k bigint")
    assert one(A.foreign_key(child, "k", numbers, "k"))["orphan_sample"] == "10.5"
    large = spark.createDataFrame([(2.0251025e7,)], "k double")
    assert one(A.foreign_key(large, "k", numbers, "k"))["orphan_count"] == 0


def test_delivered_only_compares_keys_like_foreign_keys(spark):
    returns = spark.createDataFrame([(" a ",), ("b",), ("c",), (None,)], "order_line_id string")
    orders = spark.createDataFrame([("a", "delivered"), ("b ", "cancelled"), (None, "x")],
                                   "order_line_id string, order_status string")
    got = {r.outcome: r.n_returns for r in A.delivered_only(returns, orders).collect()}
    assert got == {"delivered": 1, "cancelled": 1, "unmatched": 1}


def test_bounds_of_missing_columns_warn(spark):
    df = spark.createDataFrame([(1, 5.0)], "k int, v double")
    found = A.ranges(df, [Bounds("v", 0, 1), Bounds("gone", 0, 1)]).collect()
    assert {(r.column_name, r.out_of_range) for r in found} == {("v", 1), ("gone", None)}
    contract = TableContract(key=("k",), bounds=(Bounds("gone", 0, 1),))
    settings = replace(DEFAULT, contracts={"t": contract})
    rows = audit_layer({"t": df}, settings).filter("check_name = 'distribution_ranges'").collect()
    assert [(r.status, r.details.get("column")) for r in rows] == [("WARN", "gone")]


def test_duplicates_are_compared_within_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "d")],
                               "k int, v string")
    for key in ((), ("k",)):
        assert one(A.duplicate_rows(df, key)) == {"row_count": 6, "duplicate_rows": 4}


def test_report_is_written_with_counts_and_blocking_findings(spark, tmp_path):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    settings = replace(DEFAULT, contracts={"t": TableContract(key=("k",))})
    tables = {"t": df}
    results = audit_layer(tables, settings)
    A.write_report(results, str(tmp_path))
    summary = one(spark.read.json(str(tmp_path / "summary")))
    assert (summary["tables"], summary["total_rows"], summary["row_counts"]) == (1, 2, "t=2")
    assert summary["blocking_findings"] == "t: primary_key" and summary["overall_status"] == "FAIL"
    assert spark.read.json(str(tmp_path / "results")).count() == summary["checks_run"]


def test_details_say_what_was_found(spark):
    """Offending names, shares, bounds with what was observed, states of the orders."""
    orders = spark.createDataFrame(
        [(1, "delivered", 3, 0.5, 1), (2, "rto_unreachable", -1, None, 1), (3, None, 500, 2.0, None)],
        "order_line_id bigint, order_status string, quantity int, `Trust Score` double, day int")
    returns = spark.createDataFrame([(1, 1), (2, 2), (2, 3), (3, 4), (9, 5), (None, 6)],
                                    "order_line_id bigint, return_id int")
    days = spark.createDataFrame([(1,)], "date_key int")
    contracts = {
        "fact_orders": TableContract(("order_line_id",), bounds=(Bounds("quantity", 1, 100),)),
        "fact_returns": TableContract(("return_id",), delivered_only=True)}
    tables = {"fact_orders": orders, "fact_returns": returns, "dim_date": days}
    out = {(r.table_name, r.check_name): r for r in audit_layer(
        tables, replace(DEFAULT, contracts=contracts)).collect()}
    assert out["fact_orders", "leakage"].details == {"offending_columns": "Trust Score"}
    assert out["fact_orders", "leakage"].blocking
    assert out["fact_orders", "null_analysis"].details == {
        "row_count": "3", "order_status": "nulls=1 pct=0.333333",
        "Trust Score": "nulls=1 pct=0.333333", "day": "nulls=1 pct=0.333333"}
    assert out["fact_orders", "distribution_ranges"].details == {
        "quantity": "out_of_range=2 bounds=[1,100] observed=[-1.0,500.0]"}
    delivery = out["fact_returns", "returns_delivered_reconciliation"]
    assert delivery.violations == 3 and delivery.details == {
        "returns_with_order_ref": "5", "unmatched_order_lines": "1", "without_status": "1",
        "returns_against_non_delivered": "2",
        "non_delivered_status_breakdown": "rto_unreachable=2"}


def test_whole_audit_equals_single_measurements(spark):
    """Keys of several types, gaps, copies and samples in one pass as in passes of their own."""
    child = spark.createDataFrame(
        [(1, "a ", 10.0, "Home"), (1, "b", 10.5, " HOME"), (2, None, None, "Garden"),
         (None, "zz", 7.0, None), (2, None, None, "Garden")] + [(5, f"q{i}", 1.0, "x") for i in range(12)],
        "k int, ref string, num double, word string")
    parent = spark.createDataFrame([("a", 10, "Home"), ("b ", 7, "Sports"), (None, None, None)],
                                   "ref string, num bigint, word string")
    contracts = {
        "t": TableContract(("k",), (ForeignKey("ref", "p", "ref"), ForeignKey("num", "p", "num")),
                           (Membership("word", "words", table="p", parent_column="word"),)),
        "p": TableContract(("ref", "num"))}
    out = {(r.table_name, r.check_name): r.details for r in audit_layer(
        {"t": child, "p": parent}, replace(DEFAULT, contracts=contracts)).collect()}

    def text(row):
        return {k: "" if v is None else str(v) for k, v in row.items()}

    for column in ("ref", "num"):
        alone = text(one(A.foreign_key(child, column, parent, column)))
        assert out["t", f"fk:{column}"] == alone
    assert out["t", "primary_key"] == text(one(A.primary_key(child, ["k"])))
    assert out["t", "duplicate_rows"] == text(one(A.duplicate_rows(child)))
    assert out["t", "membership:word"] == text(one(
        A.membership(child, "word", parent=parent, parent_column="word")))
    assert out["p", "primary_key"]["null_key_rows"] == "1"
    empty = {r.check_name: r.status for r in audit_layer(
        {"t": child.limit(0), "p": parent.limit(0)},
        replace(DEFAULT, contracts=contracts)).filter("table_name = 't'").collect()}
    assert set(empty.values()) == {"PASS"}


def test_unfit_cells_of_a_csv_layer_are_reported(spark, tmp_path):
    (tmp_path / "dim_geography.csv").write_text("geo_id,emirate,city,zone_type,logistics_zone\n1,a,b\n2,a,b,c,d\n")
    layer = read_layer(spark, str(tmp_path), ["dim_geography"])
    contracts = {"dim_geography": TableContract(("geo_id",))}
    out = {r.check_name: r for r in audit_layer(layer, replace(DEFAULT, contracts=contracts)).collect()}
    assert out["unparsed_cells"].status == "WARN" and out["unparsed_cells"].details == {"*": "1"}
    assert out["primary_key"].details["row_count"] == "1"
