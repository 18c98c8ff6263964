from datetime import date

from pyspark.sql import functions as F

from marginflow.operators import cleaning as C
from marginflow.settings import DEFAULT, Bounds, CleaningRules, NullRule


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_null_tokens_keep_other_cells(spark):
    df = spark.createDataFrame(
        [(1, "NA"), (2, " null\t"), (3, "nation"), (4, ""), (5, None), (6, " - "), (7, " x ")],
        "id int, t string")
    assert rows(C.standardize_null_tokens(df), "id") == [
        (1, None), (2, None), (3, "nation"), (4, None), (5, None), (6, None), (7, " x ")]


def test_dedup_keeps_most_complete_then_smallest(spark):
    df = spark.createDataFrame(
        [(1, "b", None), (1, "b", 5), (1, "c", 4), (2, None, None), (None, "x", 1),
         (None, "x", 2)], "k int, a string, v int")
    assert rows(C.deduplicate(df, ["k"]), F.col("k").asc_nulls_first()) == [
        (None, "x", 1), (1, "b", 5), (2, None, None)]


def test_dedup_composite_key_and_ordinal(spark):
    df = spark.createDataFrame([(1, 1, 9, "z"), (1, 1, 3, "a"), (1, 2, 5, "m")],
                               "a int, b int, ingest int, t string")
    assert rows(C.deduplicate(df, ["a", "b"], ["ingest"]), "a", "b") == [
        (1, 1, 3, "a"), (1, 2, 5, "m")]


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = C.deduplicate(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_category(spark):
    df = spark.createDataFrame([(1, " FASHION"), (2, "Home"), (3, "Garden"), (4, None)],
                               "id int, category string")
    assert rows(C.normalize_category(df, "category"), "id") == [
        (1, "Fashion", True, False), (2, "Home", False, False), (3, "Unknown", False, True),
        (4, None, False, False)]


def test_enum_collapses_blanks_and_keeps_unknown(spark):
    df = spark.createDataFrame(
        [(1, "write off"), (2, " WRITE__ off "), (3, "write_off"), (4, "Lost"), (5, None)],
        "id int, c string")
    out = C.normalize_enum(df, "c", ["write_off"])
    assert rows(out, "id") == [
        (1, "write_off", True), (2, "write_off", True), (3, "write_off", False),
        (4, "Lost", False), (5, None, False)]
    assert rows(C.unmapped_values(df, "c", ["write_off"]), "value") == [("Lost", 1)]


def test_null_policy_and_errors(spark):
    df = spark.createDataFrame([(1, None, None, 2.0), (2, "b", 3.0, None)],
                               "id int, a string, p double, q double")
    policy = {"a": NullRule("fill", "Unknown"), "p": NullRule("flag_missing"),
              "q": NullRule("keep"), "gone": NullRule("fill", 0), "id": NullRule("guess")}
    out = C.apply_null_policy(df, policy)
    assert out.columns == ["id", "a", "p", "q", "dq_imputed_a", "dq_missing_p"]
    assert rows(out, "id") == [(1, "Unknown", None, 2.0, True, True),
                               (2, "b", 3.0, None, False, False)]
    assert C.policy_errors(df, policy) == {
        "gone": "column missing", "id": "unknown strategy 'guess'"}


def test_ranges_flag_and_quarantine(spark):
    df = spark.createDataFrame([(1, 0.0, "5"), (2, 1.5, "abc"), (3, None, "-1"), (4, 1.0, None)],
                               "id int, share double, n string")
    out = C.flag_invalid_ranges(df, [Bounds("share", 0, 1, quarantine=True), Bounds("n", 0)])
    assert rows(out, "id") == [
        (1, 0.0, "5", False, False), (2, None, "abc", True, False),
        (3, None, "-1", False, True), (4, 1.0, None, False, False)]


def test_temporal_flags(spark):
    orders = spark.createDataFrame(
        [(1, 20260105, 20260101, 20260104, "delivered"), (2, 20260105, None, None, "delivered"),
         (3, 20260105, 20260110, 20270101, "rto_unreachable")],
        "order_line_id int, order_date_key int, promised_delivery_date_key int, "
        "actual_delivery_date_key int, order_status string")
    flagged = C.temporal_flags_orders(orders, 20260707)
    assert [r[5:] for r in rows(flagged, "order_line_id")] == [
        (True, True, False, False, False), (False, False, True, False, False),
        (False, False, False, True, True)]
    returns = spark.createDataFrame(
        [(10, 1, 20260103, 20260102), (11, 9, 20260801, 20260802), (12, 2, 20260106, None)],
        "return_id int, order_line_id int, return_initiated_date_key int, "
        "return_received_date_key int")
    out = C.temporal_flags_returns(returns, orders, 20260707)
    assert [r[4:] for r in rows(out, "return_id")] == [
        (True, True, False), (False, False, True), (False, False, False)]


def test_extend_calendar(spark):
    base = spark.createDataFrame(
        [(20261230, date(2026, 12, 30), "Wednesday", 53, 12, 4, 2026, False, True)],
        "date_key int, full_date date, day_of_week string, week_of_year int, month int, "
        "quarter int, year int, is_weekend boolean, is_ramadan boolean")
    out = C.extend_calendar(base, F.lit(20270102), event_defaults={"is_ramadan": False})
    assert rows(out, "date_key")[1:] == [
        (20261231, date(2026, 12, 31), "Thursday", 53, 12, 4, 2026, False, False),
        (20270101, date(2027, 1, 1), "Friday", 53, 1, 1, 2027, False, False),
        (20270102, date(2027, 1, 2), "Saturday", 53, 1, 1, 2027, True, False)]
    assert C.extend_calendar(base, F.lit(20261201), event_defaults={"is_ramadan": False}
                             ).count() == 1


def test_cleaning_twice_changes_nothing(spark):
    df = spark.createDataFrame(
        [("S1", "n/a", "Seller Fulfilled", "LOCAL"), ("S1", "T1", "seller_fulfilled", "local"),
         ("S2", "T2", "other", None)],
        "seller_id string, seller_tier string, fulfillment_type string, seller_country string")
    rules = DEFAULT.cleaning["dim_seller"]
    once = C.clean_table(df, rules, DEFAULT)
    again = C.clean_table(once.select(df.columns), rules, DEFAULT)
    assert rows(once.select(df.columns), "seller_id") == rows(again.select(df.columns),
                                                              "seller_id")
    assert C.guard_rows("dim_seller", once, ["seller_id"]).collect()[0].status == "OK"
    assert C.guard_rows("dim_seller", df, ["seller_id"]).collect()[0].duplicate_rows == 2


def test_action_log_without_flags_keeps_the_dedup_row(spark):
    raw = spark.createDataFrame([(1, "n/a"), (1, "x"), (2, "y")], "k int, v string")
    rules = CleaningRules(dedup_key=("k",))
    log = C.action_counts("t", raw, C.clean_table(raw, rules, DEFAULT), rules)
    assert {(r.action, r.affected) for r in log.collect()} == {
        ("standardize_null_tokens", 1), ("deduplicate", 1)}
    plain = C.action_counts("t", raw, C.clean_table(raw, CleaningRules(), DEFAULT),
                            CleaningRules())
    assert [r.action for r in plain.collect()] == ["standardize_null_tokens"]


def test_action_details(spark):
    raw = spark.createDataFrame([("red",), ("Blue ",), ("teal",), ("teal",), ("n/a",)], "c string")
    rules = CleaningRules(enums={"c": ("red", "blue"), "gone": ("x",)},
                          nulls={"c": NullRule("keep"), "d": NullRule("fill", 1),
                                 }, bounds=(Bounds("e", 0),))
    got = {(r.action, r.target): (r.affected, r.detail)
           for r in C.cleaning_details("t", raw, rules).collect()}
    assert got == {("unmapped_values", "c"): (2, "teal"), ("keep", "c"): (1, "nulls kept"),
                   ("error", "gone"): (0, "normalize_enum: column missing"),
                   ("error", "d"): (0, "null_policy: column missing"),
                   ("error", "e"): (0, "flag_invalid_ranges: column missing")}
    odd = CleaningRules(nulls={"c": NullRule("guess")})
    assert [r.detail for r in C.cleaning_details("t", raw, odd).collect()] == [
        "null_policy: unknown strategy 'guess'"]
