"""Cleaning transforms, each ``DataFrame -> DataFrame``.

Every change leaves a ``dq_`` flag on the row. A table's rules run in a fixed order: null tokens,
deduplication, category, enumerations, null policy, ranges, temporal flags.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginflow.functions.dates import calendar_fields, key_date
from marginflow.functions.text import (
    enum_key, folded, folded_literal, is_null_token, literal_lookup, strip,
)
from marginflow.settings import (
    CATEGORIES, DELIVERED, EVENT_FLAG_DEFAULTS, UNMAPPED_CATEGORY, WEEKEND_DAYS, Bounds,
    CleaningRules, NullRule, Settings,
)
from marginflow.sources.inline import values_table
from marginflow.sources.layers import INGEST


def _string_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def standardize_null_tokens(df: DataFrame) -> DataFrame:
    """Text that means "missing" becomes NULL; all other cells keep their exact value."""
    return df.withColumns({
        c: F.when(~is_null_token(F.col(c)), F.col(c)) for c in _string_columns(df)})


def completeness(df: DataFrame) -> Column:
    """Number of non-null columns of a row; its place in a file is none of them."""
    return F.expr(" + ".join(f"CAST(`{c}` IS NOT NULL AS INT)" for c in df.columns
                             if c != INGEST))


def deduplicate(df: DataFrame, key: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Keep the most complete row per key.

    Equally complete rows are told apart by ``tie``, else by the ordinal that a file scan gave
    them (``INGEST``): the first one wins. Rows without an ordinal carry no order of their own, so
    all remaining columns decide, smallest first. Catalyst limits each key to one row before
    the shuffle, so a key with very many copies stays cheap.
    """
    if not tie:
        tie = [INGEST] if INGEST in df.columns else df.columns
    rest = [c for c in tie if c not in key]
    best = W.partitionBy(*key).orderBy(
        completeness(df).desc(), *[F.col(c).asc_nulls_last() for c in rest])
    return (df.withColumn("_pick", F.row_number().over(best))
            .filter(F.col("_pick") == 1).drop("_pick", INGEST))


def normalize_category(df: DataFrame, column: str, canonical: Sequence[str] = CATEGORIES,
                       unmapped: str = UNMAPPED_CATEGORY) -> DataFrame:
    """Canonical spelling of a category; unknown text becomes ``unmapped``, NULL stays NULL."""
    raw = F.col(column)
    mapped = literal_lookup(folded(raw), [(folded_literal(c), c) for c in canonical])
    return df.withColumns({
        column: F.when(raw.isNotNull(), F.coalesce(mapped, F.lit(unmapped))),
        "dq_category_normalized": F.coalesce(mapped != raw, F.lit(False)),
        "dq_category_unmapped": raw.isNotNull() & mapped.isNull(),
    })


def _enum_literal(text: str) -> str:
    return "_".join(folded_literal(text).replace("_", " ").split())


def normalize_enum(df: DataFrame, column: str, canonical: Sequence[str]) -> DataFrame:
    """Canonical spelling of an enumeration; unknown text is kept.

    Text that is canonical already is taken as it is and never meets the regex.
    """
    raw = F.col(column)
    pairs = [(_enum_literal(c), c) for c in canonical]
    mapped = literal_lookup(enum_key(raw), pairs)
    right = F.when(raw.isin(*canonical), raw).otherwise(F.coalesce(mapped, raw))
    return df.withColumn("_right", right).withColumns({
        column: F.col("_right"),
        f"dq_{column}_normalized": F.coalesce(F.col("_right") != raw, F.lit(False)),
    }).drop("_right")


def unmapped_values(df: DataFrame, column: str, canonical: Sequence[str]) -> DataFrame:
    """Distinct values that no canonical spelling matches, with their row counts."""
    known = [_enum_literal(c) for c in canonical]
    return (df.filter(F.col(column).isNotNull() & ~enum_key(F.col(column)).isin(*known))
            .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows")))


def apply_null_policy(df: DataFrame, policy: Mapping[str, NullRule]) -> DataFrame:
    """Fill with a constant, flag, or keep. Columns the table lacks are skipped."""
    changes: dict[str, Column] = {}
    for column, rule in policy.items():
        if column not in df.columns:
            continue
        missing = F.col(column).isNull()
        if rule.strategy == "fill":
            kind = df.schema[column].dataType
            changes[f"dq_imputed_{column}"] = missing
            changes[column] = F.coalesce(F.col(column), F.lit(rule.value).cast(kind))
        elif rule.strategy == "flag_missing":
            changes[f"dq_missing_{column}"] = missing
    return df.withColumns(changes) if changes else df


def policy_errors(df: DataFrame, policy: Mapping[str, NullRule]) -> dict[str, str]:
    """Rules that cannot be applied, with the reason; the table is still cleaned."""
    errors = {}
    for column, rule in policy.items():
        if column not in df.columns:
            errors[column] = "column missing"
        elif rule.strategy not in ("fill", "flag_missing", "keep"):
            errors[column] = f"unknown strategy '{rule.strategy}'"
    return errors


def as_number(df: DataFrame, column: str) -> Column:
    """The column as a number; text that is none becomes NULL."""
    return F.col(column).try_cast("double") if dict(df.dtypes)[column] == "string" \
        else F.col(column)


def outside(value: Column, bounds: Bounds) -> Column:
    """True where a known value lies outside the inclusive bounds."""
    low = value < F.lit(bounds.low) if bounds.low is not None else F.lit(False)
    high = value > F.lit(bounds.high) if bounds.high is not None else F.lit(False)
    return F.coalesce(low | high, F.lit(False))


def flag_invalid_ranges(df: DataFrame, bounds: Sequence[Bounds]) -> DataFrame:
    """Flag values outside their bounds and null those that are to be quarantined."""
    changes: dict[str, Column] = {}
    for b in bounds:
        if b.column not in df.columns:
            continue
        bad = outside(as_number(df, b.column), b)
        changes[f"dq_out_of_range_{b.column}"] = bad
        if b.quarantine:
            changes[b.column] = F.when(~bad, F.col(b.column))
    return df.withColumns(changes) if changes else df


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def temporal_flags_orders(df: DataFrame, as_of: int) -> DataFrame:
    placed, promised = F.col("order_date_key"), F.col("promised_delivery_date_key")
    arrived, status = F.col("actual_delivery_date_key"), strip(F.col("order_status"))
    return df.withColumns({
        "dq_promised_before_order": _sure(promised < placed),
        "dq_actual_before_order": _sure(arrived < placed),
        "dq_delivered_missing_actual": _sure((status == DELIVERED) & arrived.isNull()),
        "dq_nondelivered_has_actual": _sure((status != DELIVERED) & arrived.isNotNull()),
        "dq_delivery_after_asof": _sure(arrived > as_of),
    })


def temporal_flags_returns(df: DataFrame, orders: DataFrame, as_of: int) -> DataFrame:
    """``orders`` must hold one row per order line."""
    arrivals = orders.select(F.col("order_line_id").alias("_line"),
                             F.col("actual_delivery_date_key").alias("_arrived"))
    initiated, received = F.col("return_initiated_date_key"), F.col("return_received_date_key")
    return (df.join(arrivals, F.col("order_line_id") == F.col("_line"), "left")
            .withColumns({
                "dq_received_before_initiated": _sure(received < initiated),
                "dq_return_before_delivery": _sure(initiated < F.col("_arrived")),
                "dq_return_after_asof": _sure(initiated > as_of) | _sure(received > as_of),
            }).drop("_line", "_arrived"))


def extend_calendar(df: DataFrame, through: Column,
                    weekend_days: Sequence[str] = WEEKEND_DAYS,
                    event_defaults: Mapping[str, bool] = EVENT_FLAG_DEFAULTS) -> DataFrame:
    """Append days after the last known one up to the date key ``through``.

    ``through`` may be a scalar subquery over the facts. Nothing is added when the calendar
    already reaches that far.
    """
    last = df.agg(F.max("date_key").alias("_last")).select("_last", through.alias("_through"))
    added = (last.filter(F.col("_through") > F.col("_last"))
             .select(F.explode(F.sequence(F.date_add(key_date(F.col("_last")), 1),
                                          key_date(F.col("_through")))).alias("_day")))
    values = calendar_fields(F.col("_day"), tuple(weekend_days))
    values |= {flag: F.lit(bool(value)) for flag, value in event_defaults.items()}
    typed = [values[c].cast(df.schema[c].dataType).alias(c) for c in df.columns]
    return df.unionByName(added.select(*typed))


def clean_table(df: DataFrame, rules: CleaningRules, settings: Settings,
                orders: DataFrame | None = None) -> DataFrame:
    """Run all rules of one table as a single lazy plan.

    Temporal flags on returns need the cleaned ``orders``; without them they are left out. Rules
    for columns that the table lacks are skipped; ``rule_errors`` names them.
    """
    df = standardize_null_tokens(df)
    if rules.dedup_key:
        df = deduplicate(df, rules.dedup_key, rules.dedup_tie)
    df = df.drop(INGEST)
    if rules.category_column:
        df = normalize_category(df, rules.category_column)
    for column, canonical in rules.enums.items():
        if column in df.columns:
            df = normalize_enum(df, column, canonical)
    df = apply_null_policy(df, rules.nulls)
    df = flag_invalid_ranges(df, rules.bounds)
    if rules.temporal == "orders":
        df = temporal_flags_orders(df, settings.as_of_date_key)
    elif rules.temporal == "returns" and orders is not None:
        df = temporal_flags_returns(df, orders, settings.as_of_date_key)
    return df


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def guard_rows(name: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many cleaned rows still share their key, and OK or FAIL."""
    bad = F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint")
    return duplicate_keys(df, key).agg(bad.alias("duplicate_rows")).select(
        F.lit(name).alias("table_name"), "duplicate_rows",
        F.when(F.col("duplicate_rows") > 0, "FAIL").otherwise("OK").alias("status"))


def rule_errors(df: DataFrame, rules: CleaningRules) -> list[tuple[str, str, str]]:
    """(action, column, reason) of the rules that cannot be applied; the rest still are."""
    out = [("null_policy", c, why) for c, why in policy_errors(df, rules.nulls).items()]
    out += [("flag_invalid_ranges", b.column, "column missing") for b in rules.bounds
            if b.column not in df.columns]
    return out + [("normalize_enum", c, "column missing") for c in rules.enums
                  if c not in df.columns]


def raw_measures(raw: DataFrame) -> dict[str, Column]:
    """What the action log needs to know of the raw rows."""
    tokens = F.lit(0).cast("bigint")
    for c in _string_columns(raw):
        tokens = tokens + F.count_if(is_null_token(F.col(c)))
    return {"rows": F.count(F.lit(1)), "tokens": tokens}


def cleaned_measures(cleaned: DataFrame) -> dict[str, Column]:
    """The same of the cleaned rows: how many carry each flag."""
    return {"rows": F.count(F.lit(1)), **{c: F.count_if(F.col(c)) for c in cleaned.columns
                                          if c.startswith("dq_")}}


def action_names(rules: CleaningRules, raw: Mapping[str, object],
                 cleaned: Mapping[str, object]) -> list[tuple[str, str, object]]:
    """(action, target, affected) from measures. Deduplication is listed for tables with such a
    rule."""
    out = [("standardize_null_tokens", "*", raw["tokens"])]
    if rules.dedup_key:
        out.append(("deduplicate", "*", raw["rows"] - cleaned["rows"]))
    return out + [("flag", c, n) for c, n in cleaned.items() if c.startswith("dq_")]


def action_counts(name: str, raw: DataFrame, cleaned: DataFrame,
                  rules: CleaningRules) -> DataFrame:
    """(table_name, action, target, affected): one pass over the raw and one over the cleaned
    rows."""
    asked = cleaned_measures(cleaned)
    before, after = (df.agg(F.struct(*[v.alias(k) for k, v in measures.items()])).scalar()
                     for df, measures in ((raw, raw_measures(raw)), (cleaned, asked)))
    names = action_names(rules, {k: before[k] for k in ("rows", "tokens")},
                         {k: after[k] for k in asked})
    listed = F.array(*[F.struct(F.lit(action).alias("action"), F.lit(target).alias("target"),
                                affected.alias("affected")) for action, target, affected in names])
    return raw.sparkSession.range(1).select(F.lit(name).alias("table_name"), F.inline(listed))


def cleaning_details(name: str, raw: DataFrame, rules: CleaningRules) -> DataFrame:
    """(table_name, action, target, affected, detail): what the action log says beyond counts.

    Values that no enum spelling covers with their ten smallest samples, the nulls that a
    ``keep`` rule leaves, and rules that cannot be applied with the reason.
    """
    spark, frames = raw.sparkSession, []
    tokens = standardize_null_tokens(raw)
    lead = F.lit(name).alias("table_name")
    for column, canonical in rules.enums.items():
        if column in raw.columns:
            counted = (unmapped_values(tokens, column, canonical)
                       .withColumnRenamed("n_rows", "n"))
            samples = counted.orderBy("value").limit(10).agg(
                F.array_join(F.array_sort(F.collect_list("value")), ",")).scalar()
            frames.append(counted.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))
                          .select(lead, F.lit("unmapped_values").alias("action"),
                                  F.lit(column).alias("target"), F.col("n").alias("affected"),
                                  F.coalesce(samples, F.lit("")).alias("detail")))
    kept = [c for c, rule in rules.nulls.items() if rule.strategy == "keep" and c in raw.columns]
    if kept:
        counts = tokens.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in kept])
        frames.append(counts.unpivot([], kept, "target", "affected").select(
            lead, F.lit("keep").alias("action"), "target", "affected",
            F.lit("nulls kept").alias("detail")))
    failed = rule_errors(raw, rules)
    if failed:
        frames.append(values_table(spark, [(name, "error", c, 0, f"{action}: {why}")
                                           for action, c, why in failed],
                                   "table_name string, action string, target string, "
                                   "affected bigint, detail string"))
    if not frames:
        return spark.sql("SELECT '' AS table_name, '' AS action, '' AS target, 0L AS affected, "
                         "'' AS detail WHERE false")
    return reduce(DataFrame.unionByName, frames)
