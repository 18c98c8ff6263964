"""Data-quality checks derived from table contracts.

Structural faults (keys, references, vocabularies, leakage, returns of undelivered lines) block;
ordinary dirt (nulls, full duplicates, ranges, funnel order) warns. Every key-like check counts
values before it joins, so a value shared by very many rows moves as one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginflow.functions.numeric import rate
from marginflow.functions.text import column_token, folded, folded_literal, strip
from marginflow.operators.cleaning import as_number, outside
from marginflow.settings import FORBIDDEN_COLUMN_TOKENS, Bounds
from marginflow.sources.inline import values_table

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
SAMPLE = 10


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _n(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")


WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def _as_text(*sides: tuple[DataFrame, str]) -> bool:
    """Keys are compared as numbers only if both sides are whole numbers by type."""
    return any(dict(df.dtypes)[column] not in WHOLE_TYPES for df, column in sides)


def comparable(df: DataFrame, column: str, as_text: bool) -> Column:
    """Key in the form in which child and parent are compared.

    Text is trimmed. A fractional type holds a key such as 10 as 10.0: whole values become the
    text of the whole number, others keep their own, and nothing is cut off.
    """
    c, kind = F.col(column), dict(df.dtypes)[column]
    if kind == "string":
        return strip(c)
    if kind in ("double", "float") or kind.startswith("decimal"):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(9.0e18))
        return F.when(whole, F.floor(c).cast("bigint").cast("string")).otherwise(c.cast("string"))
    return c.cast("string") if as_text or kind not in WHOLE_TYPES else c.cast("bigint")


def _sample(values: DataFrame, column: str) -> Column:
    """The ten smallest values as text, through a top-k and never a full collection.

    Callers filter on the row count too, so that the sample needs the very exchange that the
    totals need and Spark runs it once.
    """
    top = values.select(F.col(column).cast("string").alias("v")).distinct().orderBy("v")
    return (top.limit(SAMPLE).agg(F.array_join(F.array_sort(F.collect_list("v")), ","))
            .scalar())


# -- measurements: small frames with typed columns ---------------------------------------------
def primary_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    return counted.agg(
        _n(F.sum("n")).alias("row_count"),
        _n(F.sum(F.when(has_null, F.col("n")))).alias("null_key_rows"),
        _n(F.sum(F.when(F.col("n") > 1, F.col("n")))).alias("duplicate_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_groups"),
    )


@dataclass(frozen=True)
class Reference:
    """One foreign key of a child table. For a calendar parent an orphan beyond its last key
    only shows that the calendar is short (``coverage_aware``)."""

    name: str
    column: str
    parent: DataFrame
    parent_column: str
    coverage_aware: bool = False


def _parents(references: Sequence[Reference]) -> tuple[DataFrame, dict[str, int]]:
    """(parent, key): the keys of every distinct parent column, and each reference's parent."""
    numbers: dict[tuple[int, str], int] = {}
    number_of = {r.name: numbers.setdefault((id(r.parent), r.parent_column), len(numbers))
                 for r in references}
    frames = {number_of[r.name]: r.parent.select(
        F.lit(number_of[r.name]).alias("parent"),
        comparable(r.parent, r.parent_column, True).alias("parent_key"))
        for r in references}
    return union_all(list(frames.values())).filter("parent_key IS NOT NULL").distinct(), number_of


def foreign_keys(child: DataFrame, references: Sequence[Reference]) -> DataFrame:
    """One row per reference: nulls, orphans, those beyond the calendar, match rate, and the ten
    smallest orphans as text.

    The table is scanned once: its keys are stacked as (reference, key) and counted before they
    meet the parents, and references to the same parent column share one scan of it. Nulls are
    counted apart and are no orphans.
    """
    spark = child.sparkSession
    parents, number_of = _parents(references)
    pairs = F.array(*[F.struct(
        F.lit(r.name).alias("reference"), F.lit(number_of[r.name]).alias("of"),
        F.lit(r.coverage_aware).alias("covered"),
        comparable(child, r.column, True).alias("key")) for r in references])
    keys = (child.select(F.inline(pairs)).groupBy("reference", "of", "covered", "key")
            .agg(F.count(F.lit(1)).alias("n")))
    last = parents.groupBy("parent").agg(
        F.max(F.col("parent_key").try_cast("bigint")).alias("last")) \
        .withColumnRenamed("parent", "last_of")
    marked = (keys.join(parents, F.expr("of = parent AND key = parent_key"), "left")
              .join(last, F.expr("of = last_of"), "left")
              .withColumn("orphan", F.expr("key IS NOT NULL AND parent_key IS NULL"))
              .withColumn("beyond", F.expr(
                  "coalesce(covered AND orphan AND try_cast(key AS BIGINT) > last, false)")))
    counts = marked.groupBy(F.col("reference").alias("counted")).agg(
        F.expr("coalesce(sum(CASE WHEN key IS NULL THEN n END), 0) AS nulls"),
        F.expr("coalesce(sum(CASE WHEN key IS NOT NULL THEN n END), 0) AS filled"),
        F.expr("coalesce(sum(CASE WHEN orphan THEN n END), 0) AS orphans"),
        F.expr("coalesce(sum(CASE WHEN beyond THEN n END), 0) AS beyond"),
        F.expr("max(CASE WHEN beyond THEN try_cast(key AS BIGINT) END) "
               "AS coverage_extend_through"))
    smallest = W.partitionBy("reference").orderBy("key")
    samples = (marked.filter("orphan").withColumn("rank", F.row_number().over(smallest))
               .filter(F.col("rank") <= SAMPLE)
               .groupBy(F.col("reference").alias("sampled")).agg(
                   F.array_join(F.array_sort(F.collect_list("key")), ",").alias("sample")))
    names = values_table(spark, [(r.name,) for r in references], "reference string")
    return (names.join(counts, F.expr("reference = counted"), "left")
            .join(samples, F.expr("reference = sampled"), "left")
            .select("reference", _n(F.col("nulls")).alias("null_count"),
                    _n(F.col("orphans")).alias("orphan_count"),
                    _n(F.expr("orphans - beyond")).alias("broken_orphans"),
                    _n(F.col("beyond")).alias("coverage_orphans"), "coverage_extend_through",
                    F.coalesce(rate(F.expr("filled - orphans"), F.col("filled")), F.lit(1.0))
                    .alias("match_rate"),
                    F.coalesce("sample", F.lit("")).alias("orphan_sample")))


def foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                coverage_aware: bool = False) -> DataFrame:
    """One reference alone."""
    return foreign_keys(child, [Reference(column, column, parent, parent_column,
                                          coverage_aware)]).drop("reference")


def membership(df: DataFrame, column: str, values: Sequence[str] = (),
               parent: DataFrame | None = None, parent_column: str | None = None) -> DataFrame:
    """Rows with unknown values, and rows known only after trimming and case folding."""
    counted = (df.filter(F.col(column).isNotNull())
               .groupBy(F.col(column).cast("string").alias("raw"))
               .agg(F.count(F.lit(1)).alias("n")).withColumn("form", folded(F.col("raw"))))
    if parent is None:
        marked = counted.withColumns({
            "known": F.col("form").isin(*[folded_literal(v) for v in values]),
            "exact": F.col("raw").isin(*values)})
    else:
        words = (parent.select(F.col(parent_column).cast("string").alias("word"))
                 .filter("word IS NOT NULL").distinct())
        forms = words.select(folded(F.col("word")).alias("word_form")).distinct()
        marked = (counted.join(forms, F.col("form") == F.col("word_form"), "left")
                  .join(words, F.col("raw") == F.col("word"), "left")
                  .withColumns({"known": F.col("word_form").isNotNull(),
                                "exact": F.col("word").isNotNull()}))
    unknown, dirty = ~F.col("known"), F.col("known") & ~F.col("exact")
    return marked.agg(
        _n(F.sum(F.when(unknown, F.col("n")))).alias("unknown_count"),
        _n(F.sum(F.when(dirty, F.col("n")))).alias("needs_normalization_count"),
    ).withColumns({
        "unknown_sample":
            F.coalesce(_sample(marked.filter(unknown & (F.col("n") > 0)), "raw"), F.lit("")),
        "needs_normalization_sample":
            F.coalesce(_sample(marked.filter(dirty & (F.col("n") > 0)), "raw"), F.lit("")),
    })


def delivered_only(returns: DataFrame, orders: DataFrame, ref_column: str = "order_line_id",
                   key: str = "order_line_id", status: str = "order_status") -> DataFrame:
    """(outcome, n_returns): returns by what their order line says.

    Outcomes are ``unmatched``, ``no_status`` or the status of the order. Keys are compared in
    the same form as by ``foreign_key``.
    """
    as_text = _as_text((returns, ref_column), (orders, key))
    keys = (returns.filter(F.col(ref_column).isNotNull())
            .groupBy(comparable(returns, ref_column, as_text).alias("ref"))
            .agg(F.count(F.lit(1)).alias("n")))
    states = (orders.groupBy(comparable(orders, key, as_text).alias("line"))
              .agg(F.max(status).alias("state")).filter("line IS NOT NULL"))
    outcome = (F.when(F.col("line").isNull(), "unmatched")
               .when(F.col("state").isNull(), "no_status").otherwise(strip(F.col("state"))))
    return (keys.join(states, F.col("ref") == F.col("line"), "left")
            .groupBy(outcome.alias("outcome")).agg(_n(F.sum("n")).alias("n_returns")))


def duplicate_rows(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Rows of which an identical copy exists (all copies count).

    Identical rows share their key, so with a ``key`` only rows of repeated keys are compared
    in full width.
    """
    rows = df
    if key:
        repeated = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
                    .select(*[F.col(c).alias(f"_{c}") for c in key]))
        match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
        rows = df.join(repeated, match, "left_semi")
    counted = rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    found = counted.agg(_n(F.sum(F.when(F.col("_n") > 1, F.col("_n")))).alias("duplicate_rows"))
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "duplicate_rows", found.scalar())


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, nulls, pct) of the columns with nulls, in one pass."""
    names = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return (counts.unpivot(["_rows"], names, "column_name", "nulls").filter("nulls > 0")
            .select("column_name", "nulls", rate(F.col("nulls"), F.col("_rows")).alias("pct")))


def _range_measures(df: DataFrame, bounds: Sequence[Bounds]) -> list[Column]:
    out = []
    for b in bounds:
        value = as_number(df, b.column)
        out.append(F.struct(
            F.lit(b.column).alias("column_name"),
            F.count_if(outside(value, b)).alias("out_of_range"),
            F.min(value).cast("double").alias("observed_min"),
            F.max(value).cast("double").alias("observed_max")))
    return out


def ranges(df: DataFrame, bounds: Sequence[Bounds]) -> DataFrame:
    """(column_name, out_of_range, observed_min, observed_max) of violating columns.

    A column the table lacks is listed too, with NULL in place of measures.
    """
    present = [b for b in bounds if b.column in df.columns]
    absent = [F.struct(F.lit(b.column).alias("column_name"),
                       F.lit(None).cast("bigint").alias("out_of_range"),
                       F.lit(None).cast("double").alias("observed_min"),
                       F.lit(None).cast("double").alias("observed_max"))
              for b in bounds if b.column not in df.columns]
    return (df.agg(F.array(*_range_measures(df, present), *absent).alias("m"))
            .select(F.inline("m")).filter("out_of_range IS NULL OR out_of_range > 0"))


def _funnel_measures(df: DataFrame, stages: Sequence[str]) -> list[Column]:
    return [
        F.struct(F.lit(f"{upper}<{lower}").alias("step"),
                 F.count_if(as_number(df, upper) < as_number(df, lower)).alias("breaches"))
        for upper, lower in zip(stages, stages[1:])]


def funnel(df: DataFrame, stages: Sequence[str]) -> DataFrame:
    """(step, breaches) for neighbouring stages that do not decrease."""
    return (df.agg(F.array(*_funnel_measures(df, stages)).alias("m"))
            .select(F.inline("m")).filter("breaches > 0"))


def column_listing(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name) of a layer, from its schemas."""
    return values_table(spark, [(t, c) for t, df in tables.items() for c in df.columns],
                        "table_name string, column_name string")


def forbidden_names(columns: Sequence[str],
                    forbidden: Sequence[str] = FORBIDDEN_COLUMN_TOKENS) -> list[str]:
    """The column names that contain a metric that must not exist yet."""
    return [c for c in columns
            if any(token in "".join(ch for ch in c.lower() if ch.isalnum()) for token in forbidden)]


def leakage(listing: DataFrame, forbidden: Sequence[str] = FORBIDDEN_COLUMN_TOKENS) -> DataFrame:
    """Per table, whether a column name contains a metric that must not exist yet."""
    bad = column_token(F.col("column_name")).rlike("|".join(forbidden))
    return listing.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_columns"), F.count_if(bad).alias("offending_columns"))


# -- reports -----------------------------------------------------------------------------------
def summarize(results: DataFrame) -> DataFrame:
    """Totals and the overall verdict: FAIL if anything blocks, else WARN, else PASS."""
    return results.agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == WARN).alias("warnings"),
        F.count_if(F.col("blocking")).alias("blocking_failures"),
    ).withColumn(
        "overall_status",
        F.when(F.col("blocking_failures") > 0, FAIL).when(F.col("warnings") > 0, WARN)
        .otherwise(PASS))


def report(results: DataFrame) -> DataFrame:
    """One row: totals, verdict, number of tables and rows, row counts per table, and the
    blocking findings as ``table: check``, sorted. Row counts are taken from the results."""
    counted = results.filter("check_name = 'duplicate_rows'").select(
        "table_name", F.col("details")["row_count"].cast("bigint").alias("n_rows"))
    size = counted.agg(
        F.count(F.lit(1)).alias("tables"), F.sum("n_rows").cast("bigint").alias("total_rows"),
        F.array_join(F.array_sort(F.collect_list(
            F.concat_ws("=", "table_name", F.col("n_rows").cast("string")))), ",")
        .alias("row_counts"))
    blocking = results.agg(F.array_join(F.array_sort(F.collect_list(F.when(
        F.col("blocking"), F.concat_ws(": ", "table_name", "check_name")))), ",")
        .alias("blocking_findings"))
    return summarize(results).join(size).join(blocking)


def write_report(results: DataFrame, folder: str) -> None:
    """JSON: one line per check with its details, and the one-line report."""
    results.coalesce(1).write.mode("overwrite").json(f"{folder}/results")
    report(results).coalesce(1).write.mode("overwrite").json(f"{folder}/summary")
