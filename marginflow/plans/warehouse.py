"""The tables of one data set, from raw to business layer.

``table`` gives a lazy plan, good for a single use: Catalyst prunes what the caller does not
read. ``stored`` writes the table once and reads it back, for tables that several others build
on. Marts build on stored facts, so each fact is computed once however many marts follow.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.operators.audit import union_all
from marginflow.operators.cleaning import (
    action_counts, action_names, clean_table, cleaned_measures, cleaning_details,
    extend_calendar, guard_rows, raw_measures, standardize_null_tokens,
)
from marginflow.operators.observed import Watch
from marginflow.plans import reconciliation as checks
from marginflow.plans.category import category_metrics
from marginflow.plans.executive import executive_summary
from marginflow.plans.facts import (
    SOLD_COLUMNS, order_line_economics, return_line_economics,
)
from marginflow.plans.layout import by_key
from marginflow.plans.listing import LISTING_COLUMNS, listing_metrics
from marginflow.plans.queue import intervention_queue
from marginflow.plans.seller import seller_metrics
from marginflow.settings import CALENDAR_TABLE, DEFAULT, PASS_THROUGH, Settings
from marginflow.sources.inline import values_table
from marginflow.sources.layers import row_counts
from marginflow.sources.publish import Publication, publish
from marginflow.sources.scratch import durable

ORDER_LINES = "gold_order_line_economics"
RETURN_LINES = "gold_return_line_economics"
LISTINGS = "gold_listing_metrics"
SELLERS = "gold_seller_metrics"
CATEGORIES = "gold_category_metrics"
EXECUTIVE = "gold_executive_summary"
QUEUE = "gold_intervention_queue"
# Build order, and the columns that identify a row and order the export
GOLD_KEYS: dict[str, tuple[str, ...]] = {
    ORDER_LINES: ("order_line_id",),
    RETURN_LINES: ("return_id",),
    LISTINGS: ("listing_id",),
    SELLERS: ("seller_id",),
    CATEGORIES: ("category",),
    EXECUTIVE: ("kpi_sort",),
    QUEUE: ("global_priority_rank",),
}


class GuardFailure(RuntimeError):
    """A cleaned table still has duplicate keys; it must not be written."""


class BuildFailure(RuntimeError):
    """A business table miscounts or a check fails; nothing is published."""


@dataclass(frozen=True)
class SilverBuild:
    """A published cleaned layer and what was counted while it was written."""

    tables: dict[str, DataFrame]
    actions: DataFrame    # as ``Warehouse.actions`` gives them
    row_delta: DataFrame  # as ``Warehouse.row_delta``


class Warehouse:
    """``store`` writes an intermediate table and gives it back. With ``buckets`` the line facts,
    and the two sides of the return join, are stored hashed and sorted by the key that they are
    joined and summed by (see ``plans.layout`` for when not to)."""

    def __init__(self, raw: Mapping[str, DataFrame], settings: Settings = DEFAULT,
                 store: Callable[[DataFrame, str], DataFrame] = durable,
                 buckets: int | None = None) -> None:
        self.raw = raw
        self.settings = settings
        self._store = store
        self._buckets = buckets
        self._plans: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}
        self.totals: dict[str, dict[str, object]] = {}  # counted while tables were written

    def _written(self, key: str, df: DataFrame) -> DataFrame:
        if key not in self._stored:
            self._stored[key] = self._store(df, key.replace(" ", "-"))
        return self._stored[key]

    # -- cleaned layer -------------------------------------------------------------------
    def cleaned(self, name: str) -> DataFrame:
        """One table after its own rules, without flags that need other tables."""
        return self._plan(f"cleaned {name}", lambda: self._clean(name))

    def _clean(self, name: str) -> DataFrame:
        if name not in self.settings.cleaning:
            return self.raw[name]
        return clean_table(self._ingested(name), self.settings.cleaning[name], self.settings)

    def _ingested(self, name: str) -> DataFrame:
        """A raw table, with the ordinal of its rows if the layer was read from files."""
        return self.raw.ordered(name) if getattr(self.raw, "first_wins", False) \
            else self.raw[name]

    def silver(self, name: str) -> DataFrame:
        """One table with every flag; the calendar extended over all fact dates."""
        return self._plan(f"silver {name}", lambda: self._silver(name))

    def _silver(self, name: str) -> DataFrame:
        if name == CALENDAR_TABLE:
            return self._calendar()
        rules = self.settings.cleaning.get(name)
        if rules is not None and rules.temporal == "returns":
            return clean_table(self._ingested(name), rules, self.settings,
                               self._stored.get("silver fact_orders", self.cleaned("fact_orders")))
        return self.cleaned(name)

    def _calendar_keys(self, table: str) -> list[str]:
        """Columns of a table that refer to the calendar."""
        contract = self.settings.contracts.get(table)
        return [fk.column for fk in contract.foreign_keys if fk.table == CALENDAR_TABLE] \
            if contract else []

    def _calendar(self) -> DataFrame:
        if self.settings.calendar_through is not None:
            through = F.lit(self.settings.calendar_through)
        else:
            newest = []
            for table in self.settings.contracts:
                tops = [F.max(c) for c in self._calendar_keys(table)]
                if tops:
                    top = F.greatest(*tops) if len(tops) > 1 else tops[0]
                    newest.append(self.raw[table].agg(top.alias("newest")))
            through = union_all(newest).agg(F.max("newest")).scalar()
        return extend_calendar(self.raw[CALENDAR_TABLE], through)

    def silver_layer(self) -> dict[str, DataFrame]:
        names = (CALENDAR_TABLE, *self.settings.cleaning, *PASS_THROUGH)
        return {name: self.silver(name) for name in names}

    def stored_silver(self) -> dict[str, DataFrame]:
        """The cleaned layer as written tables. Returns read the written orders."""
        names = (CALENDAR_TABLE, *self.settings.cleaning, *PASS_THROUGH)
        later = [n for n in self.settings.cleaning
                 if self.settings.cleaning[n].temporal == "returns"]
        for name in [n for n in names if n not in (*later, *PASS_THROUGH)] + later:
            if f"silver {name}" not in self._stored:
                self._written(f"silver {name}", self._silver(name))
        return {name: self.silver(name) if name in PASS_THROUGH
                else self._stored[f"silver {name}"] for name in names}

    def key_guard(self) -> DataFrame:
        """(table_name, duplicate_rows, status) of every deduplicated table."""
        return union_all([
            guard_rows(name, self.cleaned(name), rules.dedup_key)
            for name, rules in self.settings.cleaning.items() if rules.dedup_key])

    def row_delta(self) -> DataFrame:
        """(table_name, bronze, silver, delta)."""
        after = {name: self._survivors(name)
                 for name in (CALENDAR_TABLE, *self.settings.cleaning, *PASS_THROUGH)}
        before = row_counts({name: self.raw[name] for name in after})
        later = row_counts(after).withColumnRenamed("n_rows", "silver")
        return (before.withColumnRenamed("n_rows", "bronze").join(later, "table_name")
                .withColumn("delta", F.col("silver") - F.col("bronze")))

    def _survivors(self, name: str) -> DataFrame:
        """As many rows as the cleaned table: one per key where a rule deduplicates. Counting
        needs neither the tie order nor the other columns."""
        rules = self.settings.cleaning.get(name)
        if rules is not None and rules.dedup_key:
            return standardize_null_tokens(self.raw[name].select(*rules.dedup_key)).distinct()
        return self.silver(name) if name == CALENDAR_TABLE else self.cleaned(name)

    def actions(self) -> DataFrame:
        """What each rule changed, per table."""
        return union_all([action_counts(name, self.raw[name], self.silver(name), rules)
                          for name, rules in self.settings.cleaning.items()])

    def action_details(self) -> DataFrame:
        """Unmapped spellings, kept nulls and rules that could not be applied, per table."""
        return union_all([cleaning_details(name, self.raw[name], rules)
                          for name, rules in self.settings.cleaning.items()])

    def write_silver(self, folder: str) -> SilverBuild:
        """Clean, write and publish the layer in one scan of every raw table.

        Row counts, null tokens, flags and the newest dates are counted on the way. Fail closed:
        the written keys are looked at before anyone sees the layer, and if one is still
        duplicated the former version stays.
        """
        spark = self.raw[CALENDAR_TABLE].sparkSession
        fresh = Publication(spark, folder)
        try:
            build = self._write_silver(fresh)
            guards = union_all([guard_rows(name, build.tables[name], rules.dedup_key)
                                for name, rules in self.settings.cleaning.items()
                                if rules.dedup_key])
            failed = guards.filter("status = 'FAIL'").collect()
            if failed:
                raise GuardFailure("; ".join(
                    f"{r.table_name}: {r.duplicate_rows} rows share a key" for r in failed))
        except Exception:
            fresh.discard()
            raise
        fresh.switch()
        return build

    def _write_silver(self, fresh: Publication) -> SilverBuild:
        rules, spark = self.settings.cleaning, fresh.spark
        tables: dict[str, DataFrame] = {}
        counts: dict[str, dict[str, dict[str, object]]] = {}
        later = [n for n in rules if rules[n].temporal == "returns"]  # they read written orders
        for name in [n for n in (*rules, *PASS_THROUGH) if n not in later] + later:
            watch, own = Watch(spark), rules.get(name)
            newest = {f"newest {c}": F.max(c) for c in self._calendar_keys(name)}
            if own is None:
                df = watch.on("raw", self.raw[name], raw_measures(self.raw[name]) | newest)
            else:
                source = self._ingested(name)
                df = clean_table(
                    watch.on("raw", source, raw_measures(self.raw[name]) | newest), own,
                    self.settings, tables.get("fact_orders") if name in later else None)
            df = watch.on("cleaned", df, cleaned_measures(df))
            counts[name] = watch.run(lambda: tables.update({name: fresh.write(name, df)}))
        through = self.settings.calendar_through
        if through is None:
            dates = [v for c in counts.values() for k, v in c["raw"].items()
                     if k.startswith("newest ") and v is not None]
            through = max(dates, default=None)
        watch, calendar = Watch(spark), self.raw[CALENDAR_TABLE]
        # the calendar itself is read for its last day and for its rows
        df = watch.on("cleaned", extend_calendar(calendar, F.lit(through).cast("int")),
                      {"rows": F.count(F.lit(1))})
        counts[CALENDAR_TABLE] = watch.run(
            lambda: tables.update({CALENDAR_TABLE: fresh.write(CALENDAR_TABLE, df)}))
        counts[CALENDAR_TABLE]["raw"] = {"rows": calendar.count()}
        actions = [(name, action, target, affected) for name, own in rules.items()
                   for action, target, affected in action_names(
                       own, counts[name]["raw"], counts[name]["cleaned"])]
        delta = [(name, c["raw"]["rows"], c["cleaned"]["rows"],
                  c["cleaned"]["rows"] - c["raw"]["rows"]) for name, c in counts.items()]
        return SilverBuild(
            tables,
            values_table(spark, actions, "table_name string, action string, target string, "
                                         "affected bigint"),
            values_table(spark, delta, "table_name string, bronze bigint, silver bigint, "
                                       "delta bigint"))

    # -- business layer ------------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        """A business table as a lazy plan, or its stored form once there is one."""
        if name in self._stored:
            df = self._stored[name]
        else:
            df = self._plan(name, lambda: self._build(name))
        return df.select(*LISTING_COLUMNS) if name == LISTINGS else df

    def stored(self, name: str) -> DataFrame:
        """A business table written once; what the checks of other tables need of it is counted
        on the way. The listing mart keeps its carried columns here."""
        if name not in self._stored:
            watch = Watch(self.raw[CALENDAR_TABLE].sparkSession)
            plan = watch.on(name, self._build(name, watch), self._measures(name))
            self.totals.update(watch.run(
                lambda: self._stored.update({name: self._laid_out(plan, name)})))
        return self._stored[name]

    def _laid_out(self, df: DataFrame, name: str) -> DataFrame:
        if self._buckets and name in (ORDER_LINES, RETURN_LINES):
            return by_key(df, "listing_id", self._buckets, name)
        return self._store(df, name)

    def _keyed_lines(self, name: str, df: DataFrame) -> DataFrame:
        """One side of the return join, laid out by order line if buckets are asked for."""
        if not self._buckets:
            return df
        key = f"{name} by line"
        if key not in self._stored:
            self._stored[key] = by_key(df, "order_line_id", self._buckets, f"{name}_by_line")
        return self._stored[key]

    def _measures(self, name: str) -> dict[str, Column]:
        return {ORDER_LINES: checks.order_line_totals, RETURN_LINES: checks.return_line_totals,
                LISTINGS: lambda: checks.listing_totals(self.settings),
                SELLERS: checks.seller_totals,
                CATEGORIES: lambda: checks.category_totals(self.settings)}.get(name, dict)()

    def _sums(self, name: str) -> DataFrame | Mapping[str, object]:
        """Totals of a stored table, or the table if they were not counted."""
        stored = self.stored(name)
        return self.totals.get(name, stored)

    def _build(self, name: str, watch: Watch | None = None) -> DataFrame:
        cleaned, economics = self.cleaned, self.cleaned("ref_category_economics")
        rates = self.cleaned("ref_logistics_rate_card")

        def counted(table: str, measures: Mapping[str, Column]) -> DataFrame:
            return watch.on(table, cleaned(table), measures) if watch else cleaned(table)

        if name == ORDER_LINES:
            return order_line_economics(counted("fact_orders", checks.order_source_totals()),
                                        cleaned("dim_listing"), cleaned("dim_geography"),
                                        economics, rates)
        if name == RETURN_LINES:
            returns = counted("fact_returns", checks.return_source_totals())
            return return_line_economics(self._keyed_lines("fact_returns", returns),
                                         self._keyed_lines("sold", self._sold().select(*SOLD_COLUMNS)), cleaned("dim_return_reason"), economics,
                                         rates)
        if name == LISTINGS:
            orders, returns = self.stored(ORDER_LINES), self.stored(RETURN_LINES)
            return listing_metrics(cleaned("dim_listing"), orders, returns, economics,
                                   self.settings, carry=True)
        if name == SELLERS:
            listings = self.stored(LISTINGS)
            return seller_metrics(cleaned("dim_seller"), listings, self.stored(ORDER_LINES),
                                  self.stored(RETURN_LINES), self.settings)
        if name == CATEGORIES:
            sellers = self.stored(SELLERS)
            return category_metrics(self.stored(LISTINGS), sellers, economics)
        if name == EXECUTIVE:
            categories = self.stored(CATEGORIES)
            return executive_summary(self.stored(LISTINGS), self.stored(SELLERS), categories,
                                     self.settings)
        if name == QUEUE:
            sellers = self.stored(SELLERS)
            return intervention_queue(self.stored(LISTINGS), sellers, self.settings)
        raise KeyError(name)

    def _sold(self) -> DataFrame:
        """The order lines that returns refer to: the stored table, or else only the returned
        lines, picked before they are deduplicated and enriched."""
        key, rules = "order_line_id", self.settings.cleaning.get("fact_orders")
        if ORDER_LINES in self._stored or rules is None or (
                rules.dedup_key and key not in rules.dedup_key):
            return self.table(ORDER_LINES)
        asked = self.raw["fact_returns"].select(key).distinct()
        lines = clean_table(self.raw["fact_orders"].join(asked, key, "left_semi"), rules,
                            self.settings)
        cleaned = self.cleaned
        return order_line_economics(lines, cleaned("dim_listing"), cleaned("dim_geography"),
                                    cleaned("ref_category_economics"),
                                    cleaned("ref_logistics_rate_card"))

    def gold_checks(self) -> DataFrame:
        """(table_name, check_name, value, pass) of every check of every business table."""
        stored, cleaned, sums = self.stored, self.cleaned, self._sums
        sold, back, listed = sums(ORDER_LINES), sums(RETURN_LINES), sums(LISTINGS)
        found = {
            ORDER_LINES: checks.order_line_checks(stored(ORDER_LINES), self.source_totals(
                "fact_orders")),
            RETURN_LINES: checks.return_line_checks(
                stored(RETURN_LINES), stored(ORDER_LINES), self.source_totals("fact_returns")),
            LISTINGS: checks.listing_checks(stored(LISTINGS), sold, back,
                                            cleaned("dim_listing")),
            SELLERS: checks.seller_checks(stored(SELLERS), listed, sold, back,
                                          cleaned("dim_seller"), self.settings),
            CATEGORIES: checks.category_checks(stored(CATEGORIES), stored(LISTINGS),
                                               self.settings, self.totals.get(LISTINGS)),
            EXECUTIVE: checks.executive_checks(stored(EXECUTIVE), listed, sums(SELLERS),
                                               sums(CATEGORIES), sold, back, self.settings),
            QUEUE: checks.queue_checks(stored(QUEUE), listed, self.settings),
        }
        return union_all([df.withColumn("table_name", F.lit(name))
                          for name, df in found.items()])

    def source_totals(self, table: str) -> DataFrame | Mapping[str, object]:
        """What was counted of a cleaned table on its way into a business table, or the table."""
        return self.totals.get(table, self.cleaned(table))

    def build_gold(self, folder: str) -> DataFrame:
        """Build the business tables in order, check them, and only then publish all of them in
        one step (``sources.publish.published`` reads them). Raises ``BuildFailure`` at the first
        miscounting table, and on any check that fails or is undefined; then the version before
        stays."""
        for name in GOLD_KEYS:
            self.stored(name)
            expected = checks.expected_counts(self.cleaned, self.totals)
            if name in expected:
                row = checks.row_count_regression(
                    {name: self.stored(name)}, {name: expected[name]}).first()
                if not row["pass"]:
                    raise BuildFailure(f"{name}: {row.actual} rows, expected {row.expected}")
        results = self._written("gold checks", self.gold_checks())
        failed = results.filter("NOT coalesce(`pass`, false)").collect()
        if failed:
            raise BuildFailure("; ".join(f"{r.table_name}: {r.check_name}" for r in failed))
        publish(results.sparkSession, {name: self.table(name) for name in GOLD_KEYS}, folder)
        return results

    def gold_layer(self) -> dict[str, DataFrame]:
        """All business tables, stored, in build order."""
        for name in GOLD_KEYS:
            self.stored(name)
        return {name: self.table(name) for name in GOLD_KEYS}

    def _plan(self, key: str, make: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._plans:
            self._plans[key] = make()
        return self._plans[key]
