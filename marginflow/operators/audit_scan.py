"""The contract audit of a whole layer: two scans of each table, five jobs for all of them.

The first scan counts rows by key and content, for keys and duplicates, and profiles every column
on the way. The second stacks the values that any check compares with another table or a
vocabulary as (table, ask, value) and counts them in one exchange; these counts are stored, and
references, vocabularies and delivery states are joined on them and never on rows. A value that
very many rows share is one row after the first partial count.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginflow.functions.text import folded, folded_literal, strip
from marginflow.operators.audit import (
    FAIL, PASS, SAMPLE, WARN, WHOLE_TYPES, comparable, forbidden_names, union_all,
)
from marginflow.operators.cleaning import as_number, outside
from marginflow.operators.observed import Watch
from marginflow.settings import (
    CALENDAR_TABLE, DELIVERED, ForeignKey, Membership, Settings, TableContract,
)
from marginflow.sources.inline import values_table
from marginflow.sources.layers import quarantine_counts
from marginflow.sources.scratch import durable, freed

SCHEMA = ("table_name string, check_name string, status string, severity string, "
          "blocking boolean, violations bigint, summary string, details map<string,string>")
STATES = 50  # distinct order states that a report lists by name


@dataclass(frozen=True)
class Finding:
    """One check of one table. ``failures`` block if the check may block, ``warnings`` warn."""

    table: str
    check: str
    failures: int
    warnings: int
    details: Mapping[str, object]
    blocking: bool = True
    summary: str | None = None

    def row(self) -> tuple:
        status = FAIL if self.failures else WARN if self.warnings else PASS
        hard = self.blocking and not (status == WARN)
        text = self.summary or (f"{self.check}: {self.failures} broken, "
                                f"{self.warnings} advisory")
        return (self.table, self.check, status, "error" if hard else "warn",
                bool(self.failures) and self.blocking, self.failures + self.warnings, text,
                {k: "" if v is None else str(v) for k, v in self.details.items()})


def _share(part: int, whole: int) -> float:
    return float((Decimal(part) / Decimal(whole)).quantize(Decimal("0.000001"), ROUND_HALF_UP))


def _missing(table: str, check: str, column: str, blocking: bool = True) -> Finding:
    return Finding(table, check, int(blocking), int(not blocking), {"column": column}, blocking,
                   f"column missing: {column}")


# -- first scan: keys, duplicates, profile -------------------------------------------------------
def _content(df: DataFrame) -> list[Column]:
    """Two hashes of a whole row. Hashes pass over NULLs, so where they stand is hashed too."""
    gaps = [F.expr(" + ".join(f"IF(`{c}` IS NULL, {1 << i}L, 0L)" for i, c in enumerate(some)))
            for some in (df.columns[i:i + 60] for i in range(0, len(df.columns), 60))]
    columns = [F.col(c) for c in df.columns]
    return [F.xxhash64(*gaps, *columns).alias("_h1"),
            F.xxhash64(F.lit(2), *columns, *gaps).alias("_h2")]


def _key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, rows with a NULL key, rows and groups of repeated keys, repeated rows.

    Counted by key and content first, so neither a key with many rows nor a row with many copies
    meets in one task before it is summed up.
    """
    names = [f"_k{i}" for i in range(len(key))]
    content = df.select(*[F.col(c).alias(n) for c, n in zip(key, names)], *_content(df))
    alike = content.groupBy(*content.columns).agg(F.count(F.lit(1)).alias("n"))
    copies = F.sum(F.when(F.col("n") > 1, F.col("n")))
    by_key = alike.groupBy(*names).agg(F.sum("n").alias("n"), copies.alias("copies"))
    gap = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names], F.lit(False))
    return by_key.agg(
        F.sum("n").alias("rows"), F.sum(F.when(gap, F.col("n"))).alias("gaps"),
        F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("shared"),
        F.count_if(F.col("n") > 1).alias("groups"), F.sum("copies").alias("copies"))


def _profile(df: DataFrame, contract: TableContract) -> dict[str, Column]:
    out = {"rows": F.count(F.lit(1))}
    out |= {f"nulls {c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    for b in contract.bounds:
        if b.column in df.columns:
            value = as_number(df, b.column)
            out |= {f"out {b.column}": F.count_if(outside(value, b)),
                    f"min {b.column}": F.min(value).cast("double"),
                    f"max {b.column}": F.max(value).cast("double")}
    if all(c in df.columns for c in contract.funnel):
        out |= {f"step {u}<{v}": F.count_if(as_number(df, u) < as_number(df, v))
                for u, v in zip(contract.funnel, contract.funnel[1:])}
    return out


def _row_findings(table: str, df: DataFrame, contract: TableContract, counts: Mapping,
                  profile: Mapping) -> list[Finding]:
    out = [Finding(table, "leakage", len(names), 0, {"offending_columns": ",".join(names)})
           for names in [forbidden_names(df.columns)]]
    absent = [c for c in contract.key if c not in df.columns]
    if absent:
        out.append(_missing(table, "primary_key", ",".join(absent)))
    else:
        gaps, shared = counts["gaps"] or 0, counts["shared"] or 0
        out.append(Finding(table, "primary_key", gaps + shared, 0, {
            "row_count": profile["rows"], "null_key_rows": gaps, "duplicate_rows": shared,
            "duplicate_groups": counts["groups"]}))
    copies = counts["copies"] or 0
    out.append(Finding(table, "duplicate_rows", 0, copies, {
        "row_count": profile["rows"], "duplicate_rows": copies}, blocking=False))

    nulls = {c: profile[f"nulls {c}"] for c in df.columns if profile[f"nulls {c}"]}
    out.append(Finding(
        table, "null_analysis", 0, sum(nulls.values()),
        {"row_count": profile["rows"]} | {
            c: f"nulls={n} pct={_share(n, profile['rows'])}" for c, n in nulls.items()},
        False, f"{len(nulls)} column(s) with nulls"))
    present = [b for b in contract.bounds if b.column in df.columns]
    if present:
        bad = {b.column: b for b in present if profile[f"out {b.column}"]}
        out.append(Finding(
            table, "distribution_ranges", 0, sum(profile[f"out {c}"] for c in bad),
            {c: f"out_of_range={profile[f'out {c}']} "
                f"bounds=[{'' if b.low is None else b.low},{'' if b.high is None else b.high}] "
                f"observed=[{profile[f'min {c}']},{profile[f'max {c}']}]"
             for c, b in bad.items()}, False, f"{len(bad)} column(s) out of range"))
    out += [_missing(table, "distribution_ranges", b.column, False) for b in contract.bounds
            if b.column not in df.columns]
    if contract.funnel:
        if any(c not in df.columns for c in contract.funnel):
            out.append(_missing(table, "funnel_monotonicity", ",".join(contract.funnel), False))
        else:
            steps = {k.removeprefix("step "): v for k, v in profile.items()
                     if k.startswith("step ") and v}
            out.append(Finding(table, "funnel_monotonicity", 0, sum(steps.values()), steps,
                               False, f"{len(steps)} step(s) increase"))
    return out


# -- second scan: values that are compared with other tables -----------------------------------
class _Stack:
    """The values that the checks ask of every table, under a number for each question."""

    def __init__(self, tables: Mapping[str, DataFrame], settings: Settings):
        self.tables, self.settings = tables, settings
        self.numbers: dict[tuple, int] = {}
        self.asked: dict[str, list[Column]] = {}  # table -> structs

    def _ask(self, table: str, question: tuple, **value: Column) -> int:
        if (table, *question) not in self.numbers:
            number = self.numbers[table, *question] = len(self.numbers)
            self.asked.setdefault(table, []).append(F.struct(
                F.lit(number).alias("ask"),
                value.get("number", F.lit(None).cast("bigint")).alias("number"),
                value.get("text", F.lit(None).cast("string")).alias("text"),
                value.get("note", F.lit(None).cast("string")).alias("note")))
        return self.numbers[table, *question]

    def key(self, table: str, column: str, as_text: bool, note: str | None = None) -> int:
        """Ask for a key in the form in which it is compared, with the values of another column
        where ``note`` names one."""
        df = self.tables[table]
        value = {"text" if as_text else "number": comparable(df, column, as_text)}
        if note:
            value["note"] = F.col(note).cast("string")
        return self._ask(table, (column, as_text, note), **value)

    def words(self, table: str, column: str) -> int:
        return self._ask(table, (column, "as it is"), text=F.col(column).cast("string"))

    def as_text(self, *sides: tuple[str, str]) -> bool:
        return any(dict(self.tables[t].dtypes)[c] not in WHOLE_TYPES for t, c in sides)

    def count(self) -> DataFrame:
        """(ask, number, text, note, n), stored. Everything is a grouping key and counts are the
        only buffer, so that Spark aggregates by hash."""
        return durable(union_all([
            self.tables[table].select(F.inline(F.array(*asked)))
            .groupBy("ask", "number", "text", "note").agg(F.count(F.lit(1)).alias("n"))
            for table, asked in self.asked.items()]), "audit-values")


@dataclass(frozen=True)
class _Link:
    """A column of one table and what its values must be found in."""

    check: str
    table: str
    ask: int
    parent_ask: int
    covered: bool = False


def _linked(values: DataFrame, links: Sequence[_Link], noted: bool = False) -> DataFrame:
    """Counted values of every link with ``known``, and the greatest note of the parent if keys
    of the parent were asked for with one."""
    own, theirs = (values_table(values.sparkSession, [(k, a) for k, a in enumerate(asks)],
                                "link int, of_ask int")
                   for asks in ([x.ask for x in links], [x.parent_ask for x in links]))
    left = values.select("ask", "number", "text", "n").join(own, F.expr("ask = of_ask")) \
        .select("link", "number", "text", "n")
    right = (values.filter("number IS NOT NULL OR text IS NOT NULL")
             .join(theirs, F.expr("ask = of_ask"))
             .select(F.col("link").alias("to_link"), F.col("number").alias("to_number"),
                     F.col("text").alias("to_text"), "note"))
    if noted:  # else every key is there once
        right = right.groupBy("to_link", "to_number", "to_text").agg(F.max("note").alias("note"))
    same = F.expr("link = to_link AND number <=> to_number AND text <=> to_text "
                  "AND (number IS NOT NULL OR text IS NOT NULL)")
    return left.join(right, same, "left").select(
        "link", "number", "text", "n", "note", F.col("to_link").isNotNull().alias("known"))


def _samples(marked: DataFrame, by: str, condition: str) -> DataFrame:
    """(of, sample): the ten smallest values that meet a condition, as text."""
    first = W.partitionBy(by).orderBy("value")
    value = F.coalesce("text", F.col("number").cast("string"))
    return (marked.filter(condition).select(by, value.alias("value")).distinct()
            .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= SAMPLE)
            .groupBy(F.col(by).alias("of")).agg(F.array_join(F.array_sort(
                F.collect_list("value")), ",").alias("sample")))


def _reference_findings(values: DataFrame, links: Sequence[_Link]) -> list[Finding]:
    if not links:
        return []
    spark = values.sparkSession
    calendars = values_table(spark, [(k, x.parent_ask) for k, x in enumerate(links)
                                     if x.covered] or [(-1, -1)], "last_of int, of_ask int")
    last = values.join(calendars, F.expr("ask = of_ask")) \
        .groupBy("last_of").agg(F.max(F.coalesce("number", F.col("text").try_cast("bigint")))
                                .alias("last"))
    marked = (_linked(values, links).join(last, F.expr("link = last_of"), "left")
              .withColumn("empty", F.expr("number IS NULL AND text IS NULL"))
              .withColumn("whole", F.coalesce("number", F.col("text").try_cast("bigint")))
              .withColumn("orphan", F.expr("NOT empty AND NOT known"))
              .withColumn("beyond", F.expr("coalesce(orphan AND whole > last, false)")))
    counts = marked.groupBy("link").agg(
        *[F.coalesce(F.sum(F.when(F.expr(c), F.col("n"))), F.lit(0)).alias(name)
          for name, c in (("nulls", "empty"), ("filled", "NOT empty"), ("orphans", "orphan"),
                          ("beyond", "beyond"))],
        F.max(F.when(F.col("beyond"), F.col("whole"))).alias("through"))
    rows = {r.link: r for r in counts.join(_samples(marked, "link", "orphan"),
                                           F.expr("link = of"), "left").collect()}
    out = []
    for k, x in enumerate(links):
        r = rows.get(k)
        nulls, filled, orphans, beyond = (r.nulls, r.filled, r.orphans, r.beyond) if r else (
            0, 0, 0, 0)
        out.append(Finding(x.table, x.check, orphans - beyond, beyond, {
            "null_count": nulls, "orphan_count": orphans, "broken_orphans": orphans - beyond,
            "coverage_orphans": beyond, "coverage_extend_through": r.through if r else None,
            "match_rate": _share(filled - orphans, filled) if filled else 1.0,
            "orphan_sample": (r.sample if r else None) or ""}))
    return out


def _membership_findings(values: DataFrame, asks: Sequence[tuple[str, Membership, int]],
                         parent_asks: Mapping[Membership, int]) -> list[Finding]:
    if not asks:
        return []
    spark = values.sparkSession
    listed = [(k, v) for k, (_, m, _) in enumerate(asks) for v in m.values]
    words = values_table(spark, listed or [(-1, "")], "of int, word string")
    for k, (_, m, _) in enumerate(asks):
        if m.table:
            words = words.unionByName(
                values.filter((F.col("ask") == parent_asks[m]) & F.col("text").isNotNull())
                .select(F.lit(k).alias("of"), F.col("text").alias("word")))
    words = words.distinct()
    forms = words.select(F.col("of").alias("form_of"), folded(F.col("word")).alias("form")) \
        .distinct()
    own = values_table(spark, [(k, a) for k, (_, _, a) in enumerate(asks)],
                       "member int, of_ask int")
    marked = (values.filter("text IS NOT NULL")
              .join(own, F.expr("ask = of_ask"))
              .select("member", "number", "text", "n", folded(F.col("text")).alias("own_form"))
              .join(forms, F.expr("member = form_of AND own_form = form"), "left")
              .join(words, F.expr("member = of AND text = word"), "left")
              .withColumn("unknown", F.expr("form_of IS NULL"))
              .withColumn("dirty", F.expr("form_of IS NOT NULL AND of IS NULL"))
              .select("member", "number", "text", "n", "unknown", "dirty"))
    counts = marked.groupBy("member").agg(*[
        F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(f"n_{c}")
        for c in ("unknown", "dirty")])
    for c in ("unknown", "dirty"):
        sample = _samples(marked, "member", c).withColumnRenamed("sample", f"{c}_sample")
        counts = counts.join(sample, F.col("member") == F.col("of"), "left").drop("of")
    rows = {r.member: r for r in counts.collect()}
    out = []
    for k, (table, m, _) in enumerate(asks):
        r = rows.get(k)
        unknown, dirty = (r.n_unknown, r.n_dirty) if r else (0, 0)
        out.append(Finding(table, f"membership:{m.column}", unknown, dirty, {
            "unknown_count": unknown, "needs_normalization_count": dirty,
            "unknown_sample": (r.unknown_sample if r else None) or "",
            "needs_normalization_sample": (r.dirty_sample if r else None) or ""}))
    return out


def _delivery_findings(values: DataFrame, links: Sequence[_Link]) -> list[Finding]:
    if not links:
        return []
    state = F.when(~F.col("known"), "(unmatched)").when(F.col("note").isNull(), "(no status)") \
        .otherwise(strip(F.col("note")))
    counted = (_linked(values, links, noted=True).filter("number IS NOT NULL OR text IS NOT NULL")
               .groupBy("link", state.alias("state")).agg(F.sum("n").alias("n")))
    common = W.partitionBy("link").orderBy(F.desc("n"), "state")
    listed = counted.withColumn("place", F.row_number().over(common)) \
        .withColumn("name", F.expr(
            f"CASE WHEN state LIKE '(%' OR state = '{DELIVERED}' OR place <= {STATES} "
            "THEN state ELSE '(other)' END")) \
        .groupBy("link", "name").agg(F.sum("n").alias("n"))
    found: dict[int, dict[str, int]] = {}
    for r in listed.collect():
        found.setdefault(r.link, {})[r.name] = r.n
    out = []
    for k, x in enumerate(links):
        states = found.get(k, {})
        total, unmatched = sum(states.values()), states.get("(unmatched)", 0)
        others = {s: n for s, n in sorted(states.items())
                  if s not in ("(unmatched)", "(no status)", DELIVERED)}
        out.append(Finding(x.table, x.check, unmatched + sum(others.values()), 0, {
            "returns_with_order_ref": total, "unmatched_order_lines": unmatched,
            "without_status": states.get("(no status)", 0),
            "returns_against_non_delivered": sum(others.values()),
            "non_delivered_status_breakdown": ",".join(f"{s}={n}" for s, n in others.items())}))
    return out


# -- the layer -----------------------------------------------------------------------------------
def _reference_link(stack: _Stack, table: str, fk: ForeignKey) -> _Link:
    as_text = stack.as_text((table, fk.column), (fk.table, fk.parent_column))
    return _Link(f"fk:{fk.column}", table, stack.key(table, fk.column, as_text),
                 stack.key(fk.table, fk.parent_column, as_text), fk.table == CALENDAR_TABLE)


def _delivery_link(stack: _Stack, table: str) -> _Link:
    as_text = stack.as_text((table, "order_line_id"), ("fact_orders", "order_line_id"))
    return _Link("returns_delivered_reconciliation", table,
                 stack.key(table, "order_line_id", as_text),
                 stack.key("fact_orders", "order_line_id", as_text, "order_status"))


def _first_scan(tables: Mapping[str, DataFrame], settings: Settings) -> list[Finding]:
    watch, counted = Watch(_session(tables)), []
    for table, contract in settings.contracts.items():
        df = watch.on(table, tables[table], _profile(tables[table], contract))
        whole = all(c in df.columns for c in contract.key)
        counted.append(_key_counts(df, contract.key if whole else [])
                       .withColumn("table_name", F.lit(table)))
    counts: dict[str, Mapping] = {}
    profiles = watch.run(lambda: counts.update(
        {r.table_name: r.asDict() for r in union_all(counted).collect()}))
    return [finding for table, contract in settings.contracts.items()
            for finding in _row_findings(table, tables[table], contract, counts[table],
                                         profiles[table])]


def _second_scan(tables: Mapping[str, DataFrame], settings: Settings) -> list[Finding]:
    stack, out = _Stack(tables, settings), []
    links, members, states, parents = [], [], [], {}
    for table, contract in settings.contracts.items():
        df = tables[table]
        for fk in contract.foreign_keys:
            if fk.column in df.columns:
                links.append(_reference_link(stack, table, fk))
            else:
                out.append(_missing(table, f"fk:{fk.column}", fk.column))
        for m in contract.members:
            if m.column in df.columns:
                members.append((table, m, stack.words(table, m.column)))
                if m.table:
                    parents[m] = stack.words(m.table, m.parent_column)
            else:
                out.append(_missing(table, f"membership:{m.column}", m.column))
        if contract.delivered_only and "order_line_id" in df.columns:
            states.append(_delivery_link(stack, table))
    if not stack.asked:
        return out
    values = stack.count()
    return out + _together(lambda: _reference_findings(values, links),
                           lambda: _membership_findings(values, members, parents),
                           lambda: _delivery_findings(values, states))


def _unfit_cells(tables: Mapping[str, DataFrame]) -> list[Finding]:
    """A CSV layer knows what did not fit its types."""
    scans = getattr(tables, "scans", None)
    if not scans:
        return []
    unfit = {name: {} for name in scans}
    for r in quarantine_counts(scans).collect():
        unfit[r.table_name][r.column_name] = r.faults
    return [Finding(name, "unparsed_cells", 0, sum(found.values()), found, False)
            for name, found in unfit.items()]


def _session(tables: Mapping[str, DataFrame]) -> SparkSession:
    return next(iter(tables.values())).sparkSession


def _together(*parts: Callable[[], list[Finding]]) -> list[Finding]:
    """Independent jobs at the same time: small ones do not wait for large ones."""
    with ThreadPoolExecutor(len(parts)) as pool:
        return [x for done in [pool.submit(part) for part in parts] for x in done.result()]


def findings(tables: Mapping[str, DataFrame], settings: Settings) -> list[Finding]:
    """Every check of every contract table."""
    with freed(_session(tables)):
        return _together(lambda: _first_scan(tables, settings),
                         lambda: _second_scan(tables, settings),
                         lambda: _unfit_cells(tables))


def audit_layer(tables: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """Every check of every contract table as one row with its details.

    The checks run when this is called; the result is a small table. A column that a contract
    names and the table lacks fails the check (warns, where the check only warns).
    """
    return _session(tables).createDataFrame([f.row() for f in findings(tables, settings)], SCHEMA)
