"""URL filters: explicit rules, and gradient-boosted trees on lexical features for the rest.

All features are native expressions of the address; the trees are trained by Spark on labelled
addresses. Where no others are given, the addresses that a rule decides are the labelled ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.sources.scratch import durable

BLOCK, ALLOW = "block", "allow"
# fixed values: (verdict, host, path)
RULES = (
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
)
FEATURES = ("f_length", "f_host_length", "f_labels", "f_depth", "f_digits", "f_entropy",
            "f_parameters", "f_hyphens", "f_longest", "f_query_length", "f_suffix_rate",
            "f_suffix_count")


@dataclass(frozen=True)
class Boosting:
    """``fit_rows``: the trees are fitted on at most so many labelled addresses, the first in a
    hash order; suffix statistics cover all of them."""

    fit_rows: int = 20_000
    trees: int = 15
    depth: int = 3
    step: float = 0.3
    threshold: float = 0.5


def parsed(url: Column) -> tuple[Column, Column, Column]:
    """Host (lower case), path and what follows it. Null or no ``://``: all empty."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    behind = F.substr(rest, F.length(host) + 1)
    path = F.regexp_extract(behind, "^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path, F.substr(behind, F.length(path) + 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, like ``net/``, and its verdict; null if none does."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text).cast("double")
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda c: (
        size - F.length(F.replace(text, c, F.lit("")))) / size)
    return F.when(size > 0, F.aggregate(shares, F.lit(0.0), lambda t, p: t - F.when(
        p > 0, p * F.log2(p)).otherwise(0.0))).otherwise(0.0)


def lexical(pages: DataFrame) -> DataFrame:
    """``pages(…, url)`` with host, path, suffix and the features that need no other row."""
    host, path, query = parsed(F.col("url"))
    cut = (pages.withColumn("host", host).withColumn("path", path).withColumn("query", query)
           .withColumn("suffix", F.regexp_extract("host", "[^.]*$", 0)))
    size = F.greatest(F.length(F.coalesce("url", F.lit(""))), F.lit(1))
    digits = F.length(F.regexp_replace(F.coalesce("url", F.lit("")), "[^0-9]+", ""))
    labels = F.split("host", "\\.")
    numbers = {
        "f_length": size,
        "f_host_length": F.length("host"),
        "f_labels": F.size(labels),
        "f_depth": F.length(F.regexp_replace("path", "[^/]+", "")),
        "f_digits": digits / size,
        "f_entropy": _entropy(F.col("host")),
        "f_parameters": F.length(F.regexp_replace("query", "[^=]+", "")),
        "f_hyphens": F.length(F.regexp_replace("host", "[^-]+", "")),
        "f_longest": F.array_max(F.transform(labels, F.length)),
        "f_query_length": F.length("query"),
    }
    return cut.withColumns({k: v.cast("double") for k, v in numbers.items()})


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """(suffix, s_blocked, s_rows) over all of ``labelled(suffix, label)``."""
    return labelled.groupBy("suffix").agg(F.sum("label").alias("s_blocked"),
                                          F.count("*").alias("s_rows"))


def _with_suffix(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    """Blocked share and number of the other labelled addresses with this suffix. A row's own
    label never counts for itself."""
    own = F.coalesce(F.col("label").cast("long"), F.lit(0))
    is_labelled = F.col("label").isNotNull().cast("long")
    n = F.coalesce("s_rows", F.lit(0)) - is_labelled
    blocked = F.coalesce("s_blocked", F.lit(0)) - own
    return (rows.join(statistics, "suffix", "left")
            .withColumn("f_suffix_rate", (blocked + 1.0) / (n + 2.0))
            .withColumn("f_suffix_count", F.log1p(n.cast("double"))).drop("s_rows", "s_blocked"))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def judge(pages: DataFrame, rules=RULES, settings: Boosting = Boosting(),
          labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score), one row per row of ``pages``.

    ``labelled(url, label)``: label 1 for addresses to block, 0 to allow; null labels are
    ignored. Without it, the addresses of ``pages`` that a rule decides are used. ``score`` is
    the trees' probability of block. Without labels of both kinds there is nothing to learn and
    the score is 0, or 1 if all labels are block. Null and empty addresses have an empty host
    and path; null ids stay null; repeated rows give repeated results; other columns are ignored.
    """
    rows = lexical(pages.select("page_id", "url"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("by_rule", verdict).withColumn(
        "label", F.when(F.col("by_rule").isNotNull(), (F.col("by_rule") == BLOCK).cast("int")))
    rows = durable(rows, "pages")
    if labelled is None:
        taught = rows.filter("label is not null")
    else:
        taught = lexical(labelled.select("url", F.col("label").cast("int").alias("label"))
                         .filter("label in (0, 1)"))
        rows = rows.withColumn("label", F.lit(None).cast("int"))
    statistics = suffix_statistics(taught)
    sample = durable(_with_suffix(taught, statistics).orderBy(F.xxhash64("url"))
                     .limit(settings.fit_rows).select("label", *FEATURES), "labelled_pages")
    kinds = sample.agg(F.min("label"), F.max("label")).first()
    every = _with_suffix(rows, statistics)
    if kinds[0] == kinds[1]:  # also without any label
        scored = every.withColumn("score", F.lit(float(kinds[0] or 0)))
    else:
        model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=settings.trees,
                              maxDepth=settings.depth, stepSize=settings.step, seed=1) \
            .fit(_assembled(sample))
        scored = model.transform(_assembled(every)) \
            .withColumn("score", vector_to_array("probability")[1])
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(
        F.col("score") >= settings.threshold, BLOCK).otherwise(ALLOW)).alias("verdict"), "score")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
