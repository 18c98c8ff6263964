"""Stored layouts of the line facts: by month, and by the key that later joins and sums use.

``by_month`` lays a fact out in month folders, so a question about a period reads only its months,
also when the months follow from a join with the calendar. ``by_key`` writes buckets that are
hashed and sorted by a key: sums by that key and joins of two such tables need no shuffle. A key with very
many lines stays in one bucket, so buckets are an opt-in for facts without such a key; ``hot_keys``
tells.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.functions.dates import month_key
from marginflow.sources.scratch import SCRATCH, application_folder, freed

MONTH = "month"


def by_month(fact: DataFrame, date_key: str, folder: str | None = None) -> DataFrame:
    """The fact with a column ``month``, written by month and read back.

    Rows are dealt by month first, so that a month has few files; Spark splits a month with
    very many rows over several tasks (a rebalance, no plain repartition).
    """
    path = folder or f"{application_folder(fact.sparkSession)}/months-{uuid.uuid4().hex}"
    dated = fact.withColumn(MONTH, month_key(F.col(date_key)).cast("int"))
    dated.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(path)
    return fact.sparkSession.read.schema(dated.schema).parquet(path)


def in_months(fact: DataFrame, first: int, last: int) -> DataFrame:
    """The months from ``first`` to ``last`` (yyyymm), of a fact laid out by month."""
    return fact.filter(F.col(MONTH).between(first, last))


def in_season(fact: DataFrame, calendar: DataFrame, season: str | Column,
              date_key: str) -> DataFrame:
    """The rows of a fact on days for which the calendar says ``season``. Days are joined with their
    month, so months without such a day are never read: Spark prunes by the join if the calendar is
    small and its filter holds a comparison, which a mere flag is not."""
    days = calendar.filter(season).filter(F.col("date_key") > 0).select(
        F.col("date_key").alias("_day"), month_key(F.col("date_key")).cast("int").alias("_month"))
    return fact.join(days, (F.col(MONTH) == F.col("_month")) & (F.col(date_key) == F.col("_day"))) \
        .drop("_day", "_month")


def by_key(df: DataFrame, key: str, buckets: int, label: str = "keyed") -> DataFrame:
    """``df`` as a table of ``buckets`` files, hashed and sorted by ``key``."""
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    with freed(spark):
        (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).options(**SCRATCH)
         .option("path", f"{application_folder(spark)}/{name}").saveAsTable(name))
    return spark.table(name)


def hot_keys(df: DataFrame, key: str, buckets: int, factor: int = 4) -> DataFrame:
    """(key, rows) of the keys that alone fill a bucket ``factor`` times the average size."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = counted.agg(F.sum("rows")).scalar()
    return counted.filter(F.col("rows") * buckets > total * factor)
