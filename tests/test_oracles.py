"""A few named queries against their SQL on the smallest tables, and all that order globally.

``python -m oracles.compare`` runs all of them.
"""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from marginflow.catalog import QUERIES
from oracles.compare import connect, difference, rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the shared tables")


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def compare(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = connect(FOLDER).execute(entry.oracle_sql()[name])
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert difference(mine, theirs) == ""
    assert mine[1]


@pytest.mark.parametrize("name", [
    "rto_by_payment", "temporal_returns", "dq_fk_coverage", "listing_metrics_monthly",
    "dq_key_normalization", "cleaning_report"])
def test_query_equals_sql(spark, name):
    compare(spark, name)


@pytest.mark.parametrize("name", [
    "intervention_queue", "concentration_by_segment", "weight_fallback", "seller_ranking",
    "seller_percentile", "bottom_quartile_share", "lqs_histogram", "pareto_recoverable"])
def test_ordered_query_equals_sql_over_many_slices(spark, name):
    """Ranks and quantiles with no broadcast join and no merged partitions."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        compare(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
