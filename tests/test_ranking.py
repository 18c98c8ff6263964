import random

import pytest
from pyspark.sql import functions as F

from marginflow.operators.ranking import Ordered, exact_quantiles, percent_rank, tile


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small partitions are not merged, so that rows really lie in several slices."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def data(spark, n=400, seed=1):
    """A third of the values are the same, and some are NULL."""
    r = random.Random(seed)
    made = [(i, r.choice("abc"), 0 if i % 3 == 0 else (None if i % 17 == 0 else r.randint(0, 60)))
            for i in range(n)]
    return spark.createDataFrame(made, "id int, g string, v int").repartition(7)


def ranked(df):
    o = Ordered(df, [F.col("g").asc(), F.col("v").desc_nulls_last(), F.col("id").asc()])
    out = (o.position("p", count_name="n").position("pg", ("g",), "ng")
           .tie_rank("pg", "tie", ("g", "v"))
           .running_total("w", "run", total_name="total")
           .running_total("w", "run_g", ("g",)).rows)
    return (out.withColumn("third", tile(F.col("p"), F.col("n"), 3))
            .withColumn("pr", percent_rank(F.col("tie"), F.col("ng"))))


@pytest.mark.parametrize("n", [1, 2, 400])
def test_slices_equal_plain_windows(spark, n):
    df = data(spark, n).withColumn("w", (F.col("id") % 5 + 1).cast("bigint"))
    df.createOrReplaceTempView("ranking_input")
    plain = spark.sql("""
        SELECT *, row_number() OVER (ORDER BY g, v DESC NULLS LAST, id) AS p,
               count(*) OVER () AS n,
               row_number() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST, id) AS pg,
               count(*) OVER (PARTITION BY g) AS ng,
               rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) AS tie,
               sum(w) OVER (ORDER BY g, v DESC NULLS LAST, id ROWS UNBOUNDED PRECEDING) AS run,
               sum(w) OVER () AS total,
               sum(w) OVER (PARTITION BY g ORDER BY v DESC NULLS LAST, id
                            ROWS UNBOUNDED PRECEDING) AS run_g,
               ntile(3) OVER (ORDER BY g, v DESC NULLS LAST, id) AS third,
               percent_rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) AS pr
        FROM ranking_input""")
    names, sliced = sorted(plain.columns), ranked(df)
    assert sorted(sliced.columns) == names
    assert [tuple(r) for r in sliced.select(names).orderBy("id").collect()] == \
        [tuple(r) for r in plain.select(names).orderBy("id").collect()]


def test_one_value_spreads_over_slices(spark):
    df = spark.range(4000).withColumn("v", F.lit(7))
    placed = Ordered(df, [F.col("v").desc(), F.col("id").asc()])
    assert placed._df.select("slice_id").distinct().count() > 1
    out = placed.position("p").tie_rank("p", "tie", ("v",)).rows
    assert out.agg(F.min("tie"), F.max("tie"), F.count_distinct("p")).collect()[0][:] == (1, 1, 4000)


def test_quantiles_equal_the_percentile_aggregate(spark):
    df = data(spark)
    points = {"low": 0.1, "mid": 0.5, "high": 0.75}
    for by in (("g",), ()):
        exact = df.filter("v is not null").groupBy(*by).agg(
            *[F.percentile("v", F.lit(p)).alias(n) for n, p in points.items()])
        want, got = (sorted(tuple(r) for r in d.collect())
                     for d in (exact, exact_quantiles(df, "v", points, by)))
        assert len(got) == len(want)
        for left, right in zip(got, want, strict=True):
            assert left[:len(by)] == right[:len(by)]
            assert left[len(by):] == pytest.approx(right[len(by):])
