"""Row numbers against row_number; ties, nulls, hot groups, clashing names."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ouzel.operators.numbering import in_ranges, numbered, running


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, (None if i % 11 == 0 else "hot" if i % 3 else f"g{i % 7}"), i * 37 % 101 if i % 13 else None, "x") for i in range(3000)]
    return spark.createDataFrame(data, "id long, grp string, v long, _at string").repartition(5, "id")


@pytest.mark.parametrize("by", [[], ["grp"], ["grp", "_at"]])
def test_equals_row_number(rows, by):
    got = numbered(rows, ["v", F.col("id").desc()], by=by, out="k", first=1, size="n")
    w = Window.partitionBy(*by).orderBy("v", F.col("id").desc())
    want = rows.withColumn("k", F.row_number().over(w).cast("long")).withColumn("n", F.count("*").over(Window.partitionBy(*by)))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_ties_and_empty(spark):
    same = spark.range(5000).select(F.lit(1).alias("a"))
    got = [r[0] for r in numbered(same, ["a"], out="k").select("k").collect()]
    assert sorted(got) == list(range(5000))
    assert numbered(same.limit(0), ["a"], out="k").count() == 0


def test_ties_are_spread_over_ranges(spark):
    """A value that all rows share does not land in one range."""
    same = spark.range(0, 20_000, 1, 8).select(F.lit(1).alias("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # small ranges are put together
    try:
        per = in_ranges(same, ["a"], "at", "test").groupBy(F.shiftright("at", 33)).count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert per.agg(F.max("count")).first()[0] < 10_000 and per.agg(F.sum("count")).first()[0] == 20_000


def test_running_totals(rows):
    w = Window.orderBy("v", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = rows.withColumn("before", F.coalesce(F.sum("id").over(w), F.lit(0)))
    got = running(rows, ["v", "id"], "id")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert running(rows.limit(0), ["v"], "id").count() == 0
