"""Ordered computations give the same rows whether a key is large or not."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.checks import overlap_violations
from tidemark.operators.ordered import hot_keys, next_value, number_rows, row_number, running_max, running_total


@pytest.fixture
def rows(spark):
    """2,000 rows; one key holds more than a third, one key is NULL."""
    n = F.col("id")
    key = F.when(n % 5 < 2, 0).when(n % 50 == 7, None).otherwise(n % 13 + 1)
    return spark.range(2000).select(
        key.cast("int").alias("k"), F.pmod(n * 7919, F.lit(2003)).alias("o"), (n % 97).alias("v"), n.alias("id")
    )


def window():
    return Window.partitionBy("k").orderBy(F.col("o").asc_nulls_last())


def same(left, right):
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.mark.parametrize("limit", [50, 10_000])
def test_row_number(rows, setting, limit):
    setting("tidemark.hotGroupRows", limit)
    got = row_number(rows, ["k"], [F.col("o").asc_nulls_last()], "x")
    same(got, rows.withColumn("x", F.row_number().over(window()).cast("long")))


@pytest.mark.parametrize("limit", [50, 10_000])
def test_next_value(rows, setting, limit):
    setting("tidemark.hotGroupRows", limit)
    got = next_value(rows, ["k"], [F.col("o").asc_nulls_last()], "v", "x")
    same(got, rows.withColumn("x", F.lead("v").over(window())))


@pytest.mark.parametrize("limit", [50, 10_000])
def test_running_max_and_total(rows, setting, limit):
    setting("tidemark.hotGroupRows", limit)
    before = window().rowsBetween(Window.unboundedPreceding, -1)
    got = running_max(rows, ["k"], [F.col("o").asc_nulls_last()], "v", "x")
    same(got, rows.withColumn("x", F.max("v").over(before)))
    got = running_total(rows, ["k"], [F.col("o").asc_nulls_last()], F.col("v"), "x")
    same(got, rows.withColumn("x", F.coalesce(F.sum("v").over(before), F.lit(0))))


def test_hot_keys_are_the_large_ones(rows):
    assert hot_keys(rows, ["k"], 5000) is None
    assert [r.k for r in hot_keys(rows, ["k"], 300).collect()] == [0]


def test_number_rows_needs_no_single_partition(spark, rows):
    got = number_rows(rows, [F.col("o").desc_nulls_first()], "x", start=5)
    expected = rows.withColumn("x", (F.row_number().over(Window.orderBy(F.col("o").desc_nulls_first())) + 4).cast("long"))
    same(got, expected)


def test_number_rows_of_nothing(rows):
    assert number_rows(rows.filter("id < 0"), [F.col("o")], "x").count() == 0


@pytest.mark.parametrize("limit", [2, 1000])
def test_overlaps(spark, setting, limit):
    setting("tidemark.hotGroupRows", limit)
    data = [("a", 1, 5), ("a", 5, 9), ("a", 2, 3), ("a", 9, 12), ("b", 1, 9), ("b", 3, 4), ("b", 8, 10), ("c", 4, 4)]
    df = spark.createDataFrame(data, "k string, s int, e int")
    bad = overlap_violations(df, "k", "s", "e")
    assert sorted(map(tuple, bad.collect())) == [("a", 2, 3), ("b", 3, 4), ("b", 8, 10)]


def test_equal_rows_are_spread(spark, setting):
    from tidemark.operators.ordered import lay_out

    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    same = spark.range(0, 20_000, 1, 4).select(F.lit(1).alias("v"))
    assert lay_out(same, [F.col("v")], "same").select("__piece").distinct().count() > 1
