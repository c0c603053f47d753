import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.functions.text import strip_tags


@pytest.mark.parametrize(
    "end, start, expected",
    [
        ("2024-03-01", "2023-01-31", (1, 1, 1)),
        ("2024-03-31", "2024-02-29", (0, 1, 2)),
        ("2024-02-29", "2023-02-28", (1, 0, 1)),
        ("2024-01-01", "2024-01-01", (0, 0, 0)),
        ("2023-12-31", "2024-02-01", (0, -1, -1)),
        ("2006-02-15", "2006-01-20", (0, 0, 26)),
    ],
)
def test_age(spark, end, start, expected):
    parts = times.age(F.lit(end).cast("date"), F.lit(start).cast("date"))
    assert tuple(spark.range(1).select(parts.alias("a")).select("a.*").first()) == expected


def test_ranges(spark):
    df = spark.createDataFrame([(1, 5, 5, 9), (1, 5, 4, 6), (1, 9, 2, 3), (2, 2, 1, 9)], "a int, b int, c int, d int")
    got = df.select(times.overlaps(*[F.col(c) for c in "abcd"])).collect()
    assert [r[0] for r in got] == [False, True, True, False]
    got = df.select(times.contains_point(F.col("a"), F.col("b"), F.lit(5))).collect()
    assert [r[0] for r in got] == [False, False, True, False]


def test_year_bounds(spark):
    ts = times.moment("1999-12-31 23:59:59.5")
    row = spark.range(1).select(times.year_start(ts), times.next_year_start(ts)).first()
    assert tuple(row) == (dt.datetime(1999, 1, 1), dt.datetime(2000, 1, 1))


def test_strip_tags(spark):
    html = "<p class='x'>Hello</p>\r\n\r\n<b>World</b> 1 < 2"
    assert spark.range(1).select(strip_tags(F.lit(html))).first()[0] == "Hello World 1 < 2"
