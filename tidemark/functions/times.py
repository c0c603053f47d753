"""Dates, ages and validity ranges. Nothing here reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound of a range that has not ended.
OPEN_END = "9999-12-31 23:59:59.999999"


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def age(end: Column, start: Column) -> Column:
    """struct<years, months, days> between two days, negative when ``end`` is the earlier one.

    Calendar fields are subtracted; missing days are borrowed from the month of the earlier day.
    """
    low = F.least(F.to_date(start), F.to_date(end))
    high = F.greatest(F.to_date(start), F.to_date(end))
    sign = F.when(F.to_date(end) < F.to_date(start), -1).otherwise(1)
    days = F.dayofmonth(high) - F.dayofmonth(low)
    borrow = days < 0
    months = (F.year(high) - F.year(low)) * 12 + F.month(high) - F.month(low) - F.when(borrow, 1).otherwise(0)
    rest = F.when(borrow, days + F.dayofmonth(F.last_day(low))).otherwise(days)
    return F.struct(
        (sign * F.floor(months / 12)).cast("int").alias("years"),
        (sign * F.pmod(months, F.lit(12))).cast("int").alias("months"),
        (sign * rest).cast("int").alias("days"),
    )


def year_start(ts: Column) -> Column:
    return F.date_trunc("year", ts).cast("timestamp_ntz")


def next_year_start(ts: Column) -> Column:
    return (year_start(ts) + F.make_ym_interval(F.lit(1))).cast("timestamp_ntz")


def contains_point(start: Column, end: Column, ts: Column) -> Column:
    """Is ``ts`` inside ``[start, end)``?"""
    return (start <= ts) & (ts < end)


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Do two non-empty ranges ``[a, b)`` share a moment?"""
    return (a_start < b_end) & (b_start < a_end) & (a_start < a_end) & (b_start < b_end)
