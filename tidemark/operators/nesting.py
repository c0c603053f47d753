"""Collect rows into arrays of bounded size.

A group up to ``part_rows`` elements becomes one array, as a plain grouped collect would give. A
larger group is returned as several rows (``part_no`` 0, 1, 2, ...), each holding the next stretch
of the ordered group, so no task ever builds an unbounded array and no element is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import hot_keys, number_rows, running_total, split_hot

PART_ROWS = 100_000


def part_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("tidemark.partRows", str(PART_ROWS)))


def _collected(df: DataFrame, keys: Sequence[str], order: Sequence[str], element: Column, out: str):
    """Group and collect, sorted by ``order`` and then by the element itself.

    Elements travel inside a row, as a collected NULL would be dropped; a struct is a row already.
    Rows are shuffled first, as lists collected before the shuffle would not make it any smaller.
    """
    df = df.repartition(*keys)
    if not order and isinstance(df.select(element.alias("e")).schema["e"].dataType, T.StructType):
        return df.groupBy(*keys).agg(F.sort_array(F.collect_list(element)).alias(out))
    row = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], element.alias("e"))
    rows = F.sort_array(F.collect_list(row))
    return df.groupBy(*keys).agg(F.transform(rows, lambda r: r["e"]).alias(out))


def nest(
    df: DataFrame,
    keys: Sequence[str],
    element: Column,
    out: str,
    order: Sequence[str] = (),
    weight: str | None = None,
    sizing: DataFrame | None = None,
    fits: bool = False,
) -> DataFrame:
    """One row per (key, part_no) with the elements of that part in array ``out``.

    Elements are sorted by ``order``, and by themselves where that leaves ties. ``part_no`` is 0
    unless a group is too large for one array.

    ``weight`` names a column with the size of an element (default 1 each), so that nesting
    already nested arrays stays bounded too. ``sizing`` may give a cheaper table with the same keys
    and weights to measure the groups on; ``fits`` says that they were measured and are all small.
    """
    limit = part_rows(df)
    hot = None if fits else hot_keys(df if sizing is None else sizing, keys, limit, weight)
    if hot is None:
        return _with_part(_collected(df, keys, order, element, out), keys, out, F.lit(0).cast("long"))
    ordinary, large = split_hot(df, keys, hot)
    small = _with_part(_collected(ordinary, keys, order, element, out), keys, out, F.lit(0).cast("long"))
    size = F.lit(1) if weight is None else F.col(weight)
    # The element itself breaks ties, so that a hot group can be cut anywhere.
    sort = [F.col(c).asc_nulls_last() for c in order] + [element.asc_nulls_last()]
    placed = running_total(large, keys, sort, size, "__before").withColumn(
        "part_no", F.floor(F.col("__before") / limit).cast("long")
    )
    parts = _collected(placed, [*keys, "part_no"], order, element, out)
    return small.unionByName(parts.select(*keys, "part_no", out))


def _with_part(df: DataFrame, keys: Sequence[str], out: str, part: Column) -> DataFrame:
    return df.select(*keys, part.alias("part_no"), out)


def table_as_json(df: DataFrame, order: Sequence[str], out: str = "json") -> DataFrame:
    """The whole table as JSON arrays of at most ``part_rows`` rows: (part_no, json)."""
    limit = part_rows(df)
    columns = df.columns
    numbered = number_rows(df, [F.col(c).asc_nulls_last() for c in order], "__rn", start=0)
    placed = numbered.withColumn("part_no", F.floor(F.col("__rn") / limit).cast("long"))
    parts = _collected(placed, ["part_no"], ["__rn"], F.struct(*columns), "rows")
    return parts.select("part_no", F.to_json("rows", {"ignoreNullFields": "false"}).alias(out))
