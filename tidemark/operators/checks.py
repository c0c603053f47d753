"""Constraint checks as queries: an empty result means the constraint holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.operators.ordered import running_max


class ConstraintError(ValueError):
    """A table breaks a declared rule."""


def _keyed(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """The key alone: named columns, and expressions, such as a member of a document, under their aliases."""
    return df.select(*keys)


def unique_violations(df: DataFrame, keys: Sequence[str | Column], nulls_equal: bool = False) -> DataFrame:
    """Keys that occur more than once, with their count.

    A key part is a column name or an expression; an expression that gives a document has to be turned into text or a
    type first, as documents cannot be compared. As in a unique index, keys with a NULL differ from each other, unless
    ``nulls_equal`` is set.
    """
    keyed = _keyed(df, keys)
    if not nulls_equal:
        keyed = keyed.dropna()
    return keyed.groupBy(*[F.col(f"`{c}`") for c in keyed.columns]).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def first_violation(bad: DataFrame) -> Row | None:
    """The smallest row of ``bad``, in one job however many partitions have to be looked at."""
    return bad.agg(F.min(F.struct(*bad.columns))).first()[0]


def assert_unique(df: DataFrame, keys: Sequence[str | Column]) -> None:
    bad = first_violation(unique_violations(df, keys))
    if bad is not None:
        raise ConstraintError(f"key {_keyed(df, keys).columns} is not unique, for example {bad.asDict()}")


def foreign_key_violations(child: DataFrame, parent: DataFrame, child_keys, parent_keys) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    filled = child.dropna(subset=list(child_keys))
    condition = [filled[c] == parent[p] for c, p in zip(child_keys, parent_keys)]
    return filled.join(parent, condition, "left_anti")


def overlap_violations(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Rows whose ``[start, end)`` range begins before an earlier range of the key has ended.

    A row is compared with the furthest end seen so far, so no pairs of rows are formed.
    """
    filled = df.filter(F.col(start) < F.col(end))
    order = [F.col(start).asc_nulls_last(), F.col(end).asc_nulls_last()]
    seen = running_max(filled, [key], order, end, "__seen")
    return seen.filter(F.col("__seen") > F.col(start)).drop("__seen")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_null) for every required column, counted in one pass."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns])
    return counts.select(F.inline(pairs))
