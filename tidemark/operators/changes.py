"""Append, update and delete expressed as the next state of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import number_rows


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``target`` plus ``rows``; columns are matched by name and must be the same set."""
    return target.unionByName(rows)


def with_next_ids(rows: DataFrame, target: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Give ``rows`` the keys after the largest key of ``target``, in ``order``."""
    top = target.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    return number_rows(rows, [F.col(c).asc_nulls_last() for c in order], key, start=top + 1)


def update_rows(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where ``condition`` is true; NULL conditions leave the row alone."""
    return df.withColumns({name: F.when(condition, value).otherwise(F.col(name)) for name, value in values.items()})


def update_from(
    df: DataFrame, other: DataFrame, key: str, values: Mapping[str, str], where: Column | None = None
) -> DataFrame:
    """Set columns of ``df`` from the row of ``other`` with the same key.

    ``other`` must be unique on the key: a row with two partners ends the query with an error. ``values`` maps a
    column of ``df`` to a column of ``other``. Rows without a partner are kept as they are; a partner's NULL is taken over.
    """
    side = (
        other.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(
            F.count(F.lit(1)).alias("__partners"),
            *[F.any_value(source).alias(f"__new_{name}") for name, source in values.items()],
        )
    )
    joined = df.join(side, F.col(key) == F.col("__key"), "left")
    twice = F.concat(F.lit(f"update_from: several new rows for {key} "), F.col(key).cast("string"))
    hit = F.when(F.col("__partners") > 1, F.raise_error(twice).cast("boolean")).otherwise(F.col("__partners").isNotNull())
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    columns = [
        F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in df.columns
    ]
    return joined.select(*columns)


def delete_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which ``condition`` is not true (false or NULL)."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
