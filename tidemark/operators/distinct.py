"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """The first (or last) row of every key by ``order``, which must be a total order per key.

    NULLs in the order columns come last, so they are taken first with ``last``. An aggregate rather than a window:
    every map task sends one row per key it has seen.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    row = F.struct(*[F.col(c) for c in rest])
    by = F.struct(*[F.struct(F.col(c).isNull().alias("absent"), F.col(c).alias("value")).alias(f"o{i}") for i, c in enumerate(order)])
    best = df.groupBy(*keys).agg(pick(row, by).alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])
