"""Ordered computations per key that survive a key holding a large share of all rows.

A window partitioned by a key puts the whole group into one task. Here only groups up to
``hot_rows`` rows take that route. Larger groups are range-partitioned on (key, order), written
once, evaluated piece by piece, and the pieces are linked with one summary row per piece. The
number of summary rows is at most (partitions + hot keys), so they are safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written

HOT_ROWS = 2_000_000
MAX_BROADCAST_KEYS = 100_000

_POS = "__pos"
_PIECE = "__piece"
_TIE = "__tie"
# monotonically_increasing_id() keeps the partition number above bit 33.
_PIECE_SHIFT = 33


def hot_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("tidemark.hotGroupRows", str(HOT_ROWS)))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def hot_keys(
    df: DataFrame, keys: Sequence[str], limit: int, weight: str | None = None
) -> DataFrame | None:
    """Keys whose rows (or summed ``weight``) exceed ``limit``; None when there are none.

    One map-side combined count decides. The returned table has fewer than total / limit rows.
    """
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = df.groupBy(*keys).agg(size.alias("__size"))
    largest = sizes.agg(F.max("__size")).first()[0]
    if largest is None or largest <= limit:
        return None
    return written(sizes.filter(F.col("__size") > limit).select(*keys), "hot-keys")


def few(hot: DataFrame) -> bool:
    """May the hot keys be sent to every executor? They are a written table, so this is cheap."""
    return hot.count() <= MAX_BROADCAST_KEYS


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys)."""
    side = F.broadcast(hot) if few(hot) else hot
    condition = _same(df, hot, keys)
    return df.join(side, condition, "left_anti"), df.join(side, condition, "left_semi")


@dataclass(frozen=True)
class _Step:
    """How one ordered computation works on a whole group and on pieces of a group.

    whole:   column over the complete group, given (window spec)
    local:   column over one piece, same argument
    summary: aggregate describing a piece
    carry:   column over the pieces of a key, given (window spec over pieces)
    merge:   final value, given (local value, carried value, is-last-row-of-piece flag)
    """

    whole: Callable[[Window], Column]
    local: Callable[[Window], Column]
    summary: Column
    carry: Callable[[Window], Column]
    merge: Callable[[Column, Column, Column], Column]


def lay_out(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Range-partition and sort ``df``, and write it with its position in that order.

    A hash of the row, and then its place in the input, break ties, so that equal rows don't meet in one partition.
    """
    names = [f.name for f in df.schema if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]
    ties = [F.xxhash64(*[F.col(f"`{n}`") for n in names])] if names else []
    order = [*order, *ties, F.col(_TIE)]
    laid = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(_TIE)
        .withColumn(_POS, F.monotonically_increasing_id())
    )
    return written(laid, label).withColumn(_PIECE, F.shiftright(_POS, _PIECE_SHIFT))


def _pieces(df, keys, order, out, step: _Step, broadcast: bool) -> DataFrame:
    laid = lay_out(df, [F.col(k).asc_nulls_last() for k in keys] + list(order), "ordered")
    window = Window.partitionBy(_PIECE, *keys).orderBy(_POS)
    summary = laid.groupBy(_PIECE, *keys).agg(step.summary.alias("__summary"))
    over = Window.partitionBy(*keys).orderBy(_PIECE)
    carried = summary.select(
        F.col(_PIECE).alias("__p"),
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        step.carry(over).alias("__carry"),
    )
    local = laid.withColumn("__local", step.local(window)).withColumn(
        "__last", F.lead(_POS).over(window).isNull()
    )
    condition = F.col(_PIECE) == F.col("__p")
    for i, key in enumerate(keys):
        condition = condition & F.col(key).eqNullSafe(F.col(f"__k{i}"))
    value = step.merge(F.col("__local"), F.col("__carry"), F.col("__last"))
    side = F.broadcast(carried) if broadcast else carried
    return local.join(side, condition, "left").select(
        *[F.col(c) for c in df.columns], value.alias(out)
    )


def _ordered(df, keys, order, out, step: _Step) -> DataFrame:
    plain = Window.partitionBy(*keys).orderBy(*order)
    hot = hot_keys(df, keys, hot_rows(df))
    if hot is None:
        return df.withColumn(out, step.whole(plain))
    ordinary, large = split_hot(df, keys, hot)
    done = ordinary.withColumn(out, step.whole(plain))
    return done.unionByName(_pieces(large, keys, order, out, step, few(hot)))


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], weight: Column, out: str
) -> DataFrame:
    """Sum of ``weight`` over the earlier rows of the same key (0 for the first row)."""

    def before(window):
        return F.coalesce(F.sum(weight).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    step = _Step(
        whole=before,
        local=before,
        summary=F.sum(weight),
        carry=lambda w: F.coalesce(
            F.sum("__summary").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
        merge=lambda local, carry, last: local + carry,
    )
    return _ordered(df, keys, order, out, step)


def row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """1-based position of a row within its key."""

    def number(window):
        return F.row_number().over(window).cast("long")

    step = _Step(
        whole=number,
        local=number,
        summary=F.count(F.lit(1)),
        carry=lambda w: F.coalesce(
            F.sum("__summary").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
        merge=lambda local, carry, last: local + carry,
    )
    return _ordered(df, keys, order, out, step)


def next_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, out: str
) -> DataFrame:
    """``value`` of the following row of the same key, NULL for the last row."""

    def following(window):
        return F.lead(value).over(window)

    step = _Step(
        whole=following,
        local=following,
        summary=F.min_by(value, _POS),
        carry=lambda w: F.lead("__summary").over(w),
        merge=lambda local, carry, last: F.when(last, carry).otherwise(local),
    )
    return _ordered(df, keys, order, out, step)


def running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, out: str
) -> DataFrame:
    """Largest ``value`` over the earlier rows of the same key, NULL for the first row."""

    def before(window):
        return F.max(value).over(window.rowsBetween(Window.unboundedPreceding, -1))

    step = _Step(
        whole=before,
        local=before,
        summary=F.max(value),
        carry=lambda w: F.max("__summary").over(w.rowsBetween(Window.unboundedPreceding, -1)),
        merge=lambda local, carry, last: F.greatest(local, carry),
    )
    return _ordered(df, keys, order, out, step)


def number_rows(df: DataFrame, order: Sequence[Column], out: str, start: int | Column = 1) -> DataFrame:
    """Number all rows from ``start`` in ``order`` without bringing them into one partition."""
    laid = lay_out(df, order, "numbered")
    counts = laid.groupBy(_PIECE).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition of the sorted table.
    window = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(_PIECE).alias("__p"), "__n").select(
        "__p", F.coalesce(F.sum("__n").over(window), F.lit(0)).alias("__offset")
    )
    inside = F.col(_POS).bitwiseAND(F.lit((1 << _PIECE_SHIFT) - 1))
    first = start if isinstance(start, Column) else F.lit(start)
    return laid.join(F.broadcast(offsets), F.col(_PIECE) == F.col("__p"), "inner").select(
        *[F.col(c) for c in df.columns], (inside + F.col("__offset") + first).cast("long").alias(out)
    )
