"""Nested documents out of three related tables, and writing document edits back to the tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.variants import get_as, get_text
from tidemark.operators.changes import update_from
from tidemark.operators.nesting import nest, part_rows
from tidemark.operators.ordered import hot_keys


@dataclass(frozen=True)
class Level:
    """A table of the hierarchy: its key, the key of its parent, and document fields by name."""

    table: DataFrame
    key: str | None
    fields: Mapping[str, str]
    parent: str | None = None

    def struct(self, *extra: Column) -> Column:
        return F.struct(*[F.col(c).alias(name) for name, c in self.fields.items()], *extra)


def two_levels(top: Level, middle: Level, inner: str) -> DataFrame:
    """(key, part_no, document): every row of ``top`` with its ``middle`` rows in array ``inner``.

    Rows of ``top`` without partners are left out.
    """
    nested = nest(middle.table, [middle.parent], middle.struct(), inner)
    return _on_top(nested, middle.parent, top, inner)


def three_levels(top: Level, middle: Level, leaf: Level, inner: str, leaves: str) -> DataFrame:
    """(key, part_no, document): ``top`` with ``middle`` rows in ``inner``, each with its ``leaves``.

    Everything stays typed until the end; the rows are shuffled once per nesting level. ``middle``
    rows without leaves, and ``top`` rows without those, are left out. A document that would grow
    beyond the size limit of ``nest`` comes in several parts (``part_no``); a ``middle`` row cut in
    such a way appears once in each of its parts.
    """
    # How many leaves end up under a key of ``top``, measured on key columns alone. Where all of
    # these fit, so do the leaves of every middle row. Leaves without a middle row count as one group.
    counts = leaf.table.groupBy(leaf.parent).agg(F.count(F.lit(1)).alias("__weight"))
    sizing = counts.join(
        middle.table.select(middle.key, middle.parent), F.col(middle.key) == F.col(leaf.parent), "left"
    )
    fits = hot_keys(sizing, [middle.parent], part_rows(leaf.table), "__weight") is None
    by_middle = nest(leaf.table, [leaf.parent], leaf.struct(), leaves, fits=fits)
    joined = middle.table.join(by_middle, F.col(middle.key) == F.col(leaf.parent)).drop("part_no")
    weighed = joined.withColumn("__weight", F.size(leaves))
    nested = nest(
        weighed,
        [middle.parent],
        middle.struct(F.col(leaves)),
        inner,
        weight="__weight",
        sizing=sizing,
        fits=fits,
    )
    return _on_top(nested, middle.parent, top, inner)


def _on_top(nested: DataFrame, parent: str, top: Level, inner: str) -> DataFrame:
    found = top.table.join(nested, F.col(top.key) == F.col(parent))
    return found.select(top.key, "part_no", top.struct(F.col(inner)).alias("document"))


def as_variant(documents: DataFrame) -> DataFrame:
    """The typed document as a variant."""
    return documents.withColumn("document", F.to_variant_object("document"))


def apply_document_edits(
    base: DataFrame,
    before: DataFrame,
    after: DataFrame,
    key: str,
    document_key: str,
    fields: Mapping[str, tuple[str, int]],
) -> DataFrame:
    """The next state of ``base`` after documents of it were edited.

    ``before`` and ``after`` are documents in column ``doc``; rows belong together by
    ``document_key`` of the old document, given as column ``key`` in ``after``. ``fields`` maps a
    column of ``base`` to (member, length): the column takes the new text, cut to that length,
    where it differs from the old one. A change to or from NULL is no difference.
    """
    old = before.select(
        get_as(F.col("doc"), "long", document_key).alias(key),
        *[F.substring(get_text(F.col("doc"), m), 1, n).alias(f"__old_{c}") for c, (m, n) in fields.items()],
    )
    new = after.select(
        key, *[F.substring(get_text(F.col("doc"), m), 1, n).alias(f"__now_{c}") for c, (m, n) in fields.items()]
    )
    paired = old.join(new, key)
    result = base
    for column in fields:
        edits = paired.filter(F.col(f"__old_{column}") != F.col(f"__now_{column}"))
        result = update_from(result, edits, key, {column: f"__now_{column}"})
    return result
