"""Changing JSON documents held as variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAP = "map<string,variant>"


def _as_map(doc: Column) -> Column:
    return F.try_variant_get(doc, "$", _MAP)


def set_path(doc: Column, steps: list[str], value: Column) -> Column:
    """Replace (or add) the member at ``steps``; ``value`` is a variant.

    Objects on the way must exist; where they do not, the document is returned unchanged.
    """
    key, rest = steps[0], steps[1:]
    current = _as_map(doc)
    inner = F.try_variant_get(doc, _member(key), "variant")
    new = set_path(inner, rest, value) if rest else value
    patched = F.to_variant_object(
        F.map_zip_with(current, F.create_map(F.lit(key), new), lambda k, old, n: F.when(k == key, n).otherwise(old))
    )
    possible = current.isNotNull() & inner.isNotNull() if rest else current.isNotNull()
    return F.when(possible, patched).otherwise(doc)


def _member(key: str) -> str:
    from tidemark.functions.variants import path

    return path(key)


def concat(left: Column, right: Column) -> Column:
    """Shallow merge of two objects; the right one wins. NULL when one side is no object."""
    return F.to_variant_object(
        F.map_zip_with(
            _as_map(left),
            _as_map(right),
            # A JSON null on the right is a value; only a missing member is NULL here.
            lambda k, old, new: F.coalesce(new, old),
        )
    )


def delete_key(doc: Column, key: str) -> Column:
    """The object without one member; other kinds of documents are returned unchanged."""
    kept = F.to_variant_object(F.map_filter(_as_map(doc), lambda k, v: k != key))
    return F.coalesce(kept, doc)


def same_text(left: Column, right: Column) -> Column:
    """Do two documents render to the same text? Members are rendered in sorted key order."""
    return F.to_json(left) == F.to_json(right)
