"""Does a document contain a given one? The given one is a Python literal.

Objects contain objects member by member. Arrays contain arrays when every given element is
contained in some element; order and repetition do not matter. A top-level array also contains a
bare scalar. The test becomes ordinary column expressions, so that typed reads of a path can be
pushed down to the variant column's shredded files.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.variants import path

_OBJECT = "OBJECT"
_ARRAY = "ARRAY"


def contains(doc: Column, literal) -> Column:
    """NULL for a NULL document, else true or false."""
    test = _matches(doc, (), literal)
    if not isinstance(literal, (dict, list)):
        inside = F.exists(
            F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.array().cast("array<variant>")),
            lambda x: _matches(x, (), literal),
        )
        test = test | inside
    return F.when(doc.isNotNull(), test)


def _kind(doc: Column, steps) -> Column:
    return F.schema_of_variant(F.try_variant_get(doc, path(*steps), "variant"))


def _matches(doc: Column, steps: tuple, literal) -> Column:
    if isinstance(literal, dict):
        if not literal:
            return F.coalesce(_kind(doc, steps).startswith(_OBJECT), F.lit(False))
        test = F.lit(True)
        for key, value in literal.items():
            test = test & _matches(doc, (*steps, key), value)
        return test
    if isinstance(literal, list):
        if not literal:
            return F.coalesce(_kind(doc, steps).startswith(_ARRAY), F.lit(False))
        items = F.try_variant_get(doc, path(*steps), "array<variant>")
        test = F.lit(True)
        for wanted in literal:
            test = test & F.exists(items, _element_matches(wanted))
        return F.coalesce(test, F.lit(False))
    return F.coalesce(_scalar(doc, steps, literal), F.lit(False))


def _element_matches(literal):
    return lambda element: _matches(element, (), literal)


def _scalar(doc: Column, steps: tuple, literal) -> Column:
    kind = _kind(doc, steps)
    if literal is None:
        return kind == "VOID"
    if isinstance(literal, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(doc, path(*steps), "boolean") == literal)
    if isinstance(literal, str):
        return (F.try_variant_get(doc, path(*steps), "string") == literal) & (kind == "STRING")
    if isinstance(literal, (int, float, Decimal)):
        numeric = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
        if isinstance(literal, int):
            # Integers beyond double precision must not be compared as doubles.
            exact = (kind == "BIGINT") & (F.try_variant_get(doc, path(*steps), "bigint") == literal)
            other = (kind != "BIGINT") & (F.try_variant_get(doc, path(*steps), "double") == float(literal))
            return numeric & (exact | other)
        return numeric & (F.try_variant_get(doc, path(*steps), "double") == float(literal))
    raise TypeError(f"no JSON value: {literal!r}")
