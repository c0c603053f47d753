"""Reading JSON documents held as variants: members, paths, elements."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLAIN_KEY = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


def path(*steps: str | int) -> str:
    """``path("albums", 0, "title")`` is ``$.albums[0].title``."""
    text = "$"
    for step in steps:
        if isinstance(step, int):
            text += f"[{step}]"
        elif _PLAIN_KEY.match(step):
            text += f".{step}"
        elif "'" not in step:
            text += f"['{step}']"
        else:
            text += f'["{step}"]'
    return text


def get(doc: Column, *steps: str | int) -> Column:
    """Member or element as a document; NULL when the path does not exist."""
    return F.try_variant_get(doc, path(*steps), "variant")


def get_text(doc: Column, *steps: str | int) -> Column:
    """Member or element as text; a JSON null is a NULL."""
    return F.try_variant_get(doc, path(*steps), "string")


def get_as(doc: Column, kind: str, *steps: str | int, safe: bool = False) -> Column:
    """Typed member or element. A value that does not fit raises, or is NULL when ``safe``."""
    read = F.try_variant_get if safe else F.variant_get
    return read(doc, path(*steps), kind)


def exists(doc: Column, *steps: str | int) -> Column:
    """True when the path exists; a JSON null member counts, a missing one does not."""
    return get(doc, *steps).isNotNull()


def members(doc: Column, *steps: str | int) -> Column:
    """array<struct<key, value: variant>> of an object's members; NULL for anything else."""
    return F.map_entries(F.try_variant_get(doc, path(*steps), "map<string,variant>"))


def elements(doc: Column, *steps: str | int) -> Column:
    """array<variant> of an array's elements; NULL for anything else."""
    return F.try_variant_get(doc, path(*steps), "array<variant>")


def unnest(df: DataFrame, doc: str, *steps: str | int, out: str, keep: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per array element, in column ``out``; documents without elements give no row.

    ``keep`` names the columns that stand beside the elements (default: all of ``df``). They are computed before the array is
    opened, so that only they, and not the document, are copied to each row.
    """
    kept = {c: F.col(c) for c in df.columns if c != out} if keep is None else keep
    flat = df.select(*[value.alias(name) for name, value in kept.items()], elements(F.col(doc), *steps).alias("__elements"))
    # The outer form: for the inner one the optimiser would add a filter on the array's size and compute the array twice.
    rows = flat.select(*kept, F.posexplode_outer("__elements").alias("__at", out))
    return rows.filter(F.col("__at").isNotNull()).drop("__at")


def each(df: DataFrame, doc: str, *steps: str | int, key: str = "key", value: str = "value") -> DataFrame:
    """One row per object member with its key and its value as text."""
    rows = df.withColumn("__member", F.explode(members(F.col(doc), *steps)))
    return rows.withColumns({key: F.col("__member.key"), value: get_text(F.col("__member.value"))}).drop("__member")


def recordset(df: DataFrame, doc: str, schema: str, *steps: str | int) -> DataFrame:
    """One row per element of an array of objects, with the declared columns.

    Members that are not declared are left out, missing ones are NULL; a column declared as
    ``variant`` stays a document.
    """
    rows = F.try_variant_get(F.col(doc), path(*steps), f"array<struct<{schema}>>")
    return df.withColumn("__row", F.explode(rows)).select("*", "__row.*").drop("__row")


def from_text(text: Column) -> Column:
    """A piece of text as a JSON string value."""
    return text.cast("variant")


def from_row(*columns: str | Column) -> Column:
    """A row as a document; NULL members are kept."""
    return F.to_variant_object(F.struct(*columns))


def row_json(*columns: str | Column) -> Column:
    """A row as JSON text with NULL members kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def anonymous_row_json(*columns: Column) -> Column:
    """A row without column names: members are called f1, f2, ..."""
    return row_json(*[c.alias(f"f{i}") for i, c in enumerate(columns, start=1)])


def pretty(doc: Column, schema: str) -> Column:
    """A document rendered on several lines, for the members named in ``schema``."""
    typed = F.from_json(F.to_json(doc), schema)
    return F.to_json(typed, {"pretty": "true", "ignoreNullFields": "false"})


def member_values(doc: Column, *steps: str | int) -> Column:
    """array<variant> of the member values, members ordered by key length and then by key."""
    return F.transform(_ordered_members(doc, *steps), lambda m: m["value"])


def first_member(doc: Column, *steps: str | int) -> Column:
    """struct<key, value> of the first member in the same order; NULL without members."""
    return F.try_element_at(_ordered_members(doc, *steps), F.lit(1))


def _ordered_members(doc: Column, *steps: str | int) -> Column:
    as_map = F.try_variant_get(doc, path(*steps), "map<string,variant>")
    # Variants cannot be compared, so the keys are sorted and the values looked up.
    sized = F.transform(F.map_keys(as_map), lambda k: F.struct(F.length(k).alias("n"), k.alias("k")))
    return F.transform(
        F.array_sort(sized), lambda s: F.struct(s["k"].alias("key"), F.element_at(as_map, s["k"]).alias("value"))
    )
