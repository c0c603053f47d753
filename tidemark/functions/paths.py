"""JSON path text over variants, as column expressions.

``compile_path('$.product.*')`` reads a path once; ``query``, ``query_first``, ``query_array`` and ``exists`` apply it to a document
column. Supported: members (``.key``, ``."any key"``, ``.*``), elements (``[3]``, ``[*]``) and filters (``? (@.a.b == "x" && @.n >= 3)``,
``? (exists(@.a))``), any number of each in any order. Everything else is refused by name.

Paths are lax: a member step looks into the elements of an array, ``[*]`` and ``[0]`` take anything that is not an array for an array
of one element, a filter tests the elements of an array, and what doesn't exist is no result. A comparison holds if any value
on its left does, and never across types. Members of ``.*`` come by key length and then by key.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import variants


class PathError(ValueError):
    """The text is no path, or uses syntax that is not supported."""


@dataclass(frozen=True)
class Member:
    key: str


@dataclass(frozen=True)
class Members:
    pass


@dataclass(frozen=True)
class Element:
    at: int | None


@dataclass(frozen=True)
class Test:
    path: tuple
    op: str
    value: object


@dataclass(frozen=True)
class Filter:
    tests: tuple[Test, ...]


# The signs of a path.
_TOKEN = re.compile(
    r"""\s*(?:(?P<string>"(?:[^"\\]|\\.)*")|(?P<number>-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|(?P<name>[^\W\d]\w*)"""
    r"""|(?P<sign>==|!=|<>|<=|>=|&&|\|\||\*\*|[$@.\[\]*?()<>!,+/%{}-]))"""
)
_OPS = ("==", "!=", "<>", "<", "<=", ">", ">=")


class _Reader:
    def __init__(self, text: str):
        self.text, self.tokens, at = text, [], 0
        body = text.rstrip()
        while at < len(body):
            found = _TOKEN.match(body, at)
            if not found:
                raise PathError(f"not supported in path {text!r}: {body[at:].strip()[:20]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def peek(self, ahead: int = 0) -> tuple[str, str]:
        at = self.at + ahead
        return self.tokens[at] if at < len(self.tokens) else ("end", "the end")

    def take(self, sign: str) -> bool:
        found = self.peek() == ("sign", sign)
        self.at += found
        return found

    def want(self, sign: str) -> None:
        if not self.take(sign):
            raise self.refused()

    def refused(self) -> PathError:
        return PathError(f"not supported in path {self.text!r}: {self.peek()[1]!r}, {sign_or_step(self.peek())}")

    def steps(self) -> tuple:
        out = []
        while True:
            kind, value = self.peek()
            if (kind, value) == ("sign", "."):
                self.at += 1
                out.append(self.member())
            elif (kind, value) == ("sign", "["):
                self.at += 1
                out.append(self.element())
            elif (kind, value) == ("sign", "?"):
                self.at += 1
                self.want("(")
                out.append(self.filter())
                self.want(")")
            else:
                return tuple(out)

    def member(self):
        kind, value = self.peek()
        if self.take("*"):
            return Members()
        if kind not in ("name", "string") or self.peek(1) == ("sign", "("):
            raise self.refused()
        self.at += 1
        return Member(json.loads(value) if kind == "string" else value)

    def element(self):
        kind, value = self.peek()
        if self.take("*"):
            out = Element(None)
        elif kind == "number" and value.isdigit():
            self.at += 1
            out = Element(int(value))
        else:
            raise self.refused()
        self.want("]")
        return out

    def filter(self) -> Filter:
        tests = [self.test()]
        while self.take("&&"):
            tests.append(self.test())
        return Filter(tuple(tests))

    def test(self) -> Test:
        if self.peek() == ("name", "exists") and self.peek(1) == ("sign", "("):
            self.at += 2
            self.want("@")
            path = self.steps()
            self.want(")")
            return Test(path, "exists", None)
        self.want("@")
        path = self.steps()
        kind, op = self.peek()
        if kind != "sign" or op not in _OPS:
            raise self.refused()
        self.at += 1
        kind, value = self.peek()
        if kind not in ("string", "number") and value not in ("true", "false", "null"):
            raise self.refused()
        self.at += 1
        return Test(path, "!=" if op == "<>" else op, json.loads(value))


def sign_or_step(token: tuple[str, str]) -> str:
    return {"end": "something has to follow", "name": "a name without a dot or a method"}.get(token[0], "a sign out of place")


def compile_path(text: str) -> tuple:
    """The steps of a path; ``PathError`` names what is not supported."""
    reader = _Reader(text)
    reader.want("$")
    steps = reader.steps()
    if reader.peek()[0] != "end":
        raise reader.refused()
    return steps


# --- steps over a sequence (array of variants) ---


def _each(values: Column, step: Callable[[Column], Column]) -> Column:
    return F.flatten(F.transform(values, step))


def _unwrapped(values: Column) -> Column:
    """Arrays replaced by their elements."""
    return _each(values, lambda v: F.coalesce(variants.elements(v), F.array(v)))


def _present(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull())


def _through(values: Column, step) -> Column:
    if isinstance(step, Member):
        return _present(F.transform(_unwrapped(values), lambda v: variants.get(v, step.key)))
    if isinstance(step, Members):
        none = F.array().cast("array<variant>")
        return _each(_unwrapped(values), lambda v: F.coalesce(variants.member_values(v), none))
    if isinstance(step, Element):
        if step.at is None:
            return _unwrapped(values)
        alone = (lambda v: v) if step.at == 0 else (lambda v: F.lit(None).cast("variant"))
        is_array = lambda v: variants.elements(v).isNotNull()
        return _present(F.transform(values, lambda v: F.when(is_array(v), variants.get(v, step.at)).otherwise(alone(v))))
    return F.filter(_unwrapped(values), lambda v: _holds(v, step.tests))


def _applied(values: Column, steps: tuple) -> Column:
    for step in steps:
        values = _through(values, step)
    return values


def _holds(value: Column, tests: tuple[Test, ...]) -> Column:
    out = F.lit(True)
    for test in tests:
        found = _applied(F.array(value), test.path)
        out = out & (F.size(found) > 0 if test.op == "exists" else F.exists(found, _comparing(test)))
    return out


def _comparing(test: Test) -> Callable[[Column], Column]:
    return lambda value: _compared(value, test.op, test.value)


def _compared(value: Column, op: str, wanted) -> Column:
    kind = F.schema_of_variant(value)
    if wanted is None:
        same = kind == "VOID"
        return same if op == "==" else ~same if op == "!=" else F.lit(False)
    if isinstance(wanted, bool):
        fits, own = kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean")
    elif isinstance(wanted, str):
        fits, own = kind == "STRING", F.try_variant_get(value, "$", "string")
    else:
        fits = kind.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        own = F.try_variant_get(value, "$", "decimal(38,9)" if isinstance(wanted, int) else "double")
    other = F.lit(wanted)
    result = {"==": own == other, "!=": own != other, "<": own < other, "<=": own <= other, ">": own > other, ">=": own >= other}[op]
    return fits & F.coalesce(result, F.lit(False))


# --- what one asks for ---


def query(doc: Column, path: str) -> Column:
    """array<variant> of everything the path finds, in order; NULL for a NULL document."""
    return F.when(doc.isNotNull(), _applied(F.array(doc), compile_path(path)))


def query_first(doc: Column, path: str) -> Column:
    """The first thing the path finds; NULL if there is none."""
    return F.try_element_at(query(doc, path), F.lit(1))


def query_array(doc: Column, path: str) -> Column:
    """The same as JSON text of an array, empty if there is none."""
    return F.concat(F.lit("["), F.array_join(F.transform(query(doc, path), lambda v: F.to_json(v)), ","), F.lit("]"))


def exists(doc: Column, path: str) -> Column:
    """Does the path find anything? A JSON null counts."""
    return F.size(query(doc, path)) > 0
