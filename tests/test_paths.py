"""JSON paths against results written out by hand and against a plain evaluation."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import paths

DOCS = [
    '{"product": {"category": "A & B", "title": "t", "subcategory": null}, "review": {"rating": 5, "text": "ok"}, "id": 1}',
    '[{"product": {"category": "A & B"}}, {"product": {"category": "C"}}, 3, "x", null, true]',
    '{"product": [{"category": "C"}, {"category": "A & B", "n": [1, 2.5]}], "a b": {"k": -1}}',
    "5", "null", '"s"', "[]", "{}", "[[1], [2, [3]]]", None,
]
PATHS = [
    "$", "$.*", "$.product.*", "$.review.*", "$.product.category", "$[*]", "$[0]", "$[1].product", "$.product[1].n[*]", '$."a b".k',
    '$[*] ? (@.product.category == "A & B")', '$[*] ? (@.product.category == "A & B").product.category', "$.product ? (exists(@.n))",
    "$.review ? (@.rating >= 5)", "$.review ? (@.rating > 4.5 && @.text != \"no\")", "$.*.*", "$[*][*]", "$ ? (@.id < 2)",
    "$.product ? (@.subcategory == null)", "$[*] ? (@ == true)", "$ . product [ * ] . category",
]


def plain(doc, steps):
    values = [doc]
    for s in steps:
        flat = [x for v in values for x in (v if isinstance(v, list) else [v])]
        if isinstance(s, paths.Member):
            values = [v[s.key] for v in flat if isinstance(v, dict) and s.key in v]
        elif isinstance(s, paths.Members):
            values = [v[k] for v in flat if isinstance(v, dict) for k in sorted(v, key=lambda k: (len(k), k))]
        elif isinstance(s, paths.Element):
            if s.at is None:
                values = flat
            else:
                values = [v[s.at] if isinstance(v, list) else v for v in values if (len(v) > s.at if isinstance(v, list) else s.at == 0)]
        else:
            values = [v for v in flat if all(holds(v, t) for t in s.tests)]
    return values


def holds(value, test):
    found = plain(value, test.path)
    if test.op == "exists":
        return bool(found)

    def kind(x):
        return "b" if isinstance(x, bool) else "n" if isinstance(x, (int, float)) else "s" if isinstance(x, str) else x if x is None else "o"

    def one(x):
        if test.value is None:
            return (x is None) if test.op == "==" else (x is not None) if test.op == "!=" else False
        if kind(x) != kind(test.value):
            return False
        return {"==": x == test.value, "!=": x != test.value, "<": x < test.value, "<=": x <= test.value, ">": x > test.value, ">=": x >= test.value}[test.op]

    return any(one(x) for x in found)


def rows(spark, docs):
    return spark.createDataFrame(list(enumerate(docs)), "i int, t string").select("i", F.parse_json("t").alias("doc"))


def check(spark, docs, asked):
    table = rows(spark, docs)
    wide = table.select("i", *[paths.query_array(F.col("doc"), p).alias(f"p{k}") for k, p in enumerate(asked)])
    for row in wide.collect():
        for k, p in enumerate(asked):
            text = docs[row.i]
            found = None if row[f"p{k}"] is None else json.loads(row[f"p{k}"])
            expected = None if text is None else plain(json.loads(text), paths.compile_path(p))
            assert found == expected, (p, text)


def test_paths(spark):
    check(spark, DOCS, PATHS)


def test_first_and_exists(spark):
    doc = F.col("doc")
    found = rows(spark, DOCS).select(
        F.to_json(paths.query_first(doc, "$.*")).alias("first"), paths.exists(doc, "$.product.category").alias("has")
    ).collect()
    assert [r.first for r in found][:4] == ["1", '{"category":"A & B"}', '{"k":-1}', None]
    assert [r.has for r in found] == [True, True, True] + [False] * 6 + [None]


def test_random_documents(spark):
    rng = random.Random(3)

    def make(depth):
        pick = rng.random()
        if depth == 0 or pick < 0.3:
            return rng.choice([1, 2, 3, "x", "y", None, True])
        if pick < 0.65:
            return {k: make(depth - 1) for k in rng.sample(["a", "b", "cc", "d"], rng.randint(0, 3))}
        return [make(depth - 1) for _ in range(rng.randint(0, 3))]

    docs = [json.dumps(make(4)) for _ in range(120)]
    steps = [".a", ".b", ".*", "[*]", "[0]", "[1]", ' ? (@.a == "x")', " ? (@ > 1)", " ? (exists(@.b))", ".cc"]
    asked = ["$" + "".join(rng.choices(steps, k=rng.randint(1, 4))) for _ in range(25)]
    check(spark, docs, asked)


@pytest.mark.parametrize(
    "text",
    ["", "a", "$.", "$..a", "$.**", "$[a]", "$[1 to 2]", "$[-1]", "$.a.size()", '$ ? (@.a like_regex "x")', "$ ? (@.a == 1 || @.b == 2)",
     "strict $.a", "$.a + 1", "$.*#x", "$ ? (@.a)", "$ ? (@.a == )", "$.a b", "$ ? (@.a == @.b)"],
)
def test_unsupported_syntax_is_named(text):
    with pytest.raises(paths.PathError, match="not supported"):
        paths.compile_path(text)
