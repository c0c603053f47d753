"""Variants: navigation, containment, editing."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import editing, variants
from tidemark.functions.containment import contains
from tidemark.queries import reviews


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select(
        "i", F.parse_json("text").alias("doc")
    )


def values(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_paths_of_missing_and_null_members(spark):
    df = docs(spark, '{"a": {"b": [1, {"c": "x"}]}, "n": null}', "[1, 2]", '"text"')
    doc = F.col("doc")
    assert values(df, variants.get_text(doc, "a", "b", 1, "c")) == ["x", None, None]
    assert values(df, F.to_json(variants.get(doc, "a", "b"))) == ['[1,{"c":"x"}]', None, None]
    assert values(df, variants.exists(doc, "n")) == [True, False, False]
    assert values(df, variants.exists(doc, "missing")) == [False, False, False]
    assert values(df, variants.get_text(doc, "n")) == [None, None, None]


def test_typed_reads_raise_or_not(spark):
    df = docs(spark, '{"k": "word"}')
    assert values(df, variants.get_as(F.col("doc"), "int", "k", safe=True)) == [None]
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        values(df, variants.get_as(F.col("doc"), "int", "k"))


def test_odd_keys(spark):
    df = docs(spark, '{"track_id, ": 1, "content:encoded": 2}')
    assert values(df, variants.get_text(F.col("doc"), "track_id, ")) == ["1"]
    assert values(df, variants.get_text(F.col("doc"), "content:encoded")) == ["2"]


def test_unnesting(spark):
    df = docs(spark, '{"xs": [1, "two", null]}', '{"xs": []}', "{}", '{"xs": 5}')
    rows = variants.unnest(df, "doc", "xs", out="x").select("i", variants.get_text(F.col("x")))
    assert [tuple(r) for r in rows.collect()] == [(0, "1"), (0, "two"), (0, None)]


def test_each_and_recordset(spark):
    df = docs(spark, '{"b": 1, "a": {"z": 2}}', "[]")
    rows = variants.each(df, "doc").select("key", "value").collect()
    assert sorted(map(tuple, rows)) == [("a", '{"z":2}'), ("b", "1")]
    df = docs(spark, '[{"id": 1, "name": "x", "more": true}, {"id": 2, "nested": {"q": 1}}]')
    rows = variants.recordset(df, "doc", "id int, name string, nested variant").select("id", "name", F.to_json("nested"))
    assert [tuple(r) for r in rows.collect()] == [(1, "x", None), (2, None, '{"q":1}')]


def test_member_order_is_by_length_then_key(spark):
    df = docs(spark, '{"bb": 1, "a": 2, "ab": 3}', "{}", "7")
    rendered = F.transform(variants.member_values(F.col("doc")), lambda v: F.to_json(v))
    assert values(df, rendered) == [["2", "3", "1"], [], None]
    assert values(df, variants.first_member(F.col("doc"))["key"]) == ["a", None, None]


def test_rows_keep_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(variants.row_json("a", "b")).first()[0] == '{"a":1,"b":null}'
    assert df.select(variants.anonymous_row_json(F.col("a"), F.col("b"))).first()[0] == '{"f1":1,"f2":null}'
    assert json.loads(df.select(F.to_json(variants.from_row("a", "b"))).first()[0]) == {"a": 1, "b": None}
    assert df.select(F.to_json(variants.from_text(F.lit("x\"y")))).first()[0] == '"x\\"y"'


def test_pretty_has_lines(spark):
    df = docs(spark, '{"a": 1, "b": "x"}')
    text = df.select(variants.pretty(F.col("doc"), "a int, b string")).first()[0]
    assert "\n" in text and json.loads(text) == {"a": 1, "b": "x"}


CASES = [
    ('{"a": {"b": 1, "c": 2}, "d": 3}', {"a": {"b": 1}}, True),
    ('{"a": {"b": 1}}', {"a": {"b": 1, "c": 2}}, False),
    ('{"a": "5"}', {"a": 5}, False),
    ('{"a": 5}', {"a": "5"}, False),
    ('{"a": 1.0}', {"a": 1}, True),
    ('{"a": 1}', {"a": 1.0}, True),
    ('{"a": 1.5}', {"a": 1}, False),
    ('{"a": null}', {"a": None}, True),
    ("{}", {"a": None}, False),
    ('{"a": true}', {"a": True}, True),
    ('{"a": 1}', {"a": True}, False),
    ('{"a": "true"}', {"a": True}, False),
    ('{"xs": [1, 2, {"k": "v", "w": 1}]}', {"xs": [{"k": "v"}]}, True),
    ('{"xs": [1, 2]}', {"xs": [2, 1, 1]}, True),
    ('{"xs": [1, 2]}', {"xs": [3]}, False),
    ('{"xs": [1, 2]}', {"xs": []}, True),
    ('{"xs": {"a": 1}}', {"xs": []}, False),
    ('{"a": {"b": 1}}', {"a": {}}, True),
    ('{"a": [1]}', {"a": {}}, False),
    ('[1, "x"]', "x", True),
    ('[1, "x"]', ["x"], True),
    ('"x"', ["x"], False),
    ('"x"', "x", True),
    ("[[1, 2], 3]", [[2]], True),
    ("[[1, 2], 3]", [2], False),
    ('{"big": 9007199254740993}', {"big": 9007199254740993}, True),
    ('{"big": 9007199254740993}', {"big": 9007199254740992}, False),
    ('{"a": 1}', {}, True),
]


def test_containment(spark):
    for text, literal, expected in CASES:
        got = docs(spark, text).select(contains(F.col("doc"), literal)).first()[0]
        assert got is expected, (text, literal)
    null = spark.range(1).select(F.lit(None).cast("variant").alias("doc"))
    assert null.select(contains(F.col("doc"), {"a": 1})).first()[0] is None


def model(doc, wanted, top=True):
    """Containment of JSON values, written down directly."""
    if isinstance(wanted, dict):
        return isinstance(doc, dict) and all(k in doc and model(doc[k], v, False) for k, v in wanted.items())
    if isinstance(wanted, list):
        return isinstance(doc, list) and all(any(model(d, w, False) for d in doc) for w in wanted)
    if top and isinstance(doc, list):
        return any(model(d, wanted, False) for d in doc)
    if isinstance(doc, (dict, list)) or isinstance(doc, bool) != isinstance(wanted, bool):
        return False
    return type(doc) is type(wanted) and doc == wanted or (
        isinstance(doc, (int, float)) and isinstance(wanted, (int, float)) and doc == wanted
    )


def random_value(draw, depth):
    kind = draw.choice(["scalar", "scalar", "object", "array"] if depth else ["scalar"])
    if kind == "object":
        return {draw.choice("abc"): random_value(draw, depth - 1) for _ in range(draw.randint(0, 3))}
    if kind == "array":
        return [random_value(draw, depth - 1) for _ in range(draw.randint(0, 3))]
    return draw.choice([1, 2, 1.5, "1", "x", True, False, None])


def test_containment_of_random_documents(spark):
    draw = random.Random(11)
    values_ = [random_value(draw, 3) for _ in range(300)]
    df = docs(spark, *[json.dumps(v) for v in values_])
    wanted = [random_value(draw, 2) for _ in range(25)]
    tests = [contains(F.col("doc"), w).alias(f"w{i}") for i, w in enumerate(wanted)]
    for row in df.select("i", *tests).collect():
        for i, w in enumerate(wanted):
            assert row[f"w{i}"] is model(values_[row.i], w), (values_[row.i], w)


def test_edits(spark):
    df = docs(spark, '{"a": {"b": 1, "c": 2}, "d": "x"}', "[1]", '{"a": 5}')
    doc = F.col("doc")

    def got(column):
        return [json.loads(v) for v in values(df, F.to_json(column))]

    nine = F.lit(9).cast("variant")
    assert got(editing.set_path(doc, ["d"], nine)) == [{"a": {"b": 1, "c": 2}, "d": 9}, [1], {"a": 5, "d": 9}]
    assert got(editing.set_path(doc, ["a", "b"], nine)) == [{"a": {"b": 9, "c": 2}, "d": "x"}, [1], {"a": 5}]
    assert got(editing.delete_key(doc, "a")) == [{"d": "x"}, [1], {}]
    merged = df.filter("i <> 1").select("i", editing.concat(doc, F.parse_json(F.lit('{"a": null, "z": 1}'))).alias("m"))
    assert [json.loads(v) for v in values(merged, F.to_json("m"))] == [{"a": None, "d": "x", "z": 1}, {"a": None, "z": 1}]
    assert values(df, editing.same_text(doc, F.parse_json(F.lit('{"d":"x","a":{"c":2,"b":1}}')))) == [True, False, False]


def test_duplicate_keys_keep_the_last(spark):
    df = docs(spark, '{"k": 1, "k": 2}')
    assert values(df, variants.get_text(F.col("doc"), "k")) == ["2"]


def test_unnest_copies_only_what_is_kept(spark):
    df = spark.sql("""SELECT id AS i, parse_json('{"name": "n", "xs": [1, null, 3]}') AS doc FROM range(2)""")
    rows = variants.unnest(df, "doc", "xs", out="x", keep={"i": F.col("i"), "name": variants.get_text(F.col("doc"), "name")})
    assert rows.columns == ["i", "name", "x"]
    assert rows.count() == 6
    generate = [line for line in rows._jdf.queryExecution().executedPlan().toString().split("\n") if "Generate" in line]
    assert len(generate) == 1 and "doc#" not in generate[0] and "Filter" not in rows._jdf.queryExecution().optimizedPlan().toString().split("Generate")[1]


def test_path_filter_over_root_arrays(spark, monkeypatch):
    click, view = ({"product": {"category": c, "title": c + "!"}} for c in ("click", "view"))
    docs = [click, view, [view, click, 3, click], [], None, "click", [[]]]
    rows = [(k, json.dumps(d)) for k, d in enumerate(docs)] + [(9, None)]
    made = spark.createDataFrame(rows, "event_id bigint, doc string").withColumn("doc", F.parse_json("doc"))
    monkeypatch.setattr(reviews, "collection", lambda t: made)
    found = reviews.json_path_query_filter(spark, "unused").collect()
    assert sorted(tuple(r) for r in found) == [(k, "click", None, "click!") for k in (0, 2, 2)]
