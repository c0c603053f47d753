import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes
from tidemark.operators.checks import (
    ConstraintError,
    assert_unique,
    foreign_key_violations,
    null_violations,
    unique_violations,
)
from tidemark.operators.distinct import first_per_key


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_update_and_revert(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    changed = changes.update_rows(df, F.col("v") == "a", {"v": F.upper("v")})
    assert rows(changed) == [(1, "A"), (2, "b"), (3, None)]
    assert rows(changes.update_rows(changed, F.col("v") == "A", {"v": F.lower("v")})) == rows(df)


def test_update_from(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    other = spark.createDataFrame([(1, "new"), (3, None), (9, "no")], "id int, w string")
    assert rows(changes.update_from(df, other, "id", {"v": "w"})) == [(1, "new"), (2, "b"), (3, None)]
    kept = changes.update_from(df, other, "id", {"v": "w"}, where=F.col("v") == "a")
    assert rows(kept) == [(1, "new"), (2, "b"), (3, "c")]


def test_update_from_refuses_two_partners(spark):
    df = spark.createDataFrame([(1, "a"), (None, "n")], "id int, v string")
    other = spark.createDataFrame([(1, "x"), (1, "y"), (None, "p"), (None, "q")], "id int, w string")
    with pytest.raises(Exception, match="several new rows"):
        changes.update_from(df, other, "id", {"v": "w"}).collect()
    assert rows(changes.update_from(df, other.filter("w <> 'y'"), "id", {"v": "w"})) == [(1, "x"), (None, "n")]


def test_delete_keeps_rows_with_unknown_condition(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    assert rows(changes.delete_rows(df, F.col("v") == "a")) == [(2, None)]


def test_next_ids(spark):
    held = spark.createDataFrame([(7, "x")], "id long, v string")
    new = spark.createDataFrame([("c",), ("a",), ("b",)], "v string")
    grown = changes.append_rows(held, changes.with_next_ids(new, held, "id", ["v"]))
    assert rows(grown) == [(10, "c"), (7, "x"), (8, "a"), (9, "b")]
    assert rows(changes.with_next_ids(new, held.filter("id < 0"), "id", ["v"]).select("id")) == [(1,), (2,), (3,)]


def test_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "id int, v string")
    assert rows(unique_violations(df, ["id", "v"])) == [(1, "a", 2)]
    assert rows(unique_violations(df, ["id", "v"], nulls_equal=True)) == [(1, "a", 2), (2, None, 2)]
    with pytest.raises(ConstraintError):
        assert_unique(df, ["id"])
    assert_unique(df.filter("id = 3"), ["id"])


def test_foreign_keys_and_nulls(spark):
    child = spark.createDataFrame([(1,), (5,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert rows(foreign_key_violations(child, parent, ["fk"], ["pk"])) == [(5,)]
    assert rows(null_violations(child, ["fk"])) == [("fk", 1)]


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (None, 3, "c"), (2, 9, None)], "k int, o int, v string")
    assert rows(first_per_key(df, ["k"], ["o"])) == [(1, 1, "a"), (2, 9, None), (None, 3, "c")]
    assert rows(first_per_key(df, ["k"], ["o"], last=True)) == [(1, 2, "b"), (2, 9, None), (None, 3, "c")]


def test_nulls_come_last_in_order(spark):
    df = spark.createDataFrame([(1, None, "none"), (1, 5, "five")], "k int, o int, v string")
    assert rows(first_per_key(df, ["k"], ["o"])) == [(1, 5, "five")]
    assert rows(first_per_key(df, ["k"], ["o"], last=True)) == [(1, None, "none")]


def test_unique_rule_over_a_member(spark, tmp_path):
    from tidemark.functions import variants
    from tidemark.plans.snapshots import Snapshot

    docs = spark.createDataFrame([('{"a": {"id": 2}}',), ('{"a": {"id": 3}}',), ('{"a": {}}',), ('{"a": {}}',), ("[]",)], "t string")
    docs = docs.select(F.parse_json("t").alias("doc"))
    key = [variants.get_as(F.col("doc"), "long", "a", "id").alias("actor")]
    assert_unique(docs, key)
    view = Snapshot(spark, str(tmp_path / "v"))
    view.refresh(docs, key)
    again = docs.union(spark.createDataFrame([('{"a": {"id": 2}, "b": 1}',)], "t string").select(F.parse_json("t")))
    assert rows(unique_violations(again, key)) == [(2, 2)]
    with pytest.raises(ConstraintError, match="actor"):
        view.refresh(again, key)
    assert view.read().count() == 5
