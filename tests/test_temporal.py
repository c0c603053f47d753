import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.checks import ConstraintError, overlap_violations
from tidemark.plans import temporal

END = dt.datetime(9999, 12, 31, 23, 59, 59, 999999)
SCHEMA = "id long, valid_from timestamp_ntz, valid_to timestamp_ntz, v string, deleted boolean"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, op string, v string")


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def state(spark):
    return table(
        spark,
        (1, day(0), day(5), "a", False),
        (1, day(5), END, "b", False),
        (2, day(1), day(3), "c", False),
        (2, day(3), END, "c", True),
        (3, day(2), END, "d", False),
    )


@pytest.fixture
def keys(spark):
    return spark.createDataFrame([(1, day(0)), (2, day(1)), (3, day(2))], "id long, created timestamp_ntz")


def test_update_touches_only_the_open_version(spark, state):
    batch = changes(spark, (1, "x", "B"), (2, "x", "C"), (9, "x", "Z")).drop("op")
    assert found(temporal.update_versions(state, batch, day(10))) == [
        (1, day(0), day(5), "a", False),
        (1, day(5), day(10), "b", False),
        (1, day(10), END, "B", False),
        (2, day(1), day(3), "c", False),
        (2, day(3), END, "c", True),
        (3, day(2), END, "d", False),
    ]


def test_delete_leaves_a_tombstone(spark, state, keys):
    after = temporal.delete_versions(state, spark.createDataFrame([(3,)], "id long"), day(10))
    assert found(after.filter("id = 3")) == [(3, day(2), day(10), "d", False), (3, day(10), END, "d", True)]
    assert found(temporal.current(after, keys).select("id", "rec_version", "v")) == [(1, 2, "b")]
    assert after.filter("id <> 3").count() == 4


def test_errors_come_before_any_change(spark, state):
    ids = spark.createDataFrame([(2,)], "id long")
    with pytest.raises(ConstraintError, match="already deleted"):
        temporal.delete_versions(state, ids, day(10))
    with pytest.raises(ConstraintError, match="not after"):
        temporal.update_versions(state, changes(spark, (1, "x", "B")).drop("op"), day(5))
    with pytest.raises(ConstraintError, match="more than one"):
        temporal.update_versions(state, changes(spark, (1, "x", "B"), (1, "x", "C")).drop("op"), day(9))
    moved = spark.createDataFrame([(1, 4, "B")], "id long, new_id long, v string")
    with pytest.raises(ConstraintError, match="cannot be changed"):
        temporal.update_versions(state, moved, day(9))
    with pytest.raises(ConstraintError, match="unknown operation"):
        temporal.check_changes(state, changes(spark, (1, "merge", "B")), F.lit(day(9)))


def test_insert_assigns_the_next_keys(spark, state, keys):
    rows = spark.createDataFrame([("y",), ("x",)], "v string")
    new_keys, versions = temporal.insert_versions(keys, state, rows, day(10), ["v"])
    assert found(new_keys) == [(4, day(10)), (5, day(10))]
    assert found(versions) == [(4, day(10), END, "x", False), (5, day(10), END, "y", False)]


def test_one_batch_of_all_kinds(spark, state, keys):
    batch = changes(spark, (1, "update", "B"), (3, "delete", None), (None, "insert", "n"))
    new_keys, after = temporal.apply_changes(keys, state, batch, day(10), ["v"])
    view = temporal.current(after, new_keys)
    assert found(view.select("id", "rec_version", "v", "created")) == [(1, 3, "B", day(0)), (4, 1, "n", day(10))]


def test_views(spark, state, keys):
    assert [tuple(r) for r in temporal.history(state, [1], descending=True).select("v", "rec_version").collect()] == [
        ("b", 2),
        ("a", 1),
    ]
    past = temporal.as_of(state, day(4)).select("id", "v", "deleted", "rec_version")
    assert found(past) == [(1, "a", False, 1), (2, "c", True, 1), (3, "d", False, 1)]
    assert found(temporal.as_of(state, day(5)).filter("id = 1").select("v")) == [("b",)]
    stats = temporal.statistics(state, keys).first().asDict()
    assert stats == {
        "recordcount": 9,
        "min_id": 1,
        "max_id": 3,
        "min_version": 1,
        "max_version": 2,
        "deleted_records": 2,
        "version_rows": 5,
    }


def test_simple_ranges(spark):
    state = table(spark, (1, day(0), day(5), "a", False), (1, day(5), END, "b", False)).drop("deleted")
    batch = changes(spark, (1, "x", "B"), (7, "x", "Z")).drop("op")
    assert found(temporal.range_update(state, batch, day(8)))[1:] == [(1, day(5), day(8), "b"), (1, day(8), END, "B")]
    gone = temporal.range_delete(state, spark.createDataFrame([(1,), (7,)], "id long"), day(8))
    assert found(gone) == [(1, day(0), day(5), "a"), (1, day(5), day(8), "b")]
    assert temporal.range_current(gone, day(8)).count() == 0
    fresh = spark.createDataFrame([(1, "again")], "id long, v string")
    assert found(temporal.range_insert(gone, fresh, day(9)))[-1] == (1, day(9), END, "again")
    with pytest.raises(ConstraintError, match="overlap"):
        temporal.range_insert(state, fresh, day(9))


def test_random_batches_keep_the_history_sound(spark, keys):
    draw = random.Random(3)
    state = table(spark, *[(i, day(0), END, f"v{i}", False) for i in range(1, 8)])
    known = spark.createDataFrame([(i, day(0)) for i in range(1, 8)], "id long, created timestamp_ntz")
    model = {i: [(day(0), f"v{i}", False)] for i in range(1, 8)}
    for step in range(1, 5):
        batch = []
        for i in sorted(draw.sample(range(1, 10), 5)):
            deleted = i in model and model[i][-1][2]
            op = draw.choice(["update", "delete"])
            if op == "delete" and deleted:
                continue
            batch.append((i, op, f"w{step}-{i}"))
            if i in model and not deleted:
                value = f"w{step}-{i}" if op == "update" else model[i][-1][1]
                model[i].append((day(step), value, op == "delete"))
        known, state = temporal.apply_changes(known, state, changes(spark, *batch), day(step), ["v"])
        state = spark.createDataFrame(state.collect(), SCHEMA)
    expected = []
    for i, rows in model.items():
        ends = [r[0] for r in rows[1:]] + [END]
        expected += [(i, start, end, v, gone) for (start, v, gone), end in zip(rows, ends)]
    assert found(state) == sorted(expected)
    assert overlap_violations(state, "id", "valid_from", "valid_to").count() == 0


def test_history_is_not_shuffled_by_a_change(spark, state):
    """Closed versions reach the result without an exchange."""
    batch = changes(spark, (1, "update", "B"))
    df = temporal._replace_open(state, batch, F.lit(day(10)), tombstones=True)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    union, left = plan.split("\n")[:2]
    assert union.startswith("Union") and "Join" not in left
