import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.checks import ConstraintError
from tidemark.plans import versions_store
from tidemark.plans.collections import HotPath, find, read_collection, store_collection
from tidemark.plans.snapshots import PublishConflict, Snapshot, create_marker, materialize
from tidemark.session import scratch_path


def test_refresh_keeps_old_readers(spark):
    view = materialize(spark.range(3), scratch_path(spark, "t"), key=["id"])
    before = view.read()
    assert view.refresh(spark.range(5), key=["id"]) == 2
    assert (before.count(), view.read().count(), view.read(1).count()) == (3, 5, 3)


def test_refresh_can_read_what_it_replaces(spark):
    view = materialize(spark.range(3), scratch_path(spark, "t"), key=["id"])
    view.refresh(view.read().unionByName(spark.range(10, 12)), key=["id"])
    assert view.read().count() == 5


def test_a_duplicate_key_is_not_published(spark):
    view = materialize(spark.range(3), scratch_path(spark, "t"), key=["id"])
    with pytest.raises(ConstraintError):
        view.refresh(spark.range(3).union(spark.range(1)), key=["id"])
    assert (view.version(), view.read().count()) == (1, 3)
    with pytest.raises(ValueError):
        view.refresh(spark.range(3))


def test_only_one_writer_publishes_a_version(spark):
    path = scratch_path(spark, "t")
    view = materialize(spark.range(3), path, key=["id"])
    create_marker(spark, f"{path}/published/0000000002", "other")
    with pytest.raises(PublishConflict):
        create_marker(spark, f"{path}/published/0000000002", "mine")
    assert view.version() == 2


def test_a_change_made_from_an_old_version_is_refused(spark):
    view = materialize(spark.range(3), scratch_path(spark, "t"), key=["id"])
    view.refresh(spark.range(4), key=["id"], base=1)
    with pytest.raises(PublishConflict):
        view.refresh(spark.range(5), key=["id"], base=1)
    assert view.read().count() == 4


def test_nothing_published(spark):
    with pytest.raises(LookupError):
        Snapshot(spark, scratch_path(spark, "none")).read()


def versions(spark, *rows):
    df = spark.createDataFrame(rows, "id long, valid_from string, valid_to string, v string")
    return df.withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz")).withColumn(
        "valid_to", F.col("valid_to").cast("timestamp_ntz")
    )


END = "9999-12-31 23:59:59.999999"


def test_year_folders(spark):
    path = scratch_path(spark, "versions")
    first = versions(
        spark, (1, "1998-01-05", "1999-02-01", "a"), (1, "1999-02-01", END, "b"), (2, "1997-03-03", END, "c")
    )
    versions_store.write_versions(first, path)
    old = versions_store.read_versions(spark, path)
    # Only 1999 changes, and 2001 is new.
    second = versions(spark, (1, "1999-02-01", "2001-05-05", "b"), (1, "2001-05-05", END, "d"))
    assert sorted(versions_store.touched_years(second)) == [1999, 2001]
    versions_store.write_versions(second, path, years=[1999, 2001])
    now = versions_store.read_versions(spark, path)
    assert sorted((r.id, r.v, r.part_year) for r in now.collect()) == [
        (1, "a", 1998),
        (1, "b", 1999),
        (1, "d", 2001),
        (2, "c", 1997),
    ]
    assert old.count() == 3 and versions_store.read_versions(spark, path, version=1).count() == 3
    # A year that became empty disappears.
    versions_store.write_versions(second.filter("v = 'd'"), path, years=[1999, 2001])
    assert sorted(r.v for r in versions_store.read_versions(spark, path).collect()) == ["a", "c", "d"]


def test_as_of_opens_only_earlier_years(spark):
    path = scratch_path(spark, "versions")
    versions_store.write_versions(
        versions(spark, (1, "1998-01-05", "1999-02-01", "a"), (1, "1999-02-01", END, "b")), path
    )
    past = versions_store.read_as_of(spark, path, "1998-06-01")
    assert [r.v for r in past.collect()] == ["a"]
    plan = past._jdf.queryExecution().executedPlan().toString()
    assert "part_year" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "PushedFilters: [IsNotNull(valid_from)" in plan


def test_registry(spark):
    df = versions(spark, (1, "1998-01-05", END, "a"), (2, "1998-11-05", END, "a"), (3, "2000-01-01", END, "a"))
    assert sorted(map(tuple, versions_store.partition_registry(df).collect())) == [
        (1998, dt.datetime(1998, 1, 1), dt.datetime(1999, 1, 1)),
        (2000, dt.datetime(2000, 1, 1), dt.datetime(2001, 1, 1)),
    ]


HOT = [HotPath("category", "string", ("p", "c")), HotPath("n", "bigint", ("n",))]


def test_stored_collection(spark):
    texts = ['{"p": {"c": "x"}, "n": 1}', '{"p": {"c": "y"}, "n": 1.0}', '{"p": {"c": 5}, "n": "1"}', '{"q": 1}', "[1]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", F.parse_json("t").alias("doc")
    )
    path = scratch_path(spark, "collection")
    store_collection(df, path, "doc", HOT, spread="i")
    stored = read_collection(spark, path)

    def ids(literal):
        return sorted(r.i for r in find(stored, "doc", literal, HOT).collect())

    assert ids({"p": {"c": "x"}}) == [0]
    assert ids({"p": {"c": "5"}}) == []
    assert ids({"p": {"c": 5}}) == [2]
    assert ids({"n": 1}) == [0, 1]
    assert ids({"n": 1.0}) == [0, 1]
    assert ids({}) == [0, 1, 2, 3]
    plan = find(stored, "doc", {"p": {"c": "x"}}, HOT)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(category,x)" in plan


def test_version_table_changes_only_touched_years(spark):
    table = versions_store.VersionTable(spark, scratch_path(spark, "history"))
    rows = versions(
        spark, (1, "1998-01-05", "1999-02-01", "a"), (1, "1999-02-01", END, "b"), (2, "1997-03-03", END, "c")
    ).withColumn("deleted", F.lit(False))
    keys = rows.groupBy("id").agg(F.min("valid_from").alias("created"))
    table.create(rows, keys)
    batch = spark.createDataFrame([(1, "update", "B"), (None, "insert", "n")], "id long, op string, v string")
    assert table.apply(batch, "2001-05-05 00:00:00", ["v"]) == 2
    first, second = (versions_store._manifest(spark, table.path, n)["years"] for n in (1, 2))
    assert first["1997"] == second["1997"] and first["1998"] == second["1998"]
    assert first["1999"] != second["1999"] and set(second) == {"1997", "1998", "1999", "2001"}
    view = table.current().select("id", "rec_version", "v")
    assert sorted(map(tuple, view.collect())) == [(1, 3, "B"), (2, 1, "c"), (3, 1, "n")]
    assert table.keys().count() == 3
    with pytest.raises(ConstraintError):
        table.apply(spark.createDataFrame([(1, "update", "C")], "id long, op string, v string"), "2000-01-01 00:00:00", ["v"])


def files_of(path, part):
    import glob

    found = glob.glob(f"{path.removeprefix('file:')}/data/snap=*/part_year=*/part_close=*/*.parquet")
    return sorted(f for f in found if ("part_close=9999" in f) == (part == "open"))


def test_a_batch_leaves_closed_files_and_other_years_alone(spark):
    table = versions_store.VersionTable(spark, scratch_path(spark, "history"))
    rows = versions(
        spark, *[(i, f"{1990 + i % 9}-03-01", f"{1991 + i % 9}-02-01", "a") for i in range(40)],
        *[(i, f"{1991 + i % 9}-02-01", END, "b") for i in range(40)],
    ).withColumn("deleted", F.lit(False))
    table.create(rows, rows.groupBy("id").agg(F.min("valid_from").alias("created")))
    closed, opened = files_of(table.path, "closed"), files_of(table.path, "open")
    table.apply(spark.createDataFrame([(3, "update", "c")], "id long, op string, v string"), "2001-05-05 00:00:00", ["v"])
    now = files_of(table.path, "closed")
    # One closed row is new, nothing else; open rows of two years were written.
    assert set(closed) < set(now) and len(now) == len(closed) + 1
    written_open = set(files_of(table.path, "open")) - set(opened)
    assert {f.split("part_year=")[1][:4] for f in written_open} <= {"1994", "2001"}
    open_plan = table.current()._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in open_plan and open_plan.count("FileScan") == 2
    read = {f.rsplit("/data/", 1)[1] for f in versions_store.read_open(spark, table.path).inputFiles()}
    assert read and all("part_close=9999" in f for f in read)
    past = {f.rsplit("/data/", 1)[1] for f in versions_store.read_as_of(spark, table.path, "1994-06-01").inputFiles()}
    years = [tuple(int(f.split(f"{p}=")[1][:4]) for p in ("part_year", "part_close")) for f in past]
    assert years and all(a <= 1994 <= b for a, b in years) and len(past) < len(read) + len(now)
    created = {r.id: r.created.year for r in table.as_of("1994-06-01").collect()}
    assert created == {i: 1990 + i % 9 for i in range(40) if 1990 + i % 9 <= 1994}


def test_stored_numbers_are_those_of_a_window(spark):
    """Random batches: numbers, history and the current view are those of the plain operators; compacting changes nothing."""
    import random

    from tidemark.plans import temporal

    rng = random.Random(6)
    table = versions_store.VersionTable(spark, scratch_path(spark, "history"))
    rows = versions(spark, (1, "1998-01-05", END, "a"), (2, "1999-03-03", END, "b")).withColumn("deleted", F.lit(False))
    keys = rows.groupBy("id").agg(F.min("valid_from").alias("created"))
    table.create(rows, keys)
    held = rows.collect()
    plain, known = spark.createDataFrame(held, rows.schema), spark.createDataFrame(keys.collect(), keys.schema)
    for step in range(4):
        n = known.count()
        ids = rng.sample(range(1, n + 1), rng.randint(1, n))
        dead = {r.id for r in plain.filter("deleted").collect()}
        batch = [(i, rng.choice(["update", "update", "delete"]), f"s{step}") for i in ids if i not in dead]
        batch += [(None, "insert", f"n{step}{k}") for k in range(2)]
        changes = spark.createDataFrame(batch, "id long, op string, v string")
        ts = f"{2000 + step}-01-01 00:00:00"
        table.apply(changes, ts, ["v"])
        known, plain = temporal.apply_changes(known, plain, changes, ts, ["v"])
        known, plain = spark.createDataFrame(known.collect(), known.schema), spark.createDataFrame(plain.collect(), plain.schema)
    columns = ["id", "valid_from", "valid_to", "v", "deleted", "rec_version"]
    seen = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert seen(table.versions(numbers=True)) == seen(temporal.numbered(plain))
    views = [sorted(map(str, v.collect())) for v in (table.current(), temporal.current(plain, known))]
    assert views[0] == views[1]
    assert table.compact(most=1) == 6 and table.compact(most=1) is None
    assert seen(table.versions(numbers=True)) == seen(temporal.numbered(plain)) and table.keys().count() == known.count()


def test_an_empty_marker_is_not_a_version(spark):
    path = scratch_path(spark, "t")
    view = materialize(spark.range(3), path, key=["id"])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/published/0000000002")
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop).close()
    assert (view.version(), view.read().count()) == (1, 3)
    assert view.refresh(spark.range(5), key=["id"]) == 2
    assert view.read().count() == 5
