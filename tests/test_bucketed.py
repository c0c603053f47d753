"""Snapshots refreshed by differences: what is written, what is read, what goes."""

import glob
import random

import pytest
from pyspark.sql import functions as F
from test_sources import feed, item, put

from tidemark.operators.checks import ConstraintError
from tidemark.plans.bucketed import BucketedSnapshot
from tidemark.plans.snapshots import PublishConflict
from tidemark.session import scratch_path
from tidemark.streaming.refresh import RefreshJob, merge_items


def files(view):
    return set(glob.glob(f"{view.path.removeprefix('file:')}/data/*/*/*.parquet"))


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, at timestamp_ntz")


def test_only_changed_buckets_are_written(spark):
    view = BucketedSnapshot(spark, scratch_path(spark, "b"), ["id"], buckets=16)
    rows = [(i, f"v{i}", None) for i in range(200)]
    assert view.refresh(table(spark, rows)) == 1
    first = files(view)
    assert view.refresh(table(spark, rows[::-1])) == 2 and files(view) == first  # the same rows in another order
    assert view.refresh(table(spark, [*rows[:-1], (199, "new", None)])) == 3
    assert len(files(view) - first) == 1
    assert view.read().filter("id = 199").first().v == "new" and view.read(1).filter("id = 199").first().v == "v199"
    # Rows that go take their buckets with them.
    assert view.refresh(table(spark, rows[:2])) == 4 and view.read().count() == 2
    assert view.refresh(table(spark, [])) == 5 and view.read().collect() == []
    assert view.refresh(table(spark, rows)) == 6 and view.read().count() == 200
    with pytest.raises(ConstraintError):
        view.refresh(table(spark, [*rows, (7, "twice", None)]))
    with pytest.raises(PublishConflict):
        view.refresh(table(spark, rows[:9]), base=3)
    assert view.version() == 6


def test_expired_versions_go_unless_read(spark):
    view = BucketedSnapshot(spark, scratch_path(spark, "b"), ["id"], buckets=4)
    for n in range(1, 6):
        view.refresh(table(spark, [(i, f"{n if i % 4 == 0 else 0}", None) for i in range(40)]))
    with view.reading(2) as old:
        assert view.expire(keep=2) == [1, 3]
        assert {r.v for r in old.collect()} == {"0", "2"}
    assert view.expire(keep=2) == [2]
    assert {r.v for r in view.read(4).collect()} == {"0", "4"} and view.read().count() == 40
    assert len(files(view)) <= 8
    with pytest.raises(Exception):
        view.read(2)


def test_random_merges_are_those_of_a_dictionary(spark):
    rng, held = random.Random(2), {}
    view = BucketedSnapshot(spark, scratch_path(spark, "b"), ["id"], buckets=8)

    def newest(old, new):
        rows = new if old is None else old.join(new.select("id"), "id", "left_anti").unionByName(new)
        return rows

    for step in range(4):
        batch = {rng.choice([None, *range(60)]): f"s{step}" for _ in range(rng.randint(1, 12))}
        batch.pop(None, None)
        held |= batch
        view.merge(table(spark, [(i, v, None) for i, v in batch.items()]), newest)
        assert {r.id: r.v for r in view.read().collect()} == held


def test_a_batch_of_one_item_touches_one_bucket(spark, tmp_path):
    snapshot = BucketedSnapshot(spark, str(tmp_path / "snap"), ["guid"], buckets=256)
    many = spark.range(20_000).select(
        F.lit("t").alias("title"), F.lit(None).cast("string").alias("link"), F.lit("d").alias("description"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("published"), F.concat(F.lit("g"), "id").alias("guid"),
    )
    snapshot.merge(many, merge_items)
    before = files(snapshot)
    job = RefreshJob(spark, str(tmp_path / "feed"), snapshot, str(tmp_path / "log"), str(tmp_path / "check"))
    put(str(tmp_path / "feed"), "a.xml", feed(item(title="news", guid="g77", pubDate="Wed, 02 Oct 2024 10:00:00 +0000")))
    job.start(interval=None).awaitTermination()
    new = files(snapshot) - before
    assert len(new) == 1
    assert spark.read.parquet(*new).count() < 200  # of 20,000: one bucket of 256
    state = sorted(map(str, snapshot.read().collect()))
    assert len(state) == 20_000 and snapshot.read().filter("guid = 'g77'").first().title == "news"
    # The batch once more: the same rows, one log row.
    again = snapshot.read().filter("guid = 'g77'")
    job._run(spark.createDataFrame(again.collect(), again.schema), 0)
    assert sorted(map(str, snapshot.read().collect())) == state and job.log_rows().count() == 1


def test_what_arrives_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(guid):
        seen.add(1)
        return guid

    counted = counted.asNondeterministic()
    view = BucketedSnapshot(spark, scratch_path(spark, "b"), ["guid"], buckets=4)

    def arrive(first, last, day):
        rows = spark.range(first, last).select(
            F.lit(day).alias("title"), F.lit(None).cast("string").alias("link"), F.lit("d").alias("description"),
            F.lit(day).cast("timestamp_ntz").alias("published"), counted(F.concat(F.lit("g"), "id")).alias("guid"),
        )
        before = seen.value
        view.merge(rows, merge_items)
        return seen.value - before

    assert arrive(0, 100, "2024-01-01") == 100
    assert arrive(50, 150, "2024-01-02") == 100
    assert len(files(view)) == 8  # a file a bucket, in each version
    held = {r.guid: r.title for r in view.read().collect()}
    assert held == {f"g{i}": "2024-01-01" if i < 50 else "2024-01-02" for i in range(150)} and "part_bucket" not in view.read().columns
