import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions import editing, variants
from tidemark.plans.documents import apply_document_edits
from tidemark.plans.snapshots import Snapshot
from tidemark.session import scratch_path
from tidemark.sources import external, feeds, jsonlines, workload
from tidemark.streaming.refresh import RefreshJob


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write(text)


def item(**fields):
    return "<item>" + "".join(f"<{k}>{v}</{k}>" for k, v in fields.items()) + "</item>"


def feed(*items):
    head = '<?xml version="1.0" encoding="UTF-8"?><rss xmlns:content="http://purl.org/rss/1.0/modules/content/" version="2.0">'
    return head + "<channel><title>feed</title>" + "".join(items) + "</channel></rss>"


def test_bound_columns_are_checked(spark):
    path = scratch_path(spark, "ext")
    spark.range(3).selectExpr("id", "cast(id as string) as name", "id as extra").write.parquet(path + "/t")
    source = external.Source("src", "parquet", path + "/{table}")
    assert external.read_table(spark, source, "t", "name string, id bigint").columns == ["name", "id"]
    with pytest.raises(external.SchemaMismatch, match="no column"):
        external.read_table(spark, source, "t", "id bigint, missing int")
    with pytest.raises(external.SchemaMismatch, match="declared int"):
        external.read_table(spark, source, "t", "id int")
    imported = external.import_tables(spark, source, {"t": "id bigint"}, ["t"], into="ns")
    assert spark.table("ns__t").count() == imported["t"].count() == 3
    external.write_table(spark.range(3, 4).selectExpr("id", "'x' as name", "id as extra"), source, "t")
    assert external.read_table(spark, source, "t", "id bigint").count() == 4


def test_jdbc_options_ask_for_a_parallel_read():
    from pyspark.sql import types as T

    source = external.Source("shop", "jdbc", "jdbc:somedb://host/db", {"user": "u", "driver": "some.Driver"})
    schema = T.StructType().add("Id", T.LongType()).add("Name", T.StringType())
    options = external.jdbc_options(source, "Artist", schema, external.Split("Id", "1", "1000", 16))
    assert options["customSchema"] == "`Id` bigint, `Name` string"
    assert (options["partitionColumn"], options["numPartitions"], options["dbtable"]) == ("Id", "16", "Artist")
    assert options["url"] == "jdbc:somedb://host/db" and options["user"] == "u"


def test_csv(spark, tmp_path):
    put(str(tmp_path), "g.csv", "GenreId,Name\n1,Rock\n2,\"Alternative, Punk\"\n3,\n")
    rows = external.read_csv(spark, str(tmp_path), "GenreId int, Name string").collect()
    assert sorted(map(tuple, rows)) == [(1, "Rock"), (2, "Alternative, Punk"), (3, None)]
    with pytest.raises(Exception):
        external.read_csv(spark, str(tmp_path), "Id int, Name string").collect()


def test_json_lines(spark, tmp_path):
    lines = [
        '{"a": {"b": 1}}', '{"a": null}', '{"z": 1}', '{"k": 1, "k": 2}', "{broken", "[1, 2]", '{"q": "a \\" b"}', '{"ü": "ß"}', "",
    ]
    put(str(tmp_path), "d.json", "\n".join(lines) + "\n")
    docs = jsonlines.load_json(spark, str(tmp_path), "permissive")
    got = sorted(r[0] for r in docs.select(F.to_json("doc")).collect())
    assert got == sorted(['{"a":{"b":1}}', '{"a":null}', '{"z":1}', '{"k":2}', "[1,2]", '{"q":"a \\" b"}', '{"ü":"ß"}'])
    assert [r.line for r in jsonlines.rejected_json(spark, str(tmp_path)).collect()] == ["{broken"]
    with pytest.raises(Exception, match="MALFORMED"):
        jsonlines.load_json(spark, str(tmp_path)).collect()


def test_feed_dates_and_bodies(spark, tmp_path):
    put(
        str(tmp_path / "plain"),
        "a.xml",
        feed(
            item(title="one", link="http://x/1", description="&lt;b&gt;hi&lt;/b&gt;", pubDate="Wed, 02 Oct 2024 15:00:00 +0200", guid="g1"),
            item(title="two", link="http://x/2", description="d", pubDate="3 Oct 2024 01:02:03 GMT"),
            item(title="three", description="no date, no link"),
        ),
    )
    rows = {r.title: r for r in feeds.read_feed(spark, str(tmp_path / "plain")).collect()}
    assert rows["one"].published == dt.datetime(2024, 10, 2, 13) and rows["one"].description == "<b>hi</b>"
    assert rows["two"].published == dt.datetime(2024, 10, 3, 1, 2, 3) and rows["two"].guid == "http://x/2"
    assert rows["three"].published is None and len(rows["three"].guid) == 64
    body = "<item><title>t</title><content:encoded><![CDATA[<p>body</p>]]></content:encoded><guid>g</guid></item>"
    put(str(tmp_path / "enc"), "b.xml", feed(body))
    row = feeds.read_feed(spark, str(tmp_path / "enc"), encoded=True).first()
    assert (row.description, row.guid) == ("<p>body</p>", "g")


def test_workload_is_repeatable(spark):
    rows = workload.insert_rows(spark, 50).collect()
    assert len(rows) == 50 and all(len(r.text) == 25 for r in rows)
    draws = workload.update_draws(spark, 500, 20)
    ids = {r.id for r in draws.collect()}
    assert ids <= set(range(1, 21)) and len(ids) == 20
    assert draws.collect() == workload.update_draws(spark, 500, 20).collect()


def test_refresh_job_restarts_without_repeating(spark, tmp_path):
    landing = str(tmp_path / "feed")
    job = RefreshJob(
        spark, landing, Snapshot(spark, str(tmp_path / "snap")), str(tmp_path / "log"), str(tmp_path / "check")
    )
    put(landing, "a.xml", feed(
        item(title="old", guid="g1", pubDate="Wed, 02 Oct 2024 10:00:00 +0000"),
        item(title="same", guid="g2", pubDate="Wed, 02 Oct 2024 10:00:00 +0000"),
        item(title="undated", guid="g3"),
    ))
    job.start(interval=None).awaitTermination()
    put(landing, "b.xml", feed(
        item(title="new", guid="g1", pubDate="Wed, 02 Oct 2024 11:00:00 +0000"),
        item(title="repeat", guid="g2", pubDate="Wed, 02 Oct 2024 10:00:00 +0000"),
        item(title="dated", guid="g3", pubDate="Wed, 02 Oct 2024 10:00:00 +0000"),
    ))
    job.start(interval=None).awaitTermination()
    job.start(interval=None).awaitTermination()  # nothing new has landed
    assert sorted((r.guid, r.title) for r in job.snapshot.read().collect()) == [
        ("g1", "new"),
        ("g2", "same"),
        ("g3", "dated"),
    ]
    log = job.log_rows().orderBy("log_id").collect()
    assert [r.log_id for r in log] == [0, 1]
    assert all(r.time_stamp_begin <= r.time_stamp_end for r in log)
    # A batch that is run again leaves the same snapshot and one log row.
    again = feeds.read_feed(spark, landing + "/b.xml")
    job._run(again, 1)
    assert job.log_rows().count() == 2 and job.snapshot.read().count() == 3


def test_document_edits_reach_the_base_table(spark):
    long = "n" * 200
    base = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three"), (4, None)], "id long, name string")
    view = base.select(variants.from_row("id", F.col("name").alias("artist")).alias("doc"))
    new = F.when(F.col("id") == 1, "eins").when(F.col("id") == 3, long).when(F.col("id") == 4, "x").otherwise("two")
    after = view.withColumn("id", variants.get_as(F.col("doc"), "long", "id")).select(
        "id", editing.set_path(F.col("doc"), ["artist"], new.cast("variant")).alias("doc")
    )
    done = apply_document_edits(base, view, after, "id", "id", {"name": ("artist", 120)})
    assert sorted(map(tuple, done.collect())) == [(1, "eins"), (2, "two"), (3, "n" * 120), (4, None)]
    # Editing back restores the table.
    view2 = done.select(variants.from_row("id", F.col("name").alias("artist")).alias("doc"))
    back = apply_document_edits(done, view2, base.select("id", view_doc()), "id", "id", {"name": ("artist", 120)})
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, base.collect()))


def view_doc():
    return variants.from_row("id", F.col("name").alias("artist")).alias("doc")


def test_shared_dir_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from tidemark.session import shared_dir

    conf = SimpleNamespace(get=lambda name, default: None)
    fake = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError):
        shared_dir(fake)
    local = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="local[2]", applicationId="local-1"))
    assert shared_dir(local) == shared_dir(local) and os.path.isdir(shared_dir(local))
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda n, d: "hdfs://x/y/"), sparkContext=None)
    assert shared_dir(named) == "hdfs://x/y"


def test_a_running_job_picks_up_files_until_it_is_stopped(spark, tmp_path):
    landing = str(tmp_path / "feed")
    job = RefreshJob(
        spark, landing, Snapshot(spark, str(tmp_path / "snap")), str(tmp_path / "log"), str(tmp_path / "check")
    )
    put(landing, "a.xml", feed(item(title="one", guid="g1")))
    running = job.start(interval="1 second")
    try:
        running.processAllAvailable()
        put(landing, "b.xml", feed(item(title="two", guid="g2")))
        running.processAllAvailable()
    finally:
        running.stop()
    assert sorted(r.guid for r in job.snapshot.read().collect()) == ["g1", "g2"]
    assert not running.isActive and job.log_rows().count() == 2


def test_a_bad_item_loses_no_other(spark, tmp_path):
    import os

    os.makedirs(tmp_path / "f")
    text = (
        "<rss><channel><item><title>one</title><guid>g1</guid><pubDate>Mon, 01 Jan 2024 10:00 EST</pubDate></item>"
        "<item><title>broken</item><item><title>cut off"
        "<item><title>two</title><guid>g2</guid></item><item><title>worse</titl></item>"
        "<item><title>three</title><guid>g3</guid></item></channel></rss>"
    )
    (tmp_path / "f" / "a.xml").write_text(text)
    rows = feeds.read_feed(spark, str(tmp_path / "f")).collect()
    assert {r.guid for r in rows} >= {"g1", "g2", "g3"} and len({r.guid for r in rows}) == len(rows) == 6
    assert str({r.guid: r.published for r in rows}["g1"]) == "2024-01-01 15:00:00"
    assert len(feeds.rejected_items(spark, str(tmp_path / "f")).collect()) == 3
    assert tuple(feeds.undated_items(feeds.read_feed(spark, str(tmp_path / "f"))).first()) == (1, 5)
