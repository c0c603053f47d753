import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.nesting import nest, table_as_json
from tidemark.plans.documents import Level, three_levels


@pytest.mark.parametrize("limit", [10, 1000])
def test_nothing_is_lost(spark, setting, limit):
    setting("tidemark.partRows", limit)
    setting("tidemark.hotGroupRows", 25)
    n = F.col("id")
    df = spark.range(300).select(F.when(n % 3 == 0, 1).otherwise(n % 40 + 2).alias("k"), (300 - n).alias("v"))
    rows = nest(df, ["k"], F.col("v"), "vs").collect()
    assert max(len(r.vs) for r in rows) <= limit
    parts = {}
    for row in sorted(rows, key=lambda r: (r.k, r.part_no)):
        parts.setdefault(row.k, []).extend(row.vs)
    expected = {}
    for row in df.collect():
        expected.setdefault(row.k, []).append(row.v)
    assert parts == {k: sorted(v) for k, v in expected.items()}


def test_null_elements_are_kept(spark):
    df = spark.createDataFrame([(1, None), (1, 3), (1, None)], "k int, v int")
    assert nest(df, ["k"], F.col("v"), "vs").first().vs == [None, None, 3]


@pytest.mark.parametrize("limit", [7, 10_000])
def test_three_levels_in_parts(spark, setting, limit):
    setting("tidemark.partRows", limit)
    artists = spark.createDataFrame([(1, "one"), (2, "two"), (3, "none")], "a int, name string")
    albums = spark.createDataFrame([(10, 1), (11, 1), (20, 2), (99, 3)], "b int, a_fk int")
    tracks = [(10, i) for i in range(30)] + [(11, i) for i in range(5)] + [(20, i) for i in range(3)] + [(55, 0)]
    tracks = spark.createDataFrame(tracks, "b_fk int, t int")
    docs = three_levels(
        Level(artists, "a", {"id": "a", "name": "name"}),
        Level(albums, "b", {"album": "b"}, "a_fk"),
        Level(tracks, None, {"track": "t"}, "b_fk"),
        inner="albums",
        leaves="tracks",
    ).collect()
    flat = sorted((d.a, al.album, tr.track) for d in docs for al in d.document.albums for tr in al.tracks)
    assert flat == sorted([(1, 10, i) for i in range(30)] + [(1, 11, i) for i in range(5)] + [(2, 20, i) for i in range(3)])
    if limit == 7:
        assert max(sum(len(al.tracks) for al in d.document.albums) for d in docs) <= 2 * limit
    else:
        assert len(docs) == 2


def test_table_as_json_in_parts(spark, setting):
    setting("tidemark.partRows", 4)
    df = spark.createDataFrame([(i, None if i == 2 else f"n{i}") for i in range(10)], "i int, n string")
    parts = sorted(table_as_json(df, ["i"]).collect())
    assert [p.part_no for p in parts] == [0, 1, 2]
    rows = [row for p in parts for row in json.loads(p.json)]
    assert rows == [{"i": i, "n": None if i == 2 else f"n{i}"} for i in range(10)]
