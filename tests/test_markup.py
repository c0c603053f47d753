"""Items out of split files: sections, comments, broken items, block borders."""

import random
import re

import pytest
from pyspark.sql import functions as F
from test_sources import feed, put

from tidemark.sources import feeds, markup

BODY = "<![CDATA[see <item> tags and </item> ends here ]]>"


def plain_items(text):
    """The same by one pass over the whole text."""
    borders, at = [], 0
    tokens = re.compile(r"<!--|<!\[CDATA\[|<item(?=[\s/>])|</item>")
    while m := tokens.search(text, at):
        at = m.end()
        if m[0] in ("<!--", "<![CDATA["):
            closer = "-->" if m[0] == "<!--" else "]]>"
            end = text.find(closer, at)
            at = len(text) if end < 0 else end + 3
        else:
            borders.append((m.start(), at, m[0]))
    out = []
    for i, (start, _, token) in enumerate(borders):
        if token != "<item":
            continue
        if alone := re.match(r"<item(\s[^<>]*)?/>", text[start:]):
            out.append(alone[0])
            continue
        after = borders[i + 1] if i + 1 < len(borders) else None
        out.append(text[start:] if after is None else text[start : after[1]] if after[2] == "</item>" else text[start : after[0]])
    return out


def found(spark, folder):
    return sorted(r.raw for r in markup.elements(markup.read_records(spark, folder, "item"), "item").collect())


def test_sections_and_comments(spark, tmp_path):
    good = f"<item><title>one</title><content:encoded>{BODY}</content:encoded><guid>g1</guid></item>"
    hidden = "<!-- <item><guid>no</guid></item> <![CDATA[ -->"
    bad = "<item><title>broken</titl></item>"
    text = feed(good, hidden, bad, good.replace("g1", "g2"), "<items>x</items>", "<item/>", good.replace("g1", "g3"))
    put(str(tmp_path), "a.xml", text)
    put(str(tmp_path), "b.xml", feed("<item><title>plain</title><guid>g4</guid></item>"))
    rows = {r.guid: r for r in feeds.read_feed(spark, str(tmp_path), encoded=True).collect()}
    assert {"g1", "g2", "g3", "g4"} <= set(rows) and len(rows) == 6
    assert rows["g2"].description == "see <item> tags and </item> ends here"
    raws = [r.raw for r in feeds.rejected_items(spark, str(tmp_path), encoded=True).collect()]
    assert sorted(raws)[0] == bad


def test_a_section_that_never_ends(spark, tmp_path):
    text = feed("<item><guid>g1</guid></item>", "<item><title><![CDATA[open</title></item>", "<item><guid>g2</guid></item>", "<item><guid>g3</guid></item>")
    put(str(tmp_path), "a.xml", text)
    rows = feeds.read_feed(spark, str(tmp_path)).collect()
    assert {"g1", "g2", "g3"} < {r.guid for r in rows} and len(rows) == 4
    assert len(feeds.rejected_items(spark, str(tmp_path)).collect()) == 1


PIECES = ["<item>", "</item>", "<![CDATA[", "]]>", "<!--", "-->", "text ", "<item a='1'>", "<items>", "<b>", "é\n", "<item/>", "<", ">"]


@pytest.mark.parametrize("seed", range(3))
def test_random_files_in_small_blocks(spark, tmp_path, setting, seed):
    """Any mixture of markers, read in blocks of a few hundred bytes: the same as one pass."""
    rng, expected = random.Random(seed), []
    for k in range(4):
        own = [rng.choice(PIECES if k else PIECES[:4] + PIECES[6:8]) for _ in range(400)]
        # Whatever is open is closed at the end, first a comment, then a section.
        text = "".join(own) + "-->" + "]]>" + "-->" + "]]>"
        if k == 1:
            text = "<item>" + text
        put(str(tmp_path), f"{k}.xml", text)
        expected += plain_items(text)
    setting("spark.sql.files.maxPartitionBytes", 300)
    setting("spark.sql.files.openCostInBytes", 0)
    assert found(spark, str(tmp_path)) == sorted(expected)


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, setting):
    items = [f"<item><title>t{i}</title><description><![CDATA[<p>body {i}</p> </item> <item>]]></description><guid>g{i}</guid></item>" for i in range(3000)]
    put(str(tmp_path), "a.xml", feed(*items))
    setting("spark.sql.files.maxPartitionBytes", 40_000)
    setting("spark.sql.files.openCostInBytes", 0)
    lines = spark.read.option("lineSep", "<item").text(str(tmp_path))
    assert lines.select(F.spark_partition_id()).distinct().count() >= 8
    records = markup.read_records(spark, str(tmp_path), "item")
    assert records.groupBy("file", "block").count().count() >= 8
    rows = feeds.read_feed(spark, str(tmp_path)).collect()
    assert len(rows) == 3000 and {r.guid: r.description for r in rows}["g2999"] == "<p>body 2999</p> </item> <item>"


def test_empty_files(spark, tmp_path):
    put(str(tmp_path), "a.xml", "")
    put(str(tmp_path), "b.xml", "<rss></rss>")
    assert feeds.read_feed(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("encoded", [False, True])
def test_any_number_of_feeds_in_one_write(spark, tmp_path, encoded):
    names = ["en", "de", "a/b=c %", "7", "", None]
    rows = [(n, f"t{i}", None, f"<p>{i} & more</p>", None, f"{i}") for i, n in enumerate(names * 3)]
    schema = "source_name string, title string, link string, description string, published timestamp_ntz, guid string"
    items = spark.createDataFrame(rows, schema)
    feeds.land_feeds(items, str(tmp_path / "f"), encoded)
    back = feeds.read_feeds(spark, str(tmp_path / "f"), encoded)
    key = lambda r: str((r.source_name, int(r.guid), r.title, r.description))
    assert sorted(map(key, back.collect())) == sorted(map(key, items.collect()))
    numbered = feeds.number_items(back).collect()
    assert sorted((str(r.source_name), r.rn) for r in numbered) == sorted((str(n), i) for n in names for i in (1, 2, 3))
