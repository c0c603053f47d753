"""Elements out of large markup files that Spark splits, safe for tags inside CDATA sections and comments.

Files are read as text that ends a record before every opening tag, so a file of many blocks is read by many tasks and a
record is normally one element. A tag inside a CDATA section or a comment is no border. Whether a record begins inside one depends on
all records before it: every record is a map of three states (outside, in CDATA, in a comment), computed from its text
alone, and the maps are composed in file order: first over ``CHUNK`` records, then over the chunks of a file block, then over the
blocks of a file. Only files in which some record doesn't end outside take that route; in all others records are elements as they are.

A section or comment that never ends in its file ends with its element, so that the elements after it are not lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import written

#: Records whose state maps are composed in one row.
CHUNK = 256

# A state map is three letters: where one gets from outside, from a CDATA section, from a comment.
_SAME = "ock"
_COMPLETE = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
_OPEN = r"<!--|<!\[CDATA\["


def _from_outside(text: Column) -> Column:
    """The state in which text ends that begins outside: what is complete goes, then the first opening decides."""
    opened = F.regexp_extract(F.regexp_replace(text, _COMPLETE, " "), _OPEN, 0)
    state = F.when(opened == "", "o").when(opened == "<!--", "k").otherwise("c")
    return F.when(F.contains(text, F.lit("<!")), state).otherwise("o")


def _after(text: Column, end: str, stays: str) -> Column:
    """The same for text that begins in a section which ``end`` closes."""
    at = F.instr(text, end)
    return F.when(at == 0, stays).otherwise(_from_outside(F.substring(text, at + len(end), F.char_length(text))))


def state_map(text: Column) -> Column:
    """Three letters: the state in which the text ends if it begins outside, in a CDATA section, in a comment."""
    return F.concat(_from_outside(text), _after(text, "]]>", "c"), _after(text, "-->", "k"))


def _composed(maps: Column) -> Column:
    return F.aggregate(maps, F.lit(_SAME), lambda done, one: _through(one, done))


def _through(one: Column, states: Column) -> Column:
    """Each state of ``states`` led through the map ``one``."""
    return F.call_function("translate", states, F.lit(_SAME), one)


def _entering(maps: Column, first: Column) -> Column:
    """The states in which the elements of an array of maps begin, as one text, given that of the first."""
    start = F.struct(first.alias("now"), F.lit("").alias("before"))
    return F.aggregate(
        maps,
        start,
        lambda s, one: F.struct(_through(one, s["now"]).alias("now"), F.concat(s["before"], s["now"]).alias("before")),
        lambda s: s["before"],
    )


def _spread(groups: DataFrame, keys: list[str], order: str, first: Column) -> DataFrame:
    """One row per element of ``held`` (order and map) of each group: (keys, order, state in which it begins)."""
    states = _entering(F.transform("held", lambda x: x["map"]), first)
    rows = groups.select(*keys, states.alias("__states"), F.posexplode("held").alias("__at", "__one"))
    return rows.select(*keys, F.col(f"__one.{order}").alias(order), F.substring("__states", F.col("__at") + 1, F.lit(1)).alias("state"))


def _gathered(maps: DataFrame, keys: list[str], order: str) -> DataFrame:
    held = F.array_sort(F.collect_list(F.struct(order, "map"))).alias("held")
    grouped = maps.groupBy(*keys).agg(held)
    return grouped.withColumn("map", _composed(F.transform("held", lambda x: x["map"])))


def begin_states(records: DataFrame) -> DataFrame:
    """(file, block, id, state) in which every record begins, for records (file, block, id, map)."""
    slim = records.select("file", "block", F.shiftright("id", 8).alias("chunk"), "id", "map")
    chunks = _gathered(slim, ["file", "block", "chunk"], "id")
    blocks = _gathered(chunks.select("file", "block", "chunk", "map"), ["file", "block"], "chunk")
    files = _gathered(blocks.select("file", "block", "map"), ["file"], "block")
    of_blocks = _spread(files, ["file"], "block", F.lit("o"))
    known = blocks.select("file", "block", "held").join(of_blocks, ["file", "block"])
    of_chunks = _spread(known, ["file", "block"], "chunk", F.col("state"))
    known = chunks.select("file", "block", "chunk", "held").join(of_chunks, ["file", "block", "chunk"])
    return _spread(known, ["file", "block", "chunk"], "id", F.col("state")).select("file", "block", "id", "state")


def read_records(spark: SparkSession, path: str | list[str], tag: str, folder: str | None = None) -> DataFrame:
    """(file, block, id, text, map, opens): the text of files cut before every ``<tag``; written, as ``id`` must not change.

    ``opens`` tells whether the record goes on as an element of that name would; the first record of a file comes before any tag.
    ``folder`` names a column that the folders of the files have values of, which is kept.
    """
    kept = [folder] if folder else []
    lines = spark.read.schema("value string" + "".join(f", {c} string" for c in kept)).option("lineSep", f"<{tag}").text(path)
    text = F.col("value")
    cut = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        text.alias("text"),
        state_map(text).alias("map"),
        text.rlike(r"^[\s/>]").alias("opens"),
        *kept,
    )
    return written(cut, "records")


def elements(records: DataFrame, tag: str) -> DataFrame:
    """(file, raw): the text of every ``tag`` element of ``read_records``, up to its end tag, or without one up to the next element."""
    heads = records.filter("block = 0").groupBy("file").agg(F.min("id").alias("id"))
    # One row per file: records, with their texts, stay where they are.
    heads = F.broadcast(heads.withColumn("head", F.lit(True)))
    records = records.join(heads, ["file", "id"], "left").withColumn("head", F.col("head").isNotNull())
    odd = records.filter((F.substring("map", 1, 1) != "o") | ~F.col("opens") & ~F.col("head")).select("file").distinct()
    odd = written(odd, "odd-files")
    simple = records.join(odd, "file", "left_anti").filter(~F.col("head")).select("file", "text")
    if odd.limit(1).count():
        simple = simple.unionByName(_joined(records.join(odd, "file", "left_semi"), tag))
    return simple.select("file", _ended(F.concat(F.lit(f"<{tag}"), "text"), tag).alias("raw"))


def _joined(records: DataFrame, tag: str) -> DataFrame:
    """(file, text) of the elements of files whose records are not all elements: what belongs together is put together."""
    slim = records.select("file", "block", "id", "map", "opens", "head")
    states = written(slim.join(begin_states(slim), ["file", "block", "id"]), "states")
    place = F.struct("block", "id")
    # Where a file ends inside a section, the last record that begins outside opened it; the records after it are taken as they look.
    last = states.groupBy("file").agg(
        F.max_by(_through(F.col("map"), F.col("state")), place).alias("end"), F.max(F.when(F.col("state") == "o", place)).alias("opener")
    )
    broken = last.filter("end != 'o'").select("file", "opener")
    marked = states.join(broken, "file", "left")
    outside = (F.col("state") == "o") | F.coalesce(place > F.col("opener"), F.lit(False))
    marked = marked.select("file", "block", "id", (F.col("opens") & ~F.col("head") & outside).alias("starts"))
    # The element of a record is the last start up to it: within its block, or carried over from the blocks before.
    started = F.when(F.col("starts"), place)
    inside = Window.partitionBy("file", "block").orderBy("id")
    owned = marked.select("file", "block", "id", F.last(started, ignorenulls=True).over(inside).alias("own"))
    blocks = marked.groupBy("file", "block").agg(F.max(started).alias("latest"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("file", "block", F.last("latest", ignorenulls=True).over(before).alias("carried"))
    owned = owned.join(carried, ["file", "block"]).select("file", "block", "id", F.coalesce("own", "carried").alias("own"))
    texts = records.select("file", "block", "id", "text").join(owned.filter(F.col("own").isNotNull()), ["file", "block", "id"])
    parts = texts.groupBy("file", "own").agg(F.array_sort(F.collect_list(F.struct("block", "id", "text"))).alias("parts"))
    return parts.select("file", F.array_join(F.col("parts.text"), f"<{tag}").alias("text"))


def _alone(tag: str) -> str:
    """Pattern of a tag that ends itself."""
    return rf"^<{tag}(?:\s[^<>]*)?/>"


def _ended(text: Column, tag: str) -> Column:
    """The text up to and with its end tag, the first one outside sections and comments; all of it where there is none."""
    end = f"</{tag}>"
    plain = F.when(F.contains(text, F.lit(end)), F.concat(F.substring_index(text, end, 1), F.lit(end))).otherwise(text)
    pattern = f"{_COMPLETE}|{end}"
    tokens, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    at = F.array_position(tokens, end).cast("int")
    pairs = F.zip_with(F.slice(between, F.lit(1), at), F.slice(tokens, F.lit(1), at), lambda a, b: F.concat(a, b))
    cut = F.when(~F.contains(text, F.lit("<!")), plain).when(at > 0, F.array_join(pairs, "")).otherwise(text)
    return F.when(text.rlike(_alone(tag)), F.regexp_extract(text, _alone(tag), 0)).otherwise(cut)


def has_end(text: Column, tag: str) -> Column:
    """Does the element's text have its end tag outside sections and comments, or end itself?"""
    return F.contains(F.regexp_replace(text, _COMPLETE, " "), F.lit(f"</{tag}>")) | text.rlike(_alone(tag))
