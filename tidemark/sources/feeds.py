"""RSS feeds as tables, read from landed XML files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import row_number
from tidemark.sources import markup

# The item fields of an RSS feed.
RAW_SCHEMA = "title string, link string, description string, pubDate string, guid string"
RAW_SCHEMA_ENCODED = "title string, link string, `content:encoded` string, pubDate string, guid string"
# The zone names of RFC 822.
ZONES = {"EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}
# The date without its weekday, which Spark's parser does not take; seconds may be left out.
PUB_DATES = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z")


def published_at(text: Column) -> Column:
    """RFC 822 date as a UTC timestamp without zone; NULL when absent or malformed."""
    trimmed = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")
    numeric = F.regexp_replace(trimmed, r"(GMT|UTC|UT|Z)$", "+0000")
    for name, offset in ZONES.items():
        numeric = F.regexp_replace(numeric, rf"{name}$", offset)
    # Most dates name no zone.
    numeric = F.when(trimmed.rlike(r"[A-Z]$"), numeric).otherwise(trimmed)
    instant = F.coalesce(*[F.try_to_timestamp(numeric, F.lit(form)) for form in PUB_DATES])
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


_RAW, _BAD, _FOLDER = "__raw", "__bad", "feed"
# A malformed item is kept with NULL fields and its text, and stops neither its feed nor its file.
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}


def _items(spark: SparkSession, path: str | list[str], schema: str, folder: str | None = None) -> DataFrame:
    """One row per item of feed files: its fields, its text, and its text again where it is malformed.

    Files are split, and cut at items as ``markup`` says: an item that doesn't end is lost by itself only, and tags
    inside CDATA sections and comments are text.
    """
    records = markup.read_records(spark, path, "item", folder)
    items = markup.elements(records, "item").withColumnRenamed("raw", _RAW)
    kept = [_RAW]
    if folder:
        items = items.join(records.select("file", folder).distinct(), "file")
        kept.append(folder)
    parsed = items.withColumn("__item", F.from_xml(_RAW, f"{schema}, {_BAD} string", _OPTIONS))
    unended = F.when(~markup.has_end(F.col(_RAW), "item"), F.col(_RAW))
    return parsed.select("__item.*", *kept).withColumn(_BAD, F.coalesce(_BAD, unended))


def as_items(raw: DataFrame, encoded: bool = False, *more: Column) -> DataFrame:
    """(title, link, description, published, guid), after the columns of ``more``.

    An item without ``guid`` is known by its link, and without a link by a digest of its content; a malformed one by a
    digest of its text.
    """
    body = F.col("`content:encoded`") if encoded else F.col("description")
    content = F.sha2(F.concat_ws("\n", "title", body, "pubDate"), 256)
    return raw.select(
        *more,
        "title",
        "link",
        body.alias("description"),
        published_at(F.col("pubDate")).alias("published"),
        F.when(F.col(_BAD).isNotNull(), F.sha2(_RAW, 256)).otherwise(F.coalesce("guid", "link", content)).alias("guid"),
    )


def rejected_items(spark: SparkSession, path: str, encoded: bool = False) -> DataFrame:
    """(guid, raw) of the malformed items of all feed files below ``path``."""
    raw = _items(spark, path, RAW_SCHEMA_ENCODED if encoded else RAW_SCHEMA)
    return raw.filter(F.col(_BAD).isNotNull()).select(F.sha2(_RAW, 256).alias("guid"), F.col(_RAW).alias("raw"))


def undated_items(items: DataFrame) -> DataFrame:
    """How many items have a date that could be read, and how many have none or one that could not: (dated, undated)."""
    return items.agg(F.count("published").alias("dated"), F.count(F.when(F.col("published").isNull(), 1)).alias("undated"))


def read_feed(spark: SparkSession, path: str | list[str], encoded: bool = False) -> DataFrame:
    """Items of all feed files below ``path``. Some feeds carry ``content:encoded`` as the body."""
    return as_items(_items(spark, path, RAW_SCHEMA_ENCODED if encoded else RAW_SCHEMA), encoded)


def stream_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """(path) of feed files as a stream: every new file in the folder comes once. Contents are not read here."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("path")


def union_feeds(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Items of several feeds, each tagged with its feed's name and numbered in it by guid: (source_name, rn, item columns).

    Feeds may differ in how their files name the body; their items have the same columns.
    """
    return number_items(reduce(DataFrame.unionByName, [items.withColumn("source_name", F.lit(name)) for name, items in feeds.items()]))


def number_items(rows: DataFrame) -> DataFrame:
    """Items that carry the name of their feed, numbered in it by guid; any number of feeds, a null name is one of them."""
    columns = [c for c in rows.columns if c != "source_name"]
    order = [F.length("guid").asc_nulls_last(), F.col("guid").asc_nulls_last()]
    return row_number(rows, ["source_name"], order, "rn").select("source_name", "rn", *columns)


def land_feeds(rows: DataFrame, path: str, encoded: bool = False) -> None:
    """Land items that carry the name of their feed in ``source_name``, in one write: a folder of feed files for each name."""
    _write(rows.withColumn(_FOLDER, F.concat(F.lit("feed-"), "source_name")), path, encoded, [_FOLDER])


def read_feeds(spark: SparkSession, path: str, encoded: bool = False) -> DataFrame:
    """The items that ``land_feeds`` wrote, with the name of their feed: (source_name, item columns)."""
    name = F.substring(F.col(_FOLDER), 6, 1 << 30).alias("source_name")
    return as_items(_items(spark, path, RAW_SCHEMA_ENCODED if encoded else RAW_SCHEMA, _FOLDER), encoded, name)


def write_feed(df: DataFrame, path: str, encoded: bool = False) -> None:
    """Land (title, link, description, published, guid) as feed files; with ``encoded`` the body is ``content:encoded``."""
    _write(df, path, encoded, [])


def _write(df: DataFrame, path: str, encoded: bool, folders: list[str]) -> None:
    stamped = df.select(
        "title",
        "link",
        "description",
        F.concat(F.date_format("published", "E, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")).alias("pubDate"),
        "guid",
        *folders,
    )
    if not encoded:
        stamped.write.partitionBy(*folders).format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
        return
    # Spark's XML writer takes no names with a colon, so these files are written as text, one item a line.
    names = {c: "content:encoded" if c == "description" else c for c in stamped.columns if c not in folders}
    fields = [F.concat(F.lit(f"<{tag}>"), _escaped(F.col(c)), F.lit(f"</{tag}>")) for c, tag in names.items()]
    line = F.concat(F.lit("<item>"), F.concat_ws("", *fields), F.lit("</item>"))
    stamped.select(line.alias("value"), *folders).write.partitionBy(*folders).text(path)


def _escaped(text: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", "&#10;")):
        text = F.replace(text, F.lit(char), F.lit(name))
    return text
