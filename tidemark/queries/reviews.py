"""Analytics over a collection of review documents: containment, paths, averages.

A review is made from an event: ``{product: {category, title}, review: {rating, text}}``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import paths, variants
from tidemark.functions.containment import contains
from tidemark.plans.collections import HotPath, find, read_collection, store_collection
from tidemark.queries.registry import query
from tidemark.session import scratch_path


def collection(t):
    """(event_id, doc): one document per event."""
    product = F.struct(
        F.col("event_type").alias("category"), F.concat(F.lit("title-"), "user_id").alias("title")
    )
    review = F.struct(F.floor("value").cast("int").alias("rating"), F.col("props").alias("text"))
    return t.events.select(
        "event_id", F.to_variant_object(F.struct(product.alias("product"), review.alias("review"))).alias("doc")
    )


_FLAT = """(SELECT event_id, event_type AS category, 'title-' || user_id AS title,
    CAST(floor(value) AS INTEGER) AS rating, props AS text FROM events)"""

CLICKS = {"product": {"category": "click"}}


HOT = [HotPath("category", "string", ("product", "category"))]


def average_per_title(reviews, wanted, hot=()):
    """Average rating per title of the documents that contain ``wanted``, best first."""
    # Paths are read in one projection, so that a stored collection is read path by path.
    read = find(reviews, "doc", wanted, hot).select(
        variants.get_text(F.col("doc"), "product", "title").alias("title"),
        variants.get_as(F.col("doc"), "int", "review", "rating").alias("rating"),
    )
    return (
        read.groupBy("title")
        .agg(F.round(F.avg("rating"), 6).alias("average_rating"))
        .orderBy(F.col("average_rating").desc_nulls_first())
    )


@query(
    "agg_avg_json",
    f"""SELECT title, round(avg(rating), 6) AS average_rating FROM {_FLAT} WHERE category = 'click'
        GROUP BY title ORDER BY average_rating DESC""",
)
def agg_avg_json(t):
    return average_per_title(collection(t), CLICKS)


@query(
    "stored_collection",
    f"""SELECT title, round(avg(rating), 6) AS average_rating FROM {_FLAT} WHERE category = 'click'
        GROUP BY title ORDER BY average_rating DESC""",
)
def stored_collection(t):
    path = scratch_path(t.spark, "reviews")
    store_collection(collection(t), path, "doc", HOT, spread="event_id")
    return average_per_title(read_collection(t.spark, path), CLICKS, HOT)


@query(
    "agg_group_json_path",
    f"""SELECT category, round(avg(rating), 6) AS average_rating, count(rating) AS count_rating
        FROM {_FLAT} GROUP BY category""",
)
def agg_group_json_path(t):
    read = collection(t).select(
        variants.get_text(F.col("doc"), "product", "category").alias("category"),
        variants.get_as(F.col("doc"), "int", "review", "rating").alias("rating"),
    )
    return read.groupBy("category").agg(
        F.round(F.avg("rating"), 6).alias("average_rating"), F.count("rating").alias("count_rating")
    )


@query(
    "json_contains_object",
    f"SELECT event_id, title FROM {_FLAT} WHERE category = 'click' AND rating = 10",
)
def json_contains_object(t):
    wanted = {"product": {"category": "click"}, "review": {"rating": 10}}
    found = collection(t).filter(contains(F.col("doc"), wanted))
    return found.select("event_id", variants.get_text(F.col("doc"), "product", "title").alias("title"))


@query(
    "json_path_exists",
    """SELECT count(*) AS n_k, CAST(0 AS BIGINT) AS n_missing FROM events WHERE json_exists(props, '$.k')""",
)
def json_path_exists(t):
    doc = F.parse_json("props")
    read = t.events.select(paths.exists(doc, "$.k").alias("k"), paths.exists(doc, "$.missing").alias("missing"))
    return read.agg(
        F.count(F.when(F.col("k"), 1)).alias("n_k"), F.count(F.when(F.col("missing"), 1)).alias("n_missing")
    )


@query(
    "json_path_query",
    f"""SELECT event_id, to_json({{'category': category, 'title': title}}) AS value FROM {_FLAT}
        UNION ALL SELECT event_id, to_json({{'rating': rating, 'text': text}}) FROM {_FLAT}""",
)
def json_path_query(t):
    found = collection(t).select("event_id", F.explode(paths.query(F.col("doc"), "$.*")).alias("value"))
    return found.select("event_id", F.to_json("value").alias("value"))


@query(
    "json_path_query_filter",
    f"SELECT event_id, category, NULL AS subcategory, title FROM {_FLAT} WHERE category = 'click'",
)
def json_path_query_filter(t):
    clicks = paths.query(F.col("doc"), '$[*] ? (@.product.category == "click")')
    found = collection(t).select("event_id", F.explode(clicks).alias("root"))
    doc = F.col("root")
    return found.select(
        "event_id",
        variants.get_text(doc, "product", "category").alias("category"),
        variants.get_text(doc, "product", "subcategory").alias("subcategory"),
        variants.get_text(doc, "product", "title").alias("title"),
    )


@query(
    "json_path_query_array",
    f"""SELECT event_id,
          '[' || to_json({{'rating': rating, 'text': text}}) || ',' || to_json({{'category': category, 'title': title}}) || ']' AS members,
          to_json([title, category]) AS product, '[' || to_json(text) || ',' || rating || ']' AS review
        FROM {_FLAT}""",
)
def json_path_query_array(t):
    doc = F.col("doc")
    return collection(t).select(
        "event_id",
        paths.query_array(doc, "$.*").alias("members"),
        paths.query_array(doc, "$.product.*").alias("product"),
        paths.query_array(doc, "$.review.*").alias("review"),
    )


@query(
    "json_path_query_first",
    f"SELECT event_id, 'review' AS key, to_json({{'rating': rating, 'text': text}}) AS value FROM {_FLAT}",
)
def json_path_query_first(t):
    # The key of the first member is that of the only path to it.
    first = collection(t).select("event_id", "doc", paths.query_first(F.col("doc"), "$.*").alias("m"))
    key = variants.first_member(F.col("doc"))["key"]
    return first.select("event_id", key.alias("key"), F.to_json("m").alias("value"))
