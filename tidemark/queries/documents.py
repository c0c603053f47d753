"""JSON document queries: build, navigate, unnest, edit, write back.

Customers stand for artists, their orders for albums, and line items for tracks.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import editing, variants
from tidemark.functions.containment import contains
from tidemark.operators.distinct import first_per_key
from tidemark.operators.nesting import nest, table_as_json
from tidemark.plans.documents import Level, apply_document_edits, as_variant, three_levels, two_levels
from tidemark.queries.registry import query

_TRACK_FIELDS = {
    "album_id": "l_orderkey",
    "track_id": "l_linenumber",
    "track_name": "l_partkey",
    "media_type": "l_returnflag",
    "milliseconds": "l_quantity",
    "unit_price": "l_extendedprice",
}
_ALBUM_FIELDS = {"artist_id": "o_custkey", "album_id": "o_orderkey", "album_title": "o_orderpriority"}
_ARTIST_FIELDS = {"artist_id": "c_custkey", "artist": "c_name"}

_TRACK_SQL = """{'album_id': l_orderkey, 'track_id': l_linenumber, 'track_name': l_partkey,
    'media_type': l_returnflag, 'milliseconds': l_quantity, 'unit_price': l_extendedprice}"""
_DOCUMENT_SQL = f"""WITH albums AS (
    SELECT o_custkey, o_orderkey, o_orderpriority,
           list({_TRACK_SQL} ORDER BY l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity,
                l_extendedprice) AS tracks
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
  documents AS (
    SELECT c_custkey, {{'artist_id': c_custkey, 'artist': c_name, 'albums': list({{'artist_id': o_custkey,
           'album_id': o_orderkey, 'album_title': o_orderpriority, 'album_tracks': tracks}}
           ORDER BY o_custkey, o_orderkey)}} AS doc
    FROM customer JOIN albums ON c_custkey = o_custkey GROUP BY c_custkey, c_name)"""


def artist_documents(t, orders=None):
    """(c_custkey, part_no, document) for all customers, or for those of the given orders."""
    return three_levels(
        Level(t.customer, "c_custkey", _ARTIST_FIELDS),
        Level(t.orders if orders is None else orders, "o_orderkey", _ALBUM_FIELDS, "o_custkey"),
        Level(t.lineitem, None, _TRACK_FIELDS, "l_orderkey"),
        inner="albums",
        leaves="album_tracks",
    )


def order_documents(t):
    """Customers with their orders only, as variants: (c_custkey, part_no, document)."""
    return as_variant(
        two_levels(
            Level(t.customer, "c_custkey", _ARTIST_FIELDS),
            Level(t.orders, "o_orderkey", _ALBUM_FIELDS, "o_custkey"),
            inner="albums",
        )
    )


# --- building --------------------------------------------------------------------------------


@query(
    "json_build_object",
    """SELECT c_custkey, json_object('customer_id', c_custkey, 'customer_name', c_name) AS doc FROM customer""",
)
def json_build_object(t):
    doc = variants.row_json(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))
    return t.customer.select("c_custkey", doc.alias("doc"))


@query(
    "row_to_json",
    """SELECT c_custkey, to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
              'c_mktsegment': nullif(c_mktsegment, 'BUILDING')}) AS doc FROM customer""",
)
def row_to_json(t):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment")
    doc = variants.row_json("c_custkey", "c_name", "c_nationkey", segment)
    return t.customer.select("c_custkey", doc.alias("doc"))


@query(
    "row_to_json_anon",
    """SELECT c_custkey, to_json({'f1': c_custkey, 'f2': c_name || ' ' || c_mktsegment}) AS doc FROM customer""",
)
def row_to_json_anon(t):
    label = F.concat("c_name", F.lit(" "), "c_mktsegment")
    return t.customer.select("c_custkey", variants.anonymous_row_json(F.col("c_custkey"), label).alias("doc"))


@query("to_jsonb_scalar", "SELECT doc_id, to_json(lang) AS doc, lang AS back FROM documents")
def to_jsonb_scalar(t):
    doc = variants.from_text(F.col("lang"))
    return t.documents.select("doc_id", doc.alias("v")).select(
        "doc_id", F.to_json("v").alias("doc"), variants.get_text(F.col("v")).alias("back")
    )


@query(
    "agg_rows_in_object",
    """SELECT o_custkey, 0 AS part_no, to_json({'albums': list({'o_orderkey': o_orderkey, 'o_orderpriority': o_orderpriority}
              ORDER BY o_orderkey)}) AS doc FROM orders GROUP BY o_custkey""",
)
def agg_rows_in_object(t):
    nested = nest(t.orders, ["o_custkey"], F.struct("o_orderkey", "o_orderpriority"), "albums")
    return nested.select("o_custkey", "part_no", variants.row_json("albums").alias("doc"))


@query(
    "nested_documents",
    _DOCUMENT_SQL + " SELECT c_custkey, 0 AS part_no, to_json(doc) AS artist_data FROM documents",
)
def nested_documents(t):
    text = F.to_json("document", {"ignoreNullFields": "false"})
    return artist_documents(t).select("c_custkey", "part_no", text.alias("artist_data"))


@query(
    "albums_with_track_names",
    """WITH tracks AS (SELECT l_orderkey, to_json(list(l_partkey ORDER BY l_partkey)) AS names
                       FROM lineitem GROUP BY l_orderkey)
       SELECT c_name, o_orderkey, 0 AS part_no, names FROM tracks JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey""",
)
def albums_with_track_names(t):
    tracks = nest(t.lineitem, ["l_orderkey"], F.col("l_partkey"), "names")
    return (
        tracks.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_name", "o_orderkey", "part_no", F.to_json("names").alias("names"))
    )


@query(
    "to_jsonb_row",
    """SELECT c_custkey, c_name AS name, c_nationkey AS nation, c_name AS reparsed_name FROM customer""",
)
def to_jsonb_row(t):
    made = t.customer.select("c_custkey", variants.from_row("c_custkey", "c_name", "c_nationkey").alias("v"))
    # A document rendered to text and read back is the same document.
    both = made.withColumn("again", F.parse_json(F.to_json("v")))
    return both.select(
        "c_custkey",
        variants.get_text(F.col("v"), "c_name").alias("name"),
        variants.get_as(F.col("v"), "int", "c_nationkey").alias("nation"),
        variants.get_text(F.col("again"), "c_name").alias("reparsed_name"),
    )


@query(
    "agg_whole_table_json",
    """SELECT 0 AS part_no, to_json(list({'c_custkey': c_custkey, 'c_name': c_name} ORDER BY c_custkey)) AS json
       FROM customer""",
)
def agg_whole_table_json(t):
    return table_as_json(t.customer.select("c_custkey", "c_name"), ["c_custkey"])


# --- navigating ------------------------------------------------------------------------------


def _events(t):
    """Events with ``props`` read as a document."""
    return t.events.withColumn("doc", F.parse_json("props"))


@query("json_get", "SELECT event_id, json_extract(props, '$.k') AS k FROM events")
def json_get(t):
    return _events(t).select("event_id", F.to_json(variants.get(F.col("doc"), "k")).alias("k"))


@query(
    "json_get_text",
    "SELECT event_id, props ->> '$.k' AS k, props ->> '$.missing' AS missing FROM events",
)
def json_get_text(t):
    return _events(t).select(
        "event_id",
        variants.get_text(F.col("doc"), "k").alias("k"),
        variants.get_text(F.col("doc"), "missing").alias("missing"),
    )


@query(
    "json_path_get",
    """SELECT o_custkey AS c_custkey, to_json(arg_min({'album_id': o_orderkey, 'album_title': o_orderpriority,
              'artist_id': o_custkey}, o_orderkey)) AS first_album FROM orders GROUP BY o_custkey""",
)
def json_path_get(t):
    first = variants.get(F.col("document"), "albums", 0)
    return order_documents(t).filter("part_no = 0").select("c_custkey", F.to_json(first).alias("first_album"))


@query(
    "json_path_get_text",
    """SELECT o_custkey AS c_custkey, min_by(o_orderpriority, o_orderkey) AS first_title
       FROM orders GROUP BY o_custkey""",
)
def json_path_get_text(t):
    title = variants.get_text(F.col("document"), "albums", 0, "album_title")
    return order_documents(t).filter("part_no = 0").select("c_custkey", title.alias("first_title"))


@query(
    "json_contains_array",
    """SELECT DISTINCT c_custkey, c_name FROM customer JOIN orders ON c_custkey = o_custkey
       WHERE o_orderpriority = '1-URGENT'""",
)
def json_contains_array(t):
    return _with_albums(t, "1-URGENT")


def _with_albums(t, *titles):
    """Customers whose array of albums contains one with each title, wherever in the array these are.

    A document may come in parts: each wanted element is looked for in every part, and a customer is found when every
    element was seen in some part.
    """
    flags = [contains(F.col("document"), {"albums": [{"album_title": title}]}) for title in titles]
    seen = order_documents(t).select(
        "c_custkey",
        variants.get_text(F.col("document"), "artist").alias("c_name"),
        *[flag.alias(f"has{i}") for i, flag in enumerate(flags)],
    )
    whole = seen.groupBy("c_custkey", "c_name").agg(*[F.bool_or(f"has{i}").alias(f"has{i}") for i in range(len(titles))])
    return whole.filter(" AND ".join(f"has{i}" for i in range(len(titles)))).select("c_custkey", "c_name")


@query(
    "json_contains_two",
    """SELECT c_custkey, c_name FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
       HAVING bool_or(o_orderpriority = '1-URGENT') AND bool_or(o_orderpriority = '5-LOW')""",
)
def json_contains_two(t):
    return _with_albums(t, "1-URGENT", "5-LOW")


@query("join_json_key", "SELECT c.c_name, e.event_id FROM events e JOIN customer c ON c.c_custkey = CAST(e.props ->> '$.k' AS INTEGER)")
def join_json_key(t):
    key = variants.get_as(F.col("doc"), "int", "k")
    keyed = _events(t).select("event_id", key.alias("k"))
    return keyed.join(t.customer, F.col("k") == F.col("c_custkey")).select("c_name", "event_id")


@query(
    "join_json_left",
    """SELECT s.s_suppkey, s.s_name, l.l_orderkey, p.p_name FROM supplier s
       LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 49) l ON s.s_suppkey = l.l_suppkey
       LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l.l_partkey = p.p_partkey
       WHERE s.s_nationkey = 7""",
)
def join_json_left(t):
    docs = t.supplier.select(F.col("s_suppkey").alias("id"), variants.from_row("s_name", "s_nationkey", "s_suppkey").alias("doc"))
    nation = variants.get_text(F.col("doc"), "s_nationkey")
    key = variants.get_as(F.col("doc"), "long", "s_suppkey")
    chosen = docs.filter(nation == "7").select("id", key.alias("key"), variants.get_text(F.col("doc"), "s_name").alias("s_name"))
    bridge = t.lineitem.filter(F.col("l_quantity") > 49)
    parts = t.part.filter(F.col("p_size") > 10)
    return (
        chosen.join(bridge, F.col("key") == F.col("l_suppkey"), "left")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(F.col("id").alias("s_suppkey"), "s_name", "l_orderkey", "p_name")
    )


# --- unnesting -------------------------------------------------------------------------------


@query(
    "json_array_elements",
    "SELECT o_custkey AS c_custkey, o_orderkey AS album_id, o_orderpriority AS album_title FROM orders",
)
def json_array_elements(t):
    rows = variants.unnest(order_documents(t), "document", "albums", out="album", keep={"c_custkey": F.col("c_custkey")})
    return rows.select(
        "c_custkey",
        variants.get_as(F.col("album"), "long", "album_id").alias("album_id"),
        variants.get_text(F.col("album"), "album_title").alias("album_title"),
    )


@query(
    "json_nested_unnest",
    """SELECT c_custkey AS artist_id, c_name AS artist, o_orderkey AS album_id, o_orderpriority AS album_title,
              CAST(l_linenumber AS VARCHAR) AS track_id, l_partkey AS track_name, l_extendedprice AS unit_price
       FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey""",
)
def json_nested_unnest(t):
    docs = as_variant(artist_documents(t)).select("document")
    # Each track stays with its own album: albums first, then the tracks of each.
    artist = {
        "artist_id": variants.get_as(F.col("document"), "long", "artist_id"),
        "artist": variants.get_text(F.col("document"), "artist"),
    }
    albums = variants.unnest(docs, "document", "albums", out="album", keep=artist)
    album = {
        "artist_id": F.col("artist_id"),
        "artist": F.col("artist"),
        "album_id": variants.get_as(F.col("album"), "long", "album_id"),
        "album_title": variants.get_text(F.col("album"), "album_title"),
    }
    tracks = variants.unnest(albums, "album", "album_tracks", out="track", keep=album)
    return tracks.select(
        "artist_id",
        "artist",
        "album_id",
        "album_title",
        variants.get_text(F.col("track"), "track_id").alias("track_id"),
        variants.get_as(F.col("track"), "long", "track_name").alias("track_name"),
        variants.get_as(F.col("track"), "double", "unit_price").alias("unit_price"),
    ).orderBy(*[F.col(c).asc_nulls_last() for c in ("artist_id", "album_id", "track_id", "track_name")])


@query(
    "json_to_recordset",
    """SELECT o_custkey AS c_custkey, o_orderkey AS album_id, o_orderpriority AS album_title,
              CAST(NULL AS VARCHAR) AS not_there FROM orders""",
)
def json_to_recordset(t):
    rows = variants.recordset(
        order_documents(t), "document", "album_id bigint, album_title string, not_there string", "albums"
    )
    return rows.select("c_custkey", "album_id", "album_title", "not_there")


@query(
    "scalar_subquery_source",
    """SELECT c_custkey AS artist_id, o_orderkey AS album_id, o_orderpriority AS album_title FROM orders
       JOIN (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey DESC LIMIT 1) ON o_custkey = c_custkey""",
)
def scalar_subquery_source(t):
    # One customer is picked first; only that customer's orders are made into a document.
    chosen = t.customer.agg(F.max_by("c_custkey", F.struct("c_acctbal", "c_custkey"))).scalar()
    orders = t.orders.filter(F.col("o_custkey") == chosen)
    docs = as_variant(
        two_levels(
            Level(t.customer, "c_custkey", _ARTIST_FIELDS),
            Level(orders, "o_orderkey", _ALBUM_FIELDS, "o_custkey"),
            inner="albums",
        )
    )
    return variants.recordset(docs, "document", "artist_id bigint, album_id bigint, album_title string", "albums").select(
        "artist_id", "album_id", "album_title"
    )


@query(
    "json_each_text",
    """SELECT s_suppkey, unnest(['s_name', 's_nationkey']) AS key,
              unnest([s_name, CAST(s_nationkey AS VARCHAR)]) AS value FROM supplier""",
)
def json_each_text(t):
    docs = t.supplier.select("s_suppkey", variants.from_row("s_name", "s_nationkey").alias("doc"))
    return variants.each(docs, "doc").select("s_suppkey", "key", "value")


# --- editing ---------------------------------------------------------------------------------


@query(
    "json_set",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) + 1000 AS k, value AS inner_value, event_type
       FROM events""",
)
def json_set(t):
    doc = variants.from_row(F.struct(F.col("props").alias("raw"), F.lit(0).alias("v")).alias("inner"), "event_type")
    made = t.events.select("event_id", "value", F.parse_json("props").alias("props"), doc.alias("doc"))
    k = variants.get_as(F.col("props"), "int", "k") + 1000
    edited = made.select(
        "event_id",
        editing.set_path(F.col("props"), ["k"], k.cast("variant")).alias("props"),
        editing.set_path(F.col("doc"), ["inner", "v"], F.col("value").cast("variant")).alias("doc"),
    )
    return edited.select(
        "event_id",
        variants.get_as(F.col("props"), "int", "k").alias("k"),
        variants.get_as(F.col("doc"), "double", "inner", "v").alias("inner_value"),
        variants.get_text(F.col("doc"), "event_type").alias("event_type"),
    )


@query(
    "json_concat",
    """SELECT event_id, json_merge_patch(props, json_object('k', user_id, 'type', event_type)) ->> '$.k' AS k,
              json_merge_patch(props, json_object('k', user_id, 'type', event_type)) ->> '$.type' AS type FROM events""",
)
def json_concat(t):
    patch = variants.from_row(F.col("user_id").alias("k"), F.col("event_type").alias("type"))
    merged = _events(t).select("event_id", editing.concat(F.col("doc"), patch).alias("doc"))
    return merged.select(
        "event_id",
        variants.get_text(F.col("doc"), "k").alias("k"),
        variants.get_text(F.col("doc"), "type").alias("type"),
    )


@query(
    "json_delete_key",
    """SELECT event_id, props ->> '$.k' AS k, false AS has_type FROM events""",
)
def json_delete_key(t):
    typed = editing.concat(F.col("doc"), variants.from_row(F.col("event_type").alias("type")))
    cut = _events(t).select("event_id", editing.delete_key(typed, "type").alias("doc"))
    return cut.select(
        "event_id",
        variants.get_text(F.col("doc"), "k").alias("k"),
        variants.exists(F.col("doc"), "type").alias("has_type"),
    )


@query(
    "json_text_compare",
    """SELECT event_id, CAST(props ->> '$.k' AS BIGINT) = user_id AS is_different FROM events""",
)
def json_text_compare(t):
    # The column says whether the texts are equal, under the name it has always had.
    other = variants.from_row(F.col("user_id").alias("k"))
    return _events(t).select("event_id", editing.same_text(F.col("doc"), other).alias("is_different"))


@query(
    "json_pretty",
    """SELECT c_custkey, '{' || chr(10) || '  "c_custkey" : ' || c_custkey || ',' || chr(10) || '  "c_name" : "' || c_name
              || '",' || chr(10) || '  "c_mktsegment" : "' || c_mktsegment || '"' || chr(10) || '}' AS doc FROM customer""",
)
def json_pretty(t):
    doc = variants.from_row("c_custkey", "c_name", "c_mktsegment")
    text = variants.pretty(doc, "c_custkey bigint, c_name string, c_mktsegment string")
    return t.customer.select("c_custkey", text.alias("doc"))


@query(
    "json_view_update",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN substr(c_name || ' (overdrawn)', 1, 120) ELSE c_name END AS c_name
       FROM customer""",
)
def json_view_update(t):
    before = t.customer.select(
        "c_acctbal", variants.from_row(F.col("c_custkey").alias("artist_id"), F.col("c_name").alias("artist")).alias("doc")
    )
    name = F.concat(variants.get_text(F.col("doc"), "artist"), F.lit(" (overdrawn)"))
    edited = editing.set_path(F.col("doc"), ["artist"], name.cast("variant"))
    after = before.select(
        variants.get_as(F.col("doc"), "long", "artist_id").alias("c_custkey"),
        F.when(F.col("c_acctbal") < 0, edited).otherwise(F.col("doc")).alias("doc"),
    )
    base = t.customer.select("c_custkey", "c_name")
    return apply_document_edits(base, before, after, "c_custkey", "artist_id", {"c_name": ("artist", 120)})


@query(
    "document_extract_typed",
    """SELECT o_orderkey, o_custkey AS customer, o_orderpriority AS priority, o_orderdate AS ordered
       FROM orders""",
)
def document_extract_typed(t):
    docs = t.orders.select(
        variants.from_row(
            "o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("string").alias("o_orderdate")
        ).alias("doc")
    )
    doc = F.col("doc")
    return docs.select(
        variants.get_as(doc, "long", "o_orderkey").alias("o_orderkey"),
        variants.get_as(doc, "long", "o_custkey").alias("customer"),
        variants.get_text(doc, "o_orderpriority").alias("priority"),
        variants.get_text(doc, "o_orderdate").cast("timestamp_ntz").alias("ordered"),
    )


@query(
    "documents_per_actor",
    """WITH films AS (SELECT DISTINCT l_suppkey, p_partkey, p_name, year(l_shipdate) AS released,
              2024 - year(l_shipdate) AS years_ago FROM lineitem JOIN part ON l_partkey = p_partkey)
       SELECT s_suppkey, 0 AS part_no, to_json({'actor': s_name, 'films': list({'p_partkey': p_partkey, 'title': p_name,
              'released': released, 'years_ago': years_ago} ORDER BY p_partkey, released)}) AS doc
       FROM supplier JOIN films ON s_suppkey = l_suppkey GROUP BY s_suppkey, s_name""",
)
def documents_per_actor(t):
    released = F.year("l_shipdate")
    films = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            "l_suppkey",
            "p_partkey",
            F.col("p_name").alias("title"),
            released.alias("released"),
            (F.lit(2024) - released).alias("years_ago"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    element = F.struct("p_partkey", "title", "released", "years_ago")
    nested = nest(films, ["l_suppkey"], element, "films", order=["p_partkey", "released"])
    return nested.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "s_suppkey", "part_no", variants.row_json(F.col("s_name").alias("actor"), "films").alias("doc")
    )


@query(
    "json_multi_source_fields",
    """SELECT c_custkey, c_name, json_extract(props, '$.k') AS k_json, props ->> '$.k' AS k_text FROM customer
       LEFT JOIN (SELECT DISTINCT ON (user_id) user_id, props FROM events ORDER BY user_id, ts) e ON c_custkey = user_id""",
)
def json_multi_source_fields(t):
    first = first_per_key(t.events.select("user_id", "ts", "props"), ["user_id"], ["ts"])
    joined = t.customer.join(first, F.col("c_custkey") == F.col("user_id"), "left").withColumn(
        "doc", F.parse_json("props")
    )
    return joined.select(
        "c_custkey",
        "c_name",
        F.to_json(variants.get(F.col("doc"), "k")).alias("k_json"),
        variants.get_text(F.col("doc"), "k").alias("k_text"),
    )
