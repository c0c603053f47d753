"""Projection, filter, join, aggregate, window, sort and scalar-function queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.functions.text import contains_pattern, strip_tags
from tidemark.operators.changes import with_next_ids
from tidemark.operators.distinct import first_per_key
from tidemark.operators.nesting import nest
from tidemark.operators.ordered import number_rows, row_number
from tidemark.operators.textjoin import contains_join
from tidemark.plans.snapshots import materialize
from tidemark.queries.registry import query
from tidemark.session import scratch_path
from tidemark.sources import feeds
from tidemark.sources.workload import hashed_text


# --- projections and filters -----------------------------------------------------------------


@query("project_alias", "SELECT c_custkey AS artist_id, c_name AS artist FROM customer")
def project_alias(t):
    return t.customer.select(F.col("c_custkey").alias("artist_id"), F.col("c_name").alias("artist"))


@query(
    "project_table_star",
    """SELECT o.*, c.c_name AS customer_name, c.c_nationkey AS customer_nationkey
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def project_table_star(t):
    o, c = t.orders.alias("o"), t.customer.alias("c")
    return o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey")).select(
        "o.*", F.col("c.c_name").alias("customer_name"), F.col("c.c_nationkey").alias("customer_nationkey")
    )


@query("literal_columns", "SELECT doc_id, 'documents' AS source_table, true AS is_text, lang FROM documents")
def literal_columns(t):
    return t.documents.select(
        "doc_id", F.lit("documents").alias("source_table"), F.lit(True).alias("is_text"), "lang"
    )


@query(
    "filter_eq_and",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
)
def filter_eq_and(t):
    keep = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return t.orders.filter(keep).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "filter_in",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def filter_in(t):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_orderpriority"
    )


@query("filter_like_upper", "SELECT p_partkey, p_name FROM part WHERE upper(p_name) LIKE 'R%'")
def filter_like_upper(t):
    return t.part.filter(F.upper("p_name").like("R%")).select("p_partkey", "p_name")


@query("filter_like_lower", "SELECT doc_id, lang FROM documents WHERE lower(text) LIKE '%the%'")
def filter_like_lower(t):
    return t.documents.filter(F.lower("text").like("%the%")).select("doc_id", "lang")


@query(
    "filter_future_date",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE CAST(o_orderdate AS DATE) > DATE '2001-01-01' ORDER BY o_orderdate, o_orderkey""",
)
def filter_future_date(t):
    later = F.to_date("o_orderdate") > F.lit("2001-01-01").cast("date")
    return (
        t.orders.filter(later)
        .select("o_orderkey", "o_orderdate")
        .orderBy(F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey").asc_nulls_last())
    )


@query(
    "filter_not_bool",
    """SELECT event_id, user_id FROM (SELECT *, event_type = 'error' AS deleted FROM events)
       WHERE NOT deleted""",
)
def filter_not_bool(t):
    flagged = t.events.withColumn("deleted", F.col("event_type") == "error")
    return flagged.filter(~F.col("deleted")).select("event_id", "user_id")


@query(
    "cte_pipeline",
    """WITH urgent AS (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'),
            lines AS (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey),
            sized AS (SELECT u.o_custkey, l.quantity FROM urgent u JOIN lines l ON u.o_orderkey = l.l_orderkey),
            per_customer AS (SELECT o_custkey, sum(quantity) AS quantity FROM sized GROUP BY o_custkey)
       SELECT c.c_mktsegment, sum(p.quantity) AS quantity, count(*) AS customers
       FROM per_customer p JOIN customer c ON p.o_custkey = c.c_custkey GROUP BY c.c_mktsegment""",
)
def cte_chain(t):
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))
    sized = urgent.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    per_customer = sized.groupBy("o_custkey").agg(F.sum("quantity").alias("quantity"))
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment")
        .agg(F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("customers"))
    )


@query(
    "cast_ops",
    """SELECT o_orderkey, CAST(o_totalprice AS INTEGER) AS price_int, CAST(o_orderdate AS DATE) AS order_day,
              CAST(o_custkey AS VARCHAR) AS customer_text, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS rank,
              substr(o_orderpriority, 1, 4) AS short_text,
              CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS order_ts
       FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders)""",
)
def cast_ops(t):
    return t.orders.select(
        "o_orderkey",
        F.floor("o_totalprice").cast("int").alias("price_int"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        F.col("o_custkey").cast("string").alias("customer_text"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("rank"),
        F.substring("o_orderpriority", 1, 4).alias("short_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("order_ts"),
    )


# --- joins -----------------------------------------------------------------------------------


@query(
    "join_inner_2way",
    """SELECT c.c_name, o.o_orderkey, o.o_orderdate FROM customer c
       JOIN orders o ON c.c_custkey = o.o_custkey""",
)
def join_inner_2way(t):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_name", "o_orderkey", "o_orderdate"
    )


@query(
    "join_inner_3way",
    """SELECT c.c_name, o.o_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity FROM customer c
       JOIN orders o ON c.c_custkey = o.o_custkey JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
)
def join_inner_3way(t):
    return (
        t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("c_name", "o_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    )


@query(
    "join_inner_4way",
    """SELECT n.n_name, c.c_name, o.o_orderkey, l.l_linenumber, l.l_extendedprice FROM customer c
       JOIN orders o ON c.c_custkey = o.o_custkey JOIN lineitem l ON o.o_orderkey = l.l_orderkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def join_inner_4way(t):
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("n_name", "c_name", "o_orderkey", "l_linenumber", "l_extendedprice")
    )


def _large_orders(t):
    return t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000))


def _large_order_keys(t):
    """Order keys per customer, for large finished orders; some customers have none."""
    return nest(_large_orders(t), ["o_custkey"], F.col("o_orderkey"), "keys")


_LARGE_SQL = """WITH large AS (
    SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS keys FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 400000 GROUP BY o_custkey)"""


def _joined_keys(how):
    def run(t):
        keys = F.array_join(F.col("keys").cast("array<string>"), ",")
        return t.customer.join(_large_order_keys(t), F.col("c_custkey") == F.col("o_custkey"), how).select(
            "c_custkey", "c_name", F.coalesce("part_no", F.lit(0)).alias("part_no"), keys.alias("order_keys")
        )

    return run


_JOINED_SQL = """ SELECT c_custkey, c_name, 0 AS part_no, array_to_string(keys, ',') AS order_keys
    FROM customer {how} JOIN large ON c_custkey = o_custkey"""

query("join_left_preagg", _LARGE_SQL + _JOINED_SQL.format(how="LEFT"))(_joined_keys("left"))
query("join_inner_preagg", _LARGE_SQL + _JOINED_SQL.format(how="INNER"))(_joined_keys("inner"))


@query(
    "join_left_chain",
    """SELECT s.s_suppkey, s.s_name, l.l_orderkey, l.l_quantity, p.p_name FROM supplier s
       LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 49) l ON s.s_suppkey = l.l_suppkey
       LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l.l_partkey = p.p_partkey""",
)
def join_left_chain(t):
    bridge = t.lineitem.filter(F.col("l_quantity") > 49)
    parts = t.part.filter(F.col("p_size") > 10)
    return (
        t.supplier.join(bridge, F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select("s_suppkey", "s_name", "l_orderkey", "l_quantity", "p_name")
    )


def _needles(t):
    return t.benchmark.select("item_id", F.col("text").alias("needle"))


@query(
    "join_text_contains",
    """SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b
       ON d.text ILIKE '%' || b.text || '%'""",
)
def join_text_contains(t):
    texts = t.documents.select("doc_id", "text")
    found = contains_join(texts, _needles(t), "doc_id", ["text"], "needle")
    return found.select("doc_id", "item_id")


@query(
    "join_text_contains_or",
    """SELECT d.doc_id, n.needle FROM documents d JOIN
         (SELECT text AS needle FROM benchmark UNION SELECT DISTINCT source FROM documents) n
       ON d.text ILIKE '%' || n.needle || '%' OR d.source ILIKE '%' || n.needle || '%'""",
)
def join_text_contains_or(t):
    # Two snapshots: the united feeds with a title and a body, and the names looked for in either.
    items = t.documents.select(
        F.col("source").alias("source_name"),
        F.col("source").alias("title"),
        F.lit(None).cast("string").alias("link"),
        F.col("text").alias("description"),
        F.lit(None).cast("timestamp_ntz").alias("published"),
        F.col("doc_id").cast("string").alias("guid"),
    )
    united = materialize(feeds.number_items(items), scratch_path(t.spark, "feeds"), key=["source_name", "rn"]).read()
    sources = t.documents.select(F.col("source").alias("needle"))
    names = t.benchmark.select(F.col("text").alias("needle")).union(sources).distinct()
    names = materialize(names, scratch_path(t.spark, "names"), key=["needle"]).read()
    found = contains_join(united.select("guid", "title", "description"), names, "guid", ["description", "title"], "needle")
    return found.select(F.col("guid").cast("bigint").alias("doc_id"), "needle")


@query(
    "cross_join_scalar",
    """SELECT o.o_orderkey, o.o_totalprice, m.n_orders, m.max_price FROM orders o,
         (SELECT count(*) AS n_orders, max(o_totalprice) AS max_price FROM orders) m""",
)
def cross_join_scalar(t):
    # An aggregate without keys has exactly one row, so it is used as a value.
    totals = t.orders.agg(F.struct(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price")))
    return t.orders.select("o_orderkey", "o_totalprice", totals.scalar().alias("m")).select(
        "o_orderkey", "o_totalprice", "m.*"
    )


# --- aggregates ------------------------------------------------------------------------------


@query("agg_count_star", "SELECT count(*) AS n FROM events")
def agg_count_star(t):
    return t.events.agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_count_nonnull",
    """SELECT count(*) AS n, count(l.l_orderkey) AS with_line, count(p.p_name) AS with_part FROM supplier s
       LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 49) l ON s.s_suppkey = l.l_suppkey
       LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l.l_partkey = p.p_partkey""",
)
def agg_count_nonnull(t):
    bridge = t.lineitem.filter(F.col("l_quantity") > 49)
    parts = t.part.filter(F.col("p_size") > 10)
    return (
        t.supplier.join(bridge, F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("l_orderkey").alias("with_line"),
            F.count("p_name").alias("with_part"),
        )
    )


@query(
    "agg_array_scalar",
    """SELECT o_custkey, 0 AS part_no, array_to_string(list(o_orderkey ORDER BY o_orderkey), ',') AS order_keys
       FROM orders GROUP BY o_custkey""",
)
def agg_array_scalar(t):
    nested = nest(t.orders, ["o_custkey"], F.col("o_orderkey"), "keys")
    return nested.select("o_custkey", "part_no", F.array_join(F.col("keys").cast("array<string>"), ",").alias("order_keys"))


@query(
    "agg_array_rows",
    """SELECT o_custkey, 0 AS part_no, to_json(list({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus}
              ORDER BY o_orderkey)) AS order_rows FROM orders GROUP BY o_custkey""",
)
def agg_array_rows(t):
    row = F.struct("o_orderkey", "o_orderstatus")
    nested = nest(t.orders, ["o_custkey"], row, "rows")
    return nested.select(
        "o_custkey", "part_no", F.to_json("rows", {"ignoreNullFields": "false"}).alias("order_rows")
    )


@query(
    "agg_sum_array_len",
    _LARGE_SQL
    + """ SELECT c_name, 0 AS part_no, array_to_string(keys, ',') AS order_keys, sum(len(keys)) AS n_orders
          FROM customer LEFT JOIN large ON c_custkey = o_custkey GROUP BY c_name, keys""",
)
def agg_sum_array_len(t):
    # The length is that of the whole array, counted before it is cut into parts.
    counted = _large_orders(t).groupBy(F.col("o_custkey").alias("counted")).agg(F.count(F.lit(1)).alias("n"))
    keyed = _large_order_keys(t).join(counted, F.col("o_custkey") == F.col("counted"))
    joined = t.customer.join(keyed, F.col("c_custkey") == F.col("o_custkey"), "left")
    return (
        joined.groupBy("c_name", F.coalesce("part_no", F.lit(0)).alias("part_no"), "keys")
        .agg(F.sum("n").alias("n_orders"))
        .select("c_name", "part_no", F.array_join(F.col("keys").cast("array<string>"), ",").alias("order_keys"), "n_orders")
    )


@query(
    "agg_min_max",
    """SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key, min(o_orderdate) AS first_date,
              max(o_orderdate) AS last_date FROM orders""",
)
def agg_min_max(t):
    return t.orders.agg(
        F.min("o_orderkey").alias("min_key"),
        F.max("o_orderkey").alias("max_key"),
        F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
    )


@query(
    "agg_count_filter",
    """SELECT user_id, count(event_id) AS n, count(event_id) FILTER (WHERE event_type = 'error') AS n_error
       FROM events GROUP BY user_id""",
)
def agg_count_filter(t):
    return t.events.groupBy("user_id").agg(
        F.count("event_id").alias("n"),
        F.count(F.when(F.col("event_type") == "error", F.col("event_id"))).alias("n_error"),
    )


@query(
    "distinct_on",
    """SELECT DISTINCT ON (user_id) user_id, ts, event_id, event_type FROM events
       ORDER BY user_id, ts, event_id""",
)
def distinct_on(t):
    rows = t.events.select("user_id", "ts", "event_id", "event_type")
    return first_per_key(rows, ["user_id"], ["ts", "event_id"])


@query("agg_next_id", "SELECT max(o_orderkey) + 1 AS next_id FROM orders")
def agg_next_id(t):
    return t.orders.agg((F.max("o_orderkey") + 1).alias("next_id"))


@query("group_dedupe", "SELECT l_returnflag, l_linestatus FROM lineitem GROUP BY l_returnflag, l_linestatus")
def group_dedupe(t):
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@query(
    "group_by_expr",
    """SELECT year(o_orderdate) AS order_year, substr(o_orderpriority, 1, 1) AS rank, count(*) AS n,
              round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2""",
)
def group_by_expr(t):
    return t.orders.groupBy(
        F.year("o_orderdate").alias("order_year"), F.substring("o_orderpriority", 1, 1).alias("rank")
    ).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


# --- windows, sorts, set operations ----------------------------------------------------------


@query(
    "row_number_partition",
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rec_version
       FROM events""",
)
def row_number_partition(t):
    rows = t.events.select("event_id", "user_id", "ts")
    return row_number(rows, ["user_id"], [F.col("ts").asc_nulls_last()], "rec_version").drop("ts")


@query("row_number_global", "SELECT row_number() OVER (ORDER BY doc_id) AS rn, doc_id, lang FROM documents")
def row_number_global(t):
    return number_rows(t.documents.select("doc_id", "lang"), [F.col("doc_id").asc_nulls_last()], "rn")


@query(
    "row_number_after_filter",
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rec_version
       FROM events WHERE event_type = 'purchase'""",
)
def row_number_after_filter(t):
    rows = t.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return row_number(rows, ["user_id"], [F.col("ts").asc_nulls_last()], "rec_version").drop("ts")


@query(
    "sort_multi",
    """SELECT c_custkey, c_nationkey, c_mktsegment FROM customer
       ORDER BY c_mktsegment, c_nationkey, c_custkey""",
)
def sort_multi(t):
    return t.customer.select("c_custkey", "c_nationkey", "c_mktsegment").orderBy(
        *[F.col(c).asc_nulls_last() for c in ("c_mktsegment", "c_nationkey", "c_custkey")]
    )


@query(
    "sort_desc",
    """SELECT event_type, round(avg(value), 6) AS average_value FROM events GROUP BY event_type
       ORDER BY average_value DESC""",
)
def sort_desc(t):
    return (
        t.events.groupBy("event_type")
        .agg(F.round(F.avg("value"), 6).alias("average_value"))
        .orderBy(F.col("average_value").desc_nulls_first())
    )


@query("limit_one", "SELECT event_id, props FROM events ORDER BY event_id LIMIT 1")
def limit_one(t):
    return t.events.select("event_id", "props").orderBy("event_id").limit(1)


@query(
    "union_feeds",
    "\nUNION\n".join(
        f"""SELECT '{lang}' AS source_name, row_number() OVER (ORDER BY doc_id) AS rn, doc_id, n_chars
            FROM documents WHERE lang = '{lang}'"""
        for lang in ("en", "de", "fr", "es")
    ),
)
def union_feeds(t):
    # Four feeds in two shapes are landed, read, tagged, numbered and kept as one snapshot.
    landed = {}
    for lang, encoded in (("en", False), ("de", True), ("fr", False), ("es", True)):
        items = t.documents.filter(F.col("lang") == lang).select(
            F.concat(F.lit("document "), F.col("doc_id")).alias("title"),
            F.lit(None).cast("string").alias("link"),
            F.col("n_chars").cast("string").alias("description"),
            F.lit("2024-01-01").cast("timestamp_ntz").alias("published"),
            F.col("doc_id").cast("string").alias("guid"),
        )
        path = scratch_path(t.spark, f"feed-{lang}")
        feeds.write_feed(items, path, encoded)
        landed[lang] = feeds.read_feed(t.spark, path, encoded)
    united = feeds.union_feeds(landed)
    view = materialize(united, scratch_path(t.spark, "feeds"), key=["source_name", "rn"])
    return view.read().select(
        "source_name", "rn", F.col("guid").cast("bigint").alias("doc_id"), F.col("description").cast("bigint").alias("n_chars")
    )


@query(
    "union_found_feeds",
    """SELECT lang AS source_name, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn, doc_id, n_chars FROM documents""",
)
def union_found_feeds(t):
    # As many feeds as the data have, a null one among them: landed in one write, read back, numbered, kept as a snapshot.
    items = t.documents.select(
        F.col("lang").alias("source_name"),
        F.concat(F.lit("document "), F.col("doc_id")).alias("title"),
        F.lit(None).cast("string").alias("link"),
        F.col("n_chars").cast("string").alias("description"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("published"),
        F.col("doc_id").cast("string").alias("guid"),
    )
    path = scratch_path(t.spark, "feeds")
    feeds.land_feeds(items, path)
    united = feeds.number_items(feeds.read_feeds(t.spark, path))
    view = materialize(united, scratch_path(t.spark, "united"), key=["source_name", "rn"])
    return view.read().select(
        "source_name", "rn", F.col("guid").cast("bigint").alias("doc_id"), F.col("description").cast("bigint").alias("n_chars")
    )


@query(
    "join_text_names",
    """SELECT d.doc_id, n.name FROM documents d JOIN
         (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS name FROM part UNION SELECT DISTINCT lower(event_type) FROM events) n
       ON d.text ILIKE '%' || n.name || '%'""",
)
def join_text_names(t):
    # Short names in texts: parts' words and kinds of events, of three letters and more.
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("name"))
    names = words.union(t.events.select(F.lower("event_type"))).distinct()
    return contains_join(t.documents.select("doc_id", "text"), names, "doc_id", ["text"], "name").select("doc_id", "name")


@query(
    "union_distinct",
    """SELECT c_nationkey AS nation, 'customer' AS role FROM customer UNION
       SELECT s_nationkey, 'supplier' FROM supplier UNION SELECT n_nationkey, 'nation' FROM nation""",
)
def union_distinct(t):
    feeds = [
        t.customer.select(F.col("c_nationkey").alias("nation"), F.lit("customer").alias("role")),
        t.supplier.select("s_nationkey", F.lit("supplier")),
        t.nation.select("n_nationkey", F.lit("nation")),
    ]
    return reduce(lambda a, b: a.union(b), feeds).distinct()


# --- scalar functions ------------------------------------------------------------------------


@query("str_concat", "SELECT c_custkey, c_name || ' ' || c_mktsegment AS label FROM customer")
def str_concat(t):
    return t.customer.select("c_custkey", F.concat("c_name", F.lit(" "), "c_mktsegment").alias("label"))


@query("str_upper_lower", "SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low FROM part")
def str_upper_lower(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"))


@query("str_ilike", "SELECT doc_id, text ILIKE '%' || upper(lang) || '%' AS names_lang FROM documents")
def str_ilike(t):
    return t.documents.select(
        "doc_id", F.ilike("text", contains_pattern(F.upper("lang"))).alias("names_lang")
    )


@query("str_substr_md5", "SELECT c_custkey, substr(md5(c_name), 1, 25) AS digest FROM customer")
def str_substr_md5(t):
    return t.customer.select("c_custkey", hashed_text(F.col("c_name")).alias("digest"))


@query(
    "strip_tags",
    r"""SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '[\r\n]+', ' ', 'g') AS body
        FROM pages""",
)
def strip_tags_query(t):
    return t.pages.select("page_id", strip_tags(F.col("html")).alias("body"))


@query("date_cast", "SELECT event_id, CAST(ts AS DATE) AS event_day FROM events")
def date_cast(t):
    return t.events.select("event_id", F.to_date("ts").alias("event_day"))


@query(
    "date_extract_year",
    """SELECT o_orderkey, extract(year FROM o_orderdate) AS order_year,
              extract(year FROM DATE '2024-01-31') - extract(year FROM o_orderdate) AS years_ago FROM orders""",
)
def date_extract_year(t):
    today = F.lit("2024-01-31").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.year("o_orderdate").alias("order_year"),
        (F.year(today) - F.year("o_orderdate")).alias("years_ago"),
    )


@query(
    "date_trunc_year",
    """SELECT o_orderkey, CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS year_start,
              CAST(date_trunc('year', o_orderdate) + INTERVAL '1 year' AS TIMESTAMP) AS year_end FROM orders""",
)
def date_trunc_year(t):
    return t.orders.select(
        "o_orderkey",
        times.year_start(F.col("o_orderdate")).alias("year_start"),
        times.next_year_start(F.col("o_orderdate")).alias("year_end"),
    )


@query(
    "age",
    """SELECT o_orderkey, datepart('year', a) AS years, datepart('month', a) AS months, datepart('day', a) AS days
       FROM (SELECT o_orderkey, age(TIMESTAMP '2024-03-01 00:00:00', o_orderdate) AS a FROM orders)""",
)
def age(t):
    parts = times.age(F.lit("2024-03-01").cast("date"), F.col("o_orderdate"))
    return t.orders.select("o_orderkey", parts.alias("a")).select("o_orderkey", "a.*")


@query(
    "ts_difference",
    """SELECT event_id, epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(ts) AS micros_ago FROM events""",
)
def ts_difference(t):
    gap = times.moment("2024-02-01 00:00:00") - F.col("ts")
    # The interval in microseconds, which both sides can show as a number.
    whole = F.extract(F.lit("DAY"), gap) * 86400 + F.extract(F.lit("HOUR"), gap) * 3600
    rest = F.extract(F.lit("MINUTE"), gap) * 60 + F.extract(F.lit("SECOND"), gap)
    micros = (whole.cast("decimal(20,6)") + rest.cast("decimal(20,6)")) * 1000000
    return t.events.select("event_id", micros.cast("long").alias("micros_ago"))


@query("current_time", "SELECT event_id, TIMESTAMP '2024-02-01 00:00:00' AS batch_time FROM events")
def current_time(t):
    return t.events.select("event_id", times.moment("2024-02-01 00:00:00").alias("batch_time"))


@query(
    "range_build_bounds",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate AS lower_bound, l_shipdate + INTERVAL '30 days' AS upper_bound FROM lineitem",
)
def range_build_bounds(t):
    end = F.col("l_shipdate") + F.expr("INTERVAL '30' DAY")
    ranged = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.struct(F.col("l_shipdate").alias("lower"), end.alias("upper")).alias("valid"),
    )
    return ranged.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("valid.lower").alias("lower_bound"),
        F.col("valid.upper").alias("upper_bound"),
    )


@query(
    "range_contains_point",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate <= TIMESTAMP '1998-06-01 00:00:00'
              AND TIMESTAMP '1998-06-01 00:00:00' < l_shipdate + INTERVAL '30 days' AS inside FROM lineitem""",
)
def range_contains_point(t):
    end = F.col("l_shipdate") + F.expr("INTERVAL '30' DAY")
    inside = times.contains_point(F.col("l_shipdate"), end, times.moment("1998-06-01 00:00:00"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", inside.alias("inside"))


@query(
    "range_overlaps",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              o_orderdate < l_shipdate + INTERVAL '30 days' AND l_shipdate < o_orderdate + INTERVAL '60 days' AS meets
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def range_overlaps(t):
    meets = times.overlaps(
        F.col("o_orderdate"),
        F.col("o_orderdate") + F.expr("INTERVAL '60' DAY"),
        F.col("l_shipdate"),
        F.col("l_shipdate") + F.expr("INTERVAL '30' DAY"),
    )
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", meets.alias("meets")
    )


@query(
    "array_length",
    _LARGE_SQL + " SELECT c_custkey, len(keys) AS n_keys FROM customer LEFT JOIN large ON c_custkey = o_custkey",
)
def array_length(t):
    # A length needs no array.
    lengths = _large_orders(t).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_keys"))
    return t.customer.join(lengths, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "n_keys")


@query(
    "random_floor",
    """SELECT o_orderkey, 1 + CAST(floor(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0
              * (SELECT count(*) FROM customer)) AS BIGINT) AS drawn FROM orders""",
)
def random_floor(t):
    # Draws that any engine can repeat: the first digits of a digest as a number from 0 to 1.
    ids = t.customer.agg(F.count(F.lit(1))).scalar()
    digits = F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 8)
    share = F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)
    return t.orders.select("o_orderkey", (1 + F.floor(share * ids)).cast("bigint").alias("drawn"))


@query(
    "generate_series",
    """SELECT o_orderkey, i AS line FROM
         (SELECT o_orderkey, unnest(generate_series(1, CAST(substr(o_orderpriority, 1, 1) AS BIGINT))) AS i FROM orders)""",
)
def generate_series(t):
    top = F.substring("o_orderpriority", 1, 1).cast("long")
    return t.orders.select("o_orderkey", F.explode(F.sequence(F.lit(1).cast("long"), top)).alias("line"))


@query(
    "generate_workload",
    """SELECT row_number() OVER (ORDER BY o_orderkey) + (SELECT max(c_custkey) FROM customer) AS id,
              substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 25) AS text FROM orders""",
)
def generate_workload(t):
    rows = t.orders.select("o_orderkey", hashed_text(F.col("o_orderkey")).alias("text"))
    target = t.customer.select(F.col("c_custkey").alias("id"))
    return with_next_ids(rows, target, "id", ["o_orderkey"]).select("id", "text")
