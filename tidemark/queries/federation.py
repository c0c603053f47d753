"""Sources, sinks, stored results, changes and constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import variants
from tidemark.operators import changes, checks
from tidemark.plans import versions_store
from tidemark.plans.bucketed import BucketedSnapshot
from tidemark.plans.snapshots import materialize
from tidemark.queries.registry import query
from tidemark.session import scratch_path
from tidemark.sources import external, feeds, jsonlines
from tidemark.streaming.refresh import RefreshJob

_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
_ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


def _files(t):
    return external.Source("shop", "parquet", t.folder + "/{table}.parquet")


@query("scan_external_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_external_table(t):
    return external.read_table(t.spark, _files(t), "customer", _CUSTOMER)


@query(
    "import_catalog",
    """SELECT c_mktsegment, count(*) AS n_orders FROM customer JOIN orders ON c_custkey = o_custkey
       GROUP BY c_mktsegment""",
)
def import_catalog(t):
    external.import_tables(t.spark, _files(t), None, ["customer", "orders"], into="shop")
    return t.spark.sql(
        """SELECT c_mktsegment, count(*) AS n_orders FROM shop__customer
           JOIN shop__orders ON c_custkey = o_custkey GROUP BY c_mktsegment"""
    )


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv(t):
    path = scratch_path(t.spark, "customer-csv")
    external.write_csv(t.customer, path)
    return external.read_csv(t.spark, path, _CUSTOMER)


def _order_items(orders):
    """Orders as feed items."""
    return orders.select(
        F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("https://shop.example/order/"), "o_orderkey").alias("link"),
        F.concat(F.lit("<b>status</b> & total of order "), "o_orderkey").alias("description"),
        F.col("o_orderdate").alias("published"),
        F.concat(F.lit("order-"), "o_orderkey").alias("guid"),
    )


@query(
    "scan_feed",
    """SELECT o_orderpriority AS title, 'https://shop.example/order/' || o_orderkey AS link,
              '<b>status</b> & total of order ' || o_orderkey AS description, o_orderdate AS published,
              'order-' || o_orderkey AS guid FROM orders""",
)
def scan_feed(t):
    path = scratch_path(t.spark, "feed")
    feeds.write_feed(_order_items(t.orders), path)
    return feeds.read_feed(t.spark, path)


@query(
    "load_json_lines",
    """SELECT event_id, event_type, CAST(props ->> '$.k' AS INTEGER) AS k FROM events""",
)
def load_json_lines(t):
    path = scratch_path(t.spark, "json-lines")
    line = F.to_json(F.struct("event_id", "event_type", F.from_json("props", "k int").alias("props")))
    t.events.select(line).write.text(path)
    doc = F.col("doc")
    return jsonlines.load_json(t.spark, path).select(
        variants.get_as(doc, "long", "event_id").alias("event_id"),
        variants.get_text(doc, "event_type").alias("event_type"),
        variants.get_as(doc, "int", "props", "k").alias("k"),
    )


# --- stored results --------------------------------------------------------------------------

_PER_CUSTOMER_SQL = """SELECT c_custkey, c_nationkey, count(o_orderkey) AS n_orders,
    round(coalesce(sum(o_totalprice), 0), 2) AS total FROM customer
    LEFT JOIN (SELECT * FROM orders {where}) ON c_custkey = o_custkey GROUP BY c_custkey, c_nationkey"""


def _per_customer(t, status=None):
    orders = t.orders if status is None else t.orders.filter(F.col("o_orderstatus") == status)
    sums = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"))
    return t.customer.join(sums, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey",
        "c_nationkey",
        F.coalesce("n", F.lit(0)).alias("n_orders"),
        F.round(F.coalesce("s", F.lit(0)), 2).alias("total"),
    )


@query("materialize_view", _PER_CUSTOMER_SQL.format(where=""))
def materialize_view(t):
    return materialize(_per_customer(t), scratch_path(t.spark, "mv"), key=["c_custkey"]).read()


@query(
    "mv_on_mv",
    f"""SELECT c_nationkey, sum(n_orders) AS n_orders FROM ({_PER_CUSTOMER_SQL.format(where="")})
        GROUP BY c_nationkey""",
)
def mv_on_mv(t):
    first = materialize(_per_customer(t), scratch_path(t.spark, "mv"), key=["c_custkey"])
    per_nation = first.read().groupBy("c_nationkey").agg(F.sum("n_orders").alias("n_orders"))
    return materialize(per_nation, scratch_path(t.spark, "mv-on-mv"), key=["c_nationkey"]).read()


@query("refresh_view", _PER_CUSTOMER_SQL.format(where=""))
def refresh_view(t):
    view = materialize(_per_customer(t, "F"), scratch_path(t.spark, "mv"), key=["c_custkey"])
    view.refresh(_per_customer(t), key=["c_custkey"], concurrent=True)
    return view.read()


@query("refresh_changed", _PER_CUSTOMER_SQL.format(where=""))
def refresh_changed(t):
    # Customers without orders in state F keep their rows, and buckets without another row are not written.
    view = BucketedSnapshot(t.spark, scratch_path(t.spark, "mv"), ["c_custkey"], buckets=24)
    view.refresh(_per_customer(t, "F"))
    view.refresh(_per_customer(t))
    view.expire(keep=1)
    return view.read()


@query(
    "refresh_log",
    """SELECT 0::BIGINT AS log_id, 'refresh feed snapshot' AS executed, true AS in_order, count(*) AS items FROM orders""",
)
def refresh_log(t):
    # The log of the job's runs, beside what the snapshot holds after them.
    home = scratch_path(t.spark, "refresh")
    snapshot = BucketedSnapshot(t.spark, f"{home}/snapshot", ["guid"], buckets=24)
    job = RefreshJob(t.spark, f"{home}/feed/*", snapshot, f"{home}/log", f"{home}/checkpoint")
    feeds.write_feed(_order_items(t.orders), f"{home}/feed/1")
    job.start(interval=None).awaitTermination()
    items = snapshot.read().agg(F.count(F.lit(1)).alias("items"))
    rows = job.log_rows().select("log_id", "executed", (F.col("time_stamp_begin") <= F.col("time_stamp_end")).alias("in_order"))
    return rows.select("*", items.scalar().alias("items"))


@query(
    "stale_read",
    f"""SELECT 'before' AS seen, * FROM ({_PER_CUSTOMER_SQL.format(where="WHERE o_orderstatus = 'F'")})
        UNION ALL SELECT 'after', * FROM ({_PER_CUSTOMER_SQL.format(where="")})""",
)
def stale_read(t):
    view = materialize(_per_customer(t, "F"), scratch_path(t.spark, "mv"), key=["c_custkey"])
    before = view.read()
    view.refresh(_per_customer(t), key=["c_custkey"])
    after = view.read()
    return before.select(F.lit("before").alias("seen"), "*").unionByName(
        after.select(F.lit("after").alias("seen"), "*")
    )


# --- changes ---------------------------------------------------------------------------------


@query(
    "insert_select",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders UNION ALL
       SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_custkey), c_custkey, 'N'
       FROM customer WHERE c_acctbal < 0""",
)
def insert_select(t):
    target = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    rows = t.customer.filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("o_custkey"), F.lit("N").alias("o_orderstatus")
    )
    return changes.append_rows(target, changes.with_next_ids(rows, target, "o_orderkey", ["o_custkey"]))


@query(
    "insert_document_rows",
    """SELECT 'customer' AS kind, c_name AS name, c_nationkey AS nation FROM customer UNION ALL
       SELECT 'supplier', s_name, s_nationkey FROM supplier""",
)
def insert_document_rows(t):
    def documents(df, kind, prefix):
        row = variants.from_row(
            F.lit(kind).alias("kind"),
            F.col(f"{prefix}_name").alias("name"),
            F.col(f"{prefix}_nationkey").alias("nation"),
        )
        return df.select(row.alias("doc"))

    held = documents(t.customer, "customer", "c")
    grown = changes.append_rows(held, documents(t.supplier, "supplier", "s"))
    doc = F.col("doc")
    return grown.select(
        variants.get_text(doc, "kind").alias("kind"),
        variants.get_text(doc, "name").alias("name"),
        variants.get_as(doc, "int", "nation").alias("nation"),
    )


@query(
    "update_where",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 400000
              THEN upper('0-done') ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def update_where(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    large = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)
    return changes.update_rows(rows, large, {"o_orderpriority": F.upper(F.lit("0-done"))}).drop("o_totalprice")


@query(
    "update_from_join",
    """SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal < 0 AND n_name IS NOT NULL THEN n_name
              ELSE c_mktsegment END AS c_mktsegment FROM customer LEFT JOIN
              (SELECT * FROM nation WHERE n_regionkey > 1) ON c_nationkey = n_nationkey""",
)
def update_from_join(t):
    names = t.nation.filter(F.col("n_regionkey") > 1).select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    changed = changes.update_from(
        t.customer, names, "c_nationkey", {"c_mktsegment": "n_name"}, where=F.col("c_acctbal") < 0
    )
    return changed.select("c_custkey", "c_nationkey", "c_mktsegment")


@query("delete_where", "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'P')")
def delete_where(t):
    return changes.delete_rows(t.orders, F.col("o_orderstatus") == "P").select("o_orderkey", "o_orderstatus")


def _order_versions(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("valid_from"),
        (F.col("o_orderdate") + F.expr("INTERVAL '365' DAY")).alias("valid_to"),
    )


@query(
    "partitioned_table",
    """SELECT o_orderkey AS id, o_orderdate AS valid_from, year(o_orderdate) AS part_year FROM orders
       WHERE o_orderdate <= TIMESTAMP '1998-06-01 00:00:00'
         AND TIMESTAMP '1998-06-01 00:00:00' < o_orderdate + INTERVAL '365 days'""",
)
def partitioned_table(t):
    path = scratch_path(t.spark, "versions")
    versions_store.write_versions(_order_versions(t), path)
    return versions_store.read_as_of(t.spark, path, "1998-06-01 00:00:00").select("id", "valid_from", "part_year")


@query(
    "partition_registry",
    """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS part_year,
              CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS start_value,
              CAST(date_trunc('year', o_orderdate) + INTERVAL '1 year' AS TIMESTAMP) AS end_value FROM orders""",
)
def partition_registry(t):
    return versions_store.partition_registry(_order_versions(t))


# --- constraints -----------------------------------------------------------------------------


@query(
    "unique_check",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
       HAVING count(*) > 1""",
)
def unique_check(t):
    return checks.unique_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "unique_member_check",
    """SELECT event_type || '-' || CAST(props ->> '$.k' AS INTEGER) AS member, count(*) AS n FROM events
       WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
)
def unique_member_check(t):
    # A unique rule over a member of a document: the same expression checks a table and guards a snapshot.
    k = F.get_json_object("props", "$.k").cast("int")
    docs = t.events.select(variants.from_row(F.concat("event_type", F.lit("-"), k).alias("key"), "event_id").alias("doc"))
    key = variants.get_text(F.col("doc"), "key").alias("member")
    return checks.unique_violations(docs, [key])


@query(
    "foreign_key_check",
    """SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS
         (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)""",
)
def foreign_key_check(t):
    solvent = t.customer.filter(F.col("c_acctbal") >= 0)
    bad = checks.foreign_key_violations(t.orders, solvent, ["o_custkey"], ["c_custkey"])
    return bad.select("o_orderkey", "o_custkey")


@query(
    "overlap_check",
    """SELECT l_suppkey, valid_from, valid_to FROM (
         SELECT *, max(valid_to) OVER (PARTITION BY l_suppkey ORDER BY valid_from, valid_to
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
         FROM (SELECT l_suppkey, l_shipdate AS valid_from, l_shipdate + INTERVAL '2 days' AS valid_to FROM lineitem))
       WHERE seen > valid_from""",
)
def overlap_check(t):
    ranges = t.lineitem.select(
        "l_suppkey",
        F.col("l_shipdate").alias("valid_from"),
        (F.col("l_shipdate") + F.expr("INTERVAL '2' DAY")).alias("valid_to"),
    )
    return checks.overlap_violations(ranges, "l_suppkey", "valid_from", "valid_to")


@query(
    "not_null_check",
    """WITH j AS (SELECT * FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 480000)
                  ON c_custkey = o_custkey)
       SELECT 'c_custkey' AS column_name, count(*) FILTER (WHERE c_custkey IS NULL) AS n_null FROM j UNION ALL
       SELECT 'o_orderkey', count(*) FILTER (WHERE o_orderkey IS NULL) FROM j""",
)
def not_null_check(t):
    large = t.orders.filter(F.col("o_totalprice") > 480000)
    joined = t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left")
    return checks.null_violations(joined, ["c_custkey", "o_orderkey"])


# --- the refresh job -------------------------------------------------------------------------


@query(
    "refresh_job",
    """SELECT 'order-' || o_orderkey AS guid, CASE WHEN o_orderstatus = 'F' THEN 'revised' ELSE o_orderpriority END
              AS title, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '1 day' ELSE o_orderdate END
              AS published FROM orders""",
)
def refresh_job(t):
    home = scratch_path(t.spark, "refresh")
    items = _order_items(t.orders.filter(F.col("o_orderstatus") != "F"))
    done = _order_items(t.orders.filter(F.col("o_orderstatus") == "F"))
    revised = done.withColumn("title", F.lit("revised")).withColumn(
        "published", F.col("published") + F.expr("INTERVAL '1' DAY")
    )
    job = RefreshJob(
        t.spark, f"{home}/feed/*", BucketedSnapshot(t.spark, f"{home}/snapshot", ["guid"], buckets=24), f"{home}/log", f"{home}/checkpoint"
    )
    # Two landings: the second repeats finished orders with news, and both are picked up.
    feeds.write_feed(items.unionByName(done), f"{home}/feed/1")
    job.start(interval=None).awaitTermination()
    feeds.write_feed(revised, f"{home}/feed/2")
    job.start(interval=None).awaitTermination()
    return job.snapshot.read().select("guid", "title", "published")
