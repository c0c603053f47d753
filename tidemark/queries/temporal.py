"""Row history: change batches, current, past and full views.

Events are the change log: one version per event of a user, and a final ``error`` is a deletion.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.distinct import first_per_key
from tidemark.plans import temporal
from tidemark.plans.versions_store import VersionTable
from tidemark.queries.registry import query
from tidemark.session import scratch_path

NOW = "2024-02-01 00:00:00"
PAST = "2024-01-15 12:00:00"

_V = """v AS (
    SELECT user_id AS id, ts AS valid_from,
           coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), TIMESTAMP '9999-12-31 23:59:59.999999') AS valid_to,
           event_type, value,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AND event_type = 'error' AS deleted
    FROM events),
  k AS (SELECT user_id AS id, min(ts) AS created FROM events GROUP BY user_id)"""
_END = "TIMESTAMP '9999-12-31 23:59:59.999999'"
_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
_SHOWN = f"id, valid_from, {_TEXT.format('valid_to')} AS valid_to, event_type, value, deleted"


def state(t):
    deleted = F.col("event_type") == "error"
    return temporal.from_events(t.events, "user_id", "ts", ["event_type", "value"], deleted)


def keys(t):
    return t.events.groupBy(F.col("user_id").alias("id")).agg(F.min("ts").alias("created"))


def _shown(df, *columns):
    """The end of a range as text: an open end lies beyond what some clients can hold."""
    text = F.date_format("valid_to", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.withColumn("valid_to", text)


def _customer_changes(t):
    """One change per customer; most customers are no users, so most ids are unknown."""
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("event_type"), F.col("c_acctbal").alias("value")
    )


@query(
    "tt_insert",
    f"""WITH {_V} SELECT {_SHOWN} FROM v UNION ALL
        SELECT (SELECT max(id) FROM k) + row_number() OVER (ORDER BY c_custkey), TIMESTAMP '{NOW}',
               {_TEXT.format(_END)}, c_mktsegment, c_acctbal, false FROM customer""",
)
def tt_insert(t):
    held = state(t)
    rows = t.customer.select("c_custkey", F.col("c_mktsegment").alias("event_type"), F.col("c_acctbal").alias("value"))
    _, versions = temporal.insert_versions(keys(t), held, rows, NOW, ["c_custkey"])
    return _shown(held.unionByName(versions))


@query(
    "tt_update",
    f"""WITH {_V}, hit AS (SELECT v.*, c_mktsegment, c_acctbal FROM v JOIN customer ON id = c_custkey
                           WHERE valid_to = {_END} AND NOT deleted)
        SELECT {_SHOWN} FROM v WHERE NOT (valid_to = {_END} AND NOT deleted AND id IN (SELECT c_custkey FROM customer))
        UNION ALL SELECT id, valid_from, {_TEXT.format(f"TIMESTAMP '{NOW}'")}, event_type, value, false FROM hit
        UNION ALL SELECT id, TIMESTAMP '{NOW}', {_TEXT.format(_END)}, c_mktsegment, c_acctbal, false FROM hit""",
)
def tt_update(t):
    return _shown(temporal.update_versions(state(t), _customer_changes(t), NOW))


_LAST = """last AS (SELECT user_id, max_by(event_type, ts) AS event_type FROM events GROUP BY user_id)"""


@query(
    "tt_delete",
    f"""WITH {_V}, {_LAST}, gone AS (SELECT v.* FROM v WHERE valid_to = {_END}
              AND id IN (SELECT user_id FROM last WHERE event_type = 'purchase'))
        SELECT {_SHOWN} FROM v WHERE NOT (valid_to = {_END} AND event_type = 'purchase')
        UNION ALL SELECT id, valid_from, {_TEXT.format(f"TIMESTAMP '{NOW}'")}, event_type, value, false FROM gone
        UNION ALL SELECT id, TIMESTAMP '{NOW}', {_TEXT.format(_END)}, event_type, value, true FROM gone""",
)
def tt_delete(t):
    last = first_per_key(t.events.select("user_id", "ts", "event_type"), ["user_id"], ["ts"], last=True)
    ids = last.filter(F.col("event_type") == "purchase").select(F.col("user_id").alias("id"))
    return _shown(temporal.delete_versions(state(t), ids, NOW))


@query(
    "tt_current",
    f"""WITH {_V}, n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY valid_from) AS rec_version FROM v)
        SELECT id, rec_version, event_type, value, created, valid_from, {_TEXT.format("valid_to")} AS valid_until
        FROM n JOIN k USING (id) WHERE NOT deleted AND valid_to = {_END}""",
)
def tt_current(t):
    # Numbers are kept with the rows, so the view reads open rows alone.
    view = temporal.current(temporal.numbered(state(t)), keys(t))
    return view.withColumn("valid_until", F.date_format("valid_until", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


_NUMBERED = f"""WITH {_V} SELECT {_SHOWN}, row_number() OVER (PARTITION BY id ORDER BY valid_from) AS rec_version
    FROM v ORDER BY id, rec_version"""


@query("tt_history", _NUMBERED + " DESC")
def tt_history(t):
    return _shown(temporal.history(state(t), descending=True))


@query("tt_all_versions", _NUMBERED)
def tt_all_versions(t):
    return _shown(temporal.history(state(t)))


@query(
    "tt_as_of",
    f"""WITH {_V} SELECT {_SHOWN}, row_number() OVER (PARTITION BY id ORDER BY valid_from) AS rec_version, created
        FROM v JOIN k USING (id) WHERE valid_from <= TIMESTAMP '{PAST}' AND TIMESTAMP '{PAST}' < valid_to""",
)
def tt_as_of(t):
    return _shown(temporal.as_of(state(t), PAST, keys(t)))


@query(
    "tt_stored_current",
    f"""WITH {_V}, n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY valid_from) AS rec_version FROM v)
        SELECT id, rec_version, event_type, value, created, valid_from, {_TEXT.format("valid_to")} AS valid_until
        FROM n JOIN k USING (id) WHERE NOT deleted AND valid_to = {_END}""",
)
def tt_stored_current(t):
    table = VersionTable(t.spark, scratch_path(t.spark, "history"))
    table.create(state(t), keys(t))
    return table.current().withColumn("valid_until", F.date_format("valid_until", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    "tt_statistics",
    f"""WITH {_V}, n AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY valid_from) AS rec_version FROM v)
        SELECT count(*) AS recordcount, min(v.id) AS min_id, max(v.id) AS max_id, min(rec_version) AS min_version,
               max(rec_version) AS max_version, count(v.id) FILTER (WHERE deleted) AS deleted_records,
               (SELECT count(*) FROM v) AS version_rows
        FROM k JOIN v ON k.id = v.id JOIN n ON k.id = n.id""",
)
def tt_statistics(t):
    return temporal.statistics(state(t), keys(t))


@query(
    "join_versions_on_id",
    f"""WITH {_V} SELECT a.id, count(*) AS pair_rows, count(*) FILTER (WHERE a.deleted) AS deleted_pairs
        FROM v a JOIN v b ON a.id = b.id GROUP BY a.id""",
)
def join_versions_on_id(t):
    return temporal.version_pairs(state(t))


_DML_SQL = f"""WITH {_V}, cur AS (SELECT v.*, c_mktsegment, c_acctbal,
              CASE c_mktsegment WHEN 'BUILDING' THEN 'update' WHEN 'MACHINERY' THEN 'delete' END AS op
              FROM v JOIN customer ON id = c_custkey WHERE valid_to = {_END} AND NOT deleted)
        SELECT {_SHOWN} FROM v
          WHERE NOT (valid_to = {_END} AND NOT deleted AND id IN (SELECT id FROM cur WHERE op IS NOT NULL))
        UNION ALL SELECT id, valid_from, {_TEXT.format(f"TIMESTAMP '{NOW}'")}, event_type, value, false FROM cur
          WHERE op IS NOT NULL
        UNION ALL SELECT id, TIMESTAMP '{NOW}', {_TEXT.format(_END)},
          CASE op WHEN 'update' THEN c_mktsegment ELSE event_type END,
          CASE op WHEN 'update' THEN c_acctbal ELSE value END, op = 'delete' FROM cur WHERE op IS NOT NULL
        UNION ALL SELECT (SELECT max(id) FROM k) + row_number() OVER (ORDER BY c_acctbal, c_mktsegment, c_custkey),
          TIMESTAMP '{NOW}', {_TEXT.format(_END)}, c_mktsegment, c_acctbal, false
          FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"""


def _view_changes(t, visible):
    """A change per customer. Updates and deletes go through the current view, so that ids it does
    not show are out of reach."""
    op = (
        F.when(F.col("event_type") == "BUILDING", "update")
        .when(F.col("event_type") == "MACHINERY", "delete")
        .otherwise("insert")
    )
    wanted = _customer_changes(t).withColumn("op", op)
    reached = wanted.filter(F.col("op") != "insert").join(visible, "id", "left_semi")
    return reached.unionByName(wanted.filter(F.col("op") == "insert"))


@query("tt_view_dml", _DML_SQL)
def tt_view_dml(t):
    held, known = state(t), keys(t)
    batch = _view_changes(t, temporal.current(held, known).select("id"))
    _, versions = temporal.apply_changes(known, held, batch, NOW, ["value", "event_type", "id"])
    return _shown(versions)


@query("tt_stored_batch", _DML_SQL)
def tt_stored_batch(t):
    table = VersionTable(t.spark, scratch_path(t.spark, "history"))
    table.create(state(t), keys(t))
    batch = _view_changes(t, table.current().select("id"))
    table.apply(batch, NOW, ["value", "event_type", "id"])
    return _shown(table.versions())


@query(
    "distinct_change_batch",
    """SELECT user_id AS id, max_by(event_type, ts) AS event_type, max_by(value, ts) AS value
       FROM events GROUP BY user_id""",
)
def distinct_change_batch(t):
    draws = t.events.select(F.col("user_id").alias("id"), "ts", "event_type", "value")
    return temporal.dedupe_changes(draws, ["ts"]).drop("ts")


# --- the simple variant ----------------------------------------------------------------------

_SIMPLE = "id, valid_from, " + _TEXT.format("valid_to") + " AS valid_to, event_type, value"


def simple_state(t):
    return state(t).drop("deleted")


@query("asof_current", f"WITH {_V} SELECT {_SIMPLE} FROM v WHERE valid_from <= TIMESTAMP '{NOW}' AND TIMESTAMP '{NOW}' < valid_to")
def asof_current(t):
    return _shown(temporal.range_current(simple_state(t), NOW))


@query("asof_historic", f"WITH {_V} SELECT {_SIMPLE} FROM v WHERE valid_from <= TIMESTAMP '{PAST}' AND TIMESTAMP '{PAST}' < valid_to")
def asof_historic(t):
    return _shown(temporal.range_current(simple_state(t), PAST))


@query(
    "asof_update",
    f"""WITH {_V}, hit AS (SELECT v.*, c_mktsegment, c_acctbal FROM v JOIN customer ON id = c_custkey
                           WHERE valid_to = {_END})
        SELECT {_SIMPLE} FROM v WHERE NOT (valid_to = {_END} AND id IN (SELECT c_custkey FROM customer))
        UNION ALL SELECT id, valid_from, {_TEXT.format(f"TIMESTAMP '{NOW}'")}, event_type, value FROM hit
        UNION ALL SELECT id, TIMESTAMP '{NOW}', {_TEXT.format(_END)}, c_mktsegment, c_acctbal FROM hit""",
)
def asof_update(t):
    return _shown(temporal.range_update(simple_state(t), _customer_changes(t), NOW))


@query(
    "asof_delete",
    f"""WITH {_V}, {_LAST} SELECT id, valid_from,
          {_TEXT.format(f"CASE WHEN valid_to = {_END} AND l.event_type = 'purchase' THEN TIMESTAMP '{NOW}' ELSE valid_to END")}
          AS valid_to, v.event_type, value FROM v JOIN last l ON id = user_id""",
)
def asof_delete(t):
    last = first_per_key(t.events.select("user_id", "ts", "event_type"), ["user_id"], ["ts"], last=True)
    ids = last.filter(F.col("event_type") == "purchase").select(F.col("user_id").alias("id"))
    return _shown(temporal.range_delete(simple_state(t), ids, NOW))


@query(
    "asof_insert",
    f"""WITH {_V} SELECT {_SIMPLE} FROM v UNION ALL
        SELECT c_custkey, TIMESTAMP '{NOW}', {_TEXT.format(_END)}, c_mktsegment, c_acctbal FROM customer
        WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
)
def asof_insert(t):
    held = simple_state(t)
    rows = _customer_changes(t).join(held.select("id").distinct(), "id", "left_anti")
    return _shown(temporal.range_insert(held, rows, NOW))


@query("asof_stats", "SELECT min(ts) AS min_from, max(ts) AS max_from, count(*) AS n FROM events")
def asof_stats(t):
    return temporal.range_statistics(simple_state(t))
