"""Row history: versions with validity ranges, change batches, current, past and full views.

A version table has ``id``, ``valid_from``, ``valid_to``, payload columns and ``deleted``. The newest
version of an id ends at ``OPEN_END``. A change batch has at most one row per id and one timestamp.

A table may also have ``rec_version``, the number of a version within its id (``numbered`` adds it). The change
operators keep it up to date, and the current view then needs the open versions alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import contains_point, open_end
from tidemark.operators.changes import with_next_ids
from tidemark.operators.checks import ConstraintError, first_violation, unique_violations
from tidemark.operators.distinct import first_per_key
from tidemark.operators.ordered import next_value, row_number

_META = ("id", "valid_from", "valid_to", "deleted", "rec_version")


def payload_columns(state: DataFrame) -> list[str]:
    return [c for c in state.columns if c not in _META]


def from_events(events: DataFrame, key: str, ts: str, payload: Sequence[str], deleted: Column) -> DataFrame:
    """Versions out of a change log: a row is valid until the next row of its key.

    Only the newest row of a key can be a tombstone, so ``deleted`` is kept there alone.
    """
    rows = events.select(
        F.col(key).alias("id"), F.col(ts).alias("valid_from"), *payload, deleted.alias("__deleted")
    )
    ranged = next_value(rows, ["id"], [F.col("valid_from").asc_nulls_last()], "valid_from", "__next")
    return ranged.select(
        "id",
        "valid_from",
        F.coalesce("__next", open_end()).alias("valid_to"),
        *payload,
        (F.col("__next").isNull() & F.col("__deleted")).alias("deleted"),
    )


# --- change batches -------------------------------------------------------------------------


def dedupe_changes(changes: DataFrame, order: Sequence[str], last: bool = True) -> DataFrame:
    """One change per id: the last (or first) one by ``order``."""
    return first_per_key(changes, ["id"], order, last=last)


def _open_rows(state: DataFrame) -> DataFrame:
    return state.filter(F.col("valid_to") == open_end())


def change_violations(state: DataFrame, changes: DataFrame, ts: Column) -> DataFrame:
    """(id, reason) of changes that must stop the batch before anything is published."""
    unknown = changes.filter(~F.col("op").isin("insert", "update", "delete") | F.col("op").isNull())
    repeated = changes.filter(F.col("op") != "insert").groupBy("id").count().filter(F.col("count") > 1)
    current = _open_rows(state).select("id", "valid_from", "deleted")
    hits = changes.filter(F.col("op") != "insert").select("id", "op", *_new_id(changes)).join(current, "id")
    reason = F.when(F.col("deleted") & (F.col("op") == "delete"), "already deleted")
    if "new_id" in changes.columns:
        moved = (F.col("op") == "update") & F.col("new_id").isNotNull() & (F.col("new_id") != F.col("id"))
        reason = F.when(moved, "the id cannot be changed").otherwise(reason)
    stale = (~F.col("deleted")) & (F.col("valid_from") >= ts)
    reason = F.when(stale, "timestamp not after the open version").otherwise(reason)
    found = hits.select("id", reason.alias("reason")).filter(F.col("reason").isNotNull())
    return found.unionByName(
        repeated.select("id", F.lit("more than one change").alias("reason"))
    ).unionByName(unknown.select("id", F.lit("unknown operation").alias("reason")))


def _new_id(changes: DataFrame) -> list[str]:
    return ["new_id"] if "new_id" in changes.columns else []


def check_changes(state: DataFrame, changes: DataFrame, ts: Column) -> None:
    bad = first_violation(change_violations(state, changes, ts))
    if bad is not None:
        raise ConstraintError(f"id {bad['id']}: {bad['reason']}")


def _stamp(ts) -> Column:
    return ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp_ntz")


def _replace_open(state: DataFrame, changes: DataFrame, ts: Column, tombstones: bool) -> DataFrame:
    """Apply updates and deletes. Only open versions are joined; history passes by untouched."""
    payload = payload_columns(state)
    ends = F.col("valid_to") == open_end()
    history = state.filter(~ends)
    batch = changes.select(
        F.col("id").alias("__id"), F.col("op").alias("__op"), *[F.col(c).alias(f"__new_{c}") for c in payload]
    )
    joined = state.filter(ends).join(batch, F.col("id") == F.col("__id"), "left")
    has_flag, has_number = "deleted" in state.columns, "rec_version" in state.columns
    alive = ~F.col("deleted") if has_flag else F.lit(True)
    update = F.coalesce((F.col("__op") == "update") & alive, F.lit(False))
    delete = F.coalesce((F.col("__op") == "delete") & alive, F.lit(False))

    def version(start, end, values, deleted, later=0):
        fields = [F.col("id"), start.alias("valid_from"), end.alias("valid_to"), *values]
        if has_flag:
            fields.append(deleted.alias("deleted"))
        if has_number:
            fields.append((F.col("rec_version") + later).alias("rec_version"))
        return F.struct(*fields)

    old = [F.col(c) for c in payload]
    new = [F.col(f"__new_{c}").alias(c) for c in payload]
    flag = F.col("deleted") if has_flag else F.lit(False)
    kept = version(F.col("valid_from"), F.col("valid_to"), old, flag)
    closed = version(F.col("valid_from"), ts, old, F.lit(False))
    updated = version(ts, open_end(), new, F.lit(False), later=1)
    buried = version(ts, open_end(), old, F.lit(True), later=1)
    after_delete = F.array(closed, buried) if tombstones else F.array(closed)
    rows = F.when(update, F.array(closed, updated)).when(delete, after_delete).otherwise(F.array(kept))
    changed = joined.select(F.explode(rows).alias("__row")).select("__row.*")
    return history.unionByName(changed)


def insert_versions(
    keys: DataFrame, state: DataFrame, rows: DataFrame, ts, order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """New ids for ``rows`` in ``order``: (key rows with ``created``, version rows).

    Both results carry the columns of the tables they are to be appended to; the version rows also
    tell the caller which id a row received.
    """
    at = _stamp(ts)
    # The rows may have an ``id`` of their own, which can order them but is not kept.
    by = {f"__by{i}": F.col(c) for i, c in enumerate(order)}
    given = rows.select(*[c.alias(name) for name, c in by.items()], *payload_columns(state))
    placed = with_next_ids(given, keys, "id", list(by))
    new_keys = placed.select("id", at.alias("created"))
    payload = payload_columns(state)
    versions = placed.select(
        "id",
        at.alias("valid_from"),
        open_end().alias("valid_to"),
        *payload,
        F.lit(False).alias("deleted"),
        F.lit(1).cast("long").alias("rec_version"),
    )
    return new_keys, versions.select(*state.columns)


def update_versions(state: DataFrame, changes: DataFrame, ts, check: bool = True) -> DataFrame:
    """Close the open version of every changed id at ``ts`` and add the new payload.

    Older versions, deleted ids and unknown ids stay as they are.
    """
    batch = changes.withColumn("op", F.lit("update"))
    if check:
        check_changes(state, batch, _stamp(ts))
    return _replace_open(state, batch, _stamp(ts), tombstones=True)


def delete_versions(state: DataFrame, ids: DataFrame, ts, check: bool = True) -> DataFrame:
    """Close the open version of every id at ``ts`` and add a tombstone with the same payload."""
    batch = _as_batch(ids, state, "delete")
    if check:
        check_changes(state, batch, _stamp(ts))
    return _replace_open(state, batch, _stamp(ts), tombstones=True)


def _as_batch(ids: DataFrame, state: DataFrame, op: str) -> DataFrame:
    types = {f.name: f.dataType for f in state.schema.fields}
    empty = [F.lit(None).cast(types[c]).alias(c) for c in payload_columns(state)]
    return ids.select("id", F.lit(op).alias("op"), *empty)


def change_batch(
    keys: DataFrame, state: DataFrame, changes: DataFrame, ts, order: Sequence[str], check: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Inserts, updates and deletes of one batch (column ``op``): (new keys, next versions).

    Only open versions take part, so ``state`` may leave the closed ones out; the result then has the open versions and those that
    the batch has closed.
    """
    at = _stamp(ts)
    if check:
        check_changes(state, changes, at)
    replaced = _replace_open(state, changes.filter(F.col("op") != "insert"), at, tombstones=True)
    new_keys, versions = insert_versions(keys, state, changes.filter(F.col("op") == "insert"), at, order)
    return new_keys, replaced.unionByName(versions)


def apply_changes(
    keys: DataFrame, state: DataFrame, changes: DataFrame, ts, order: Sequence[str], check: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The same batch: the next (keys, versions)."""
    new_keys, versions = change_batch(keys, state, changes, ts, order, check)
    return keys.unionByName(new_keys), versions


# --- views ----------------------------------------------------------------------------------


def current(state: DataFrame, keys: DataFrame) -> DataFrame:
    """The open, not deleted version of every id, with its version number and creation time.

    Where the table has numbers, only open versions are read. Without them, the open version being the last one, its number is the
    count of versions of its id: an aggregate with map-side combine instead of a window over the whole history.
    """
    alive = _open_rows(state).filter(~F.col("deleted"))
    if "rec_version" not in state.columns:
        alive = alive.join(state.groupBy("id").agg(F.count(F.lit(1)).alias("rec_version")), "id")
    return alive.join(keys.select("id", "created"), "id").select(
        "id",
        "rec_version",
        *payload_columns(state),
        "created",
        "valid_from",
        F.col("valid_to").alias("valid_until"),
    )


def numbered(state: DataFrame) -> DataFrame:
    """Every version with its number within its id."""
    if "rec_version" in state.columns:
        return state
    return row_number(state, ["id"], [F.col("valid_from").asc_nulls_last()], "rec_version")


def history(state: DataFrame, ids: Sequence | None = None, descending: bool = False) -> DataFrame:
    """All versions, tombstones included, of some ids (default: of all), with numbers, sorted."""
    chosen = state if ids is None else state.filter(F.col("id").isin(list(ids)))
    rows = numbered(chosen)
    version = F.col("rec_version").desc_nulls_first() if descending else F.col("rec_version").asc_nulls_last()
    return rows.orderBy(F.col("id").asc_nulls_last(), version)


def as_of(state: DataFrame, ts, keys: DataFrame | None = None) -> DataFrame:
    """Versions valid at ``ts``, tombstones included, of the ids in ``keys`` with their ``created``, where these are given.

    The number counts the rows that are left after the filter. As the ranges of an id don't overlap, that is one row per id.
    """
    valid = state.filter(contains_point(F.col("valid_from"), F.col("valid_to"), _stamp(ts))).drop("rec_version")
    window = Window.partitionBy("id").orderBy("valid_from")
    rows = valid.withColumn("rec_version", F.row_number().over(window))
    return rows if keys is None else rows.join(keys.select("id", "created"), "id")


def statistics(state: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of figures over versions joined to numbered versions on the id alone.

    That join has n * n rows for an id with n versions; its counts follow from n, so the join is
    never made. ``version_rows`` is the plain number of versions.
    """
    known = state.join(keys.select("id"), "id", "left_semi")
    per_id = known.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("deleted"), 1)).alias("gone")
    )
    return per_id.agg(
        F.sum(F.col("n") * F.col("n")).alias("recordcount"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
        F.min(F.lit(1)).alias("min_version"),
        F.max("n").alias("max_version"),
        F.sum(F.col("n") * F.col("gone")).alias("deleted_records"),
        F.sum("n").alias("version_rows"),
    )


def version_pairs(state: DataFrame) -> DataFrame:
    """Per id: rows of the join of its versions with themselves, and those on deleted versions."""
    per_id = state.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("deleted"), 1)).alias("gone")
    )
    return per_id.select(
        "id", (F.col("n") * F.col("n")).alias("pair_rows"), (F.col("n") * F.col("gone")).alias("deleted_pairs")
    )


# --- the simple variant: no tombstones -------------------------------------------------------


def range_current(state: DataFrame, now) -> DataFrame:
    """Rows whose range contains ``now``."""
    return state.filter(contains_point(F.col("valid_from"), F.col("valid_to"), _stamp(now)))


def range_update(state: DataFrame, changes: DataFrame, now, check: bool = True) -> DataFrame:
    """Close the current row at ``now`` and open a new one; ids without a current row are skipped."""
    batch = changes.withColumn("op", F.lit("update"))
    if check:
        check_changes(_flagged(state), batch, _stamp(now))
    return _replace_open(state, batch, _stamp(now), tombstones=False)


def range_delete(state: DataFrame, ids: DataFrame, now, check: bool = True) -> DataFrame:
    """Close the current row at ``now``; nothing is added."""
    batch = _as_batch(ids, state, "delete")
    if check:
        check_changes(_flagged(state), batch, _stamp(now))
    return _replace_open(state, batch, _stamp(now), tombstones=False)


def range_insert(state: DataFrame, rows: DataFrame, now) -> DataFrame:
    """Open a range ``[now, end)`` per row; an id that already has a later end is an error."""
    fresh = rows.select("id", _stamp(now).alias("valid_from"), open_end().alias("valid_to"), *payload_columns(state))
    twice = unique_violations(fresh, ["id"]).select("id")
    busy = state.filter(F.col("valid_to") > _stamp(now)).join(fresh.select("id"), "id", "left_semi").select("id")
    bad = first_violation(twice.unionByName(busy))
    if bad is not None:
        raise ConstraintError(f"id {bad['id']}: ranges would overlap")
    return state.unionByName(fresh.select(*state.columns))


def _flagged(state: DataFrame) -> DataFrame:
    return state.withColumn("deleted", F.lit(False))


def range_statistics(state: DataFrame) -> DataFrame:
    return state.agg(
        F.min("valid_from").alias("min_from"), F.max("valid_from").alias("max_from"), F.count(F.lit(1)).alias("n")
    )
